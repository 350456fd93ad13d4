"""From raw documents to packed training sequences, stage by stage.

Quality rules and toxicity drop documents, the Jaccard join leaves one document of
each group, the secret scan replaces live secrets in the texts, and packing lays the
token pieces of what is left into sequences. Each stage's result is written and read
again before the next one works on all of it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.llm import jaccard, packing, quality, secrets, toxicity
from starloom.llm.tables import is_fold, table
from starloom.session import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Words of a shingle and least similarity of near duplicates.
WORDS, PERCENT = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base filter and the rules' posterior keep."""
    return quality.keep(docs)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a toxic window, by a network trained on labelled documents."""
    labels = table(spark, sf_dir, "labels").where(~is_fold(F.col("doc_id"), 5, 0))
    network = toxicity.train(table(spark, sf_dir, "documents"), labels)
    scored = toxicity.score(docs, network, docs.columns)
    return scored.where("score < 0.5").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words, similarity 0.8."""
    return jaccard.keep_one(docs, size=WORDS, percent=PERCENT)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, live-looking secrets replaced, ``n_chars`` counted anew."""
    clean = secrets.redact(docs, F.col("source"), F.concat_ws("/", "source", "lang"))
    return clean.withColumn("n_chars", F.length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequences' pieces."""
    import public_tokenizers

    return packing.pack(packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("toxicity", drop_toxic),
    ("ngram_jaccard", near_duplicates),
    ("secret_scan", redact_secrets),
    ("packing", pack),
]
#: The stages train models and pack by a bounded search, which SQL does not express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, work in STAGES:
        docs = stage(work(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"pipeline": pipeline}
ORACLE: dict[str, str] = {}
