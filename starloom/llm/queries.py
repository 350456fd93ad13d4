"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.llm import (
    alignment,
    bpe,
    jaccard,
    language,
    lines,
    lm,
    neighbours,
    packing,
    personal,
    quality,
    secrets,
    toxicity,
    whitening,
)
from starloom.llm.tables import is_fold, table


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior"
    )


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", is_fold(F.col("doc_id"), 3, 1))
    model = language.train(docs.where(~F.col("held_out")))
    return language.identify(docs, model, ["doc_id", "held_out"])


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's source is its owner, and a source's language part its repository."""
    docs = table(spark, sf_dir, "documents")
    return secrets.scan(docs, F.col("source"), F.concat_ws("/", "source", "lang"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json")
    lexicon = bpe.lexicon_of(bpe.frequent_words(docs), path)
    return bpe.digests(docs, path, lexicon)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", is_fold(F.col("doc_id"), 5, 0))
    labels = table(spark, sf_dir, "labels").where(~is_fold(F.col("doc_id"), 5, 0))
    network = toxicity.train(docs.where(~F.col("held_out")), labels)
    scored = toxicity.score(docs, network, ["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(packing.pieces(docs, _tokenizer("byte_bpe_50k.json")))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.scan(table(spark, sf_dir, "documents"))


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector."""
    found = neighbours.search(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(20)) == 0, 20)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", is_fold(F.col("doc_id"), 10, 0))
    return lm.score(docs, "held_out")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE against pieces."""
    docs = table(spark, sf_dir, "documents")
    return alignment.align(docs, _tokenizer("byte_bpe_50k.json"), _tokenizer("piece_bpe_32k.model"))


def op12_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", is_fold(F.col("doc_id"), 4, 2))
    labels = table(spark, sf_dir, "labels").where(~is_fold(F.col("doc_id"), 4, 2))
    field = lines.train(docs.where(~F.col("held_out")), labels)
    scored = lines.score(docs, field, ["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_language_id,
        op3_ngram_jaccard,
        op4_secret_scan,
        op5_bpe,
        op6_toxicity,
        op7_packing,
        op8_personal_data,
        op9_nearest,
        op10_lm_score,
        op11_alignment,
        op12_line_quality,
        op13_whitening,
    )
}
ORACLE: dict[str, str] = {}
