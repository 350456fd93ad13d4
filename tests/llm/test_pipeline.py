from pathlib import Path

import pytest

from llm_shared import docs  # noqa: F401
import corpus_pipeline as c
from __spark_entry__ import SMALL, queries

pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="the given tables are not here")


def prose(n):
    return " ".join(f"word{n}and{i}" for i in range(70)) + ". "


def test_every_operator_is_registered():
    names = set(queries())
    assert "pipeline" in names
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))


def test_stages_take_effect(spark, docs):
    key = "password = 0123456789abcdef0123"
    rows = [(i, prose(i)) for i in range(12)] + [(20, prose(3)), (21, prose(4) + key), (22, "spam " * 80), (23, None)]
    frame = docs(*rows)
    after = c.quality_rules(spark, frame, SMALL)
    assert after.columns == c.COLUMNS and {r["doc_id"] for r in after.collect()} == {*range(12), 20, 21}
    unique = c.near_duplicates(spark, after, SMALL)
    assert unique.columns == c.COLUMNS and {r["doc_id"] for r in unique.collect()} == {*range(12)}
    clean = {r["doc_id"]: r for r in c.redact_secrets(spark, docs((1, prose(4) + key)), SMALL).collect()}
    assert clean[1]["text"] == prose(4) + "[SECRET]" and clean[1]["n_chars"] == len(clean[1]["text"])
    packed = c.pack(spark, unique, SMALL).collect()
    assert {r["doc_id"] for r in packed} == {*range(12)}


def test_the_whole_pipeline_on_the_smallest_tables(spark):
    out = c.run(spark, SMALL).collect()
    assert out and all(r["offset"] + r["length"] <= 2048 for r in out)
    assert [name for name, _ in c.STAGES] == ["quality_rules", "toxicity", "ngram_jaccard", "secret_scan", "packing"]
