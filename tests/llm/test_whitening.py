import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import whitening as w

ROWS = "vec_id long, embedding array<float>"


def brute(vectors, most=32):
    x = np.floor(64 * vectors.astype(np.float64)).astype(np.int64) + w.SHIFT
    n, sums = len(x), x.sum(0)
    centred = x - sums / n
    values, u = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:most]
    return ((n * x - sums) ** 2).sum(1), centred @ u[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def check(rows, ids, vectors, most=32):
    deviation, whitened, explained = brute(vectors, most)
    k = whitened.shape[1]
    assert len(rows) == len(ids) * k
    got = np.full((len(ids), k), np.nan)
    place = {i: at for at, i in enumerate(ids)}
    for r in rows:
        at, c = place[r["vec_id"]], r["component"] - 1
        got[at, c] = r["whitened"]
        assert r["n"] == len(ids) and r["deviation"] == deviation[at]
        assert abs(r["explained"] / explained[c] - 1) < 1e-6 and r["identity_error"] < 1e-8
    sign = np.sign((got * whitened).sum(0))
    assert np.abs(got * sign - whitened).max() < 1e-7


@pytest.mark.parametrize("block_rows,block_cols", [(1024, 1024), (7, 4), (1, 3)])
def test_equals_a_plain_version(spark, monkeypatch, block_rows, block_cols):
    monkeypatch.setattr(w, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(w, "BLOCK_COLS", block_cols)
    monkeypatch.setattr(w, "BLOCKS_PER_SPLIT", 3)
    r = np.random.default_rng(3)
    x = (r.normal(size=(150, 6)) @ r.normal(size=(6, 6)) + 2).astype(np.float32)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], ROWS).repartition(4)
    check(w.whiten(frame).collect(), list(range(150)), x)


def test_at_most_so_many_components(spark):
    r = np.random.default_rng(4)
    x = r.normal(size=(90, 40)).astype(np.float32)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], ROWS)
    check(w.whiten(frame).collect(), list(range(90)), x)
    check(w.whiten(frame, most=3).collect(), list(range(90)), x, 3)


def test_rows_that_take_no_part_and_clashing_columns(spark):
    x = np.array([[1.0, 0.25], [0.5, 3.0], [-2.0, 1.0], [0.0, 0.0]], np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(10, None), (11, []), (12, [None, 1.0]), (13, [float("nan"), 1.0]), (14, [float("-inf"), 1.0]), (15, [1.0, 2.0, 3.0])]
    frame = spark.createDataFrame(rows, ROWS)
    for name in ("x", "n", "b", "part", "ids", "whitened", "deviation"):
        frame = frame.withColumn(name, F.lit("other"))
    check(w.whiten(frame).collect(), [0, 1, 2, 3], x)


def test_repeated_and_null_ids_are_rows(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [0.0, 2.0]), (None, [0.5, 1.0]), (2, [5.0, 1.0])]
    got = w.whiten(spark.createDataFrame(rows, ROWS)).collect()
    assert sorted(str(r["vec_id"]) for r in got if r["component"] == 1) == ["1", "1", "2", "None", "None"]
    assert got[0]["n"] == 5 and got[0]["identity_error"] < 1e-8


def test_no_variance_and_no_rows(spark):
    same = w.whiten(spark.createDataFrame([(i, [1.0, 2.0]) for i in range(9)], ROWS))
    none = w.whiten(spark.createDataFrame([], ROWS))
    assert same.count() == none.count() == 0 and same.columns == none.columns == list(w.RESULT)
    # two dimensions that always move together have one component
    line = w.whiten(spark.createDataFrame([(i, [float(i), float(2 * i)]) for i in range(9)], ROWS)).collect()
    assert {r["component"] for r in line} == {1} and abs(line[0]["explained"] - 1) < 1e-9


def test_frequent_lengths_and_overflow(spark):
    rows = [(i, [float(i), 1.0 + i * i]) for i in range(4)] + [(9 + i, [float(i), 1.0 + i * i, i / 7]) for i in range(5)]
    got = w.whiten(spark.createDataFrame(rows, ROWS)).collect()
    assert {r["vec_id"] for r in got} == {9, 10, 11, 12, 13}
    with pytest.raises(Exception, match="OVERFLOW|overflow"):
        w.whiten(spark.createDataFrame([(1, [1e30, 1.0]), (2, [0.0, 1.0])], ROWS)).collect()
