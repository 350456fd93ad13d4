import numpy as np
from pyspark.sql import functions as F

from starloom.llm import neighbours as a

ROWS = "vec_id long, embedding array<float>"


def brute(ids, x, own, query, k):
    score = (x * query).sum(1)
    order = np.lexsort((ids, -score))
    order = order[ids[order] != own][:k]
    return ids[order].tolist(), score[order]


def search(spark, rows, k=5, **kind):
    frame = spark.createDataFrame(rows, ROWS)
    return a.search(frame, F.pmod("vec_id", F.lit(5)) == 0, k, **kind).orderBy("query_id", "rank").collect()


def test_recall_against_brute_force(spark):
    r = np.random.default_rng(1)
    x = r.normal(size=(1500, 24)).astype(np.float32) * r.uniform(0.2, 3, (1500, 1)).astype(np.float32)
    got = search(spark, [(i, v.tolist()) for i, v in enumerate(x)], 10, block_rows=400, chunk_queries=100)
    ids, hits, wide = np.arange(1500), 0, x.astype(np.float64)
    assert len(got) == 300 * 10
    for q in range(0, 1500, 5):
        mine = [r for r in got if r["query_id"] == q]
        assert [r["rank"] for r in mine] == list(range(1, 11)) and q not in [r["id"] for r in mine]
        assert all(abs(r["score"] - wide[r["id"]] @ wide[q]) < 1e-9 for r in mine)
        hits += len({r["id"] for r in mine} & set(brute(ids, wide, q, wide[q], 10)[0]))
    assert hits / 3000 > 0.95


def test_the_forest_looks_at_few_where_neighbours_are_near():
    r = np.random.default_rng(2)
    centres = r.normal(size=(80, 32))
    x = np.repeat(centres, 50, 0) + 0.05 * r.normal(size=(4000, 32))
    longest = np.sqrt((x**2).sum(1).max())
    normals = a.planes(32)
    forest = a.Forest.of(a._strings(a.longer(x, longest), normals))
    flat = np.concatenate([x[:1] / np.linalg.norm(x[0]), np.zeros((1, 1))], 1)
    own = a._strings(flat, normals)
    sizes = []
    for length in range(a.BITS + 1):
        begin, end = forest.ranges(own, length)
        sizes.append((end - begin)[:, 0])
    assert (np.diff(sizes, axis=0) <= 0).all() and (sizes[0] == 4000).all()
    length = int(forest.longest(own, a.FIRST * 10 + a.TREES)[0])
    begin, end = forest.ranges(own, length)
    met = forest.candidates(begin[:, 0], end[:, 0])
    plain = {int(p) for t in range(a.TREES) for p in forest.places[t, begin[t, 0] : end[t, 0]]}
    assert set(met.tolist()) == plain
    assert length > 4 and len(met) < 400 and set(brute(np.arange(4000), x, 0, x[0], 10)[0]) <= plain


def test_few_are_scored_where_neighbours_are_near_and_many_are_left_out_where_not(monkeypatch):
    """Clustered vectors, and random ones, which have no near neighbours; blocks of a larger table."""
    r = np.random.default_rng(5)
    near = np.repeat(r.normal(size=(160, 64)), 50, 0) + 0.1 * r.normal(size=(8000, 64))
    far = r.normal(size=(8000, 64))
    scored = []
    work = a.Forest.candidates
    monkeypatch.setattr(a.Forest, "candidates", lambda *args: scored.append(len(got := work(*args))) or got)
    for x, most, at_least in ((near, 0.1, 0.99), (far / np.linalg.norm(far, axis=1)[:, None], 0.5, 0.9)):
        scored.clear()
        queries = x[:60]
        longest = np.sqrt((x**2).sum(1).max())
        hits = 0
        for own, met, _ in a.nearest(np.arange(8000), x, np.arange(60), queries, 20, longest, 0.15):
            wanted = brute(np.arange(8000), x, own, x[own], 3)[0]  # so many are this block's share
            hits += len(set(wanted) & set(met.tolist()))
        assert sum(scored) / (60 * 8000) < most and hits / 180 >= at_least


def test_very_long_vectors_and_clashing_columns(spark):
    rows = [(i, [float((i * j) % 7 - 3) for j in range(1, 3001)], 1, "x") for i in range(1, 13)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, id int, vector string")
    got = a.search(frame, F.col("vec_id") == 5, 3).collect()
    wide = np.array([r[1] for r in rows])
    assert [r["id"] for r in sorted(got, key=lambda r: r["rank"])] == brute(np.arange(1, 13), wide, 5, wide[4], 3)[0]


def test_ties_copies_and_vectors_that_take_no_part(spark):
    rows = [(i, [1.0, 0.0]) for i in range(30)] + [(40, None), (45, []), (50, [0.0, 0.0]), (55, [float("nan"), 1.0])]
    rows += [(60, [float("inf"), 1.0]), (65, [None, 1.0]), (70, [1.0, 2.0, 3.0]), (None, [1.0, 0.0])]
    got = search(spark, rows, 4)
    assert {r["query_id"] for r in got} == {0, 5, 10, 15, 20, 25}
    assert [r["id"] for r in got if r["query_id"] == 0] == [1, 2, 3, 4]
    assert [r["id"] for r in got if r["query_id"] == 25] == [0, 1, 2, 3]
    few = search(spark, [(5, [1.0, 2.0]), (6, [2.0, 1.0])], 20)
    assert [(r["query_id"], r["rank"], r["id"], r["score"]) for r in few] == [(5, 1, 6, 4.0)]
    assert search(spark, []) == []
    twice = search(spark, [(5, [1.0, 0.0]), (5, [1.0, 0.0]), (7, [0.0, 1.0])], 3)
    assert [(r["query_id"], r["id"]) for r in twice] == [(5, 7)]


def test_depth_follows_from_the_angle():
    assert a.depth_for(1.0) == a.BITS and a.depth_for(-1.0) == 0
    assert a.depth_for(0.9) > a.depth_for(0.5) > a.depth_for(0.0)
