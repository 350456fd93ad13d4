from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_shared import docs, odd  # noqa: F401
from starloom.llm import lines as m

GOOD = "And thereby the good people of that town were glad."
BAD = "BUY!! NOW!! BUY!! BUY!! ### NOW!! BUY!!"


@pytest.fixture(scope="module")
def field():
    r = np.random.default_rng(1)
    texts, labels = [], []
    for i in range(80):
        label = int(r.random() < 0.6)
        own = [f"{GOOD} {w}." if label else f"{BAD} {w}!!" for w in r.integers(0, 99, 1 + i % 5)]
        texts.append("\n".join(own))
        labels.append(label)
    lines = m.describe(texts)
    return m.fit(lines, np.repeat(np.array(labels, float), lines.counts), 60)


def brute(field, lines):
    """Marginals and log likelihoods by all label sequences of every chain."""
    scores, at, marginals, logs = field.scores(lines), 0, [], []
    for n in lines.counts:
        own = scores[at : at + n]
        at += n
        ways = list(product((0, 1), repeat=int(n)))
        weight = np.array([sum(s for s, y in zip(own, way) if y) + sum(field.joint[a, b] for a, b in zip(way, way[1:])) for way in ways])
        total = np.logaddexp.reduce(weight)
        marginals += [np.exp(np.logaddexp.reduce(weight[[w[i] == 1 for w in ways]]) - total) for i in range(n)]
        logs.append(dict(zip(ways, weight - total)))
    return np.array(marginals), logs


def some_lines(field):
    return m.describe([f"{GOOD}\n{BAD}\n\n{GOOD}", BAD, "", f"{BAD}\n{BAD}\n{GOOD}\nx\n1 2 3", GOOD])


def test_marginals_equal_all_sequences(field):
    lines = some_lines(field)
    assert lines.counts.tolist() == [3, 1, 0, 5, 1]
    assert np.allclose(field.marginals(lines), brute(field, lines)[0], atol=1e-9)


def test_gradient_equals_differences(field):
    lines, labels = some_lines(field), np.array([1, 0, 1, 0, 0, 0, 1, 1, 0, 1.0])

    def likelihood():
        _, logs = brute(field, lines)
        edges = np.concatenate([[0], np.cumsum(lines.counts)])
        return sum(own[tuple(labels[a:b].astype(int))] for own, a, b in zip(logs, edges, edges[1:]))

    for p, g in zip((field.weights, field.ends, field.joint), field.gradient(lines, labels)):
        flat = p.reshape(-1)
        for i in range(0, len(flat), 17 if len(flat) > 20 else 1):
            kept = flat[i]
            flat[i] = kept + 1e-5
            up = likelihood()
            flat[i] = kept - 1e-5
            down = likelihood()
            flat[i] = kept
            assert abs((up - down) / 2e-5 - g.reshape(-1)[i]) < 1e-5


def test_scores_weigh_lines_by_length(field):
    alone = field.quality([GOOD, BAD])
    assert alone[0] > 0.9 and alone[1] < 0.1
    mixed = field.quality(["\n".join([GOOD] * 20 + [BAD] * 2), "\n".join([BAD] * 20 + [GOOD] * 2)])
    assert mixed[0] > 0.7 > mixed[1]
    lines = some_lines(field)
    own = field.marginals(lines)[:3]
    assert np.isclose(field.quality([f"{GOOD}\n{BAD}\n\n{GOOD}"])[0], (own * lines.chars[:3]).sum() / lines.chars[:3].sum())
    assert field.quality(["", " \n\t\n ", "\n"]).tolist() == [0, 0, 0]


def test_neighbours_count(field):
    between = m.describe([f"{GOOD}\nx\n{GOOD}", f"{BAD}\nx\n{BAD}"])
    good = field.marginals(between)
    assert good[1] > good[4]


def test_very_long_texts(field):
    got = field.quality(["\n".join([GOOD] * 30_000), "x" * 1_000_000, f"{BAD} " * 50_000])
    assert got[0] > 0.7 and ((0 <= got) & (got <= 1)).all() and got[2] < 0.1


def test_training_in_spark(docs, spark):
    rows = [(i, "\n".join([GOOD if i % 3 else BAD] * (1 + i % 4))) for i in range(60)] + [(100, None), (101, ""), (102, BAD)]
    known = [(i, int(i % 3 > 0)) for i in range(50)] + [(50, None), (51, 7), (102, 1), (102, 0), (1, 1), (100, 1), (101, 0)]
    frame = docs(*rows).withColumn("y", F.lit("other")).withColumn("quality", F.lit("x")).withColumn("score", F.lit(1))
    labels = spark.createDataFrame(known, "doc_id long, quality int").withColumn("text", F.lit("clash"))
    field = m.train(frame, labels)
    got = {r["doc_id"]: r["score"] for r in m.score(frame, field, ["doc_id"]).collect()}
    assert all((got[i] >= 0.7) == bool(i % 3) for i in range(60)) and got[100] == got[101] == 0
    again = m.train(frame.repartition(7), labels.repartition(3))
    assert np.array_equal(field.weights, again.weights)
    none = m.train(frame, labels.where("false"))
    assert {r["score"] for r in m.score(frame.where("doc_id < 60"), none, ["doc_id"]).collect()} == {0.5}
    assert not m.train(frame, labels, longest=0).weights.any()


def test_odd_rows_and_an_empty_table(odd, docs, field):
    got = m.score(odd, field, ["doc_id"]).collect()
    assert len(got) == 7 and [r["score"] for r in got if r["doc_id"] in (1, 2, 3)] == [0, 0, 0]
    assert m.score(docs(), field, ["doc_id"]).count() == 0
