import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from llm_shared import docs, odd  # noqa: F401
from starloom.llm import tables, toxicity as t

PLAIN = [f"some plain words number {i} about the weather and other things we like" for i in range(60)]
BAD = [p + f" you utter {w}" for p, w in zip(PLAIN, ["moronic", "moronish", "moronly"] * 20)]


@pytest.fixture(scope="module")
def network():
    return t.fit(PLAIN + BAD, [0] * 60 + [1] * 60)


def test_gradients_equal_differences():
    net = t.Network.new(1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    buckets, at, mask = t._encode([["hello", "you", "x"], ["a", "bb", "ccc", "dd", "e"]])
    y = np.array([1.0, 0.0])

    def loss():
        _, logit = net.gradients(buckets, at, mask, y)
        return float(np.mean(np.logaddexp(0, logit) - y * logit))

    g, _ = net.gradients(buckets, at, mask, y)
    for name, value in net.p.items():
        i = np.unravel_index(np.abs(g[name]).argmax(), g[name].shape)
        old, e = value[i], 1e-3
        value[i] = old + e
        up = loss()
        value[i] = old - e
        down = loss()
        value[i] = old
        assert abs(g[name][i] - (up - down) / 2 / e) < 1e-5


def test_every_word_is_in_a_window_and_windows_overlap():
    for n in [1, t.WINDOW, t.WINDOW + 1, 100, 1001]:
        starts = t.window_starts(n)
        covered = {i for s in starts for i in range(s, min(n, s + t.WINDOW))}
        assert covered == set(range(n)) and t.STRIDE < t.WINDOW
        assert all(b - a < t.WINDOW for a, b in zip(starts, starts[1:]))


def test_it_learns_and_knows_families_of_words(network):
    assert (network.scores(BAD) >= 0.5).all() and (network.scores(PLAIN) < 0.5).all()
    deep = " ".join(PLAIN) + " moronish " + " ".join(PLAIN)
    assert network.scores([deep, " ".join(PLAIN)]).round().tolist() == [1, 0]


def test_scores_do_not_depend_on_the_batch(network):
    some = [*BAD[:3], "", *PLAIN[:3], "x" * 500]
    one = np.concatenate([network.scores([x]) for x in some])
    assert np.allclose(network.scores(some), one, atol=1e-4) and one[3] == 0


def test_words_past_the_kept_ones_score_the_same(network, monkeypatch):
    some = [*BAD[:9], "", *PLAIN[:9]]
    network.forget()
    expected = [network.scores([x])[0] for x in some]
    monkeypatch.setattr(t, "KEPT_WORDS", 20)
    network.forget()
    assert np.allclose([network.scores([x])[0] for x in some], expected, atol=1e-4) and 0 < len(network.rows) <= 20
    network.forget()


def test_kept_inputs_are_not_copied_for_new_words(monkeypatch):
    monkeypatch.setattr(t, "KEPT_WORDS", 200_000)
    net = t.Network.new()
    net.inputs = np.zeros((t.KEPT_WORDS + 1, 6 * t.HIDDEN), np.float32)
    net.rows = {f"kept{i}": i + 1 for i in range(t.KEPT_WORDS)}
    tracemalloc.start()
    try:
        logit, _, _ = net.window_logits([f"kept0 new{i} kept{i}" for i in range(20)])
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(logit) == 20 and peak < net.inputs.nbytes / 4


def test_batches_of_long_texts_are_bounded_by_bytes(spark, docs, network):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    frame = docs(*[(i, "ab " * 400_000) for i in range(12)]).coalesce(1).select("text")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    try:
        spark.conf.unset(key)
        t.score(frame, network, [])
        most = max(r["n"] for r in frame.mapInArrow(sizes, "n long").collect())
        assert most < tables.BATCH_BYTES + 2 * 1_200_000
        spark.conf.set(key, "100m")
        t.score(frame, network, [])
        assert spark.conf.get(key) == "100m"
    finally:
        spark.conf.set(key, before) if before else spark.conf.unset(key)


def test_labels_of_one_kind_teach_nothing():
    assert (t.fit(PLAIN, [0] * 60).scores(["you moron", ""]) == 0).all()


def test_training_and_scoring_frames(spark, docs, odd, network):
    rows = [(i, x) for i, x in enumerate(PLAIN + BAD)] + [(900, None)]
    labels = spark.createDataFrame([(i, int(i >= 60)) for i in range(120)] + [(900, 1), (901, None)], "doc_id long, toxic int")
    made = t.train(docs(*rows), labels)
    got = {r["doc_id"]: r["score"] for r in t.score(docs(*rows), made, ["doc_id"]).collect()}
    assert sum((got[i] >= 0.5) == (i >= 60) for i in range(120)) >= 117 and got[900] == 0
    assert t.score(odd, network, ["doc_id"]).count() == 7
    assert t.score(docs(), network, ["doc_id"]).count() == 0
