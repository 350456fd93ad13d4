import math
from collections import Counter, defaultdict

import numpy as np

from llm_shared import docs, odd  # noqa: F401
from starloom.llm import language as g

TEXTS = {
    "en": ["the cat sat on the mat with the other cats", "this is the thing that they have"],
    "de": ["die katze sitzt auf der matte und schläft", "das ist nicht die sache von der ich spreche"],
}


def model():
    counts = {}
    for lang, texts in TEXTS.items():
        grams = np.concatenate([g._grams(g._bytes_of(t), g.ORDER + 1) for t in texts])
        counts[lang] = np.unique(grams, return_counts=True)
    return g.build(counts)


def brute(lang, text):
    seen = [defaultdict(Counter) for _ in range(g.ORDER + 1)]
    for t in TEXTS[lang]:
        b = bytes(g._bytes_of(t))
        for i in range(g.ORDER, len(b)):
            for k in range(g.ORDER + 1):
                seen[k][b[i - k : i]][b[i]] += 1
    b, bits = bytes(g._bytes_of(text)), 0.0
    for i in range(g.ORDER, len(b)):
        for k in range(g.ORDER, -2, -1):
            if k < 0:
                bits += 8
                break
            followers = seen[k].get(b[i - k : i])
            if followers is None:
                continue
            total = sum(followers.values()) + len(followers)
            if b[i] in followers:
                bits -= math.log2(followers[b[i]] / total)
                break
            bits -= math.log2(len(followers) / total)
    return bits


def test_code_lengths_equal_brute_force():
    m = model()
    for text in ["the katze", "", "漢字 Ünïcode!", "x" * 50, "die the DIE"]:
        got = m.lengths([text, "other", text])
        assert np.allclose(got[0], [brute(x, text) for x in m.languages], rtol=1e-5)
        assert np.array_equal(got[0], got[2])


def test_prediction():
    names, score = model().predict(["the cat", "die katze", "123 !", ""])
    assert names == ["en", "de", "und", "und"]
    assert score[0] > 0.5 and score[2] == score[3] == 0 and (score <= 1).all()


def test_training_and_identifying(docs, odd):
    rows = [(i, TEXTS[x][i % 2], x) for i, x in enumerate(["en", "de"] * 4)]
    rows = [(a, b, c, "s") for a, b, c in rows] + [(99, "no label", None, "s"), (98, None, "en", "s")]
    m = g.train(docs(*rows))
    assert m.languages == ["de", "en"]
    got = g.identify(docs(*rows), m, ["doc_id"]).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in got if r["doc_id"] < 8} == {i: ["en", "de"][i % 2] for i in range(8)}
    assert g.identify(odd, m, ["doc_id"]).count() == 7
    nothing = g.train(docs())
    assert [r["lang_pred"] for r in g.identify(docs((1, "abc")), nothing, ["doc_id"]).collect()] == ["und"]
    assert g.identify(docs(), m, ["doc_id"]).count() == 0


def test_table_finds_what_it_holds():
    r = np.random.default_rng(1)
    keys = np.unique(r.integers(0, 2**63, 5000).astype(np.uint64))
    t = g.Table(keys[::2], np.arange(len(keys[::2]), dtype=np.float32)[:, None])
    assert (t.rows[t.find(keys[::2]), 0] == np.arange(len(keys[::2]))).all()
    assert (t.find(keys[1::2]) == 0).all()
