"""Alignment against a plain version that tokenises every document by itself."""

import hashlib
import random
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm_shared import docs, odd  # noqa: F401
from starloom.llm import alignment as m

public_tokenizers = pytest.importorskip("public_tokenizers")
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
LETTERS = "abcxyzABC é́Éß'sтк漢1２ \t\n\x1c\u0085　!?😀ﬁİ\x00"


@pytest.fixture(scope="module")
def plain():
    """Groups of a text by the two libraries, offset by offset; None without tokens."""
    a, b, own = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B), m.aligner(A, B)
    a.encode_special_tokens = True

    def groups(text):
        if not text:
            return None
        whole = (" " + text).encode()
        sides = []
        for ids, parts in ((a.encode(" " + text, add_special_tokens=False).ids, own.a_bytes), (b.encode(text), own.b_bytes)):
            if b"".join(parts[i] for i in ids) != whole:
                return None
            at, ends = 0, []
            for i in ids:
                at += len(parts[i])
                ends.append((at, i))
            sides.append(ends)
        cuts = sorted({e for e, _ in sides[0]} & {e for e, _ in sides[1]})
        made = [([], []) for _ in cuts]
        for k, side in enumerate(sides):
            for end, i in side:
                made[bisect_left(cuts, end)][k].append(i)
        return made

    return groups


def expected(rows, plain):
    each = {i: plain(t) or [] for i, t in rows}
    linked = {i: Counter((x, y) for a, b in g for x in a for y in b) for i, g in each.items()}
    count = Counter(p for own in linked.values() for p in own)
    top = defaultdict(int)
    for (x, _), n in count.items():
        top[x] = max(top[x], n)
    made = {}
    for i, g in each.items():
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        own = linked[i]
        made[i] = {
            "n_a": sum(len(a) for a, _ in g),
            "n_b": sum(len(b) for _, b in g),
            "n_groups": len(g),
            "n_links": sum(own.values()),
            "n_best": sum(n for p, n in own.items() if count[p] == top[p[0]]),
            "count_sum": sum(n * count[p] for p, n in own.items()),
            "groups_sha256": hashlib.sha256(text.encode()).hexdigest() if g else "",
        }
    return made


def random_texts(n, seed):
    r = random.Random(seed)
    words = ["".join(r.choice(LETTERS) for _ in range(r.randint(0, 9))) for _ in range(60)]
    special = ["<|endoftext|>", "<s>", "</s>", "<unk>", "<0x41>", "a▁b"]
    return [" ".join(r.choice(words if r.random() < 0.97 else special) for _ in range(r.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("known", [0, 40, 1 << 20])
def test_documents_equal_the_plain_version(docs, plain, known, settings):
    texts = random_texts(60, 1)
    rows = [(i, t) for i, t in enumerate(texts + texts[:9] * 3 + [None, "", " ", "a▁b", "x " * 3000])]
    got = m.align(docs(*rows).repartition(5), A, B, known_pairs=known).collect()
    want = expected(rows, plain)
    assert len(got) == len(rows)
    for r in got:
        assert {k: r[k] for k in want[0]} == want[r["doc_id"]], r


def test_groups_of_very_long_and_wide_texts(plain, monkeypatch):
    r = random.Random(4)
    texts = ["x" * 20_000, " " * 20_000, "".join(r.choice("abc漢é") for _ in range(20_000)), "\n" * 999 + "ok"]
    for wide in (0, 3, m.WIDE):
        monkeypatch.setattr(m, "WIDE", wide)
        n_a, n_b, n_groups, n_links, digests, pairs, times = m.aligner(A, B).measure(texts)
        for i, text in enumerate(texts):
            want = expected([(0, text)], plain)[0]
            assert [n_a[i], n_b[i], n_groups[i], n_links[i], digests[i]] == [
                want[k] for k in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")
            ]
            assert np.frombuffer(times[i], "<i8").sum() == want["n_links"]
            assert (np.diff(np.frombuffer(pairs[i], "<i8")) > 0).all()


def test_a_hot_text_is_joined_in_shares(docs, plain, no_broadcast):
    rows = [(i, "the same text") for i in range(40)] + [(100, "another text"), (101, None)]
    want = expected(rows, plain)
    for r in m.align(docs(*rows), A, B).collect():
        assert {k: r[k] for k in want[0]} == want[r["doc_id"]]


def test_odd_rows_other_columns_and_an_empty_table(odd, docs):
    clashing = odd.withColumn("n", F.lit(7)).withColumn("digest", F.lit("x")).withColumn("pair", F.lit(1)).withColumn("n_a", F.lit(3))
    got = m.align(clashing, A, B).collect()
    assert len(got) == 7 and [r["groups_sha256"] for r in got if r["doc_id"] in (1, 2)] == ["", ""]
    assert len({tuple(r) for r in got if r["doc_id"] == 4}) == 1
    empty = m.align(docs(), A, B)
    assert empty.count() == 0 and empty.columns == got[0].__fields__


def test_counts_are_held_back_and_handed_on_in_parts(docs, plain, monkeypatch):
    rows = list(enumerate(random_texts(30, 7)))
    aligned = m.align_texts(docs(*rows), A, B)
    whole = {r["pair"]: (r["n"], r["best"]) for r in m.pair_counts(aligned).collect()}
    monkeypatch.setattr(m, "HELD_PAIRS", 10)
    batches = aligned.select("n", "pairs").toArrow().to_batches(max_chunksize=3)
    parts = Counter()
    for batch in m._pair_counts(iter(batches)):
        for pair, n in zip(*[batch.column(c).to_pylist() for c in ("pair", "n")]):
            parts[pair] += n
    assert parts == {p: n for p, (n, _) in whole.items()}
