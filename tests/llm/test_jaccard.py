import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from llm_shared import docs, odd  # noqa: F401
from starloom.llm import jaccard as j
from starloom.llm.components import components

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return frozenset(zip(*[words[i:] for i in range(size)])) if len(words) >= size else frozenset([tuple(words)] if words else [])


def brute(rows, size=4, percent=85):
    parent = {i: i for i, _ in rows if i is not None}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    sets = [(i, shingles(t, size)) for i, t in rows if i is not None]
    for n, (a, x) in enumerate(sets):
        for b, y in sets[:n]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {i: find(i) for i in parent}


def check(docs, rows, size=4, percent=85):
    got = j.near_duplicates(docs(*rows), size=size, percent=percent).collect()
    assert len(got) == len(rows)
    want = brute(rows, size, percent)
    assert all(r["component_id"] == want[r["doc_id"]] for r in got if r["doc_id"] is not None)
    assert {r["doc_id"] for r in got if r["doc_id"] is not None} == set(want)
    sizes = sorted((r["doc_id"] or -1, r["n_shingles"]) for r in got)
    assert sizes == sorted((i if i is not None else -1, len(shingles(t, size))) for i, t in rows)


@pytest.mark.parametrize("seed, size, percent", [(1, 4, 85), (2, 4, 85), (3, 5, 80)])
def test_components_equal_brute_force(docs, seed, size, percent):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = []
    for group in range(12):
        base = [r.choice(vocabulary) for _ in range(r.choice([4, 6, 7, 12, 40, 90]))]
        for _ in range(r.randint(1, 8)):
            words = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2])):
                words[r.randrange(len(words))] = r.choice(vocabulary)
            if r.random() < 0.3:
                words += words[: r.randint(0, 5)]
            rows.append((len(rows) * 7 % 1000 + 5, " ".join(words).upper() if r.random() < 0.2 else "\n".join(words)))
    check(docs, rows, size, percent)


def test_rows_of_one_id_are_one_node(docs):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    check(docs, [(1, a), (2, a), (2, b), (3, b + " more")])
    # the least id of two sets, copies of one row, small sets, a chain through ids
    check(docs, [(1, a), (1, b), (1, b), (5, a + " x"), (6, b + " x"), (7, c), (7, "few words"), (8, "few words"), (8, d), (9, d)])


def test_one_id_held_by_many_rows(docs):
    texts = [" ".join(f"t{k}w{i}" for i in range(20)) for k in range(15)]
    check(docs, [(50, t) for t in texts] * 3 + [(60, texts[3]), (61, texts[9] + " end"), (62, "something else here now")])


def test_cells_never_bound_too_low():
    r = np.random.default_rng(5)
    for _ in range(200):
        n, m, both = (int(x) for x in r.integers(1, 400, 3))
        shared, own, other = (np.unique(r.integers(0, 2**63, k).astype(np.uint64) << np.uint64(1)) for k in (both, n, m))
        x, y = np.union1d(shared, own), np.union1d(shared, other)
        bound = j.most_shared(j.cells(x), j.cells(y))
        assert len(np.intersect1d(x, y)) <= bound <= min(len(x), len(y))
    # very many hashes with one beginning: more bits, no count beyond a byte
    close = np.arange(70_000, dtype=np.uint64) << np.uint64(40)
    assert j.cells(close).sum() == 70_000 and j.most_shared(j.cells(close), j.cells(close[:9])) == 9


def test_a_chain_of_copies_is_one_component(docs):
    r = random.Random(3)
    words = [f"c{i}" for i in range(80)]
    rows = []
    for i in range(25):
        words[r.randrange(80)] = f"new{i}"
        rows.append((100 - i, " ".join(words)))
    check(docs, rows)


@pytest.mark.parametrize("more, copies", [(5, 1), (10, 1), (13, 1), (15, 1), (10, 10)])
def test_unseen_words_in_one_copy(docs, more, copies):
    r = random.Random(more)
    rows = []
    for group in range(6):
        words = [f"g{group}w{i}" for i in range(93)]
        at = r.choice([0, 40, 93])
        longer = words[:at] + [f"only{group}x{i}" for i in range(more)] + words[at:]
        # with more copies, each with an end of its own, no shared shingle is rare
        for copy in range(copies):
            end = [f"end{group}y{copy}"] if copies > 1 else []
            rows += [(len(rows) + n, " ".join(text + end)) for n, text in enumerate([words, longer], 1)]
    check(docs, rows)


def test_odd_rows(docs, odd):
    rows = [(1, None), (2, ""), (3, " \t "), (4, "x"), (5, "X"), (6, "a b c"), (7, "a b  C"), (8, "É a b"), (9, "é a b"), (10, "a\x1cb c"), (11, "a b\x1c c")]
    check(docs, rows)
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in j.near_duplicates(odd).collect()}
    assert (None, 1, None) in got and (1, 0, 1) in got and (4, 1, 4) in got
    assert j.near_duplicates(docs()).count() == 0


def test_keep_one_of_each_group(docs):
    long = " ".join(f"w{i}" for i in range(40))
    rows = docs((9, long), (3, long), (3, long), (5, long + " w0"), (7, "alone"), (None, "alone"), (None, long))
    kept = j.keep_one(rows)
    assert kept.columns == rows.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 0, 3, 7]


def test_keep_one_judges_rows_of_one_id_by_their_texts(docs):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = docs((1, a), (2, a), (2, b), (2, b), (3, b + " more"), (4, c), (4, c.upper()), (5, None), (5, ""), (5, c))
    kept = sorted((r["doc_id"], (r["text"] or "")[:2]) for r in j.keep_one(rows, size=5, percent=80).collect())
    assert kept[:2] == [(1, "a0"), (2, "b0")] and len(kept) == 4
    assert kept[2][0] == 4 and kept[2][1].lower() == "c0" and kept[3] == (5, "")
    assert j.keep_one(docs()).count() == 0


def test_prefixes_share_what_the_lemma_says():
    r = np.random.default_rng(4)
    for _ in range(300):
        n = int(r.integers(6, 60))
        base = r.choice(10_000, n, replace=False)
        other = base.copy()
        other[: int(r.integers(0, 4))] = r.integers(20_000, 30_000, 1)
        x, y = np.unique(base), np.unique(other)
        inter = len(np.intersect1d(x, y))
        if not j.similar(inter, len(x), len(y)):
            continue
        for level in range(1, min(j.MAX_LEVEL, j.needed(len(x)), j.needed(len(y))) + 1):
            a = x[: len(x) - j.needed(len(x)) + level]
            b = y[: len(y) - j.needed(len(y)) + level]
            assert len(np.intersect1d(a, b)) >= level


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 140)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_the_order_comes_from_all_documents(spark):
    """Before, words and shingles were counted on a sample of 2,000 documents or an eighth."""
    texts = spark.range(5000).selectExpr("id AS doc_id", "concat('all ', IF(id % 2 = 0, 'even', 'odd ODD'), ' w', id) AS text")
    order = j.order_of(texts)
    found = dict(zip(order.words.tolist(), order.weight.tolist()))
    hashes = j.word_hashes("all even odd").tolist()
    assert [round(2 ** found[h]) for h in hashes] == [5000, 2500, 5000]
    assert len(found) == 3


def test_shingles_that_many_documents_hold_come_last(spark):
    """Before, only words were counted, so a passage of seldom words was in all its texts' prefixes."""
    passage = " ".join(f"p{i}" for i in range(12))
    rows = [(d, " ".join(f"d{d}x{i}" if i % 2 else f"w{i % 10}" for i in range(40)) + " " + passage) for d in range(60)]
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    order = j.order_of(texts)
    shared = j.shingle_hashes(j.word_hashes(passage))
    assert np.isin(shared, order.shingles).all() and len(order.shingles) == len(shared)
    got = order.tokens(j.word_hashes(rows[0][1])).view(np.uint64) & np.uint64((1 << 56) - 1)
    assert set(got[-len(shared) :]) == set(shared >> np.uint64(8))


def test_texts_that_share_a_passage_make_few_pairs(docs, monkeypatch):
    """Before, all 120 texts with one passage met in 7,140 candidate pairs."""
    found = []
    real = j._cross_pairs

    def cross(*args):
        pairs = real(*args)
        found.append(pairs.count())
        return pairs

    monkeypatch.setattr(j, "_cross_pairs", cross)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(d, passage + " " + " ".join(f"w{(d * 7 + i * i) % 50} the{d * 40 + i}" for i in range(20))) for d in range(1, 121)]
    check(docs, rows)
    assert found == [0]


def counted(rows, size=4):
    """Sums of what one task counts, and the most rows that it passes on at once."""
    batch = pa.RecordBatch.from_arrays([pa.array(rows, pa.string())], ["text"])
    found, most = Counter(), 0
    for made in j._counts(size)(iter([batch])):
        most = max(most, made.num_rows)
        for whole, key, n in zip(*[c.to_pylist() for c in made.columns]):
            found[whole, key] += n
    return found, most


def test_counts_of_a_task():
    rows = ["a b c d e", "a b c d e f", "A b  c d", "", None, "x"]
    words, sets = Counter(), Counter()
    for text in rows:
        hashes = j.word_hashes(text or "")
        words.update((False, k) for k in hashes.view(np.int64).tolist())
        sets.update((True, k) for k in set(j.shingle_hashes(hashes).view(np.int64).tolist()))
    assert counted(rows)[0] == words + Counter({k: n for k, n in sets.items() if n > 1})
    assert counted([None, ""])[0] == Counter() and counted([])[0] == Counter()


def test_counts_are_passed_on_bit_by_bit(monkeypatch):
    rows = [" ".join(f"w{i % 3}x{k}" for k in range(i, i + 40)) for i in range(60)]
    whole, _ = counted(rows)
    monkeypatch.setattr(j, "COUNTS_AT_ONCE", 7)
    assert counted(rows) == (whole, 7)


def test_memory_of_a_task_that_counts():
    rows = [" ".join(f"{i}x{k}" for k in range(2_000)) for i in range(450)]
    batch = pa.RecordBatch.from_arrays([pa.array(rows, pa.string())], ["text"])
    tracemalloc.start()
    try:
        n = sum(made.num_rows for made in j._counts(4)(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    # the hashes of words and shingles are 14 MB
    assert n == 900_000 and peak < 40e6
