import re
from collections import Counter

from hypothesis import given, settings, strategies as st

from llm_shared import docs, odd  # noqa: F401
from starloom.llm import quality as q
from pyspark.sql import functions as F

LETTERS = "abcdefghijklmnopqrstuvwxyz"
GOOD = " ".join(f"word{a}{b}" for a in LETTERS[:8] for b in LETTERS[:8]) + "."
SHOUT = " ".join(f"WORD{a}{b}!!".upper() for a in LETTERS[:8] for b in LETTERS[8:16])
SIGNS = " ".join(f"ab{a}{b}###" for a in LETTERS[:8] for b in LETTERS[8:16])
AGAIN = "spam " * 90


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if seen[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(covered),
    )


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def check(docs, texts):
    got = q.features(docs(*enumerate(texts))).orderBy("doc_id").collect()
    assert [tuple(r[c] for c in COUNTS) for r in got] == [brute(t) for t in texts]
    for r in got:
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed


def test_counts_equal_brute_force(docs):
    check(docs, [None, "", " \n\t", "a b c a b c d", "a a a a", "x\ny\nx\n \n \nx", "é# 漢|字 \x0b b", "\x1ca \x1ca \x1ca b", AGAIN, SHOUT, "a\r\nb\r\na\r\nb"])


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\t#é\x1c ", max_size=40), min_size=1, max_size=20))
def test_counts_of_any_text(spark, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    check(lambda *_: rows, texts)


def test_rules_that_agree_are_believed(docs):
    rows = [(i, GOOD + " and more") for i in range(60)] + [(100 + i, SHOUT + str(i)) for i in range(5)]
    rows += [(200 + i, SIGNS + str(i)) for i in range(5)] + [(300, AGAIN), (301, "short")]
    kept = {r["doc_id"]: r for r in q.judge(docs(*rows)).collect()}
    assert all(kept[i]["kept"] for i in range(60))
    assert not any(r["kept"] for i, r in kept.items() if i >= 100)
    assert kept[100]["posterior"] < 0.5 < kept[0]["posterior"]


def test_em_finds_the_accuracy_of_rules():
    names = ["a", "b", "c", "d"]
    # a and b agree on what is bad; c is mostly alone, and d speaks for what it blames
    patterns = [
        ({"a": 0, "b": 0, "c": 0, "d": 1}, 900),
        ({"a": -1, "b": -1, "c": 0, "d": 0}, 60),
        ({"a": -1, "b": -1, "c": -1, "d": 0}, 5),
        ({"a": 0, "b": 0, "c": -1, "d": 1}, 35),
    ]
    model = q.fit(patterns, names)
    assert model.accuracy["a"] >= q.ACCURACY[0] and model.accuracy["b"] >= q.ACCURACY[0]
    assert model.accuracy["c"] == q.ACCURACY[0] < model.accuracy["d"]
    sure = {"a": -1, "b": -1, "c": 0, "d": 0}
    assert model.log_odds(sure) < 0 < model.log_odds({"a": 0, "b": 0, "c": -1, "d": 1})


def test_variety_votes_alike_at_every_length(docs):
    """Few words over and over in ever new order, and text whose words go on growing."""
    rule = next(r for r in q.RULES if r.name == "variety")
    dull = [" ".join(LETTERS[(i * i + i // 7) % 20] for i in range(n)) for n in (80, 4_990, 5_010, 40_000)]
    rich = [" ".join(f"w{i % int(3 * n ** 0.8)}" for i in range(n)) for n in (80, 4_990, 5_010, 40_000)]
    rows = q.features(docs(*enumerate(dull + rich))).withColumn("vote", rule.vote())
    assert [r["vote"] for r in rows.orderBy("doc_id").collect()] == [q.BAD] * 4 + [q.ABSTAIN] * 4


def test_odd_rows_and_an_empty_table(odd, docs):
    got = q.judge(odd).collect()
    assert len(got) == 7 and not any(r["kept"] for r in got)
    assert q.judge(docs()).count() == 0
    assert q.keep(docs()).count() == 0 and q.keep(odd).count() == 0


def test_keep_returns_the_rows_as_they_were(docs):
    rows = docs((1, GOOD), (2, AGAIN), (None, GOOD + " more"), (None, AGAIN))
    kept = q.keep(rows)
    assert kept.columns == rows.columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect()) == [(0, GOOD + " more"), (1, GOOD)]


def test_extra_columns_of_clashing_names(docs):
    rows = docs((1, GOOD)).withColumns({"words": F.lit(1), "n_words": F.lit("x"), "kept": F.lit(0)})
    assert q.judge(rows).collect()[0]["n_words"] == len(GOOD.split())


def test_no_python_in_the_plan(docs):
    from conftest import plan_of

    plan = plan_of(q.features(docs((1, GOOD))))
    assert "Python" not in plan and "Exchange" not in plan
