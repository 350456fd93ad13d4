import hashlib
import random
import re

from pyspark.sql import functions as F

from llm_shared import docs, odd  # noqa: F401
from starloom.llm import secrets as s

BASE = {
    "assign": (
        re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A),
        1,
        12,
    ),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 16),
}


def owners():
    return F.col("source"), F.concat_ws("/", "source", "lang")


def brute(text):
    found = []
    for n, (kind, (pattern, group, least)) in enumerate(BASE.items()):
        for m in pattern.finditer(text or ""):
            if len(m.group(group)) >= least:
                found.append((m.start(), n, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x for _, _, x in sorted(found))


def test_base_spans_equal_brute_force(docs):
    r = random.Random(5)
    pieces = ["password", "Token", "API_KEY", "apikey", " = ", ":", '"', "'", "AKIA", "ABCDEFGH12345678", "0123456789abcdef",
              "deadbeef", " ", "é", "漢😀", "\n", "abcDEF+/_.=-1", "zz", "AKIAAKIA", "token=token: "]
    texts = ["".join(r.choice(pieces) for _ in range(r.randint(0, 25))) for _ in range(400)]
    texts += ["token: password = abcdefghijklmnop", "secret=" + "a" * 5000, " ".join(["0123456789abcdef0"] * 1500), None, ""]
    got = {x["doc_id"]: x for x in s.scan(docs(*enumerate(texts)), *owners()).collect()}
    for i, text in enumerate(texts):
        spans = brute(text)
        assert got[i]["base_sha256"] == hashlib.sha256(spans.encode()).hexdigest(), (text, spans, got[i]["spans"])
        kept = [x for x in got[i]["spans"].split(",") if x.split(":")[0] in BASE]
        assert ",".join(kept) == spans
        assert [got[i][f"n_{k}"] for k in BASE] == [spans.count(k + ":") for k in BASE]


KEY, SHARED = "ghp_A1b2C3d4E5f6G7h8I9j0K1l2M3n4", "ghp_ExampleExample1234567890abcdEFG"


def test_ownership_tells_examples_from_live_keys(docs):
    rows = [(1, f"use {KEY} here", "en", "a"), (2, f"again {KEY}", "en", "a")]
    rows += [(10 + i, f"copy {SHARED} me", "en", f"owner{i}") for i in range(4)]
    got = {x["doc_id"]: x for x in s.scan(docs(*rows), *owners()).collect()}
    assert got[1]["spans"].split(",")[0] == f"prefixed:4:{4 + len(KEY)}" and got[1]["n_live"] > 0
    assert got[10]["spans"] == "" and got[10]["n_copied"] > 0 and got[10]["n_live"] == 0
    clean = {x["doc_id"]: x["text"] for x in s.redact(docs(*rows), *owners()).collect()}
    assert clean[1] == "use [SECRET] here" and clean[10] == f"copy {SHARED} me"


def test_redaction_leaves_other_rows_alone(docs, odd):
    rows = docs((None, "password=0123456789abcdef01"), (1, "token: 'abcdefghijklmn' é 0123456789abcdef"), (2, "fine"), (3, None))
    got = sorted((x["doc_id"] or 0, x["text"]) for x in s.redact(rows, *owners()).collect())
    assert [t for _, t in got] == ["[SECRET]", "[SECRET]' é [SECRET]", "fine", None]
    assert s.redact(odd, *owners()).count() == 7
    assert s.redact(rows, *owners()).columns == rows.columns


def test_odd_rows_and_an_empty_table(odd, docs):
    assert s.scan(odd, *owners()).count() == 7
    assert s.scan(docs(), *owners()).count() == 0
    assert s.redact(docs(), *owners()).count() == 0


def test_running_totals_of_long_arrays(spark):
    df = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(5000)), lambda x: x.cast("long")).alias("v"))
    got = df.select(s._running(F.col("v")).alias("t")).collect()[0]["t"]
    assert got == [i * (i + 1) // 2 for i in range(1, 5001)]
