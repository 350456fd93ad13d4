import hashlib
import re

from hypothesis import given, settings, strategies as st

from llm_shared import docs, odd  # noqa: F401
from starloom.llm import personal as p

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(text):
    return re.sub(r"[^0-9]", "", text)


def brute(text):
    return {
        "email": [m.span() for m in EMAIL.finditer(text)],
        "ip": [m.span() for m in IP.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))],
        "card": [m.span() for m in CARD.finditer(text) if 16 <= len(digits(m.group())) <= 19 and p.luhn(digits(m.group()))],
        "phone": [m.span() for m in PHONE.finditer(text) if 8 <= len(digits(m.group())) <= 15],
    }


@settings(max_examples=2000, deadline=None)
@given(st.text(alphabet="ab@.-_ 12345670+()é%", max_size=60))
def test_base_spans_equal_the_patterns(text):
    assert p.base_spans(text) == brute(text)


def test_known_values():
    text = "card 4111 1111 1111 1111, not 4111 1111 1111 1112; 10.0.0.255 and 10.0.0.256; +1 (555) 010-9999"
    found = p.base_spans(text)
    assert found == brute(text)
    assert [len(v) for v in found.values()] == [0, 1, 1, 1]


def test_checksums_and_context_decide_on_wider_kinds():
    iban = "DE89 3704 0044 0532 0130 00"
    assert p.mod_97(iban) and not p.mod_97("DE88 3704 0044 0532 0130 00")
    assert p.spans_of(f"pay {iban} now")[1]["iban"] == [(4, 4 + len(iban))]
    assert p.spans_of("pay DE88 3704 0044 0532 0130 00 now")[1]["iban"] == []
    assert p.spans_of("ssn 123-45-6789")[1]["ssn"] == [(4, 15)]
    assert p.spans_of("part 123-45-6789")[1]["ssn"] == []
    assert p.spans_of("born 1999-02-03")[1]["birth"] == [(5, 15)]
    assert p.spans_of("on 1999-02-03")[1]["birth"] == []


def test_very_long_runs_take_linear_time():
    import time

    start = time.time()
    p.spans_of("a" * 1_000_000 + "@" + "1" * 500_000 + ".5 +2 " + "1 " * 300_000 + "@" * 200_000)
    assert time.time() - start < 20


def test_scan(docs, odd):
    texts = ["mail a.b@c.de and 1.2.3.4", None, "é x@y.zz", "DE89 3704 0044 0532 0130 00"]
    got = {r["doc_id"]: r for r in p.scan(docs(*enumerate(texts))).collect()}
    assert (got[0]["n_email"], got[0]["n_ip"]) == (1, 1)
    assert got[0]["spans"] == "email:5:13,ip:18:25"
    assert got[0]["base_sha256"] == hashlib.sha256(b"email:5:13,ip:18:25").hexdigest()
    assert got[2]["spans"] == "email:2:8"
    assert got[3]["spans"] == "iban:0:27" and got[3]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    ids = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in p.scan(odd).collect())
    assert ids == [(False, 1), (False, 2), (False, 3), (False, 4), (False, 4), (False, 5), (True, 0)]
    assert p.scan(docs()).count() == 0
    large = docs((2**62 + 1, "x"), (None, "y"))
    assert {r["doc_id"] for r in p.scan(large).collect()} == {2**62 + 1, None}
