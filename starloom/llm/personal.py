"""Personal data: patterns propose spans, checksums confirm them, context scores them.

The base kinds are always reported as they match. The wider kinds are reported if
their score, raised by a checksum that holds and by tell-tale words close by,
reaches a threshold. Positions are code points, ends exclusive.

NULL texts count as empty. Each row stands for itself, so repeated or NULL ids and
ties change nothing; an empty table gives an empty result. Only id and text are
read. All patterns take time linear in the text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame

from starloom.llm.tables import map_texts, texts

BASE = ("email", "ip", "card", "phone")
WIDER = ("iban", "ssn", "birth")
#: A wider span is reported from this score on.
THRESHOLD = 0.6
CONTEXT_CHARS, CONTEXT_BONUS = 40, 0.3

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# no match can begin inside a run of digits, so only the first digit of a run is tried
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]{3}")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_IBAN = re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_BIRTH = re.compile(r"(?<![0-9])(?:19|20)[0-9]{2}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12][0-9]|3[01])(?![0-9])")
_WORDS = {
    "iban": re.compile(r"(?i)\b(?:iban|account|bank|konto|cuenta|compte)\b"),
    "ssn": re.compile(r"(?i)\b(?:ssn|social|security|tax)\b"),
    "birth": re.compile(r"(?i)\b(?:born|birth|dob|geboren|nacid[oa]|n[ée]e?)\b"),
}
#: What a pattern alone is worth, before checksum and context.
_START = {"iban": 0.3, "ssn": 0.4, "birth": 0.2}


def luhn(digits: str) -> bool:
    doubled = (2 * int(d) if i % 2 else int(d) for i, d in enumerate(reversed(digits)))
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def mod_97(iban: str) -> bool:
    """Letters count from A = 10; the whole number leaves 1 modulo 97."""
    text = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches end a run of local characters at an @, so each @ is looked at once."""
    begin, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > begin and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            yield start, domain.end()
            begin = domain.end()
        at = text.find("@", max(at + 1, begin))


def ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        # int() of a very long number is slow, and such a part is too large anyway
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            yield m.span()


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 8 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
            yield m.span()


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans of the base kinds."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in BASE}
    if "@" in text:
        found["email"] = list(emails(text))
    if _DIGITS.search(text) or "." in text:
        found["ip"] = list(ips(text))
    if _DIGITS.search(text) or " " in text or "-" in text:
        found["card"] = list(cards(text))
    if "+" in text:
        found["phone"] = list(phones(text))
    return found


def scored_spans(text: str) -> dict[str, list[tuple[int, int, float]]]:
    """Proposed spans of the wider kinds with their scores."""
    found: dict[str, list[tuple[int, int, float]]] = {k: [] for k in WIDER}
    if not _DIGITS.search(text) and "-" not in text:
        return found
    for kind, pattern in (("iban", _IBAN), ("ssn", _SSN), ("birth", _BIRTH)):
        for m in pattern.finditer(text):
            score = _START[kind]
            if kind == "iban":
                score = score + 0.5 if mod_97(m.group()) else 0.0
            near = text[max(0, m.start() - CONTEXT_CHARS) : m.start()], text[m.end() : m.end() + CONTEXT_CHARS]
            if any(_WORDS[kind].search(x) for x in near):
                score += CONTEXT_BONUS if kind != "birth" else 2 * CONTEXT_BONUS
            found[kind].append((*m.span(), min(1.0, score)))
    return found


def spans_of(text: str) -> tuple[dict[str, list[tuple[int, int]]], dict[str, list[tuple[int, int]]]]:
    """Base spans, and the wider spans that reach the threshold."""
    wider = {k: [(a, b) for a, b, score in v if score >= THRESHOLD] for k, v in scored_spans(text).items()}
    return base_spans(text), wider


def _joined(spans: dict[str, list[tuple[int, int]]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, found in spans.items() for a, b in found)


def _columns(texts_: list[str]) -> list:
    rows = []
    for text in texts_:
        base, wider = spans_of(text)
        listed = _joined(base)
        digest = hashlib.sha256(listed.encode()).hexdigest()
        counts = [len(base[k]) for k in BASE]
        rows.append((*counts, digest, _joined({**base, **wider}), sum(map(len, wider.values()))))
    return list(zip(*rows))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Personal data of every document, one pass and no shuffle."""
    counts = ", ".join(f"n_{k} long" for k in BASE)
    added = f"{counts}, base_sha256 string, spans string, n_wider long"
    return map_texts(texts(docs, id_col, text_col), lambda: _columns, added, ["doc_id"])
