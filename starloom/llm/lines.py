"""Document quality by a linear-chain conditional random field over lines.

Every line with a word is a place in a chain and is good or bad. A line's score for
good comes from its own features and those of the lines before and after it: shares of
letters, capitals, digits and symbols, words and distinct words, lengths, whether it
was there before. Each feature falls into one of a few fixed ranges, and every range
passed has a weight. A second set of weights joins the labels of neighbouring lines.
Forward and backward passes give each line's marginal, and a document's score is the
mean of them weighted by the lines' visible characters.

Weights are fitted in numpy by gradient ascent on the likelihood of whole chains, in
which a labelled document's lines carry its label. At most about ``TRAIN_DOCS`` labelled
documents are taken, by hash of their ids, and none of more than ``TRAIN_LINES`` lines.
What comes to the driver is one byte for each line and feature, no text.

Texts that are NULL, empty or without a word score 0. Labels other than 0 and 1 and ids
labelled both ways are not learned from; without any label every line is as likely good
as bad and every text with a word scores 0.5. Repeated and NULL ids are rows of their
own, extra columns are not read, and an empty table gives an empty result.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starloom.llm.tables import map_texts, ship, steps, texts_of
from starloom.operators.joins import fits_broadcast
from starloom.session import stage

TRAIN_DOCS, TRAIN_LINES = 4_000, 2_000
ROUNDS, RATE, DECAY = 150, 0.1, 0.02

# kinds of characters
UPPER, LETTER, DIGIT, SPACE, END, LOUD, BAR, SYMBOL, OTHER = range(9)
KINDS = 9


def _kind(c: str) -> int:
    if c in "!?":
        return LOUD
    if c in ".,;:'\"-()":
        return END
    if c == "|":
        return BAR
    if c.isspace():
        return SPACE
    what = unicodedata.category(c)
    if what == "Lu":
        return UPPER
    if what[0] in "LM":
        return LETTER
    if what[0] == "N":
        return DIGIT
    return SYMBOL if what[0] in "SP" else OTHER


_KIND = np.array([_kind(chr(c)) for c in range(1 << 16)], np.uint8)
_KIND[-1] = OTHER  # stands for everything beyond it

_SHARES = [0.0, 0.01, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.75, 0.95]
_COUNTS = [1.0, 2.0, 4.0, 8.0, 16.0, 32.0, 64.0, 128.0]
#: Feature and where its ranges begin; a value passes every edge below it.
FEATURES: dict[str, list[float]] = {
    "words": _COUNTS,
    "letters in a word": [2.0, 3.0, 4.0, 5.0, 6.0, 8.0, 12.0],
    "capitals of letters": _SHARES,
    "letters": [0.3, 0.5, 0.6, 0.7, 0.8, 0.85, 0.9, 0.95, 0.98],
    "digits": _SHARES,
    "loud marks": _SHARES,
    "bars": _SHARES,
    "symbols": _SHARES,
    "other characters": _SHARES,
    "distinct words": [0.05, 0.1, 0.2, 0.4, 0.6, 0.7, 0.8, 0.9, 0.99],
    "longest word": [4.0, 8.0, 12.0, 16.0, 24.0, 48.0],
    "ends a sentence": [0.5],
    "was there before": [0.5],
    "is the line before again": [0.5],
}
_EDGES = [np.array(e) for e in FEATURES.values()]
_FIRST = np.concatenate([[0], np.cumsum([len(e) for e in _EDGES])])
N_EDGES = int(_FIRST[-1])


@dataclass
class Lines:
    """Lines of some documents in a row: how many each has, their lengths and ranges."""

    counts: np.ndarray
    chars: np.ndarray
    ranges: np.ndarray


def describe(texts: list[str]) -> Lines:
    """Every line with a word, by features."""
    counts, lines, numbers = [], [], []
    for text in texts:
        before: set[str] = set()
        last, n = None, 0
        for line in text.split("\n"):
            words = line.split()
            if not words:
                continue
            n += 1
            lines.append(line)
            numbers.append((len(words), len(set(words)), max(map(len, words)), words[-1][-1] in ".!?:;", line in before, line == last))
            before.add(line)
            last = line
        counts.append(n)
    if not lines:
        return Lines(np.array(counts, np.int64), np.zeros(0), np.zeros((0, len(FEATURES)), np.uint8))
    size = np.array([len(x) for x in lines])
    codes = np.frombuffer("".join(lines).encode("utf-32-le"), "<u4")
    kinds = np.repeat(np.arange(len(lines)), size) * KINDS + _KIND[np.minimum(codes, len(_KIND) - 1)]
    kind = np.bincount(kinds, minlength=len(lines) * KINDS).reshape(-1, KINDS).astype(np.float64)
    words, distinct, longest, *flags = np.array(numbers, np.float64).T
    visible = kind.sum(1) - kind[:, SPACE]
    letters = kind[:, UPPER] + kind[:, LETTER]
    values = [
        words,
        letters / words,
        kind[:, UPPER] / np.maximum(letters, 1),
        letters / visible,
        *(kind[:, k] / visible for k in (DIGIT, LOUD, BAR, SYMBOL, OTHER)),
        distinct / words,
        longest,
        *flags,
    ]
    ranges = np.stack([np.searchsorted(e, v, "left") for e, v in zip(_EDGES, values)], 1).astype(np.uint8)
    return Lines(np.array(counts, np.int64), visible, ranges)


def _chains(counts: np.ndarray) -> list[np.ndarray]:
    """Per place in a chain the lines that stand there, longest chains first."""
    order = np.argsort(-counts, kind="stable")
    starts, sizes = (np.cumsum(counts) - counts)[order], counts[order]
    alive = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1 if len(sizes) else 1), "right")
    return [starts[:n] + t for t, n in enumerate(alive)]


def messages(scores: np.ndarray, places: list[np.ndarray], joint: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log odds for good from all lines up to each, and from all lines behind it.

    ``scores`` are the lines' own log odds; ``joint`` holds the weights of label pairs,
    bad first.
    """
    forward, backward = scores.copy(), np.zeros_like(scores)
    (bb, bg), (gb, gg) = joint
    for at, then in zip(places, places[1:]):
        a = forward[at[: len(then)]]
        forward[then] += np.logaddexp(a + gg, bg) - np.logaddexp(a + gb, bb)
    for at, then in zip(places[-2::-1], places[:0:-1]):
        b = scores[then] + backward[then]
        backward[at[: len(then)]] = np.logaddexp(b + gg, gb) - np.logaddexp(b + bg, bb)
    return forward, backward


def _good(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def _neighbours(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The line before and behind each, or the number of lines where there is none."""
    n = int(counts.sum())
    before, behind = np.arange(n) - 1, np.arange(n) + 1
    used = counts[counts > 0]
    first = np.cumsum(used) - used
    before[first] = n
    behind[first + used - 1] = n
    return before, behind


class Field:
    """Weights of ranges for a line, its predecessor and successor, and of label pairs."""

    def __init__(self) -> None:
        # of ranges passed, then one of every line, of those without predecessor and without successor
        self.weights = np.zeros((3, N_EDGES))
        self.ends = np.zeros(3)
        self.joint = np.zeros((2, 2))

    def scores(self, lines: Lines) -> np.ndarray:
        """Each line's own log odds."""
        before, behind = _neighbours(lines.counts)
        total = np.full(len(lines.ranges), self.ends[0])
        for k, near in enumerate((None, before, behind)):
            own = np.zeros(len(lines.ranges) + 1)
            for f in range(len(_EDGES)):
                passed = np.concatenate([[0.0], np.cumsum(self.weights[k, _FIRST[f] : _FIRST[f + 1]])])
                own[:-1] += passed[lines.ranges[:, f]]
            if near is None:
                total += own[:-1]
            else:
                own[-1] = self.ends[k]
                total += own[near]
        return total

    def marginals(self, lines: Lines) -> np.ndarray:
        """Probability that each line is good."""
        forward, backward = messages(self.scores(lines), _chains(lines.counts), self.joint)
        return _good(forward + backward)

    def quality(self, texts: list[str]) -> np.ndarray:
        """Scores of texts, lines weighted by their visible characters."""
        lines = describe(texts)
        of = np.repeat(np.arange(len(texts)), lines.counts)
        total = np.bincount(of, lines.chars, len(texts))
        good = np.bincount(of, lines.chars * self.marginals(lines), len(texts))
        return np.clip(good / np.maximum(total, 1), 0.0, 1.0)

    def gradient(self, lines: Lines, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the log likelihood of the lines' labels, for the three sets of weights."""
        before, behind = _neighbours(lines.counts)
        passed = _passed(lines.ranges)
        scores, places = self.scores(lines), _chains(lines.counts)
        forward, backward = messages(scores, places, self.joint)
        rest = labels - _good(forward + backward)
        weights, ends = np.empty_like(self.weights), np.array([rest.sum(), 0.0, 0.0])
        for k, near in enumerate((None, before, behind)):
            if near is None:
                weights[k] = rest @ passed
            else:
                there = near < len(rest)
                moved = np.zeros(len(rest))
                moved[near[there]] = rest[there]
                weights[k] = moved @ passed
                ends[k] = rest[~there].sum()
        at = np.flatnonzero(behind < len(rest))
        then = behind[at]
        odds = np.stack(
            [
                np.full(len(at), self.joint[0, 0]),
                self.joint[0, 1] + scores[then] + backward[then],
                self.joint[1, 0] + forward[at],
                self.joint[1, 1] + forward[at] + scores[then] + backward[then],
            ]
        )
        each = np.exp(odds - odds.max(0))
        expected = (each / each.sum(0)).sum(1).reshape(2, 2)
        met = np.bincount((2 * labels[at] + labels[then]).astype(int), minlength=4).reshape(2, 2)
        return weights, ends, met - expected


def _passed(ranges: np.ndarray) -> np.ndarray:
    """Lines by edges: whether the line's value is beyond the edge."""
    return np.concatenate([ranges[:, f, None] > np.arange(len(e)) for f, e in enumerate(_EDGES)], 1).astype(np.float64)


def fit(lines: Lines, labels: np.ndarray, rounds: int = ROUNDS) -> Field:
    """Weights by Adam on the mean log likelihood, with decay towards 0."""
    field = Field()
    if not len(labels):
        return field
    places = [field.weights, field.ends, field.joint]
    first, second = ([np.zeros_like(p) for p in places] for _ in range(2))
    for t in range(1, rounds + 1):
        for p, g, m, v in zip(places, field.gradient(lines, labels), first, second):
            g = g / len(labels) - DECAY * p / N_EDGES
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return field


def _ranges(longest: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Label and packed ranges of every document of at most so many lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch):
                lines = describe(texts_of(part))
                edges = np.concatenate([[0], np.cumsum(lines.counts)])
                rows = [lines.ranges[a:b].tobytes() if 0 < b - a <= longest else None for a, b in zip(edges, edges[1:])]
                made = pa.RecordBatch.from_arrays([part.column("y"), pa.array(rows, pa.binary())], ["y", "ranges"])
                yield made.filter(made.column("ranges").is_valid())

    return run


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    most: int = TRAIN_DOCS,
    longest: int = TRAIN_LINES,
) -> Field:
    """Fit on about ``most`` labelled documents of at most ``longest`` lines, chosen by hash of their ids."""
    ship(docs.sparkSession)
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("y IN (0, 1)")
    known = known.groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("__other")).where("y = __other").drop("__other")
    n = known.count()
    share = min(1.0, most / max(n, 1))
    chosen = stage(known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20))), "labels")
    # a few thousand rows, so that the texts need not be shuffled to meet them
    chosen = F.broadcast(chosen) if fits_broadcast(chosen) else chosen
    text = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where("text IS NOT NULL")
    rows = text.join(chosen, "doc_id").select("text", "y").mapInArrow(_ranges(longest), "y int, ranges binary").toArrow().to_pylist()
    rows.sort(key=lambda r: (r["y"], r["ranges"]))
    each = [np.frombuffer(r["ranges"], np.uint8).reshape(-1, len(FEATURES)) for r in rows]
    counts = np.array([len(x) for x in each], np.int64)
    lines = Lines(counts, np.zeros(0), np.concatenate([np.zeros((0, len(FEATURES)), np.uint8), *each]))
    return fit(lines, np.repeat(np.array([r["y"] for r in rows], np.float64), counts))


def score(docs: DataFrame, field: Field, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` with every text's score, one pass and no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def make():
        return lambda texts: [shared.value.quality(texts)]

    return map_texts(docs, make, "score double", keep, text_col)
