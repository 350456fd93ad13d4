"""Alignment of two tokenizers over a corpus, each distinct text once.

Texts are grouped by their whole text, so copies meet in one row that knows how many
there are; the grouping counts before it shuffles, so a text that a third of all rows
hold is one row per task by then. Each distinct text is tokenised twice and aligned
once: byte offsets where a token of both ends cut both sequences into groups, and all
tokens of a group are linked. A pair's count is the number of documents that hold it
linked, copies weighing by their number. Measures go back to the documents by the
SHA-256 of their text.

The most frequent pairs (``KNOWN_PAIRS`` at most, by a cut-off on their count) are
broadcast, the others meet the texts that hold them in a join; results are the same
for any number of known pairs.

NULL and empty texts have no tokens, nor have texts that a tokenizer does not give
back byte for byte: zeros, and an empty string for the groups. Rows with equal or NULL
ids are documents each. Other columns are not read; an empty table gives an empty
result. A text is one row in memory, and a group's pairs are the product of its
distinct ids.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F, types as T

from starloom.llm.packing import byte_symbols, encoder
from starloom.llm.tables import map_texts, ship
from starloom.operators.joins import lookup
from starloom.session import stage

KNOWN_PAIRS = 1 << 20
#: Links of one group beyond which its distinct ids are multiplied instead.
WIDE = 1 << 16
#: Pairs a task sums up before it hands them on.
HELD_PAIRS = 4_000_000
MARK = "▁"
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")
_B_BITS, _PAIR_BITS = 20, 40
MEASURES = ("n_a", "n_b", "n_groups", "n_links")


def pair_code(a, b):
    return (a << _B_BITS) | b


def _counted(pairs: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs in order, and their summed numbers."""
    if not len(pairs):
        return pairs, times
    order = np.argsort(pairs, kind="stable")
    pairs, times = pairs[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
    return pairs[first], np.add.reduceat(times, first)


class Side(NamedTuple):
    """Tokens of some texts in a row: ids, the text of each, and where each ends, in bytes."""

    ids: np.ndarray
    of: np.ndarray
    ends: np.ndarray

    @staticmethod
    def made(tokens: list[np.ndarray], size: np.ndarray) -> Side:
        ids = np.concatenate([np.zeros(0, np.int64), *tokens]).astype(np.int64)
        return Side(ids, np.repeat(np.arange(len(tokens)), [len(t) for t in tokens]), np.cumsum(size[ids]))

    def cuts(self, other: Side) -> np.ndarray:
        """Whether a token ends where one of the other side does."""
        at = np.searchsorted(other.ends, self.ends)
        return other.ends[at] == self.ends


def links(a: Side, b: Side, a_group: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs with the text before them in the same number, and how often each occurs."""
    a_from, b_from = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    wide = n_a * n_b > WIDE
    each = np.where(wide, 0, n_b)[a_group]
    # every A token next to each B token of its group
    which = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    left = np.repeat(np.arange(len(a.ids)), each)
    pairs = (a.of[left] << _PAIR_BITS) | pair_code(a.ids[left], b.ids[b_from[a_group[left]] + which])
    if not wide.any():
        return np.unique(pairs, return_counts=True)
    found, times = [pairs], [np.ones(len(pairs), np.int64)]
    for g in np.flatnonzero(wide):
        a_ids, a_times = np.unique(a.ids[a_from[g] : a_from[g] + n_a[g]], return_counts=True)
        b_ids, b_times = np.unique(b.ids[b_from[g] : b_from[g] + n_b[g]], return_counts=True)
        found.append((a.of[a_from[g]] << _PAIR_BITS | pair_code(a_ids[:, None], b_ids)).ravel())
        times.append((a_times[:, None] * b_times).ravel())
    return _counted(np.concatenate(found), np.concatenate(times))


class Aligner:
    """Both tokenizers."""

    def __init__(self, path_a: str, path_b: str):
        symbols = byte_symbols()
        with open(path_a, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        # special tokens are no tokens here: their strings are split like any text
        self.a = encoder(path_a).coding
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(symbols[c] for c in token) if set(token) <= set(symbols) else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(_BYTE.fullmatch(p)[1], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)
        ]
        if len(self.a_bytes) > 1 << (_PAIR_BITS - _B_BITS) or len(pieces) > 1 << _B_BITS:
            raise ValueError("a vocabulary has more ids than a pair's code holds")
        self.a_size, self.b_size = (np.array([len(t) for t in x]) for x in (self.a_bytes, self.b_bytes))
        # a token's number as it stands in the groups: within its side, or as the last of it
        self.written = [f"{i}{end}" for x, ends in ((self.a_bytes, ",|"), (self.b_bytes, ",;")) for end in ends for i in range(len(x))]

    def _tokens(self, text: str, b: list[int]) -> tuple[np.ndarray, np.ndarray] | None:
        """Both sides' ids, None if one does not give back the text."""
        whole, a = b" " + text.encode(), self.a.encode_to_numpy(" " + text, disallowed_special=())
        if b"".join(map(self.b_bytes.__getitem__, b)) != whole or b"".join(map(self.a_bytes.__getitem__, a.tolist())) != whole:
            return None
        return a, np.array(b, np.int64)

    def measure(self, texts: list[str]) -> list[list]:
        """Columns of the texts: measures, digest of the groups, pairs and their times."""
        out: list[tuple] = [(0, 0, 0, 0, "", b"", b"")] * len(texts)
        both = [self._tokens(t, b) if t else None for t, b in zip(texts, self.b.encode(texts, num_threads=1))]
        good = [i for i, x in enumerate(both) if x]
        if not good:
            return [list(c) for c in zip(*out)]
        a, b = (Side.made([both[i][k] for i in good], size) for k, size in enumerate((self.a_size, self.b_size)))
        a_cut, b_cut = a.cuts(b), b.cuts(a)
        a_group, b_group = np.cumsum(a_cut) - a_cut, np.cumsum(b_cut) - b_cut
        n_a, n_b = np.bincount(a_group), np.bincount(b_group)
        text_of = a.of[np.cumsum(n_a) - 1]
        sums = [np.bincount(x, w, len(good)).astype(np.int64).tolist() for x, w in ((a.of, None), (b.of, None), (text_of, None), (text_of, n_a * n_b))]
        keys, times = links(a, b, a_group, n_a, n_b)
        edges = np.searchsorted(keys >> _PAIR_BITS, np.arange(len(good) + 1)).tolist()
        pairs = keys & ((1 << _PAIR_BITS) - 1)
        # groups in order, each with its A tokens before its B tokens
        order = np.empty(len(a.ids) + len(b.ids), np.int64)
        order[np.arange(len(a.ids)) + (np.cumsum(n_b) - n_b)[a_group]] = a.ids + a_cut * len(self.a_bytes)
        order[np.arange(len(b.ids)) + np.cumsum(n_a)[b_group]] = 2 * len(self.a_bytes) + b.ids + b_cut * len(self.b_bytes)
        written = list(map(self.written.__getitem__, order.tolist()))
        at = 0
        for k, i in enumerate(good):
            end = at + sums[0][k] + sums[1][k]
            digest = hashlib.sha256("".join(written[at:end])[:-1].encode()).hexdigest()
            own = slice(edges[k], edges[k + 1])
            packed = pairs[own].astype("<i8").tobytes(), times[own].astype("<i8").tobytes()
            out[i] = (*(s[k] for s in sums), digest, *packed)
            at = end
        return [list(c) for c in zip(*out)]


@lru_cache(2)
def aligner(path_a: str, path_b: str) -> Aligner:
    """One per worker and pair of files."""
    return Aligner(path_a, path_b)


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Packed numbers of a batch in a row, and how many each row has."""
    values = [np.frombuffer(v, "<i8") for v in column.to_pylist()]
    return np.concatenate([np.zeros(0, np.int64), *values]), np.array([len(v) for v in values], np.int64)


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents by pair, summed over a task's texts before they are shuffled."""

    def rows() -> pa.RecordBatch:
        pairs, n = _counted(np.concatenate([p for p, _ in held]), np.concatenate([n for _, n in held]))
        held[:] = [(pairs, n)]
        return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n)], ["pair", "n"])

    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        pairs, size = _numbers(batch.column("pairs"))
        held.append((pairs, np.repeat(batch.column("n").to_numpy(), size)))
        if sum(len(p) for p, _ in held) > HELD_PAIRS:
            summed = rows()
            if summed.num_rows > HELD_PAIRS // 2:
                yield summed
                held.clear()
    if held:
        yield rows()


def _known(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs above a cut-off that at most ``most`` pairs reach: codes, counts, whether best."""
    level = F.floor(4 * F.log2("n")).cast("int")
    cut, total = None, 0
    for r in counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():
        total += r["count"]
        if total > most:
            break
        cut = r["level"]
    rows = counts.where(level >= cut if cut is not None else F.lit(False)).select("pair", "n", "best").toArrow().sort_by("pair")
    return tuple(rows.column(c).to_numpy() for c in ("pair", "n", "best"))


def _weigh(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A text's sums over known pairs (``pair`` NULL), and a row for every other pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts, best = shared.value
        for batch in batches:
            pairs, size = _numbers(batch.column("pairs"))
            times, _ = _numbers(batch.column("times"))
            of = np.repeat(np.arange(batch.num_rows), size)
            place = np.minimum(np.searchsorted(codes, pairs), max(len(codes) - 1, 0))
            hit = codes[place] == pairs if len(codes) else np.zeros(len(pairs), bool)
            n_best, count_sum = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(n_best, of[hit], times[hit] * best[place[hit]])
            np.add.at(count_sum, of[hit], times[hit] * counts[place[hit]])
            number, rest = batch.column("number"), of[~hit]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([number, number.take(pa.array(rest))]),
                    pa.concat_arrays([pa.nulls(len(n_best), pa.int64()), pa.array(pairs[~hit])]),
                    pa.array(np.concatenate([n_best, times[~hit]])),
                    pa.array(np.concatenate([count_sum, np.zeros(len(rest), np.int64)])),
                ],
                ["number", "pair", "n_best", "count_sum"],
            )

    return run


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair``, the documents ``n`` that hold it, and whether no pair of its A id has more."""
    ship(aligned.sparkSession)
    summed = aligned.select("n", "pairs").mapInArrow(_pair_counts, "pair long, n long")
    counts = stage(summed.groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    a_id = F.shiftright("pair", _B_BITS)
    # one row for each id of the vocabulary
    most = counts.groupBy(a_id.alias("a")).agg(F.max("n").alias("most"))
    return counts.join(F.broadcast(most), a_id == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align_texts(docs: DataFrame, path_a: str, path_b: str, text_col: str = "text") -> DataFrame:
    """Every distinct text once, stored: digest, copies, measures, pairs; ``number`` tells texts apart."""
    ship(docs.sparkSession)
    texts = docs.where(F.octet_length(text_col) > 0).groupBy(F.col(text_col).alias("text")).agg(F.count(F.lit(1)).alias("n"))
    added = ", ".join(f"{m} long" for m in MEASURES) + ", groups_sha256 string, pairs binary, times binary"
    made = map_texts(
        texts.withColumn("digest", F.unhex(F.sha2("text", 256))),
        lambda: aligner(path_a, path_b).measure,
        added,
        ["digest", "n"],
    )
    # numbers differ from run to run; what is written is read from then on
    return stage(made.withColumn("number", F.monotonically_increasing_id()), "aligned")


def align(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    known_pairs: int = KNOWN_PAIRS,
) -> DataFrame:
    """Per document the measures of its text, and what its links count over the corpus."""
    spark = docs.sparkSession
    aligned = align_texts(docs, path_a, path_b, text_col)
    counts = stage(pair_counts(aligned), "pair-counts")
    shared = spark.sparkContext.broadcast(_known(counts, known_pairs))
    schema = "number long, pair long, n_best long, count_sum long"
    weighed = stage(
        aligned.select("number", "pairs", "times").mapInArrow(_weigh(shared), schema).withColumn("rest", F.col("pair").isNotNull()),
        "weighed",
        "rest",
    )
    times = F.col("n_best")
    rest = weighed.where("rest").join(counts, "pair").select(
        "number", F.when(F.col("best"), times).otherwise(0).alias("n_best"), (times * F.col("n")).alias("count_sum")
    )
    sums = weighed.where("NOT rest").select("number", "n_best", "count_sum").unionByName(rest)
    totals = sums.groupBy("number").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    measured = [*MEASURES, "n_best", "count_sum", "groups_sha256"]
    side = stage(aligned.select("digest", "number", *MEASURES, "groups_sha256").join(totals, "number").select("digest", *measured), "measures")
    digest = F.unhex(F.sha2(F.when(F.octet_length(text_col) > 0, F.col(text_col)), 256))
    ids = stage(docs.select(F.col(id_col).alias("doc_id"), digest.alias("digest")), "digests")
    found = lookup(ids, side, {"digest": "digest"}, {c: c for c in measured}, "left")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in measured[:-1]]
    return found.select("doc_id", *zero, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
