"""Log probabilities of texts by deleted interpolation of word n-grams.

A text's tokens are its words, A-Z made small, and one end. Tokens are counted over
all training texts. Every one of them is an event and a context of a bigram model,
tokens that no training text holds share one more. The probability of a token after
another mixes three maximum-likelihood estimates, of the pair, of the token alone and
of any token, with weights that depend on how often the context was seen.
Expectation-maximisation learns the weights from the counts of all pairs, from which
the event in question was deleted; it tells counts apart by their leading bits.

Every count is over all training texts. Broadcast are the counts of a bounded number
of frequent tokens and of frequent pairs; the counts of all others meet the texts in
joins: pairs with rare tokens by rows, rare pairs of other tokens by blocks of packed
pairs, dealt by a hash of the pair. Pairs frequent in a bounded sample are counted
apart, exactly, so no bucket holds a pair that very many texts share.

NULL and empty texts are the end alone. Rows are kept apart even if their ids are
equal or NULL. Without training texts every token is equally likely. Columns other
than the three named ones are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F

from starloom.llm.language import Table
from starloom.llm.tables import frequent, ship, steps, texts_of
from starloom.session import stage

#: Tokens whose counts are broadcast, about.
KNOWN_TOKENS = 1_000_000
#: Numbers of a text's begin and of every token whose count is not broadcast; then come
#: the broadcast ones by rank. A number takes so many bytes.
BEGIN, RARE, FIRST = 0, 1, 2
BYTES = 3
#: Pairs whose counts are broadcast, the documents they are chosen from, their least count there.
KNOWN_PAIRS, PAIR_DOCS, PAIR_LEAST = 65_536, 6_000, 8
#: Rows of pair statistics up to which the driver learns the weights from them alone; of
#: more, each round is an aggregate over all of them.
LOCAL_EVENTS = 500_000
#: Leading bits of the counts that the weights are learned from.
BITS = 5
PAIRS_PER_BUCKET = 2_000_000
#: Sums come back in packed ranges of 2 ** so many rows.
ROWS_BITS = 12
#: Contexts seen from 2 ** i times on share weights.
CONTEXT_BUCKETS, ROUNDS = 24, 30
END = xxhash.xxh3_64_intdigest(b"\n")
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHIFT, _LOW = np.uint64(8 * BYTES), np.uint64((1 << (8 * BYTES)) - 1)


def token_hashes(text: str) -> np.ndarray:
    """Hashes of the words and of the end, which no word can be."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    words.append(b"\n")
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _planes(numbers: np.ndarray, width: int) -> bytes:
    """The lowest bytes of all numbers, then the next ones, which packs well."""
    return numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _numbers(planes: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(planes) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, -1).T
    return out.view("<u8").ravel()


def _count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept: list[tuple[np.ndarray, np.ndarray]] = []

    def rows() -> pa.RecordBatch:
        keys = np.concatenate([k for k, _ in kept] or [np.zeros(0, np.uint64)])
        n = np.concatenate([n for _, n in kept] or [np.zeros(0, np.int64)])
        kept.clear()
        one, at = np.unique(keys, return_inverse=True)
        total = np.bincount(at, weights=n, minlength=len(one)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(one.view(np.int64)), pa.array(total)], ["token", "n"])

    for batch in batches:
        for part in steps(batch):
            found = [token_hashes(t) for t in texts_of(part)]
            keys, n = np.unique(np.concatenate(found), return_counts=True)
            kept.append((keys, n.astype(np.int64)))
            if sum(len(k) for k, _ in kept) > 2_000_000:
                yield rows()
    yield rows()


@dataclass
class Vocabulary:
    """Counts of the frequent tokens, most frequent first, and totals of all."""

    table: Table  # token -> rank, count
    n_tokens: int
    n_distinct: int
    n_docs: int
    event_counts: np.ndarray  # of every numbered token as an event
    context_counts: np.ndarray  # of every numbered token as a context

    def base(self, count: np.ndarray) -> np.ndarray:
        """log10 of the smoothed share of tokens with these counts."""
        return np.log10((count + 0.1) / (self.n_tokens + 0.1 * (self.n_distinct + 1)))


def vocabulary_of(counts: DataFrame, known: DataFrame, n_docs: int) -> Vocabulary:
    """Vocabulary of all counted tokens, with the counts of the known ones by token."""
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    top = known.toArrow()
    tokens, n = top.column("token").to_numpy().view(np.uint64), top.column("n").to_numpy().astype(np.int64)
    assert len(n) + FIRST < 1 << (8 * BYTES - 1)
    order = np.lexsort((tokens, -n))
    tokens, n = tokens[order], n[order]
    event_counts = np.concatenate([np.zeros(FIRST, np.int64), n])
    context_counts = np.concatenate([np.zeros(FIRST, np.int64), np.where(tokens == np.uint64(END), 0, n)])
    context_counts[BEGIN] = n_docs
    table = Table(tokens, np.stack([np.arange(len(n)), n], 1).astype(np.int64))
    return Vocabulary(table, total["n"], total["v"], n_docs, event_counts, context_counts)


def _encode(shared):
    """Texts as numbers of tokens, with the sums over tokens whose counts are broadcast."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, packer = shared.value, zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for part in steps(batch):
                found = [token_hashes(t) for t in texts_of(part)]
                size = np.array([len(x) for x in found])
                start = np.cumsum(size) - size
                tokens = np.concatenate(found)
                row = vocabulary.table.find(tokens)
                rank, count = vocabulary.table.rows[row, 0], vocabulary.table.rows[row, 1]
                known = row > 0
                # tokens without a broadcast count are looked up later
                number = np.where(known, rank + FIRST, RARE)
                base = np.where(known, vocabulary.base(count), 0.0)
                blobs, rare = [], []
                for a, n in zip(start, size):
                    blobs.append(packer.compress(_planes(number[a : a + n], BYTES)))
                    rare.append(tokens[a : a + n][~known[a : a + n]].view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("held_out"),
                        pa.array(size, pa.int64()),
                        pa.array(np.add.reduceat(known.astype(np.int64), start), pa.int64()),
                        pa.array(np.add.reduceat(base, start), pa.float64()),
                        pa.array(blobs, pa.binary()),
                        pa.array(rare, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "held_out", "n_tokens", "n_known", "base", "numbers", "rare"],
                )

    return run


def _pairs(blob: bytes, unpacker: zstandard.ZstdDecompressor) -> np.ndarray:
    """Pairs of each token and the one before it, as one number."""
    tokens = _numbers(unpacker.decompress(blob), BYTES)
    before = np.concatenate([np.array([BEGIN], np.uint64), tokens[:-1]])
    return (before << _SHIFT) | tokens


def _has_rare(pairs: np.ndarray) -> np.ndarray:
    """Whether a count of either token is not broadcast."""
    return (pairs >> _SHIFT == RARE) | (pairs & _LOW == RARE)


def _rare_pairs(shared):
    """The pairs with a rare token: hashes of rare tokens, numbers and counts of the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, unpacker = shared.value, zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                part = part.filter(pc.greater(pc.list_value_length(part.column("rare")), 0))
                if not part.num_rows:
                    continue
                each = [_pairs(b.as_buffer(), unpacker) for b in part.column("numbers")]
                pairs = np.concatenate(each)
                before, event = (pairs >> _SHIFT).astype(np.int64), (pairs & _LOW).astype(np.int64)
                key = event.copy()
                key[event == RARE] = part.column("rare").flatten().to_numpy()
                # a rare token is never the last of its text, which is the end
                first = np.where(before == RARE, np.roll(key, 1), before)
                keep = _has_rare(pairs)
                row = np.repeat(np.arange(len(each)), [len(x) for x in each])[keep]
                before, event = before[keep], event[keep]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row").take(pa.array(row)),
                        part.column("held_out").take(pa.array(row)),
                        pa.array(first[keep]),
                        pa.array(key[keep]),
                        pa.array(vocabulary.context_counts[before], mask=before == RARE),
                        pa.array(vocabulary.event_counts[event], mask=event == RARE),
                    ],
                    ["row", "held_out", "before", "event", "context", "single"],
                )

    return run


def _rare_values(shared):
    """log10 of the probability of pairs with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, context, single = (batch.column(c).to_numpy().astype(np.float64) for c in ("n", "context", "single"))
            value = shared.value.log10(n, context, single)
            yield pa.RecordBatch.from_arrays([*map(batch.column, ("row", "count")), pa.array(value)], ["row", "count", "value"])

    return run


def _hash(pairs: np.ndarray) -> np.ndarray:
    return (pairs.astype(np.uint64) * _MIX) >> np.uint64(33)


def _count_pairs(known: np.ndarray | None):
    """Counts of pairs without rare tokens: of the known ones, or of all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                found = np.concatenate([_pairs(b.as_buffer(), unpacker) for b in part.column("numbers")])
                found = found[~_has_rare(found)] if known is None else found[_place(known, found)[1]]
                keys, n = np.unique(found, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64))], ["pair", "n"])

    return run


def _place(known: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where pairs are among the sorted known ones, and whether they are."""
    if not len(known):
        return np.zeros(len(pairs), np.int64), np.zeros(len(pairs), bool)
    place = np.minimum(np.searchsorted(known, pairs), len(known) - 1)
    return place, known[place] == pairs


def context_bucket(count: np.ndarray) -> np.ndarray:
    """Bucket of contexts by count: 0 for unseen ones, then by powers of two."""
    return np.where(count > 0, 1 + np.minimum(np.log2(np.maximum(count, 1)).astype(np.int64), CONTEXT_BUCKETS - 2), 0)


def coarse(count: np.ndarray) -> np.ndarray:
    """Counts by their leading bits: small ones as they are, of others the middle of those that share them."""
    count = np.asarray(count).astype(np.int64)
    over = np.maximum(np.frexp(count.astype(np.float64))[1] - BITS, 0).astype(np.int64)
    return (count >> over << over) + ((1 << over) >> 1)


def _coarse(count: Column) -> Column:
    """As ``coarse``, in SQL."""
    step = F.pow(F.lit(2.0), F.greatest(F.length(F.bin(count)) - BITS, F.lit(0))).cast("long")
    return (count - count % step + F.floor(step / 2)).cast("long")


def _estimates(pair: np.ndarray, context: np.ndarray, single: np.ndarray, total: float, classes: int) -> np.ndarray:
    """Maximum-likelihood estimates of pair, token and any token, one column each."""
    out = np.zeros((len(pair), 3))
    out[:, 0] = np.divide(pair, context, out=np.zeros(len(pair)), where=context > 0)
    out[:, 1] = single / total if total > 0 else 0.0
    out[:, 2] = 1.0 / (classes + 1)
    return out


def _gained(bucket: np.ndarray, each: np.ndarray, events: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Per context bucket the events that each estimate accounts for, and all events."""
    share = weights[bucket] * each
    share *= (events / np.maximum(share.sum(1), 1e-300))[:, None]
    return np.stack([np.bincount(bucket, weights=x, minlength=CONTEXT_BUCKETS) for x in (*share.T, events)], 1)


def learn_weights(pair: np.ndarray, context: np.ndarray, single: np.ndarray, total: int, classes: int, rounds: int = ROUNDS, times=1.0, others=None) -> np.ndarray:
    """Mixture weights per context bucket, by EM.

    Each of the counted events is held out in turn: its own count is deleted from
    the pair, the context and the token before their estimates are mixed. Counts are
    taken by their leading bits, so few kinds of events stand for all pairs. ``times``
    is how many pairs have these counts, ``classes`` how many tokens there are;
    ``others`` gives what further pairs gain.
    """
    weights = np.tile([0.3, 0.6, 0.1], (CONTEXT_BUCKETS, 1))
    weights[0] = [0.0, 0.9, 0.1]
    if not len(pair) and others is None:
        return weights if total else np.tile([0.0, 0.0, 1.0], (CONTEXT_BUCKETS, 1))
    bucket = context_bucket(context)
    n = coarse(pair)
    each = _estimates(n - 1.0, coarse(context) - 1.0, coarse(single) - 1.0, total - 1.0, classes)
    for _ in range(rounds):
        sums = _gained(bucket, each, n * times, weights)
        if others is not None:
            sums = sums + others(weights)
        gained, seen = sums[:, :3], sums[:, 3:]
        # a few events of the prior keep every weight above zero
        weights = np.where(seen > 0, (gained + 1.0) / (seen + 3.0), weights)
    weights[0] = [0.0, 0.9, 0.1]
    return weights


EVENTS = "n long, context long, single long, times long"


def _events(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many pairs have the same counts, as far as the weights depend on these.

    Nothing is left of a single pair's count once it is deleted, so of its context
    the bucket is enough.
    """
    unpacker = zstandard.ZstdDecompressor()
    for batch in batches:
        for i in range(batch.num_rows):
            counts = np.stack([_numbers(unpacker.decompress(batch.column(c)[i].as_buffer()), 8) for c in ("n", "context", "single")], 1)
            counts = coarse(counts[counts[:, 0] > 0])
            once = counts[:, 0] == 1
            counts[once, 1] = 1 << np.maximum(context_bucket(counts[once, 1]) - 1, 0)
            counts = counts[np.lexsort(counts.T)]
            first = np.flatnonzero(np.concatenate([np.ones(len(counts[:1]), bool), (counts[1:] != counts[:-1]).any(1)]))
            times = np.diff(np.append(first, len(counts)))
            yield pa.RecordBatch.from_arrays([*map(pa.array, counts[first].T.copy()), pa.array(times)], ["n", "context", "single", "times"])


def _others(events: DataFrame, total: int, classes: int):
    """What all pairs of ``events`` gain by some weights: one aggregate over them."""

    def gains(weights: np.ndarray) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((CONTEXT_BUCKETS, 4))
            for batch in batches:
                n, context, single, times = (batch.column(c).to_numpy().astype(np.float64) for c in ("n", "context", "single", "times"))
                each = _estimates(n - 1.0, context - 1.0, single - 1.0, total - 1.0, classes)
                sums += _gained(context_bucket(context), each, n * times, weights)
            columns = [np.arange(CONTEXT_BUCKETS), *sums.T.copy()]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["bucket", "a", "b", "c", "seen"])

        found = events.mapInArrow(run, "bucket long, a double, b double, c double, seen double")
        summed = found.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ("a", "b", "c", "seen")]).toArrow()
        out = np.zeros((CONTEXT_BUCKETS, 4))
        out[summed.column("bucket").to_numpy()] = np.stack([summed.column(c).to_numpy() for c in ("a", "b", "c", "seen")], 1)
        return out

    return gains


@dataclass
class Model:
    """Weights to mix a pair's estimates with, and the known pairs' log10."""

    weights: np.ndarray
    total: int
    classes: int
    known: np.ndarray
    known_values: np.ndarray

    def log10(self, counts: np.ndarray, context: np.ndarray, single: np.ndarray) -> np.ndarray:
        """log10 of the mixture, from the counts of pairs, their contexts and their tokens."""
        each = _estimates(counts, context, single, self.total, self.classes)
        return np.log10((self.weights[context_bucket(context)] * each).sum(1))


def _near(shared):
    """Each row's sums over the known pairs, beside what is known of the row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, unpacker = shared.value, zstandard.ZstdDecompressor()
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                part = batch.slice(begin, 500)
                each = [_pairs(b.as_buffer(), unpacker) for b in part.column("numbers")]
                size = np.array([len(x) for x in each])
                place, met = _place(model.known, np.concatenate(each))
                sums = np.zeros(len(met))
                sums[met] = model.known_values[place[met]]
                total = np.add.reduceat(sums, np.cumsum(size) - size)
                names = [c for c in part.schema.names if c != "numbers"]
                yield pa.RecordBatch.from_arrays([*map(part.column, names), pa.array(total)], [*names, "near_sum"])

    return run


def _deal(known: np.ndarray, buckets: int):
    """All pairs but the known and the rare ones in packed blocks by bucket.

    A block carries pairs and the rows they belong to, the lowest bit of a row's
    number saying whether it is held out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker, packer = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)

        def flush(pairs: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
            at = (_hash(pairs) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(at, kind="stable")
            at, pairs, rows = at[order], pairs[order], rows[order]
            found, first = np.unique(at, return_index=True)
            edges = [*first.tolist(), len(at)]
            ranges = list(zip(edges, edges[1:]))
            packed = [packer.compress(_planes(pairs[a:b], 2 * BYTES)) for a, b in ranges]
            numbers = [packer.compress(np.diff(rows[a:b], prepend=0).astype("<i8").tobytes()) for a, b in ranges]
            kinds = [pa.int32(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip([found, packed, numbers], kinds)], ["bucket", "pairs", "rows"]
            )

        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                part = batch.slice(begin, 500)
                each = [_pairs(b.as_buffer(), unpacker) for b in part.column("numbers")]
                pairs = np.concatenate(each)
                numbers = part.column("row").to_numpy() * 2 + part.column("held_out").to_numpy(zero_copy_only=False)
                rows = np.repeat(numbers, [len(x) for x in each])
                left = ~(_has_rare(pairs) | _place(known, pairs)[1])
                waiting.append((pairs[left], rows[left]))
            if sum(len(p) for p, _ in waiting) > 4_000_000:
                yield flush(*map(np.concatenate, zip(*waiting)))
                waiting.clear()
        if waiting:
            yield flush(*map(np.concatenate, zip(*waiting)))

    return run


COUNTED = "n binary, context binary, single binary, rows binary, at binary"


def _count(shared):
    """Counts the pairs of one bucket over training rows: counts by pair, and each row's pairs."""

    def run(bucket: pa.Table) -> pa.Table:
        vocabulary = shared.value
        unpacker, packer = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
        pairs = np.concatenate([_numbers(unpacker.decompress(b.as_buffer()), 2 * BYTES) for b in bucket.column("pairs")])
        rows = np.concatenate([np.cumsum(np.frombuffer(unpacker.decompress(b.as_buffer()), "<i8")) for b in bucket.column("rows")])
        one, at = np.unique(pairs, return_inverse=True)
        counts = np.bincount(at[(rows & 1) == 0], minlength=len(one))
        values = [(counts, 8), (vocabulary.context_counts[one >> _SHIFT], 8), (vocabulary.event_counts[one & _LOW], 8)]
        packed = [packer.compress(_planes(x, width)) for x, width in values]
        packed += [packer.compress(np.diff(rows >> 1, prepend=0).astype("<i8").tobytes()), packer.compress(_planes(at, 4))]
        return pa.table({c: pa.array([b], pa.binary()) for c, b in zip(["n", "context", "single", "rows", "at"], packed)})

    return run


def _score(shared):
    """Sums every row's log10 over the pairs of each bucket.

    The sums of each range of rows come back as one packed block: a document's pairs
    lie in ever more buckets as these become more, and a row for each would be many.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        unpacker, packer = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for i in range(batch.num_rows):
                raw = {c: unpacker.decompress(batch.column(c)[i].as_buffer()) for c in batch.schema.names}
                counts = [_numbers(raw[c], 8).astype(np.int64) for c in ("n", "context", "single")]
                value = model.log10(*counts)[_numbers(raw["at"], 4).astype(np.int64)]
                row, of = np.unique(np.cumsum(np.frombuffer(raw["rows"], "<i8")), return_inverse=True)
                total = np.bincount(of, weights=value)
                found, first = np.unique(row >> ROWS_BITS, return_index=True)
                edges = [*first.tolist(), len(row)]
                ranges = list(zip(edges, edges[1:]))
                numbers = [packer.compress(np.diff(row[a:b], prepend=0).astype("<i8").tobytes()) for a, b in ranges]
                sums = [packer.compress(total[a:b].astype("<f8").tobytes()) for a, b in ranges]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found, pa.int64()), pa.array(numbers, pa.binary()), pa.array(sums, pa.binary())], ["block", "rows", "sums"]
                )

    return run


def _gather(block: pa.Table) -> pa.Table:
    """The sums of one range of rows over all buckets."""
    unpacker = zstandard.ZstdDecompressor()
    rows = np.concatenate([np.cumsum(np.frombuffer(unpacker.decompress(b.as_buffer()), "<i8")) for b in block.column("rows")])
    sums = np.concatenate([np.frombuffer(unpacker.decompress(b.as_buffer()), "<f8") for b in block.column("sums")])
    row, of = np.unique(rows, return_inverse=True)
    return pa.table({"row": pa.array(row, pa.int64()), "far_sum": pa.array(np.bincount(of, weights=sums), pa.float64())})


def score(docs: DataFrame, held_out: str, id_col: str = "doc_id", text_col: str = "text", known_tokens: int = KNOWN_TOKENS) -> DataFrame:
    """Scores of all documents by a model of those where ``held_out`` is false."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(held_out), F.lit(False)).alias("held_out"), F.col(text_col).alias("text")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    training = rows.where(~F.col("held_out"))
    counts = stage(
        training.select("text").mapInArrow(_count_tokens, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")), "tokens"
    )
    # the end is always known, whatever its count
    is_end = F.col("token") == int(np.uint64(END).view(np.int64))
    ends = counts.where(is_end).first()
    is_known = frequent(counts, known_tokens, "token") | is_end
    vocabulary = vocabulary_of(counts, counts.where(is_known), ends["n"] if ends else 0)
    shared = spark.sparkContext.broadcast(vocabulary)
    of_row = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base double"
    encoded = rows.mapInArrow(_encode(shared), f"{of_row}, numbers binary, rare array<long>")
    encoded = stage(encoded.withColumn("row", F.monotonically_increasing_id()), "encoded")
    train = encoded.where(~F.col("held_out"))

    # pairs with tokens beyond the known ones: counted and met by joins
    pair_row = "row long, held_out boolean, before long, event long, context long, single long"
    beside = encoded.select("row", "held_out", "numbers", "rare").mapInArrow(_rare_pairs(shared), pair_row)
    # a pair lies where its rare event does, else its rare context, so that giving all its rows its
    # count and a token's take one shuffle; no rare token is among the most frequent ones
    rest = counts.where(~is_known).withColumnRenamed("n", "count")
    token = F.when(F.col("single").isNull(), F.col("event")).otherwise(F.col("before"))
    of_pair = Window.partitionBy("token", "before", "event")
    half = beside.withColumn("token", token).repartition("token").select(
        "row",
        "token",
        "before",
        "context",
        "single",
        F.count_if(~F.col("held_out")).over(of_pair).alias("n"),
        (F.row_number().over(of_pair.orderBy("row")) == 1).alias("once"),
    )
    rare, count = F.col("single").isNull(), F.coalesce("count", F.lit(0))
    half = half.join(rest, "token", "left").select(
        "row",
        "n",
        "once",
        F.when(rare & F.col("context").isNull(), F.col("before")).alias("before"),
        F.when(rare, F.col("context")).otherwise(count).alias("context"),
        F.when(rare, count).otherwise(F.col("single")).alias("single"),
        rare.alias("rare"),
    )
    half = stage(half, "rare-counts")
    # of two rare tokens, the context's count
    both = half.where(F.col("context").isNull()).drop("context").withColumnRenamed("before", "token").join(rest, "token", "left")
    both = stage(both.select("row", "n", "once", count.alias("context"), "single", "rare"), "rare-both")
    of_rows = half.where(F.col("context").isNotNull()).drop("before").unionByName(both)

    # frequent pairs
    n_docs, n_events, n_classes = vocabulary.n_docs, vocabulary.n_tokens, vocabulary.n_distinct
    share = min(1.0, PAIR_DOCS / max(1, n_docs))
    some = train.where(F.pmod(F.xxhash64("row"), F.lit(1 << 20)) < int(share * (1 << 20)))
    often = (
        some.select("numbers").mapInArrow(_count_pairs(None), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        .where(F.col("n") >= PAIR_LEAST).orderBy(F.desc("n"), "pair").limit(KNOWN_PAIRS).select("pair").toArrow()
    )
    known = np.sort(often.column("pair").to_numpy().astype(np.uint64))
    exact = train.select("numbers").mapInArrow(_count_pairs(known), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    known_counts = np.zeros(len(known), np.int64)
    known_counts[np.searchsorted(known, exact.column("pair").to_numpy().astype(np.uint64))] = exact.column("n").to_numpy()
    known_context, known_single = vocabulary.context_counts[known >> _SHIFT], vocabulary.event_counts[known & _LOW]

    # all other pairs, counted by bucket; then the weights from the counts of all
    buckets = max(1, math.ceil(n_events / PAIRS_PER_BUCKET))
    packed = encoded.select("row", "held_out", "numbers").mapInArrow(_deal(known, buckets), "bucket int, pairs binary, rows binary")
    counted = stage(packed.groupBy("bucket").applyInArrow(_count(shared), COUNTED), "counted")
    events = counted.select("n", "context", "single").mapInArrow(_events, EVENTS)
    # as in _events, in SQL: bits, not log2, as its floor may be one off
    least = F.pow(F.lit(2.0), F.least(F.length(F.bin("context")) - 1, F.lit(CONTEXT_BUCKETS - 2))).cast("long")
    beside_context = F.when(F.col("n") == 1, least).otherwise(F.col("context"))
    of_rare = of_rows.where("once AND n > 0").select("n", beside_context.alias("context"), "single").select(*map(_coarse, map(F.col, ("n", "context", "single"))), F.lit(1).cast("long"))
    events = stage(events.union(of_rare).groupBy("n", "context", "single").agg(F.sum("times").alias("times")), "events")
    of_known = [known_counts, known_context, known_single, np.ones(len(known))]
    local = events.count() <= LOCAL_EVENTS
    if local:
        of_others = events.toArrow()
        of_known = [np.concatenate([a, of_others.column(i).to_numpy()]) for i, a in enumerate(of_known)]
    *of_pairs, times = (a.astype(np.float64) for a in of_known)
    others = None if local else _others(events, n_events, n_classes)
    weights = learn_weights(*of_pairs, n_events, n_classes, times=times, others=others)
    found = Model(weights, n_events, n_classes, known, np.zeros(0))
    found.known_values = found.log10(known_counts, known_context, known_single)
    model = spark.sparkContext.broadcast(found)

    # every row's sums, of both kinds of pairs in one aggregate
    values = of_rows.select("row", "n", "context", "single", F.when(F.col("rare"), F.col("single")).alias("count"))
    values = values.mapInArrow(_rare_values(model), "row long, count long, value double")
    base = F.log10((F.col("count") + 0.1) / (n_events + 0.1 * (n_classes + 1)))
    of_beside = values.select("row", "value", (F.col("count") > 0).cast("long").alias("known"), base.alias("base"))
    blocks = counted.mapInArrow(_score(model), "block long, rows binary, sums binary")
    far = blocks.groupBy("block").applyInArrow(_gather, "row long, far_sum double")
    far = far.select("row", F.col("far_sum").alias("value"), F.lit(0).cast("long").alias("known"), F.lit(0.0).alias("base"))
    sums = of_beside.union(far).groupBy("row").agg(*[F.sum(c).alias(f"more_{c}") for c in ("value", "known", "base")])
    near = encoded.select("row", *[c for c in encoded.columns if c not in ("row", "rare")]).mapInArrow(_near(model), f"row long, {of_row}, near_sum double")
    more = lambda c: F.coalesce(f"more_{c}", F.lit(0))
    return near.join(sums, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + more("known")).cast("long").alias("n_known"),
        F.lit(vocabulary.n_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more("base")).alias("base_score"),
        (F.col("near_sum") + more("value")).alias("score"),
    )
