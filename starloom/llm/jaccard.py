"""Near-duplicate classes by an n-gram Jaccard join with adaptive multi-match prefixes.

A document is its set of word shingles. Documents with equal sets are one class and
are joined as one. Two sets that are similar enough share at least l shingles among
the first n - ceil(t n) + l of each, in any order common to all sets. The order puts
shingles first that should be rare by how often all documents hold the words they are
made of, and last those that many documents were found to hold, so a passage that many
texts share is in a prefix only where nearly the whole text is made of such; it changes
cost, never results. Each document chooses its own l: a longer prefix costs more look-ups but asks for more shared
shingles before a pair is verified, which pays where its shingles are frequent.

Components are wanted, not all pairs. So each shared shingle first proposes a leader
to all its documents, which links large groups of copies by as many pairs as they
have members. Only pairs across the components found so far are then joined in full,
so no group is expanded into all its pairs and no link between components is lost.

A candidate pair is first bounded: how many hashes of each set begin with the same
bits says how many they can share at most. Whole sets are moved only for pairs that
this bound leaves, so candidates that share a few passages cost little.

NULL and empty texts have no shingles and are linked with nothing. Rows with one id
are one node, whatever their texts: what one of them is linked with, all of them with
shingles are. A NULL id is never linked and has component NULL. An empty table gives
an empty result. Columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from starloom.llm.components import components
from starloom.llm.tables import frequent, ship, small_batches, steps, texts, texts_of, tidy
from starloom.operators.joins import fits_broadcast
from starloom.session import stage

SHINGLE, PERCENT = 4, 85
#: Longest prefix: shared shingles that a pair may be asked for.
MAX_LEVEL = 8
#: What verifying a candidate costs, in look-ups of a shingle.
VERIFY_COST = 50
#: Words and shingles that count as frequent, about, which bounds what is broadcast.
FREQUENT_WORDS, FREQUENT_SHINGLES = 65_536, 262_144
#: Words or shingles that a task counts at once. Of these, shingles of one document are left out.
COUNTED_AT_ONCE = 2_000_000
#: Counts that a task passes on at once.
COUNTS_AT_ONCE = 100_000
#: Shingles of up to so many documents are rare: all pairs of their documents are few.
RARE = 8
#: Rounds of leaders before the full join.
LEADER_ROUNDS = 2
_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xC2B2AE3D27D4EB4F)


def needed(n: int | np.ndarray, percent: int = PERCENT):
    """Least number of shingles that a set of ``n`` shares with any similar set."""
    return (percent * n + 99) // 100


def similar(inter: int, a: int, b: int, percent: int = PERCENT) -> bool:
    return 100 * inter >= percent * (a + b - inter)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _B
    return x ^ (x >> np.uint64(29))


def word_hashes(text: str) -> np.ndarray:
    """Hashes of the words after A-Z became small; bytes above ASCII stay as they are."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """A hash per window of words, or one of all words if there are fewer."""
    if not len(words):
        return words
    short = len(words) < size
    width = len(words) if short else size
    total = np.zeros(len(words) - width + 1, np.uint64)
    for i in range(width):
        total = total * _A + words[i : len(words) - width + 1 + i]
    return _mix(total + np.uint64(width if short else 0))


def _look(keys: np.ndarray, values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The values of the sorted keys, 0 for others."""
    if not len(keys):
        return np.zeros(len(at), np.float32)
    place = np.minimum(np.searchsorted(keys, at), len(keys) - 1)
    return np.where(keys[place] == at, values[place], np.float32(0))


@dataclass
class Order:
    """Frequency of words and of shingles, by which shingles are ordered, the more frequent later."""

    words: np.ndarray
    weight: np.ndarray
    shingles: np.ndarray
    shingle_weight: np.ndarray

    def tokens(self, words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
        """Keys of the distinct shingles in order: 7 bits of their frequency, or else their words', then 56 of the hash."""
        hashes = shingle_hashes(words, size)
        weight = _look(self.words, self.weight, words)
        width = len(words) - len(hashes) + 1
        summed = np.zeros(len(hashes), np.float32)
        for i in range(width):
            summed += weight[i : len(words) - width + 1 + i]
        rank = np.minimum(summed * (4 / max(1, width)), 79).astype(np.uint64)
        seen = _look(self.shingles, self.shingle_weight, hashes)
        rank = np.where(seen > 0, np.uint64(80) + np.minimum(seen * 2, 47).astype(np.uint64), rank)
        return np.unique((rank << np.uint64(56)) | (hashes >> np.uint64(8))).view(np.int64)


def _counts(size: int):
    """Words by how often they occur, and shingles that several documents hold by these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: list[np.ndarray] = []
        sets: list[np.ndarray] = []

        def rows() -> Iterator[pa.RecordBatch]:
            # one kind after the other, sorted in place, and passed on bit by bit
            for whole, met in ((False, words), (True, sets)):
                hashes = np.concatenate(met)
                met.clear()
                hashes.sort()
                first = np.concatenate([[0], np.flatnonzero(hashes[1:] != hashes[:-1]) + 1, [len(hashes)]])
                for i in range(0, len(first) - 1, COUNTS_AT_ONCE):
                    edges = first[i : i + COUNTS_AT_ONCE + 1]
                    n = np.diff(edges)
                    held = n > int(whole)
                    keys, n = hashes[edges[:-1][held]], n[held]
                    columns = [pa.array(np.full(len(n), whole)), pa.array(keys.view(np.int64)), pa.array(n)]
                    yield pa.RecordBatch.from_arrays(columns, ["shingle", "key", "n"])

        for batch in batches:
            for part in steps(batch):
                for text in texts_of(part):
                    words.append(word_hashes(text))
                    sets.append(np.unique(shingle_hashes(words[-1], size)))
                if sum(map(len, words)) > COUNTED_AT_ONCE:
                    yield from rows()
        if words:
            yield from rows()

    return run


def order_of(docs: DataFrame, size: int = SHINGLE) -> Order:
    """The order of shingles, from the words and shingles of all documents.

    A shingle is counted where a task meets it in several of the documents that it
    takes at once, as it does with one that a share of all documents hold.
    """
    counted = docs.select("text").mapInArrow(tidy(_counts(size)), "shingle boolean, key long, n long")
    summed = counted.groupBy("shingle", "key").agg(F.sum("n").alias("n"))
    summed = stage(summed.where(F.col("n") > F.when(F.col("shingle"), RARE).otherwise(1)), "counts")

    def top(of: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
        table = of.where(frequent(of, most, "key")).select("key", "n").toArrow()
        keys = table.column("key").to_numpy().view(np.uint64)
        by_key = np.argsort(keys)
        return keys[by_key], np.log2(table.column("n").to_numpy()[by_key]).astype(np.float32)

    return Order(*top(summed.where("NOT shingle"), FREQUENT_WORDS), *top(summed.where("shingle"), FREQUENT_SHINGLES))


def cells(whole: np.ndarray) -> np.ndarray:
    """How many of a set's hashes begin with each pattern of bits, about two for each cell."""
    bits = max(1, len(whole).bit_length() - 1)
    while True:
        counts = np.bincount((whole >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
        if counts.max() < 256:
            return counts.astype(np.uint8)
        bits += 1


def most_shared(x: np.ndarray, y: np.ndarray) -> int:
    """Most hashes that two sets with these cells can have in common."""
    few, many = (x, y) if len(x) <= len(y) else (y, x)
    return int(np.minimum(few, many.reshape(len(few), -1).sum(1)).sum())


def _sketches(shared, size: int, percent: int):
    """Per document its set's size, signature and cells, and the tokens of its longest prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch):
                sizes, signs, counts, tokens = [], [], [], []
                for text in texts_of(part):
                    words = word_hashes(text)
                    whole = np.unique(shingle_hashes(words, size))
                    n = len(whole)
                    sizes.append(n)
                    signs.append(_sign(whole))
                    counts.append(cells(whole).tobytes() if n else None)
                    most = min(MAX_LEVEL, needed(n, percent))
                    tokens.append(shared.value.tokens(words, size)[: n - needed(n, percent) + most] if n else [])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(sizes, pa.int64()),
                        pa.array(signs, pa.binary()),
                        pa.array(counts, pa.binary()),
                        pa.array(tokens, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n", "sign", "cells", "tokens"],
                )

    return run


def _sign(whole: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(whole.tobytes()) if len(whole) else None


def _sets(size: int, with_sets: bool = True):
    """Per document its set's signature and the set itself, or the digest of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch):
                wholes = [np.unique(shingle_hashes(word_hashes(text), size)) for text in texts_of(part)]
                last = pa.array([w.tobytes() for w in wholes], pa.binary()) if with_sets else part.column("digest")
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(map(_sign, wholes), pa.binary()), last],
                    ["doc_id", "sign", "whole" if with_sets else "digest"],
                )

    return run


def _bounded(percent: int):
    """The pairs that can be similar by their cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("cells_a"), batch.column("cells_b")):
                a, b = (np.frombuffer(s.as_buffer(), np.uint8) for s in (x, y))
                keep.append(similar(most_shared(a, b), int(a.sum()), int(b.sum()), percent))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).filter(pa.array(keep, pa.bool_())) for c in ("a", "b")], ["a", "b"]
            )

    return run


def _verified(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("whole_a"), batch.column("whole_b")):
                a, b = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                both = np.concatenate([a, b])
                both.sort(kind="stable")
                inter = int((both[1:] == both[:-1]).sum())
                keep.append(similar(inter, len(a), len(b), percent))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).filter(pa.array(keep, pa.bool_())) for c in ("a", "b")], ["a", "b"]
            )

    return run


def _if_small(side: DataFrame) -> DataFrame:
    """A staged side, broadcast if its size allows."""
    return F.broadcast(side) if fits_broadcast(side) else side


def _in_pairs(pairs: DataFrame) -> DataFrame:
    return stage(pairs.select(F.col("a").alias("doc")).union(pairs.select("b")).distinct(), "ids")


def _links(docs: DataFrame, reps: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs whose sets are similar. Sets are made anew for pairs that their cells leave."""
    pairs = stage(pairs, "pairs")
    if pairs.isEmpty():
        return pairs
    counts = reps.join(_if_small(_in_pairs(pairs)), "doc", "left_semi").select("doc", "cells")
    both = pairs.join(counts.toDF("a", "cells_a"), "a").join(counts.toDF("b", "cells_b"), "b")
    pairs = stage(both.mapInArrow(tidy(_bounded(percent)), "a long, b long"), "near")
    if pairs.isEmpty():
        return pairs
    wanted = reps.join(_if_small(_in_pairs(pairs)), "doc", "left_semi").select("doc", "doc_id", "sign")
    wanted = _if_small(stage(wanted, "wanted"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    made = (
        docs.join(wanted, "doc_id", "left_semi")
        .mapInArrow(tidy(_sets(size)), f"doc_id {kind}, sign binary, whole binary")
        .join(wanted, ["doc_id", "sign"])
    )
    # rows of one id and one set are one node
    sets = stage(made.groupBy("doc").agg(F.first("whole").alias("whole")), "sets")
    both = pairs.join(sets.toDF("a", "whole_a"), "a").join(sets.toDF("b", "whole_b"), "b")
    return stage(both.mapInArrow(tidy(_verified(percent)), "a long, b long"), "similar")


def _level(position: Column, n: Column, percent: int) -> Column:
    """Shortest prefix, counted in shared shingles, that holds a position of a set of n."""
    need = F.floor((n * percent + 99) / 100).cast("int")
    return F.greatest(F.lit(1), position - (n - need) + 1).cast("int")


def _choose_levels(postings: DataFrame, percent: int) -> DataFrame:
    """Each document's l, the one of least estimated cost, and how much it can share.

    ``common`` counts the shingles of its longest prefix that are in another's longest
    prefix too, ``frequent`` those of them that are not rare. With what lies behind the
    prefix they are what it can share; a document that cannot share enough with anyone
    is left out. (A similar document of more shingles may hold others of the prefix
    behind its own, but never more than its need of shared shingles is greater.)
    """
    levels = range(1, MAX_LEVEL + 1)
    sums = postings.groupBy("doc").agg(
        F.max("most").alias("most"),
        F.max("n").alias("n"),
        F.sum("df").alias("weight"),
        F.count(F.lit(1)).alias("common"),
        F.count_if(F.col("df") > RARE).alias("frequent"),
        *[F.sum(F.when(F.col("level") <= i, F.col("df") - 1).otherwise(0)).alias(f"s{i}") for i in levels],
    )
    # a candidate shares l shingles, so look-ups / l bounds the candidates
    costs = [
        F.when(F.col("most") >= i, F.struct((F.col(f"s{i}") * (1 + VERIFY_COST / i)).alias("cost"), F.lit(i).alias("l")))
        for i in levels
    ]
    need = F.floor((F.col("n") * percent + 99) / 100)
    best = F.array_min(F.array_compact(F.array(*costs)))["l"]
    able = F.col("common") + _behind(F.col("n"), percent) >= need
    return sums.where(able).select("doc", "weight", "common", "frequent", best.alias("l"))


def _behind(n: Column, percent: int) -> Column:
    """How many shingles of a set of n its longest prefix leaves out."""
    need = F.floor((n * percent + 99) / 100)
    return need - F.least(F.lit(MAX_LEVEL), need)


def _can_be_similar(shared_a: Column, shared_b: Column, n_a: Column, n_b: Column, percent: int) -> Column:
    """Whether two sets may overlap enough, given what the longest prefix of each can share.

    A shingle of both lies in both prefixes or behind the one that ends first in the
    order. Which one that is does not show in the counts, so the longer rest is taken.
    """
    most = F.least(shared_a, shared_b) + _behind(F.greatest(n_a, n_b), percent)
    return (100 + percent) * most >= percent * (n_a + n_b)


def _leader_pairs(postings: DataFrame, labels: DataFrame, number: int, percent: int) -> DataFrame:
    """Documents with the leaders that their shingles propose, where not yet in one component.

    The leader of a shingle is, among its documents of about one size, first the one
    whose shingles are the most frequent, as a document is that others were copied
    from; in later rounds the first by a hash.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / np.log(100 / percent) + number / LEADER_ROUNDS)
    rows = postings.join(labels, "doc").withColumn("band", band)
    place = -F.col("weight") if number == 0 else F.xxhash64(F.col("doc"), F.lit(number))
    named = {"doc": "d", "comp": "c", "common": "a", "n": "m"}
    first = F.struct(place.alias("h"), *[F.col(c).alias(name) for c, name in named.items()])
    lead = rows.groupBy("token", "band").agg(F.min(first).alias("first")).select("token", "band", "first.*").drop("h")
    able = _can_be_similar(F.col("common"), F.col("a"), F.col("n"), F.col("m"), percent)
    met = rows.join(lead, ["token", "band"]).where((F.col("comp") != F.col("c")) & able)
    shared = met.groupBy("doc", "d").agg(F.count(F.lit(1)).alias("hits"), F.max("l").alias("l"))
    return shared.where("hits >= l").select(F.col("doc").alias("a"), F.col("d").alias("b"))


def _cross_pairs(postings: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """All candidate pairs across components.

    Pairs that share a rare shingle are met by those alone: each brings together few
    documents. All others share frequent shingles only, so whatever else a document
    holds is unlike the other's, and few documents can still be similar to one; of
    those the smaller asks for as many shared shingles as it chose.
    """
    rows = postings.join(labels, "doc")
    mixed = rows.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("token")
    rows = stage(rows.join(mixed, "token").select("token", "doc", "comp", "n", "df", "level", "l", "common", "frequent"), "mixed")

    def side(name: str, of: DataFrame) -> DataFrame:
        return of.select("token", *[F.col(c).alias(f"{name}_{c}") for c in of.columns if c != "token"])

    smaller = (F.col("x_n") < F.col("y_n")) | ((F.col("x_n") == F.col("y_n")) & (F.col("x_doc") < F.col("y_doc")))
    apart = smaller & (F.col("x_comp") != F.col("y_comp"))
    far = 100 * (F.col("frequent") + _behind(F.col("n"), percent)) >= percent * F.col("n")
    rare, often = rows.where(F.col("df") <= RARE), rows.where((F.col("df") > RARE) & far)
    near = _can_be_similar(F.col("x_common"), F.col("y_common"), F.col("x_n"), F.col("y_n"), percent)
    by_rare = side("x", rare).join(side("y", rare), "token").where(apart & near).select("x_doc", "y_doc")
    near = _can_be_similar(F.col("x_frequent"), F.col("y_frequent"), F.col("x_n"), F.col("y_n"), percent)
    met = side("x", often.where("level <= l")).join(side("y", often), "token").where(
        apart & near & (F.col("y_level") <= F.col("x_l"))
    )
    shared = met.groupBy("x_doc", "y_doc").agg(F.count(F.lit(1)).alias("hits"), F.max("x_l").alias("l"))
    by_often = shared.where("hits >= l").select("x_doc", "y_doc")
    return by_rare.union(by_often).distinct().toDF("a", "b")


@dataclass
class Found:
    """Rows' sketches, the classes of equal sets, and links between classes with the
    least class of each component that they make."""

    sketches: DataFrame
    classes: DataFrame
    links: DataFrame
    labels: DataFrame

    def named(self) -> DataFrame:
        """Of each class, by its sign, the first class of its component by id and sign."""
        met = stage(self.classes.join(self.labels, "node"), "met")
        least = stage(met.groupBy("label").agg(F.min(F.struct("rep", "sign")).alias("least")), "least")
        of = met.join(_if_small(least), "label").select("sign", "least")
        own = F.struct("rep", "sign")
        return self.classes.join(of, "sign", "left").select("sign", F.coalesce("least", own).alias("least"))


def _search(rows: DataFrame, size: int, percent: int) -> Found:
    """All links between texts. A class of equal sets goes by the number of one of its rows."""
    spark = rows.sparkSession
    ship(spark)
    small_batches(spark)
    kind = rows.schema["doc_id"].dataType.simpleString()
    shared = spark.sparkContext.broadcast(order_of(rows, size))
    columns = f"doc_id {kind}, n long, sign binary, cells binary, tokens array<long>"
    made = rows.mapInArrow(tidy(_sketches(shared, size, percent)), columns)
    sketches = stage(made.withColumn("row", F.monotonically_increasing_id()), "sketches")
    known = sketches.where("sign IS NOT NULL AND doc_id IS NOT NULL").select("sign", "doc_id", "row")
    first = known.groupBy("sign").agg(F.min(F.struct("doc_id", "row")).alias("first"))
    classes = stage(first.select("sign", F.col("first.doc_id").alias("rep"), F.col("first.row").alias("node")), "classes")
    # a set too small to differ and still be similar equals every set it is linked with
    least = next(n for n in range(1, 10_000) if similar(n, n, n + 1, percent))
    others = stage(known.join(classes, "sign").where("row <> node").select("row"), "others")
    alike = sketches.where((F.col("n") >= least) & F.col("doc_id").isNotNull())
    reps = alike.join(_if_small(others), "row", "left_anti").withColumnRenamed("row", "doc")
    if not fits_broadcast(others):
        reps = stage(reps, "reps")
    most = F.least(F.lit(MAX_LEVEL), F.floor((F.col("n") * percent + 99) / 100)).cast("int")
    postings = reps.select("doc", "n", most.alias("most"), F.posexplode("tokens").alias("at", "token"))
    postings = postings.withColumn("level", _level(F.col("at"), F.col("n"), percent)).drop("at")
    # one shuffle for both: the counts lie where their rows do
    postings = postings.repartition("token")
    common = postings.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    postings = stage(postings.join(common.hint("merge"), "token"), "postings")
    chosen = postings.join(_choose_levels(postings, percent), "doc")
    postings = stage(chosen.select("token", "doc", "n", "df", "level", "weight", "common", "frequent", "l"), "postings")
    alone = postings.select("doc").distinct().withColumn("comp", F.col("doc"))
    links = spark.createDataFrame([], "a long, b long")
    merged = spark.createDataFrame([], "node long, label long")
    labels = stage(alone, "labels")
    for number in range(LEADER_ROUNDS + 1):
        last = number == LEADER_ROUNDS
        pairs = _cross_pairs(postings, labels, percent) if last else _leader_pairs(postings, labels, number, percent)
        found = _links(rows, reps, pairs, size, percent)
        if not found.isEmpty():
            links = links.union(found)
            merged = components(links)
            comp = merged.toDF("doc", "label")
            labels = stage(alone.join(comp, "doc", "left").select("doc", F.coalesce("label", "comp").alias("comp")), "labels")
    return Found(sketches, classes, links, merged)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per row its id, the size of its set, and the least id it is linked with."""
    found = _search(texts(docs, id_col, text_col), size, percent)
    # rows of one id with different sets link their classes
    held = found.sketches.where("doc_id IS NOT NULL").join(found.classes, "sign").select("doc_id", "node")
    several = held.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b")
    several = stage(several.select("doc_id", "a"), "several")
    if not several.isEmpty():
        by_id = held.join(_if_small(several), "doc_id").select("a", F.col("node").alias("b")).where("a <> b").distinct()
        found.labels = components(found.links.union(by_id))
    named = found.named().select("sign", F.col("least.rep").alias("comp"))
    return found.sketches.select("doc_id", "n", "sign").join(named, "sign", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of every group of linked texts, one of least id.

    Rows without an id stay. Rows that share an id are judged each by its text, so one
    with another text stays; of those with equal sets the one of least digest does.
    """
    rows = texts(docs, id_col, text_col)
    found = _search(rows, size, percent)
    known = found.sketches.where("doc_id IS NOT NULL").select("doc_id", "sign")
    again = stage(known.groupBy("doc_id").count().where("count > 1").select("doc_id"), "again")
    judged = known.join(found.named(), "sign", "left")
    first = (F.col("doc_id") == F.col("least.rep")) & (F.col("sign") == F.col("least.sign"))
    judged = stage(judged.withColumn("stays", F.coalesce(first, F.lit(True))).select("doc_id", "sign", "stays"), "judged")
    out = stage(judged.where("NOT stays").select(F.col("doc_id").alias(id_col)).distinct(), "out")
    if again.isEmpty():
        return docs.join(_if_small(out), id_col, "left_anti").select(*docs.columns)
    again, by = _if_small(again), again.withColumnRenamed("doc_id", id_col)
    once = docs.join(_if_small(out), id_col, "left_anti").join(_if_small(by), id_col, "left_anti")
    digest = F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    signed = (
        rows.join(again, "doc_id", "left_semi")
        .withColumn("digest", F.md5(F.coalesce("text", F.lit("")).cast("binary")))
        .mapInArrow(tidy(_sets(size, False)), f"doc_id {kind}, sign binary, digest string")
    )
    least = signed.groupBy("doc_id", "sign").agg(F.min("digest").alias("digest"))
    stay = judged.where("stays").select("doc_id", "sign").distinct()
    kept = least.alias("x").join(stay.alias("y"), F.expr("x.doc_id = y.doc_id AND x.sign <=> y.sign"), "left_semi")
    kept = stage(kept.select(F.col("doc_id").alias(id_col), F.col("digest").alias("__digest")), "kept")
    several = docs.withColumn("__digest", digest).join(_if_small(kept), [id_col, "__digest"], "left_semi")
    return once.select(*docs.columns).unionByName(several.dropDuplicates([id_col, "__digest"]).select(*docs.columns))
