"""Nearest neighbours by inner product with a hash-prefix forest.

A vector's hash string in a tree is the side it lies on of that tree's random
hyperplanes, first plane first. A tree is the sorted array of all its strings, so the
vectors that share a prefix stand together. A query descends in every tree to its
longest match and then ascends in all trees at once until the prefixes hold enough
candidates for a first answer. From the score of the last of these that matters it
follows how likely a neighbour that is as near shares a prefix of some length in some
tree; the query ascends, a few bits at a time, until that is likely enough. Nearer
candidates met on the way end the ascent earlier.

For inner products, candidates get one more coordinate that makes them equally long,
so the nearest in angle are the largest products. Scores are taken from the original
vectors in double precision.

Rows are indexed in blocks of bounded size, dealt by id and vector, each with its forest,
and queries come in chunks of bounded size; every chunk meets every block, and a query's
answers from all blocks are merged. A block holds its share of a query's neighbours, so
it is enough that those near enough to be among them are met. All rows are indexed, so
only the forest costs recall.

Vectors that are NULL, empty, zero or hold NULL or non-finite components take no
part, nor do those of another length than most, nor rows without id. Rows that share
an id are candidates each, but one query, by their least vector, and never their own
neighbours. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from starloom.llm.tables import ship
from starloom.session import stage

TREES, BITS, SEED = 256, 24, 11
#: First answer: so many candidates for each neighbour wanted.
FIRST = 8
#: How likely a neighbour as near as the last one wanted of the first answer is to be met.
LIKELY = 0.85
#: Bits by which a query ascends before it looks again at what it has met.
STEP = 2
#: Standard deviations by which a block may hold more of the neighbours than its share.
MARGIN = 0.5
BLOCK_ROWS, CHUNK_QUERIES = 8_192, 8_192


def planes(dim: int, seed: int = SEED) -> np.ndarray:
    """Normals of all trees' hyperplanes, for vectors with one coordinate more."""
    return np.random.default_rng(seed).normal(size=(dim + 1, TREES * BITS)).astype(np.float32)


def _strings(vectors: np.ndarray, normals: np.ndarray) -> np.ndarray:
    """Hash strings as numbers, their first bit highest: trees by vectors."""
    weight = np.uint32(1) << np.arange(BITS - 1, -1, -1, dtype=np.uint32)
    found, flat = np.empty((TREES, len(vectors)), np.uint32), vectors.astype(np.float32)
    for t in range(TREES):
        found[t] = (flat @ normals[:, t * BITS : (t + 1) * BITS] > 0) @ weight
    return found


def longer(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Vectors over ``longest`` with the coordinate that gives all of them length 1."""
    scaled = vectors / longest
    rest = np.sqrt(np.maximum(0.0, 1.0 - (scaled**2).sum(1)))
    return np.concatenate([scaled, rest[:, None]], 1)


def depth_for(cosine: float) -> int:
    """Longest prefix that some tree shares with so near a vector often enough."""
    same = 1 - math.acos(max(-1.0, min(1.0, cosine))) / math.pi
    if same >= 1:
        return BITS
    if same <= 0:
        return 0
    once = 1 - (1 - LIKELY) ** (1 / TREES)
    return max(0, min(BITS, int(math.log(once) / math.log(same))))


@dataclass
class Forest:
    """The sorted strings of one block, and for each place the vector it stands for."""

    strings: np.ndarray
    places: np.ndarray

    @staticmethod
    def of(strings: np.ndarray) -> Forest:
        places = np.argsort(strings, axis=1, kind="stable")
        return Forest(np.take_along_axis(strings, places, 1), places)

    def ranges(self, strings: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Per tree and query, where the vectors that share a prefix of ``length`` begin and end."""
        rest = BITS - length
        low = (strings >> np.uint32(rest)) << np.uint32(rest)
        high = low + np.uint32((1 << rest) - 1)
        begin, end = np.empty(strings.shape, np.int64), np.empty(strings.shape, np.int64)
        for t in range(TREES):
            begin[t] = np.searchsorted(self.strings[t], low[t], "left")
            end[t] = np.searchsorted(self.strings[t], high[t], "right")
        return begin, end

    def candidates(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Vectors that share the prefix of one query's ranges in some tree."""
        n, size = self.strings.shape[1], end - begin
        first = begin + n * np.arange(TREES) - (np.cumsum(size) - size)
        met = np.zeros(n, bool)
        met[self.places.ravel()[np.repeat(first, size) + np.arange(size.sum())]] = True
        return np.flatnonzero(met)

    def longest(self, strings: np.ndarray, enough: int) -> np.ndarray:
        """Per query the longest prefix that ``enough`` vectors share in all trees together, 0 if none."""
        found, open_ = np.zeros(strings.shape[1], np.int64), np.arange(strings.shape[1])
        for length in range(BITS, 0, -1):
            begin, end = self.ranges(strings[:, open_], length)
            reached = (end - begin).sum(0) >= enough
            found[open_[reached]] = length
            open_ = open_[~reached]
            if not len(open_):
                break
        return found


def nearest(
    ids: np.ndarray,
    vectors: np.ndarray,
    query_ids: np.ndarray,
    queries: np.ndarray,
    k: int,
    longest: float,
    share: float = 1.0,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per query its nearest of the vectors, other than itself: ids and scores.

    ``share`` is the part of all rows that the vectors are. So many of a query's
    neighbours are expected among them, and some more; the last of these, not the k-th
    of this part, says how near a vector must be to matter.
    """
    normals = planes(vectors.shape[1])
    forest = Forest.of(_strings(longer(vectors, longest), normals))
    size = np.sqrt((queries**2).sum(1))
    flat = np.concatenate([queries / size[:, None], np.zeros((len(queries), 1))], 1)
    strings = _strings(flat, normals)
    rough, expected = vectors.astype(np.float32), min(k, math.ceil(k * share + MARGIN * math.sqrt(k * share)))

    def best(i: int, met: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        met = met[ids[met] != query_ids[i]]
        if len(met) > 2 * k:
            # single precision tells which can be among the best at all
            near = rough[met] @ queries[i].astype(np.float32)
            met = met[near >= np.partition(near, len(near) - k)[len(near) - k] - 1e-4 * size[i] * longest]
        score = (vectors[met] * queries[i]).sum(1)
        first = np.lexsort((ids[met], -score))[:k]
        return met[first], score[first]

    def answers(at: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for some in np.array_split(at, math.ceil(len(at) / 512)):
            begin, end = forest.ranges(strings[:, some], length)
            for j, i in enumerate(some.tolist()):
                yield i, *best(i, forest.candidates(begin[:, j], end[:, j]))

    def by_length(lengths: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for length in np.unique(lengths):
            yield from answers(at[lengths == length], int(length))

    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    # a query that is a row itself shares all of its strings
    length = forest.longest(strings, FIRST * k + TREES)
    open_ = np.arange(len(queries))
    while len(open_):
        wanted = length.copy()
        for i, met, score in by_length(length[open_], open_):
            held[i] = met, score
            if len(score) < min(k, len(ids) - 1):
                wanted[i] = 0
            elif length[i]:
                last = float(score[min(expected, len(score)) - 1]) if len(score) else 0.0
                wanted[i] = min(length[i], depth_for(last / (float(size[i]) * longest)))
        # nearer neighbours met on the way make longer prefixes do, so the ascent goes in steps
        open_ = open_[wanted[open_] < length[open_]]
        length[open_] = np.maximum(wanted[open_], length[open_] - STEP)
    for i, own in enumerate(query_ids):
        met, score = held[i]
        yield int(own), ids[met], score


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    column = table.column("vector").combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return table.column("id").to_numpy(), flat.reshape(len(table), -1)


def search(
    rows: DataFrame,
    is_query: Column,
    k: int,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block_rows: int = BLOCK_ROWS,
    chunk_queries: int = CHUNK_QUERIES,
) -> DataFrame:
    """``query_id``, ``rank``, ``id`` and ``score`` of each query's ``k`` nearest found."""
    ship(rows.sparkSession)
    vector = F.col(vector_col).cast("array<double>")
    all_ = rows.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), vector.alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks")
    )
    all_ = all_.where(_usable(F.col("vector")))
    schema = "query_id long, id long, score double"
    squares = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    sizes = (
        all_.groupBy(F.size("vector").alias("dim"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("asks").cast("long")).alias("asking"), F.sqrt(F.max(squares)).alias("longest"))
        .orderBy(F.desc("n"), "dim")
        .first()
    )
    if sizes is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, id long, score double")
    n_rows, longest, blocks = sizes["n"], float(sizes["longest"]), math.ceil(sizes["n"] / block_rows)
    chunks = max(1, math.ceil(sizes["asking"] / chunk_queries))
    same = all_.where(F.size("vector") == sizes["dim"])

    def dealt(df: DataFrame, own: str, other: str, n_own: int, n_other: int) -> DataFrame:
        """A row's own number by hash, next to every number of the other side."""
        return df.select(
            "id",
            "vector",
            F.pmod(F.xxhash64("id", "vector", F.lit(own)), F.lit(n_own)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))).alias(other),
        )

    asking = same.where("asks").groupBy("id").agg(F.min("vector").alias("vector"))
    index = dealt(same, "block", "chunk", blocks, chunks)
    queries = dealt(asking, "chunk", "block", chunks, blocks)

    def found(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(left) and len(right):
            (ids, vectors), (query_ids, wanted) = _matrix(left), _matrix(right)
            for own, met, score in nearest(ids, vectors, query_ids, wanted, k, longest, len(ids) / n_rows):
                out.append((np.full(len(met), own), met, score))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0)] * 3
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("query_id", "id", "score"), columns, (pa.int64(), pa.int64(), pa.float64()))})

    keys = ["block", "chunk"]
    met = stage(index.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(found, schema), "neighbours")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    ranked = met.withColumn("rank", place).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "score")
