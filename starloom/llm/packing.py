"""Best-fit packing of token sequences with a bounded number of open bins.

Documents become ids, a closing id 0, and pieces of at most ``CAPACITY`` tokens. A
packer takes pieces one by one: each goes to the open bin whose free space is the
least that suffices; if none does and too many bins are open, the fullest closes.
Open bins are kept by free space, and a bitset says which free spaces occur, so both
choices are one bit operation.

Each task packs its own share of the pieces. Bins still open at its end are not
closed but unpacked, and their pieces packed again by fewer tasks, until one task
holds what is left. Only lengths are moved, never texts or ids.

A NULL text counts as empty and becomes the closing id alone. Repeated rows and NULL
ids are packed like any other; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import math
import re
import sys
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from starloom.llm.tables import ship, small_batches, steps, texts, texts_of, tidy
from starloom.session import stage

CAPACITY = 2048
OPEN_BINS = 1024
#: Pieces for one packing task.
PIECES_PER_TASK = 250_000
#: Words whose ids a worker keeps.
KEPT_WORDS = 100_000
CLOSING = np.zeros(1, "<u4").tobytes()
#: Fixed value: how a byte-level vocabulary of this kind splits text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# a space after other white space does not begin a word of its own
_ENTANGLED = re.compile(r"\s ")


def byte_symbols() -> dict[str, int]:
    """The letters that stand for bytes: printable ones for themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids of a byte-level BPE vocabulary, word by word.

    Words begin at single spaces, so each is encoded by itself, and frequent words
    are encoded once. Texts in which white space meets a space are encoded whole.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        symbols = byte_symbols()
        ranks = {bytes(symbols[c] for c in token): i for token, i in spec["model"]["vocab"].items()}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any("<|" not in token for token in special):
            raise ValueError("special tokens are expected to look like <|name|>")
        for token in special:
            ranks.pop(token.encode(), None)
        self.coding = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.known: dict[str, bytes] = {}

    def _encode(self, text: str) -> bytes:
        if "<|" in text:
            return np.array(self.coding.encode(text, allowed_special="all"), "<u4").tobytes()
        ids = array("I", self.coding.encode_ordinary(text))
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def ids(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if _ENTANGLED.search(text):
            return self._encode(text)
        first, *words = text.split(" ")
        known = self.known
        parts = list(map(known.get, words))
        if None in parts:
            for i, part in enumerate(parts):
                if part is None:
                    parts[i] = made = self._encode(" " + words[i])
                    if len(known) < KEPT_WORDS and len(words[i]) < 64:
                        known[words[i]] = made
        return self._encode(first) + b"".join(parts) if first else b"".join(parts)


@lru_cache(2)
def encoder(path: str) -> Encoder:
    """One encoder per worker and vocabulary."""
    return Encoder(path)


def cut(ids: bytes, capacity: int = CAPACITY) -> list[tuple[int, int, int, int]]:
    """Pieces of a document with its closing id: number, start, length, crc32."""
    data = ids + CLOSING
    n = len(data) // 4
    first = n if n <= capacity else n % capacity or capacity
    edges = [0, *range(first, n + 1, capacity)]
    return [
        (i, a, b - a, zlib.crc32(data[4 * a : 4 * b])) for i, (a, b) in enumerate(zip(edges, edges[1:]))
    ]


def pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """The pieces of all documents, without their ids."""
    ship(docs.sparkSession)
    small_batches(docs.sparkSession)
    rows = texts(docs, id_col, text_col)
    added = T.StructType.fromDDL("piece int, start long, length long, ids_crc32 long")
    schema = T.StructType([rows.schema["doc_id"], *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [f.type for f in to_arrow_schema(schema)]
        encode = encoder(path).ids
        for batch in batches:
            for part in steps(batch):
                each = [cut(encode(t), capacity) for t in texts_of(part)]
                owner = np.repeat(np.arange(len(each)), [len(x) for x in each])
                columns = zip(*[p for x in each for p in x])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(owner)), *[pa.array(c, k) for c, k in zip(columns, kinds[1:])]],
                    schema.names,
                )

    return rows.mapInArrow(tidy(run), schema)


class Packer:
    """Open bins by free space. A bin is the list of its items' numbers and lengths."""

    def __init__(self, capacity: int = CAPACITY, most: int = OPEN_BINS):
        self.capacity, self.most, self.n_open, self.bits = capacity, most, 0, 0
        self.bins: list[list[list]] = [[] for _ in range(capacity + 1)]

    def _take(self, free: int) -> list:
        found = self.bins[free].pop()
        if not self.bins[free]:
            self.bits ^= 1 << free
        self.n_open -= 1
        return found

    def add(self, item, length: int) -> list[list]:
        """Place an item; the bins that close for it."""
        closed, free, target = [], self.capacity, []
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            target = self._take(free)
        elif self.n_open == self.most:
            closed.append(self._take((self.bits & -self.bits).bit_length() - 1))
        target.append((item, length))
        free -= length
        if free == 0:
            closed.append(target)
        else:
            self.bins[free].append(target)
            self.bits |= 1 << free
            self.n_open += 1
        return closed

    def rest(self) -> Iterator[list]:
        for same in self.bins:
            yield from same


def _packed(schema: T.StructType, level: int, last: bool, capacity: int, most: int):
    """Packing of one task's pieces; the last level closes every bin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [f.type for f in to_arrow_schema(schema)]
        base = (level << 56) + (TaskContext.get().partitionId() << 32)
        packer, made = Packer(capacity, most), 0
        out: list[tuple] = []

        def close(found: list, number: int | None) -> None:
            offset = 0
            for row, length in found:
                out.append((*row, number, offset if number is not None else None))
                offset += length

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out)) or [[] for _ in kinds]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], schema.names)

        for batch in batches:
            names = schema.names[:-2]
            length = names.index("length")
            for row in zip(*[batch.column(c).to_pylist() for c in names]):
                for found in packer.add(row, row[length]):
                    close(found, base + made)
                    made += 1
            if len(out) > 50_000:
                yield flush()
        for found in packer.rest():
            close(found, base + made if last else None)
            made += 1
            if len(out) > 50_000:
                yield flush()
        yield flush()

    return run


def pack(rows: DataFrame, capacity: int = CAPACITY, most: int = OPEN_BINS, per_task: int = PIECES_PER_TASK) -> DataFrame:
    """Each piece with the sequence that holds it and its place there.

    ``rows`` has ``length``, the other columns pass through; lengths are at most
    ``capacity``. The pieces are taken in the order of a hash of theirs.
    """
    ship(rows.sparkSession)
    left, done, level = stage(rows, "pieces"), [], 0
    schema = T.StructType([*left.schema, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    columns = left.columns
    tasks = max(1, math.ceil(left.count() / per_task))
    while True:
        place = F.xxhash64(*columns)
        dealt = left.repartition(tasks, place).sortWithinPartitions(place, *columns)
        packed = stage(dealt.mapInArrow(tidy(_packed(schema, level, tasks == 1, capacity, most)), schema), "packed")
        done.append(packed.where("sequence_id IS NOT NULL"))
        if tasks == 1:
            return reduce(DataFrame.unionByName, done)
        left = packed.where("sequence_id IS NULL").select(*columns)
        level += 1
        # fewer tasks each time, whatever is left
        tasks = min(max(1, tasks // 2), max(1, math.ceil(left.count() / per_task)))
