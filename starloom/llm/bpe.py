"""BPE encoding and decoding with a minimal acyclic transducer of frequent words.

Frequent words are counted over the whole corpus and compiled, with the ids that the
merges give them, into a minimal acyclic automaton: words share beginnings and
endings, and every edge carries how many words are passed over by taking it, so the
sum along a word's path is its number, which leads to its ids. The automaton is a
few flat arrays in one file that each worker maps into memory. All other words go
through the vocabulary's merges, one best pair at a time. What the transducer holds
changes the time taken, never an id.

NULL texts count as empty: no ids, and an empty text decoded. Rows are kept apart
even if their ids are equal or NULL. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import re
import tempfile
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from starloom.llm.language import Table
from starloom.llm.packing import byte_symbols
from starloom.llm.tables import frequent, map_texts, ship, steps, texts, texts_of
from starloom.session import stage

#: Words in the transducer.
LEXICON_WORDS = 32_768
#: Words with their ids that a worker keeps.
KEPT_WORDS = 300_000
#: Words of more bytes are merged one by one, by a heap of their pairs.
LONG_WORD = 512
# Texts of these letters need no normalising but small letters, and split in the same way.
_LATIN = re.compile("[\\x00-\\x7fÀ-ÖØ-öø-ÿ]*")
_LATIN_WORDS = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^ \\t\\n\\x0b\\f\\ra-zß-öø-ÿ0-9]+"
)
_NEVER = np.iinfo(np.int32).max
_DTYPES = (("keys", np.int64), ("targets", np.int32), ("passed", np.int32), ("final", np.uint8), ("starts", np.int32), ("ids", np.uint32))


def compile_lexicon(words: dict[bytes, list[int]]) -> bytes:
    """The minimal automaton of ``words`` and their ids as one block of bytes.

    Words come in order; states that no later word can change are merged with an
    equal one, if there is any, as soon as the next word parts from them.
    """
    ordered = sorted(words)
    finals, edges = [False], [{}]
    same: dict[tuple, int] = {}
    path: list[tuple[int, int]] = []  # (state, byte) of the last word

    def freeze(down_to: int) -> None:
        while len(path) > down_to:
            state, byte = path.pop()
            child = edges[state][byte]
            known = same.setdefault((finals[child], tuple(edges[child].items())), child)
            edges[state][byte] = known

    last = b""
    for word in ordered:
        common = next((i for i, (a, b) in enumerate(zip(word, last)) if a != b), min(len(word), len(last)))
        freeze(common)
        state = edges[path[-1][0]][path[-1][1]] if path else 0
        for byte in word[common:]:
            finals.append(False)
            edges.append({})
            edges[state][byte] = len(edges) - 1
            path.append((state, byte))
            state = len(edges) - 1
        finals[state] = True
        last = word
    freeze(0)
    number, order = {0: 0}, [0]
    for state in order:
        for child in edges[state].values():
            if child not in number:
                number[child] = len(order)
                order.append(child)
    below: dict[int, int] = {}

    def count(root: int) -> None:
        todo = [root]
        while todo:
            state = todo[-1]
            open_ = [c for c in edges[state].values() if c not in below]
            if open_:
                todo.extend(open_)
            else:
                below[state] = finals[state] + sum(below[c] for c in edges[state].values())
                todo.pop()

    count(0)
    keys, targets, passed = [], [], []
    for state in order:
        before = int(finals[state])
        for byte in sorted(edges[state]):
            child = edges[state][byte]
            keys.append(number[state] * 256 + byte)
            targets.append(number[child])
            passed.append(before)
            before += below[child]
    ids = [words[w] for w in ordered]
    starts = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
    arrays = (keys, targets, passed, [finals[s] for s in order], starts, [i for x in ids for i in x])
    blocks = [np.asarray(a, dtype=kind).tobytes() for a, (_, kind) in zip(arrays, _DTYPES)]
    return np.array([len(b) for b in blocks], np.int64).tobytes() + b"".join(blocks)


class Lexicon:
    """A compiled automaton, mapped from a file that only this process sees."""

    def __init__(self, block: bytes):
        with tempfile.TemporaryFile() as file:
            file.write(block)
            file.flush()
            self.map = mmap.mmap(file.fileno(), len(block), access=mmap.ACCESS_READ)
        sizes = np.frombuffer(self.map, np.int64, len(_DTYPES))
        at = 8 * len(_DTYPES)
        for (name, kind), size in zip(_DTYPES, sizes):
            setattr(self, name, np.frombuffer(self.map, kind, int(size) // np.dtype(kind).itemsize, at))
            at += int(size)

    @property
    def n_states(self) -> int:
        return len(self.final)

    def find(self, words: list[bytes]) -> np.ndarray:
        """Number of each word, -1 for words that are not in the lexicon."""
        size = np.array([len(w) for w in words], np.int64)
        found = np.zeros(len(words), np.int64)
        if not len(words) or not len(self.keys):
            return np.full(len(words), -1)
        flat = np.frombuffer(b"".join(words) + b"\0", np.uint8)
        start = np.cumsum(size) - size
        state, alive = np.zeros(len(words), np.int64), np.ones(len(words), bool)
        for i in range(int(size.max(initial=0))):
            go = np.flatnonzero(alive & (size > i))
            if not len(go):
                break
            key = state[go] * 256 + flat[start[go] + i]
            edge = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = self.keys[edge] == key
            alive[go[~ok]] = False
            go, edge = go[ok], edge[ok]
            state[go] = self.targets[edge]
            found[go] += self.passed[edge]
        return np.where(alive & (self.final[state] == 1), found, -1)

    def ids_of(self, number: int) -> bytes:
        return self.ids[self.starts[number] : self.starts[number + 1]].astype("<u4").tobytes()


class Coding:
    """A word-end BPE vocabulary: its splitting, merges, special tokens and decoding."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.end, self.vocabulary = model["end_of_word_suffix"], model["vocab"]
        ids = [(self.vocabulary[a], self.vocabulary[b], self.vocabulary[a + b]) for a, b in model["merges"]]
        left, right, joined = np.array(ids, np.int64).reshape(-1, 3).T
        keys = (left << 32 | right).astype(np.uint64)
        # a pair listed twice has the rank of its last place
        _, last = np.unique(keys[::-1], return_index=True)
        place = len(keys) - 1 - last
        self.pairs = Table(keys[place], np.stack([place, joined[place]], 1).astype(np.int32))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special = re.compile("|".join(f"({re.escape(t)})" for t in self.special) or r"(?!)")
        letters = {b: c for c, b in byte_symbols().items()}
        self.inner = np.array([self.vocabulary[letters[b]] for b in range(256)], np.int32)
        self.last = np.array([self.vocabulary[letters[b] + self.end] for b in range(256)], np.int32)
        self.bytes_of = byte_symbols()
        own = Tokenizer.from_file(path)
        self.normalize, self.split = own.normalizer.normalize_str, own.pre_tokenizer.pre_tokenize_str
        self.tokens = {i: t for t, i in self.vocabulary.items()} | {i: t for t, i in self.special.items()}

    def words(self, text: str) -> list[bytes | int]:
        """Words in bytes, and ids of special tokens, of a text without spaces."""
        if "<|" not in text and _LATIN.fullmatch(text):
            return [w.encode() for w in _LATIN_WORDS.findall(text.lower())]
        out: list[bytes | int] = []
        for part in self._special.split(text) if "<|" in text else (text,):
            if part in self.special:
                out.append(self.special[part])
            elif part:
                out.extend(self.as_bytes(word) for word, _ in self.split(self.normalize(part)))
        return out

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word: of all neighbours the pair of least rank, the first of equals, is
        joined, until no pair is left. Words of like length take each step together, a long
        word alone, in a time that hardly grows faster than its length."""
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(words)
        order = sorted((i for i in range(len(words)) if len(words[i]) <= LONG_WORD), key=lambda i: len(words[i]))
        for i in range(len(words)):
            if len(words[i]) > LONG_WORD:
                out[i] = self._merged_alone(words[i])
        at = 0
        while at < len(order):
            # about as many letters each time, however long the words
            n = max(1, min(4096, 65_536 // max(1, len(words[order[min(at + 4095, len(order) - 1)]]))))
            some = order[at : at + n]
            for i, ids in zip(some, self._merged([words[i] for i in some])):
                out[i] = ids
            at += n
        return out

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; negative ids stand for no letter."""
        found = self._pair(left.ravel(), right.ravel())
        rank = np.where(found == 0, _NEVER, self.pairs.rows[found, 0]).reshape(left.shape)
        return np.where((left < 0) | (right < 0), _NEVER, rank)

    def _pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return self.pairs.find((left.astype(np.int64) << 32 | right).astype(np.uint64))

    def _merged(self, words: list[bytes]) -> list[np.ndarray]:
        size = np.array([len(w) for w in words])
        width = int(size.max())
        chars = np.frombuffer(b"".join([w.ljust(width, b"\0") for w in words]), np.uint8).reshape(-1, width)
        place = np.arange(width)[None, :]
        ids = np.where(place < size[:, None] - 1, self.inner[chars], self.last[chars])
        ids = np.where(place < size[:, None], ids, -1).astype(np.int32)
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(words)
        row = np.arange(len(words))
        rank = self._ranks(ids[:, :-1], ids[:, 1:])
        while len(row):
            best = rank.argmin(1) if rank.shape[1] else np.zeros(len(row), np.int64)
            go = rank[np.arange(len(row)), best] < _NEVER if rank.shape[1] else np.zeros(len(row), bool)
            for i in np.flatnonzero(~go):
                out[row[i]] = ids[i][ids[i] >= 0]
            row, ids, rank, best = row[go], ids[go], rank[go], best[go]
            if not len(row):
                break
            each = np.arange(len(row))
            ids[each, best] = self.pairs.rows[self._pair(ids[each, best], ids[each, best + 1]), 1]
            # what stands behind the pair moves up by one
            step = np.arange(ids.shape[1] - 1)[None, :]
            ids = np.take_along_axis(ids, step + (step > best[:, None]), 1)
            step = step[:, :-1]
            rank = np.take_along_axis(rank, step + (step >= best[:, None]), 1)
            before, after = best > 0, best < rank.shape[1]
            rank[each[before], best[before] - 1] = self._ranks(ids[each[before], best[before] - 1], ids[each[before], best[before]])
            rank[each[after], best[after]] = self._ranks(ids[each[after], best[after]], ids[each[after], best[after] + 1])
        return out

    def _merged_alone(self, word: bytes) -> np.ndarray:
        """Ids of one word: its pairs wait in a heap by rank and place, letters are a linked list."""
        letters = self.inner[np.frombuffer(word, np.uint8)]
        letters[-1] = self.last[word[-1]]
        first = self._ranks(letters[:-1], letters[1:])
        waiting = [(int(first[i]), int(i), int(letters[i]), int(letters[i + 1])) for i in np.flatnonzero(first < _NEVER)]
        heapq.heapify(waiting)
        ids: list[int | None] = letters.tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        ranks: dict[tuple[int, int], tuple[int, int] | None] = {}

        def rule(left: int, right: int) -> tuple[int, int] | None:
            if (left, right) not in ranks:
                found = self._pair(np.array([left]), np.array([right]))[0]
                ranks[left, right] = tuple(self.pairs.rows[found].tolist()) if found else None
            return ranks[left, right]

        while waiting:
            _, at, left, right = heapq.heappop(waiting)
            then = after[at]
            # a pair that one of its letters has left since waits in vain
            if ids[at] != left or then >= len(ids) or ids[then] != right:
                continue
            ids[at], ids[then] = rule(left, right)[1], None
            after[at] = after[then]
            if after[at] < len(ids):
                before[after[at]] = at
            for x, y in ((before[at], at), (at, after[at])):
                if x >= 0 and y < len(ids) and (found := rule(ids[x], ids[y])):
                    heapq.heappush(waiting, (found[0], x, ids[x], ids[y]))
        return np.array([i for i in ids if i is not None], np.int32)

    def as_bytes(self, word: str) -> bytes:
        return bytes(self.bytes_of[c] for c in word)

    def decode(self, ids: Iterable[int]) -> str:
        """The tokens in order with spaces between, as this kind of vocabulary decodes."""
        return " ".join(map(self.tokens.__getitem__, ids))


class Encoder:
    """Texts to ids: words met before, then the transducer, then the merges."""

    def __init__(self, coding: Coding, lexicon: Lexicon):
        self.coding, self.lexicon = coding, lexicon
        self.known: dict[str, bytes] = {}
        self.known_words: dict[bytes, bytes] = {}

    def _ids(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of words that are not kept: from the transducer, else from the merges."""
        numbers = self.lexicon.find(words)
        ids = {words[i]: self.lexicon.ids_of(numbers[i]) for i in np.flatnonzero(numbers >= 0)}
        unseen = [words[i] for i in np.flatnonzero(numbers < 0)]
        ids.update((w, x.astype("<u4").tobytes()) for w, x in zip(unseen, self.coding.merge(unseen)))
        if len(self.known_words) + len(ids) <= KEPT_WORDS:
            self.known_words.update((w, x) for w, x in ids.items() if len(w) < 64)
        return ids

    def _learn(self, new: list[str]) -> dict[str, bytes]:
        """Ids of words between spaces that are not known yet."""
        split = [self.coding.words(w) for w in new]
        known = self.known_words
        ids: dict[bytes | int, bytes] = self._ids(
            list(dict.fromkeys(w for ws in split for w in ws if isinstance(w, bytes) and w not in known))
        )
        ids.update((w, np.array([w], "<u4").tobytes()) for ws in split for w in ws if isinstance(w, int))
        made = {
            w: b"".join([ids[x] if x in ids else known[x] for x in ws]) for w, ws in zip(new, split)
        }
        room = KEPT_WORDS - len(self.known)
        if room >= len(made):
            self.known.update((w, x) for w, x in made.items() if len(w) < 64)
        return made

    def encode(self, texts_: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        words = [t.split(" ") for t in texts_]
        known = self.known
        parts = [list(map(known.get, ws)) for ws in words]
        new = dict.fromkeys(w for ws, ps in zip(words, parts) if None in ps for w, p in zip(ws, ps) if p is None)
        if new:
            made = self._learn(list(new))
            parts = [
                [made[w] if p is None else p for w, p in zip(ws, ps)] if None in ps else ps for ws, ps in zip(words, parts)
            ]
        return [b"".join(ps) for ps in parts]


@lru_cache(2)
def coding(path: str) -> Coding:
    """One vocabulary per worker and file."""
    return Coding(path)


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, block: bytes) -> Encoder:
    """One encoder per worker, vocabulary and lexicon."""
    key = (path, hashlib.sha256(block).hexdigest())
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(coding(path), Lexicon(block))
    return _ENCODERS[key]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words between white space, small letters.

    A task passes its counts on whenever it holds very many words, and keeps to
    itself a word it has met only once by then: the order of the most frequent
    words hardly depends on those.
    """
    seen: Counter[str] = Counter()

    def rows() -> pa.RecordBatch:
        kept = {w: n for w, n in seen.items() if n > 1 and len(w) < 64}
        seen.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(list(kept), pa.string()), pa.array(list(kept.values()), pa.int64())], ["word", "n"]
        )

    for batch in batches:
        for part in steps(batch):
            for text in texts_of(part):
                seen.update(text.lower().split())
            if len(seen) > 400_000:
                yield rows()
    yield rows()


def frequent_words(docs: DataFrame, most: int = LEXICON_WORDS, text_col: str = "text") -> list[str]:
    """About ``most`` of the most frequent words of all texts, by count, then by themselves.

    Only these reach the driver, however many tasks there are.
    """
    ship(docs.sparkSession)
    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(_count, "word string, n long")
    counted = stage(counted.groupBy("word").agg(F.sum("n").alias("n")), "words")
    top = counted.where(frequent(counted, most, "word")).collect()
    return [r["word"] for r in sorted(top, key=lambda r: (-r["n"], r["word"]))]


def lexicon_of(words: Iterable[str], path: str) -> bytes:
    """Words, as the vocabulary splits them, compiled with their ids."""
    own = coding(path)
    plain = sorted({w for text in words for w in own.words(text) if isinstance(w, bytes)})
    return compile_lexicon({w: ids.tolist() for w, ids in zip(plain, own.merge(plain))})


def encode_decode(docs: DataFrame, path: str, block: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's ids and the text they decode to, one pass and no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def make():
        own = encoder(path, shared.value)

        def columns(texts_: list[str]) -> list:
            ids = own.encode(texts_)
            numbers = [np.frombuffer(x, "<u4").tolist() for x in ids]
            return [numbers, [own.coding.decode(n) for n in numbers]]

        return columns

    return map_texts(texts(docs, id_col, text_col), make, "ids array<long>, decoded string", ["doc_id"])


def digests(docs: DataFrame, path: str, block: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Number of ids, and digests of the ids and of the decoded text."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def make():
        own = encoder(path, shared.value)

        def columns(texts_: list[str]) -> list:
            ids = own.encode(texts_)
            decoded = (own.coding.decode(np.frombuffer(x, "<u4").tolist()) for x in ids)
            return [
                [len(x) // 4 for x in ids],
                [hashlib.sha256(x).hexdigest() for x in ids],
                [hashlib.sha256(t.encode()).hexdigest() for t in decoded],
            ]

        return columns

    added = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_texts(texts(docs, id_col, text_col), make, added, ["doc_id"])
