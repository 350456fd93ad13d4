"""Language by prediction by partial matching over bytes.

Each language has a tree of byte contexts of up to ``ORDER`` bytes with the counts
of what followed. A byte costs -log2 of its share in the longest context that knows
it; every longer context that is known, but not with this byte, costs its escape
first (escape count: the number of different followers). Statistics are frozen
after training, so the cost of a byte depends on itself and the ORDER bytes before
it, and a text's code length is a sum of table look-ups. No exclusions are made.

Training takes a bounded sample of labelled documents per language. Scoring takes
every byte of every text, small letters for capitals.

A NULL text, or one without a letter, is ``und`` with score 0. Rows are kept apart
even if their ids are equal or NULL. Without any labelled text all are ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from starloom.llm.tables import map_texts, ship, steps, texts_of

ORDER = 3
#: Documents per language that training takes, chosen by a hash of their ids: the
#: expected number, which bounds the model whatever the size of the corpus.
TRAIN_DOCS = 300
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
_SEPARATOR = b"\n"


def _bytes_of(text: str) -> np.ndarray:
    """The text's bytes after as many separators as the longest context needs."""
    return np.frombuffer(_SEPARATOR * ORDER + text.lower().encode("utf-8", "replace"), np.uint8)


def _grams(data: np.ndarray, size: int) -> np.ndarray:
    """Keys of the last ``size`` bytes at every place that has ORDER bytes before it."""
    keys = np.zeros(max(0, len(data) - ORDER), np.uint64)
    for back in range(size):
        shift = np.uint64(8 * back)
        keys |= data[ORDER - back : len(data) - back].astype(np.uint64) << shift
    return keys


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of byte sequences of ORDER + 1 bytes per language."""
    for batch in batches:
        for part in steps(batch):
            by_lang: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(part.column("lang").to_pylist(), texts_of(part)):
                by_lang.setdefault(lang, []).append(_grams(_bytes_of(text), ORDER + 1))
            for lang, grams in by_lang.items():
                keys, n = np.unique(np.concatenate(grams), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys), pa.string()), pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64))],
                    ["lang", "gram", "n"],
                )


class Table:
    """Rows of numbers by key: open addressing with the keys' own slots, all in numpy."""

    def __init__(self, keys: np.ndarray, rows: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(2 * len(keys) + 1))))
        self.slots = np.zeros(1 << self.bits, np.int32)
        self.keys = np.concatenate([np.array([np.iinfo(np.uint64).max], np.uint64), keys])
        self.rows = np.concatenate([np.zeros((1, rows.shape[1]), rows.dtype), rows])
        place, at = np.arange(1, len(self.keys)), self._slot(keys)
        while len(place):
            free = self.slots[at] == 0
            self.slots[at[free]] = place[free]
            lost = self.slots[at] != place
            place, at = place[lost], (at[lost] + 1) & (len(self.slots) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys * np.uint64(0x9E3779B97F4A7C15)
        mixed >>= np.uint64(64 - self.bits)
        return mixed.view(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row numbers, 0 for keys that are not there."""
        at = self._slot(keys)
        found = self.slots[at]
        wrong = np.flatnonzero((self.keys[found] != keys) & (found != 0))
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & (len(self.slots) - 1)
            found[wrong] = self.slots[at[wrong]]
            wrong = wrong[(self.keys[found[wrong]] != keys[wrong]) & (found[wrong] != 0)]
        return found


@dataclass
class Model:
    """Per context length: costs of known sequences, and escapes of known contexts."""

    languages: list[str]
    costs: list[Table]
    escapes: list[Table]

    def _cost(self, keys: np.ndarray, order: int) -> np.ndarray:
        """Bits of the last byte of each key after ``order`` bytes, per language."""
        if order < 0:
            return np.full((len(keys), len(self.languages)), 8.0, np.float32)
        mask = np.uint64((1 << (8 * (order + 1))) - 1)
        keys = keys & mask
        found = self.costs[order].find(keys)
        cost = self.costs[order].rows[found]
        new = np.flatnonzero(found == 0)
        if len(new):
            context = self.escapes[order].find(keys[new] >> np.uint64(8))
            cost[new] = self.escapes[order].rows[context] + self._cost(keys[new], order - 1)
        return cost

    def lengths(self, texts: list[str]) -> np.ndarray:
        """Code length in bits of every text under every language."""
        data = [_bytes_of(t) for t in texts]
        size = np.array([len(d) - ORDER for d in data])
        total = np.zeros((len(texts), len(self.languages)))
        if not size.sum():
            return total
        cost = self._cost(np.concatenate([_grams(d, ORDER + 1) for d in data]), ORDER)
        some = np.flatnonzero(size)
        starts = (np.cumsum(size) - size)[some]
        total[some] = np.add.reduceat(cost, starts, axis=0, dtype=np.float64)
        return total

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language of each text, and how surely: the posterior per byte of evidence.

        The score compares the best code length with the others as probabilities.
        """
        bits = self.lengths(texts)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        best = bits.argmin(axis=1)
        odds = np.exp2(-np.minimum(bits - bits.min(axis=1, keepdims=True), 1000.0))
        score = 1 / odds.sum(axis=1)
        letters = np.array([bool(_LETTER.search(t)) for t in texts], bool)
        names = [self.languages[i] if ok else UNKNOWN for i, ok in zip(best, letters)]
        return names, np.where(letters, score, 0.0)


def build(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """Trees of all languages from their counts of the longest sequences."""
    languages = sorted(counts)
    costs, escapes = [], []
    for order in range(ORDER + 1):
        mask = np.uint64((1 << (8 * (order + 1))) - 1)
        seen, contexts = [], []
        for lang in languages:
            grams, n = counts[lang]
            keys, at = np.unique(grams & mask, return_inverse=True)
            each = np.bincount(at, weights=n, minlength=len(keys))
            before, of = np.unique(keys >> np.uint64(8), return_inverse=True)
            followers = np.bincount(of).astype(np.float64)
            total = np.bincount(of, weights=each) + followers
            seen.append((keys, -np.log2(each / total[of])))
            contexts.append((before, -np.log2(followers / total)))
        all_contexts = np.unique(np.concatenate([c for c, _ in contexts])) if languages else np.zeros(0, np.uint64)
        escape = np.zeros((len(all_contexts), len(languages)), np.float32)
        for i, (keys, bits) in enumerate(contexts):
            escape[np.searchsorted(all_contexts, keys), i] = bits
        escapes.append(Table(all_contexts, escape))
        all_keys = np.unique(np.concatenate([k for k, _ in seen])) if languages else np.zeros(0, np.uint64)
        shorter = Model(languages, costs, escapes)
        context = escapes[order].rows[escapes[order].find(all_keys >> np.uint64(8))]
        cost = context + shorter._cost(all_keys, order - 1)
        for i, (keys, bits) in enumerate(seen):
            cost[np.searchsorted(all_keys, keys), i] = bits
        costs.append(Table(all_keys, cost.astype(np.float32)))
    return Model(languages, costs, escapes)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = TRAIN_DOCS) -> Model:
    """Fit on about ``per_language`` documents of each language, whole texts."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    )
    sizes = rows.groupBy("lang").count().collect()
    # of languages with more documents, those with a small hash are taken
    share = F.lit(False)
    for r in sizes:
        part = min(1.0, per_language / r["count"])
        share = share | ((F.col("lang") == r["lang"]) & (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(part * (1 << 20))))
    ship(docs.sparkSession)
    sample = rows.where(share).select("lang", "text")
    counted = sample.mapInArrow(_counts, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    table = counted.toArrow().combine_chunks()
    langs = table.column("lang").to_numpy()
    grams, n = table.column("gram").to_numpy().astype(np.uint64), table.column("n").to_numpy()
    return build({lang: (grams[langs == lang], n[langs == lang]) for lang in sorted(set(langs))})


def identify(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` with the predicted language and its score, one pass and no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        return lambda texts: list(shared.value.predict(texts))

    return map_texts(docs, make, "lang_pred string, score double", keep, text_col)


def held_out(fold: Column, number: int = 1) -> Column:
    return F.coalesce(fold == number, F.lit(False))
