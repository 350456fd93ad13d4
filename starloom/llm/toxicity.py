"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A text is cut into overlapping windows of words. A word's input is a learned vector
of its own hash next to the sum of learned vectors of its byte n-grams. Two gated
recurrent passes, forwards and backwards, run over each window; attention weighs
their states and a logistic unit scores the pooled state. The text's score is that
of its worst window, shifted so that 0.5 separates labelled texts best.

Only the text's label is known in training, not which window earns it. So a toxic
text is taught by its most suspicious windows, first judged by how much more often
their words occur in toxic texts, then by the network itself; a clean text is taught
by windows all over it and by those the network wrongly suspects.

Training takes a bounded sample of labelled texts, scoring every window of every
text. NULL and empty texts have no window and score 0. Rows are kept apart even if
their ids are equal or NULL; without labels of both kinds everything scores 0.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, functions as F

from starloom.llm.tables import map_texts, small_batches
from starloom.operators.joins import fits_broadcast
from starloom.session import stage

WINDOW, STRIDE = 24, 16
WORD_BITS, GRAM_BITS = 12, 13
WORD_DIM, GRAM_DIM, HIDDEN = 8, 12, 8
#: Longer words are cut into parts of this many characters, all of which are read.
WORD_CHARS = 24
#: Labelled texts that training takes, a third of them toxic: the expected number of a choice
#: by hash of their ids.
TRAIN_DOCS = 3600
EPOCHS, BATCH, RATE, SEED = 6, 64, 0.01, 7
#: Words whose inputs a worker keeps.
KEPT_WORDS = 100_000
_STRIP = ".,;:!?\"'()[]{}<>|*#$%&"


def words_of(text: str) -> list[str]:
    return text.lower().split()


def _tokens(text: str) -> list[str]:
    """Words, the very long ones cut so that each token has one input."""
    words = words_of(text)
    if max(map(len, words), default=0) <= WORD_CHARS:
        return words
    return [w[i : i + WORD_CHARS] for w in words for i in range(0, len(w), WORD_CHARS)]


def _buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word bucket of each word, buckets of its byte 3- and 4-grams, and which of those exist."""
    data = [b"^" + w.strip(_STRIP).encode("utf-8", "replace") + b"$" for w in words]
    size = np.array([len(d) for d in data])
    width = max(4, int(size.max()))
    chars = np.frombuffer(b"".join([d.ljust(width, b"\0") for d in data]), np.uint8).reshape(len(data), width)
    whole, mix = np.zeros(len(data), np.uint64), np.uint64(0x9E3779B97F4A7C15)
    for i in range(width):
        # padding leaves the hash as it is
        whole = np.where(i < size, whole * np.uint64(1099511628211) + chars[:, i] + np.uint64(1), whole)
    word = ((whole * mix) >> np.uint64(64 - WORD_BITS)).astype(np.int32)
    grams, there = [], []
    for n in (3, 4):
        key = np.zeros((len(data), width - n + 1), np.uint64)
        for i in range(n):
            key = (key << np.uint64(8)) | chars[:, i : i + width - n + 1]
        grams.append((((key + np.uint64(n)) * mix) >> np.uint64(64 - GRAM_BITS)).astype(np.int32))
        there.append(np.arange(width - n + 1)[None, :] + n <= size[:, None])
    return word, np.concatenate(grams, 1), np.concatenate(there, 1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Network:
    """Parameters by name, and the logit at which a text counts as toxic."""

    p: dict[str, np.ndarray]
    threshold: float = 0.0
    rows: dict[str, int] = field(default_factory=dict)
    inputs: np.ndarray | None = None

    @staticmethod
    def new(seed: int = SEED) -> Network:
        r = np.random.default_rng(seed)
        d, h = WORD_DIM + GRAM_DIM, HIDDEN
        p = {
            "word": r.normal(0, 0.1, (1 << WORD_BITS, WORD_DIM)),
            "gram": r.normal(0, 0.1, (1 << GRAM_BITS, GRAM_DIM)),
            "att_w": r.normal(0, 0.3, (2 * h, h)),
            "att_v": r.normal(0, 0.3, h),
            "out_w": r.normal(0, 0.3, 2 * h),
            "out_b": np.zeros(1),
        }
        for way in ("f", "b"):
            p[f"w_{way}"] = r.normal(0, d**-0.5, (d, 3 * h))
            p[f"u_{way}"] = r.normal(0, h**-0.5, (h, 3 * h))
            p[f"c_{way}"] = np.zeros(3 * h)
        return Network({k: v.astype(np.float32) for k, v in p.items()})

    def vectors(self, buckets: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
        word, grams, there = buckets
        # row 0 of a padded table stands for what is not there
        table = np.concatenate([np.zeros((1, GRAM_DIM), np.float32), self.p["gram"]])
        summed = table[np.where(there, grams + 1, 0)].sum(1)
        return np.concatenate([self.p["word"][word], summed], 1)

    def _pass(self, gates: np.ndarray, mask: np.ndarray, way: str, keep: list | None = None) -> np.ndarray:
        """States of one direction; ``gates`` are the inputs' share of the gates, time first."""
        h, u, c = HIDDEN, self.p[f"u_{way}"], self.p[f"c_{way}"]
        state = np.zeros((gates.shape[1], h), np.float32)
        states = np.empty((len(gates), gates.shape[1], h), np.float32)
        for t in range(len(gates)) if way == "f" else reversed(range(len(gates))):
            own = state @ u + c
            rz = _sigmoid(gates[t, :, : 2 * h] + own[:, : 2 * h])
            reset, update = rz[:, :h], rz[:, h:]
            fresh = np.tanh(gates[t, :, 2 * h :] + reset * own[:, 2 * h :])
            m = mask[t][:, None]
            after = state + m * (1 - update) * (fresh - state)
            if keep is not None:
                keep.append((t, state, own, reset, update, fresh, m))
            states[t] = state = after
        return states

    def _pooled(self, states: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        look = np.tanh(states @ self.p["att_w"])
        weight = np.where(mask > 0, look @ self.p["att_v"], -1e9)
        weight = np.exp(weight - weight.max(0))
        weight *= mask
        weight /= np.maximum(weight.sum(0), 1e-9)
        return (weight[:, :, None] * states).sum(0), weight, look

    def logits(self, gates_f: np.ndarray, gates_b: np.ndarray, mask: np.ndarray) -> np.ndarray:
        states = np.concatenate([self._pass(gates_f, mask, "f"), self._pass(gates_b, mask, "b")], 2)
        pooled, _, _ = self._pooled(states, mask)
        return pooled @ self.p["out_w"] + self.p["out_b"][0]

    def gradients(
        self, buckets: tuple[np.ndarray, np.ndarray, np.ndarray], at: np.ndarray, mask: np.ndarray, y: np.ndarray
    ) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the mean log loss over windows ``at`` (time first, word numbers)."""
        p, h = self.p, HIDDEN
        x = self.vectors(buckets)
        kept: dict[str, list] = {"f": [], "b": []}
        states = np.concatenate([self._pass((x @ p[f"w_{w}"])[at], mask, w, kept[w]) for w in ("f", "b")], 2)
        pooled, weight, look = self._pooled(states, mask)
        logit = pooled @ p["out_w"] + p["out_b"][0]
        d = ((_sigmoid(logit) - y) / len(y)).astype(np.float32)
        g = {k: np.zeros_like(v) for k, v in p.items()}
        g["out_w"], g["out_b"] = pooled.T @ d, np.array([d.sum()], np.float32)
        d_pooled = d[:, None] * p["out_w"]
        d_states = weight[:, :, None] * d_pooled
        d_weight = (states * d_pooled).sum(2)
        d_score = weight * (d_weight - (weight * d_weight).sum(0))
        g["att_v"] = np.einsum("tbk,tb->k", look, d_score)
        d_look = d_score[:, :, None] * p["att_v"] * (1 - look**2)
        g["att_w"] = np.einsum("tbh,tbk->hk", states, d_look)
        d_states = d_states + d_look @ p["att_w"].T
        d_x = np.zeros_like(x)
        for way, part in (("f", d_states[:, :, :h]), ("b", d_states[:, :, h:])):
            back = np.zeros((at.shape[1], h), np.float32)
            u, d_gate = p[f"u_{way}"], np.zeros((*at.shape, 3 * h), np.float32)
            for t, state, own, reset, update, fresh, m in reversed(kept[way]):
                d_after = back + part[t]
                d_fresh = d_after * m * (1 - update) * (1 - fresh**2)
                d_update = -d_after * m * (fresh - state) * update * (1 - update)
                d_reset = d_fresh * own[:, 2 * h :] * reset * (1 - reset)
                d_own = np.concatenate([d_reset, d_update, d_fresh * reset], 1)
                d_gate[t] = np.concatenate([d_reset, d_update, d_fresh], 1)
                g[f"u_{way}"] += state.T @ d_own
                g[f"c_{way}"] += d_own.sum(0)
                back = d_after * (1 - m * (1 - update)) + d_own @ u.T
            flat = np.zeros((len(x), 3 * h), np.float32)
            np.add.at(flat, at.ravel(), d_gate.reshape(-1, 3 * h))
            g[f"w_{way}"] = x.T @ flat
            d_x += flat @ p[f"w_{way}"].T
        word, grams, there = buckets
        np.add.at(g["word"], word, d_x[:, :WORD_DIM])
        row, place = np.nonzero(there)
        np.add.at(g["gram"], grams[row, place], d_x[row, WORD_DIM:])
        return g, logit

    def _rows(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words' gate inputs, and those past the kept ones. Number 0 is padding.

        The first words that a worker meets are kept, the frequent ones among them;
        others are made anew in each step.
        """
        if self.inputs is None:
            self.rows, self.inputs = {}, np.zeros((KEPT_WORDS + 1, 6 * HIDDEN), np.float32)
        found = list(map(self.rows.get, words))
        new: list[str] = []
        if None in found:
            new = list(dict.fromkeys([w for w, row in zip(words, found) if row is None]))
            new.sort(key=len)  # words of like length together, so that little is padded
            first = len(self.rows) + 1
            keep = first + len(new) <= KEPT_WORDS
            number = self.rows if keep else {}
            number.update(zip(new, range(first, first + len(new))))
            found = [number[w] if row is None else row for w, row in zip(words, found)]
            made = np.empty((len(new), 6 * HIDDEN), np.float32)
            for i in range(0, len(new), 5_000):
                x = self.vectors(_buckets(new[i : i + 5_000]))
                made[i : i + len(x), : 3 * HIDDEN] = x @ self.p["w_f"]
                made[i : i + len(x), 3 * HIDDEN :] = x @ self.p["w_b"]
            if keep:
                self.inputs[first : first + len(new)] = made
            else:
                return np.array(found, np.int64), made
        return np.array(found, np.int64), np.zeros((0, 6 * HIDDEN), np.float32)

    def _gates(self, at: np.ndarray, extra: np.ndarray) -> np.ndarray:
        """The gate inputs of these numbers; those past the kept ones are taken from ``extra``."""
        if not len(extra):
            return self.inputs[at]
        past = at - (len(self.rows) + 1)
        late = past >= 0
        gates = self.inputs[np.where(late, 0, at)]
        gates[late] = extra[past[late]]
        return gates

    def forget(self) -> None:
        """Drop inputs made from earlier parameters."""
        self.rows, self.inputs = {}, None

    def window_logits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[list[str]]]:
        """Logit of every window, the number of its text, and the texts' words."""
        tokens = [_tokens(t) for t in texts]
        found, extra = self._rows([w for ws in tokens for w in ws])
        rows = np.concatenate([[0], found])
        starts, ends, owner, base = [], [], [], 1
        for i, ws in enumerate(tokens):
            if ws:
                first = window_starts(len(ws))
                starts.append(base + first)
                ends.append(np.minimum(base + first + WINDOW, base + len(ws)))
                owner.append(np.full(len(first), i))
            base += len(ws)
        if not owner:
            return np.zeros(0), np.zeros(0, np.int64), tokens
        start, end, of = map(np.concatenate, (starts, ends, owner))
        out = np.empty(len(start), np.float32)
        for i in range(0, len(start), 2048):
            place = start[None, i : i + 2048] + np.arange(WINDOW)[:, None]
            mask = place < end[None, i : i + 2048]
            gates = self._gates(rows[np.where(mask, place, 0)], extra)
            out[i : i + 2048] = self.logits(gates[:, :, : 3 * HIDDEN], gates[:, :, 3 * HIDDEN :], mask.astype(np.float32))
        return out, of, tokens

    def scores(self, texts: list[str]) -> np.ndarray:
        """Score of each text's worst window, 0 without any window."""
        logit, of, _ = self.window_logits(texts)
        worst = np.full(len(texts), -np.inf)
        np.maximum.at(worst, of, logit)
        over = np.clip(worst - self.threshold, -700.0, 700.0)
        return np.where(np.isfinite(worst) & np.isfinite(self.threshold), 1 / (1 + np.exp(-over)), 0.0)


def window_starts(n_words: int) -> np.ndarray:
    """Starts of the windows that cover all words, each overlapping the next."""
    last = max(0, n_words - WINDOW)
    return np.arange(0, last + STRIDE, STRIDE) if last else np.zeros(1, np.int64)


def _windows(words: list[str]) -> list[list[str]]:
    return [words[s : s + WINDOW] for s in window_starts(len(words)) if s < len(words)]


class _Adam:
    def __init__(self, p: dict[str, np.ndarray], rate: float):
        self.p, self.rate, self.t = p, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}

    def step(self, g: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, x in self.p.items():
            self.m[k] = 0.9 * self.m[k] + 0.1 * g[k]
            self.v[k] = 0.999 * self.v[k] + 0.001 * g[k] ** 2
            m, v = self.m[k] / (1 - 0.9**self.t), self.v[k] / (1 - 0.999**self.t)
            x -= (self.rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)


def _encode(windows: list[list[str]]) -> tuple[tuple, np.ndarray, np.ndarray]:
    vocabulary = list(dict.fromkeys(w for ws in windows for w in ws))
    number = {w: i for i, w in enumerate(vocabulary)}
    at = np.zeros((WINDOW, len(windows)), np.int64)
    mask = np.zeros((WINDOW, len(windows)), np.float32)
    for j, ws in enumerate(windows):
        at[: len(ws), j] = [number[w] for w in ws]
        mask[: len(ws), j] = 1
    return _buckets(vocabulary), at, mask


def _suspicion(texts: list[list[str]], labels: list[int]) -> dict[str, float]:
    """Log odds of each word's occurring in a toxic rather than a clean text."""
    seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
    for words, y in zip(texts, labels):
        # word beginnings stand for families of words
        seen[y].update({w.strip(_STRIP) for w in words} | {w.strip(_STRIP)[:5] for w in words})
    n = {y: labels.count(y) + 2 for y in (0, 1)}
    return {w: float(np.log((c + 0.5) / n[1]) - np.log((seen[0][w] + 0.5) / n[0])) for w, c in seen[1].items() if c > 1}


def _worst(windows: list[list[str]], value) -> list[list[str]]:
    """The window of highest value, and others that come close."""
    marks = [value(w) for w in windows]
    top = max(marks)
    return [w for w, m in zip(windows, marks) if m >= max(top - 1.0, 0.5 * top)][:3]


def fit(texts: list[str], labels: list[int], seed: int = SEED) -> Network:
    """Train on labelled texts, then set the threshold on the same texts' worst windows."""
    net = Network.new(seed)
    if len(set(labels)) < 2:
        net.threshold = np.inf
        return net
    order = np.random.default_rng(seed)
    tokens = [_tokens(t) for t in texts]
    used = [i for i, ws in enumerate(tokens) if ws]
    odds = _suspicion([tokens[i] for i in used], [labels[i] for i in used])

    def mark(window: list[str]) -> float:
        return max(max(odds.get(w.strip(_STRIP), -9.0), odds.get(w.strip(_STRIP)[:5], -9.0)) for w in window)

    bags = {i: _windows(tokens[i]) for i in used}
    positive = [w for i in used if labels[i] for w in _worst(bags[i], mark)]
    adam = _Adam(net.p, RATE)
    clean = [i for i in used if not labels[i]]
    wrong: list[list[str]] = []
    for epoch in range(EPOCHS):
        if epoch == EPOCHS // 2:
            positive = [w for i in used if labels[i] for w in _taught(net, tokens[i])]
        if epoch in (2, 4):
            wrong = _suspects(net, [texts[i] for i in clean], [tokens[i] for i in clean], 2 * len(positive))
        plain = [bags[i][order.integers(len(bags[i]))] for i in order.choice(clean, min(len(clean) * 3, 2 * len(positive) + 500))]
        windows = positive + plain + wrong
        ys = np.array([1.0] * len(positive) + [0.0] * (len(plain) + len(wrong)), np.float32)
        shuffled = order.permutation(len(windows))
        adam.rate = RATE * (1 - 0.9 * epoch / EPOCHS)
        for i in range(0, len(windows), BATCH):
            some = shuffled[i : i + BATCH]
            buckets, at, mask = _encode([windows[j] for j in some])
            g, _ = net.gradients(buckets, at, mask, ys[some])
            adam.step(g)
    net.forget()
    net.threshold = _threshold(net, texts, np.array(labels))
    net.forget()
    return net


def _taught(net: Network, words: list[str]) -> list[list[str]]:
    net.forget()
    windows = _windows(words)
    logit, _, _ = net.window_logits([" ".join(words)])
    top = logit.max()
    return [w for w, x in zip(windows, logit) if x >= max(top - 1.0, 0.5 * top)][:3]


def _suspects(net: Network, texts: list[str], tokens: list[list[str]], most: int) -> list[list[str]]:
    """Windows of clean texts that score highest."""
    net.forget()
    found: list[tuple[float, list[str]]] = []
    for i in range(0, len(texts), 200):
        logit, of, words = net.window_logits(texts[i : i + 200])
        place = np.arange(len(of)) - np.searchsorted(of, of)
        for j in np.flatnonzero(logit > -2.0):
            start = int(place[j]) * STRIDE
            found.append((float(logit[j]), words[of[j]][start : start + WINDOW]))
    found.sort(key=lambda x: -x[0])
    return [w for _, w in found[:most] if w]


def _threshold(net: Network, texts: list[str], labels: np.ndarray) -> float:
    """The logit that separates best, in the middle of the widest such gap."""
    worst = np.concatenate([_worst_logits(net, texts[i : i + 200]) for i in range(0, len(texts), 200)])
    known = np.isfinite(worst)
    order = np.argsort(worst[known])
    value, y = worst[known][order], labels[known][order]
    # wrong if everything from place i on counts as toxic; a clean text lost weighs double
    wrong = np.concatenate([[0], np.cumsum(y)]) + 2 * ((1 - y).sum() - np.concatenate([[0], np.cumsum(1 - y)]))
    best = np.flatnonzero(wrong == wrong.min())
    edge = np.concatenate([[value[0] - 1], value, [value[-1] + 1]])
    gaps = edge[best + 1] - edge[best]
    i = best[gaps.argmax()]
    return float((edge[i] + edge[i + 1]) / 2)


def _worst_logits(net: Network, texts: list[str]) -> np.ndarray:
    logit, of, _ = net.window_logits(texts)
    worst = np.full(len(texts), -np.inf)
    np.maximum.at(worst, of, logit)
    return worst


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most: int = TRAIN_DOCS) -> Network:
    """Fit on about ``most`` labelled documents, chosen by hash of their ids.

    ``docs`` holds the documents that may be learned from. The choice is made on the
    labels, so the texts of all other documents are filtered out by the join.
    """
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("y IN (0, 1)")
    sizes = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    part = {y: min(1.0, most * share / n) for y, n, share in ((0, sizes.get(0, 0) or 1, 2 / 3), (1, sizes.get(1, 0) or 1, 1 / 3))}
    chosen = known.where(
        F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
        < F.when(F.col("y") == 1, int(part[1] * (1 << 20))).otherwise(int(part[0] * (1 << 20)))
    )
    chosen = stage(chosen, "labels")
    # about ``most`` rows, so the texts of all documents need not be shuffled to meet them
    chosen = F.broadcast(chosen) if fits_broadcast(chosen) else chosen
    text = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = text.join(chosen, "doc_id").where("text IS NOT NULL").toArrow().sort_by([("doc_id", "ascending"), ("text", "ascending")])
    return fit(rows.column("text").to_pylist(), rows.column("y").to_pylist())


def score(docs: DataFrame, network: Network, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` with every text's score, one pass and no shuffle."""
    small_batches(docs.sparkSession)
    # a worker keeps its copy, and with it the inputs of words met in earlier tasks
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def make():
        return lambda texts: [shared.value.scores(texts)]

    return map_texts(docs, make, "score double", keep, text_col)
