"""Toxicity of texts by a bidirectional gated recurrent network over windows of words.

A word comes in as three vectors: that of its hashed spelling, the mean of those of its hashed
character sequences (four bytes anywhere), and the mean of those of its beginnings (four to eight bytes), so that unseen
words of a known stem are recognised. Two gated recurrent layers read a window forwards and backwards, attention pools
their states, and a logistic unit judges the window. Windows overlap by half and cover
the whole text; a text's score follows from its worst window, the mean of all and their number.

All is numpy. Only the text's label is known, not where in it the reason stands. One entry of every vector starts as
the log odds of the label where the spelling or sequence is found; the network first learns from the windows
in which these are highest, then from those it finds worst itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitaria.llm.session import let_workers_import
from vitaria.llm.words import hash_spans, mix, spans

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Signs left out of words, so that a word with signs around it is that word.
_SIGNS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_GRAM = 4
_BEGINNINGS = (4, 5, 6, 7, 8)
_WINDOWS_AT_ONCE = 4096
_BYTES_AT_ONCE = 2 << 20


@dataclass(frozen=True)
class Shape:
    """Hashed spellings and character sequences, lengths of their vectors, of states and attention, words in a window and between windows."""

    spellings: int = 1 << 14
    grams: int = 1 << 14
    size: int = 8
    hidden: int = 12
    attention: int = 8
    window: int = 24
    stride: int = 12


class Words:
    """Words of some texts, one after the other, and the windows over them."""

    def __init__(self, texts: list[bytes], shape: Shape):
        joined = b"\n".join(texts).translate(_LOWER, _SIGNS)
        sizes = np.array([len(t) - sum(map(t.count, _SIGN_BYTES)) if t else 0 for t in texts], np.int64)
        self.data = np.frombuffer(joined, np.uint8)
        self.starts, self.ends = spans(self.data)
        self.hashes = hash_spans(self.data, self.starts, self.ends)
        begins = np.cumsum(np.r_[0, sizes[:-1] + 1])
        first = np.searchsorted(self.starts, begins)
        counts = np.diff(np.r_[first, len(self.starts)])
        windows = np.maximum(1, -(-(counts - shape.window) // shape.stride) + 1)
        self.begins = np.cumsum(windows) - windows  # first window of each text
        self.docs = np.repeat(np.arange(len(texts)), windows)
        number = np.arange(len(self.docs)) - self.begins[self.docs]
        self.at = first[self.docs] + number * shape.stride
        self.until = np.minimum(self.at + shape.window, (first + counts)[self.docs])


_SIGN_BYTES = [bytes([b]) for b in _SIGNS]


@dataclass
class Vocabulary:
    """Different words: spelling ids, ids of their beginnings, and ids of their character sequences one after the other."""

    spellings: np.ndarray
    begins: np.ndarray
    grams: np.ndarray
    offsets: np.ndarray

    def take(self, which: np.ndarray) -> Vocabulary:
        """Some of the words."""
        counts = np.diff(self.offsets)[which]
        offsets = np.r_[0, np.cumsum(counts)]
        at = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - self.offsets[:-1][which], counts)
        return Vocabulary(self.spellings[which], self.begins[which], self.grams[at], offsets)


def vocabulary(words: Words, first: int, last: int, shape: Shape) -> tuple[Vocabulary, np.ndarray]:
    """The different words from one place to another, and which of them stands at each place."""
    hashes = words.hashes[first:last]
    _, place, which = np.unique(hashes, return_index=True, return_inverse=True)
    order = np.argsort(place)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    place = place[order] + first
    starts, ends = words.starts[place], words.ends[place]
    counts = np.maximum(ends - starts - _GRAM + 1, 1)
    many = np.repeat(np.arange(len(place)), counts)
    at = starts[many] + np.arange(len(many)) - np.repeat(np.cumsum(counts) - counts, counts)
    grams = np.zeros(len(many), np.uint64)
    for k in range(_GRAM):
        inside = at + k < ends[many]
        grams = grams * np.uint64(257) + np.where(inside, words.data[np.minimum(at + k, len(words.data) - 1)] + np.uint64(1), np.uint64(0))
    size = np.uint64(shape.grams)
    begins = [mix(hash_spans(words.data, starts, np.minimum(starts + k, ends)) + np.uint64(k)) % size for k in _BEGINNINGS]
    spelled = (words.hashes[place] % np.uint64(shape.spellings)).astype(np.int64)
    offsets = np.r_[0, np.cumsum(counts)]
    return Vocabulary(spelled, np.stack(begins, 1).astype(np.int64), (mix(grams) % size).astype(np.int64), offsets), rank[which]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Network:
    """Weights of the network, and how a text's score follows from its windows."""

    shape: Shape
    spelled: np.ndarray
    written: np.ndarray
    dense: dict[str, np.ndarray]
    judge: np.ndarray = field(default_factory=lambda: np.array([0.0, 1.0, 0.0, 0.0]))

    @classmethod
    def start(cls, shape: Shape, seed: int) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda *s: rng.normal(0, s[0] ** -0.5, s).astype(np.float32)
        h, dense = shape.hidden, {}
        for way in "fb":
            dense |= {f"w{way}": draw(3 * shape.size, 3 * h), f"u{way}": draw(h, 3 * h), f"c{way}": np.zeros(3 * h, np.float32)}
        dense |= {"a": draw(2 * h, shape.attention), "a0": np.zeros(shape.attention, np.float32), "v": draw(shape.attention),
                  "o": draw(2 * h), "o0": np.zeros(1, np.float32)}
        small = lambda n: rng.normal(0, 0.3, (n, shape.size)).astype(np.float32)
        return cls(shape, small(shape.spellings), small(shape.grams), dense)

    def inputs(self, vocab: Vocabulary) -> np.ndarray:
        """Vector of each word: of its spelling, and the means of its character sequences and its beginnings."""
        means = np.add.reduceat(self.written[vocab.grams], vocab.offsets[:-1], axis=0) / np.diff(vocab.offsets)[:, None]
        return np.hstack([self.spelled[vocab.spellings], means, self.written[vocab.begins].mean(axis=1)])

    def _layer(self, way: str, x: np.ndarray, ids: np.ndarray, mask: np.ndarray, kept: list | None) -> np.ndarray:
        """States of one direction; what the way back needs goes to ``kept``."""
        h, d = self.shape.hidden, self.dense
        projected = np.vstack([x @ d[f"w{way}"] + d[f"c{way}"], np.zeros((1, 3 * h), np.float32)])
        steps = range(ids.shape[1]) if way == "f" else range(ids.shape[1] - 1, -1, -1)
        state, states = np.zeros((len(ids), h), np.float32), np.empty((*ids.shape, h), np.float32)
        for t in steps:
            p, g = projected[ids[:, t]], state @ d[f"u{way}"]
            gates = 1 / (1 + np.exp(-(p[:, : 2 * h] + g[:, : 2 * h])))
            z, r = gates[:, :h], gates[:, h:]
            new = np.tanh(p[:, 2 * h :] + r * g[:, 2 * h :])
            m = mask[:, t : t + 1]
            after = state + m * (1 - z) * (new - state)
            if kept is not None:
                kept.append((t, state, z, r, new, g[:, 2 * h :], m))
            state = after
            states[:, t] = state
        return states

    def windows(self, x: np.ndarray, ids: np.ndarray, mask: np.ndarray, kept: dict | None = None) -> np.ndarray:
        """Logit of each window; ``ids`` say which row of ``x`` stands at each place."""
        d, back = self.dense, {"f": [], "b": []} if kept is not None else {"f": None, "b": None}
        states = np.concatenate([self._layer(way, x, ids, mask, back[way]) for way in "fb"], axis=2)
        inner = np.tanh(states @ d["a"] + d["a0"])
        weights = inner @ d["v"] - 1e9 * (1 - mask)
        weights = np.exp(weights - weights.max(axis=1, keepdims=True))
        weights /= weights.sum(axis=1, keepdims=True)
        pooled = np.einsum("bt,bth->bh", weights, states)
        if kept is not None:
            kept.update(back=back, states=states, inner=inner, weights=weights, pooled=pooled)
        return pooled @ d["o"] + d["o0"][0]

    def slopes(self, x: np.ndarray, ids: np.ndarray, error: np.ndarray, kept: dict) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Slopes of the weights and of the input vectors, by the errors of the windows' logits."""
        d, h, out = self.dense, self.shape.hidden, {}
        out["o"], out["o0"] = kept["pooled"].T @ error, np.array([error.sum()], np.float32)
        pooled = error[:, None] * d["o"]
        at_weights = np.einsum("bth,bh->bt", kept["states"], pooled)
        at_scores = kept["weights"] * (at_weights - (kept["weights"] * at_weights).sum(axis=1, keepdims=True))
        out["v"] = np.einsum("bt,bta->a", at_scores, kept["inner"])
        at_inner = at_scores[..., None] * d["v"] * (1 - kept["inner"] ** 2)
        out["a"], out["a0"] = np.einsum("bth,bta->ha", kept["states"], at_inner), at_inner.sum(axis=(0, 1))
        at_states = kept["weights"][..., None] * pooled[:, None] + at_inner @ d["a"].T
        at_x = np.zeros((len(x) + 1, x.shape[1]), np.float32)
        for n, way in enumerate("fb"):
            carried, u = np.zeros((len(ids), h), np.float32), np.zeros_like(d[f"u{way}"])
            at_projected = np.zeros((len(x) + 1, 3 * h), np.float32)
            for t, state, z, r, new, g, m in reversed(kept["back"][way]):
                total = carried + at_states[:, t, n * h : (n + 1) * h]
                moved = total * m
                at_z = moved * (state - new) * z * (1 - z)
                at_new = moved * (1 - z) * (1 - new**2)
                at_r = at_new * g * r * (1 - r)
                gates = np.hstack([at_z, at_r, at_new * r])
                u += state.T @ gates
                carried = total * (1 - m) + moved * z + gates @ d[f"u{way}"].T
                np.add.at(at_projected, ids[:, t], np.hstack([at_z, at_r, at_new]))
            at_projected[-1] = 0
            out[f"u{way}"], out[f"w{way}"], out[f"c{way}"] = u, x.T @ at_projected[:-1], at_projected.sum(axis=0)
            at_x[:-1] += at_projected[:-1] @ d[f"w{way}"].T
        return out, at_x[:-1]

    def logits(self, words: Words) -> np.ndarray:
        """Logit of every window, some thousand at a time, whatever the length of a text."""
        out = np.empty(len(words.at), np.float32)
        for a in range(0, len(out), _WINDOWS_AT_ONCE):
            b = min(a + _WINDOWS_AT_ONCE, len(out))
            first, last = int(words.at[a]), int(max(words.until[b - 1], words.at[a]))
            place = words.at[a:b, None] + np.arange(self.shape.window) - first
            mask = place + first < words.until[a:b, None]
            if last == first:
                x, ids = np.empty((0, 3 * self.shape.size), np.float32), np.zeros_like(place)
            else:
                vocab, which = vocabulary(words, first, last, self.shape)
                x, ids = self.inputs(vocab), np.where(mask, which[np.minimum(place, len(which) - 1)], 0)
            ids = np.where(mask, ids, len(x))
            out[a:b] = self.windows(x.astype(np.float32), ids, mask.astype(np.float32))  # as exact as the weights
        return out

    def features(self, words: Words) -> np.ndarray:
        """Of every text: one, its worst window, the mean over windows, and their number."""
        logits = self.logits(words)
        counts = np.diff(np.r_[words.begins, len(logits)])
        worst = np.maximum.reduceat(logits, words.begins)
        mean = np.add.reduceat(_sigmoid(logits), words.begins) / counts
        return np.stack([np.ones(len(counts)), worst, mean, np.log(counts)], axis=1)

    def scores(self, words: Words) -> np.ndarray:
        return _sigmoid(self.features(words) @ self.judge)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression by Newton's method, with a small penalty."""
    w, penalty = np.zeros(x.shape[1]), np.diag([1e-6, *[1e-2] * (x.shape[1] - 1)]) * weight.sum() / max(len(y), 1)
    for _ in range(25):
        p = _sigmoid(x @ w)
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty + 1e-6 * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (weight * (y - p)) - penalty @ w)
        w = w + np.clip(step, -2, 2)
    return w


_TEXTS_AT_ONCE = 200


def _odds(found: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Log odds of label 1 by the numbers of texts with either label that each id is found in; near 0 for rare ids."""
    odds = np.log((found[1] + 1) / (y.sum() + 2)) - np.log((found[0] + 1) / (len(y) - y.sum() + 2))
    return (odds * found.sum(axis=0) / (found.sum(axis=0) + 10)).astype(np.float32)


def _start_from_odds(net: Network, vocab: Vocabulary, which: np.ndarray, docs: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sets the first entry of every vector; gives the odds of each different word. ``docs`` is ascending."""
    spelled, written = np.zeros((2, net.shape.spellings)), np.zeros((2, net.shape.grams))
    for first in range(0, len(y), _TEXTS_AT_ONCE):
        a, b = np.searchsorted(docs, [first, first + _TEXTS_AT_ONCE])
        pairs = np.unique(docs[a:b] * np.int64(len(vocab.spellings)) + which[a:b])  # a word once for each text
        own, of = vocab.take(pairs % len(vocab.spellings)), pairs // len(vocab.spellings)
        ids = np.r_[own.grams, own.begins.ravel()]
        texts = np.r_[np.repeat(of, np.diff(own.offsets)), np.repeat(of, len(_BEGINNINGS))]
        for table, found, text in ((spelled, own.spellings, of), (written, ids, texts)):
            once = np.unique(text * np.int64(table.shape[1]) + found)
            label = y[once // table.shape[1]]
            for k in (0, 1):
                table[k] += np.bincount(once[label == k] % table.shape[1], minlength=table.shape[1])
    net.spelled[:, 0], net.written[:, 0] = _odds(spelled, y), _odds(written, y)
    return net.inputs(vocab)[:, :: net.shape.size].sum(axis=1)


def fit_network(texts: list[bytes], y: np.ndarray, weight: np.ndarray, shape: Shape, *, epochs: int = 6, seed: int = 5) -> Network:
    """Network that learns from four fifths of the texts; the rest sets how scores follow from windows."""
    rng = np.random.default_rng(seed)
    net, words = Network.start(shape, seed), Words(texts, shape)
    check = np.arange(len(texts)) % 5 == 4 if len(texts) >= 50 else np.zeros(len(texts), bool)
    counts = np.diff(np.r_[words.begins, len(words.at)])
    if len(words.starts):
        vocab, which = vocabulary(words, 0, len(words.starts), shape)
        owner = np.searchsorted(words.at[words.begins], np.arange(len(words.starts)), "right") - 1
        learns = ~check[owner]
        renumbered = np.cumsum(~check) - 1
        odds = _start_from_odds(net, vocab, which[learns], renumbered[owner[learns]], y[~check])
        highest = np.maximum.reduceat(np.r_[odds[which], -np.inf], np.stack([words.at, words.until], 1).ravel())[::2]
        logits = np.where(words.at < words.until, highest, 0)
        first, second = ({n: np.zeros_like(w) for n, w in net.dense.items()} for _ in range(2))
        seen = [np.full(len(t), 1e-3, np.float32) for t in (net.spelled, net.written)]
        step = 0
        for epoch in range(epochs):
            logits = net.logits(words) if epoch in (2, 4) else logits
            order = np.lexsort([-logits, words.docs])
            rank = np.arange(len(order)) - words.begins[words.docs[order]]
            chosen = rng.permutation(order[(rank < np.minimum(3, counts)[words.docs[order]]) & ~check[words.docs[order]]])
            for some in np.array_split(chosen, max(1, len(chosen) // 128)):
                place = words.at[some, None] + np.arange(shape.window)
                mask = place < words.until[some, None]
                own, ids = np.unique(np.where(mask, which[np.minimum(place, len(which) - 1)], which[0]), return_inverse=True)
                part = vocab.take(own)
                x, ids = net.inputs(part), np.where(mask, ids.reshape(place.shape), len(own))
                kept: dict = {}
                found = net.windows(x, ids, mask.astype(np.float32), kept)
                error = ((_sigmoid(found) - y[words.docs[some]]) / len(some)).astype(np.float32)
                slopes, at_x = net.slopes(x, ids, error, kept)
                step += 1
                for n, slope in slopes.items():
                    first[n] += 0.1 * (slope - first[n])
                    second[n] += 0.001 * (slope**2 - second[n])
                    net.dense[n] -= 0.004 * (first[n] / (1 - 0.9**step)) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8)
                size = shape.size
                share = at_x[:, size : 2 * size] / np.diff(part.offsets)[:, None]
                starts = np.repeat(at_x[:, 2 * size :] / len(_BEGINNINGS), len(_BEGINNINGS), axis=0)
                written = np.r_[part.grams, part.begins.ravel()], np.r_[np.repeat(share, np.diff(part.offsets), axis=0), starts]
                spread = (part.spellings, at_x[:, :size]), written
                for table, sums, (rows, slope) in zip((net.spelled, net.written), seen, spread, strict=True):
                    touched, to = np.unique(rows, return_inverse=True)
                    total = np.zeros((len(touched), shape.size), np.float32)
                    np.add.at(total, to, slope)
                    sums[touched] += (total**2).mean(axis=1)
                    table[touched] -= 0.05 * total / np.sqrt(sums[touched])[:, None]
    judged = check if check.any() else ~check
    net.judge = _logistic(net.features(words)[judged], y[judged], weight[judged])
    return net


def learning_rows(docs: DataFrame, labels: DataFrame, label: str, sample: int, longest: int) -> DataFrame:
    """``label, text`` of at most ``sample`` labelled texts of ``longest`` bytes at most, half of either label if there are as many; one for each id.

    Those of the least id hash are taken, and of rows with one id the text of the least hash.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    halves = [known.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample // 2) for k in (0, 1)]
    chosen = halves[0].union(halves[1])
    short = docs.where(F.octet_length("text") <= longest).join(F.broadcast(chosen), "doc_id")
    one = F.min(F.struct(F.xxhash64("text").alias("mark"), "text")).alias("one")
    return short.groupBy("doc_id", "label").agg(one).select("doc_id", "label", "one.text")


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    shape: Shape | None = None,
    sample: int = 4_000,
    longest: int = 16_384,
) -> DataFrame:
    """``doc_id, score`` for every row: how likely ``label`` is 1, by the whole text alone.

    ``labels`` has ``doc_id`` and ``label``. The network learns from at most ``sample`` labelled texts of at most ``longest``
    bytes, which bounds what the driver holds; every row is scored over all its windows.

    Null and empty texts have one window without words and get the score of that. Null labels and ids are left out
    of learning; without labels, or with one label only, every score is the share of 1 among them, 0.5 if there
    are none. Null ids and repeated rows are scored like any other; an empty table gives an empty one. Other columns are not read.
    """
    let_workers_import(docs.sparkSession)
    shape = shape or Shape()
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    known = labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    found = sorted(learning_rows(rows, known, "label", sample, longest).collect(), key=lambda r: (r["label"], r["doc_id"]))
    y = np.array([r["label"] for r in found], float)
    if len(set(y)) < 2:
        return rows.select("doc_id", F.lit(float(y.mean()) if len(y) else 0.5).alias("score"))
    shares = {r["label"]: r["n"] for r in known.where("label is not null").groupBy("label").agg(F.count("*").alias("n")).collect()}
    weight = np.array([shares[int(k)] / (y == k).sum() for k in y])
    mixed = np.random.default_rng(1).permutation(len(y))  # both labels in the part that is learned from and in the other
    net = fit_network([found[i]["text"].encode() for i in mixed], y[mixed], weight[mixed], shape)
    held = docs.sparkSession.sparkContext.broadcast(net)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            ids, some, size, at = batch.column("doc_id"), [], 0, 0
            for n, one in enumerate(texts):
                some.append(one)
                size += len(one)
                if size > _BYTES_AT_ONCE or n == len(texts) - 1:
                    scores = held.value.scores(Words(some, held.value.shape))
                    yield pa.RecordBatch.from_arrays([ids.slice(at, len(some)), pa.array(scores, pa.float64())], ["doc_id", "score"])
                    some, size, at = [], 0, n + 1

    return rows.mapInArrow(score, "doc_id long, score double")
