"""Text quality by random-indexing word vectors and a small calibrated network.

Every word id has a sparse random index vector. A word's vector is the sum of the
index vectors of the words around it, over all documents. A document is described by
its words' vectors, pooled, and a two-layer network in numpy, whose probabilities are
calibrated by a temperature, scores that description.

A token of the text stands for two words: its spelling in lower case, hashed, and its
shape (which kinds of characters it holds, and whether it repeats the token before).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitaria.llm.session import let_workers_import
from vitaria.llm.words import SPACES, hash_spans, mix, spans

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Kinds of characters, one bit each: letters, capitals, digits, full stops and commas, and four sorts of signs.
_KIND = np.full(256, 1, np.uint8)
_KIND[65:91] = 2
_KIND[48:58] = 4
_KIND[list(b".,;:'\"-()")] = 8
_KIND[list(b"|<>{}[]=_~^`\\/")] = 16
_KIND[list(b"#*$%&@+")] = 32
_KIND[list(b"!?")] = 64
_KIND[list(SPACES)] = 0
SHAPES = 256
_SLICE = 512
_TOKENS_AT_ONCE = 1 << 18


@dataclass(frozen=True)
class Indexing:
    """Size of the word space: hashed spellings, vector length, entries of an index vector, reach of a context."""

    spellings: int = 1 << 15
    size: int = 64
    entries: int = 4
    reach: int = 2

    @property
    def words(self) -> int:
        return self.spellings + SHAPES

    def index_vectors(self) -> tuple[np.ndarray, np.ndarray]:
        """Places and signs of the entries of every word's index vector."""
        bits = mix(np.arange(self.words * self.entries, dtype=np.uint64) + np.uint64(1)).reshape(self.words, self.entries)
        return (bits % np.uint64(self.size)).astype(np.int64), np.where(bits >> np.uint64(63), 1.0, -1.0)

    def ids(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Spelling id and shape id of every token."""
        data = np.frombuffer(text, np.uint8)
        starts, ends = spans(data)
        if not len(starts):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        hashes = hash_spans(_LOWER[data], starts, ends)
        kinds = np.bitwise_or.reduceat(_KIND[data], starts)
        repeats = np.r_[False, hashes[1:] == hashes[:-1]]
        return (hashes % np.uint64(self.spellings)).astype(np.int64), self.spellings + kinds.astype(np.int64) + 128 * repeats


def _texts(batch: pa.RecordBatch, at: int, n: int) -> list[bytes]:
    return [x or b"" for x in batch.column("text").slice(at, n).cast(pa.large_binary()).to_pylist()]


def _blocks(batches: Iterator[pa.RecordBatch], indexing: Indexing) -> Iterator[tuple[list, list[np.ndarray], list[np.ndarray]]]:
    """Documents' other columns, spelling ids and shape ids, about ``_TOKENS_AT_ONCE`` tokens together."""
    rows, spelled, shaped, held = [], [], [], 0
    for batch in batches:
        others = [n for n in batch.schema.names if n != "text"]
        for at in range(0, len(batch), 256):
            texts = _texts(batch, at, 256)
            keys = zip(*(batch.column(n).slice(at, 256).to_pylist() for n in others), strict=True) if others else [()] * len(texts)
            for key, text in zip(keys, texts, strict=True):
                a, b = indexing.ids(text)
                rows.append(key)
                spelled.append(a)
                shaped.append(b)
                held += len(a)
                if held >= _TOKENS_AT_ONCE:
                    yield rows, spelled, shaped
                    rows, spelled, shaped, held = [], [], [], 0
    if rows:
        yield rows, spelled, shaped


_SUMS = pa.schema([("slice", pa.int32()), ("sums", pa.binary())])


def _contexts(indexing: Indexing):
    """Sums of index vectors around every word, of all documents of a task; a row for each slice of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = indexing.index_vectors()
        size = indexing.size
        sums = np.zeros(indexing.words * size)  # whole numbers
        low = indexing.spellings * size
        for _, spelled, shaped in _blocks(batches, indexing):
            gap = np.full(indexing.reach, -1)
            spellings, shapes = (np.concatenate([x for ids in kind for x in (ids, gap)]) for kind in (spelled, shaped))
            around, sign = (np.hstack([x[spellings], x[shapes]]) for x in (places, signs))
            for offset in range(1, indexing.reach + 1):
                ahead = np.flatnonzero((spellings[:-offset] >= 0) & (spellings[offset:] >= 0))
                for target, context in ((ahead, ahead + offset), (ahead + offset, ahead)):
                    entries, weights = around[context], sign[context].ravel()
                    sums[:low] += np.bincount((spellings[target, None] * size + entries).ravel(), weights, low)
                    sums[low:] += np.bincount(((shapes[target, None] - indexing.spellings) * size + entries).ravel(), weights, len(sums) - low)
        table = sums.astype(np.int64).reshape(indexing.words, size)
        for number, at in enumerate(range(0, indexing.words, _SLICE)):
            part = table[at : at + _SLICE]
            if part.any():
                yield pa.RecordBatch.from_pylist([{"slice": number, "sums": part.tobytes()}], _SUMS)

    return run


def _add(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x, np.int64) for x in table.column("sums").to_pylist())
    return pa.Table.from_pylist([{"slice": table.column("slice")[0].as_py(), "sums": total.tobytes()}], _SUMS)


def word_vectors(docs: DataFrame, indexing: Indexing) -> np.ndarray:
    """Vector of every word id, of unit length; its size is fixed by ``indexing``."""
    partial = docs.select("text").mapInArrow(_contexts(indexing), "slice int, sums binary")
    # sums are added twice: first those of some tasks, then the few that are left
    spread = partial.withColumn("share", F.pmod(F.spark_partition_id(), F.lit(1024)))
    parts = spread.groupBy("slice", "share").applyInArrow(_add, "slice int, sums binary")
    vectors = np.zeros((indexing.words, indexing.size))
    for row in parts.groupBy("slice").applyInArrow(_add, "slice int, sums binary").collect():
        part = np.frombuffer(row["sums"], np.int64).reshape(-1, indexing.size)
        vectors[row["slice"] * _SLICE : row["slice"] * _SLICE + len(part)] = part
    return (vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def _pooled(ids: list[np.ndarray], vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean of each document's word vectors, and their mean square distance from it; zeros for no words."""
    lengths = np.array([len(x) for x in ids])
    mean, around = np.zeros((len(ids), vectors.shape[1])), np.zeros((len(ids), 1))
    full = np.flatnonzero(lengths)
    if len(full):
        words = np.concatenate(ids)
        begins = (np.cumsum(lengths) - lengths)[full]
        exact = vectors.astype(np.float64)
        for n, begin in zip(full, begins, strict=True):
            mean[n] = exact.take(words[begin : begin + lengths[n]], axis=0).sum(axis=0)
        mean[full] /= lengths[full, None]
        norms = np.einsum("ij,ij->i", vectors, vectors)
        squares = np.add.reduceat(norms[words], begins, dtype=np.float64) / lengths[full]
        around[full, 0] = squares - (mean[full] ** 2).sum(axis=1)
    return mean, around


def _features(spelled: list[np.ndarray], shaped: list[np.ndarray], vectors: np.ndarray) -> np.ndarray:
    words = np.array([[len(x)] for x in spelled], float)
    return np.hstack([*_pooled(spelled, vectors), *_pooled(shaped, vectors), np.log1p(words)])


@dataclass
class Network:
    """Two layers, the scale of their inputs, and the temperature of their answer."""

    shift: np.ndarray
    scale: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        inner = np.maximum((x - self.shift) / self.scale @ self.hidden + self.hidden_bias, 0)
        return inner @ self.out + self.out_bias

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def fit_network(x: np.ndarray, y: np.ndarray, *, hidden: int = 32, epochs: int = 60, seed: int = 7) -> Network:
    """Network trained by Adam on four fifths of the rows; the rest chooses the epoch and the temperature."""
    rng = np.random.default_rng(seed)
    check = np.arange(len(x)) % 5 == 4 if len(x) >= 50 else np.zeros(len(x), bool)
    shift, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z, rate = (x - shift) / scale, np.clip(y.mean(), 0.01, 0.99)
    weights = [rng.normal(0, (2 / x.shape[1]) ** 0.5, (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden),
               np.array(np.log(rate / (1 - rate)))]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    rows, step, best = np.flatnonzero(~check), 0, (np.inf, weights)
    judged = check if check.any() else ~check

    def loss(logits: np.ndarray, labels: np.ndarray) -> float:
        return float(np.mean(np.logaddexp(0, logits) - labels * logits))

    for _ in range(epochs):
        for chosen in np.array_split(rng.permutation(rows), max(1, len(rows) // 256)):
            step += 1
            a, labels = z[chosen], y[chosen]
            inner = a @ weights[0] + weights[1]
            active = np.maximum(inner, 0)
            error = (1 / (1 + np.exp(-np.clip(active @ weights[2] + weights[3], -30, 30))) - labels) / len(chosen)
            back = np.outer(error, weights[2]) * (inner > 0)
            slopes = [a.T @ back + 1e-4 * weights[0], back.sum(axis=0), active.T @ error + 1e-4 * weights[2], error.sum()]
            for i, slope in enumerate(slopes):
                first = 0.9 * moments[i][0] + 0.1 * slope
                second = 0.999 * moments[i][1] + 0.001 * slope**2
                moments[i] = first, second
                change = 0.003 * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
                weights[i] = weights[i] - change
        now = loss(np.maximum(z[judged] @ weights[0] + weights[1], 0) @ weights[2] + weights[3], y[judged])
        if now < best[0]:
            best = now, list(weights)
    w = best[1]
    network = Network(shift, scale, w[0], w[1], w[2], float(w[3]))
    logits = network.logits(x[judged])
    network.temperature = float(min(np.geomspace(0.5, 8, 57), key=lambda t: loss(logits / t, y[judged])))
    return network


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    indexing: Indexing | None = None,
    sample: int = 20_000,
    fit: Callable[[np.ndarray, np.ndarray], Network] = fit_network,
) -> DataFrame:
    """``doc_id, score`` for every row: how likely ``label`` is 1, by the text alone.

    ``labels`` has ``doc_id`` and ``label``. Vectors are learned from all texts. The network learns from at
    most ``sample`` labels, those of the least id hash, and of rows that share an id from the one of the
    least text hash; this bounds what the driver holds.

    Null and empty texts have no words and get the score of that. Null labels are left out; without labels, or
    with one label only, every score is the share of 1 among them, 0.5 if there are none. Null ids
    and repeated rows are scored like any other; an empty table gives an empty one.
    Only ``doc_id`` and ``text`` are read.
    """
    let_workers_import(docs.sparkSession)
    indexing = indexing or Indexing()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("double").alias("label")).where("label is not null and doc_id is not null")
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample)
    vectors = docs.sparkSession.sparkContext.broadcast(word_vectors(rows, indexing))
    width = 2 * (indexing.size + 1) + 1

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, spelled, shaped in _blocks(batches, indexing):
            found = _features(spelled, shaped, vectors.value).astype(np.float32)
            columns = [pa.array([k[i] for k in keys], kind) for i, kind in enumerate((pa.float64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([f.tobytes() for f in found], pa.binary())], ["label", "mark", "features"])

    once = rows.join(F.broadcast(known.select("doc_id").distinct()), "doc_id").groupBy("doc_id")
    learned = once.agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")).join(F.broadcast(known), "doc_id")
    learned = learned.select("label", F.xxhash64("doc_id", "text").alias("mark"), "text")
    learned = learned.mapInArrow(describe, "label double, mark long, features binary").collect()
    found = sorted(learned, key=lambda r: (r["mark"], r["label"]))
    y = np.array([r["label"] for r in found])
    if len(set(y)) < 2:
        return rows.select("doc_id", F.lit(float(y.mean()) if len(y) else 0.5).alias("score"))
    x = np.frombuffer(b"".join(bytes(r["features"]) for r in found), np.float32).reshape(-1, width).astype(float)
    network = fit(x, y)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, spelled, shaped in _blocks(batches, indexing):
            scores = network.scores(_features(spelled, shaped, vectors.value))
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int64()), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return rows.select(F.col("doc_id").cast("long"), "text").mapInArrow(score, "doc_id long, score double")
