"""Exact repeats of word sequences across documents, found by fixed-block anchors.

Every document is parted into non-overlapping blocks of half a window; their
hashes are the index. All documents probe it with every rolling window of that
length. A window of twice the length that repeats holds a whole block, so wherever a
repeat lies a probe hits. Around the hits the full windows are compared, and runs
of windows that an earlier document has are the maximal exact repeats.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from vitaria.llm.exchange import ids_of, pack, part_cuts, piece_count, piece_of, texts_of, unpack
from vitaria.llm.session import let_workers_import
from vitaria.llm.words import hash_spans, hash_windows, spans

_SENT = pa.schema([("part", pa.int32()), ("piece", pa.int32()), ("hashes", pa.binary()), ("docs", pa.binary())])
_ANSWER = pa.schema([("piece", pa.int32()), ("hashes", pa.binary()), ("docs", pa.binary())])
_SENT_DDL = "part int, piece int, hashes binary, docs binary"
_ANSWER_DDL = "piece int, hashes binary, docs binary"
_ANCHOR, _SEVERAL = np.uint32(1), np.uint32(2)


class _Words:
    """All words of a piece, document after document; only documents that hold a window."""

    def __init__(self, table: pa.Table, names: tuple[str, str], window: int):
        self.ids, self.texts = ids_of(table, names[0]), texts_of(table, names[1])
        found, hashes, counts = [], [], []
        for text in self.texts:
            data = np.frombuffer(text, np.uint8)
            starts, ends = spans(data)
            found.append((starts, ends))
            counts.append(len(starts))
            hashes.append(hash_spans(data, starts, ends) if len(starts) >= window else np.empty(0, np.uint64))
        self.spans, self.counts = found, np.array(counts, np.int64)
        lengths = np.array([len(x) for x in hashes], np.int64)
        self.hashes = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        self.begins = np.cumsum(lengths) - lengths
        self.owner = np.repeat(np.arange(len(lengths)), lengths)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every window inside one document."""
        hashes = hash_windows(self.hashes, size)
        inside = np.flatnonzero(self.owner[: len(hashes)] == self.owner[size - 1 :])
        return inside, hashes[inside]


def _probes(key: tuple[str, str], window: int, parts: int):
    """Rolling and anchor blocks of a piece: 30 bits of each different hash within its part, and two marks.

    Parts grow in number with the texts, so the bits left out let the same small
    share of false hits through at any size; full windows are compared later.
    """
    size = window // 2

    def run(table: pa.Table) -> pa.Table:
        words = _Words(table, key, window)
        at, hashes = words.windows(size)
        docs = words.ids[words.owner[at]]
        order = np.argsort(hashes, kind="stable")
        hashes, docs = hashes[order], docs[order]
        anchor = ((at - words.begins[words.owner[at]]) % size == 0)[order]
        first = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]]) if len(hashes) else np.empty(0, np.int64)
        marks = np.zeros(len(first), np.uint32)
        if len(first):
            marks |= np.logical_or.reduceat(anchor, first) * _ANCHOR
            marks |= (np.minimum.reduceat(docs, first) != np.maximum.reduceat(docs, first)) * _SEVERAL
        hashes, width = hashes[first], (1 << 64) // parts + 1
        piece = table.column("rep_piece")[0].as_py()
        rows = []
        for part, a, b in part_cuts(hashes, parts):
            inside = ((hashes[a:b] - np.uint64(part * width)) // np.uint64(-(-width // (1 << 30)))).astype(np.uint32)
            rows.append((part, piece, pack(inside << np.uint32(2) | marks[a:b]), b""))
        return pa.Table.from_pylist([dict(zip(_SENT.names, r, strict=True)) for r in rows], _SENT)

    return run


def _hits(table: pa.Table) -> pa.Table:
    """To every piece those of its block hashes that are anchors and lie in several documents."""
    pieces, blobs = table.column("piece").to_pylist(), [unpack(x, np.uint32) for x in table.column("hashes").to_pylist()]
    every = np.sort(np.concatenate(blobs))
    values = every >> np.uint32(2)
    first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    marks = np.bitwise_or.reduceat(every & np.uint32(3), first)
    twice = np.diff(np.r_[first, len(values)]) > 1
    hit = values[first][((marks & _ANCHOR) > 0) & (twice | ((marks & _SEVERAL) > 0))]
    part = table.column("part")[0].as_py()
    rows = []
    for piece, blob in zip(pieces, blobs, strict=True):
        own = blob >> np.uint32(2)
        if len(own := np.unique(own[np.isin(own, hit)])):
            rows.append({"piece": piece, "hashes": pack(own), "docs": np.int32(part).tobytes()})
    return pa.Table.from_pylist(rows, _ANSWER)


def _candidates(key: tuple[str, str], window: int, parts: int):
    """Different full windows around the hits of a piece, each with the least id that has it."""
    size, width = window // 2, (1 << 64) // parts + 1

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(table) or not len(answers):
            return _SENT.empty_table()
        words = _Words(table, key, window)
        at, hashes = words.windows(size)
        part = hashes // np.uint64(width)
        inside = (hashes - part * np.uint64(width)) // np.uint64(-(-width // (1 << 30)))
        keys = part << np.uint64(32) | inside
        known = [
            (np.uint64(np.frombuffer(d, np.int32)[0]) << np.uint64(32)) | unpack(h, np.uint32).astype(np.uint64)
            for h, d in zip(answers.column("hashes").to_pylist(), answers.column("docs").to_pylist(), strict=True)
        ]
        hit = at[np.isin(keys, np.concatenate(known))]
        marks = np.zeros(len(words.hashes) + 1, np.int32)
        np.add.at(marks, np.maximum(hit - (window - size), 0), 1)
        np.add.at(marks, hit + 1, -1)
        near = np.cumsum(marks[:-1]) > 0
        at, hashes = words.windows(window)
        chosen = near[at]
        at, hashes = at[chosen], hashes[chosen]
        docs = words.ids[words.owner[at]]
        order = np.argsort(hashes, kind="stable")
        hashes, docs = hashes[order], docs[order]
        if not len(hashes):
            return _SENT.empty_table()
        first = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]])
        hashes, least, most = hashes[first], np.minimum.reduceat(docs, first), np.maximum.reduceat(docs, first)
        piece = table.column("rep_piece")[0].as_py()
        rows = [(p, piece, pack(hashes[a:b]), pack(least[a:b]) + pack(most[a:b])) for p, a, b in part_cuts(hashes, parts)]
        return pa.Table.from_pylist([dict(zip(_SENT.names, r, strict=True)) for r in rows], _SENT)

    return run


def _repeats(table: pa.Table) -> pa.Table:
    """To every piece those of its windows that a document of lesser id has too, and that id."""
    blobs = [unpack(x, np.uint64) for x in table.column("hashes").to_pylist()]
    bounds = [np.split(np.frombuffer(x, np.uint8), 2) for x in table.column("docs").to_pylist()]
    every = np.concatenate(blobs)
    least = np.concatenate([unpack(x[0].tobytes(), np.int64) for x in bounds])
    order = np.argsort(every, kind="stable")
    first = np.flatnonzero(np.r_[True, every[order][1:] != every[order][:-1]])
    hashes, lowest = every[order][first], np.minimum.reduceat(least[order], first)
    rows = []
    for piece, blob, (_, most) in zip(table.column("piece").to_pylist(), blobs, bounds, strict=True):
        low = lowest[np.searchsorted(hashes, blob)]
        later = unpack(most.tobytes(), np.int64) > low
        if later.any():
            rows.append({"piece": piece, "hashes": pack(blob[later]), "docs": pack(low[later])})
    return pa.Table.from_pylist(rows, _ANSWER)


def _runs(covered: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.r_[0, covered.astype(np.int8), 0]))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def _without(text: bytes, spans_: tuple[np.ndarray, np.ndarray], runs: list[tuple[int, int]]) -> bytes:
    """Text without runs of words; each run goes with the white space that follows it."""
    starts, kept, at = spans_[0], [], 0
    for first, end in runs:
        kept.append(text[at : starts[first]])
        at = int(starts[end]) if end < len(starts) else len(text)
    return b"".join([*kept, text[at:]])


def _cut(key: tuple[str, str], window: int, names: list[str], schema: pa.Schema):
    """Rows of a piece with the spans of repeats and the text without them."""

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(table):
            return schema.empty_table()
        words = _Words(table, key, window)
        removed = np.zeros(len(words.hashes) + 1, np.int32)
        if len(answers):
            known = np.concatenate([unpack(x, np.uint64) for x in answers.column("hashes").to_pylist()])
            lowest = np.concatenate([unpack(x, np.int64) for x in answers.column("docs").to_pylist()])
            order = np.argsort(known)
            known, lowest = known[order], lowest[order]
            at, hashes = words.windows(window)
            place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            again = at[(known[place] == hashes) & (lowest[place] < words.ids[words.owner[at]])]
            removed[again] += 1
            np.subtract.at(removed, again + window, 1)
        covered = np.cumsum(removed[:-1]) > 0
        kept, found = [], []
        for i, text in enumerate(words.texts):
            begin = words.begins[i]
            count = words.counts[i] if words.counts[i] >= window else 0
            runs = _runs(covered[begin : begin + count]) if count else []
            found.append([{"start": a, "end": b} for a, b in runs])
            kept.append(_without(text, words.spans[i], runs))
        columns = [table.column(n) for n in names]
        counts = pa.array(words.counts, pa.int64())
        removed_words = pa.array([sum(s["end"] - s["start"] for s in x) for x in found], pa.int64())
        text = pa.array(kept, pa.binary()).cast(pa.string())
        return pa.Table.from_arrays([*columns, counts, removed_words, pa.array(found, schema.field(len(schema) - 2).type), text], schema=schema)

    return run


def mark_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", window: int = 50) -> DataFrame:
    """Rows with ``rep_words``, ``rep_removed``, ``rep_spans`` (first word, word after the last) and ``rep_kept``.

    A word is removed if it lies in a window of ``window`` words that also starts in a
    document of a lesser id; windows are judged on the given texts. A removed run
    goes with the white space after it; what is kept stays as it was.

    Null texts have no words and an empty ``rep_kept``. A null id comes after all
    others. Rows of one id, repeated ones too, are never judged by each other, and
    texts shorter than a window never lose a word. An empty table gives an empty one.
    Columns named ``rep_*`` are replaced; all other columns stay as they are. Windows
    are told apart by 64-bit hashes.
    """
    if window < 2 or window % 2:
        raise ValueError("window must be an even number of words")
    let_workers_import(docs.sparkSession)
    docs = docs.drop(*[c for c in docs.columns if c.startswith("rep_")])
    names = docs.columns
    parts = piece_count(docs, text)
    held, key = docs.withColumn("rep_piece", piece_of(parts, doc_id, text)), (doc_id, text)
    pieces = lambda: held.groupBy("rep_piece")

    hits = pieces().applyInArrow(_probes(key, window, parts), _SENT_DDL).groupBy("part").applyInArrow(_hits, _ANSWER_DDL)
    windows = pieces().cogroup(hits.groupBy("piece")).applyInArrow(_candidates(key, window, parts), _SENT_DDL)
    repeats = windows.groupBy("part").applyInArrow(_repeats, _ANSWER_DDL)

    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    added = T.StructType().add("rep_words", "long").add("rep_removed", "long").add("rep_spans", span).add("rep_kept", "string")
    schema = T.StructType([*docs.schema.fields, *added.fields])
    arrow = to_arrow_schema(schema)
    return pieces().cogroup(repeats.groupBy("piece")).applyInArrow(_cut(key, window, names, arrow), schema)
