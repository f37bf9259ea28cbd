"""Packing tokens into sequences: bounded-space online best fit.

Every partition keeps a fixed number of open windows. A piece of a document goes
to the window in which it leaves least room. When it fits in none, the fullest is
topped up with the piece's first tokens and emitted, and the rest of the piece is
placed again. What is open at the end is joined into whole windows, and the one
unfilled rest of each partition is merged with others in rounds of bounded groups.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitaria.llm.session import let_workers_import
from vitaria.llm.words import SPACES, hash_spans, spans
from vitaria.sinks.shared import keep_table

_PIECE = pa.schema(
    [("doc", pa.int64()), ("doc_row", pa.int64()), ("start", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()),
     ("sequence_id", pa.int64()), ("offset", pa.int64())]
)
_OUT_DDL = (
    "doc long, doc_row long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long,"
    " ids binary, whole boolean, place long"
)
_OUT = pa.schema(
    [("doc", pa.int64()), ("doc_row", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
     ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary()),
     ("whole", pa.bool_()), ("place", pa.int64())]
)
#: Sequences numbered by one partition or group.
_NUMBERS = 1 << 32
#: Unfilled rests merged in one group.
MERGE_AT_ONCE = 256


class _Piece:
    """Consecutive tokens of one document."""

    __slots__ = ("doc", "row", "start", "ids", "total")

    def __init__(self, doc, row: int, start: int, ids: np.ndarray, total: int):
        self.doc, self.row, self.start, self.ids, self.total = doc, row, start, ids, total

    def cut(self, at: int) -> tuple[_Piece, _Piece]:
        first = _Piece(self.doc, self.row, self.start, self.ids[:at], self.total)
        return first, _Piece(self.doc, self.row, self.start + at, self.ids[at:], self.total)


def _fill(pieces: Iterator[_Piece], size: int) -> Iterator[list[_Piece]]:
    """Pieces end to end in windows of ``size``; only the last may be shorter."""
    window, room = [], size
    for piece in pieces:
        while len(piece.ids) > room:
            first, piece = piece.cut(room) if room else (None, piece)
            yield [*window, first] if first else window
            window, room = [], size
        if len(piece.ids):
            window.append(piece)
            room -= len(piece.ids)
    if window:
        yield window


def best_fit(pieces: Iterator[_Piece], size: int, windows: int) -> Iterator[list[_Piece]]:
    """Windows of ``size`` tokens, all full but the last, with at most ``windows`` open at once."""
    room: list[tuple[int, int]] = []  # (free tokens, number) of the open windows, ascending
    content: dict[int, list[_Piece]] = {}
    number = 0
    for piece in pieces:
        while len(piece.ids):
            need = len(piece.ids)
            if need >= size:
                first, piece = piece.cut(size)
                yield [first]
                continue
            at = bisect_left(room, (need, -1))
            if at == len(room) and len(room) < windows:
                room.append((size, number))
                content[number] = []
                number += 1
                at = bisect_left(room := sorted(room), (need, -1))
            if at == len(room):  # fits in none
                free, chosen = room.pop(0)
                first, piece = piece.cut(free)
                yield [*content.pop(chosen), first]
                continue
            free, chosen = room.pop(at)
            content[chosen].append(piece)
            if free == need:
                yield content.pop(chosen)
            else:
                insort(room, (free - need, chosen))
            break
    left = [content[chosen] for _, chosen in room]
    yield from _fill((p for window in left for p in window), size)


def _rows(windows: Iterator[list[_Piece]], size: int, place: int) -> Iterator[pa.RecordBatch]:
    """Numbered windows as rows; a window that isn't full keeps its ids for a later merge."""
    rows: list[tuple] = []

    def batch() -> pa.RecordBatch:
        columns = [pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), _OUT, strict=True)]
        rows.clear()
        return pa.RecordBatch.from_arrays(columns, schema=_OUT)

    for number, window in enumerate(windows):
        whole, offset = sum(len(p.ids) for p in window) == size, 0
        for p in window:
            data = p.ids.astype("<u4", copy=False).tobytes()
            rows.append((p.doc, p.row, p.start, len(p.ids), zlib.crc32(data), p.total, place * _NUMBERS + number, offset,
                         None if whole else data, whole, place))
            offset += len(p.ids)
        if len(rows) > 20_000:
            yield batch()
    if rows:
        yield batch()


def _pack(tokens: Callable[[], Callable[[list], Iterator[np.ndarray]]], size: int, windows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, place = tokens(), TaskContext.get().partitionId()

        def pieces() -> Iterator[_Piece]:
            row = 0
            for batch in batches:
                for at in range(0, len(batch), 256):
                    some = batch.slice(at, 256)
                    for doc, ids in zip(some.column("doc").to_pylist(), encode(some.column("text").to_pylist()), strict=True):
                        yield _Piece(doc, place * _NUMBERS + row, 0, ids, len(ids))
                        row += 1

        yield from _rows(best_fit(pieces(), size, windows), size, place)

    return run


def _merge(size: int, base: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("place", "ascending"), ("sequence_id", "ascending"), ("offset", "ascending")])
        rows = table.select(["doc", "doc_row", "start", "ids", "doc_tokens"]).to_pylist()
        pieces = (_Piece(r["doc"], r["doc_row"], r["start"], np.frombuffer(r["ids"], "<u4"), r["doc_tokens"]) for r in rows)
        return pa.Table.from_batches(_rows(_fill(pieces, size), size, base + table.column("group")[0].as_py()), _OUT)

    return run


def pack_documents(
    docs: DataFrame,
    tokens: Callable[[], Callable[[list], Iterator[np.ndarray]]],
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = 2048,
    windows: int = 64,
) -> DataFrame:
    """Pieces of all documents: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, padding, doc_row``.

    ``tokens`` is called in each task and gives a function from a list of texts to
    the token ids of each. Every token lies in one piece, pieces of a sequence lie
    end to end from offset 0, and all sequences hold ``size`` tokens but one, which
    ``padding`` fills up unless its length is a power of two. ``doc_row`` tells rows
    of one id apart.

    A null text is handed on as empty; a document without tokens has no piece. A
    null id stays null. An empty table has no pieces. Other columns are not read.
    """
    let_workers_import(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    packed = keep_table(rows.mapInArrow(_pack(tokens, size, windows), _OUT_DDL), "packed")
    done, rests = [packed.where("whole")], packed.where("not whole")
    base = (packed.agg(F.max("place")).first()[0] or 0) + 1
    while True:
        groups = rests.agg(F.count_distinct("place"), F.max("place")).first()
        if groups[0] <= 1:
            break
        low = rests.agg(F.min("place")).first()[0]
        grouped = rests.withColumn("group", F.floor((F.col("place") - low) / MERGE_AT_ONCE).cast("long"))
        merged = keep_table(grouped.groupBy("group").applyInArrow(_merge(size, base), _OUT_DDL), "merged")
        done.append(merged.where("whole"))
        rests, base = merged.where("not whole"), base + (groups[1] - low) // MERGE_AT_ONCE + 1
    out = rests
    for part in done:
        out = out.union(part)
    filled = F.col("offset") + F.col("length")
    last = out.groupBy("sequence_id").agg(F.max(filled).alias("filled")).where(F.col("filled") < size)
    short = F.when(F.bit_count("filled") == 1, 0).otherwise(size - F.col("filled"))
    padding = F.coalesce(short, F.lit(0)).cast("long").alias("padding")
    return out.join(last, "sequence_id", "left").select(
        F.col("doc").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", padding, "doc_row"
    )


_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Signs that a tokenizer by kinds of characters parts from a letter before them; not the apostrophe.
_SIGNS = b".,;:!?*#$%&+=|()[]{}<>/\\\"-_~^@"


class _WordIds:
    """Token ids of white-space separated words, remembered for the words met last.

    Words are looked up all at once by their hashes; only those not met lately are handled one by one.
    """

    def __init__(self, path: str, held: int):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        self.tokenizer, self.held = Tokenizer.from_file(path), held
        self.special = [x.content.encode() for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.holds_special = re.compile(b"|".join(map(re.escape, self.special)) or b"(?!)").search
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.recent: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self._forget()

    def _forget(self) -> None:
        self.known, self.pool = np.empty(0, np.uint64), np.empty(0, "<u4")  # hashes ascending, and all ids one after the other
        self.at, self.length = np.empty(0, np.int64), np.empty(0, np.int64)  # where each word's ids lie

    def own_spelling(self, raw: bytes, lower: bytes) -> bytes:
        """Texts in lower case, but for words that become an added token by it: to the tokenizer they are none."""
        if raw == lower or not any(x in lower for x in self.special):
            return lower
        out = bytearray(lower)
        for special in self.special:
            at = lower.find(special)
            while at >= 0:
                a, b = at, at + len(special)
                while a > 0 and lower[a - 1] not in SPACES:
                    a -= 1
                while b < len(lower) and lower[b] not in SPACES:
                    b += 1
                out[a:b] = raw[a:b]
                at = lower.find(special, b)
        return bytes(out)

    def ids(self, text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and how many each has."""
        hashes = hash_spans(np.frombuffer(text, np.uint8), starts, ends)
        different, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) > self.held:
            self._forget()
        place = np.searchsorted(self.known, different)
        missing = np.ones(len(different), bool)
        inside = place < len(self.known)
        missing[inside] = self.known[place[inside]] != different[inside]
        if missing.any():
            words = [text[a:b] for a, b in zip(starts[first[missing]].tolist(), ends[first[missing]].tolist(), strict=True)]
            self.learn(set(words))
            found = [self.recent[word] for word in words]
            lengths = np.array([len(x) // 4 for x in found], np.int64)
            begins = len(self.pool) + np.cumsum(lengths) - lengths
            self.pool = np.concatenate([self.pool, np.frombuffer(b"".join(found), "<u4")])
            at = place[missing]
            self.known = np.insert(self.known, at, different[missing])
            self.at, self.length = np.insert(self.at, at, begins), np.insert(self.length, at, lengths)
            place = np.searchsorted(self.known, different)
        lengths = self.length[place][which]
        ends_at = np.cumsum(lengths)
        total = int(ends_at[-1]) if len(ends_at) else 0
        return self.pool[np.arange(total) + np.repeat(self.at[place][which] - (ends_at - lengths), lengths)], lengths

    def _one_by_one(self, texts: list[str]) -> Iterator[bytes]:
        for found in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            yield array("I", found.ids).tobytes()

    def _encode(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of words. Words of letters only go together: where each gives one id that ends a word, these tell them apart."""
        out, joined, single = {}, [], []
        for word in words:
            (joined if word.decode("utf-8", "replace").isalpha() else single).append(word)
        groups = [joined[at : at + 64] for at in range(0, len(joined), 64)]
        found = self.tokenizer.encode_batch_fast([b" ".join(g).decode() for g in groups], add_special_tokens=False)
        for group, one in zip(groups, found, strict=True):
            ids = np.array(one.ids, "<u4")
            ends = (np.flatnonzero(self.ends_word[ids]) + 1) * 4
            if len(ends) == len(group) and ends[-1] == 4 * len(ids):
                data = ids.tobytes()
                cuts = [0, *ends.tolist()]
                out.update(zip(group, map(data.__getitem__, map(slice, cuts, cuts[1:])), strict=False))
            else:
                single += group
        for at in range(0, len(single), 4096):
            some = single[at : at + 4096]
            out.update(zip(some, self._one_by_one([w.decode("utf-8", "replace") for w in some]), strict=True))
        return out

    def learn(self, words: set[bytes]) -> None:
        """Words of the next texts, and nothing that is known already, are encoded.

        Signs after a letter are a piece of their own to the tokenizer, so a word is
        put together from what is before them and the signs.
        """
        if len(self.recent) > self.held:
            self.older, self.recent = self.recent, {}
        recent, older = self.recent, self.older
        fresh, joined = set(), []
        for word in words:
            if word in recent:
                continue
            if (ids := older.get(word)) is not None:
                recent[word] = ids
                continue
            stem = word.rstrip(_SIGNS)
            if len(stem) in (0, len(word)) or not 97 <= stem[-1] <= 122 or self.holds_special(word):
                fresh.add(word)
                continue
            joined.append((word, stem, word[len(stem) :]))
            for part in joined[-1][1:]:
                if part not in recent:
                    if (ids := older.get(part)) is not None:
                        recent[part] = ids
                    else:
                        fresh.add(part)
        recent.update(self._encode(list(fresh)))
        for word, stem, signs in joined:
            recent[word] = recent[stem] + recent[signs]


_word_ids: dict[tuple[str, int], _WordIds] = {}


def word_tokens(path: str, end_id: int = 1, held: int = 300_000):
    """Token ids of texts by a public tokenizer without case that parts words at white space, followed by ``end_id``.

    Such a tokenizer gives a text the ids of its words one after the other, so each
    different word is encoded once and remembered by the Python worker, about ``held`` at a time.
    """

    def start() -> Callable[[list], Iterator[np.ndarray]]:
        if (path, held) not in _word_ids:
            _word_ids[path, held] = _WordIds(path, held)
        known = _word_ids[path, held]

        def encode(texts: list) -> Iterator[np.ndarray]:
            raw = [text.encode("utf-8", "surrogatepass") for text in texts]
            joined = b"\n".join(raw)
            text = known.own_spelling(joined, joined.translate(_LOWER))
            starts, ends = spans(np.frombuffer(text, np.uint8))
            ids, lengths = known.ids(text, starts, ends)
            begins = np.cumsum([0, *(len(x) + 1 for x in raw)])
            cuts = np.r_[0, np.cumsum(lengths)][np.searchsorted(starts, begins)]
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                yield np.append(ids[a:b], np.uint32(end_id))

        return encode

    return start
