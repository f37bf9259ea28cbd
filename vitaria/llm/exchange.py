"""Numbers sent from pieces of a table to parts of their range, and answers sent back.

Hashes of many windows are dealt by range in sorted blobs instead of a row each:
a piece sends one row to each part that it has hashes in.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text in one piece.
PIECE_BYTES = 3 << 20
LEAST_PIECES = 64


def piece_count(docs: DataFrame, text: str, piece_bytes: int = PIECE_BYTES) -> int:
    """Pieces of about ``piece_bytes`` of text each."""
    size = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    return max(LEAST_PIECES, -(-size // piece_bytes))


def piece_of(pieces: int, doc_id: str, text: str) -> Column:
    """Piece of a row, by its id and text."""
    return F.pmod(F.xxhash64(F.col(doc_id), F.col(text)), F.lit(pieces)).cast("int")


def part_cuts(hashes: np.ndarray, parts: int) -> Iterator[tuple[int, int, int]]:
    """``(part, from, to)`` for every part of the range that sorted hashes reach."""
    own = hashes // np.uint64((1 << 64) // parts + 1)
    edges = [*np.flatnonzero(np.r_[True, own[1:] != own[:-1]]).tolist(), len(hashes)] if len(hashes) else []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        yield int(own[a]), a, b


def pack(numbers: np.ndarray) -> bytes:
    """Bytes of whole numbers, all first bytes first: small numbers then compress well."""
    return np.ascontiguousarray(numbers).view(np.uint8).reshape(len(numbers), numbers.itemsize).T.tobytes()


def unpack(data: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).ravel()


def texts_of(table: pa.Table, text: str) -> list[bytes]:
    """UTF-8 of each text, nothing for null."""
    column = table.column(text).cast(pa.large_binary())
    return [x or b"" for x in column.to_pylist()]


def ids_of(table: pa.Table, doc_id: str) -> np.ndarray:
    """Ids as whole numbers, null as the greatest one."""
    return table.column(doc_id).cast(pa.int64()).fill_null(np.iinfo(np.int64).max).to_numpy()
