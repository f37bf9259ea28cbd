"""Words of whole texts: as Spark columns, and as numpy spans and hashes inside tasks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space that parts words: space, tab to carriage return. All other characters belong to words.
SPACES = b" \t\n\x0b\x0c\r"
SPACE_PATTERN = r"[\x20\x09-\x0D]+"

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES_AT_ONCE = 1 << 20
_powers: dict[int, np.ndarray] = {}


def word_array(text: Column) -> Column:
    """Words of a text as an array; null and empty texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_PATTERN), lambda w: w != "")


def count_words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def mix(x: np.ndarray) -> np.ndarray:
    """Bits of unsigned 64-bit numbers scattered, one to one."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def powers(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i below n."""
    held = _powers.get(base)
    if held is None or len(held) < n:
        made = np.full(max(n, 1 << 16), base, np.uint64)
        made[0] = 1
        held = np.cumprod(made, dtype=np.uint64)
        if len(held) <= 1 << 22:
            _powers[base] = held
    return held[:n]


def spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each word, and the byte after it."""
    inside = np.empty(len(data) + 2, bool)
    inside[0] = inside[-1] = False
    np.logical_not(_IS_SPACE[data], out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word by its bytes, the same wherever it lies.

    Works through the bytes a megabyte at a time, so that memory follows the
    number of words.
    """
    hashes = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(starts, starts[at] + _BYTES_AT_ONCE)))
        first, last = int(starts[at]), int(ends[to - 1])
        sums = np.zeros(last - first + 1, np.uint64)
        np.cumsum((data[first:last] + np.uint64(1)) * powers(_BASE, last - first), out=sums[1:])
        lows, highs = starts[at:to] - first, ends[at:to] - first
        plain = (sums[highs] - sums[lows]) * powers(_INVERSE, last - first)[lows]
        hashes[at:to] = mix(plain + (highs - lows).astype(np.uint64))
        at = to
    return hashes


def hash_windows(hashes: np.ndarray, size: int, base: int = 0xD1342543DE82EF95) -> np.ndarray:
    """Hash of every window of ``size`` consecutive words, by the words' hashes."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * powers(base, len(hashes)), out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * powers(pow(base, -1, 1 << 64), len(hashes))[:n])


def text_words(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text (null: none), and the span of each word in them."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    return data, *spans(data)
