"""Order MinHash fingerprints of texts, and of each text with its end taken from the next one.

A text is the sequence of its character k-mers, each numbered by its occurrence. Each
of ``functions`` hash functions selects the ``tuple_size`` k-mers of least hash; these go
into the signature in the order in which they stand in the text. Two texts agree in an
entry only if they share k-mers and have them in the same order, so the share
of equal entries falls with edit distance.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from vitaria.llm.session import let_workers_import
from vitaria.llm.words import hash_windows, mix

_AT_ONCE = 1 << 18  # hash values held at once
#: Bytes of text of neighbouring documents in one range of ids.
RANGE_BYTES = 8 << 20
LEAST_RANGES = 64
#: Ranges are streamed, so fewer and larger ones need no more memory; the driver holds a row for each.
MOST_RANGES = 20_000


class OrderMinHash:
    """Signatures with fixed parameters."""

    def __init__(self, kmer: int = 8, tuple_size: int = 2, functions: int = 32, seed: int = 1):
        self.kmer, self.tuple_size, self.functions = kmer, tuple_size, functions
        with np.errstate(over="ignore"):
            numbers = mix(np.arange(1, 2 * functions + 1, dtype=np.uint64) + np.uint64(seed << 32))
        self.masks, self.factors = numbers[:functions], numbers[functions:] | np.uint64(1)

    def numbered(self, text: str) -> np.ndarray:
        """Hash of every k-mer with its occurrence; a shorter text is one k-mer, an empty one none."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        hashes = hash_windows(mix(points + np.uint64(1)), max(1, min(self.kmer, len(points))))
        if len(hashes) < 2:
            return hashes
        order = np.argsort(hashes, kind="stable")
        ordered = hashes[order]
        first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
        if len(first) == len(hashes):
            return hashes
        occurrence = np.empty(len(hashes), np.uint64)
        occurrence[order] = np.arange(len(hashes)) - np.repeat(first, np.diff(np.r_[first, len(hashes)]))
        return mix(hashes + occurrence * np.uint64(0x9E3779B97F4A7C15))

    def signature(self, text: str) -> np.ndarray:
        hashes = self.numbered(text)
        out = np.zeros(self.functions, np.uint64)
        if not len(hashes):
            return out.astype(np.uint32)
        size = min(self.tuple_size, len(hashes))
        step = max(1, _AT_ONCE // len(hashes))
        for at in range(0, self.functions, step):
            values = (hashes[None, :] ^ self.masks[at : at + step, None]) * self.factors[at : at + step, None]
            rows = np.arange(len(values))
            chosen = np.empty((len(values), size), np.int64)
            for k in range(size):
                chosen[:, k] = values.argmin(axis=1)
                values[rows, chosen[:, k]] = np.uint64((1 << 64) - 1)
            chosen.sort(axis=1)
            part = np.full(len(values), size, np.uint64)
            for k in range(size):
                part = mix(part * np.uint64(0x9E3779B97F4A7C15) + hashes[chosen[:, k]])
            out[at : at + step] = part
        return (out >> np.uint64(32)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal entries."""
    return float(np.mean(a == b))


def _hex(signature: np.ndarray) -> str:
    return signature.astype(">u4").tobytes().hex()


_OUT = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
     ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
)
_OUT_DDL = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
)


def _neighbours(hashing: OrderMinHash, share: int):
    """Fingerprints of rows that come by range, id and content, each range followed by the first row of the next."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            for at in range(0, len(batch), 512):
                rows, some = [], batch.slice(at, 512)
                for part, doc, text, lent in zip(*(some.column(n).to_pylist() for n in ("part", "doc", "text", "lent")), strict=True):
                    signature = hashing.signature(text)
                    if before is not None and before[0] == part:
                        _, old, old_text, old_signature = before
                        cut = len(old_text) // share
                        edited = old_text[: len(old_text) - cut] + text[:cut]
                        changed = hashing.signature(edited)
                        digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                        rows.append((old, len(old_text), digest, _hex(old_signature), _hex(changed),
                                     likeness(old_signature, changed), likeness(old_signature, signature)))
                    before = None if lent else (part, doc, text, signature)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), _OUT, strict=True)], schema=_OUT)

    return run


def fingerprint_neighbours(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", hashing: OrderMinHash | None = None, share: int = 4
) -> DataFrame:
    """Fingerprint of every text and of its edited text, and how near they and the next text's are.

    The edited text has its last ``len // share`` code points replaced by as many first ones of the next
    document by ascending id; the first follows the last. A null text is empty and has the
    fingerprint of the empty text. Null ids come first, rows of one id go by their
    text's hash. Equal texts have equal fingerprints. An empty table gives an empty one.

    Ids are dealt in ranges of about equal numbers; each range also gets the first row of the
    next one, so that neighbours meet without one task seeing all.
    """
    let_workers_import(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = min(max(LEAST_RANGES, -(-size // RANGE_BYTES)), MOST_RANGES)
    cuts = rows.agg(F.percentile_approx("doc", [i / ranges for i in range(1, ranges)], 100 * ranges)).first()[0] or []
    edges = np.unique(np.array(cuts, np.int64))

    @pandas_udf("int")
    def part_of(ids: pd.Series) -> pd.Series:
        found = np.searchsorted(edges, ids.fillna(0).to_numpy(np.int64), side="right") + 1
        return pd.Series(np.where(ids.isna(), 0, found).astype(np.int32))

    placed = rows.select(part_of("doc").alias("part"), "doc", F.xxhash64("text").alias("mark"), "text")
    # the first row of each range, one small row each on the driver
    firsts = placed.groupBy("part").agg(F.min(F.struct("doc", "mark")).alias("at")).orderBy("part").collect()
    lend = [(before.part, first.at.doc, first.at.mark) for before, first in zip(firsts, firsts[1:] + firsts[:1], strict=True)]
    wanted = docs.sparkSession.createDataFrame(lend, "part int, doc long, mark long").dropDuplicates()
    met = placed["doc"].eqNullSafe(wanted["doc"]) & (placed["mark"] == wanted["mark"])
    lent = placed.join(F.broadcast(wanted), met).select(wanted["part"], placed["doc"], placed["mark"], placed["text"])
    lent = lent.dropDuplicates(["part"])
    every = placed.withColumn("lent", F.lit(False)).union(lent.withColumn("lent", F.lit(True)))
    every = every.repartition("part").sortWithinPartitions("part", "lent", "doc", "mark")
    hashing = hashing or OrderMinHash()
    return every.select("part", "doc", "text", "lent").mapInArrow(_neighbours(hashing, share), _OUT_DDL)
