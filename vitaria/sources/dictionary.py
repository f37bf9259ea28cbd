"""Code dictionaries such as ICD-10: code, description and place in the file."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitaria import rules
from vitaria.operators.joins import BroadcastBound, fits
from vitaria.sinks.shared import keep_table

_ENTRIES = pa.schema([("ord", pa.int64()), ("code", pa.string()), ("description", pa.string())])
_PROBE = pa.schema([("code", pa.string()), ("exact", pa.string()), ("best", pa.string())])


@dataclass(frozen=True)
class CodeDictionary:
    """``frame(ord, code, description)``, one row per code.

    ``small`` tells that the entries were counted and stay within the broadcast
    bound. ``lengths`` are the different lengths of its codes. A small
    dictionary also has ``probes``, per length a frame ``(code, exact, best)``:
    the text for that very code, and the text for a longer code of which it is
    the longest listed beginning.
    """

    frame: DataFrame
    lengths: tuple[int, ...]
    small: bool
    probes: Mapping[int, DataFrame] = field(default_factory=dict)

    @classmethod
    def from_entries(
        cls, spark: SparkSession, items: Iterable[Mapping], bound: BroadcastBound = BroadcastBound()
    ) -> CodeDictionary:
        """From ``{"code", "description"}`` items held by the driver."""
        return cls._local(spark, rules.dictionary_entries(items), bound)

    @classmethod
    def from_json(cls, spark: SparkSession, path: str, bound: BroadcastBound = BroadcastBound()) -> CodeDictionary:
        """From a JSON file holding one array of ``{"code", "description"}``."""
        whole = spark.read.text(path, wholetext=True)
        items = F.from_json(
            "value", "array<struct<code:string,description:string>>", {"mode": "FAILFAST"}
        )
        return cls.from_frame(whole.select(F.posexplode(items).alias("ord", "e")).select("ord", "e.*"), bound)

    @classmethod
    def from_frame(cls, frame: DataFrame, bound: BroadcastBound = BroadcastBound()) -> CodeDictionary:
        """From a DataFrame ``(ord, code, description)`` of any size.

        Within the bound the entries are taken to the driver once, as a
        broadcast would do anyway; beyond it they stay distributed.
        """
        entries = keep_table(
            frame.where(F.col("code").isNotNull())
            .groupBy("code")
            .agg(F.min("ord").alias("first"), F.max_by("description", "ord").alias("description"))
            .select(F.col("first").cast("long").alias("ord"), "code", "description"),
            "dictionary",
        )
        if fits(entries, bound):
            rows = [tuple(row) for row in entries.orderBy("ord").collect()]
            return cls._local(frame.sparkSession, rows, bound)
        lengths = entries.agg(F.sort_array(F.collect_set(F.length("code")))).first()[0]
        return cls(entries, tuple(lengths), False)

    @classmethod
    def _local(cls, spark: SparkSession, rows: list[tuple], bound: BroadcastBound) -> CodeDictionary:
        entries = _table(rows, _ENTRIES)
        frame = spark.createDataFrame(entries)
        by_code = {code: (place, text) for place, code, text in rows}
        lengths = tuple(sorted({len(code) for code in by_code}))
        if entries.num_rows > bound.rows or entries.nbytes > bound.size:
            return cls(frame, lengths, False)
        probes: dict[int, list[tuple]] = {n: [] for n in lengths}
        for code, (_, text) in by_code.items():
            # every listed code that begins a text also begins the longest one that does
            starts = (by_code.get(code[:n]) for n in lengths if n <= len(code))
            best = min((start for start in starts if start is not None), key=lambda start: start[0])[1]
            probes[len(code)].append((code, best if text == code else text, best))
        return cls(
            frame, lengths, True, {n: spark.createDataFrame(_table(part, _PROBE)) for n, part in probes.items()}
        )


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.table([pa.array(values, kind.type) for values, kind in zip(columns, schema)], schema=schema)
