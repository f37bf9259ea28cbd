"""What tasks need from the session."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession

_ROOT = str(Path(__file__).resolve().parents[2])


def let_workers_import(spark: SparkSession) -> None:
    """Python workers look for this library where the driver found it, besides where it is installed."""
    known = spark.sparkContext.environment
    if _ROOT not in known.get("PYTHONPATH", "").split(":"):
        known["PYTHONPATH"] = ":".join(filter(None, [known.get("PYTHONPATH", ""), _ROOT]))
