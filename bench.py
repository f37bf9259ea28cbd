"""Headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; prints one JSON line.

Bronze and silver tables that scans and runs need are laid out once, before anything is timed.
"""

from __future__ import annotations

import json
import os
import re
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks import QUERIES
from checks.stand_ins import ICD_ITEMS, mortality, outpatient
from checks.storage import bronze_of
from vitaria.plans.chain import run_table
from vitaria.plans.specs import SPECS
from vitaria.sinks.shared import drop_kept, new_folder
from vitaria.sources import CodeDictionary, read_silver, scan_bronze

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
REPEATS = int(os.environ.get("BENCH_REPEATS", "2"))

HEADLINE = [
    "chain_mortality", "chain_outpatient", "chain_admissions",
    "drop_columns", "recode_multi", "decode_age", "icd_two_columns", "prefix_lookup", "prefix_lookup_large_dictionary",
    "year_filter", "year_frequency", "value_counts", "audit_counts", "audit_diff", "quarantine_age",
    "missing_partitions", "region_enrich", "table_roundtrip", "chain_lineage",
]


def session() -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
    )
    spark = builder.getOrCreate()
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepared(spark: SparkSession) -> dict[str, Callable[[], DataFrame]]:
    """Scans and runs over tables that are laid out here."""
    outpatients = bronze_of(outpatient(spark, SF_DIR), "sia-parquet/AM", "AM")
    deaths = bronze_of(mortality(spark, SF_DIR), "sim-parquet", "DO")
    dictionary = CodeDictionary.from_entries(spark, ICD_ITEMS)
    stored = new_folder(spark, "silver")

    def run(silver: str) -> DataFrame:
        run_table(spark, SPECS["SIM.DO"], deaths, silver, ["PE", "PI"], range(1990, 2010), dictionary=dictionary)
        return read_silver(spark, silver, "SIM", "DO")

    run(stored)
    return {
        "run_mortality": lambda: run(new_folder(spark, "silver")),
        "scan_outpatient": lambda: scan_bronze(spark, outpatients, SPECS["SIA.AM"].layout, ["SP"], [1999, 2000], [1, 2, 12]),
        "silver_read": lambda: read_silver(spark, stored, "SIM", "DO").where("ano = '1997' and uf = 'PE'"),
    }


def measure(build: Callable[[], DataFrame]) -> float:
    """Time from building a query to its last row, writes it makes included."""
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = session()
    timed = {name: (lambda name=name: QUERIES[name](spark, SF_DIR)) for name in HEADLINE} | prepared(spark)
    for build in timed.values():  # first a round that is not counted
        measure(build)
    seconds = {name: round(min(measure(build) for _ in range(REPEATS)), 3) for name, build in timed.items()}
    drop_kept(spark)
    scale = re.search(r"sf([\d.]+)", SF_DIR)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
