"""Runs that read bronze once, lookups planned together, hot rows dealt out, rules that never apply."""

import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from vitaria.operators.codes import exact_lookup
from vitaria.operators.joins import lookup_join
from vitaria.plans import chain
from vitaria.plans.chain import run_datasets
from vitaria.plans.liveness import dead_rules, dead_rules_report
from vitaria.plans.specs import SPECS
from vitaria.sources import CodeDictionary, read_silver

SIM = SPECS["SIM.DO"]


def bronze(spark, folder, ages):
    rows = spark.createDataFrame([(i, a, str(i % 3), "A00") for i, a in enumerate(ages)], "chave int, IDADE string, SEXO string, CAUSABAS string")
    rows.coalesce(1).write.parquet(f"{folder}/DOPE2020.parquet")
    rows.drop("SEXO").limit(2).coalesce(1).write.parquet(f"{folder}/DOPI2020.parquet")
    return str(folder)


@pytest.mark.parametrize(("ages", "bad"), [(["402"] * 6, 0), (["402"] * 4 + ["4", "4xx"], 2)])
def test_one_scan_of_bronze(spark, tmp_path, monkeypatch, ages, bad):
    """The reports come from footers and from what the write counted; bronze is read again only for values it found unreadable."""
    place, silver = bronze(spark, tmp_path / "sim-parquet", ages), str(tmp_path / "silver")
    icd = CodeDictionary.from_entries(spark, [{"code": "A00", "description": "cholera"}])
    outcome = run_datasets(spark, SIM, [place], silver, icd)
    for report in (outcome.before, outcome.after, outcome.changes, outcome.missing):
        assert "parquet" not in report._jdf.queryExecution().executedPlan().toString().lower()
    counts = {r.Arquivo: (r.registros_antes, r.registros_depois) for r in outcome.changes.collect()}
    assert counts == {"DOPE2020.parquet": (6, 6), "DOPI2020.parquet": (2, 2)}
    plan = outcome.quarantine._jdf.queryExecution().optimizedPlan().toString()
    assert ("parquet" in plan) == bool(bad)
    assert {(r.dataset, r.valor, r.ocorrencias) for r in outcome.quarantine.collect()} == ({("DOPE2020", "4", 1), ("DOPE2020", "4xx", 1)} if bad else set())
    assert read_silver(spark, silver, "SIM", "DO").count() == 8


def test_dropped_columns_are_not_read_while_values_are_counted(spark, tmp_path):
    place = bronze(spark, tmp_path / "sim-parquet", ["402"] * 6)
    icd = CodeDictionary.from_entries(spark, [{"code": "A00", "description": "cholera"}])
    spec = replace(SIM, rules=replace(SIM.rules, drop=["chave"]))
    groups, _, counts = chain._groups(spark, spec, chain.dataset_parts(spark, place), icd, None, {})
    assert sum(counts.values()) == 8 and all(g.unreadable is not None for g in groups)
    for group in groups:
        scan = [x for x in group.result._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x]
        assert scan and all("chave" not in x for x in scan)


def test_rows_alike_in_all_are_dealt_out(spark):
    """8,000 rows that hold nothing but their key, from two tasks: no task gets twice the bound."""
    rows = spark.range(8000, numPartitions=2).select(F.lit("hot").alias("k"))
    side = spark.createDataFrame([("hot", 1), ("cold", 2)], "k string, v int")
    held = {name: spark.conf.get(name) for name in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    for name, value in zip(held, ("400", "false", "-1"), strict=True):
        spark.conf.set(name, value)
    try:
        joined = lookup_join(rows, side, ["k"], small=False, hot_rows=500)
        tasks = joined.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n"), F.sum("v").alias("v")).collect()
    finally:
        for name, value in held.items():
            spark.conf.set(name, value)
    assert sum(r.n for r in tasks) == sum(r.v for r in tasks) == 8000
    assert max(r.n for r in tasks) <= 1000


def test_two_large_lookups_count_once_and_join_once(spark, tmp_path, monkeypatch):
    from vitaria.operators import joins

    entries = [{"code": f"{a}{i:02d}", "description": f"text {a}{i}"} for a in "AB" for i in range(50)]
    path = tmp_path / "codes.json"
    path.write_text(json.dumps(entries))
    dictionary = replace(CodeDictionary.from_json(spark, str(path)), small=False)
    rows = spark.range(3000).select(F.lit("A01").alias("a"), F.format_string("B%02d", F.col("id") % 60).alias("b"), F.lit(None).cast("string").alias("c"))
    counted, real = [], joins.hot_keys
    monkeypatch.setattr(joins, "hot_keys", lambda frame, keys, hot_rows: counted.append((frame, keys)) or real(frame, keys, 500))
    found = exact_lookup(rows, ["a", "b", "c"], dictionary)
    assert len(counted) == 1 and len(counted[0][1]) == 3
    assert "Join" not in counted[0][0]._jdf.queryExecution().optimizedPlan().toString()
    values = {tuple(r) for r in found.collect()}
    assert found.count() == 3000 and found.columns == ["a", "b", "c"]
    assert values == {("text A1", f"text B{i}" if i < 50 else f"B{i:02d}", None) for i in range(60)}


def test_dead_rules(spark):
    assert ("icd", "CAUSABAS_O", "drop removes it first") in dead_rules(SIM)
    assert all(step == "dates" or why == "drop removes it first" for step, _, why in dead_rules(SPECS["SIA.AM"]))
    assert dead_rules(SPECS["SIH.CH"]) == []
    rules = replace(SIM.rules, drop=[], recode={"d": {"1": "x"}, "n": {"1": "x"}}, age_columns=["o"], dates={"d": "yyyyMMdd"}, rename={"o": "n"}, keep=[], icd_columns=[])
    odd = replace(SIM, rules=rules, steps=("dates", "rename", "recode", "age"))
    assert dead_rules(odd) == [("recode", "d", "dates makes it a date first"), ("age", "o", "rename removes it first")]
    rows = spark.createDataFrame([("1", None), ("2", "x")], "CAUSABAS_O string, o string")
    report = dead_rules_report(spark, [(odd, rows), (SIM, rows)]).where("valores > 0").collect()
    assert {(r.etapa, r.coluna, r.valores) for r in report} == {("age", "o", 1), ("icd", "CAUSABAS_O", 2)}
