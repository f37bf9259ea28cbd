"""Types that drift between runs and between files, broken files, and footers of many datasets."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitaria.operators.quality import audit_datasets
from vitaria.plans.chain import run_datasets
from vitaria.plans.faults import failing_parts
from vitaria.plans.specs import SPECS
from vitaria.sinks.tables import convert_datasets, write_silver
from vitaria.sources import read_silver
from vitaria.sources.contract import common_schema, common_type, keep_contract
from vitaria.sources.footers import read_footers
from vitaria.sources.tables import dataset_schemas, files_of, read_contract, read_mixed


def jobs_of(spark, group, run):
    """What a call gives, and how many Spark jobs it takes."""
    spark.sparkContext.setJobGroup(group, group)
    try:
        found = run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return found, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_common_types():
    i, n, s, f, d = T.IntegerType(), T.LongType(), T.StringType(), T.FloatType(), T.DoubleType()
    assert [common_type(a, b) for a, b in [(i, n), (n, i), (i, s), (f, d), (i, d), (T.NullType(), i), (i, T.NullType()), (d, d)]] == [n, n, s, d, s, i, i, d]
    merged = common_schema(T.StructType().add("a", i).add("b", s), T.StructType().add("c", d).add("a", n))
    assert [(x.name, x.dataType) for x in merged] == [("a", n), ("b", s), ("c", d)]


def rows_of(spark, uf, kind, n=3, **more):
    rows = spark.range(n).select("id", F.lit(uf).alias("uf"), F.lit("2020").alias("ano"), F.lit("01").alias("mes"), F.col("id").cast(kind).alias("x"))
    return rows.withColumns({c: F.lit(v) for c, v in more.items()})


def test_contract_widens_only_narrower_partitions(spark, tmp_path):
    base, place = str(tmp_path), tmp_path / "SIA" / "AM"
    files = lambda: {p.relative_to(place).parts[1]: {q.name for q in p.parent.glob("*.parquet")} for p in place.rglob("*.parquet")}
    write_silver(rows_of(spark, "SP", "int"), base, "SIA", "AM")
    write_silver(rows_of(spark, "RJ", "bigint"), base, "SIA", "AM")
    assert dict(read_silver(spark, base, "SIA", "AM").dtypes)["x"] == "bigint"
    before = files()
    write_silver(rows_of(spark, "PE", "int", y="new"), base, "SIA", "AM")  # narrower than the table: cast, nothing rewritten
    assert {k: v for k, v in files().items() if k != "uf=PE"} == before
    write_silver(rows_of(spark, "BA", "string"), base, "SIA", "AM")
    stored = read_silver(spark, base, "SIA", "AM")
    assert {(r.uf, r.x, r.y) for r in stored.collect()} == {(uf, str(i), "new" if uf == "PE" else None) for uf in ("SP", "RJ", "PE", "BA") for i in range(3)}
    assert {r.mes for r in stored.collect()} == {"01"}
    before = files()
    write_silver(rows_of(spark, "SP", "double"), base, "SIA", "AM")
    assert {k: v for k, v in files().items() if k != "uf=SP"} == {k: v for k, v in before.items() if k != "uf=SP"}
    assert {r.x for r in read_silver(spark, base, "SIA", "AM").where("uf = 'SP'").collect()} == {"0.0", "1.0", "2.0"}


def test_table_without_a_contract_gets_one_and_a_stopped_widening_is_done_again(spark, tmp_path, monkeypatch):
    place = str(tmp_path / "SIA" / "AM")
    for uf, kind in (("SP", "int"), ("RJ", "string")):
        rows_of(spark, uf, kind).withColumn("regiao", F.lit("Sudeste")).write.mode("append").partitionBy("regiao", "uf", "ano", "mes").parquet(place)
    from vitaria.sources import contract

    def stop(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(contract, "_widen_partitions", stop)
    with pytest.raises(RuntimeError, match="lost"):
        write_silver(rows_of(spark, "PE", "int"), str(tmp_path), "SIA", "AM")
    monkeypatch.undo()
    assert read_contract(spark, place)[1] is False
    write_silver(rows_of(spark, "PE", "int"), str(tmp_path), "SIA", "AM")
    assert {(r.uf, r.x) for r in read_silver(spark, str(tmp_path), "SIA", "AM").collect()} == {(uf, str(i)) for uf in ("SP", "RJ", "PE") for i in range(3)}
    _, jobs = jobs_of(spark, "unchanged", lambda: keep_contract(spark, place, read_contract(spark, place)[0]))
    assert jobs <= 2  # the contract's text and no footers


def test_footers_of_many_datasets_take_few_jobs(spark, tmp_path):
    ids = spark.range(400).withColumn("dataset", F.concat(F.lit("DOSP"), (F.col("id") + 1000).cast("string"), F.lit(".parquet")))
    ids.repartition(8, "dataset").write.partitionBy("dataset").parquet(f"{tmp_path}/in")
    places = [str(p) for p in sorted((tmp_path / "in").glob("dataset=*"))]
    schemas, jobs = jobs_of(spark, "footers", lambda: dataset_schemas(spark, places))
    assert len(schemas) == 400 and {s.simpleString() for s in schemas.values()} == {"struct<id:bigint>"}
    assert jobs <= 20  # listings and one schema; it was one for each dataset
    report, jobs = jobs_of(spark, "audit", lambda: audit_datasets(spark, f"{tmp_path}/in").collect())
    assert len(report) == 400 and jobs <= 40
    _, jobs = jobs_of(spark, "convert", lambda: convert_datasets(spark, f"{tmp_path}/in", f"{tmp_path}/out", "parquet").collect())
    assert jobs <= 40 and spark.read.parquet(f"{tmp_path}/out").count() == 400


def test_footers_tell_rows_and_reasons(spark, tmp_path):
    spark.range(7).coalesce(1).write.parquet(f"{tmp_path}/a b%25.parquet")
    (tmp_path / "bad.parquet").write_text("no parquet file at all")
    files = files_of(spark, [f"{tmp_path}/a b%25.parquet"])[f"{tmp_path}/a b%25.parquet"]
    found, bad = read_footers(spark, [*files, (tmp_path / "bad.parquet").as_uri(), (tmp_path / "none.parquet").as_uri()])
    assert [f.rows for f in found.values()] == [7]
    assert sorted("not a Parquet file" in text for text in bad.values()) == [False, True]
    assert not any("o1" in text and "calling" in text for text in bad.values())


def test_part_files_of_one_dataset_drift(spark, tmp_path):
    place = f"{tmp_path}/DOSP2020.parquet"
    spark.createDataFrame([("1", "a")], "SEXO string, b string").coalesce(1).write.parquet(place)
    spark.createDataFrame([(2,)], "SEXO int").coalesce(1).write.mode("append").parquet(place)
    assert {tuple(r) for r in read_mixed(spark, [place], "dataset").select("SEXO", "b", "dataset").collect()} == {("1", "a", "DOSP2020"), ("2", None, "DOSP2020")}
    with pytest.raises(ValueError, match="SEXO"):
        dataset_schemas(spark, [place])


@pytest.mark.parametrize("bad", [set(), {7}, {3, 250}, {0, 1, 2, 298, 299}])
def test_failing_parts_take_few_tests(bad):
    tests = []

    def test(group):
        tests.append(len(group))
        return ValueError(str(sorted(set(group) & bad))) if set(group) & bad else None

    assert set(failing_parts(range(300), test)) == bad
    assert len(tests) <= 1 + 2 * len(bad) * 10
    assert failing_parts([], test) == {}


def test_an_error_of_all_parts_is_raised_soon():
    tests = []

    def test(group):
        tests.append(group)
        return OSError("no space left")

    with pytest.raises(OSError, match="no space"):
        failing_parts(range(10_000), test)
    assert len(tests) < 64


def test_broken_pages_of_some_files(spark, tmp_path):
    """Footers are whole, but two files of forty have broken pages: the others are stored, those of their datasets too."""
    folder = tmp_path / "sia-parquet" / "AM"
    rows = spark.range(40 * 50).withColumn("dataset", F.concat(F.lit("AMSP20"), F.lpad((F.col("id") % 10 + 1).cast("string"), 2, "0"), F.lit(".parquet")))
    rows.withColumn("AP_CONDIC", F.lit("EP")).repartition(4, F.col("id") / 500).write.partitionBy("dataset").parquet(str(folder))
    files = sorted(folder.rglob("*.parquet"))
    files = [f for f in files if f.is_file()]
    lost = 0
    for file in (files[3], files[-1]):
        lost += spark.read.parquet(str(file)).count()
        data = bytearray(file.read_bytes())
        data[4:60] = b"\xff" * 56
        file.write_bytes(bytes(data))
        for check in file.parent.glob(f".{file.name}.crc"):
            check.unlink()
    spec, silver = SPECS["SIA.AM"], str(tmp_path / "silver")
    outcome, jobs = jobs_of(spark, "broken", lambda: run_datasets(spark, spec, [str(folder)], silver))
    assert {r.arquivo.rsplit("/", 1)[-1] for r in outcome.failures.collect()} == {files[3].name, files[-1].name}
    assert read_silver(spark, silver, "SIA", "AM").count() == 2000 - lost
    assert jobs < 60


def test_all_files_broken_is_an_outcome(spark, tmp_path):
    (tmp_path / "AMSP2001.parquet").mkdir()
    (tmp_path / "AMSP2001.parquet" / "x.parquet").write_text("nothing")
    outcome = run_datasets(spark, SPECS["SIA.AM"], [f"{tmp_path}/AMSP2001.parquet"], f"{tmp_path}/silver")
    assert [r.dataset for r in outcome.failures.collect()] == ["AMSP2001"]
    assert outcome.before.count() == outcome.changes.count() == outcome.missing.count() == 0
