"""Whole runs on small datasets laid out like the real ones."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from vitaria import fixed_values as fv
from vitaria.operators.partitions import missing_partitions
from vitaria.plans.chain import apply_chain, chain_columns, chain_lineage, run_datasets, run_table, with_options
from vitaria.plans.specs import SPECS
from vitaria.sinks.tables import convert_datasets, write_json_rows, write_report_csv, write_silver
from vitaria.sources import CodeDictionary, list_datasets, partition_grid, read_silver
from vitaria.streaming.daily import refresh_new_datasets

ICD = [
    {"code": "A", "description": "Infecciosas"},
    {"code": "A01", "description": "Febre tifoide"},
    {"code": "I21", "description": "Infarto"},
]
DEATHS = [
    # IDADE, CAUSABAS, SEXO, RACACOR, ESC, ORIGEM, DTOBITO
    ("402", "A01", "1", "1", "3", "1", "01012020"),
    ("503", "A019", "2", "9", None, "1", "02012020"),
    ("999", "I219", "0", None, "9", "2", "03012020"),
    ("x", "Z99", "3", "4", "1", "2", ""),
    (None, None, None, "5", "", None, None),
    ("400", "", "1", "2", "2", "1", "04012020"),
]
DEATH_COLUMNS = "IDADE string, CAUSABAS string, SEXO string, RACACOR string, ESC string, ORIGEM string, DTOBITO string"


@pytest.fixture
def dictionary(spark):
    return CodeDictionary.from_entries(spark, ICD)


def deaths(spark, times=1):
    return spark.createDataFrame(DEATHS * times, DEATH_COLUMNS)


def test_mortality_run(spark, tmp_path, dictionary):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    for name, times in [("DOPE2020", 1), ("DOPI2020", 2), ("DOSP2020", 3)]:
        deaths(spark, times).coalesce(1).write.parquet(f"{bronze}/sim-parquet/{name}.parquet")
    outcome = run_table(spark, SPECS["SIM.DO"], bronze, silver, ["PE", "PI", "AC"], [2020], dictionary=dictionary)
    stored = read_silver(spark, silver, "SIM", "DO")
    assert {"Idade", "Causa Básica", "Sexo", "Raça/Cor", "Escolaridade", "Data do Óbito"} <= set(stored.columns)
    assert "ORIGEM" not in stored.columns
    found = stored.where("uf = 'PE'").select("Idade", "Causa Básica", "Sexo", "`Raça/Cor`", "Escolaridade").collect()
    assert sorted(map(str, map(tuple, found))) == sorted(
        map(
            str,
            [
                ("2 anos", "Febre tifoide", "Homem", "Branca", "4 a 7 anos"),
                ("103 anos", "Infecciosas", "Mulher", "9", None),
                ("Código inválido", "Infarto", "Ignorado", None, "Ignorado"),
                (None, "Z99", "3", "Parda", "Nenhuma"),
                (None, None, None, "Indígena", ""),
                (fv.AGE_UNDER_ONE, "", "Homem", "Preta", "1 a 3 anos"),
            ],
        )
    )
    assert [tuple(r) for r in stored.groupBy("regiao", "uf", "ano").count().orderBy("uf").collect()] == [
        ("NORDESTE", "PE", "2020", 6), ("NORDESTE", "PI", "2020", 12),
    ]
    changes = {r[fv.AUDIT_FILE]: r for r in outcome.changes.collect()}
    assert changes["DOPI2020.parquet"].registros_antes == 12 and changes["DOPI2020.parquet"].registros_perdidos == 0
    assert "ORIGEM" in changes["DOPI2020.parquet"].colunas_removidas and "Idade" in changes["DOPI2020.parquet"].colunas_adicionadas
    assert {tuple(r) for r in outcome.quarantine.collect()} == {("DOPE2020", "IDADE", "x", 1), ("DOPI2020", "IDADE", "x", 2)}
    assert {tuple(r) for r in outcome.missing.collect()} == {("DOPE2020.parquet", "CAUSABAS_O"), ("DOPI2020.parquet", "CAUSABAS_O")}


def test_second_run_replaces_only_its_partitions(spark, tmp_path, dictionary):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    deaths(spark).write.parquet(f"{bronze}/sim-parquet/DOPE2020.parquet")
    deaths(spark).write.parquet(f"{bronze}/sim-parquet/DOPE2021.parquet")
    spec = SPECS["SIM.DO"]
    run_table(spark, spec, bronze, silver, ["PE"], [2020, 2021], dictionary=dictionary)
    deaths(spark, 2).write.mode("overwrite").parquet(f"{bronze}/sim-parquet/DOPE2021.parquet")
    run_table(spark, spec, bronze, silver, ["PE"], [2021], dictionary=dictionary)
    counts = read_silver(spark, silver, "SIM", "DO").groupBy("ano").count()
    assert {tuple(r) for r in counts.collect()} == {("2020", 6), ("2021", 12)}


def admissions(spark, *days):
    rows = [(str(i), day, day, "1", "2", "9") for i, day in enumerate(days)]
    return spark.createDataFrame(rows, "N_AIH string, DT_INTER string, NASC string, CGC_HOSP string, CNPJ_MANT string, VAL_RN string")


def test_admissions_run_and_emptied_partition(spark, tmp_path):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    folder = f"{bronze}/sih-parquet/RD"
    admissions(spark, "20200101", "20210615", "20190101").write.parquet(f"{folder}/RDSP2201.parquet")
    admissions(spark, "20210101").write.parquet(f"{folder}/RDSP2202.parquet")
    spec = SPECS["SIH.RD"]
    outcome = run_table(spark, spec, bronze, silver, ["SP"], [2022])
    stored = read_silver(spark, silver, "SIH", "RD")
    assert {"CNPJ do Hospital", "CNPJ do Hospital_2", "Data de Inicio", "ano_inter"} <= set(stored.columns)
    assert {tuple(r) for r in stored.select("mes", "ano_inter").collect()} == {("01", "2020"), ("01", "2021"), ("02", "2021")}
    assert {r[fv.AUDIT_FILE]: r.registros_perdidos for r in outcome.changes.collect()} == {"RDSP2201.parquet": 1, "RDSP2202.parquet": 0}
    # a corrected file without any row of those years must leave nothing behind
    admissions(spark, "20180101").write.mode("overwrite").parquet(f"{folder}/RDSP2202.parquet")
    run_table(spark, spec, bronze, silver, ["SP"], [2022])
    assert {r.mes for r in read_silver(spark, silver, "SIH", "RD").collect()} == {"01"}


def test_admission_filter_needs_its_column(spark):
    with pytest.raises(ValueError, match="SP_DTINTER"):
        apply_chain(admissions(spark, "20200101"), SPECS["SIH.SP"])


def test_outpatient_steps_and_dead_rules(spark):
    df = spark.createDataFrame([("EP", "0", "202001", "9")], "AP_CONDIC string, AP_MNDIF string, AP_CMP string, AP_MVM string")
    result = apply_chain(df, SPECS["SIA.AM"])
    assert result.columns == ["Condicao de pagamento", "Data de atendimento"]
    assert tuple(result.first()) == ("Em processamento", "202001")
    # the older family of tables is not renamed
    assert apply_chain(df, SPECS["SIA.PAR"]).columns == ["AP_CONDIC", "AP_CMP"]


def test_declared_steps(spark, dictionary):
    spec = with_options(SPECS["SIM.DO"], keep=True)
    assert spec.steps == ("drop", "recode", "age", "keep", "icd", "rename")
    row = apply_chain(deaths(spark), spec, dictionary).first()
    assert (row["Causa Básica"], row["Categoria CID"]) == ("Febre tifoide", "A01")
    dated = apply_chain(spark.createDataFrame([("202101",)], "AP_CMP string"), with_options(SPECS["SIA.AM"], dates=True))
    assert str(dated.first()[0]) == "2021-01-01"
    assert with_options(SPECS["SIH.RD"], keep=True, icd=True).steps == ("drop", "years", "keep", "icd", "rename")
    assert with_options(SPECS["SIA.PAR"], dates=True).steps == ("drop", "recode", "dates")


def test_every_table_has_a_spec():
    tables = {spec.table for spec in SPECS.values()}
    assert len(SPECS) == 22 and {"DO", "ACF", "PA", "IMPBO", "RD", "CM"} <= tables
    # two record systems have a table of the same name in neither case
    assert SPECS["SIH.SP"].rules.year_column == "SP_DTINTER" and SPECS["SIH.RD"].rules.year_column == "DT_INTER"


def test_lineage_of_chain(spark, dictionary):
    rows = deaths(spark).withColumn("dataset", F.lit("DOPE2020"))
    records = {r.qualifiedName.split(".")[1]: r for r in chain_lineage(rows, SPECS["SIM.DO"], "equipe", dictionary).collect()}
    assert list(records) == ["drop", "recode", "age", "icd", "rename"]
    assert records["drop"].deleted_columns == ["ORIGEM"] and records["icd"].added_columns == []
    assert [step for step, before, after in chain_columns(rows, SPECS["SIM.DO"], dictionary) if before != after] == ["drop", "rename"]


def test_missing_month(spark, tmp_path):
    for month in range(1, 12):
        spark.range(1).write.parquet(f"{tmp_path}/AMSP22{month:02d}.parquet")
    lost = missing_partitions(partition_grid(spark, ["SP"], [2022]), list_datasets(spark, str(tmp_path)), ["uf", "ano", "mes"])
    assert [tuple(r) for r in lost.collect()] == [("SP", "2022", "12")]


def test_report_and_json_files(spark, tmp_path):
    report = spark.createDataFrame([("DOSP2020", 3, "a, b")], f"Arquivo string, `{fv.AUDIT_ROWS}` long, Colunas string")
    write_report_csv(report, f"{tmp_path}/audit")
    parts = list((tmp_path / "audit").glob("*.csv"))
    assert len(parts) == 1 and parts[0].read_text(encoding="utf-8").splitlines() == [
        "Arquivo,Número de Registros,Colunas", 'DOSP2020,3,"a, b"',
    ]
    write_json_rows(spark.createDataFrame([("1", None, "SP")], "a string, b string, uf string"), f"{tmp_path}/json")
    lines = [p.read_text() for p in (tmp_path / "json" / "uf=SP").glob("*.json")]
    assert lines == ['{"a":"1","b":null}\n']


def test_convert_datasets(spark, tmp_path):
    spark.range(2).write.parquet(f"{tmp_path}/in/DOSP2020.parquet")
    spark.range(3).withColumn("x", F.lit(1)).write.parquet(f"{tmp_path}/in/DORJ2020.parquet")
    places = convert_datasets(spark, f"{tmp_path}/in", f"{tmp_path}/out", "parquet")
    assert {r.dataset for r in places.collect()} == {"DOSP2020", "DORJ2020"}
    counts = spark.read.parquet(f"{tmp_path}/out").groupBy("dataset").count().collect()
    assert {tuple(r) for r in counts} == {("DOSP2020", 2), ("DORJ2020", 3)}


def test_rebalanced_write_equals_plain(spark, tmp_path):
    rows = spark.range(5000).select(
        "id", F.when(F.col("id") % 3 > 0, "SP").otherwise("RJ").alias("uf"), F.lit("2020").alias("ano"), F.lit("01").alias("mes")
    )
    for name, rebalance in [("a", False), ("b", True)]:
        write_silver(rows, f"{tmp_path}/{name}", "SIA", "AM", rebalance=rebalance)
    plain, balanced = (read_silver(spark, f"{tmp_path}/{name}", "SIA", "AM").select("id", "uf", "mes") for name in "ab")
    assert plain.count() == 5000 and plain.exceptAll(balanced).isEmpty()


def test_daily_refresh_takes_only_new_datasets(spark, tmp_path, dictionary):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    schema = deaths(spark).schema
    spec = SPECS["SIM.DO"]

    def refresh():
        return refresh_new_datasets(spark, spec, bronze, silver, f"{tmp_path}/state", schema, dictionary)

    deaths(spark).coalesce(1).write.parquet(f"{bronze}/sim-parquet/DOPE2020.parquet")
    refresh()
    deaths(spark, 2).coalesce(1).write.parquet(f"{bronze}/sim-parquet/DOPI2020.parquet")
    deaths(spark).coalesce(1).write.mode("append").parquet(f"{bronze}/sim-parquet/DOPE2020.parquet")
    refresh()
    assert refresh() is None
    counts = read_silver(spark, silver, "SIM", "DO").groupBy("uf").count().collect()
    assert {tuple(r) for r in counts} == {("PE", 12), ("PI", 12)}


def set_times(folder, moment):
    for path in folder.rglob("*"):
        os.utime(path, (moment, moment))


def test_daily_refresh_takes_files_of_any_age(spark, tmp_path, dictionary):
    bronze, silver, folder = tmp_path / "bronze", str(tmp_path / "silver"), tmp_path / "bronze" / "sim-parquet"

    def refresh():
        return refresh_new_datasets(spark, SPECS["SIM.DO"], str(bronze), silver, f"{tmp_path}/state", None, dictionary)

    deaths(spark).coalesce(1).write.parquet(f"{folder}/DOPE2020.parquet")
    refresh()
    deaths(spark).coalesce(1).write.parquet(f"{folder}/DOPI2020.parquet")
    set_times(folder / "DOPI2020.parquet", 1_500_000_000)
    refresh()
    assert {r.uf for r in read_silver(spark, silver, "SIM", "DO").collect()} == {"PE", "PI"}
    # one dataset loses its rows, another its files
    deaths(spark).limit(0).write.mode("overwrite").parquet(f"{folder}/DOPE2020.parquet")
    deaths(spark).coalesce(1).write.parquet(f"{folder}/DOSP2020.parquet")
    assert {r.registros_depois for r in refresh().changes.where("Arquivo = 'DOPE2020.parquet'").collect()} == {0}
    assert {r.uf for r in read_silver(spark, silver, "SIM", "DO").collect()} == {"PI", "SP"}
    shutil.rmtree(folder / "DOSP2020.parquet")
    assert refresh() is None
    assert {r.uf for r in read_silver(spark, silver, "SIM", "DO").collect()} == {"PI"}


def test_daily_refresh_leaves_other_tables_of_the_folder(spark, tmp_path):
    folder, silver = tmp_path / "bronze" / "sia-parquet" / "AM", str(tmp_path / "silver")
    rows = spark.createDataFrame([("EP",)] * 3, "AP_CONDIC string").coalesce(1)
    for name in ("AMSP2101", "AQSP2101"):
        rows.write.parquet(f"{folder}/{name}.parquet")
    refresh_new_datasets(spark, SPECS["SIA.AM"], str(tmp_path / "bronze"), silver, f"{tmp_path}/state")
    assert {r.dataset for r in read_silver(spark, silver, "SIA", "AM").collect()} == {"AMSP2101"}


def test_failed_dataset_is_reported_and_tried_again(spark, tmp_path, dictionary):
    bronze, silver, folder = tmp_path / "bronze", str(tmp_path / "silver"), tmp_path / "bronze" / "sim-parquet"
    deaths(spark).coalesce(1).write.parquet(f"{folder}/DOPE2020.parquet")
    (folder / "DOPI2020.parquet").mkdir()
    (folder / "DOPI2020.parquet" / "part.parquet").write_text("no parquet")

    def refresh():
        return refresh_new_datasets(spark, SPECS["SIM.DO"], str(bronze), silver, f"{tmp_path}/state", None, dictionary)

    assert [r.dataset for r in refresh().failures.collect()] == ["DOPI2020"]
    assert {r.uf for r in read_silver(spark, silver, "SIM", "DO").collect()} == {"PE"}
    deaths(spark).coalesce(1).write.mode("overwrite").parquet(f"{folder}/DOPI2020.parquet")
    assert refresh().failures.count() == 0
    assert {r.uf for r in read_silver(spark, silver, "SIM", "DO").collect()} == {"PE", "PI"}


def test_emptied_mortality_dataset_leaves_nothing(spark, tmp_path, dictionary):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    deaths(spark).write.parquet(f"{bronze}/sim-parquet/DOPE2020.parquet")
    spec = SPECS["SIM.DO"]
    run_table(spark, spec, bronze, silver, ["PE", "AC"], [2020], dictionary=dictionary)
    deaths(spark).limit(0).write.mode("overwrite").parquet(f"{bronze}/sim-parquet/DOPE2020.parquet")
    outcome = run_table(spark, spec, bronze, silver, ["PE", "AC"], [2020], dictionary=dictionary)
    assert read_silver(spark, silver, "SIM", "DO", deaths(spark).schema.add("dataset", "string")).count() == 0
    assert [tuple(r)[1:4] for r in outcome.changes.collect()] == [(0, 0, 0)]
    assert [tuple(r) for r in outcome.absent.collect()] == [("AC", "2020")]


def test_drifted_datasets_run_together(spark, tmp_path, dictionary):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    deaths(spark).write.parquet(f"{bronze}/sim-parquet/DOPE2020.parquet")
    numbers = deaths(spark).where("SEXO is not null").withColumn("SEXO", F.col("SEXO").cast("int")).drop("IDADE", "ESC")
    numbers.withColumn("a, b", F.lit(1)).write.parquet(f"{bronze}/sim-parquet/DOPI2020.parquet")
    outcome = run_table(spark, SPECS["SIM.DO"], bronze, silver, ["PE", "PI"], [2020], dictionary=dictionary)
    stored = read_silver(spark, silver, "SIM", "DO")
    assert {r.Sexo for r in stored.where("uf = 'PE'").collect()} == {"Homem", "Mulher", "Ignorado", "3", None}
    assert {r.Sexo for r in stored.where("uf = 'PI'").collect()} == {"1", "2", "0", "3"}  # numbers match no code
    assert {tuple(r) for r in outcome.missing.collect()} == {
        ("DOPI2020.parquet", "IDADE"), ("DOPE2020.parquet", "CAUSABAS_O"), ("DOPI2020.parquet", "CAUSABAS_O"),
    }
    changes = {r[fv.AUDIT_FILE]: r for r in outcome.changes.collect()}
    assert "a, b" not in changes["DOPI2020.parquet"].colunas_removidas and "Idade" in changes["DOPE2020.parquet"].colunas_adicionadas
    assert "Idade" not in changes["DOPI2020.parquet"].colunas_adicionadas
    renamed = {r.qualifiedName: r.added_columns for r in outcome.lineage.where("name like 'rename%'").collect()}
    assert "Idade" in renamed["process.rename.vitaria@DOPE2020"] and "Idade" not in renamed["process.rename.vitaria@DOPI2020"]
    outcome.store(f"{tmp_path}/reports")
    assert spark.read.parquet(f"{tmp_path}/reports/changes").count() == 2 and spark.read.parquet(f"{tmp_path}/reports/failures").count() == 0


def test_a_segment_is_replaced_alone(spark, tmp_path):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    folder, spec = f"{bronze}/sia-parquet/PA", SPECS["SIA.PA"]
    rows = spark.createDataFrame([("EP",)] * 3, "AP_CONDIC string").coalesce(1)
    for name in ("PASP2101a", "PASP2101b", "PASP2102"):
        rows.write.parquet(f"{folder}/{name}.parquet")
    run_table(spark, spec, bronze, silver, ["SP"], [2021])
    rows.limit(1).write.mode("overwrite").parquet(f"{folder}/PASP2101b.parquet")
    run_datasets(spark, spec, [f"{folder}/PASP2101b.parquet"], silver)
    counts = read_silver(spark, silver, "SIA", "PA").groupBy("mes", "segmento").count().collect()
    assert {tuple(r) for r in counts} == {("01", "a", 3), ("01", "b", 1), ("02", "0", 3)}
