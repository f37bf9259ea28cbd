"""Whole runs over datasets that are emptied, drifted, broken, late or of another table."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check, sql_case
from checks.stand_ins import ADMISSIONS_SQL, ICD_ITEMS, MORTALITY_SQL, OUTPATIENT_SQL, admissions, mortality, outpatient
from checks.storage import bronze_of
from vitaria import fixed_values as fv
from vitaria.plans.chain import run_table
from vitaria.plans.liveness import dead_rules_report
from vitaria.plans.specs import SPECS
from vitaria.sinks.shared import new_folder
from vitaria.sinks.tables import listed_as_text
from vitaria.sources import CodeDictionary, read_silver
from vitaria.streaming.daily import refresh_new_datasets

SPEC = SPECS["SIM.DO"]


def _store(spark, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _broken_dataset(spark, path: str) -> None:
    """A dataset whose only file is no Parquet file."""
    text = new_folder(spark, "text")
    spark.range(1).select(F.lit("no parquet").alias("value")).coalesce(1).write.text(text)
    store, place = _store(spark, text)
    part = next(s.getPath() for s in store.listStatus(place) if s.getPath().getName().startswith("part"))
    there, target = _store(spark, path)
    there.mkdirs(target)
    store.rename(part, _store(spark, f"{path}/part.parquet")[1])


def _make_old(spark, folder: str) -> None:
    store, place = _store(spark, folder)
    for status in store.listStatus(place):
        store.setTimes(status.getPath(), 1_400_000_000_000, -1)


def _run(spark, bronze: str, silver: str):
    dictionary = CodeDictionary.from_entries(spark, ICD_ITEMS)
    return run_table(spark, SPEC, bronze, silver, ["PE", "PI"], range(1994, 2010), dictionary=dictionary)


@check(
    "run_emptied_mortality",
    f"select chave, uf, ano from ({MORTALITY_SQL}) where uf in ('PE', 'PI') and not (uf = 'PE' and ano = '1997')",
)
def run_emptied(spark, sf_dir):
    rows, silver = mortality(spark, sf_dir), new_folder(spark, "silver")
    bronze = bronze_of(rows, "sim-parquet", "DO")
    _run(spark, bronze, silver)
    # a corrected dataset holds no row; nothing of the old one may stay
    rows.drop("uf", "ano").limit(0).write.mode("overwrite").parquet(f"{bronze}/sim-parquet/dataset=DOPE1997.parquet")
    _run(spark, bronze, silver)
    return read_silver(spark, silver, "SIM", "DO").select("chave", "uf", "ano")


def _drifted(spark, sf_dir) -> str:
    """1997 lacks the age and has numbers for SEXO; one dataset of 2009 is no Parquet file."""
    rows = mortality(spark, sf_dir)
    bronze = bronze_of(rows.where("ano <> '1997'"), "sim-parquet", "DO")
    numbers = rows.where("ano = '1997'").withColumn("SEXO", F.col("SEXO").cast("int")).drop("IDADE")
    bronze_of(numbers, "sim-parquet", "DO", base=bronze, mode="append")
    _broken_dataset(spark, f"{bronze}/sim-parquet/DOPE2009.parquet")
    return bronze


_SEXO = f"case when ano = '1997' then \"SEXO\" else {sql_case('SEXO', fv.SIM_RECODE['SEXO']).split(' as ')[0]} end"


@check(
    "run_drifted",
    f"select chave, uf, ano, {_SEXO} as sexo, \"DTOBITO\" as dia from ({MORTALITY_SQL}) where uf in ('PE', 'PI')"
    " union all select null, 'PE', '2009', 'DOPE2009', null",
)
def run_drifted(spark, sf_dir):
    silver = new_folder(spark, "silver")
    outcome = _run(spark, _drifted(spark, sf_dir), silver)
    stored = read_silver(spark, silver, "SIM", "DO")
    stored = stored.select("chave", "uf", "ano", F.col("Sexo").alias("sexo"), F.col("`Data do Óbito`").alias("dia"))
    nothing = F.lit(None)
    failed = outcome.failures.select(
        nothing.cast("long"), F.substring("dataset", 3, 2), F.right("dataset", F.lit(4)), "dataset", nothing.cast("string")
    )
    return stored.union(failed)


@check(
    "run_reports_drifted",
    f"""with d as (select uf, ano, count(*) as n from ({MORTALITY_SQL}) where uf in ('PE', 'PI') group by uf, ano)
select 'DO' || uf || ano || '.parquet' as arquivo, n as antes, n as depois, cast(0 as bigint) as perdidos,
  case when ano = '1997' then 'CAUSABAS, CAUSABAS_O, SEXO, RACACOR, DTOBITO, ORIGEM'
    else 'IDADE, CAUSABAS, CAUSABAS_O, SEXO, RACACOR, DTOBITO, ORIGEM' end as removidas,
  case when ano = '1997' then 'Causa Básica, Sexo, Raça/Cor, Data do Óbito'
    else 'Idade, Causa Básica, Sexo, Raça/Cor, Data do Óbito' end as adicionadas,
  case when ano = '1997' then 'IDADE' end as falta,
  case when ano = '1997' then 'CAUSABAS, SEXO, RACACOR, DTOBITO' else 'IDADE, CAUSABAS, SEXO, RACACOR, DTOBITO' end as renomeadas
from d union all
select 'ausente ' || u || y, null, null, null, null, null, null, null
from (select unnest(['PE', 'PI']) as u), (select cast(unnest(range(1994, 2010)) as varchar) as y)
where not exists (select 1 from d where uf = u and ano = y) and not (u = 'PE' and y = '2009')""",
)
def run_reports(spark, sf_dir):
    outcome = _run(spark, _drifted(spark, sf_dir), new_folder(spark, "silver"))
    lacking = outcome.missing.select(F.col(fv.AUDIT_FILE).alias("a"), F.col("coluna").alias("falta")).where("falta = 'IDADE'")
    renamed = outcome.lineage.where("qualifiedName like 'process.rename.%'").select(
        F.concat(F.element_at("inputs", 1), F.lit(".parquet")).alias("b"), F.array_join("deleted_columns", ", ").alias("renomeadas")
    )
    changes = listed_as_text(outcome.changes).toDF("arquivo", "antes", "depois", "perdidos", "removidas", "adicionadas")
    joined = changes.join(lacking, F.col("arquivo") == F.col("a"), "left").join(renamed, F.col("arquivo") == F.col("b"), "left")
    absent = outcome.absent.select(F.concat(F.lit("ausente "), "uf", "ano").alias("arquivo"))
    return joined.drop("a", "b").unionByName(absent, allowMissingColumns=True)


@check(
    "daily_late_files",
    f"select chave, uf, ano from ({MORTALITY_SQL}) where uf in ('PE', 'PI') and not (uf = 'PI' and ano = '1996')",
)
def daily_late_files(spark, sf_dir):
    """Files that come late with old times, a dataset emptied meanwhile, and datasets of another table."""
    rows = mortality(spark, sf_dir).where("uf in ('PE', 'PI')")
    bronze, silver, state = (new_folder(spark, name) for name in ("bronze", "silver", "state"))
    folder, schema = f"{bronze}/sim-parquet", rows.drop("uf", "ano").schema
    dictionary = CodeDictionary.from_entries(spark, ICD_ITEMS)
    refresh = lambda: refresh_new_datasets(spark, SPEC, bronze, silver, state, schema, dictionary)
    bronze_of(rows.where("ano <> '1998'"), "sim-parquet", "DO", base=bronze)
    bronze_of(rows.where("ano = '1999'"), "sim-parquet", "XX", base=bronze, mode="append")
    refresh()
    bronze_of(rows.where("ano = '1998'"), "sim-parquet", "DO", base=bronze, mode="append")
    for uf in ("PE", "PI"):
        _make_old(spark, f"{folder}/dataset=DO{uf}1998.parquet")
    rows.drop("uf", "ano").limit(0).write.mode("overwrite").parquet(f"{folder}/dataset=DOPI1996.parquet")
    refresh()
    return read_silver(spark, silver, "SIM", "DO").select("chave", "uf", "ano")


_ODD = "chave % 2 = 1"
_SEXO_OF_PARTS = f"case when ano = '1997' and {_ODD} then \"SEXO\" else {sql_case('SEXO', fv.SIM_RECODE['SEXO']).split(' as ')[0]} end"


def _stored(spark, silver: str):
    stored = read_silver(spark, silver, "SIM", "DO")
    return stored.select("chave", "uf", "ano", F.col("Sexo").alias("sexo"), F.col("`Data do Óbito`").alias("dia"))


@check(
    "run_drift_between_runs",
    f"""select chave, uf, ano, {_SEXO} as sexo, "DTOBITO" as dia from ({MORTALITY_SQL})
where uf in ('PE', 'PI') and ano between '1995' and '1998'""",
)
def run_drift_between_runs(spark, sf_dir):
    """Numbers come first, text in a later run, numbers again on a day after that; the table has one type and stays readable."""
    rows = mortality(spark, sf_dir).where("uf in ('PE', 'PI')")
    silver, state = new_folder(spark, "silver"), new_folder(spark, "state")
    numbers = lambda year: rows.where(F.col("ano") == year).withColumn("SEXO", F.col("SEXO").cast("int"))
    bronze = bronze_of(numbers("1997"), "sim-parquet", "DO")
    _run(spark, bronze, silver)
    text = bronze_of(rows.where("ano in ('1995', '1996')"), "sim-parquet", "DO")
    _run(spark, text, silver)
    labelled = rows.where("ano = '1998'")
    daily = bronze_of(labelled, "sim-parquet", "DO")
    bronze_of(numbers("1997"), "sim-parquet", "DO", base=daily, mode="append")
    refresh_new_datasets(spark, SPEC, daily, silver, state, None, CodeDictionary.from_entries(spark, ICD_ITEMS))
    return _stored(spark, silver)


@check(
    "run_drifted_parts",
    f"select chave, uf, ano, {_SEXO_OF_PARTS} as sexo, \"DTOBITO\" as dia from ({MORTALITY_SQL}) where uf in ('PE', 'PI')"
    " union all select null, 'PE', '1997', 'DOPE1997', 'broken.parquet'",
)
def run_drifted_parts(spark, sf_dir):
    """Datasets of 1997 have part files with SEXO as text, others with numbers and without the age, and one file that is no Parquet file."""
    rows, silver = mortality(spark, sf_dir).where("uf in ('PE', 'PI')"), new_folder(spark, "silver")
    odd = (F.col("ano") == "1997") & (F.col("chave") % 2 == 1)
    bronze = bronze_of(rows.where(~odd), "sim-parquet", "DO")
    bronze_of(rows.where(odd).withColumn("SEXO", F.col("SEXO").cast("int")).drop("IDADE"), "sim-parquet", "DO", base=bronze, mode="append")
    aside = new_folder(spark, "aside")
    _broken_dataset(spark, aside)
    store, target = _store(spark, f"{bronze}/sim-parquet/dataset=DOPE1997.parquet/broken.parquet")
    store.rename(_store(spark, f"{aside}/part.parquet")[1], target)
    outcome = _run(spark, bronze, silver)
    failed = outcome.failures.select(
        F.lit(None).cast("long"), F.substring("dataset", 3, 2), F.right("dataset", F.lit(4)), "dataset", F.substring_index("arquivo", "/", -1)
    )
    return _stored(spark, silver).union(failed)


@check(
    "daily_broken_file",
    f"""select chave, uf, ano, 'stored' as what from ({MORTALITY_SQL}) where uf = 'PE' and ano = '1996'
union all select null, 'PI', '1998', 'not a Parquet file' union all select null, 'PI', '1998', 'tried again'""",
)
def daily_broken_file(spark, sf_dir):
    """A broken dataset is all that came, while another one went: its failure is told, the other's rows go, and it is tried again."""
    rows = mortality(spark, sf_dir)
    bronze, silver, state = (new_folder(spark, name) for name in ("bronze", "silver", "state"))
    dictionary = CodeDictionary.from_entries(spark, ICD_ITEMS)
    refresh = lambda: refresh_new_datasets(spark, SPEC, bronze, silver, state, None, dictionary)
    bronze_of(rows.where("uf = 'PE' and ano in ('1996', '1997')"), "sim-parquet", "DO", base=bronze)
    refresh()
    store, gone = _store(spark, f"{bronze}/sim-parquet/dataset=DOPE1997.parquet")
    store.rename(gone, _store(spark, new_folder(spark, "gone"))[1])
    _broken_dataset(spark, f"{bronze}/sim-parquet/DOPI1998.parquet")
    told = refresh().failures.select(
        F.lit(None).cast("long"), F.substring("dataset", 3, 2), F.right("dataset", F.lit(4)),
        F.regexp_extract("erro", "is (not a Parquet file)", 1),
    )
    again = refresh().failures.select(F.lit(None).cast("long"), F.substring("dataset", 3, 2), F.right("dataset", F.lit(4)), F.lit("tried again"))
    stored = read_silver(spark, silver, "SIM", "DO").select("chave", "uf", "ano", F.lit("stored").alias("what"))
    return stored.union(told).union(again)


_FRAMES = {"SIM": (mortality, MORTALITY_SQL), "SIA": (outpatient, OUTPATIENT_SQL), "SIH": (admissions, ADMISSIONS_SQL)}
#: Rules as the fixed values have them: ``(step, columns)`` in the order of the full chain, and what each family runs.
_RULES = {
    "SIM": [("recode", fv.SIM_RECODE), ("age", [fv.SIM_AGE_COLUMN]), ("keep", fv.SIM_KEEP), ("icd", fv.SIM_ICD_COLUMNS), ("rename", fv.SIM_RENAME)],
    "SIA": [("recode", fv.SIA_RECODE), ("dates", fv.SIA_DATES), ("rename", fv.SIA_RENAME)],
    "SIH": [("recode", fv.SIH_RECODE), ("keep", fv.SIH_KEEP), ("icd", fv.SIH_KEEP), ("dates", fv.SIH_DATES), ("rename", fv.SIH_RENAME)],
}
_DROPS = {"SIM": fv.SIM_DROP, "SIA": fv.SIA_DROP, "SIH": fv.SIH_DROP}


def _dead_sql() -> str:
    arms = []
    for spec in SPECS.values():
        if not spec.steps:
            continue
        there = _FRAMES[spec.system][1]
        for step, columns in _RULES[spec.system]:
            runs = step in spec.steps
            why = "drop removes it first" if runs else "the table does not run this step"
            for c in columns:
                if not runs or c in _DROPS[spec.system]:
                    values = f'(select count("{c}") from ({there}))' if f'"{c}"' in there else "0"
                    arms.append(f"('{spec.system}', '{spec.table}', '{step}', '{c}', '{why}', {values})")
    return f"select * from (values {', '.join(arms)}) t(sistema, tabela, etapa, coluna, motivo, valores)"


@check("dead_rules", _dead_sql())
def dead_rules_of_all_tables(spark, sf_dir):
    frames = {system: make(spark, sf_dir) for system, (make, _) in _FRAMES.items()}
    return dead_rules_report(spark, [(spec, frames[spec.system]) for spec in SPECS.values()])
