"""Scans of bronze layouts and writes of silver and other tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check, table
from checks.stand_ins import MORTALITY_SQL, OUTPATIENT_SQL, STATES, mortality, outpatient, pick, sql_list
from vitaria import fixed_values as fv
from vitaria.operators.partitions import missing_partitions
from vitaria.operators.quality import audit_datasets
from vitaria.plans.specs import SPECS
from vitaria.sinks.shared import new_folder
from vitaria.sinks.tables import (
    convert_datasets, json_rows, write_json_rows, write_report_csv, write_silver, write_table,
)
from vitaria.sources import (
    list_datasets, partition_grid, read_delta, read_mixed, read_records, read_silver, scan_bronze,
)


def bronze_of(
    rows, folder: str, table_name: str, segment: str = "", extension: str = "parquet",
    base: str | None = None, mode: str = "error",
) -> str:
    """Lay rows out as bronze datasets under a base path, coordinates in the names only."""
    period = F.concat(F.right("ano", F.lit(2)), "mes") if "mes" in rows.columns else F.col("ano")
    name = F.concat(F.lit(table_name), "uf", period, F.lit(f"{segment}.{extension}"))
    base = base or new_folder(rows.sparkSession, "bronze")
    (
        rows.withColumn("dataset", name)
        .drop("uf", "ano", "mes")
        .hint("rebalance", F.col("dataset"))
        .write.mode(mode)
        .partitionBy("dataset")
        .parquet(f"{base}/{folder}")
    )
    return base


def scan(spark, base, spec, ufs, years, months=tuple(range(1, 13)), **options):
    return scan_bronze(spark, base, SPECS[spec].layout, ufs, years, months, **options)


@check(
    "scan_mortality",
    f"select chave, 'DO' as tabela, uf, ano, 'DO' || uf || ano as dataset from ({MORTALITY_SQL})"
    " where uf in ('SP', 'PE') and ano in ('1996', '1997')",
)
def scan_mortality(spark, sf_dir):
    base = bronze_of(mortality(spark, sf_dir), "sim-parquet", "DO")
    return scan(spark, base, "SIM.DO", ["SP", "PE"], [1996, 1997, 2030]).select("chave", "tabela", "uf", "ano", "dataset")


@check(
    "scan_outpatient",
    f"select chave, linha, 'AM' as tabela, uf, ano, mes from ({OUTPATIENT_SQL})"
    " where uf = 'SP' and ano in ('1999', '2000') and mes in ('01', '02', '12')",
)
def scan_outpatient(spark, sf_dir):
    base = bronze_of(outpatient(spark, sf_dir), "sia-parquet/AM", "AM")
    return scan(spark, base, "SIA.AM", ["SP"], [1999, 2000], [1, 2, 12]).select("chave", "linha", "tabela", "uf", "ano", "mes")


@check(
    "scan_segmented",
    f"select chave, linha, 'PA' as tabela, uf, ano, mes, 'PA' || uf || substr(ano, 3, 2) || mes || 'a' as dataset"
    f" from ({OUTPATIENT_SQL}) where ano = '1998'",
)
def scan_segmented(spark, sf_dir):
    base = bronze_of(outpatient(spark, sf_dir), "sia-parquet/PA", "PA", segment="a")
    return scan(spark, base, "SIA.PA", STATES, ["1998"]).select("chave", "linha", "tabela", "uf", "ano", "mes", "dataset")


_PER_MONTH_SQL = f"""select o_orderkey, {sql_list(STATES[:2])}[o_custkey % 2 + 1] as uf,
  strftime(o_orderdate, '%Y') as ano, strftime(o_orderdate, '%m') as mes from orders"""


def _admitted(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        pick(STATES[:2], F.col("o_custkey") % 2).alias("uf"),
        F.date_format("o_orderdate", "yyyy").alias("ano"),
        F.date_format("o_orderdate", "MM").alias("mes"),
    )


@check("scan_admissions", f"select o_orderkey, uf, ano, mes from ({_PER_MONTH_SQL}) where uf = 'RJ' and ano = '2000'")
def scan_admissions(spark, sf_dir):
    base = bronze_of(_admitted(spark, sf_dir), "sih-parquet/RD", "RD")
    return scan(spark, base, "SIH.RD", ["RJ"], [2000]).select("o_orderkey", "uf", "ano", "mes")


@check(
    "scan_grid",
    f"select uf, ano, mes, count(*) as n from ({_PER_MONTH_SQL}) where ano in ('1995', '1996') group by uf, ano, mes",
)
def scan_grid(spark, sf_dir):
    base = bronze_of(_admitted(spark, sf_dir), "sih-parquet/RD", "RD")
    return scan(spark, base, "SIH.RD", ["SP", "RJ"], [1995, 1996]).groupBy("uf", "ano", "mes").agg(F.count("*").alias("n"))


@check(
    "missing_datasets",
    f"select g.uf, g.ano, g.mes from (select uf, ano, lpad(cast(m as varchar), 2, '0') as mes from"
    " (select unnest(['SP', 'RJ', 'AC']) as uf), (select unnest(['2000', '2001']) as ano), (select unnest(range(1, 13)) as m)) g"
    f" where not exists (select 1 from ({_PER_MONTH_SQL}) o where o.uf = g.uf and o.ano = g.ano and o.mes = g.mes)",
)
def missing_datasets(spark, sf_dir):
    base = bronze_of(_admitted(spark, sf_dir), "sih-parquet/RD", "RD")
    grid = partition_grid(spark, ["SP", "RJ", "AC"], [2000, 2001])
    return missing_partitions(grid, list_datasets(spark, f"{base}/sih-parquet/RD"), ["uf", "ano", "mes"])


@check(
    "list_datasets",
    f"select 'DO' || uf || ano as dataset, 'DO' as tabela, uf, ano from ({MORTALITY_SQL}) group by uf, ano",
)
def datasets(spark, sf_dir):
    base = bronze_of(mortality(spark, sf_dir), "sim-parquet", "DO")
    return list_datasets(spark, base).select("dataset", "tabela", "uf", "ano")


@check("scan_literal", "select count(*) as n, sum(o_totalprice) > 0 as positivo from orders")
def scan_literal(spark, sf_dir):
    rows = read_records(spark, f"{sf_dir}/orders.parquet", merge_schema=False)
    return rows.agg(F.count("*").alias("n"), (F.sum("o_totalprice") > 0).alias("positivo"))


@check("scan_delta_files", f"select chave, \"AP_CONDIC\" from ({OUTPATIENT_SQL}) where uf = 'SP' and ano = '1998' and mes = '03'")
def scan_delta_files(spark, sf_dir):
    # no Delta library here: all Parquet files of the directory are read
    base = bronze_of(outpatient(spark, sf_dir), "sia-delta", "PAR", extension="delta")
    return read_delta(spark, f"{base}/sia-delta/dataset=PARSP9803.delta", raw_files=True).select("chave", "AP_CONDIC")


@check(
    "scan_delta_grid",
    f"select chave, linha, uf, ano, mes from ({OUTPATIENT_SQL}) where uf = 'SP' and ano in ('1998', '1999') and mes = '01'",
)
def scan_delta_grid(spark, sf_dir):
    base = bronze_of(outpatient(spark, sf_dir), "sia-delta", "PAR", extension="delta")
    return scan(spark, base, "SIA.PAR", ["SP"], [1998, 1999], [1], raw_delta_files=True).select("chave", "linha", "uf", "ano", "mes")


@check(
    "union_drifted_files",
    "select o_orderkey as chave, cast(o_custkey as varchar) as codigo, o_orderstatus as extra, 'DOSP1996' as dataset from orders"
    " where o_orderkey % 2 = 0 union all select o_orderkey, 'c' || cast(o_custkey as varchar), null, 'DOSP1997' from orders"
    " where o_orderkey % 2 = 1",
)
def union_drifted(spark, sf_dir):
    # one dataset has numbers where the other has text, and a column the other lacks
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "chave")
    base = new_folder(spark, "drift")
    first, second = f"{base}/DOSP1996.parquet", f"{base}/DOSP1997.parquet"
    orders.where("chave % 2 = 0").select(
        "chave", F.col("o_custkey").alias("codigo"), F.col("o_orderstatus").alias("extra")
    ).write.parquet(first)
    orders.where("chave % 2 = 1").select(
        "chave", F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("codigo")
    ).write.parquet(second)
    return read_mixed(spark, [first, second], "dataset")


@check(
    "merge_missing_columns",
    "select o_orderkey, case when o_orderkey % 2 = 0 then o_orderstatus end as o_orderstatus from orders",
)
def merge_missing(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    base = new_folder(spark, "merge")
    orders.where("o_orderkey % 2 = 0").select("o_orderkey", "o_orderstatus").write.parquet(f"{base}/a")
    orders.where("o_orderkey % 2 = 1").select("o_orderkey").write.parquet(f"{base}/b")
    return read_records(spark, base)


@check(
    "silver_roundtrip",
    f"select chave, \"IDADE\", uf, ano, case when uf in ('SP', 'RJ') then 'SUDESTE' else 'NORDESTE' end as regiao"
    f" from ({MORTALITY_SQL}) where ano = '1997' and uf = 'PE'",
)
def silver_roundtrip(spark, sf_dir):
    base = new_folder(spark, "silver")
    write_silver(mortality(spark, sf_dir), base, "SIM", "DO", rebalance=True)
    rows = read_silver(spark, base, "SIM", "DO")
    return rows.where("ano = '1997' and uf = 'PE'").select("chave", "IDADE", "uf", "ano", "regiao")


@check(
    "silver_overwrite",
    "select cast(o_orderkey as varchar) as chave, strftime(o_orderdate, '%Y') as ano, case when strftime(o_orderdate, '%Y') = '1996'"
    " then 'novo' else o_orderstatus end as situacao, 'SP' as uf from orders",
)
def silver_overwrite(spark, sf_dir):
    # the second run replaces 1996 and leaves the other years
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("chave"),
        F.date_format("o_orderdate", "yyyy").alias("ano"),
        F.col("o_orderstatus").alias("situacao"),
        F.lit("SP").alias("uf"),
    )
    base = new_folder(spark, "silver")
    write_silver(rows, base, "SIM", "DO", rebalance=True)
    write_silver(rows.where("ano = '1996'").withColumn("situacao", F.lit("novo")), base, "SIM", "DO")
    return read_silver(spark, base, "SIM", "DO").select("chave", "ano", "situacao", "uf")


@check("table_roundtrip", "select o_orderkey, o_totalprice from orders")
def table_roundtrip(spark, sf_dir):
    path = new_folder(spark, "table")
    kind = write_table(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), path)
    return spark.read.format(kind).load(path)


@check(
    "convert_datasets",
    f"select chave, \"SEXO\", 'DO' || uf || ano as dataset from ({MORTALITY_SQL})",
)
def convert(spark, sf_dir):
    base = bronze_of(mortality(spark, sf_dir), "sim-parquet", "DO")
    target = new_folder(spark, "converted")
    convert_datasets(spark, base, target, "parquet")
    return spark.read.parquet(target).select("chave", "SEXO", "dataset")


@check(
    "audit_of_files",
    f"select 'DO' || uf || ano || '.parquet' as \"Arquivo\", cast(count(*) as varchar) as \"Número de Registros\","
    f" 'chave, IDADE, CAUSABAS, CAUSABAS_O, SEXO, RACACOR, DTOBITO, ORIGEM' as \"Colunas\" from ({MORTALITY_SQL}) group by uf, ano",
)
def audit_of_files(spark, sf_dir):
    base = bronze_of(mortality(spark, sf_dir), "sim-parquet", "DO")
    path = new_folder(spark, "audit")
    write_report_csv(audit_datasets(spark, base), path)
    return spark.read.csv(path, header=True).select(fv.AUDIT_FILE, fv.AUDIT_ROWS, fv.AUDIT_COLUMNS)


@check("json_rows", f"""select '{{"chave":' || cast(chave as varchar) || ',"SEXO":"' || "SEXO" || '","RACACOR":' ||
  case when "RACACOR" is null then 'null' else '"' || "RACACOR" || '"' end || '}}' as json from ({MORTALITY_SQL})""")
def rows_as_json(spark, sf_dir):
    return json_rows(mortality(spark, sf_dir).select("chave", "SEXO", "RACACOR"))


@check("json_by_state", f'select chave, "RACACOR", uf from ({MORTALITY_SQL})')
def json_by_state(spark, sf_dir):
    path = new_folder(spark, "json")
    write_json_rows(mortality(spark, sf_dir).select("chave", "RACACOR", "uf"), path)
    return spark.read.schema("chave long, RACACOR string, uf string").json(path)
