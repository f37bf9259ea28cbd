"""Code lookups, regions, dataset names and grids."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from checks.registry import check, table
from checks.stand_ins import ICD_ITEMS, ICD_SQL, MORTALITY_SQL, STATES, mortality, pick, resolve_sql, sql_list
from vitaria import fixed_values as fv
from vitaria.functions import parse_dataset
from vitaria.operators import columns as ops
from vitaria.operators.codes import distinct_codes, exact_lookup, resolve_codes, resolve_distinct
from vitaria.operators.joins import BroadcastBound, lookup_join
from vitaria.operators.partitions import add_region, in_regions, missing_partitions
from vitaria.sinks.shared import new_folder
from vitaria.sources import CodeDictionary
from vitaria.sources.bronze import MONTHS, partition_grid

BRANDS = [
    ("Brand#1", "primeira família"),
    ("Brand#17", "dezessete"),
    ("Brand#22", "vinte e dois, primeiro"),
    ("Brand#2", "segunda família"),
    ("Brand#25", "vinte e cinco"),
    ("Brand#3", "Brand#3"),
    ("Brand#22", "vinte e dois, por último"),
    ("Brand#9", "nove"),
]
_BRAND_SQL = """dic(ord, code, description) as (values (0, 'Brand#1', 'primeira família'), (1, 'Brand#17', 'dezessete'),
  (2, 'Brand#22', 'vinte e dois, por último'), (3, 'Brand#2', 'segunda família'), (4, 'Brand#25', 'vinte e cinco'),
  (5, 'Brand#3', 'Brand#3'), (7, 'Brand#9', 'nove'))"""


def _brands(spark):
    return CodeDictionary.from_entries(spark, [{"code": c, "description": d} for c, d in BRANDS])


@check(
    "prefix_lookup",
    f"with {_BRAND_SQL} select p_partkey, {resolve_sql('p_brand')} as p_brand from part",
)
def prefix_lookup(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return resolve_codes(parts, ["p_brand", "not_there"], _brands(spark))


@check(
    "exact_lookup",
    f"with {_BRAND_SQL} select p_partkey, coalesce(description, p_brand) as p_brand from part"
    " left join dic on code = p_brand",
)
def exact(spark, sf_dir):
    return exact_lookup(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), ["p_brand"], _brands(spark))


@check(
    "keep_category",
    f"with {_BRAND_SQL} select p_partkey, {resolve_sql('p_brand')} as p_brand, p_brand as p_brand_keep from part",
)
def keep_category(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return resolve_codes(ops.keep_raw(parts, ["p_brand"]), ["p_brand"], _brands(spark))


@check(
    "icd_two_columns",
    f"with {ICD_SQL} select chave, {resolve_sql('m.CAUSABAS')} as \"CAUSABAS\", {resolve_sql('m.CAUSABAS_O')} as \"CAUSABAS_O\""
    f" from ({MORTALITY_SQL}) m",
)
def icd(spark, sf_dir):
    rows = mortality(spark, sf_dir).select("chave", "CAUSABAS", "CAUSABAS_O")
    return resolve_codes(rows, fv.SIM_ICD_COLUMNS, CodeDictionary.from_entries(spark, ICD_ITEMS))


# a dictionary out of the data: types by name, first seen first
_DATA_DIC = """dic as (select row_number() over (order by o, code) as ord, code, description from (
  select p_brand as code, min(p_partkey) as o, max(p_type) as description from part group by p_brand))"""


def _data_dictionary(spark, sf_dir, bound):
    entries = (
        table(spark, sf_dir, "part")
        .groupBy(F.col("p_brand").alias("code"))
        .agg(F.min("p_partkey").alias("ord"), F.max("p_type").alias("description"))
    )
    return CodeDictionary.from_frame(entries, bound)


_DATA_SQL = (
    f"with {_DATA_DIC}, coded as (select p_partkey, p_brand || cast(p_size % 10 as varchar) as codigo from part)"
    f" select p_partkey, {resolve_sql('coded.codigo')} as codigo from coded"
)


def _coded(spark, sf_dir):
    code = F.concat("p_brand", (F.col("p_size") % 10).cast("string"))
    return table(spark, sf_dir, "part").select("p_partkey", code.alias("codigo"))


@check("prefix_lookup_data_dictionary", _DATA_SQL)
def data_dictionary(spark, sf_dir):
    bound = BroadcastBound()
    return resolve_codes(_coded(spark, sf_dir), ["codigo"], _data_dictionary(spark, sf_dir, bound), bound)


@check("prefix_lookup_large_dictionary", _DATA_SQL)
def large_dictionary(spark, sf_dir):
    # a bound of nothing takes the way that dictionaries too large to broadcast take
    bound = BroadcastBound(rows=0, size=0)
    return resolve_codes(_coded(spark, sf_dir), ["codigo"], _data_dictionary(spark, sf_dir, bound), bound)


@check("distinct_codes", f'select distinct "CAUSABAS" as code from ({MORTALITY_SQL}) where "CAUSABAS" is not null')
def distinct(spark, sf_dir):
    return distinct_codes(mortality(spark, sf_dir), ["CAUSABAS"])


@check(
    "resolved_codes",
    f"with {ICD_SQL}, codes as (select distinct \"CAUSABAS\" as code from ({MORTALITY_SQL}) where \"CAUSABAS\" is not null)"
    f" select c.code, {resolve_sql('c.code')} as description from codes c"
    " where exists (select 1 from dic where starts_with(c.code, dic.code))",
)
def resolved(spark, sf_dir):
    return resolve_distinct(mortality(spark, sf_dir), ["CAUSABAS"], CodeDictionary.from_entries(spark, ICD_ITEMS))


_REGION_SQL = "states(regiao, uf) as (values " + ", ".join(
    f"('{region}', '{uf}')" for region, ufs in fv.REGIONS.items() for uf in ufs
) + ")"


@check(
    "region_enrich",
    f"with {_REGION_SQL} select chave, m.uf, regiao from ({MORTALITY_SQL}) m left join states on states.uf = m.uf",
)
def region_enrich(spark, sf_dir):
    return add_region(mortality(spark, sf_dir).select("chave", "uf"))


@check(
    "region_of_nation",
    "select n_nationkey, n_name, r_name from nation left join region on n_regionkey = r_regionkey",
)
def region_of_nation(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    return lookup_join(nation, table(spark, sf_dir, "region"), ["r_regionkey"]).select("n_nationkey", "n_name", "r_name")


@check(
    "lookup_hot_keys",
    "select l_orderkey, l_linenumber, l_suppkey, s_name from lineitem left join supplier on l_suppkey = s_suppkey and s_suppkey % 3 > 0",
)
def lookup_hot_keys(spark, sf_dir):
    # the side counts as large, and every supplier has more rows than are allowed in one task
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("s_suppkey"))
    side = table(spark, sf_dir, "supplier").where("s_suppkey % 3 > 0").select("s_suppkey", "s_name")
    joined = lookup_join(lines, side, ["s_suppkey"], small=False, hot_rows=100)
    return joined.select("l_orderkey", "l_linenumber", F.col("s_suppkey").alias("l_suppkey"), "s_name")


@check("region_members", f"select chave, uf from ({MORTALITY_SQL}) where uf in ('SP', 'RJ', 'MG', 'ES')")
def region_members(spark, sf_dir):
    return in_regions(mortality(spark, sf_dir).select("chave", "uf"), ["SUDESTE"])


_MONTH_GRID_SQL = """with span as (select min(year(o_orderdate)) as a, max(year(o_orderdate)) as b from orders),
 grid as (select cast(y as varchar) as ano, lpad(cast(m as varchar), 2, '0') as mes
   from (select unnest(range(a - 1, b + 1)) as y from span), (select unnest(range(1, 13)) as m))"""


@check(
    "missing_partitions",
    _MONTH_GRID_SQL + " select grid.ano, grid.mes from grid where not exists (select 1 from orders"
    " where strftime(o_orderdate, '%Y') = grid.ano and strftime(o_orderdate, '%m') = grid.mes)",
)
def missing(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    span = orders.agg(F.min(F.year("o_orderdate")).alias("a"), F.max(F.year("o_orderdate")).alias("b"))
    years = F.sequence(F.col("a") - 1, F.col("b")).cast("array<string>")
    grid = span.select(F.explode(years).alias("ano")).select(
        "ano", F.explode(F.array(*[F.lit(month) for month in MONTHS])).alias("mes")
    )
    observed = orders.select(F.date_format("o_orderdate", "yyyy").alias("ano"), F.date_format("o_orderdate", "MM").alias("mes"))
    return missing_partitions(grid, observed, ["ano", "mes"])


@check(
    "partition_grid",
    f"select uf, ano, mes, count(chave) as n from (select unnest({sql_list(['SP', 'PE', 'AC'])}) as uf),"
    " (select unnest(['1996', '1997']) as ano), (select lpad(cast(unnest(range(1, 13)) as varchar), 2, '0') as mes)"
    " left join (select o_orderkey as chave, " + f"{sql_list(STATES)}[o_custkey % 4 + 1] as u,"
    " strftime(o_orderdate, '%Y') as y, strftime(o_orderdate, '%m') as m from orders) on u = uf and y = ano and m = mes"
    " group by uf, ano, mes",
)
def grid_counts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        pick(STATES, F.col("o_custkey") % 4).alias("uf"),
        F.date_format("o_orderdate", "yyyy").alias("ano"),
        F.date_format("o_orderdate", "MM").alias("mes"),
    )
    # rows are counted per coordinate first, so the join is between small tables
    per_coordinate = orders.groupBy("uf", "ano", "mes").agg(F.count("*").alias("n"))
    grid = partition_grid(spark, ["SP", "PE", "AC"], [1996, 1997], range(1, 13))
    return grid.join(per_coordinate, ["uf", "ano", "mes"], "left").select(
        "uf", "ano", "mes", F.coalesce("n", F.lit(0)).alias("n")
    )


TABLES = ["ACF", "AM", "PA", "PAM", "SP", "IMPBO", "DO"]
_NAMES_SQL = f"""select c_custkey, t, u, y,
  'bronze/' || t || u || case when t = 'DO' then y else substr(y, 3, 2) || m end
  || case when t = 'PA' then 'b' else '' end || '.parquet/part-0.parquet' as caminho, m
 from (select c_custkey, {sql_list(TABLES)}[c_custkey % 7 + 1] as t, {sql_list(STATES)}[c_nationkey % 4 + 1] as u,
   cast(1996 + c_custkey % 28 as varchar) as y, lpad(cast(c_custkey % 12 + 1 as varchar), 2, '0') as m from customer)"""


def _names(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey",
        pick(TABLES, F.col("c_custkey") % 7).alias("t"),
        pick(STATES, F.col("c_nationkey") % 4).alias("u"),
        (1996 + F.col("c_custkey") % 28).cast("string").alias("y"),
        F.lpad((F.col("c_custkey") % 12 + 1).cast("string"), 2, "0").alias("m"),
    )
    digits = F.when(F.col("t") == "DO", F.col("y")).otherwise(F.concat(F.right("y", F.lit(2)), "m"))
    segment = F.when(F.col("t") == "PA", "b").otherwise("")
    return customer.select(
        "c_custkey",
        F.concat(F.lit("bronze/"), "t", "u", digits, segment, F.lit(".parquet/part-0.parquet")).alias("caminho"),
    )


@check(
    "parse_dataset_name",
    f"select c_custkey, caminho, t as tabela, u as uf, y as ano, case when t <> 'DO' then m end as mes,"
    f" case when t = 'PA' then 'b' else '' end as segmento from ({_NAMES_SQL})",
)
def parse_names(spark, sf_dir):
    return _names(spark, sf_dir).withColumns(parse_dataset(F.col("caminho")))


@check(
    "dictionary_from_json",
    f"with {_BRAND_SQL} select p_partkey, {resolve_sql('p_brand')} as p_brand from part",
)
def dictionary_file(spark, sf_dir):
    path = new_folder(spark, "dictionary-file")
    items = [{"code": code, "description": text} for code, text in BRANDS]
    spark.createDataFrame([(json.dumps(items),)], "value string").write.text(path)
    dictionary = CodeDictionary.from_json(spark, path)
    return resolve_codes(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), ["p_brand"], dictionary)
