"""Column, year and frequency operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check, sql_case, table
from checks.stand_ins import ADMISSIONS_SQL, AGE_SQL, MORTALITY_SQL, OUTPATIENT_SQL, admissions, mortality, outpatient
from vitaria import fixed_values as fv
from vitaria import rules
from vitaria.functions import dataset_name, lookup_or
from vitaria.operators import columns as ops
from vitaria.operators.frequency import stack_columns, value_counts, year_frequency
from vitaria.operators.years import add_year, filter_years, year_predicate


@check(
    "drop_columns",
    "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate from orders",
)
def drop_columns(spark, sf_dir):
    flat = rules.drop_list(["o_orderpriority", "not_there"])
    return ops.drop_columns(table(spark, sf_dir, "orders"), flat)


@check("drop_columns_by_id", "select o_orderkey, o_totalprice, o_orderdate, o_orderpriority from orders")
def drop_columns_by_id(spark, sf_dir):
    entries = [
        {"id": 0, "to_drop": ["o_orderpriority"]},
        {"id": 1, "to_drop": ["o_custkey", "not_there"]},
        {"id": 0, "to_drop": ["o_orderstatus"]},
    ]
    return ops.drop_columns(table(spark, sf_dir, "orders"), rules.drop_list(entries, "all"))


@check("drop_columns_first", "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate from orders")
def drop_columns_first(spark, sf_dir):
    entries = [{"id": 0, "to_drop": ["o_orderpriority"]}, {"id": 1, "to_drop": ["o_custkey"]}]
    return ops.drop_columns(table(spark, sf_dir, "orders"), rules.drop_list(entries, "first"))


@check(
    "rename_columns",
    'select o_orderkey as "Pedido", o_custkey as "Cliente", o_orderstatus as "Situação/Fase", o_totalprice,'
    " o_orderdate, o_orderpriority from orders",
)
def rename_columns(spark, sf_dir):
    names = {"o_orderkey": "Pedido", "o_custkey": "Cliente", "o_orderstatus": "Situação/Fase", "gone": "x"}
    return ops.rename_columns(table(spark, sf_dir, "orders"), names)


@check(
    "rename_collision",
    'select o_orderkey as "Pedido", o_custkey as "Cliente", o_totalprice as "Cliente_2" from orders',
)
def rename_collision(spark, sf_dir):
    few = ops.select_columns(table(spark, sf_dir, "orders"), "o_orderkey", "o_custkey", "o_totalprice")
    names = {"o_orderkey": "Pedido", "o_custkey": "Cliente", "o_totalprice": "Cliente"}
    return ops.rename_columns(few, names, on_collision="suffix")


@check("select_columns", "select l_orderkey, l_shipdate from lineitem")
def select_columns(spark, sf_dir):
    return ops.select_columns(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_shipdate")


@check(
    "column_list",
    "select 'o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority' as \"Colunas\","
    " count(*) as n from orders",
)
def column_list(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.agg(F.count("*").alias("n")).select(F.lit(ops.column_list(orders)).alias("Colunas"), "n")


STATUS = {"F": "Fechado", "O": "Aberto"}


@check("recode_status", f"select o_orderkey, {sql_case('o_orderstatus', STATUS)} from orders")
def recode_status(spark, sf_dir):
    few = ops.select_columns(table(spark, sf_dir, "orders"), "o_orderkey", "o_orderstatus")
    return ops.recode_columns(few, rules.recode_table({"o_orderstatus": STATUS}))


@check(
    "recode_multi",
    f"select chave, linha, {sql_case('AP_CONDIC', fv.SIA_RECODE['AP_CONDIC'])},"
    f" {sql_case('AP_SEXO', fv.SIA_RECODE['AP_SEXO'])}, {sql_case('AP_RACACOR', fv.SIA_RECODE['AP_RACACOR'])},"
    f' {sql_case("AP_OBITO", fv.SIA_RECODE["AP_OBITO"])}, "AP_ALTA" from ({OUTPATIENT_SQL})',
)
def recode_multi(spark, sf_dir):
    # AP_ALTA holds numbers here, so its rule matches nothing
    rows = outpatient(spark, sf_dir).select(
        "chave", "linha", "AP_CONDIC", "AP_SEXO", "AP_RACACOR", "AP_OBITO", "AP_ALTA"
    )
    return ops.recode_columns(rows, fv.SIA_RECODE)


@check(
    "recode_list",
    f"select chave, {sql_case('SEXO', fv.SIM_RECODE['SEXO'])}, {sql_case('RACACOR', {'1': 'Branca', '2': 'Preta'})}"
    f" from ({MORTALITY_SQL})",
)
def recode_list(spark, sf_dir):
    listed = [
        {"id": 0, "column_name": "SEXO", "to_replace": ["0", "1", "2"], "value": ["Ignorado", "Homem", "Mulher"]},
        {"id": 1, "column_name": "RACACOR", "to_replace": ["1", "2", "3"], "value": ["Branca", "Preta"]},
    ]
    return ops.recode_columns(mortality(spark, sf_dir).select("chave", "SEXO", "RACACOR"), rules.recode_table(listed))


@check(
    "recode_replace",
    f"select chave, case \"SEXO\" when '1' then '2' when '2' then '1' else \"SEXO\" end as \"SEXO\" from ({MORTALITY_SQL})",
)
def recode_replace(spark, sf_dir):
    # a swap shows that replacements do not chain
    listed = [{"id": 0, "column_name": "SEXO", "to_replace": ["1", "2"], "value": ["2", "1"]}]
    table_ = rules.recode_table(listed, strict=True)
    return ops.recode_columns(mortality(spark, sf_dir).select("chave", "SEXO"), table_, blank_null_labels=True)


MANY = {f"{number:02d}": f"faixa {number // 5}" for number in range(60)}


@check(
    "recode_many_labels",
    "select o_orderkey, case when o_custkey % 100 < 60 then 'faixa ' || cast((o_custkey % 100) // 5 as varchar)"
    " else lpad(cast(o_custkey % 100 as varchar), 2, '0') end as codigo from orders",
)
def recode_many_labels(spark, sf_dir):
    code = F.lpad((F.col("o_custkey") % 100).cast("string"), 2, "0")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", code.alias("codigo"))
    return ops.recode_columns(rows, {"codigo": MANY})


@check(
    "recode_by_table",
    "select o_orderkey, coalesce(c_name, cast(o_custkey as varchar)) as cliente from orders"
    " left join customer on o_custkey = c_custkey and c_nationkey < 20",
)
def recode_by_table(spark, sf_dir):
    side = (
        table(spark, sf_dir, "customer")
        .where("c_nationkey < 20")
        .select(F.col("c_custkey").cast("string").alias("code"), F.col("c_name").alias("label"))
    )
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("cliente"))
    return ops.recode_by_table(rows, "cliente", side)


@check(
    "decode_age",
    f"select chave, {AGE_SQL.format(c='codigo')} as idade from (select o_orderkey as chave, cast(o_orderkey % 7 as varchar)"
    " || lpad(cast(o_custkey % 100 as varchar), 2, '0') as codigo from orders)",
)
def decode_age(spark, sf_dir):
    code = F.concat(
        (F.col("o_orderkey") % 7).cast("string"), F.lpad((F.col("o_custkey") % 100).cast("string"), 2, "0")
    )
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("chave"), code.alias("idade"))
    return ops.decode_ages(rows, ["idade"])


@check("decode_age_bad", f"select chave, {AGE_SQL.format(c='IDADE')} as \"IDADE\" from ({MORTALITY_SQL})")
def decode_age_bad(spark, sf_dir):
    return ops.decode_ages(mortality(spark, sf_dir).select("chave", "IDADE"), [fv.SIM_AGE_COLUMN])


@check(
    "year_column",
    "select o_orderkey, substr(cast(o_orderdate as varchar), 1, 4) as ano_inter from orders",
)
def year_column(spark, sf_dir):
    return add_year(table(spark, sf_dir, "orders"), "o_orderdate").select("o_orderkey", "ano_inter")


@check(
    "year_filter",
    "select o_orderkey, o_totalprice, substr(cast(o_orderdate as varchar), 1, 4) as ano_inter from orders"
    " where substr(cast(o_orderdate as varchar), 1, 4) in ('1995', '1996')",
)
def year_filter(spark, sf_dir):
    kept = filter_years(table(spark, sf_dir, "orders"), "o_orderdate", ["1995", "1996"])
    return kept.select("o_orderkey", "o_totalprice", "ano_inter")


@check(
    "year_filter_text",
    f"select \"N_AIH\", \"DT_INTER\", substr(\"DT_INTER\", 1, 4) as ano_inter from ({ADMISSIONS_SQL})"
    " where substr(\"DT_INTER\", 1, 4) in ('1998', '2000')",
)
def year_filter_text(spark, sf_dir):
    kept = filter_years(admissions(spark, sf_dir), "DT_INTER", ["1998", "2000"])
    return kept.select("N_AIH", "DT_INTER", "ano_inter")


@check(
    "year_equals_project",
    "select o_orderdate, o_orderpriority from orders where substr(cast(o_orderdate as varchar), 1, 4) = '1997'",
)
def year_equals_project(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return ops.select_columns(
        orders.where(year_predicate(orders, "o_orderdate", ["1997"])), "o_orderdate", "o_orderpriority"
    )


@check(
    "stack_columns",
    f"select \"DT_INTER\" as valor from ({ADMISSIONS_SQL}) union all select \"DT_SAIDA\" from ({ADMISSIONS_SQL})",
)
def stack(spark, sf_dir):
    return stack_columns(admissions(spark, sf_dir), "DT_INTER", "DT_SAIDA")


@check(
    "year_frequency",
    "select ano, count(*) as \"count\" from (select substr(\"DT_INTER\", 1, 4) as ano"
    f" from ({ADMISSIONS_SQL}) union all select substr(\"DT_SAIDA\", 1, 4) from ({ADMISSIONS_SQL}))"
    " where ano is not null group by ano",
)
def years(spark, sf_dir):
    return year_frequency(admissions(spark, sf_dir), "DT_INTER", "DT_SAIDA")


@check(
    "year_frequency_filtered",
    "select ano, count(*) as \"count\" from (select unnest([substr(\"DT_INTER\", 1, 4), substr(\"DT_SAIDA\", 1, 4)]) as ano"
    f" from ({ADMISSIONS_SQL}) where substr(\"DT_INTER\", 1, 4) in ('1999', '2000')) where ano is not null group by ano",
)
def years_filtered(spark, sf_dir):
    return year_frequency(
        filter_years(admissions(spark, sf_dir), "DT_INTER", ["1999", "2000"]), "DT_INTER", "DT_SAIDA"
    )


@check(
    "year_frequency_two_tables",
    "select ano, count(*) as \"count\" from (select substr(cast(l_shipdate as varchar), 1, 4) as ano from lineitem"
    " union all select substr(cast(o_orderdate as varchar), 1, 4) from orders) where ano is not null group by ano",
)
def years_two_tables(spark, sf_dir):
    shipped = add_year(table(spark, sf_dir, "lineitem"), "l_shipdate", "ano").select("ano")
    ordered = add_year(table(spark, sf_dir, "orders"), "o_orderdate", "ano").select("ano")
    return value_counts(shipped.unionAll(ordered), "ano")


@check(
    "value_counts",
    "select event_type, count(*) as \"count\" from events where event_type is not null group by event_type",
)
def counts(spark, sf_dir):
    return value_counts(table(spark, sf_dir, "events"), "event_type")


@check("value_counts_codes", f"select \"RACACOR\", count(*) as \"count\" from ({MORTALITY_SQL}) where \"RACACOR\" is not null group by 1")
def counts_codes(spark, sf_dir):
    return value_counts(mortality(spark, sf_dir), "RACACOR")


@check("birth_year_of_admitted", f"""select substr("NASC", 1, 4) as ano_nasc, "DT_INTER" from ({ADMISSIONS_SQL})
  where substr("DT_INTER", 1, 4) = '1999'""")
def birth_year(spark, sf_dir):
    rows = admissions(spark, sf_dir)
    return add_year(rows.where(year_predicate(rows, "DT_INTER", ["1999"])), "NASC", "ano_nasc").select(
        "ano_nasc", "DT_INTER"
    )


@check(
    "enforce_dates",
    f"""select chave, linha, cast(cast(try_strptime("AP_DTINIC", '%Y%m%d') as date) as varchar) as "AP_DTINIC",
  cast(cast(try_strptime("AP_CMP" || '01', '%Y%m%d') as date) as varchar) as "AP_CMP" from ({OUTPATIENT_SQL})""",
)
def dates(spark, sf_dir):
    rows = ops.enforce_dates(outpatient(spark, sf_dir), {"AP_DTINIC": "yyyyMMdd", "AP_CMP": "yyyyMM", "AP_DTFIM": "yyyyMMdd"})
    return rows.select(
        "chave", "linha", F.col("AP_DTINIC").cast("string").alias("AP_DTINIC"), F.col("AP_CMP").cast("string").alias("AP_CMP")
    )


@check(
    "text_functions",
    """select c_custkey,
  substr(c_name, 1, 4) as primeiros,
  right(c_name, 2) as ultimos,
  lpad(cast(c_custkey % 12 + 1 as varchar), 2, '0') as mes,
  split_part(c_name, '#', 1) as antes,
  replace(c_name, '#', '.') as trocado,
  regexp_extract('/d/' || c_mktsegment || '.parquet/part-0.parquet', '([A-Z]+)\\.parquet', 1) as dataset,
  c_mktsegment || ', ' || c_name as junto,
  starts_with(c_mktsegment, 'B') as comeca,
  try_cast(substr(c_name, 10) as integer) as numero,
  c_nationkey + 100 as somado,
  cast(c_nationkey as varchar) as texto,
  case c_mktsegment when 'BUILDING' then 'Obra' when 'MACHINERY' then 'Máquina' else 'Outro' end as segmento
from customer""",
)
def text_functions(spark, sf_dir):
    path = F.concat(F.lit("/d/"), "c_mktsegment", F.lit(".parquet/part-0.parquet"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.substring("c_name", 1, 4).alias("primeiros"),
        F.right("c_name", F.lit(2)).alias("ultimos"),
        F.lpad((F.col("c_custkey") % 12 + 1).cast("string"), 2, "0").alias("mes"),
        F.substring_index("c_name", "#", 1).alias("antes"),
        F.replace("c_name", F.lit("#"), F.lit(".")).alias("trocado"),
        dataset_name(path).alias("dataset"),
        F.concat_ws(", ", "c_mktsegment", "c_name").alias("junto"),
        F.startswith("c_mktsegment", F.lit("B")).alias("comeca"),
        F.substr("c_name", F.lit(10)).try_cast("int").alias("numero"),
        (F.col("c_nationkey") + 100).alias("somado"),
        F.col("c_nationkey").cast("string").alias("texto"),
        lookup_or(F.col("c_mktsegment"), ["BUILDING", "MACHINERY"], ["Obra", "Máquina"], F.lit("Outro")).alias("segmento"),
    )
