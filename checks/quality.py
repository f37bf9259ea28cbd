"""Audits, quarantine and catalog tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from checks.registry import check, table
from checks.stand_ins import MORTALITY_SQL, OUTPATIENT_SQL, mortality, outpatient
from vitaria import fixed_values as fv
from vitaria.functions import age_is_bad, date_is_bad
from vitaria.operators import columns as ops
from vitaria.operators.lineage import file_metadata, lineage_edges, process_records
from vitaria.operators.quality import audit, audit_datasets, audit_diff, missing_columns, quarantine
from vitaria.operators.years import filter_years
from vitaria.plans.chain import chain_lineage, chain_quarantine, with_options
from vitaria.plans.specs import SPECS
from vitaria.sinks.tables import listed_as_text

COLUMNS = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "lineitem": [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    ],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
    "embeddings": ["vec_id", "embedding", "label"],
    "pages": ["page_id", "url", "html"],
    "benchmark": ["item_id", "text"],
    "labels": ["doc_id", "quality", "toxic"],
    "conversations": ["conv_id", "turn", "role", "text"],
}
_AUDIT_SQL = " union all ".join(
    f"select '{name}.parquet' as \"Arquivo\", count(*) as \"Número de Registros\", '{', '.join(columns)}' as \"Colunas\" from {name}"
    for name, columns in COLUMNS.items()
)


@check("audit_counts", _AUDIT_SQL)
def audit_counts(spark, sf_dir):
    return listed_as_text(audit_datasets(spark, sf_dir))


@check(
    "missing_columns",
    " union all ".join(
        f"select '{name}.parquet' as \"Arquivo\", '{c}' as coluna from (select count(*) from {name})"
        for name, columns in COLUMNS.items()
        for c in ("text", "doc_id")
        if c not in columns
    ),
)
def missing(spark, sf_dir):
    return missing_columns(audit_datasets(spark, sf_dir), ["text", "doc_id"])


@check(
    "audit_diff",
    "select strftime(o_orderdate, '%Y') as \"Arquivo\", count(*) as registros_antes,"
    " case when strftime(o_orderdate, '%Y') in ('1996', '1997') then count(*) end as registros_depois,"
    " case when strftime(o_orderdate, '%Y') in ('1996', '1997') then 0 else count(*) end as registros_perdidos,"
    " case when strftime(o_orderdate, '%Y') in ('1996', '1997') then 'o_orderpriority' else"
    " 'o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority' end as colunas_removidas,"
    " case when strftime(o_orderdate, '%Y') in ('1996', '1997') then 'ano_inter' else '' end as colunas_adicionadas"
    " from orders group by 1",
)
def diff(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    year = F.date_format("o_orderdate", "yyyy")
    kept = ops.drop_columns(filter_years(orders, "o_orderdate", ["1996", "1997"]), ["o_orderpriority"])
    return listed_as_text(audit_diff(audit(orders, year), audit(kept, year)))


_BAD_AGE = 'case when "IDADE" like \'x%\' then true else false end'


@check(
    "quarantine_age",
    f"select 'DO' || uf || ano as dataset, 'IDADE' as coluna, \"IDADE\" as valor, count(*) as ocorrencias"
    f" from ({MORTALITY_SQL}) where {_BAD_AGE} group by 1, 2, 3",
)
def quarantine_age(spark, sf_dir):
    rows = mortality(spark, sf_dir)
    return quarantine(rows, {"IDADE": age_is_bad(F.col("IDADE"))}, F.concat(F.lit("DO"), "uf", "ano"))


@check(
    "quarantine_dates",
    f"select dataset, coluna, valor, count(*) as ocorrencias from (select 'AM' || uf || substr(ano, 3, 2) || mes as dataset,"
    f" 'AP_DTINIC' as coluna, \"AP_DTINIC\" as valor from ({OUTPATIENT_SQL}) where \"AP_DTINIC\" = '20219999'"
    f" union all select 'AM' || uf || substr(ano, 3, 2) || mes, 'AP_CONDIC', \"AP_CONDIC\" from ({OUTPATIENT_SQL})"
    " where \"AP_CONDIC\" = 'R') group by 1, 2, 3",
)
def quarantine_dates(spark, sf_dir):
    dataset = F.concat(F.lit("AM"), "uf", F.right("ano", F.lit(2)), "mes")
    bad = {
        "AP_DTINIC": date_is_bad(F.col("AP_DTINIC"), "yyyyMMdd"),
        "AP_CONDIC": ~F.col("AP_CONDIC").isin(*fv.SIA_RECODE["AP_CONDIC"]),
    }
    return quarantine(outpatient(spark, sf_dir), bad, dataset)


@check(
    "quarantine_chain",
    f"select 'AM' || uf || substr(ano, 3, 2) || mes as dataset, 'AP_DTINIC' as coluna, \"AP_DTINIC\" as valor,"
    f" count(*) as ocorrencias from ({OUTPATIENT_SQL}) where \"AP_DTINIC\" = '20219999' group by 1, 2, 3",
)
def quarantine_chain(spark, sf_dir):
    dataset = F.concat(F.lit("AM"), "uf", F.right("ano", F.lit(2)), "mes")
    rows = outpatient(spark, sf_dir).withColumn("dataset", dataset)
    return chain_quarantine(rows, with_options(SPECS["SIA.AM"], dates=True))


_FILES_SQL = f"select distinct 'DO' || uf || ano as base from ({MORTALITY_SQL})"


def _files(spark, sf_dir):
    return mortality(spark, sf_dir).select(F.concat(F.lit("DO"), "uf", "ano").alias("dataset")).distinct()


@check(
    "file_metadata",
    "select base || '@bronze' as \"qualifiedName\", base || 'Teste' as name, 'Óbitos' as description,"
    f" 'equipe' as owner, base || '.parquet' as filename from ({_FILES_SQL})",
)
def metadata(spark, sf_dir):
    files = _files(spark, sf_dir).select(F.concat("dataset", F.lit(".parquet")).alias("filename"))
    return file_metadata(files, "filename", "Teste", "equipe", "Óbitos")


@check(
    "process_lineage",
    "select 'process.drop.vitaria@' || base as \"qualifiedName\", 'drop do arquivo ' || base as name, 'dados' as owner,"
    " 'Transformação de drop' as description, '' as added_columns, 'CAUSABAS_O, ORIGEM' as deleted_columns,"
    f" base as inputs, base as outputs from ({_FILES_SQL})",
)
def process(spark, sf_dir):
    rows = mortality(spark, sf_dir)
    after = ops.drop_columns(rows, fv.SIM_DROP)
    records = process_records(_files(spark, sf_dir), "drop", rows.columns, after.columns, "dados")
    return records.withColumns({c: F.array_join(c, ", ") for c in ("added_columns", "deleted_columns", "inputs", "outputs")})


@check(
    "chain_lineage",
    "select 'process.' || step || '.vitaria@' || base as \"qualifiedName\", step || ' do arquivo ' || base as name,"
    " 'dados' as owner, 'Transformação de ' || step as description, added as added_columns, deleted as deleted_columns"
    f" from ({_FILES_SQL}), (values ('drop', '', 'CAUSABAS_O, ORIGEM'), ('recode', '', ''), ('age', '', ''),"
    " ('rename', 'Idade, Causa Básica, Sexo, Raça/Cor, Data do Óbito', 'IDADE, CAUSABAS, SEXO, RACACOR, DTOBITO'))"
    " s(step, added, deleted)",
)
def lineage(spark, sf_dir):
    rows = mortality(spark, sf_dir).withColumn("dataset", F.concat(F.lit("DO"), "uf", "ano"))
    spec = SPECS["SIM.DO"]
    steps = tuple(step for step in spec.steps if step != "icd")
    records = chain_lineage(rows, replace(spec, steps=steps), "dados")
    return records.drop("inputs", "outputs").withColumns(
        {c: F.array_join(c, ", ") for c in ("added_columns", "deleted_columns")}
    )


@check(
    "lineage_edges",
    "select distinct 'dataset_process' as \"typeName\", base || '@bronze' as end1, 'process.drop.vitaria@' || base as end2"
    f" from ({_FILES_SQL})",
)
def edges(spark, sf_dir):
    pairs = _files(spark, sf_dir).select(
        F.concat("dataset", F.lit("@bronze")).alias("origem"),
        F.concat(F.lit("process.drop.vitaria@"), "dataset").alias("destino"),
    )
    return lineage_edges(pairs, "dataset_process")
