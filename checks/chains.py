"""Whole chains, step order included."""

from __future__ import annotations

import json
from dataclasses import replace

from pyspark.sql import functions as F

from checks.registry import check, sql_case, table
from checks.stand_ins import (
    ADMISSIONS_SQL, AGE_SQL, ICD_ITEMS, ICD_SQL, MORTALITY_SQL, OUTPATIENT_SQL,
    admissions, day_text, mortality, outpatient, resolve_sql,
)
from checks.storage import bronze_of
from vitaria import fixed_values as fv
from vitaria.plans.chain import apply_chain, run_table, with_options
from vitaria.plans.specs import SPECS
from vitaria.rules import load_rules
from vitaria.sinks.shared import new_folder
from vitaria.sinks.tables import listed_as_text
from vitaria.sources import CodeDictionary, read_silver
from vitaria.streaming.daily import refresh_new_datasets

_MORTALITY_COLUMNS = f"""{AGE_SQL.format(c='m.IDADE')} as "Idade", {resolve_sql('m.CAUSABAS')} as "Causa Básica",
  {sql_case('SEXO', fv.SIM_RECODE['SEXO'], 'Sexo')}, {sql_case('RACACOR', fv.SIM_RECODE['RACACOR'], 'Raça/Cor')},
  "DTOBITO" as "Data do Óbito" """


@check(
    "chain_mortality",
    f"with {ICD_SQL} select chave, uf, ano, {_MORTALITY_COLUMNS} from ({MORTALITY_SQL}) m",
)
def chain_mortality(spark, sf_dir):
    return apply_chain(mortality(spark, sf_dir), SPECS["SIM.DO"], CodeDictionary.from_entries(spark, ICD_ITEMS))


@check(
    "chain_mortality_with_category",
    f"with {ICD_SQL} select chave, uf, ano, {_MORTALITY_COLUMNS}, \"CAUSABAS\" as \"Categoria CID\" from ({MORTALITY_SQL}) m",
)
def chain_mortality_keep(spark, sf_dir):
    spec = with_options(SPECS["SIM.DO"], keep=True)
    return apply_chain(mortality(spark, sf_dir), spec, CodeDictionary.from_entries(spark, ICD_ITEMS))


_OUTPATIENT_COLUMNS = f"""chave, linha, {sql_case('AP_CONDIC', fv.SIA_RECODE['AP_CONDIC'], 'Condicao de pagamento')},
  {sql_case('AP_SEXO', fv.SIA_RECODE['AP_SEXO'], 'Sexo')}, {sql_case('AP_RACACOR', fv.SIA_RECODE['AP_RACACOR'], 'Raça/Cor')},
  {sql_case('AP_OBITO', fv.SIA_RECODE['AP_OBITO'], 'Obito')}, "AP_ALTA", "AP_CMP" as "Data de atendimento", "AP_DTINIC",
  uf, ano, mes"""


@check("chain_outpatient", f"select {_OUTPATIENT_COLUMNS} from ({OUTPATIENT_SQL})")
def chain_outpatient(spark, sf_dir):
    return apply_chain(outpatient(spark, sf_dir), SPECS["SIA.AM"])


_ADMISSIONS_COLUMNS = """"N_AIH" as "Número da AIH", "CGC_HOSP" as "CNPJ do Hospital", "CNPJ_MANT" as "CNPJ do Hospital_2",
  "DT_INTER" as "Data de Inicio", "DT_SAIDA" as "Data de Fim", "NASC" as "Data de Nascimento", "SEXO" as "Sexo",
  substr("DT_INTER", 1, 4) as ano_inter"""


@check(
    "chain_admissions",
    f"select {_ADMISSIONS_COLUMNS} from ({ADMISSIONS_SQL}) where substr(\"DT_INTER\", 1, 4) in ('1999', '2000')",
)
def chain_admissions(spark, sf_dir):
    # the table's own years are 2020 and 2021; the data here is older
    spec = SPECS["SIH.RD"]
    spec = replace(spec, rules=replace(spec.rules, years=["1999", "2000"]))
    return apply_chain(admissions(spark, sf_dir), spec)


@check(
    "run_mortality",
    f"with {ICD_SQL} select chave, uf, ano, 'DO' || uf || ano as dataset, case when uf in ('SP', 'RJ') then 'SUDESTE'"
    f" else 'NORDESTE' end as regiao, {_MORTALITY_COLUMNS} from ({MORTALITY_SQL}) m where uf in ('PE', 'PI')",
)
def run_mortality(spark, sf_dir):
    base = bronze_of(mortality(spark, sf_dir), "sim-parquet", "DO")
    silver = new_folder(spark, "silver")
    dictionary = CodeDictionary.from_entries(spark, ICD_ITEMS)
    run_table(spark, SPECS["SIM.DO"], base, silver, ["PE", "PI"], range(1990, 2010), dictionary=dictionary)
    return read_silver(spark, silver, "SIM", "DO")


@check(
    "run_outpatient_audit",
    f"select 'AM' || uf || substr(ano, 3, 2) || mes || '.parquet' as \"Arquivo\", count(*) as registros_antes, count(*) as registros_depois,"
    " cast(0 as bigint) as registros_perdidos, 'AP_CONDIC, AP_SEXO, AP_RACACOR, AP_OBITO, AP_MNDIF, AP_CMP, AP_MVM' as colunas_removidas,"
    " 'Condicao de pagamento, Sexo, Raça/Cor, Obito, Data de atendimento' as colunas_adicionadas"
    f" from ({OUTPATIENT_SQL}) where uf = 'SP' group by uf, ano, mes",
)
def run_outpatient(spark, sf_dir):
    base = bronze_of(outpatient(spark, sf_dir), "sia-parquet/AM", "AM")
    outcome = run_table(spark, SPECS["SIA.AM"], base, new_folder(spark, "silver"), ["SP"], range(1990, 2010))
    return listed_as_text(outcome.changes)


_RUN_ADMISSIONS = f"""select *, ['SP', 'RJ'][cast("CGC_HOSP" as bigint) % 2 + 1] as uf, "ANO_CMPT" as ano,
  substr("NASC", 5, 2) as mes from ({ADMISSIONS_SQL})"""


@check(
    "run_admissions",
    f"select {_ADMISSIONS_COLUMNS}, uf, ano, mes, 'SUDESTE' as regiao, 'RD' || uf || substr(ano, 3, 2) || mes as dataset"
    f" from ({_RUN_ADMISSIONS}) where substr(\"DT_INTER\", 1, 4) in ('1999', '2000') and uf = 'RJ' and mes <= '06'",
)
def run_admissions(spark, sf_dir):
    rows = admissions(spark, sf_dir).withColumns(
        {
            "uf": F.when(F.col("CGC_HOSP").cast("long") % 2 == 0, "SP").otherwise("RJ"),
            "ano": F.col("ANO_CMPT"),
            "mes": F.substring("NASC", 5, 2),
        }
    )
    base = bronze_of(rows, "sih-parquet/RD", "RD")
    silver = new_folder(spark, "silver")
    spec = SPECS["SIH.RD"]
    spec = replace(spec, rules=replace(spec.rules, years=["1999", "2000"]))
    run_table(spark, spec, base, silver, ["RJ"], range(1999, 2003), range(1, 7))
    return read_silver(spark, silver, "SIH", "RD")


@check(
    "daily_mortality",
    f"with {ICD_SQL} select chave, uf, ano, {_MORTALITY_COLUMNS} from ({MORTALITY_SQL}) m",
)
def daily_mortality(spark, sf_dir):
    # two scheduled runs: the second sees only what came in between
    rows = mortality(spark, sf_dir)
    bronze, silver, state = (new_folder(spark, name) for name in ("bronze", "silver", "state"))
    schema = rows.drop("uf", "ano").schema
    dictionary = CodeDictionary.from_entries(spark, ICD_ITEMS)
    for part in (rows.where("ano < '1998'"), rows.where("ano >= '1998'")):
        bronze_of(part, "sim-parquet", "DO", base=bronze, mode="append")
        refresh_new_datasets(spark, SPECS["SIM.DO"], bronze, silver, state, schema, dictionary)
    return read_silver(spark, silver, "SIM", "DO").drop("dataset", "regiao")


@check(
    "rule_files",
    "select o_orderkey as \"Pedido\", case o_orderstatus when 'F' then 'Fechado' else o_orderstatus end as \"Fase\","
    " cast(cast(o_orderdate as date) as varchar) as dia from orders",
)
def rule_files(spark, sf_dir):
    # the rules come from files, the table from the data
    files = {
        "drop": ["o_custkey", "o_totalprice", "o_orderpriority", "o_orderdate"],
        "recode": {"o_orderstatus": {"F": "Fechado"}},
        "rename": {"o_orderkey": "Pedido", "o_orderstatus": "Fase"},
        "dates": ["dia"],
    }
    paths = {name: new_folder(spark, f"rules-{name}") for name in files}
    for name, content in files.items():
        spark.createDataFrame([(json.dumps(content),)], "value string").write.text(paths[name])
    spec = replace(SPECS["SIA.AM"], rules=load_rules(spark, **paths), steps=("drop", "recode", "dates", "rename"))
    orders = table(spark, sf_dir, "orders").withColumn("dia", day_text(F.col("o_orderdate")))
    return apply_chain(orders, spec).withColumn("dia", F.col("dia").cast("string"))
