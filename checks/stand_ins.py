"""The three record systems played by the driver's tables.

Each frame has the real column names, so the real rules run on it, and comes
with the SQL that builds the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import table

# An invented dictionary. A shorter code stands before a longer one and after
# it, one code occurs twice, one description repeats its code.
ICD = [
    ("A", "Doenças infecciosas"),
    ("A01", "Febre tifoide"),
    ("B12", "Hepatite, categoria"),
    ("B1", "Hepatites virais"),
    ("B125", "Hepatite, subcategoria"),
    ("C", "C"),
    ("C34", "Neoplasia dos brônquios"),
    ("A01", "Febres tifoide e paratifoide"),
    ("D50", "Anemia por deficiência de ferro"),
    ("D", "Doenças do sangue"),
    ("I21", "Infarto agudo do miocárdio"),
    ("I2", "Doenças isquêmicas"),
    ("J", "Doenças do aparelho respiratório"),
    ("J18", "Pneumonia"),
    ("R99", "R99"),
    ("R9", "Causas mal definidas"),
]
ICD_ITEMS = [{"code": code, "description": text} for code, text in ICD]


def _merged() -> list[tuple[int, str, str]]:
    first: dict[str, int] = {}
    last: dict[str, str] = {}
    for position, (code, text) in enumerate(ICD):
        first.setdefault(code, position)
        last[code] = text
    return [(first[code], code, last[code]) for code in first]


ICD_SQL = (
    "dic(ord, code, description) as (values "
    + ", ".join(f"({o}, '{c}', '{d}')" for o, c, d in _merged())
    + ")"
)


def resolve_sql(code: str) -> str:
    """The lookup rule as correlated subqueries."""
    exact = f"(select max(description) from dic where dic.code = {code} and dic.description <> {code})"
    prefix = f"(select arg_min(description, ord) from dic where starts_with({code}, dic.code))"
    return f"coalesce({exact}, {prefix}, {code})"


def sql_list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def pick(values: list[str], index) -> F.Column:
    """One of a few values by a row's own number."""
    return F.array(*[F.lit(v) for v in values])[index.cast("int")]


def day_text(moment) -> F.Column:
    """A day as yyyyMMdd."""
    return F.replace(moment.cast("date").cast("string"), F.lit("-"), F.lit(""))


STATES = ["SP", "RJ", "PE", "PI"]

# --- mortality from orders ---------------------------------------------------

MORTALITY_SQL = f"""select
  o_orderkey as chave,
  case when o_orderkey % 97 = 0 then null
       when o_orderkey % 50 = 0 then 'x' || lpad(cast(o_custkey % 100 as varchar), 2, '0')
       else cast(o_orderkey % 7 as varchar) || lpad(cast(o_custkey % 100 as varchar), 2, '0') end as "IDADE",
  case when o_orderkey % 101 = 0 then null
       else chr(cast(65 + o_custkey % 26 as integer)) || lpad(cast(o_orderkey % 100 as varchar), 2, '0')
            || case when o_orderkey % 3 = 0 then '' else cast(o_custkey % 10 as varchar) end end as "CAUSABAS",
  chr(cast(65 + o_orderkey % 26 as integer)) || '01' as "CAUSABAS_O",
  cast(o_orderkey % 4 as varchar) as "SEXO",
  case when o_custkey % 11 = 0 then null else cast(o_custkey % 7 as varchar) end as "RACACOR",
  strftime(o_orderdate, '%d%m%Y') as "DTOBITO",
  o_orderstatus as "ORIGEM",
  {sql_list(STATES)}[o_custkey % 4 + 1] as uf,
  strftime(o_orderdate, '%Y') as ano
from orders"""


def mortality(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    two = F.lpad((customer % 100).cast("string"), 2, "0")
    letter = F.chr(65 + customer % 26)
    return table(spark, sf_dir, "orders").withColumn("day", day_text(F.col("o_orderdate"))).select(
        key.alias("chave"),
        F.when(key % 97 == 0, None)
        .when(key % 50 == 0, F.concat(F.lit("x"), two))
        .otherwise(F.concat((key % 7).cast("string"), two))
        .alias("IDADE"),
        F.when(key % 101 == 0, None)
        .otherwise(
            F.concat(
                letter,
                F.lpad((key % 100).cast("string"), 2, "0"),
                F.when(key % 3 == 0, "").otherwise((customer % 10).cast("string")),
            )
        )
        .alias("CAUSABAS"),
        F.concat(F.chr(65 + key % 26), F.lit("01")).alias("CAUSABAS_O"),
        (key % 4).cast("string").alias("SEXO"),
        F.when(customer % 11 == 0, None).otherwise((customer % 7).cast("string")).alias("RACACOR"),
        F.concat(F.right("day", F.lit(2)), F.substring("day", 5, 2), F.left("day", F.lit(4))).alias("DTOBITO"),
        F.col("o_orderstatus").alias("ORIGEM"),
        pick(STATES, customer % 4).alias("uf"),
        F.left("day", F.lit(4)).alias("ano"),
    )


# --- outpatient from lineitem ------------------------------------------------

OUTPATIENT_SQL = f"""select
  l_orderkey as chave,
  l_linenumber as linha,
  case l_returnflag when 'A' then 'EP' when 'N' then 'PG' else l_returnflag end as "AP_CONDIC",
  case when l_linenumber = 7 then null when l_linestatus = 'F' then 'F' else 'M' end as "AP_SEXO",
  lpad(cast(l_partkey % 6 as varchar), 2, '0') as "AP_RACACOR",
  cast(l_suppkey % 2 as varchar) as "AP_OBITO",
  l_suppkey % 2 as "AP_ALTA",
  cast(l_suppkey % 2 as varchar) as "AP_MNDIF",
  strftime(l_shipdate, '%Y%m') as "AP_CMP",
  strftime(l_shipdate, '%Y%m') as "AP_MVM",
  case when l_linenumber = 6 then '20219999' else strftime(l_shipdate, '%Y%m%d') end as "AP_DTINIC",
  {sql_list(STATES)}[l_suppkey % 2 + 1] as uf,
  strftime(l_shipdate, '%Y') as ano,
  strftime(l_shipdate, '%m') as mes
from lineitem"""


def outpatient(spark: SparkSession, sf_dir: str) -> DataFrame:
    parity = F.col("l_suppkey") % 2
    return table(spark, sf_dir, "lineitem").withColumn("day", day_text(F.col("l_shipdate"))).select(
        F.col("l_orderkey").alias("chave"),
        F.col("l_linenumber").alias("linha"),
        F.when(F.col("l_returnflag") == "A", "EP")
        .when(F.col("l_returnflag") == "N", "PG")
        .otherwise(F.col("l_returnflag"))
        .alias("AP_CONDIC"),
        F.when(F.col("l_linenumber") == 7, None)
        .when(F.col("l_linestatus") == "F", "F")
        .otherwise("M")
        .alias("AP_SEXO"),
        F.lpad((F.col("l_partkey") % 6).cast("string"), 2, "0").alias("AP_RACACOR"),
        parity.cast("string").alias("AP_OBITO"),
        parity.alias("AP_ALTA"),
        parity.cast("string").alias("AP_MNDIF"),
        F.left("day", F.lit(6)).alias("AP_CMP"),
        F.left("day", F.lit(6)).alias("AP_MVM"),
        F.when(F.col("l_linenumber") == 6, "20219999").otherwise(F.col("day")).alias("AP_DTINIC"),
        pick(STATES, parity).alias("uf"),
        F.left("day", F.lit(4)).alias("ano"),
        F.substring("day", 5, 2).alias("mes"),
    )


# --- admissions from orders --------------------------------------------------

ADMISSIONS_SQL = """select
  cast(o_orderkey as varchar) as "N_AIH",
  cast(o_custkey as varchar) as "CGC_HOSP",
  cast(o_custkey % 50 as varchar) as "CNPJ_MANT",
  case when o_orderkey % 41 = 0 then null else strftime(o_orderdate, '%Y%m%d') end as "DT_INTER",
  strftime(o_orderdate + interval 200 day, '%Y%m%d') as "DT_SAIDA",
  strftime(o_orderdate - interval 9000 day, '%Y%m%d') as "NASC",
  cast(o_custkey % 3 as varchar) as "SEXO",
  o_totalprice as "VAL_SADT",
  strftime(o_orderdate, '%Y') as "ANO_CMPT"
from orders"""


def admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    def day(offset: int) -> F.Column:
        return day_text(F.date_add("o_orderdate", offset))

    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("N_AIH"),
        F.col("o_custkey").cast("string").alias("CGC_HOSP"),
        (F.col("o_custkey") % 50).cast("string").alias("CNPJ_MANT"),
        F.when(F.col("o_orderkey") % 41 == 0, None).otherwise(day(0)).alias("DT_INTER"),
        day(200).alias("DT_SAIDA"),
        day(-9000).alias("NASC"),
        (F.col("o_custkey") % 3).cast("string").alias("SEXO"),
        F.col("o_totalprice").alias("VAL_SADT"),
        F.left(day(0), F.lit(4)).alias("ANO_CMPT"),
    )


AGE_SQL = """case
  when try_cast(substr({c}, 1, 1) as integer) is null or try_cast(substr({c}, 2) as bigint) is null then null
  when substr({c}, 1, 1) = '0' and cast(substr({c}, 2) as bigint) = 0 then 'Idade não relatada'
  when substr({c}, 1, 1) = '0' then cast(cast(substr({c}, 2) as bigint) as varchar) || ' minutos'
  when substr({c}, 1, 1) = '1' then cast(cast(substr({c}, 2) as bigint) as varchar) || ' horas'
  when substr({c}, 1, 1) = '2' then cast(cast(substr({c}, 2) as bigint) as varchar) || ' dias'
  when substr({c}, 1, 1) = '3' then cast(cast(substr({c}, 2) as bigint) as varchar) || ' meses'
  when substr({c}, 1, 1) = '4' and cast(substr({c}, 2) as bigint) = 0
    then 'Menor de 1 ano, mas não se sabe o número de horas, dias ou meses'
  when substr({c}, 1, 1) = '4' then cast(cast(substr({c}, 2) as bigint) as varchar) || ' anos'
  when substr({c}, 1, 1) = '5' then cast(100 + cast(substr({c}, 2) as bigint) as varchar) || ' anos'
  else 'Código inválido' end"""
