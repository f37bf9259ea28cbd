"""Random rules and dictionaries against plain Python."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vitaria.functions import decode_age
from vitaria.operators import columns as ops
from vitaria.operators.codes import resolve_codes
from vitaria.operators.years import filter_years
from vitaria.sources import CodeDictionary

from tests.test_units import expected_text

few = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
texts = st.text("AB1é", max_size=4)


@few
@given(st.lists(st.one_of(st.none(), texts), min_size=1, max_size=30), st.dictionaries(texts, texts, max_size=6))
def test_recode(spark, items, labels):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], "i int, c string")
    found = [r.c for r in ops.recode_columns(df, {"c": labels}).orderBy("i").collect()]
    assert found == [labels.get(v, v) for v in items]


@few
@given(st.lists(st.one_of(st.none(), texts), min_size=1, max_size=30), st.lists(st.tuples(texts, texts), max_size=12))
def test_resolve(spark, items, entries):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], "i int, c string")
    dictionary = CodeDictionary.from_entries(spark, [{"code": k, "description": d} for k, d in entries])
    found = [r.c for r in resolve_codes(df, ["c"], dictionary).orderBy("i").collect()]
    assert found == [expected_text(v, entries) for v in items]


@few
@given(st.lists(st.text("0123456789x", max_size=4), min_size=1, max_size=40))
def test_age_never_fails(spark, items):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], "i int, c string")
    found = [r.c for r in df.select("i", decode_age(F.col("c")).alias("c")).orderBy("i").collect()]
    assert [v is None for v in found] == [not (v[:1].isdigit() and v[1:].isdigit()) for v in items]


@few
@given(st.lists(st.sampled_from(["a", "b", "c", "d"]), max_size=4), st.integers(1, 40))
def test_drop_and_rename_keep_rows(spark, names, rows):
    df = spark.range(rows).select(*[F.col("id").alias(c) for c in "abcd"])
    assert ops.drop_columns(df, names).withColumn("n", F.lit(1)).count() == rows
    assert ops.rename_columns(df, {c: c + "x" for c in names}).count() == rows


@few
@given(st.lists(st.one_of(st.none(), st.text("0129-", max_size=6)), min_size=1, max_size=30))
def test_year_filter_is_subset(spark, items):
    df = spark.createDataFrame([(v,) for v in items], "c string")
    found = sorted(r.c for r in filter_years(df, "c", ["2012", "2020"]).collect())
    assert found == sorted(v for v in items if v is not None and v[:4] in ("2012", "2020"))
