"""Plans: what is pushed, what is broadcast, what is not shuffled."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from checks import QUERIES
from checks.stand_ins import ICD_ITEMS
from vitaria.operators.codes import resolve_codes
from vitaria.operators.frequency import year_frequency
from vitaria.operators.joins import BroadcastBound, lookup_join
from vitaria.operators.years import filter_years
from vitaria.plans.chain import apply_chain
from vitaria.plans.specs import SPECS
from vitaria.sources import CodeDictionary, scan_bronze
from vitaria.sources.bronze import unite_drifted

SF_DIR = "/root/testdata/sf0.001"


def plan(df, mode="formatted"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


@pytest.fixture(scope="module")
def bronze(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("bronze"))
    rows = spark.range(200).select(
        F.concat((F.col("id") % 6).cast("string"), F.lit("05")).alias("IDADE"),
        F.lit("A01").alias("CAUSABAS"),
        F.lit("1").alias("SEXO"),
        F.lit("x").alias("ORIGEM"),
        F.concat(F.lit("2020010"), (F.col("id") % 9 + 1).cast("string")).alias("DT_INTER"),
    )
    for name in ("DOPE2020", "DOPI2020"):
        rows.coalesce(1).write.parquet(f"{base}/sim-parquet/{name}.parquet")
    return base


def mortality(spark, bronze, **options):
    return scan_bronze(spark, bronze, SPECS["SIM.DO"].layout, ["PE", "PI"], [2020], **options)


def test_chain_is_one_pass_without_shuffle_or_python(spark, bronze):
    text = plan(apply_chain(mortality(spark, bronze), SPECS["SIM.DO"], CodeDictionary.from_entries(spark, ICD_ITEMS)))
    assert "BroadcastHashJoin" in text
    assert text.count("Scan parquet") and "ORIGEM" not in "".join(l for l in text.splitlines() if "ReadSchema" in l)
    for word in ("hashpartitioning", "rangepartitioning", "SortMergeJoin", "Python", "CartesianProduct", "NestedLoop"):
        assert word not in text


def test_filter_on_coordinates_leaves_datasets_unread(spark, bronze):
    text = plan(mortality(spark, bronze).where("uf = 'PI' and ano = '2020'"))
    assert "DOPI2020" in text and "DOPE2020" not in text and "Union" not in text


@pytest.mark.parametrize(
    "kind, pushed",
    [("string", "StringStartsWith"), ("date", "GreaterThanOrEqual"), ("timestamp_ntz", "GreaterThanOrEqual"), ("int", "GreaterThanOrEqual")],
)
def test_year_filter_reaches_the_scan(spark, tmp_path, kind, pushed):
    text_day = F.concat(F.lit("2020-01-"), F.lpad((F.col("id") % 28 + 1).cast("string"), 2, "0"))
    day = F.replace(text_day, F.lit("-"), F.lit("")).cast(kind) if kind in ("string", "int") else text_day.cast(kind)
    spark.range(50).select(day.alias("DT_INTER"), F.lit("wide").alias("other")).write.parquet(str(tmp_path / "t"))
    kept = filter_years(spark.read.parquet(str(tmp_path / "t")), "DT_INTER", ["2020", "2021"])
    filters = [line for line in plan(kept).splitlines() if "PushedFilters" in line]
    assert pushed in filters[0]
    pruned = plan(kept.select("ano_inter"))
    assert "other" not in [line for line in pruned.splitlines() if "ReadSchema" in line][0]


def test_frequency_scans_once_and_counts_before_the_shuffle(spark, tmp_path):
    spark.range(10).select(F.lit("2020").alias("a"), F.lit("2021").alias("b"), F.lit("z").alias("c")).write.parquet(f"{tmp_path}/t")
    text = plan(year_frequency(spark.read.parquet(f"{tmp_path}/t"), "a", "b"))
    assert text.count("Scan parquet") == 2  # once in the tree, once in the details
    assert "partial_count" in text


def test_large_side_is_shuffled_and_hot_keys_spread(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(100).withColumn("k", F.col("id") % 5)
        side = spark.range(5).select(F.col("id").alias("k"), F.lit("v").alias("v"))
        cold = plan(lookup_join(rows, side, ["k"], BroadcastBound(rows=1)))
        hot = plan(lookup_join(rows, side, ["k"], BroadcastBound(rows=1), hot_rows=10), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Broadcast" not in cold and "hashpartitioning(k" in cold
    # what is broadcast is the list of hot keys; the side itself is shuffled with the parts
    assert hot.count("hashpartitioning(k") == 2 and "_part" in hot


def test_prefix_join_is_no_theta_join(spark):
    dictionary = CodeDictionary.from_frame(
        spark.createDataFrame([(i, e["code"], e["description"]) for i, e in enumerate(ICD_ITEMS)], "ord int, code string, description string"),
        BroadcastBound(0, 0),
    )
    df = spark.range(10).select(F.concat(F.lit("A01"), F.col("id").cast("string")).alias("c"))
    text = plan(resolve_codes(df, ["c"], dictionary, BroadcastBound(0, 0)))
    assert "NestedLoop" not in text and "Cartesian" not in text


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_leaves_the_jvm(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR), "simple")
    for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


def test_many_branches_stay_shallow(spark):
    parts = [spark.range(1).select(F.col("id").alias(f"c{i % 3}")) for i in range(300)]
    united = unite_drifted(parts)
    assert united.columns == ["c0", "c1", "c2"]
    # pairwise: the depth grows with the logarithm of the number of branches
    depth = max(line.find("Range") for line in plan(united, "simple").splitlines())
    assert 0 < depth < 60


def test_entry(spark):
    frame = driver.entry(spark)
    assert frame.count() == spark.read.parquet(f"{SF_DIR}/orders.parquet").count()
