"""Small cases for every operator, edge rows included."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from vitaria import fixed_values as fv
from vitaria import rules
from vitaria.functions import decode_age, lookup_or, parse_dataset, region_of, year_text
from vitaria.operators import columns as ops
from vitaria.operators.codes import exact_lookup, resolve_codes
from vitaria.operators.frequency import stack_columns, value_counts
from vitaria.operators import joins
from vitaria.operators.joins import BroadcastBound, fits, hot_keys, lookup_join
from vitaria.operators.lineage import file_metadata, process_records
from vitaria.operators.quality import audit, audit_datasets, audit_diff, missing_columns, quarantine
from vitaria.operators.years import filter_years, year_predicate
from vitaria.sources import (
    CodeDictionary, dataset_files, dataset_glob, delta_available, list_datasets, partition_grid, read_delta,
    read_mixed, read_records, region_states,
)
from vitaria.plans.specs import SPECS
from vitaria.sources.bronze import BronzeLayout, scan_bronze


def values(df):
    return [row[0] for row in df.collect()]


def frame(spark, *items, name="c", kind="string"):
    return spark.createDataFrame([(item,) for item in items], f"`{name}` {kind}")


# --- rules -------------------------------------------------------------------


def test_drop_list_shapes():
    entries = [{"id": 0, "to_drop": ["a"]}, {"id": 1, "to_drop": ["b", "a"]}, {"id": 0, "to_drop": ["c"]}]
    assert rules.drop_list(["a", "b", "a"]) == ["a", "b"]
    assert rules.drop_list(entries, "first") == ["a"]
    assert rules.drop_list(entries, "all") == ["c", "b", "a"]


def test_recode_table_shapes():
    assert rules.recode_table({"x": {"1": "a"}}) == {"x": {"1": "a"}}
    short = [{"column_name": "x", "to_replace": ["1", "2"], "value": ["a"]}]
    assert rules.recode_table(short) == {"x": {"1": "a"}}
    with pytest.raises(ValueError):
        rules.recode_table(short, strict=True)


def test_recode_rules_for_one_column_follow_each_other():
    listed = [
        {"column_name": "x", "to_replace": ["1", "2"], "value": ["2", "z"]},
        {"column_name": "x", "to_replace": ["2", "3"], "value": ["y", "w"]},
    ]
    assert rules.recode_table(listed) == {"x": {"1": "y", "2": "z", "3": "w"}}


def test_rule_files_are_read(spark, tmp_path):
    path = tmp_path / "rules.json"
    path.write_text(json.dumps({"IDADE": "Idade", "SEXO": "Sexo/Gênero"}), encoding="utf-8")
    assert rules.read_json(spark, str(path)) == {"IDADE": "Idade", "SEXO": "Sexo/Gênero"}


def test_dictionary_keeps_first_place_and_last_text():
    items = [{"code": c, "description": d} for c, d in [("A", "1"), ("B", "2"), ("A", "3")]]
    assert rules.dictionary_entries(items) == [(0, "A", "3"), (1, "B", "2")]


# --- columns -----------------------------------------------------------------


def test_drop_ignores_absent_and_compares_exactly(spark):
    df = spark.createDataFrame([(1, 2, 3)], "A int, b int, `c.d` int")
    assert ops.drop_columns(df, ["a", "b", "zz", "c.d"]).columns == ["A"]


def test_rename_is_simultaneous(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    swapped = ops.rename_columns(df, {"a": "b", "b": "a", "no": "x"})
    assert swapped.columns == ["b", "a"] and tuple(swapped.first()) == (1, 2)


def test_rename_collision(spark):
    df = spark.createDataFrame([(1, 2, 3)], "CGC_HOSP int, CNPJ_MANT int, SEXO int")
    with pytest.raises(ops.RenameCollision, match="CGC_HOSP"):
        ops.rename_columns(df, fv.SIH_RENAME)
    assert ops.rename_columns(df, fv.SIH_RENAME, "suffix").columns == ["CNPJ do Hospital", "CNPJ do Hospital_2", "Sexo"]
    assert ops.rename_columns(df, fv.SIH_RENAME, "keep").columns == df.columns


def test_rename_collision_by_case_and_taken_suffix(spark):
    df = spark.createDataFrame([(1, 2, 3)], "x int, y int, `idade_2` int")
    assert ops.rename_columns(df, {"x": "Idade", "y": "IDADE"}, "suffix").columns == ["Idade", "IDADE_3", "idade_2"]


@pytest.mark.parametrize("labels", [{"1": "a", "2": "b"}, {"1": "a", "2": "b", **{f"k{i}": "x" for i in range(50)}}])
def test_recode_passes_null_and_unknown_through(spark, labels):
    df = frame(spark, "1", "2", None, "7", "")
    assert sorted(map(str, values(ops.recode_columns(df, {"c": labels, "absent": labels})))) == sorted(
        map(str, ["a", "b", None, "7", ""])
    )


def test_recode_does_not_chain_and_skips_numbers(spark):
    df = frame(spark, "1", "2")
    assert values(ops.recode_columns(df, {"c": {"1": "2", "2": "z"}})) == ["2", "z"]
    numbers = frame(spark, 1, 2, kind="int")
    assert values(ops.recode_columns(numbers, {"c": {"1": "a"}})) == [1, 2]


def test_recode_leading_zero_matters(spark):
    df = frame(spark, "01", "1", "99")
    assert values(ops.recode_columns(df, {"c": fv.SIA_RECODE["AP_RACACOR"]})) == ["Branca", "1", "Ignorado"]


def test_null_label(spark):
    df = frame(spark, "1", "2")
    assert values(ops.recode_columns(df, {"c": {"1": None, "2": "b"}})) == ["1", "b"]
    assert values(ops.recode_columns(df, {"c": {"1": None, "2": "b"}}, blank_null_labels=True)) == [None, "b"]
    long = {"1": None, "2": "b", **{f"k{i}": "x" for i in range(50)}}
    assert values(ops.recode_columns(df, {"c": long}, blank_null_labels=True)) == [None, "b"]


def test_lookup_or(spark):
    df = frame(spark, "1", "5", None)
    assert values(df.select(lookup_or(F.col("c"), ["1"], ["um"], F.lit("?")))) == ["um", "?", "?"]


# --- age ---------------------------------------------------------------------

AGES = {
    "000": "Idade não relatada", "005": "5 minutos", "101": "1 horas", "203": "3 dias", "311": "11 meses",
    "400": fv.AGE_UNDER_ONE, "402": "2 anos", "499": "99 anos", "500": "100 anos", "503": "103 anos",
    "999": "Código inválido", "600": "Código inválido", "9A1": None, "4": None, "": None, "x12": None,
    "4 2": "2 anos", "4.5": None, "50": "100 anos", None: None, "4" + "9" * 30: None,
}


def test_decode_age(spark):
    df = frame(spark, *AGES)
    assert values(df.select(decode_age(F.col("c")))) == list(AGES.values())


def test_age_of_other_type_is_left(spark):
    assert values(ops.decode_ages(frame(spark, 402, kind="int"), ["c", "absent"])) == [402]


# --- dates and years ---------------------------------------------------------


def test_dates(spark):
    df = frame(spark, "20210131", "20219999", None, "junk")
    assert values(ops.enforce_dates(df, {"c": "yyyyMMdd"})) == [date(2021, 1, 31), None, None, None]
    stamps = frame(spark, datetime(2021, 1, 31, 5), kind="timestamp")
    assert values(ops.enforce_dates(stamps, {"c": "yyyyMMdd"})) == [date(2021, 1, 31)]


@pytest.mark.parametrize(
    "kind, items",
    [
        ("string", ["20200131", "2021-05-01", "20191231", "2022", None, "", "202"]),
        ("date", [date(2020, 1, 1), date(2021, 12, 31), date(2019, 12, 31), date(2022, 1, 1), None]),
        ("timestamp", [datetime(2020, 1, 1), datetime(2021, 12, 31, 23, 59, 59), datetime(2022, 1, 1), None]),
        ("timestamp_ntz", [datetime(2020, 1, 1), datetime(2021, 12, 31, 23, 59, 59), datetime(2022, 1, 1), None]),
        ("int", [20200131, 2021, 202112, 20191231, 20220101, 202, None, -20200101, 2147483647]),
        ("long", [20200131, 2021, 20211231235959, 2019, 2**63 - 1, None]),
        ("double", [20200131.0, 2021.0, 20191231.0, None]),
    ],
)
def test_year_predicate_equals_text_rule(spark, kind, items):
    df = frame(spark, *items, kind=kind)
    by_text = df.where(year_text(F.col("c"), df.schema["c"].dataType).isin("2020", "2021"))
    by_range = df.where(year_predicate(df, "c", ["2020", 2021]))
    assert values(by_range) == values(by_text) and values(by_range)


def test_filter_years_keeps_year(spark):
    kept = filter_years(frame(spark, "20200131", "20190131", name="DT_INTER"), "DT_INTER", ["2020"])
    assert [tuple(row) for row in kept.collect()] == [("20200131", "2020")] and kept.columns[-1] == "ano_inter"
    with pytest.raises(ValueError):
        filter_years(kept, "DT_INTER", ["20"])


def test_frequency(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None), ("c", "a")], "x string, y string")
    assert [tuple(r) for r in value_counts(stack_columns(df, "x", "y"), "valor").collect()] == [("a", 3), ("b", 1), ("c", 1)]


# --- names -------------------------------------------------------------------

NAMES = {
    "PASP2101a.parquet": ("PA", "SP", "2021", "01", "a"),
    "/b/PAMPB2101.parquet/part-0.parquet": ("PAM", "PB", "2021", "01", ""),
    "SPSP2201.parquet": ("SP", "SP", "2022", "01", ""),
    "IMPBOPB2112.delta": ("IMPBO", "PB", "2021", "12", ""),
    "AMAM9912": ("AM", "AM", "1999", "12", ""),
    "x/dataset=DOPE2020.parquet/p.parquet": ("DO", "PE", "2020", None, ""),
    "DORJ1998.parquet": ("DO", "RJ", "1998", None, ""),
    "verificacao_inicial.csv": (None,) * 5,
    None: (None,) * 5,
}


def test_parse_dataset(spark):
    df = frame(spark, *NAMES).select(*[c.alias(n) for n, c in parse_dataset(F.col("c")).items()])
    assert [tuple(row) for row in df.collect()] == list(NAMES.values())


def test_regions(spark):
    assert region_states(spark).count() == 27 and region_states(spark, ["SUL"]).count() == 3
    assert values(frame(spark, "PB", "SP", "XX", None).select(region_of(F.col("c")))) == ["NORDESTE", "SUDESTE", None, None]


def test_grid(spark):
    grid = partition_grid(spark, ["SP", "RJ"], [2020, 2021])
    assert grid.count() == 48 and grid.where("mes = '01'").count() == 4
    assert partition_grid(spark, ["SP"], [2020], None).columns == ["uf", "ano"]


# --- codes -------------------------------------------------------------------


def expected_text(code, entries):
    """What a code becomes, stated on the list of entries.

    Of entries that repeat a code the last text holds, at the place of the first.
    Those whose code begins the given one are candidates. The one equal to it
    decides unless its text only repeats the code; then the foremost does.
    """
    candidates = [(place, key) for place, (key, _) in enumerate(entries) if code is not None and code[: len(key)] == key]
    if not candidates:
        return code
    final = dict(entries)
    if code in final and final[code] != code:
        return final[code]
    return final[min(candidates)[1]]


ENTRIES = [("A", "letra A"), ("A01", "exato"), ("B12", "longo"), ("B1", "curto"), ("C", "C"), ("C3", "c três"), ("A01", "último"), ("R9", "r"), ("R99", "R99")]
CODES = ["A01", "A02", "A0", "B123", "B19", "C34", "C", "R99", "R991", "Z", "", None, "a01", "B12"]


def test_resolve_codes_both_ways(spark):
    items = [{"code": c, "description": d} for c, d in ENTRIES]
    expected = [expected_text(code, ENTRIES) for code in CODES]
    small = CodeDictionary.from_entries(spark, items)
    df = spark.createDataFrame([(i, c, c) for i, c in enumerate(CODES)], "i int, CAUSABAS string, CAUSABAS_O string")
    found = resolve_codes(df, fv.SIM_ICD_COLUMNS, small).orderBy("i").collect()
    assert [row.CAUSABAS for row in found] == expected == [row.CAUSABAS_O for row in found]
    none = BroadcastBound(0, 0)
    ordered = spark.createDataFrame([(i, c, d) for i, (c, d) in enumerate(ENTRIES)], "ord int, code string, description string")
    large = CodeDictionary.from_frame(ordered, none)
    assert not large.small
    found = resolve_codes(df, fv.SIM_ICD_COLUMNS, large, none).orderBy("i").collect()
    assert [row.CAUSABAS for row in found] == expected == [row.CAUSABAS_O for row in found]


def test_exact_lookup_and_empty_dictionary(spark):
    items = [{"code": "A", "description": "letra"}]
    df = frame(spark, "A", "A1", None)
    assert values(exact_lookup(df, ["c", "absent"], CodeDictionary.from_entries(spark, items))) == ["letra", "A1", None]
    assert values(resolve_codes(df, ["c"], CodeDictionary.from_entries(spark, []))) == ["A", "A1", None]


def test_dictionary_file(spark, tmp_path):
    path = tmp_path / "cid.json"
    path.write_text(json.dumps([{"code": c, "description": d} for c, d in ENTRIES], ensure_ascii=False), encoding="utf-8")
    dictionary = CodeDictionary.from_json(spark, str(path))
    assert dictionary.small and dictionary.lengths == (1, 2, 3)
    assert values(resolve_codes(frame(spark, "A01", "B123"), ["c"], dictionary)) == ["último", "longo"]


@pytest.mark.parametrize("hot_rows", [1, 50, 10_000])
def test_spread_join_equals_broadcast(spark, hot_rows):
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id"))
    rows = spark.range(0, 1000, 1, 8).select("id", key.alias("k"))
    side = spark.range(500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    spread = lookup_join(rows, side, ["k"], BroadcastBound(10, 10), hot_rows=hot_rows)
    plain = lookup_join(rows, side, ["k"])
    assert spread.columns == plain.columns
    assert sorted(map(str, spread.collect())) == sorted(map(str, plain.collect()))


def task_sizes(spark, rows, side, keys, hot_rows):
    """Joined rows per task, with neither coalescing nor broadcasts in the way."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookup_join(rows, side, keys, small=False, hot_rows=hot_rows)
        sizes = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        return sizes, joined.where("v = 1").count(), joined.where("v is null").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("layout", ["one partition", "strided", "even"])
def test_hot_rows_are_spread(spark, layout):
    rows = spark.range(0, 8000, 1, 1 if layout == "one partition" else 16)
    rows = rows.select("id", F.lit("A").alias("k"), F.when(F.col("id") < 4000, "B").alias("j"))
    if layout == "strided":  # the hot rows lie in two of sixteen partitions
        rows = rows.where(F.spark_partition_id() % 8 == 0)
    total = rows.count()
    side = spark.createDataFrame([("A", "B", 1)], "k string, j string, v int")
    sizes, found, without = task_sizes(spark, rows, side, ["k", "j"], 250)
    assert sum(sizes) == total == found + without and found == rows.where("j = 'B'").count()
    assert max(sizes) < total / 3


def test_many_hot_keys_are_all_spread(spark):
    rows = spark.range(0, 60_000, 1, 4).select("id", (F.col("id") % 1500).alias("k"))
    hot = hot_keys(rows, [["k"]], 10)
    assert hot.count() == 1500 and {r["_parts"] for r in hot.collect()} == {4}
    side = spark.range(1500).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    sizes, found, _ = task_sizes(spark, rows, side, ["k"], 10)
    assert found == 60_000 and max(sizes) < 2 * 60_000 / 8


def test_list_of_hot_keys_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(joins, "HOT_LIST", 10)
    rows = spark.range(1000).select(F.when(F.col("id") < 500, F.lit(-1)).otherwise(F.col("id") % 100).alias("k"))
    # a hundred keys have five rows each; the least number of a hot key rises to a tenth of all
    assert [r["_hot0"] for r in hot_keys(rows, [["k"]], 2).collect()] == [-1]


def test_hot_keys_of_two_joins_in_one_pass(spark):
    rows = spark.range(100).select(F.lit("x").alias("a"), F.when(F.col("id") < 60, "y").alias("b"))
    found = {(r["_of"], r["_hot0"]): r["_parts"] for r in hot_keys(rows, [["a"], ["b"]], 30).collect()}
    assert found == {(0, "x"): 4, (1, "y"): 2, (1, None): 2}


def test_measuring_a_side(spark):
    side = spark.range(500).select("id", F.lit("text").alias("v"))
    assert fits(side) and not fits(side, BroadcastBound(499)) and not fits(side, BroadcastBound(size=100))


# --- quality and catalog -----------------------------------------------------


def test_audit_of_datasets(spark, tmp_path):
    spark.range(5).withColumn("x", F.lit("1")).write.parquet(str(tmp_path / "a b" / "DOSP2020.parquet"))
    spark.range(3).write.parquet(str(tmp_path / "a b" / "DORJ2020.parquet"))
    spark.range(0).write.parquet(str(tmp_path / "a b" / "DOES2020.parquet"))
    report = audit_datasets(spark, str(tmp_path / "a b"), "inicial")
    assert report.columns == [fv.AUDIT_FILE, fv.AUDIT_ROWS, fv.AUDIT_COLUMNS, "etapa"]
    assert sorted(tuple(r)[:3] for r in report.collect()) == [
        ("DOES2020.parquet", 0, ["id"]), ("DORJ2020.parquet", 3, ["id"]), ("DOSP2020.parquet", 5, ["id", "x"]),
    ]
    assert [tuple(r) for r in missing_columns(report, ["x"]).orderBy(fv.AUDIT_FILE).collect()] == [
        ("DOES2020.parquet", "x"), ("DORJ2020.parquet", "x"),
    ]


def test_audit_diff(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "d string, x int")
    before = audit(df, F.col("d"))
    after = audit(df.where("x > 1").where("d = 'a'").withColumn("y", F.lit(1)).drop("x"), F.col("d"))
    found = {r[0]: tuple(r)[1:] for r in audit_diff(before, after).collect()}
    assert found == {"a": (2, 1, 1, ["x"], ["y"]), "b": (1, None, 1, ["d", "x"], [])}


def test_quarantine_counts_each_column(spark):
    df = spark.createDataFrame([("a", "1", "x"), ("a", "x", "x"), ("b", "x", "2"), ("b", None, "2")], "d string, p string, q string")
    bad = {"p": F.col("p") == "x", "q": F.col("q") == "x", "absent": F.col("d") == "a"}
    found = sorted(tuple(r) for r in quarantine(df, bad, F.col("d")).collect())
    assert found == [("a", "p", "x", 1), ("a", "q", "x", 2), ("b", "p", "x", 1)]


def test_catalog_records(spark):
    files = frame(spark, "DOSP2020.parquet", "DOSP2020.parquet", name="filename")
    assert [tuple(r) for r in file_metadata(files).collect()] == [
        ("DOSP2020@bronze", "DOSP2020", "", "", "DOSP2020.parquet")
    ]
    record = process_records(frame(spark, "DOSP2020", name="dataset"), "rename", ["a", "b"], ["b", "c"], "equipe").first()
    assert record.qualifiedName == "process.rename.vitaria@DOSP2020" and record.name == "rename do arquivo DOSP2020"
    assert (record.added_columns, record.deleted_columns, record.owner) == (["c"], ["a"], "equipe")


# --- sources -----------------------------------------------------------------


def test_globs():
    assert dataset_glob("/b", SPECS["SIA.AM"].layout, ["SP"], [2022], ["1", 12]) == (
        "/b/sia-parquet/AM/{,dataset=}AM{SP}{22}{01,12}.parquet"
    )
    assert dataset_glob("s3a://b/", SPECS["SIM.DO"].layout, ["PE", "PI"], [2020]) == (
        "s3a://b/sim-parquet/{,dataset=}DO{PE,PI}{2020}.parquet"
    )
    assert "{,[a-z]}.parquet" in dataset_glob("/b", SPECS["SIA.PA"].layout, ["SP"], [2021])


@pytest.mark.parametrize("branches", [0, 32])
def test_scan_reads_only_the_grid(spark, tmp_path, branches):
    base = str(tmp_path)
    for name, rows in [("PASP2101a", 3), ("PASP2101b", 4), ("PASP2102", 5), ("PARJ2101a", 6), ("PASP2001a", 7)]:
        spark.range(rows).write.parquet(f"{base}/sia-parquet/PA/{name}.parquet")
    spark.range(9).write.parquet(f"{base}/sia-parquet/PA/PAMSP2101.parquet")
    found = scan_bronze(spark, base, SPECS["SIA.PA"].layout, ["SP", "MG"], [2021], max_branches=branches)
    keys = ["tabela", "uf", "ano", "mes", "segmento", "dataset"]
    counts = sorted(tuple(r) for r in found.groupBy(*keys).count().collect())
    assert counts == [
        ("PA", "SP", "2021", "01", "a", "PASP2101a", 3), ("PA", "SP", "2021", "01", "b", "PASP2101b", 4),
        ("PA", "SP", "2021", "02", "0", "PASP2102", 5),
    ]
    with pytest.raises(ValueError, match="no dataset"):
        scan_bronze(spark, base, SPECS["SIA.PA"].layout, ["AC"], [2021])


def test_scan_refuses_hidden_coordinates(spark, tmp_path):
    spark.range(1).withColumn("UF", F.lit("x")).write.parquet(f"{tmp_path}/sim-parquet/DOSP2020.parquet")
    with pytest.raises(ValueError, match="coordinates"):
        scan_bronze(spark, str(tmp_path), SPECS["SIM.DO"].layout, ["SP"], [2020])


def test_merge_and_mixed_schemas(spark, tmp_path):
    one, two = f"{tmp_path}/DOSP2020.parquet", f"{tmp_path}/DOSP2021.parquet"
    spark.range(1).select(F.lit("a").alias("x"), F.lit(5).alias("n")).write.parquet(one)
    spark.range(1).select(F.lit("b").alias("x"), F.lit("7").alias("n"), F.lit("e").alias("extra")).write.parquet(two)
    found = sorted(tuple(r) for r in read_mixed(spark, [one, two], "dataset").select("x", "n", "extra", "dataset").collect())
    assert found == [("a", "5", None, "DOSP2020"), ("b", "7", "e", "DOSP2021")]
    (tmp_path / "note.txt").write_text("not data")
    listed = [(place, name) for place, name, _ in dataset_files(spark, str(tmp_path))]
    assert listed == [(f"file:{one}", "DOSP2020"), (f"file:{two}", "DOSP2021")]
    assert list_datasets(spark, str(tmp_path)).select("uf", "ano").distinct().count() == 2
    assert dataset_files(spark, f"{tmp_path}/none*") == []


def test_nested_directories_are_walked(spark, tmp_path):
    spark.range(2).write.parquet(f"{tmp_path}/x/deep/er")
    spark.range(3).write.parquet(f"{tmp_path}/x/flat")
    assert read_records(spark, f"{tmp_path}/x").count() == 5


def test_delta_without_library(spark, tmp_path):
    spark.range(2).write.parquet(f"{tmp_path}/t.delta")
    if not delta_available(spark):
        with pytest.raises(RuntimeError, match="raw_files"):
            read_delta(spark, f"{tmp_path}/t.delta")
    assert read_delta(spark, f"{tmp_path}/t.delta", raw_files=True).count() == 2
    layout = BronzeLayout("X", "d", extension="delta")
    assert dataset_glob("/b", layout, ["SP"], [2021], [1]).endswith("X{SP}{21}{01}.delta")


def test_rules_from_files(spark, tmp_path):
    files = {
        "drop": [{"id": 0, "to_drop": ["ORIGEM"]}, {"id": 1, "to_drop": ["SEXO"]}],
        "recode": [{"id": 0, "column_name": "SEXO", "to_replace": ["1"], "value": ["Homem"]}],
        "rename": {"SEXO": "Sexo"},
        "dates": ["DT_INTER"],
    }
    for name, content in files.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(content), encoding="utf-8")
    paths = {name: f"{tmp_path}/{name}.json" for name in files}
    loaded = rules.load_rules(spark, SPECS["SIM.DO"].rules, **paths)
    assert loaded.drop == ["ORIGEM"] and loaded.recode == {"SEXO": {"1": "Homem"}} and loaded.rename == {"SEXO": "Sexo"}
    assert loaded.dates == {"DT_INTER": "yyyyMMdd"} and loaded.age_columns == ["IDADE"]
    assert rules.load_rules(spark, drop=paths["drop"], drop_entries="all").drop == ["ORIGEM", "SEXO"]
    with pytest.raises(ValueError, match="old to new"):
        rules.load_rules(spark, rename=paths["dates"])
