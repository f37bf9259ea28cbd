import random
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import awkward_rows, words
from vitaria.llm.mixing import fill, mix_sources, ranked, repeat_rows
from vitaria.llm.quality import normal_line, quality_rules, repeated_words
from vitaria.llm.queries import mixing_sql, quality_sql
from vitaria.llm.words import word_array


def in_duck(sql, df):
    frame = df.toPandas().astype(object).where(lambda x: x.notna(), None)  # noqa: F841
    connection = duckdb.connect()
    connection.execute("create table docs (doc_id bigint, text varchar, lang varchar, source varchar, n_chars bigint)")
    connection.executemany("insert into docs values (?, ?, ?, ?, ?)", [tuple(r) for r in df.collect()])
    return connection.execute(sql)


def test_repeated_words(spark):
    texts = ["a b c a b c", "a b c", "x x x x", "a b c d a b c e a b c", "", "q w e r t y q w e", None, "a b a b a b a"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    found = {r.t: r.n for r in rows.select("t", repeated_words(word_array(F.col("t"))).alias("n")).collect()}
    for text in texts:
        w = words(text)
        many = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        covered = {i + k for i in range(len(w) - 2) if many[tuple(w[i : i + 3])] > 1 for k in range(3)}
        assert found[text] == len(covered), text


def test_rules_equal_sql(docs):
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_kept_words"]
    result = in_duck(f"select {', '.join(names)} from ({quality_sql('docs')})", docs)
    rules = quality_rules(docs).select("doc_id", *[F.col(f"qr_{n}") for n in names[1:]])
    assert Counter(map(tuple, rules.collect())) == Counter(result.fetchall())


def letters(number):
    """A number in letters: digits of a line count alike."""
    return "".join("abcdefghij"[int(d)] for d in str(number))


def boilerplate(spark):
    line = "this page and what stands on it belongs to somebody"
    rows = [(i, f"{line}\nown words of {letters(i)} " + " ".join(f"w{letters(i)}x{letters(k)}" for k in range(60))) for i in range(40)]
    rows += [(100 + i, f"{line}\n{line}x\nown {i}\n" * 12) for i in range(3)]
    rows += [(200 + i, "\n".join(f"copied line {letters(k)} of a text that many have" for k in range(20))) for i in range(30)]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("source", F.lit("h"))


def test_frequent_lines_go_and_copies_do_not_count(spark):
    rules = {r.doc_id: r for r in quality_rules(boilerplate(spark), share=0.2, least=5, max_repeated=1.0).collect()}
    assert all(r.qr_kept for i, r in rules.items() if i < 100)
    assert not rules[0].qr_text.startswith("this page") and "own words" in rules[0].qr_text
    assert all(r.qr_kept and r.qr_text.count("\n") == 19 for i, r in rules.items() if i >= 200)


def test_depleted_document_is_rejected(spark):
    shared = "\n".join(f"shared {letters(k)} line of the host with some words in it" for k in range(8))
    rows = [(i, f"{shared}\n" + " ".join(f"w{letters(i)}x{letters(k)}" for k in range(200))) for i in range(30)] + [(99, f"{shared}\nand this")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("source", F.lit(None).cast("string"))
    kept = {r.doc_id: r.qr_kept for r in quality_rules(frame, share=0.2, least=5).collect()}
    assert kept.pop(99) is False and all(kept.values())


def test_rules_stand_clashing_columns_and_empty_tables(docs, empty):
    assert quality_rules(empty).count() == 0
    clash = docs.withColumns({"qr_text": F.lit(1), "host": F.lit(2), "line": F.lit(3), "documents": F.lit(4)})
    found = quality_rules(clash)
    assert found.count() == docs.count() and {"host", "line", "documents"} <= set(found.columns)
    assert found.where("text is null and (qr_kept or qr_text <> '')").count() == 0


def test_normal_line(spark):
    assert spark.range(1).select(normal_line(F.lit("  A\t b12  "))).first()[0] == "a b00"


def test_mix_equals_sql(docs):
    result = in_duck(f"select doc_id, size, source_size, target, repeats from ({mixing_sql('docs')})", docs)
    mixed = mix_sources(docs).select("doc_id", "mix_size", "mix_source_size", "mix_target", "mix_repeats")
    round_ = lambda rows: Counter((r[0], r[1], r[2], round(r[3], 6), r[4]) for r in rows)
    # equal rows are interchangeable
    assert round_(map(tuple, mixed.collect())) == round_(result.fetchall())


def test_mix_reaches_its_targets(docs):
    rows = mix_sources(docs).collect()
    taken, target, largest = defaultdict(int), {}, Counter()
    for r in rows:
        taken[r.source] += r.mix_size * r.mix_repeats
        target[r.source] = r.mix_target
        largest[r.source] = max(largest[r.source], r.mix_size)
        assert 0 <= r.mix_repeats <= 2
    assert sum(target.values()) == pytest.approx(1.5 * sum(r.mix_size for r in rows))
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in target)
    again = mix_sources(docs.repartition(7)).collect()
    assert Counter((r.doc_id, r.mix_repeats) for r in rows) == Counter((r.doc_id, r.mix_repeats) for r in again)


def test_water_filling(spark):
    sources = spark.createDataFrame([(5.0, 10), (2.0, 100), (1.0, 100), (9.0, 0)], "mix_weight double, mix_source_size long")
    level = fill(sources, 150.0, 2.0)
    assert level == pytest.approx(130 / 3) and fill(sources, 1e9, 2.0) is None


def test_mix_edges(docs, empty, spark):
    assert mix_sources(empty).count() == 0 and repeat_rows(mix_sources(empty)).count() == 0
    wordless = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert {(r.mix_target, r.mix_repeats) for r in mix_sources(wordless).collect()} == {(0.0, 0)}
    clash = docs.withColumns({"mix_source": F.lit("x"), "key": F.lit("y"), "part": F.lit(1)})
    mixed = mix_sources(clash)
    assert mixed.count() == len(awkward_rows()) and {"key", "part"} <= set(mixed.columns)
    repeated = repeat_rows(mixed)
    assert repeated.count() == mixed.agg(F.sum("mix_repeats")).first()[0] and repeated.columns == clash.drop("mix_source").columns


def test_ranks(spark):
    rows = spark.createDataFrame([(c,) for c in ["b", "a", None, "é", "Z", "\U0001f600"]], "s string")
    found = {r.s: r.n for r in ranked(rows, F.col("s").asc_nulls_last(), "n").collect()}
    assert found == {"Z": 0, "a": 1, "b": 2, "é": 3, "\U0001f600": 4, None: 5}


def plain_kept(rows, share=0.02, least=10, left=0.5):
    """Verdict of every row by a plain count of documents, for rows that pass the base rules."""
    import re

    normal = lambda line: re.sub("[0-9]", "0", " ".join(re.findall(r"[^\x20\x09-\x0D]+", line.lower())))
    documents = {}
    for host, text in rows:
        documents.setdefault(host, set()).add(frozenset(normal(x) for x in (text or "").split("\n") if normal(x)))
    documents = {host: {d for d in own if d} for host, own in documents.items()}
    kept = []
    for host, text in rows:
        words, stay = 0, 0
        for line in (text or "").split("\n"):
            n = len(re.findall(r"[^\x20\x09-\x0D]+", line))
            words += n
            holders = sum(normal(line) in d for d in documents[host])
            stay += 0 if n and holders > least and holders > len(documents[host]) * share else n
        kept.append(words >= 50 and stay >= words * left)
    return kept


def test_documents_are_counted_one_by_one(spark):
    """A host of 600 documents, 30 of them 20 template lines and one own line: five per cent against two. And the same with copies."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=6))
    line = lambda: " ".join(word() for _ in range(6))
    template = [line() for _ in range(20)]
    rows = [("h", "\n".join(line() for _ in range(12))) for _ in range(570)]
    rows += [("h", "\n".join([*template, line()])) for _ in range(30)]
    rows += [("copies", rows[0][1])] * 50 + [("copies", "\n".join(line() for _ in range(12))) for _ in range(60)]
    rows += [(None, "\n".join([*template[:9], *(line() for _ in range(9))])) for _ in range(25)] + [("h", None), ("h", "")]
    table = spark.createDataFrame([(i, t, h) for i, (h, t) in enumerate(rows)], "doc_id long, text string, source string").repartition(5)
    found = {r.doc_id: r.qr_kept for r in quality_rules(table).select("doc_id", "qr_kept").collect()}
    assert [found[i] for i in range(len(rows))] == plain_kept(rows)
    assert not any(found[i] for i in range(570, 600)) and all(found[i] for i in range(570))
    assert all(found[i] for i in range(600, 710))
