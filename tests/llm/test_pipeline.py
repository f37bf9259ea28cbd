import re
from collections import Counter, defaultdict

import duckdb
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.conftest import SCHEMA, awkward_rows, words
from tests.llm.test_dedup import near_classes
from vitaria.llm.queries import QUERIES, mixing_sql, quality_sql
from vitaria.llm.simhash import near_copy_groups


def stages(spark, docs, folder):
    found = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "")
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        found.append(docs)
    return found


def test_stages_on_awkward_rows(spark, docs, tmp_path):
    quality, near, repeats, mixed, packed = stages(spark, docs, tmp_path)
    for frame in (quality, near, repeats, mixed):
        assert frame.columns == docs.columns and frame.dtypes == docs.dtypes
    assert all(len(words(r.text)) >= 30 for r in quality.collect())
    ids = Counter(r.doc_id for r in near.collect())
    assert set(ids) == {r.component_id for r in near_copy_groups(quality).collect()} and set(ids.values()) == {1}
    assert {r.doc_id for r in repeats.collect()} <= set(ids)
    seen = set()
    for r in sorted(repeats.collect(), key=lambda r: (r.doc_id is None, r.doc_id)):
        own = words(r.text)
        assert r.n_chars == len(r.text)
        windows = {tuple(own[i : i + 50]) for i in range(len(own) - 49)}
        seen |= windows
    assert set(Counter(r.doc_id for r in mixed.collect()).values()) <= {1, 2}
    lengths = defaultdict(int)
    for r in packed.collect():
        lengths[r.sequence_id] += r.length
    assert sorted(lengths.values())[1:] == [2048] * (len(lengths) - 1)


def test_stages_on_an_empty_table(spark, empty, tmp_path):
    assert [frame.count() for frame in stages(spark, empty, tmp_path)] == [0] * 5


def test_run_equals_its_stages(spark, tmp_path):
    rows = spark.createDataFrame(awkward_rows(11, 40), SCHEMA)
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    whole = corpus_pipeline.run(spark, str(tmp_path))
    last = stages(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), f"{tmp_path}/stages")[-1]
    pieces = lambda frame: Counter((r.doc_id, r.doc_tokens) for r in frame.collect() if r.start == 0)
    assert pieces(whole) == pieces(last)


def in_table(rows):
    connection = duckdb.connect()
    connection.execute("create table docs (doc_id bigint, text varchar, source varchar)")
    connection.executemany("insert into docs values (?, ?, ?)", rows)
    return connection


def without_repeats(rows, window=50):
    """Texts without the words, and the white space after them, that windows of lesser ids cover."""
    first, out = {}, []
    key = lambda i: (1 << 63) - 1 if i is None else i
    spans = [[m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)] for _, text, _ in rows]
    said = [[text[a:b] for a, b in own] for (_, text, _), own in zip(rows, spans, strict=True)]
    for (doc_id, _, _), w in zip(rows, said, strict=True):
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            first[k] = min(first.get(k, key(doc_id)), key(doc_id))
    for (doc_id, text, source), own, w in zip(rows, spans, said, strict=True):
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < key(doc_id):
                gone |= set(range(i, i + window))
        starts = [a for a, _ in own] + [len(text)]
        kept = text[: starts[0]] + "".join(text[starts[i] : starts[i + 1]] for i in range(len(own)) if i not in gone)
        if len(gone) < len(w) or not w:
            out.append((doc_id, kept, source))
    return out


def test_run_equals_brute_force(spark, tmp_path):
    given = awkward_rows(11, 40)
    spark.createDataFrame(given, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    kept = in_table([(i, t, s) for i, t, _, s, _ in given]).execute(
        f"select doc_id, kept_text, source from ({quality_sql('docs')}) where kept"
    ).fetchall()
    groups = defaultdict(list)
    for i, label in near_classes([text for _, text, _ in kept]).items():
        groups[label].append(kept[i])
    one = [min(own, key=lambda r: (r[0] is None, r[0] or 0)) for own in groups.values()]
    left = without_repeats(one)
    mixed = in_table(left).execute(f"select doc_id, text, repeats from ({mixing_sql('docs')})").fetchall()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = Counter()
    for doc_id, text, repeats in mixed:
        expected[doc_id, len(tokenizer.encode(text, add_special_tokens=False).ids) + 1] += repeats
    lengths, found = Counter(), {}
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        lengths[r.doc_row] += r.length
        found[r.doc_row] = (r.doc_id, r.doc_tokens)
    assert all(found[row][1] == n for row, n in lengths.items())
    assert Counter(found.values()) == +expected
    assert len(kept) > len(one) > 10 and sum(len(t) for _, t, _ in left) < sum(len(t) for _, t, _ in one)


def test_every_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
