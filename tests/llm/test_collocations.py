"""Collocations against a plain count of all phrases."""

import random
import re
from collections import Counter, defaultdict

import pytest

from vitaria.llm import collocations
from vitaria.llm.collocations import mine_collocations

SCHEMA = "doc_id long, text string, lang string, phrase string, w1 int, n int"
_FALL = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain(rows, least, top, covered=80):
    found = []
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(_FALL)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            totals[lang] += len(words)
            for size in range(1, 5):
                counts[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = defaultdict(int)
        for p, a in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    inside[p[i : i + size]] = max(inside[p[i : i + size]], a)
        rows = []
        for p, a in candidates.items():
            score, _, left, right = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            if 100 * inside[p] < covered * a:
                rows.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            found.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(found)


def corpus(seed=5, docs=160):
    rng = random.Random(seed)
    words = [w for n, w in enumerate("the of and new york united states america é ü x1 big apple red tape zz Yes no one two".split()) for _ in range(1 + 12 // (n + 1))]
    fixed = ["United States of America", "new york", "big apple red tape", "one two one two one", "the the the the"]
    rows = []
    for i in range(docs):
        parts = []
        for _ in range(rng.randint(1, 25)):
            parts.append(rng.choice(fixed) if rng.random() < 0.4 else rng.choice(words))
            parts.append(rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "!", "\x0b", " \r\n", "\x1c", "\xa0"]))
        rows.append(("".join(parts), ["en", "en", "fr", None, ""][i % 5]))
    return rows + [(None, "en"), ("", "en"), (" ..,, ", "de"), ("lone", "it"), (rows[0][0] * 30, "en"), rows[1], rows[1], rows[1]]


@pytest.mark.parametrize(("least", "top", "first", "block"), [(3, 7, 3, 1_000_000), (2, 500, None, 1_000_000), (4, 3, 1, 5)])
def test_as_a_plain_count_has_it(spark, monkeypatch, least, top, first, block):
    """A few phrases by many rounds, all phrases, and a frontier in many blocks."""
    monkeypatch.setattr(collocations, "_PHRASES_AT_ONCE", block)
    rows = corpus() if block > 5 else corpus(docs=30)
    table = spark.createDataFrame([(i, t, lang, "clash", 1, 2) for i, (t, lang) in enumerate(rows)], SCHEMA).repartition(3)
    found = mine_collocations(table, least=least, top=top, first=first)
    assert found.dtypes == [("lang", "string"), ("rank", "bigint"), ("phrase", "string"), *((c, "bigint") for c in ("a", "l", "r", "n", "score"))]
    assert sorted(map(tuple, found.collect())) == plain(rows, least, top)


def test_nothing_and_too_little(spark):
    assert mine_collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    assert mine_collocations(spark.createDataFrame([(1, "a b c", "en", "", 0, 0)], SCHEMA)).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    a = 9_000_000_000_000_000
    row = spark.createDataFrame([(a, a + 1, 5 * a)], "a long, l long, r long")
    found = row.select(collocations._ratio(row["a"], row["l"] + row["r"]).alias("x")).first()["x"]
    assert found == 2000000 * a // (6 * a + 1)
