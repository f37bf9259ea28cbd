"""Small tables with every awkward row the operators have to stand."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = "the an er on ing re th ea st or wh ti nd ou at in es le ve mo".split()


def sentence(rng, n):
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(n))


def awkward_rows(seed=3, n=60):
    """Plain, short, long, copied and null texts; null and repeated ids and sources; ties and equal rows."""
    rng = random.Random(seed)
    rows = []
    passage = sentence(rng, 70)
    for i in range(n):
        lines = [sentence(rng, rng.randint(5, 30)) for _ in range(rng.randint(2, 8))]
        if i % 7 == 0:
            lines.insert(1, passage)
        if i % 5 == 0:
            lines.append("all rights reserved 2024")
        rows.append((i, "\n".join(lines), "en", f"s{i % 4}" if i % 9 else None, 0))
    rows += [(100 + i, rows[3][1], "en", "s1", 0) for i in range(8)]  # copies
    rows += [(120 + i, rows[4][1] + f" end{i}", "en", "s2", 0) for i in range(8)]  # near copies
    rows += [
        (200, None, None, None, None), (201, "", "en", "s0", 0), (202, " \n\t ", "en", "s0", 0), (203, "one", "en", "s0", 0),
        (204, "A b  c", "de", "\U0001f600", 0), (205, "the end " * 300, "en", "s3", 0), (None, rows[5][1], "en", "s1", 0),
        (None, None, None, None, None), (206, sentence(rng, 6000), "en", "s1", 0), (207, "é ü\x1c\xa0x 漢字 \U0001f600 ***", "fr", "s2", 0),
        (208, rows[6][1], "en", "s2", 0), (208, rows[6][1], "en", "s2", 0),
    ]
    return rows


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return (text or "").encode().split()
