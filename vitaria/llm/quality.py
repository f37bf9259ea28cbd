"""Quality rules on documents and on lines across documents, in DataFrame functions only.

Lines are normalised and hashed. For every host it is counted in how many of its
documents a line stands; lines above a limit are boilerplate and are removed, and a
document of which too little is left is rejected.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitaria.llm.words import SPACE_PATTERN, count_words, word_array
from vitaria.sinks.shared import keep_table

SYMBOLS = r"[#*$%&|<>]"
WORD = r"[^\x20\x09-\x0D]"


def normal_line(line: Column) -> Column:
    """A line in lower case, its digits as 0, its white space as single spaces."""
    return F.regexp_replace(F.trim(F.regexp_replace(F.lower(line), SPACE_PATTERN, " ")), "[0-9]", "0")


def line_hash(line: Column) -> Column:
    """64 bits of the hash of a normalised line, as hexadecimal digits; null for a line without words."""
    return F.when(F.rlike(line, F.lit(WORD)), F.substring(F.md5(normal_line(line)), 1, 16))


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value made once, as the element of a one-element array."""
    return F.get(F.transform(F.array(value), body), 0)


def repeated_words(words: Column, size: int = 3) -> Column:
    """Words that lie in windows of ``size`` words found twice or more among ``words``.

    Windows are sorted by hash, those equal to a neighbour are the repeated ones,
    and their first words, in order, give the words they cover.
    """

    def windows(hashes: Column) -> Column:
        first = F.sequence(F.lit(0), F.size(words) - size)
        window = lambda i: F.struct(F.xxhash64(*[F.get(hashes, i + k) for k in range(size)]).alias("h"), i.alias("at"))
        return F.sort_array(F.transform(first, window))

    def starts(ordered: Column) -> Column:
        def again(x: Column, i: Column) -> Column:
            return F.coalesce((F.get(ordered, i - 1)["h"] == x["h"]) | (F.get(ordered, i + 1)["h"] == x["h"]), F.lit(False))

        return F.sort_array(F.transform(F.filter(ordered, again), lambda x: x["at"]))

    def covered(found: Column) -> Column:
        none = F.struct(F.lit(0).alias("n"), F.lit(-size).alias("last"))
        step = lambda a, x: F.struct((a["n"] + F.least(F.lit(size), x - a["last"])).alias("n"), x.alias("last"))
        return F.aggregate(found, none, step, lambda a: a["n"])

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    found = _once(hashes, lambda h: covered(_once(windows(h), starts)))
    return F.when(F.size(words) > size, found).otherwise(0).cast("long")


def frequent_lines(docs: DataFrame, *, host: str, text: str, share: float, least: int) -> DataFrame:
    """``host, frequent`` for every host with lines in more than ``share`` of its documents, and more than ``least``.

    Documents of a host with the same set of lines are copies and count once, so a copied text is no
    boilerplate; all others count each. Every document also counts under an empty line, which gives the number of its
    host's documents in the same pass. A host cannot have more such lines than its documents have lines on average over ``share``.
    """
    hashes = F.transform(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), line_hash)
    held = docs.select(F.col(host).alias("host"), F.array_sort(F.array_distinct(F.array_compact(hashes))).alias("lines")).where(F.size("lines") > 0)
    document = F.substring(F.md5(F.array_join("lines", "")), 1, 16)
    rows = held.select("host", document.alias("document"), F.explode(F.concat(F.array(F.lit("")), "lines")).alias("line"))
    counted = rows.groupBy("host", "line").agg(F.count_distinct("document").alias("documents"))
    # of all other lines nothing more is asked
    counted = keep_table(counted.where((F.col("line") == "") | (F.col("documents") > least)), "line-counts")
    sizes = counted.where("line = ''").select(F.col("host").alias("sized_host"), F.col("documents").alias("host_documents"))
    many = counted.where((F.col("documents") > least) & (F.col("line") != "")).join(sizes, F.col("host").eqNullSafe(F.col("sized_host")))
    many = many.where(F.col("documents") > F.col("host_documents") * F.lit(share))
    # a written table has a known size, so Spark broadcasts it where it is small and shuffles nothing
    return keep_table(many.groupBy("host").agg(F.collect_list("line").alias("frequent")), "frequent-lines")


def quality_rules(
    docs: DataFrame,
    *,
    host: str = "source",
    text: str = "text",
    min_words: int = 50,
    max_repeated: float = 0.5,
    share: float = 0.02,
    least: int = 10,
    min_left: float = 0.5,
) -> DataFrame:
    """Rows with ``qr_*`` columns: measures, the text without frequent lines, and the verdict ``qr_kept``.

    ``qr_base_failed`` is true for fewer than ``min_words`` words or more than ``max_repeated`` of them
    in repeated 3-word windows. ``qr_kept`` is false for these, and for a document of
    which less than ``min_left`` of its words stand outside frequent lines of its host.

    A null text has no words, fails the base rules and has an empty ``qr_text``. A null host is a
    host of its own. Ids are not read; repeated rows are judged alike. An empty table
    gives an empty one. Columns named ``qr_*`` are replaced, other columns stay.
    """
    docs = docs.drop(*[c for c in docs.columns if c.startswith("qr_")])
    frequent = frequent_lines(docs, host=host, text=text, share=share, least=least)
    frequent = frequent.select(F.col("host").alias("qr_host"), F.col("frequent").alias("qr_frequent"))
    whole = F.coalesce(F.col(text), F.lit(""))
    measured = docs.withColumns({"qr_words": word_array(F.col(text)), "qr_lines": F.split(whole, "\n")})
    lines = F.filter("qr_lines", lambda x: F.rlike(x, F.lit(WORD)))
    measured = measured.withColumns(
        {
            "qr_n_words": F.size("qr_words").cast("long"),
            "qr_word_chars": F.char_length(F.translate(whole, " \t\n\x0b\f\r", "")).cast("long"),
            "qr_n_symbols": F.regexp_count(whole, F.lit(SYMBOLS)).cast("long"),
            "qr_n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            "qr_n_repeat_words": repeated_words(F.col("qr_words")),
        }
    ).drop("qr_words")
    joined = measured.join(frequent, measured[host].eqNullSafe(frequent["qr_host"]), "left")
    stays = lambda x: ~F.coalesce(F.array_contains("qr_frequent", line_hash(x)), F.lit(False))
    kept = F.when(F.col("qr_frequent").isNull(), F.col("qr_lines")).otherwise(F.filter("qr_lines", stays))
    joined = joined.withColumn("qr_text", F.array_join(kept, "\n"))
    joined = joined.withColumns(
        {
            "qr_n_kept_words": F.when(F.col("qr_frequent").isNull(), F.col("qr_n_words")).otherwise(count_words(F.col("qr_text"))),
            "qr_base_failed": (F.col("qr_n_words") < min_words) | (F.col("qr_n_repeat_words") > F.col("qr_n_words") * max_repeated),
        }
    )
    left = F.col("qr_n_kept_words") >= F.col("qr_n_words") * min_left
    return joined.withColumn("qr_kept", ~F.col("qr_base_failed") & left).drop("qr_lines", "qr_host", "qr_frequent")
