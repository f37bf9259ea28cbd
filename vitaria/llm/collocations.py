"""Collocations: the best phrases of every language, by best-first growth.

Words and word pairs are counted over all texts. Longer phrases are grown from prefixes, best
first: a prefix found ``a`` times whose first word is found ``f`` times cannot begin a phrase
that scores above ``2000000 * a / (f + a)``. Prefixes whose bound reaches a level are expanded
by counting, in one pass over the texts, only the phrases that continue them. Every phrase at or above the
level is then settled; when a language has enough of them that survive, it is done, ties included, otherwise
its level falls and more of its frontier is expanded.

Phrases are known by the 64-bit hashes of their words, which hold the language as well.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitaria.llm.session import let_workers_import
from vitaria.llm.words import hash_spans, mix
from vitaria.operators.joins import lookup_join
from vitaria.sinks.shared import keep_table

#: Bytes between words, and those of them that end a piece.
_GAPS = b" \t"
_ENDS = b".,;:!?\n\x0b\x0c\r"
_GAP = np.zeros(256, bool)
_GAP[list(_GAPS + _ENDS)] = True
_END = np.zeros(256, bool)
_END[list(_ENDS)] = True
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BYTES_AT_ONCE = 2 << 20
#: Windows that a task holds before it adds them up and sends them.
_WINDOWS_AT_ONCE = 1_000_000
#: Phrases that are looked for in one pass over the texts; more take more passes.
_PHRASES_AT_ONCE = 1_000_000
#: Greatest score: a phrase whose parts occur nowhere else.
SCALE = 2_000_000
LONGEST = 4


class _Block:
    """Words of some texts: hashes, spans, text, language, and the piece of text that each is in."""

    def __init__(self, texts: list[bytes], seeds: np.ndarray):
        self.data = b"\n".join(texts).translate(_LOWER)
        data = np.frombuffer(self.data, np.uint8)
        inside = np.empty(len(data) + 2, bool)
        inside[0] = inside[-1] = False
        np.logical_not(_GAP[data], out=inside[1:-1])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.ends = edges[::2], edges[1::2]
        self.pieces = np.cumsum(_END[data], dtype=np.int32)[self.starts] if len(data) else np.empty(0, np.int32)
        begins = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
        self.docs = np.searchsorted(begins, self.starts, "right") - 1
        self.langs = seeds[self.docs]
        self.words = mix(hash_spans(data, self.starts, self.ends) ^ mix(self.langs))

    def windows(self, size: int) -> np.ndarray:
        """First words of all windows that lie in one piece."""
        n = len(self.words) - size + 1
        return np.flatnonzero(self.pieces[size - 1 :] == self.pieces[:n]) if n > 0 else np.empty(0, np.int64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Block, list]]:
    """Texts of some megabytes together, and their languages if they are read."""
    for batch in batches:
        seeds, texts = batch.column("seed").to_numpy().view(np.uint64), batch.column("text").cast(pa.large_binary())
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)) // _BYTES_AT_ONCE
        cuts = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), len(batch)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                langs = batch.column("lang").slice(a, b - a).to_pylist() if "lang" in batch.schema.names else []
                yield _Block(texts.slice(a, b - a).to_pylist(), seeds[a:b]), langs


def phrase_keys(columns: Sequence[np.ndarray]) -> np.ndarray:
    """64-bit key of phrases given by the hashes of their first, second, … words."""
    return reduce(lambda key, word: mix(key * _STEP + word), columns[1:], columns[0])


class _Keys:
    """A set of keys that tells for many keys at once which it holds."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.unique(keys)
        bits = max(10, int(len(self.keys)).bit_length() + 4)
        self.shift = np.uint64(64 - bits)
        self.seen = np.zeros(1 << bits, bool)
        self.seen[self.keys >> self.shift] = True

    def has(self, keys: np.ndarray) -> np.ndarray:
        found = self.seen[keys >> self.shift]
        at = np.flatnonzero(found)
        if len(at):
            place = np.minimum(np.searchsorted(self.keys, keys[at]), len(self.keys) - 1)
            found[at] = self.keys[place] == keys[at]
        return found


def _added(columns: list[np.ndarray], schema: pa.Schema, **fixed: int) -> pa.RecordBatch:
    """Equal windows as one row with their number."""
    _, first, n = np.unique(phrase_keys(columns), return_index=True, return_counts=True)
    values = [pa.array(np.full(len(n), v, np.int32)) for v in fixed.values()]
    values += [pa.array(c[first].view(np.int64)) for c in columns]
    return pa.RecordBatch.from_arrays([*values, pa.array(n.astype(np.int64))], schema=schema)


_GRAMS = pa.schema([("kind", pa.int32()), ("w1", pa.int64()), ("w2", pa.int64()), ("n", pa.int64())])


def _words_and_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task: kind 0 has a language and all its words, kind 1 a word and its language, kind 2 a pair."""
    held: list[tuple[np.ndarray, ...]] = []

    def send() -> Iterator[pa.RecordBatch]:
        words, langs, first, second = (np.concatenate(c) for c in zip(*held, strict=True))
        held.clear()
        yield _added([langs, np.zeros_like(langs)], _GRAMS, kind=0)
        yield _added([words, langs], _GRAMS, kind=1)
        yield _added([first, second], _GRAMS, kind=2)

    size = 0
    for block, _ in _blocks(batches):
        pairs = block.windows(2)
        held.append((block.words, block.langs, block.words[pairs], block.words[pairs + 1]))
        size += len(block.words)
        if size > _WINDOWS_AT_ONCE:
            yield from send()
            size = 0
    if size:
        yield from send()


def _names(size: int) -> list[str]:
    return [f"w{i}" for i in range(1, size + 1)]


def _windows(size: int, sought: dict[str, _Keys]) -> Callable:
    """Counts of the windows whose first words, last words or all words are sought."""
    schema = pa.schema([(w, pa.int64()) for w in [*_names(size), "n"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        count = 0
        for block, _ in _blocks(batches):
            at = block.windows(size)
            shorter = phrase_keys([block.words[i : len(block.words) - size + 2 + i] for i in range(size - 1)]) if len(at) else at
            found = np.zeros(len(at), bool)
            for which, keys in sought.items():
                if which == "all":
                    found |= keys.has(phrase_keys([block.words[at + i] for i in range(size)]))
                else:
                    found |= keys.has(shorter[at + (which == "last")])
            at = at[found]
            held.append([block.words[at + i] for i in range(size)])
            count += len(at)
            if count > _WINDOWS_AT_ONCE:
                yield _added([np.concatenate(c) for c in zip(*held, strict=True)], schema)
                held, count = [], 0
        if count:
            yield _added([np.concatenate(c) for c in zip(*held, strict=True)], schema)

    return run


def _texts_of(sought: dict[int, _Keys]) -> Callable:
    """Language and text of the sought phrases, by their number of words; each once in a task's block."""
    schema = pa.schema([*((w, pa.int64()) for w in _names(LONGEST)), ("lang", pa.string()), ("phrase", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[tuple] = set()
        for block, langs in _blocks(batches):
            rows = []
            for size, keys in sought.items():
                at = block.windows(size)
                all_keys = phrase_keys([block.words[at + i] for i in range(size)])
                found = keys.has(all_keys)
                _, first = np.unique(all_keys[found], return_index=True)
                for i in at[found][first].tolist():
                    words = tuple(block.words[i : i + size].view(np.int64).tolist()) + (0,) * (LONGEST - size)
                    if words not in sent:
                        sent.add(words)
                        text = b" ".join(block.data[a:b] for a, b in zip(block.starts[i : i + size], block.ends[i : i + size], strict=True))
                        rows.append((*words, langs[block.docs[i]], text.decode()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return run


def _ratio(a: Column, whole: Column) -> Column:
    """``SCALE * a / whole`` as a whole number, exact for any counts."""
    wide = lambda c: c.cast("decimal(20,0)")
    return F.call_function("div", wide(a) * F.lit(SCALE), wide(whole)).cast("long")


def _scored(phrases: DataFrame, cuts: Sequence[tuple[str, str]]) -> DataFrame:
    """``l, r, score`` of the cut of the lowest score, the first of several; ``cuts`` names the counts of both parts."""
    each = [F.struct(_ratio(F.col("a"), F.col(x) + F.col(y)).alias("score"), F.lit(k).alias("k"), F.col(x).alias("l"), F.col(y).alias("r"))
            for k, (x, y) in enumerate(cuts)]
    best = F.array_min(F.array(*each)) if len(each) > 1 else each[0]
    return phrases.withColumn("best", best).withColumns({n: F.col(f"best.{n}") for n in ("l", "r", "score")}).drop("best")


def _bound(a: str = "a", first: str = "f1") -> Column:
    """No phrase that such a prefix begins scores more."""
    return _ratio(F.col(a), F.col(first) + F.col(a))


def _levels(phrases: DataFrame, order: Sequence[str], most: int) -> DataFrame:
    """``lang`` and, where it has ``most`` phrases or more, the values of ``order`` that the ``most``-th has, descending.

    Counted by value first, so that a language's phrases are never sorted in one task.
    """
    counted = phrases.groupBy("lang", *order).agg(F.count("*").alias("n"))
    down = Window.partitionBy("lang").orderBy(*[F.col(c).desc() for c in order])
    reached = counted.withColumn("above", F.sum("n").over(down.rowsBetween(Window.unboundedPreceding, 0))).where(F.col("above") >= most)
    return reached.groupBy("lang").agg(F.max(F.struct(*order)).alias("level")).select("lang", *[F.col(f"level.{c}").alias(f"least_{c}") for c in order])


def _key_blocks(phrases: DataFrame, size: int) -> Iterator[tuple[_Keys, _Keys]]:
    """Keys of phrases of ``size`` words, and of those marked ``last``, in blocks of bounded size."""
    names = _names(size)
    blocks = -(-phrases.count() // _PHRASES_AT_ONCE)
    for block in range(blocks):
        own = phrases.where(F.pmod(F.xxhash64(*names), F.lit(blocks)) == block).select(*names, "last").toArrow()
        keys = phrase_keys([own.column(n).to_numpy().view(np.uint64) for n in names])
        yield _Keys(keys), _Keys(keys[own.column("last").to_numpy().astype(bool)])


def _counted(texts: DataFrame, size: int, passes: Iterator[dict[str, _Keys]], least: int) -> DataFrame:
    """``w1, …, a``: the windows that each pass seeks, with how often they occur, if at least ``least`` times."""
    names = _names(size)
    ddl = ", ".join(f"{n} long" for n in [*names, "n"])
    tables = []
    for sought in passes:
        held = texts.sparkSession.sparkContext.broadcast(sought)
        rows = texts.select("seed", "text").mapInArrow(lambda batches, held=held: _windows(size, held.value)(batches), ddl)
        tables.append(keep_table(rows.groupBy(*names).agg(F.sum("n").alias("a")).where(F.col("a") >= least), f"phrases{size}"))
    if not tables:
        return texts.sparkSession.createDataFrame([], ", ".join(f"{n} long" for n in [*names, "a"]))
    if len(tables) == 1:
        return tables[0]
    return reduce(DataFrame.union, tables).groupBy(*names).agg(F.max("a").alias("a"))  # counts of a window are equal in all passes


def _grown(texts: DataFrame, size: int, frontier: DataFrame, least: int) -> DataFrame:
    """All phrases of ``size`` words that begin with a phrase of the frontier, or end with one marked ``last``."""
    passes = ({"first": first, "last": last} for first, last in _key_blocks(frontier, size - 1))
    return _counted(texts, size, passes, least)


def _of(phrases: DataFrame, names: Sequence[str], **values: str) -> DataFrame:
    """Values of phrases under other names, to be looked up by other words."""
    words = [F.col(w).alias(n) for w, n in zip(_names(len(names)), names, strict=True)]
    return phrases.select(*words, *[F.col(c).alias(n) for n, c in values.items()])


def _uncovered(phrases: DataFrame, longer: DataFrame, size: int, covered: int) -> DataFrame:
    """Phrases that lie in no phrase of one word more with ``covered`` per cent of their occurrences.

    A phrase of two words more that covers them lies around one of one word more that does.
    """
    names = _names(size)
    ends = [longer.select(*[F.col(f"w{i + by}").alias(f"w{i}") for i in range(1, size + 1)], F.col("a").alias("most")) for by in (0, 1)]
    most = ends[0].union(ends[1]).groupBy(*names).agg(F.max("most").alias("most"))
    joined = lookup_join(phrases, most, names)
    return joined.where(F.coalesce(100 * F.col("most") < covered * F.col("a"), F.lit(True)))


def _settled(texts: DataFrame, frontier: DataFrame, pairs: DataFrame, levels: DataFrame, least: int, covered: int) -> DataFrame:
    """All phrases that survive and score at least their language's level: ``lang, w1, …, w4, a, l, r, score``."""
    marked = lambda rows: rows.where(F.col("bound") >= F.col("level")).withColumn("last", F.col("score") >= F.col("level"))
    twos = keep_table(marked(lookup_join(frontier, levels, ["lang"])), "frontier2")
    threes = _grown(texts, 3, twos, least)
    threes = lookup_join(threes, _of(pairs, ["w1", "w2"], f12="a", f1="f1", lang="lang"), ["w1", "w2"])
    threes = lookup_join(threes, _of(pairs, ["w2", "w3"], f23="a", f3="f2"), ["w2", "w3"])
    threes = _scored(threes, [("f1", "f23"), ("f12", "f3")]).withColumn("bound", _bound())
    threes = keep_table(lookup_join(threes, levels, ["lang"]), "phrases3")
    heads = keep_table(marked(threes), "frontier3")
    fours = _grown(texts, 4, heads, least)
    # a four that reaches the level begins with one of the heads
    known = lookup_join(fours, _of(heads, ["w1", "w2", "w3"], f123="a", f1="f1", f12="f12", lang="lang", level="level"), ["w1", "w2", "w3"])
    known = lookup_join(known.where("f123 is not null"), _of(pairs, ["w3", "w4"], f34="a", f4="f2"), ["w3", "w4"])
    known = lookup_join(known, _of(threes, ["w2", "w3", "w4"], f234="a"), ["w2", "w3", "w4"])
    may = F.least(_bound(), _ratio(F.col("a"), F.col("f12") + F.col("f34")), _ratio(F.col("a"), F.col("f123") + F.col("f4")))
    known = keep_table(known.where(may >= F.col("level")), "phrases4")
    unknown = known.where("f234 is null").select("w2", "w3", "w4").distinct().toDF("w1", "w2", "w3").withColumn("last", F.lit(False))
    tails = _counted(texts, 3, ({"all": keys} for keys, _ in _key_blocks(unknown, 3)), least)
    known = lookup_join(known, _of(tails, ["w2", "w3", "w4"], counted="a"), ["w2", "w3", "w4"])
    known = _scored(known.withColumn("f234", F.coalesce("f234", "counted")), [("f1", "f234"), ("f12", "f34"), ("f123", "f4")])
    found = [
        _uncovered(twos.where("last"), threes, 2, covered),
        _uncovered(heads.where("last"), fours, 3, covered),
        known.where(F.col("score") >= F.col("level")),
    ]
    none = F.lit(0).cast("long")
    columns = lambda size: [F.col(w) if i < size else none.alias(w) for i, w in enumerate(_names(LONGEST))]
    return reduce(DataFrame.union, [t.select("lang", *columns(n), "a", "l", "r", "score") for n, t in enumerate(found, 2)])


def _best(phrases: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of every language by score and count, and all that tie with the last."""
    for order in (["score"], ["score", "a"]):
        least = lookup_join(phrases, _levels(phrases, order, top), ["lang"])
        reaches = F.struct(*order) >= F.struct(*[F.col(f"least_{c}") for c in order])
        phrases = least.where(F.coalesce(reaches, F.lit(True))).select(*phrases.columns)
    return phrases


def _with_texts(texts: DataFrame, phrases: DataFrame) -> DataFrame:
    """Phrases with their language's name and their text, taken from a place where they occur."""
    names = _names(LONGEST)
    ddl = ", ".join([*(f"{n} long" for n in names), "name string", "phrase string"])
    blocks = max(1, -(-phrases.count() // _PHRASES_AT_ONCE))
    found = []
    for block in range(blocks):
        own = phrases.where(F.pmod(F.xxhash64(*names), F.lit(blocks)) == block).select(*names).toArrow()
        words = [own.column(n).to_numpy().view(np.uint64) for n in names]
        sizes = sum((w != 0).astype(int) for w in words)
        sought = {n: _Keys(phrase_keys([w[sizes == n] for w in words[:n]])) for n in range(2, LONGEST + 1)}
        held = texts.sparkSession.sparkContext.broadcast(sought)
        found.append(texts.mapInArrow(lambda batches, held=held: _texts_of(held.value)(batches), ddl))
    once = reduce(DataFrame.union, found).groupBy(*names).agg(F.min("name").alias("name"), F.min("phrase").alias("phrase"))
    return phrases.join(once, names)


def mine_collocations(
    docs: DataFrame,
    *,
    lang: str = "lang",
    text: str = "text",
    least: int = 30,
    top: int = 2000,
    covered: int = 80,
    first: int | None = None,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of two to four words of every language.

    Texts are put in lower case (A-Z), cut at ``.,;:!?`` and line ends, and split at spaces and tabs. ``a`` counts a
    phrase, ``l`` and ``r`` its parts at the cut of the lowest score, ``n`` all words of the language. Phrases found less than
    ``least`` times don't count, and those that lie in a longer one with ``covered`` per cent of their
    occurrences are left out. Ranked by score, count and text. ``first`` is how many pairs of a language reach its
    first level; it changes only how much work is done at once.

    A null language is ``und``, a null text empty. Repeated rows count each time. Languages without such a phrase, and an
    empty table, give no row. Ids are not read, nor are other columns.
    """
    spark = docs.sparkSession
    let_workers_import(spark)
    named = F.coalesce(F.col(lang).cast("string"), F.lit("und"))
    texts = docs.select(named.alias("lang"), F.xxhash64(named).alias("seed"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    counts = texts.select("seed", "text").mapInArrow(_words_and_pairs, "kind int, w1 long, w2 long, n long")
    counts = counts.groupBy("kind", "w1", "w2").agg(F.sum("n").alias("n")).where((F.col("kind") == 0) | (F.col("n") >= least))
    counts = keep_table(counts, "counts")
    totals = counts.where("kind = 0").select(F.col("w1").alias("lang"), "n")
    words = counts.where("kind = 1").select(F.col("w1").alias("w"), F.col("w2").alias("lang"), F.col("n").alias("f"))
    pairs = counts.where("kind = 2").select("w1", "w2", F.col("n").alias("a"))
    pairs = lookup_join(pairs, words.select(F.col("w").alias("w1"), "lang", F.col("f").alias("f1")), ["w1"])
    pairs = lookup_join(pairs, words.select(F.col("w").alias("w2"), F.col("f").alias("f2")), ["w2"])
    pairs = keep_table(_scored(pairs, [("f1", "f2")]).withColumn("bound", _bound()), "pairs")

    frontier, reached, done = pairs, first or 2 * top, []
    while True:
        langs = frontier.select("lang").distinct()
        levels = langs.join(_levels(frontier, ["score"], reached), "lang", "left")
        levels = keep_table(levels.select("lang", F.coalesce("least_score", F.lit(0)).alias("level")), "levels")
        found = keep_table(_settled(texts, frontier, pairs, levels, least, covered), "found")
        have = found.groupBy("lang").agg(F.count("*").alias("have"))
        state = levels.join(have, "lang", "left").select(
            "lang", ((F.col("level") == 0) | (F.coalesce("have", F.lit(0)) >= top)).alias("done")
        )
        state = keep_table(state, "levels")
        done.append(lookup_join(found, state, ["lang"]).where("done").select(*found.columns))
        if state.where("not done").isEmpty():
            break
        frontier = keep_table(lookup_join(frontier, state, ["lang"]).where("not done").drop("done"), "pairs")
        reached *= 8
    best = keep_table(_best(reduce(DataFrame.union, done), top), "best")
    named = lookup_join(_with_texts(texts, best), totals, ["lang"])
    order = Window.partitionBy("name").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = named.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.select(F.col("name").alias("lang"), "rank", "phrase", "a", "l", "r", "n", "score")
