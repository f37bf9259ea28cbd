"""SimHash near-duplicates by anchor-point covering.

The bits of a fingerprint are parted into ``threshold // 2 + 1`` blocks, so that two
linked fingerprints differ by at most one bit in some block. The anchors of a
block are the words of a covering code: a perfect Hamming code on its first 15
bits times all words on the rest, which leaves no word further than one bit from
an anchor. A fingerprint's home is its nearest anchor, and it is copied to every
anchor within the covering radius plus one. Homes are compared with copies, anchor
by anchor, on all 64 bits.

Near copies by a similarity of their shingles are found in the same way, with wide
fingerprints of as many blocks as it takes for one to agree within a bit, and are
held against their texts before they count.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from vitaria.llm.components import components
from vitaria.llm.session import let_workers_import
from vitaria.llm.words import hash_spans, hash_windows, mix, spans
from vitaria.operators.joins import HOT_ROWS, BroadcastBound, lookup_join
from vitaria.sinks.shared import keep_table

BITS = 64
CODE_BITS = 15
#: Homes of one anchor compared in one task; more are dealt to several.
HOMES_PER_PART = 2048
#: Shingles of the texts of a cluster that are homes in one task.
SHINGLES_PER_PART = 1 << 21
_COPIES_AT_ONCE = 1024
_ROWS_AT_ONCE = 1 << 18
#: Blocks of a wide fingerprint, in 64-bit numbers of four each. Of two texts of the
#: least similarity 0.8 some block differs by at most a bit with probability 0.93.
WIDE_BLOCKS = 8
WIDE_BITS = 16
_SEEDS = np.array([0x243F6A8885A308D3, 0x13198A2E03707344], np.uint64)

# bit i of a code word counts as number i + 1; a word is in the code if its numbers' XOR is 0
_SYNDROME = np.zeros(1 << CODE_BITS, np.uint8)
for _bit in range(CODE_BITS):
    _SYNDROME[1 << _bit : 2 << _bit] = _SYNDROME[: 1 << _bit] ^ np.uint8(_bit + 1)


def fingerprint(text: str | None, shingle: int) -> int:
    """64 majority bits of the hashes of all shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    data, hash64 = b" ".join(words), xxhash.xxh64_intdigest
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    size = min(shingle, len(words))
    last = len(words) - size + 1
    spans = zip(starts[:last].tolist(), ends[size - 1 :].tolist(), strict=True)
    hashes = np.fromiter((hash64(data[a:b], 42) for a, b in spans), np.uint64, last)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, last, 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > last, bitorder="little").view(np.uint64)[0])


def fingerprints(text, shingle: int):
    """Column of fingerprints as signed 64-bit numbers."""

    @pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    return run(text)


def _blocks(threshold: int) -> list[tuple[int, int]]:
    """First bit and width of each block."""
    edges = np.linspace(0, BITS, threshold // 2 + 2).round().astype(int)
    return [(int(a), int(b - a)) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _near_anchors(values: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """``(rows, anchors, home)``: anchors at distance two or less of block values, and first their homes."""
    code_bits = min(width, CODE_BITS)
    if code_bits < CODE_BITS:  # a block too short for the code: every value is an anchor
        yield np.arange(len(values)), values, True
        masks = [0, *(1 << i for i in range(width)), *((1 << i) | (1 << j) for i in range(width) for j in range(i))]
        for mask in masks:
            yield np.arange(len(values)), values ^ np.uint64(mask), False
        return
    syndromes = _SYNDROME[values & np.uint64((1 << CODE_BITS) - 1)]
    free = [1 << i for i in range(CODE_BITS, width)]
    for syndrome in range(CODE_BITS + 1):
        rows = np.flatnonzero(syndromes == syndrome)
        if not len(rows):
            continue
        some = values[rows]
        home = (1 << (syndrome - 1)) if syndrome else 0
        yield rows, some ^ np.uint64(home), True
        if syndrome:
            pairs = [(i, i ^ syndrome) for i in range(1, CODE_BITS + 1) if i < i ^ syndrome]
            masks = [home, *(1 << (i - 1) | 1 << (j - 1) for i, j in pairs), *(home | bit for bit in free)]
        else:
            masks = [0, *free, *(a | b for a in free for b in free if a < b)]
        for mask in masks:
            yield rows, some ^ np.uint64(mask), False


def _spread(threshold: int):
    """Rows ``anchor, home, print`` of every fingerprint."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            prints = batch["print"].to_numpy().view(np.uint64)
            for number, (first, width) in enumerate(_blocks(threshold)):
                values = (prints >> np.uint64(first)) & np.uint64((1 << width) - 1)
                for rows, anchors, home in _near_anchors(values, width):
                    cell = anchors.astype(np.int64) * 64 + number
                    yield pd.DataFrame({"anchor": cell, "home": home, "print": prints[rows].view(np.int64)})

    return run


def _compare(threshold: int):
    """Links between homes and copies; rows come by anchor and part, homes first.

    Of a block of homes and copies that hang together only a star is emitted, so
    the links are never more than the rows compared.
    """

    def linked(homes: np.ndarray, copies: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for at in range(0, len(homes), HOMES_PER_PART):
            own = homes[at : at + HOMES_PER_PART]
            for start in range(0, len(copies), _COPIES_AT_ONCE):
                others = copies[start : start + _COPIES_AT_ONCE]
                near = np.bitwise_count(own[:, None] ^ others[None, :]) <= threshold
                if np.count_nonzero(near) == np.count_nonzero(np.isin(others, own)):
                    continue  # none but a fingerprint with itself
                labels, none = np.arange(len(own)), len(own)
                while True:
                    met = np.where(near, labels[:, None], none).min(axis=0)
                    now = np.minimum(labels, np.where(near, met[None, :], none).min(axis=1))
                    if (now == labels).all():
                        break
                    labels = now
                found = met < none
                yield np.concatenate([own, others[found]]), np.concatenate([own[labels], own[met[found]]])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, homes = None, np.empty(0, np.uint64)
        for batch in batches:
            keys = batch[["anchor", "part"]].to_numpy()
            prints, home = batch["print"].to_numpy().view(np.uint64), batch["home"].to_numpy()
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1), len(keys)]
            lows, highs = [], []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if current != (key := tuple(keys[a])):
                    current, homes = key, np.empty(0, np.uint64)
                here = home[a:b]
                if here.any():
                    homes = np.concatenate([homes, prints[a:b][here]])
                for high, low in linked(homes, prints[a:b][~here]) if len(homes) else ():
                    highs.append(high)
                    lows.append(low)
            if highs:
                pairs = pd.DataFrame({"a": np.concatenate(highs).view(np.int64), "b": np.concatenate(lows).view(np.int64)})
                yield pairs[pairs["a"] != pairs["b"]].drop_duplicates()

    return run


def near_links(prints: DataFrame, threshold: int) -> DataFrame:
    """Links ``a, b`` that join all distinct fingerprints (column ``print``) at ``threshold`` or fewer bits.

    Only enough links are returned to hang together what does, not all pairs. An
    anchor with many homes is dealt to several parts by its homes, each with all copies.
    """
    spread = prints.mapInPandas(_spread(threshold), "anchor long, home boolean, print long")
    spread = keep_table(spread, "anchors")
    wide = spread.where("home").groupBy("anchor").count().where(F.col("count") > HOMES_PER_PART)
    wide = wide.select("anchor", F.ceil(F.col("count") / HOMES_PER_PART).cast("int").alias("parts"))
    dealt = spread.join(wide, "anchor", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.array(F.pmod(F.xxhash64("print"), F.col("parts")).cast("int"))
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    dealt = dealt.select("anchor", F.explode(F.when(F.col("home"), own).otherwise(every)).alias("part"), "home", "print")
    dealt = dealt.repartition("anchor", "part").sortWithinPartitions("anchor", "part", F.desc("home"))
    return dealt.mapInPandas(_compare(threshold), "a long, b long")


def simhash_groups(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, threshold: int = 4
) -> DataFrame:
    """``doc_id, print, component_id`` for every row: fingerprint and the least id of its group.

    A-Z is lower-cased; words are parted by ASCII white space; a text of fewer
    words than a shingle is one shingle; null and empty texts have fingerprint 0
    and link like any other. Rows with a null id have a fingerprint and a group
    too, but the null is never a group's id unless it has no other. Repeated rows
    come out as often as they go in; an empty table gives an empty one.
    """
    if not 0 <= threshold < 2 * BITS // CODE_BITS:
        raise ValueError("threshold needs blocks of fewer than 15 bits")
    let_workers_import(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), fingerprints(F.col(text), shingle).alias("print"))
    rows = keep_table(rows, "fingerprints")
    classes = keep_table(rows.groupBy("print").agg(F.min("doc_id").alias("least_id")), "classes")
    found = components(near_links(classes.select("print"), threshold))
    labelled = classes.join(found, F.col("print") == F.col("node"), "left")
    labelled = labelled.select("print", "least_id", F.coalesce("component", "print").alias("component"))
    ids = labelled.groupBy("component").agg(F.min("least_id").alias("component_id"))
    return rows.join(labelled.select("print", "component").join(ids, "component"), "print").select(
        "doc_id", "print", "component_id"
    )


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles; of fewer words the one of them all, of none none."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass").lower(), np.uint8)
    hashes = hash_spans(data, *spans(data))
    return np.unique(hash_windows(hashes, min(shingle, len(hashes)))) if len(hashes) else hashes


def wide_print(shingles: np.ndarray) -> np.ndarray:
    """Majority bits of the hashes of distinct shingles, as signed 64-bit numbers."""
    words = np.empty(len(_SEEDS), np.int64)
    for number, seed in enumerate(_SEEDS):
        counts = np.zeros(BITS, np.int64)
        for at in range(0, len(shingles), 1 << 16):
            hashes = mix(shingles[at : at + (1 << 16)] ^ seed)
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.int64)
        words[number] = np.packbits(2 * counts > len(shingles), bitorder="little").view(np.int64)[0]
    return words


def most_bits(similarity: float) -> int:
    """Bits by which wide fingerprints of texts of a similarity differ at most, but for one pair in a thousand."""
    bits = WIDE_BLOCKS * WIDE_BITS
    part = math.acos(min(1.0, 2 * similarity / (1 + similarity))) / math.pi
    return math.ceil(bits * part + 3.1 * math.sqrt(bits * part * (1 - part)))


def _set_of(text, shingle: int):
    """Column ``key, p0, p1, n``: name of a text's set of shingles, its wide fingerprint, and its size."""

    @pandas_udf("key string, p0 long, p1 long, n long")
    def run(texts: pd.Series) -> pd.DataFrame:
        sets = [shingle_set(t, shingle) for t in texts]
        prints = np.array([wide_print(x) for x in sets], np.int64).reshape(-1, len(_SEEDS))
        keys = [xxhash.xxh3_128_hexdigest(x.tobytes()) for x in sets]
        return pd.DataFrame({"key": keys, "p0": prints[:, 0], "p1": prints[:, 1], "n": [len(x) for x in sets]})

    return run(text)


def _wide_spread(names: list[str], homes_only: bool):
    """Rows ``anchor, home`` and the named columns of every wide fingerprint."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            prints = batch[names].to_numpy(np.int64)
            for number in range(WIDE_BLOCKS):
                word, first = divmod(number * WIDE_BITS, BITS)
                values = (prints[:, word].astype(np.uint64) >> np.uint64(first)) & np.uint64((1 << WIDE_BITS) - 1)
                for rows, anchors, home in _near_anchors(values, WIDE_BITS):
                    if home or not homes_only:
                        cell = anchors.astype(np.int64) * WIDE_BLOCKS + number
                        yield pd.DataFrame({"anchor": cell, "home": home} | {n: prints[rows, i] for i, n in enumerate(names)})

    return run


def _differing(homes: np.ndarray, copies: np.ndarray, at_once: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Some homes and some copies at a time, and the bits by which each of these differ."""
    for at in range(0, len(homes), HOMES_PER_PART):
        own = homes[at : at + HOMES_PER_PART]
        for start in range(0, len(copies), at_once):
            others = copies[start : start + at_once]
            differing = (own[:, None, word] ^ others[None, :, word] for word in range(len(_SEEDS)))
            # of signed numbers it counts those of the amount
            yield own, others, sum(np.bitwise_count(x.view(np.uint64)) for x in differing)


def _stars(limit: int):
    """Links that join what hangs together by homes and copies within ``limit`` bits, never more than the rows compared."""

    def found(homes: np.ndarray, copies: np.ndarray) -> Iterator[np.ndarray]:
        for own, others, bits in _differing(homes, copies, _COPIES_AT_ONCE):
            near = bits <= limit
            apart = near & (bits > 0)  # none but a fingerprint with itself otherwise
            rows, met = np.flatnonzero(apart.any(axis=1)), np.flatnonzero(apart.any(axis=0))
            if not len(met):
                continue
            near, labels = near[np.ix_(rows, met)], np.arange(len(rows))
            while True:
                least = np.where(near, labels[:, None], len(rows)).min(axis=0)
                now = np.minimum(labels, np.where(near, least[None, :], len(rows)).min(axis=1))
                if (now == labels).all():
                    break
                labels = now
            own, others = own[rows], others[met]
            links = np.column_stack([np.concatenate([own, others]), np.concatenate([own[labels], own[least]])])
            yield links[(links[:, : len(_SEEDS)] != links[:, len(_SEEDS) :]).any(axis=1)]

    return found


def _meet(prints: DataFrame, found, columns: list[str]) -> DataFrame:
    """Rows that ``found`` gives for the homes and the copies of each anchor, by the columns of ``prints``.

    An anchor with many homes is dealt to several parts by its homes, each with all copies.
    """
    names = prints.columns
    ddl = "anchor long, home boolean, " + ", ".join(f"{n} long" for n in names)
    homes = prints.mapInPandas(_wide_spread(names, True), ddl)
    wide = homes.groupBy("anchor").count().where(F.col("count") > HOMES_PER_PART)
    wide = wide.select("anchor", F.ceil(F.col("count") / HOMES_PER_PART).cast("int").alias("parts"))
    spread = prints.mapInPandas(_wide_spread(names, False), ddl)
    # 4,096 anchors a block, so no more than 32,768 rows
    dealt = spread.join(F.broadcast(wide), "anchor", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.array(F.pmod(F.xxhash64(*names), F.col("parts")).cast("int"))
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    dealt = dealt.select("anchor", F.explode(F.when(F.col("home"), own).otherwise(every)).alias("part"), "home", *names)
    dealt = dealt.repartition("anchor", "part").sortWithinPartitions("anchor", "part", F.desc("home"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, homes = None, np.empty((0, len(names)), np.int64)
        for batch in batches:
            keys, home = batch[["anchor", "part"]].to_numpy(), batch["home"].to_numpy()
            values = batch[names].to_numpy(np.int64)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1), len(keys)]
            rows, held = [], 0
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if current != (key := tuple(keys[a])):
                    current, homes = key, np.empty((0, len(names)), np.int64)
                here = home[a:b]
                if here.any():
                    homes = np.concatenate([homes, values[a:b][here]])
                for some in found(homes, values[a:b][~here]) if len(homes) and not here.all() else ():
                    rows.append(some)
                    held += len(some)
                    if held > _ROWS_AT_ONCE:
                        yield pd.DataFrame(np.concatenate(rows), columns=columns)
                        rows, held = [], 0
            if rows:
                yield pd.DataFrame(np.concatenate(rows), columns=columns)

    return dealt.mapInPandas(run, ", ".join(f"{c} long" for c in columns))


class _Homes:
    """Texts of one part of a cluster, against which all texts of the cluster are held."""

    def __init__(self, similarity: float, limit: int):
        self.similarity, self.limit = similarity, limit
        self.names: list[str] = []
        self.prints, self.sizes = np.empty((0, len(_SEEDS)), np.uint64), np.empty(0, np.int64)
        self.labels = np.empty(0, np.int64)
        self.shingles, self.owners, self.sorted = np.empty(0, np.uint64), np.empty(0, np.int32), True

    def add(self, names: list[str], prints: np.ndarray, sets: list[np.ndarray]) -> None:
        numbers = np.arange(len(self.names), len(self.names) + len(names))
        sizes = np.array([len(x) for x in sets], np.int64)
        self.names += names
        self.prints, self.sizes = np.concatenate([self.prints, prints]), np.r_[self.sizes, sizes]
        self.labels = np.r_[self.labels, numbers]
        self.shingles = np.concatenate([self.shingles, *sets])
        self.owners = np.r_[self.owners, np.repeat(numbers, sizes).astype(np.int32)]
        self.sorted = False

    def shared(self, shingles: np.ndarray) -> np.ndarray:
        """How many of the shingles each home has."""
        if not self.sorted:
            order = np.argsort(self.shingles, kind="stable")
            self.shingles, self.owners, self.sorted = self.shingles[order], self.owners[order], True
        start = np.searchsorted(self.shingles, shingles)
        each = np.searchsorted(self.shingles, shingles, side="right") - start
        at = np.repeat(start - (np.cumsum(each) - each), each) + np.arange(each.sum())
        return np.bincount(self.owners[at], minlength=len(self.names))

    def links(self, name: str, number: int, wide: np.ndarray, shingles: np.ndarray) -> list[tuple[str, str]]:
        """A link of a text to one home of each group that it joins; ``number`` is its own among the homes, or -1.

        Homes of the text's own group need not be compared any more.
        """
        size, label = len(shingles), self.labels[number] if number >= 0 else -1
        near = (np.bitwise_count(self.prints ^ wide).sum(axis=1) <= self.limit) & (self.labels != label)
        near &= np.minimum(self.sizes, size) >= (self.similarity - 1e-9) * np.maximum(self.sizes, size)
        if not near.any():
            return []
        same = self.shared(shingles)
        alike = np.flatnonzero(near & (same / np.maximum(1, self.sizes + size - same) >= self.similarity))
        met, first = np.unique(self.labels[alike], return_index=True)
        if number >= 0:
            met = np.append(met, label)
        if len(met):
            self.labels[np.isin(self.labels, met)] = met.min()
        return [(self.names[i], name) for i in alike[first]]


def _alike(shingle: int, similarity: float, limit: int):
    """Links between texts of a cluster that are alike; rows come by cluster and part, homes first.

    Every text is held against the homes of its part, itself a home or not. Of texts that hang
    together only as many links are emitted as join them.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, homes = None, _Homes(similarity, limit)
        for batch in batches:
            keys, home, names = batch[["cluster", "part"]].to_numpy(), batch["home"].to_numpy(), batch["key"].tolist()
            prints = batch[["p0", "p1"]].to_numpy(np.int64).view(np.uint64)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1), len(keys)]
            found = []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if current != (key := tuple(keys[a])):
                    current, homes = key, _Homes(similarity, limit)
                before, own = len(homes.names), int(home[a:b].sum())
                sets = [shingle_set(t, shingle) for t in batch["text"].iloc[a : a + own]]
                if own:
                    homes.add(names[a : a + own], prints[a : a + own], sets)
                for i in range(a, b):
                    number = before + i - a if i < a + own else -1
                    shingles = sets[i - a] if i < a + own else shingle_set(batch["text"].iat[i], shingle)
                    found += homes.links(names[i], number, prints[i], shingles)
            if found:
                yield pd.DataFrame(found, columns=["a", "b"])

    return run


def _clusters(sets: DataFrame, limit: int, bound: BroadcastBound, hot_rows: int) -> DataFrame:
    """Sets with ``cluster`` and ``parts``: all that hang together by candidates, those alone in their cluster left out.

    A cluster's number is a hash, so two may have the same, which only brings them together to be compared.
    """
    prints = keep_table(sets.select("p0", "p1").distinct(), "prints")
    near = _meet(prints, _stars(limit), ["p0", "p1", "q0", "q1"])
    near = near.select(F.xxhash64("p0", "p1").alias("a"), F.xxhash64("q0", "q1").alias("b"))
    found = components(near, bound, hot_rows)
    placed = sets.withColumn("own", F.xxhash64("p0", "p1"))
    placed = lookup_join(placed, found.toDF("own", "cluster"), ["own"], bound, hot_rows=hot_rows)
    placed = keep_table(placed.withColumn("cluster", F.coalesce("cluster", "own")).drop("own"), "placed")
    sizes = placed.groupBy("cluster").agg(F.count("*").alias("held"), F.sum("n").alias("shingles")).where("held > 1")
    parts = F.greatest(F.lit(1), F.ceil(F.col("shingles") / SHINGLES_PER_PART)).cast("int")
    sizes = keep_table(sizes.select("cluster", parts.alias("parts")), "sizes")
    return lookup_join(placed, sizes, ["cluster"], bound, hot_rows=hot_rows).where("parts is not null")


def near_copy_groups(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = 5,
    similarity: float = 0.8,
    bound: BroadcastBound = BroadcastBound(),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``doc_id, component_id`` for every row: the least id of its group of near copies.

    Two texts are linked if the Jaccard similarity of their sets of word shingles (A-Z
    lower-cased) is at least ``similarity``, found by comparing their words. Candidates are those whose wide fingerprints
    share an anchor and differ by at most :func:`most_bits`. What hangs together by candidates is a cluster, and its
    texts meet in one task, or in several if they are many, each with some of them as homes and with all of them. There
    all pairs within that many bits are compared, unless links found before have joined them; pairs are never written
    out. A link is missed only if no chain of candidates leads from one text to the other (at most 7 %
    of pairs of similarity 0.8, 0.4 % at 0.9) or they differ by more bits.

    Texts of equal shingles are one group, null, empty and blank texts too; a text of fewer words
    than a shingle is one shingle. Rows with a null id have a group, but
    the null is never its id unless it has no other. Repeated rows come out as often as they go
    in; an empty table gives an empty one.
    """
    let_workers_import(docs.sparkSession)
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    texts = texts.withColumn("hash", F.md5("text"))
    rows = texts.select("doc_id", "hash", _set_of(F.col("text"), shingle).alias("set")).select("doc_id", "hash", "set.*")
    rows = keep_table(rows, "sets")
    firsts = [F.min(c).alias(a) for c, a in (("doc_id", "least_id"), ("hash", "hash"), ("p0", "p0"), ("p1", "p1"), ("n", "n"))]
    sets = keep_table(rows.groupBy("key").agg(*firsts), "classes")
    limit = most_bits(similarity)
    met = keep_table(_clusters(sets.select("key", "hash", "p0", "p1", "n"), limit, bound, hot_rows), "clusters")
    held = lookup_join(texts.select("hash", "text"), met, ["hash"], bound, hot_rows=hot_rows).where("key is not null")
    held = held.groupBy("key", "cluster", "parts", "p0", "p1").agg(F.min("text").alias("text"))
    dealt = held.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.withColumn("home", F.col("part") == F.pmod(F.xxhash64("key"), F.col("parts"))).drop("parts")
    dealt = dealt.repartition("cluster", "part").sortWithinPartitions("cluster", "part", F.desc("home"))
    linked = components(dealt.mapInPandas(_alike(shingle, similarity, limit), "a string, b string"), bound, hot_rows)
    labelled = sets.join(linked, F.col("key") == F.col("node"), "left")
    labelled = labelled.select("key", "least_id", F.coalesce("component", "key").alias("component"))
    ids = labelled.groupBy("component").agg(F.min("least_id").alias("component_id"))
    return rows.join(labelled.select("key", "component").join(ids, "component"), "key").select("doc_id", "component_id")


def keep_one(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """One row of each group of :func:`near_copy_groups`: that of the least id, the least text hash among rows of one id.

    Of equal rows one stays. Rows whose id is null stay only if their group has no id.
    """
    named = F.concat_ws(" ", F.col(doc_id).isNull().cast("string"), F.col(doc_id).cast("string"), F.md5(F.coalesce(F.col(text), F.lit(""))))
    keyed = docs.withColumn("near_key", named)
    key = F.struct(F.col(doc_id).isNull().alias("missing"), F.col(doc_id).alias("id"), "near_key").alias("doc_id")
    groups = near_copy_groups(keyed.select(key, F.col(text).alias("text")), shingle=shingle, similarity=similarity)
    stay = groups.select(F.col("component_id.near_key").alias("near_key")).distinct()
    return keyed.join(stay, "near_key", "left_semi").dropDuplicates(["near_key"]).drop("near_key")
