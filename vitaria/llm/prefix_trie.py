"""Prefix trie of conversations: which beginnings they share, and what sharing saves.

A node is a distinct sequence of first turns. It is known by its depth and two 64-bit
sums of its turns' hashes, each times a power of its place, so the key of every prefix is a
running sum. Running sums are made over ranges of the sorted turns and carried from range to
range, so a conversation of any length is spread over tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitaria.llm.contraction import subtree_sums
from vitaria.llm.session import let_workers_import
from vitaria.llm.words import powers
from vitaria.operators.joins import lookup_join
from vitaria.sinks.shared import keep_table

_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_ALL = (1 << 64) - 1
#: Ids joined in one row before they are hashed.
_IDS_AT_ONCE = 4096

_RANKED = "conv long, at long, s1 long, s2 long, p1 long, p2 long, bytes long"


def _uint(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy().astype(np.int64).view(np.uint64)


def _batch(**columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({n: pa.array(c.view(np.int64) if c.dtype == np.uint64 else c) for n, c in columns.items()})


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places and running sums of sorted turns, from the first turn of the conversation that lies in this range."""
    last, count, sums = None, 0, [np.uint64(0), np.uint64(0)]
    part = TaskContext.get().partitionId()
    for batch in batches:
        if not len(batch):
            continue
        conv = batch.column("conv").to_numpy()
        starts = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
        run = np.cumsum(np.r_[True, conv[1:] != conv[:-1]]) - 1
        carried = last == conv[0]
        at = np.arange(1, len(conv) + 1) - starts[run] + np.where(run == 0, count if carried else 0, 0)
        out = {"conv": conv, "at": at, "part": np.full(len(conv), part, np.int64)}
        for i, base in enumerate(_BASES):
            term = _uint(batch, f"r{i + 1}") * powers(base, int(at.max()) + 1)[at]
            total = np.cumsum(term, dtype=np.uint64)
            before = np.r_[np.uint64(0), total][starts][run]
            held = np.where(run == 0, sums[i] if carried else np.uint64(0), np.uint64(0)).astype(np.uint64)
            out[f"s{i + 1}"] = total - before + held
            out[f"p{i + 1}"] = out[f"s{i + 1}"] - term
            sums[i] = out[f"s{i + 1}"][-1]
        last, count = conv[-1], int(at[-1])
        yield _batch(**out, bytes=batch.column("bytes").to_numpy()).select(["conv", "part", "at", "s1", "s2", "p1", "p2", "bytes"])


def _carried(ends: list) -> dict[int, tuple[int, int, int, int]]:
    """``(conversation, turns, sums)`` that ranges of the turns begin after, for those that begin within a conversation."""
    held, found = None, {}
    for row in sorted(ends, key=lambda r: r["part"]):
        end, same = row["last"], held is not None and row["first"] == held[0]
        if same:
            found[row["part"]] = held
        if same and end["conv"] == held[0]:
            sums = [(h + pow(b, held[1], 1 << 64) * (s & _ALL)) & _ALL for h, b, s in zip(held[2:], _BASES, (end["s1"], end["s2"]), strict=True)]
            held = (held[0], held[1] + end["at"], *sums)
        else:
            held = (end["conv"], end["at"], end["s1"] & _ALL, end["s2"] & _ALL)
    return found


def _shift(carried: dict[int, tuple[int, int, int, int]]) -> Callable:
    """Places and sums from the conversation's very first turn on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            conv, part, at = (batch.column(n).to_numpy().copy() for n in ("conv", "part", "at"))
            sums = {n: _uint(batch, n).copy() for n in ("s1", "s2", "p1", "p2")}
            for own in np.unique(part).tolist():
                if own in carried:
                    first, count, *before = carried[own]
                    rows = (part == own) & (conv == first)
                    at[rows] += count
                    for n, values in sums.items():
                        i = int(n[1]) - 1
                        values[rows] = np.uint64(before[i]) + values[rows] * np.uint64(pow(_BASES[i], count, 1 << 64))
            yield _batch(conv=conv, at=at, **sums, bytes=batch.column("bytes").to_numpy())

    return run


def ranked_turns(turns: DataFrame) -> DataFrame:
    """``conv, at, s1, s2, p1, p2, bytes``: place of every turn, and the sums of the turns up to and before it.

    What passes through the driver is a row for each range of the sorted turns.
    """
    keys = turns.groupBy("conv", "turn").agg(F.count("*").alias("n"))
    tied = not keys.where("n > 1").isEmpty()  # only then the texts have to be sorted as well
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), *([F.col("role"), F.col("text")] if tied else [])]
    rows = turns.select(
        "conv", "turn", *(["role", "text"] if tied else []), F.octet_length("text").cast("long").alias("bytes"),
        F.xxhash64(F.lit(1), "role", "text").alias("r1"), F.xxhash64(F.lit(2), "text", "role").alias("r2"),
        F.monotonically_increasing_id().alias("row"),  # many equal rows don't have to share a range
    )
    spread = rows.repartitionByRange(*order, "row").sortWithinPartitions(*order).select("conv", "r1", "r2", "bytes")
    parted = "conv long, part long, at long, s1 long, s2 long, p1 long, p2 long, bytes long"
    local = keep_table(spread.mapInArrow(_running, parted), "turns")
    ends = local.groupBy("part").agg(F.min("conv").alias("first"), F.max(F.struct("conv", "at", "s1", "s2")).alias("last")).collect()
    carried = _carried(ends)
    return local.mapInArrow(_shift(carried), _RANKED) if carried else local.drop("part")


def _rebase(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of turns that follow ``taken`` other turns instead of ``skipped`` own ones."""
    for batch in batches:
        taken, skipped, at = (batch.column(n).to_numpy() for n in ("taken", "skipped", "at"))
        out = {"conv": batch.column("conv").to_numpy(), "depth": taken + at - skipped}
        for i, base in enumerate(_BASES):
            inverse = pow(base, -1, 1 << 64)
            back = np.array([pow(inverse, k, 1 << 64) for k in range(int((skipped - taken).max(initial=0)) + 1)], np.uint64)
            for to, of in (("k", "s"), ("p", "p")):
                own = _uint(batch, f"{of}{i + 1}") - _uint(batch, f"o{i + 1}")
                out[f"{to}{i + 1}"] = _uint(batch, f"b{i + 1}") + own * back[skipped - taken]
        found = _batch(**out, bytes=batch.column("bytes").to_numpy())
        yield found.append_column("last", pa.array(out["depth"] == batch.column("total").to_numpy()))


def rebuilt_prefixes(ranked: DataFrame, base: Column, heads: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Prefixes of conversations whose first turns are replaced by another's.

    The first ``heads`` turns of a conversation are those of conversation ``base``, both expressions over ``conv``;
    ``heads`` is at most ``most``. Gives ``conv, total`` for every conversation, and a row for each of its
    prefixes but the empty one: ``conv, depth, k1, k2, p1, p2, bytes, last``.
    """
    turn = F.struct("at", "s1", "s2", "p1", "p2", "bytes")
    convs = ranked.groupBy("conv").agg(
        F.max("at").alias("own"), F.sort_array(F.collect_list(F.when(F.col("at") <= most, turn))).alias("first")
    )
    convs = keep_table(convs.withColumns({"base": base, "h": heads.cast("long")}), "conversations")
    bases = convs.where("conv = base").select(F.col("conv").alias("base"), F.col("first").alias("of_base"), F.col("own").alias("base_own"))
    joined = convs.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_own", F.lit(0))))
    sums = {
        **{f"b{i}": F.coalesce(F.get("of_base", F.col("taken").cast("int") - 1)[f"s{i}"], F.lit(0)) for i in (1, 2)},
        **{f"o{i}": F.coalesce(F.get("first", F.col("h").cast("int") - 1)[f"s{i}"], F.lit(0)) for i in (1, 2)},
        "total": F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0)),
    }
    info = keep_table(joined.withColumns(sums), "conversations")
    nothing = [F.lit(0).cast("long").alias(n) for n in ("taken", "skipped", "b1", "b2", "o1", "o2")]
    taken = info.select("conv", "total", *nothing, F.explode(F.slice("of_base", F.lit(1), F.col("taken").cast("int"))).alias("t"))
    own = ["taken", F.col("h").alias("skipped"), "b1", "b2", "o1", "o2"]
    near = info.select("conv", "total", *own, F.explode(F.filter("first", lambda t: t["at"] > F.col("h"))).alias("t"))
    later = ranked.where(F.col("at") > most).select("conv", turn.alias("t"))  # only long conversations have these
    far = lookup_join(later, info.select("conv", "total", *own), ["conv"]).select(near.columns)
    spread = taken.union(near).union(far).select(*near.columns[:-1], "t.*")
    ddl = "conv long, depth long, k1 long, p1 long, k2 long, p2 long, bytes long, last boolean"
    names = ["conv", "depth", "k1", "p1", "k2", "p2", "bytes", "last"]
    prefixes = spread.mapInArrow(lambda batches: (b.select(names) for b in _rebase(batches)), ddl)
    return info.select("conv", "total"), prefixes


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of sorted rows joined by commas, some thousand in a row."""
    for batch in batches:
        keys = [batch.column(n).to_numpy() for n in ("depth", "k1", "k2")]
        conv = batch.column("conv").to_numpy()
        if not len(conv):
            continue
        new = np.r_[True, np.any([k[1:] != k[:-1] for k in keys], axis=0)]
        cuts = np.flatnonzero(new).tolist()
        edges = sorted({*cuts, *(x for a, b in zip(cuts, [*cuts[1:], len(conv)], strict=True) for x in range(a, b, _IDS_AT_ONCE))})
        joined = [",".join(map(str, conv[a:b].tolist())) for a, b in zip(edges, [*edges[1:], len(conv)], strict=True)]
        yield pa.RecordBatch.from_pydict({**{n: pa.array(k[edges]) for n, k in zip(("depth", "k1", "k2"), keys, strict=True)},
                                          "first": pa.array(conv[edges]), "ids": pa.array(joined, pa.string())})


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the joined ids of each node, read one after the other."""
    key, digest, rows = None, None, []
    for batch in batches:
        for *of, ids in zip(*(batch.column(n).to_pylist() for n in ("depth", "k1", "k2", "ids")), strict=True):
            if of != key:
                if key is not None:
                    rows.append((*key, digest.hexdigest()))
                key, digest = of, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        if len(rows) > 10_000:
            yield pa.RecordBatch.from_pydict(dict(zip(("depth", "k1", "k2", "digest"), map(list, zip(*rows, strict=True)), strict=True)))
            rows = []
    if key is not None:
        rows.append((*key, digest.hexdigest()))
        yield pa.RecordBatch.from_pydict(dict(zip(("depth", "k1", "k2", "digest"), map(list, zip(*rows, strict=True)), strict=True)))


def ends_digest(ends: DataFrame) -> DataFrame:
    """``depth, k1, k2, digest``: SHA-256 of the ids that end at each node, ascending, joined by commas.

    Ids are joined some thousand at a time in ranges; the rows that are left for a node are streamed through its hash.
    """
    keys = ["depth", "k1", "k2"]
    sorted_ids = ends.select(*keys, "conv").repartitionByRange("k1", "k2", "depth", "conv").sortWithinPartitions("k1", "k2", "depth", "conv")
    joined = sorted_ids.mapInArrow(_joined_ids, "depth long, k1 long, k2 long, first long, ids string")
    together = joined.repartition("k1", "k2", "depth").sortWithinPartitions("k1", "k2", "depth", "first")
    return together.mapInArrow(_digests, "depth long, k1 long, k2 long, digest string")


def prefix_trie(
    conversations: DataFrame,
    base: Callable[[Column], Column],
    heads: Callable[[Column], Column],
    *,
    most: int = 8,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """A row for each node of the trie of rebuilt conversations.

    Turns are ordered by ``turn`` (null first), those of one number by role and text. Every conversation begins with the first
    ``heads(conv_id)`` turns (``most`` at most) of conversation ``base(conv_id)``, fewer if it has fewer, followed by its
    own turns after as many. Columns: ``conv_id`` (least member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` (bytes of the last text once for every member but one, summed over the
    subtree) and ``ends_sha256``.

    A null role or text is empty. Rows without a conversation id belong to none and are left out; ids that are no whole
    numbers are an error. Repeated rows are turns of their own. An empty table has no node. Other columns are not read.
    """
    let_workers_import(conversations.sparkSession)
    turns = conversations.select(
        F.col(conv_id).cast("long").alias("conv"), F.col(turn).alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((role, "role"), (text, "text"))],
    ).where("conv is not null")
    convs, prefixes = rebuilt_prefixes(ranked_turns(turns), base(F.col("conv")), heads(F.col("conv")), most)
    prefixes = keep_table(prefixes, "prefixes")
    zero = F.lit(0).cast("long")
    root = convs.agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv_id")).where("n_convs > 0")
    places = ["depth", "k1", "k2", "p1", "p2", "bytes"]
    nodes = prefixes.groupBy(*places).agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv_id"))
    nodes = nodes.union(root.select(*[zero.alias(c) for c in places], "n_convs", "conv_id"))
    nodes = keep_table(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    above = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("node").alias("parent"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    linked = keep_table(lookup_join(nodes, above, ["depth", "p1", "p2"]), "nodes")
    kids = linked.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    linked = linked.join(kids, "node", "left").withColumn("n_children", F.coalesce("n_children", zero))
    counted = linked.select(
        "node", "parent", "depth", (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens"),
    )
    sums = subtree_sums(counted, ["n_leaves", "saved_tokens"])
    ends = prefixes.where("last").select("depth", "k1", "k2", "conv").union(convs.where("total = 0").select(zero, zero, zero, "conv"))
    found = linked.join(sums, "node").join(ends_digest(ends), ["depth", "k1", "k2"], "left")
    none = F.lit(hashlib.sha256().hexdigest())
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("digest", none).alias("ends_sha256"),
    )
