"""Tree contraction and the prefix trie, against plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict
from pathlib import Path

from pyspark.sql import functions as F

from vitaria.llm.contraction import subtree_sums
from vitaria.llm.prefix_trie import _carried, prefix_trie, ranked_turns
from vitaria.sinks.shared import shared_dir

SCHEMA = "conv_id long, turn long, role string, text string, conv string, node int"
BASE, HEADS = (lambda c: c - c % 5), (lambda c: F.crc32(c.cast("string").cast("binary")) % 9)


def sums_of(parents, values):
    total = dict(values)
    for node in sorted(parents, reverse=True):  # parents have lesser numbers
        if parents[node] is not None:
            total[parents[node]] += total[node]
    return total


def trees():
    rng = random.Random(4)
    chain = {i: i - 1 if i else None for i in range(300)}
    star = {i: 0 if i else None for i in range(200)}
    caterpillar = {i: (None if i == 0 else max(0, (i - 1) // 2 * 2 - (0 if i % 2 else 0))) for i in range(200)}
    forest = {i: (None if i % 50 == 0 else rng.randint(max(0, i - 4), i - 1)) for i in range(400)}
    bushy = {i: (rng.randint(0, i - 1) if i else None) for i in range(300)}
    return {"chain": chain, "star": star, "caterpillar": caterpillar, "forest": forest, "bushy": bushy, "one": {0: None}}


def test_contraction_gives_every_subtree_total(spark):
    parents = {}
    for tree in trees().values():  # one forest of all
        at = len(parents)
        parents |= {at + n: None if p is None else at + p for n, p in tree.items()}
    depth = {}
    for node in sorted(parents):
        depth[node] = 0 if parents[node] is None else depth[parents[node]] + 1
    rows = [(n, p, depth[n], n % 7, None if n % 3 == 0 else n) for n, p in parents.items()]
    found = subtree_sums(spark.createDataFrame(rows, "node long, parent long, depth int, a int, b long"), ["a", "b"]).collect()
    assert len(found) == len(parents)
    assert {r.node: r.a for r in found} == sums_of(parents, {r[0]: r[3] for r in rows})
    assert {r.node: r.b for r in found} == sums_of(parents, {r[0]: r[4] or 0 for r in rows})


def test_contraction_of_nothing(spark):
    assert subtree_sums(spark.createDataFrame([], "node long, parent long, depth int, a int"), ["a"]).count() == 0


def conversations():
    rng = random.Random(11)
    rows = []
    for c in [*range(0, 60), 71, 83, 95, 99]:
        words = ["hello", "yes", "né"] if c % 3 else ["hello"]
        rows += [(c, i if i or c % 4 else None, rng.choice(["user", "assistant"] if c % 7 else ["user"]), rng.choice(words)) for i in range(rng.randint(1, 12))]
    rows += [(60, i, "user", "hello") for i in range(400)]  # a long one
    rows += [(61, 0, None, None), (61, 1, "user", ""), (62, 5, "b", "tie"), (62, 5, "a", "tie"), (62, 5, "a", "same"), (62, 5, "a", "same"),
             (None, 1, "user", "nobody"), (None, None, None, None), (120, None, "user", "x" * 5000)]
    rng.shuffle(rows)
    return rows


def trie_of(rows):
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            turns[c].append(((t is not None, t or 0), role or "", text or ""))
    turns = {c: [x[1:] for x in sorted(own)] for c, own in turns.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = turns.get(c - c % 5, [])[:h] + own[h:]
    members = defaultdict(list)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node, own in members.items():
        kids[node[:-1]] += bool(node)
        childless = not any(len(rebuilt[c]) > len(node) for c in own)
        cost = (len(own) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += childless
            saved[node[:d]] += cost
    out = []
    for node, own in members.items():
        ends = ",".join(map(str, sorted(c for c in own if len(rebuilt[c]) == len(node))))
        up = min(members[node[:-1]]) if node else None
        out.append((min(own), len(node), up, len(own), kids[node], leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def test_trie_as_in_plain_python(spark):
    rows = conversations()
    table = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(5)
    found = prefix_trie(table, BASE, HEADS)
    assert found.dtypes == [(c, "bigint") for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")] + [
        ("ends_sha256", "string")
    ]
    assert sorted(map(tuple, found.collect()), key=str) == trie_of(rows)


def test_trie_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_trie(empty, BASE, HEADS).count() == 0
    assert prefix_trie(spark.createDataFrame([(None, 1, "a", "b", "", 0)], SCHEMA), BASE, HEADS).count() == 0


def test_one_conversation_is_spread_over_tasks(spark):
    """A third of all rows are of one conversation, half of these alike; its places and sums go on from range to range."""
    rows = [(7, i // 2, "user", "same" if i % 2 else f"t{i}") for i in range(4000)] + [(c, 0, "user", "x") for c in range(100, 8100)]
    turns = spark.createDataFrame(rows, "conv long, turn long, role string, text string")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = ranked_turns(turns)
        own = ranked.where("conv = 7").orderBy("at").collect()
        kept = max(Path(shared_dir(spark)).glob("turns-*"), key=lambda p: p.stat().st_mtime)
        sizes = spark.read.parquet(str(kept)).groupBy("part").count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert [r["at"] for r in own] == list(range(1, 4001))
    assert all(a["s1"] == b["p1"] and a["s2"] == b["p2"] for a, b in zip(own, own[1:]))
    assert sizes < 2500  # 12,000 in eight ranges


def test_ranges_within_a_conversation_are_carried():
    part = lambda n, first, last, at, s: {"part": n, "first": first, "last": {"conv": last, "at": at, "s1": s, "s2": s}}
    found = _carried([part(2, 5, 5, 4, 9), part(0, 1, 5, 3, 2), part(4, 5, 6, 1, 1), part(5, 7, 7, 1, 1)])
    assert {n: c[:2] for n, c in found.items()} == {2: (5, 3), 4: (5, 7)}
