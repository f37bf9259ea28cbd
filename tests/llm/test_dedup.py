import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.conftest import SCHEMA, awkward_rows, sentence, words
from vitaria.llm import simhash
from vitaria.llm.components import components
from vitaria.llm.exchange import pack, part_cuts, unpack
from vitaria.llm.simhash import (
    _SYNDROME, _blocks, _near_anchors, fingerprint, keep_one, most_bits, near_copy_groups, near_links, shingle_set, simhash_groups, wide_print,
)
from vitaria.llm.substrings import mark_repeats
from vitaria.llm.words import hash_spans, hash_windows, spans
from vitaria.operators.joins import BroadcastBound


def brute_fingerprint(text):
    w = words(text.lower() if text and text.isascii() else text)
    w = [bytes(b + 32 if 65 <= b <= 90 else b for b in x) for x in w]
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 4]), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(pairs, nodes):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_anchors_cover():
    """Every word is within one bit of its home, and homes of words one bit apart are among the copies."""
    values = np.random.default_rng(1).integers(0, 1 << 22, 300).astype(np.uint64)
    for width in (13, 15, 21, 22):
        part = values & np.uint64((1 << width) - 1)
        homes, copies = {}, defaultdict(set)
        for rows, anchors, home in _near_anchors(part, width):
            for r, a in zip(rows.tolist(), anchors.tolist(), strict=True):
                if home:
                    homes[r] = a
                else:
                    copies[r].add(a)
        for r, value in enumerate(part.tolist()):
            assert (homes[r] ^ value).bit_count() <= 1 and all((a ^ value).bit_count() <= 2 for a in copies[r])
            near = np.array([value] + [value ^ 1 << i for i in range(width)], np.uint64)
            assert {int(a) for _, found, home in _near_anchors(near, width) if home for a in found} <= copies[r]
    assert _SYNDROME[0] == 0 and sum(b for _, b in _blocks(4)) == 64 and len(_blocks(4)) == 3


@pytest.mark.parametrize("threshold", [0, 2, 4, 5])
def test_links_lose_nothing(spark, threshold):
    rng = np.random.default_rng(threshold)
    centres = rng.integers(0, 1 << 63, 12).tolist()
    prints = set(rng.integers(0, 1 << 63, 200).tolist())
    for c in centres:  # chains and dense groups
        for _ in range(25):
            for bit in rng.integers(0, 64, int(rng.integers(1, 6))).tolist():
                c ^= 1 << bit
            prints.add(c)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = near_links(spark.createDataFrame([(p,) for p in signed], "print long"), threshold).collect()
    every = [(a, b) for i, a in enumerate(signed) for b in signed[:i] if (prints[i] ^ (b % (1 << 64))).bit_count() <= threshold]
    assert classes([tuple(r) for r in links], signed) == classes(every, signed)


def test_components(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1100)] + [(5, 5), (-3, 2000)]
    found = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    expected = classes(chain, {n for pair in chain for n in pair})
    assert found == expected
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_groups_equal_brute_force(docs):
    rows = [r for r in awkward_rows()]
    prints = [brute_fingerprint(t) for _, t, *_ in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    label = classes(pairs, range(len(rows)))
    least = {}
    for i, (doc_id, *_) in enumerate(rows):
        if doc_id is not None:
            least[label[i]] = min(least.get(label[i], doc_id), doc_id)
    expected = sorted(((r[0], prints[i], least.get(label[i])) for i, r in enumerate(rows)), key=str)
    found = sorted(((r.doc_id, r.print % (1 << 64), r.component_id) for r in simhash_groups(docs).collect()), key=str)
    assert found == expected


def brute_shingles(text, size=5):
    w = [bytes(b + 32 if 65 <= b <= 90 else b for b in x) for x in words(text)]
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def near_classes(texts, similarity=0.8):
    """Label of each text: texts are linked at this Jaccard similarity of their shingles, equal sets always."""
    sets = [brute_shingles(t) for t in texts]
    alike = lambda x, y: x == y or len(x & y) >= similarity * len(x | y)
    return classes([(i, j) for i in range(len(sets)) for j in range(i) if alike(sets[i], sets[j])], range(len(sets)))


def least_ids(rows, label):
    least = {}
    for i, (doc_id, *_) in enumerate(rows):
        if doc_id is not None:
            least[label[i]] = min(least.get(label[i], doc_id), doc_id)
    return sorted(((r[0], least.get(label[i])) for i, r in enumerate(rows)), key=str)


def edited(rng, text, share):
    """Some words replaced one by one."""
    w = text.split(" ")
    for i in rng.sample(range(len(w)), int(share * len(w))):
        w[i] = f"new{rng.randrange(10**9)}"
    return " ".join(w)


def test_near_copies_equal_brute_force(docs):
    rows = awkward_rows()
    found = sorted(map(tuple, near_copy_groups(docs).collect()), key=str)
    assert found == least_ids(rows, near_classes([t for _, t, *_ in rows]))


@pytest.mark.parametrize("bound,hot_rows", [(BroadcastBound(), 10**6), (BroadcastBound(0, 0), 20)])
def test_a_large_group_of_near_copies_hangs_together(spark, bound, hot_rows):
    """Joined by broadcast, and by a shuffle in which the text that all link to is a hot key."""
    rng = random.Random(4)
    base = sentence(rng, 400)
    rows = [(i, edited(rng, base, 0.01)) for i in range(150)] + [(200 + i, sentence(rng, 200)) for i in range(50)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = dict(map(tuple, near_copy_groups(frame, bound=bound, hot_rows=hot_rows).collect()))
    assert found == {i: 0 if i < 150 else i for i, _ in rows}


def test_near_copies_are_found_and_no_others(spark):
    rng = random.Random(8)
    rows, like, unlike = [], [], []
    for i in range(0, 800, 2):
        text = sentence(rng, 300)
        other = edited(rng, text, rng.choice([0.01, 0.018, 0.02, 0.03]))
        x, y = brute_shingles(text), brute_shingles(other)
        (like if len(x & y) >= 0.8 * len(x | y) else unlike).append(i)
        rows += [(i, text), (i + 1, other)]
    found = dict(map(tuple, near_copy_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert sum(found[i + 1] == i for i in like) >= 0.9 * len(like) and len(like) > 100
    assert all(found[i + 1] == i + 1 for i in unlike) and len(unlike) > 50


def test_no_link_is_lost_behind_nearer_texts(spark):
    """Families in which a text's nearest and least candidates are often too unlike, and another is not."""
    rng, rows = random.Random(21), []
    for _ in range(8):
        base = sentence(rng, 300)
        rows += [(len(rows) + i, edited(rng, base, rng.choice([0.01, 0.013, 0.016, 0.02, 0.023]))) for i in range(20)]
    label = near_classes([t for _, t in rows])
    found = dict(map(tuple, near_copy_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()))
    assert found == label and 8 < len(set(label.values())) < len(rows) - 8


def family(rng, size):
    """Texts of one base, many of them too unlike each other to be near copies."""
    base = sentence(rng, 150)
    return [(i, edited(rng, base, rng.choice([0.014, 0.02, 0.027, 0.034, 0.04]))) for i in range(size)]


def test_a_family_is_never_written_in_pairs(spark, monkeypatch):
    rows, counts, kept = family(random.Random(5), 250), {}, simhash.keep_table

    def keep(df, name):
        table = kept(df, name)
        counts[name] = max(counts.get(name, 0), table.count())
        return table

    monkeypatch.setattr(simhash, "keep_table", keep)
    found = dict(map(tuple, near_copy_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()))
    assert found == near_classes([t for _, t in rows]) and 10 < len(set(found.values())) < 240
    assert max(counts.values()) <= 2 * len(rows), counts


def test_clusters_dealt_to_several_tasks_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHINGLES_PER_PART", 2000)
    rows = family(random.Random(6), 120)
    found = dict(map(tuple, near_copy_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()))
    assert found == near_classes([t for _, t in rows])


def test_wide_fingerprints():
    assert len(shingle_set(None, 5)) == len(shingle_set(" \n", 5)) == 0 and not wide_print(shingle_set("", 5)).any()
    assert len(shingle_set("One two", 5)) == 1 and (shingle_set("one  TWO", 5) == shingle_set("One two", 5)).all()
    text = sentence(random.Random(1), 200_000)
    assert len(shingle_set(text, 5)) == len(brute_shingles(text))
    assert most_bits(1.0) == 0 and most_bits(0.9) < most_bits(0.8) < 64


def test_one_of_each_group_stays(docs, empty, spark):
    rows = awkward_rows()
    expected = {i for _, i in least_ids(rows, near_classes([t for _, t, *_ in rows]))}
    kept = keep_one(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == expected
    assert kept.count() == len(expected) and len(rows) > len(expected)
    assert keep_one(empty).count() == 0 and simhash_groups(empty).count() == 0 and near_copy_groups(empty).count() == 0
    nulls = spark.createDataFrame([(None, "x", None, None, None)] * 3, SCHEMA)
    assert keep_one(nulls).count() == 1
    clash = docs.withColumns({n: F.lit(1) for n in ("print", "component_id", "node", "key", "p0", "p1", "hash", "least_id")})
    assert set(keep_one(clash).columns) == set(clash.columns)


def test_fingerprint_of_few_words():
    assert fingerprint(None, 4) == fingerprint(" \n", 4) == 0
    assert fingerprint("One two", 4) == xxhash.xxh64_intdigest(b"one two", 42)


def brute_repeats(rows, window):
    first = {}
    key = lambda i: (1 << 63) - 1 if i is None else i
    for doc_id, text, *_ in rows:
        w = words(text)
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            first[k] = min(first.get(k, key(doc_id)), key(doc_id))
    out = []
    for doc_id, text, *_ in rows:
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < key(doc_id):
                gone[i : i + window] = [True] * window
        out.append((doc_id, len(w), sum(gone), tuple(x for x, g in zip(w, gone, strict=True) if not g)))
    return sorted(out, key=str)


@pytest.mark.parametrize("window", [6, 50])
def test_repeats_equal_brute_force(docs, window):
    rows = mark_repeats(docs, window=window).collect()
    found = sorted(((r.doc_id, r.rep_words, r.rep_removed, tuple(words(r.rep_kept))) for r in rows), key=str)
    assert found == brute_repeats(awkward_rows(), window)
    for r in rows:
        assert sum(s.end - s.start for s in r.rep_spans) == r.rep_removed
        if not r.rep_removed:
            assert r.rep_kept == (r.text or "")


def test_repeats_edges(docs, empty):
    assert mark_repeats(empty).count() == 0
    clash = docs.withColumns({"rep_words": F.lit("x"), "piece": F.lit(1), "part": F.lit(2), "when": F.current_timestamp()})
    found = mark_repeats(clash)
    assert found.count() == docs.count() and {"piece", "part", "when"} <= set(found.columns)
    with pytest.raises(ValueError):
        mark_repeats(docs, window=7)


def test_hashes_do_not_depend_on_place():
    data = np.frombuffer(b"  alpha beta\tgamma alpha beta gamma \x0b", np.uint8)
    starts, ends = spans(data)
    hashes = hash_spans(data, starts, ends)
    assert [bytes(data[a:b]) for a, b in zip(starts, ends, strict=True)][:3] == [b"alpha", b"beta", b"gamma"]
    assert hashes[:3].tolist() == hashes[3:].tolist() and len(set(hashes.tolist())) == 3
    windows = hash_windows(hashes, 3)
    assert windows[0] == windows[3] and len(set(windows.tolist())) == 3
    long = np.frombuffer(b"ab " * (1 << 20), np.uint8)
    assert len(set(hash_spans(long, *spans(long)).tolist())) == 1


def test_packed_numbers_and_cuts():
    numbers = np.sort(np.random.default_rng(0).integers(0, 1 << 63, 1000).astype(np.uint64) * np.uint64(2))
    assert (unpack(pack(numbers), np.uint64) == numbers).all()
    cuts = list(part_cuts(numbers, 7))
    assert cuts[0][1] == 0 and cuts[-1][2] == 1000 and all(a[2] == b[1] for a, b in zip(cuts, cuts[1:], strict=False))


@pytest.mark.parametrize(("bound", "hot_rows"), [(BroadcastBound(), 1_000_000), (BroadcastBound(0, 0), 1_000_000), (BroadcastBound(0, 0), 40)])
def test_components_of_hubs(spark, bound, hot_rows):
    """Hubs by broadcast, by a shuffle, and dealt to several tasks come to the same."""
    hubs = [(i, 1000 * h) for h in (1, 2, 3) for i in range(1000 * h + 1, 1000 * h + 300)]
    links = [*hubs, (1299, 2299), (5000, 5001), (5002, 5001), (7, 7), (None, 3)]
    found = components(spark.createDataFrame(links, "a long, b long"), bound, hot_rows).collect()
    expected = {n: 1000 for n in (*range(1000, 1300), *range(2000, 2300))}
    expected |= {n: 3000 for n in range(3000, 3300)} | dict.fromkeys((5000, 5001, 5002), 5000)
    assert sorted((r.node, r.component) for r in found) == sorted(expected.items())
