import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import awkward_rows
from vitaria.llm import lm
from vitaria.llm.classifier import Indexing, Network, _pooled, fit_network, score_quality, word_vectors
from vitaria.llm.lm import score_texts

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def tokens(text):
    return (text or "").encode().translate(_LOWER).split() + [b"\n"]


def test_scores_equal_brute_force_where_they_can(docs):
    known = docs.withColumn("learns", F.col("doc_id") % 3 != 0).withColumns({"piece": F.lit(1), "keys": F.lit(2)})
    rows = score_texts(known, "learns").collect()
    counts = Counter(t for i, text, *_ in awkward_rows() if i is not None and i % 3 for t in tokens(text))
    total, kinds = sum(counts.values()), len(counts)
    expected = []
    for i, text, *_ in awkward_rows():
        own = tokens(text)
        base = sum(math.log10((counts[t] + 1) / (total + kinds + 1)) for t in own)
        expected.append((i, len(own), sum(counts[t] > 0 for t in own), total, round(base, 6)))
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows) == Counter(expected)
    assert all(r.score < 0 and (r.bits_per_byte is None or r.bits_per_byte > 0) for r in rows)
    again = score_texts(known, "learns").collect()
    assert sorted(round(r.score, 6) for r in rows) == sorted(round(r.score, 6) for r in again)


def test_scores_beat_single_words_on_the_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = score_texts(docs.withColumn("learns", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2), "learns").collect()
    learned = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 7 != 2]
    assert sum(r.score for r in learned) > sum(r.base_score for r in learned)
    apart = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 7 == 2]
    bits = sum(r.bits_per_byte * r.n_tokens for r in apart if r.bits_per_byte) / sum(r.n_tokens for r in apart)
    assert bits < 3


def test_score_edges(docs, empty):
    assert score_texts(empty.withColumn("learns", F.lit(True)), "learns").count() == 0
    none = score_texts(docs.withColumn("learns", F.lit(None).cast("boolean")), "learns").collect()
    assert len(none) == docs.count() and all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in none)


def test_probabilities_of_letters_and_signatures_sum_to_one():
    """Whatever the mixer has learned, its chances for all symbols of some bits add up to one."""
    rng = np.random.default_rng(0)
    bits = 3
    history = rng.integers(0, 1 << bits, 40)

    def cost(last):
        mixer, out = lm._Mixer(1, bits, 2), 0.0
        for symbol in [*history, last]:
            nodes, path = lm._path(np.array([symbol]), bits)
            inputs = [np.sin(nodes).astype(np.float32), np.cos(nodes).astype(np.float32)]
            out = mixer.step(np.array([0]), inputs, np.zeros((1, bits), np.int64), path)[0]
        return out

    assert sum(2 ** -cost(s) for s in range(1 << bits)) == pytest.approx(1, abs=1e-4)


def test_new_words_again():
    found = lm.Tokens([b"q w q q e", b"q w"])
    fresh = np.flatnonzero(found.hashes != found.hashes[-1])
    again, bits = lm._again_bits(found, fresh)
    assert again.tolist() == [False, False, True, True, False, False, False] and (bits >= 0).all()


def test_tokens_of_texts():
    found = lm.Tokens([b"", b"A a\nB", b" "])
    assert found.owner.tolist() == [0, 1, 1, 1, 1, 2] and found.first.tolist() == [0, 1, 5]
    assert found.keys[1] == found.keys[2] != found.keys[3] and found.keys[0] == found.keys[4] == found.keys[5]
    assert all(c[0] == c[1] == c[5] for c in found.contexts())


def test_network_learns_and_is_calibrated():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 6))
    chance = 1 / (1 + np.exp(-(2 * x[:, 0] * x[:, 1] + x[:, 2])))
    y = (rng.random(3000) < chance).astype(float)
    scores = fit_network(x[:2500], y[:2500]).scores(x[2500:])
    assert np.mean((scores > 0.5) == (chance[2500:] > 0.5)) > 0.85
    assert abs(scores.mean() - y[2500:].mean()) < 0.06


def quality_labels(spark, docs):
    rows = [(i, int("***" not in t), 0) for i, t in ((r.doc_id, r.text) for r in docs.collect())]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_held_out_quality(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    rows = score_quality(docs, labels.where(~held_out)).where(held_out).join(labels, "doc_id").collect()
    assert len(rows) > 50 and np.mean([(r.score >= 0.7) == (r.quality == 1) for r in rows]) > 0.95


def test_quality_edges(docs, empty, spark):
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0)], "doc_id long, quality int")
    assert {r.score for r in score_quality(docs, labels).collect()} == {1.0}
    assert {r.score for r in score_quality(docs, labels.where("doc_id = 9")).collect()} == {0.5}
    assert score_quality(empty, labels).count() == 0
    more = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    rows = score_quality(docs.withColumns({"label": F.lit("x"), "mark": F.lit(1)}), more).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    by_id = {r.doc_id: r.score for r in rows}
    assert by_id[200] == by_id[201] == by_id[202] and by_id[3] == by_id[100]


def test_a_labelled_id_repeated_very_often_is_learned_once(spark):
    """What comes to the driver is bounded by the sample of labels, not by the rows that have them."""
    docs = spark.createDataFrame([(i if i < 20 else 3, f"some text {i}") for i in range(2500)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")
    sizes = []

    def fit(x, y):
        sizes.append(len(y))
        return fit_network(x, y)

    assert score_quality(docs, labels, sample=12, fit=fit).count() == 2500
    assert sizes == [12]


def test_shapes_and_spellings():
    spelled, shaped = Indexing().ids(b"The the THE ** ** x1,")
    assert spelled[0] == spelled[1] == spelled[2] and spelled[3] == spelled[4]
    assert len(set(shaped.tolist())) >= 4 and shaped[3] != shaped[4] and shaped[1] != shaped[2]


def brute_vectors(texts, indexing):
    """Sums of the index vectors of all words within reach, word by word."""
    places, signs = indexing.index_vectors()
    sums = np.zeros((indexing.words, indexing.size))
    for text in texts:
        kinds = [ids.tolist() for ids in indexing.ids((text or "").encode())]
        for i in range(len(kinds[0])):
            for j in range(max(0, i - indexing.reach), min(len(kinds[0]), i + indexing.reach + 1)):
                for of, around in ((a, b) for a in kinds for b in kinds if i != j):
                    for place, sign in zip(places[around[j]], signs[around[j]], strict=True):
                        sums[of[i], place] += sign
    return sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)


def test_pooling_holds_one_document_of_vectors():
    """Means and distances as in plain numpy, without the vectors of all tokens being copied together."""
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(500, 64)).astype(np.float32)
    ids = [rng.integers(0, 500, n) for n in (1000, 0, 1, *[700] * 200)]
    tracemalloc.start()
    mean, around = _pooled(ids, vectors)
    held = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert held < 142_000 * 64 * 4 / 2
    for i, own in enumerate(ids):
        found = vectors[own].astype(float) if len(own) else np.zeros((1, 64))
        assert np.allclose(mean[i], found.mean(axis=0))
        assert np.isclose(around[i, 0], (found**2).sum(axis=1).mean() - (mean[i] ** 2).sum(), atol=1e-4)


def test_quality_scores_equal_brute_force(spark):
    """Vectors, pooling and scores word by word, with a network that is given."""
    indexing = Indexing(spellings=64, size=8, entries=2)
    rows = [(i, t) for i, (_, t, *_) in enumerate(awkward_rows(5, 12)) if t is None or len(t) < 3000]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    vectors = brute_vectors([t for _, t in rows], indexing)
    assert np.allclose(word_vectors(docs, indexing), vectors, atol=1e-6)
    rng = np.random.default_rng(3)
    width = 2 * (indexing.size + 1) + 1
    network = Network(np.zeros(width), np.ones(width), rng.normal(size=(width, 5)), rng.normal(size=5), rng.normal(size=5), 0.1, 1.5)
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    found = {r.doc_id: r.score for r in score_quality(docs, labels, indexing=indexing, fit=lambda x, y: network).collect()}
    assert len(found) == len(rows)
    for i, text in rows:
        x = []
        kinds = indexing.ids((text or "").encode())
        for ids in kinds:
            own = vectors[ids] if len(ids) else np.zeros((1, indexing.size))
            mean = own.mean(axis=0)
            x += [*mean, np.mean([np.sum((v - mean) ** 2) for v in own])]
        x.append(math.log1p(len(kinds[0])))
        inner = [max(0.0, sum(a * b for a, b in zip(x, column, strict=True)) + bias) for column, bias in zip(network.hidden.T, network.hidden_bias, strict=True)]
        logit = sum(a * b for a, b in zip(inner, network.out, strict=True)) + network.out_bias
        assert found[i] == pytest.approx(1 / (1 + math.exp(-logit / network.temperature)), abs=1e-4)


def test_last_short_words():
    found = lm.Tokens([b"words der lang", b"nothing here", b"the a"])
    short = found.last_short()
    names = {0: None} | dict(zip(found.hashes.tolist(), "words der lang . nothing here . the a .".split(), strict=True))
    assert [names[h] for h in short.tolist()] == [None, None, "der", "der", None, None, None, None, "the", "a"]


def test_contexts_keep_their_own_counts_however_many_there_are():
    """What each context of a text tells equals brute-force counts, among 400,000 other contexts."""
    rng = np.random.default_rng(4)
    own = lm.Tokens([b"one two three two three one three two one", b"two one two"])
    keys = np.concatenate(lm._keys(own.contexts(), own.signatures))
    others = lm.mix(np.arange(1, 400_001, dtype=np.uint64)) & ~lm._SYMBOL | rng.integers(0, 1024, 400_000).astype(np.uint64)
    after, counts = np.unique(np.concatenate([keys, others]), return_counts=True)
    found = lm._answers(after, counts, keys, lm.SIGNATURE_BITS)
    seen = Counter()
    for key in keys.tolist():
        for level in range(lm.SIGNATURE_BITS):
            shift = lm.SIGNATURE_BITS - 1 - level
            seen[key >> 10, (key & 1023 | 1024) >> shift + 1, key >> shift & 1] += 1
    for key, told in zip(keys.tolist(), found.tolist(), strict=True):
        for level, answer in enumerate(told):
            node = (key & 1023 | 1024) >> lm.SIGNATURE_BITS - level
            zeros, ones = (seen[key >> 10, node, bit] for bit in (0, 1))
            assert answer >> 1 == round(math.log((ones + 0.4) / (zeros + 0.4)) * lm._STEPS) and answer & 1 == (zeros + ones > 1)
    assert not lm._answers(after, counts, np.array([1 << 40], np.uint64), lm.SIGNATURE_BITS).any()


def test_held_out_bits_a_byte(spark):
    """2.26 when contexts shared 2^18 slots, whatever the size of the input."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = score_texts(docs.withColumn("learns", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2), "learns").collect()
    apart = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 7 == 2 and r.bits_per_byte]
    bits = [-r.score / math.log10(2) for r in apart]
    assert sum(bits) / sum(b / r.bits_per_byte for b, r in zip(bits, apart, strict=True)) < 2.2


def test_keys_and_letter_contexts_equal_plain_ones():
    """Sorted keys are those of ``np.unique``; a letter's context of all its word's is built letter by letter."""
    numbers = np.random.default_rng(3).integers(0, 500, 2000).astype(np.uint64)
    assert (lm._distinct(numbers) == np.unique(numbers)).all() and len(lm._distinct(numbers[:0])) == 0
    found = lm.Tokens([b"alpha extraordinarily a", b"", b"be alphabetical"])
    chosen = np.flatnonzero(found.ends - found.starts > 0)
    word, value, keys = lm._letters_of(found, chosen)
    expected = []
    for token in chosen:
        letters = bytes(found.data[found.starts[token] : found.ends[token]])
        for place in range(len(letters) + 1):
            prefix = 0
            for k, letter in enumerate(letters[: min(place, lm._PREFIX)]):
                prefix = (prefix + letter + 1) * int(lm._ODD[k % 4]) % (1 << 64)
            expected.append((letters + b" ")[place] | int(lm.mix(np.array([prefix], np.uint64) + (lm._ODD[3] << np.uint64(1)))[0]) & ~1023)
    assert keys[2].tolist() == expected and len(word) == len(value) == len(expected)


def test_places_equal_unique():
    rng = np.random.default_rng(6)
    spread, close = rng.integers(0, 1 << 63, 500).astype(np.uint64), rng.integers(0, 40, 2000).astype(np.uint64)  # close ones share all upper bits
    for keys in (rng.choice(spread, 3000), close, close + np.uint64(1 << 40), close[:1], close[:0]):
        for found, expected in zip(lm._places(keys), np.unique(keys, return_index=True, return_inverse=True), strict=True):
            assert (found == expected).all()
        assert (lm._order(keys)[0] == np.argsort(keys, kind="stable")).all()


def test_numbers_pressed_in_their_least_width():
    for top, width in ((0, 1), (255, 1), (256, 2), (1 << 16, 4), (1 << 32, 8), ((1 << 63) - 1, 8)):
        numbers = np.array([0, top, 3], np.int64)
        assert lm._press(numbers)[0] == width and (lm._unpress(lm._press(numbers), np.int64) == numbers).all()
    assert lm._press(np.empty(0, np.int64)) == b"" and len(lm._unpress(b"", np.int64)) == 0


def learned(texts):
    """Keys after contexts with their counts, and the model, of some texts."""
    found = lm.Tokens(texts)
    after, counts = np.unique(np.concatenate(lm._keys(found.contexts(), found.signatures)), return_counts=True)
    pairs = np.bincount(found.signatures_before() << 10 | found.signatures, minlength=1025 << 10).reshape(-1, 1024)
    tokens = np.bincount(found.signatures, minlength=1024)
    return after, counts, lm.Model(lm._chances(tokens), lm._stretched(pairs).ravel(), tokens, 0.1, len(found.keys), len(np.unique(found.keys)))


def some_texts(seed, n):
    rng = np.random.default_rng(seed)
    words = [f"{a}{b}" for a in ("a", "the", "or", "wind", "longer") for b in ("", "x", "ness", "ing")]
    return [" ".join(rng.choice(words, size)).encode() for size in rng.integers(0, 60, n)]


def asked_of(found, read):
    own, places = zip(*lm._context_keys(found, read), strict=True)
    keys, at = lm._merged(own)
    return keys, [a[place] for a, place in zip(at, places, strict=True)]


def test_signatures_side_by_side_equal_one_after_the_other(monkeypatch):
    """Lanes, segments and tokens that are passed over change nothing: each segment is read by itself, bit by bit."""
    monkeypatch.setattr(lm, "LANES", 4)
    monkeypatch.setattr(lm, "SEGMENT", 13)
    after, counts, model = learned(some_texts(1, 40))
    found = lm.Tokens(some_texts(2, 25))
    met = np.random.default_rng(3).random(len(found.keys)) < 0.8
    keys, places = asked_of(found, np.flatnonzero(met))
    own = lm._keys(found.contexts(), found.signatures)
    assert keys.tolist() == sorted(set(np.concatenate([k[met] for k in own]).tolist()))
    assert all((keys[place] == k[met]).all() for place, k in zip(places, own, strict=True))
    bits = lm._signature_bits(found, np.flatnonzero(met), model, lm._Told(keys, lm._answers(after, counts, keys, 10)), places)
    told, before = [lm._answers(after, counts, k, 10) for k in own], found.signatures_before()
    for token in range(len(found.keys)):
        if (token - found.first[found.owner[token]]) % 13 == 0:
            weights = [[[1.5 / 4] * 4, [1.5 / 4] * 4] for _ in range(10)]
            table = [[1 / (1 + math.exp(8 - 0.5 * k)) for k in range(33)] for _ in range(10)]
            local = model.own.tolist()
        expected, node = 0.0, 1
        for level in range(10) if met[token] else ():
            bit, answers = int(found.signatures[token]) >> 9 - level & 1, [int(t[token, level]) for t in told]
            inputs = [float(model.stretched[before[token] << 10 | node]), *((a >> 1) / lm._STEPS for a in answers), math.log(local[node] / (1 - local[node]))]
            weight = weights[level][answers[-1] & 1]
            dot = max(-8, min(8, sum(w * x for w, x in zip(weight, inputs, strict=True))))
            mixed, place = 1 / (1 + math.exp(-dot)), int((dot + 8) * 2)
            refined = table[level][place]
            weight[:] = [w + (bit - mixed) * 0.03 * x for w, x in zip(weight, inputs, strict=True)]
            table[level][place] += 0.02 * (bit - refined)
            one = max(1 / 4096, min(1 - 1 / 4096, (mixed + refined) / 2))
            expected -= math.log2(one if bit else 1 - one)
            local[node] = max(0.002, min(0.998, local[node] + 0.05 * (bit - local[node])))
            node = node << 1 | bit
        assert bits[token] == pytest.approx(expected, abs=0.01)


def test_tokens_passed_over_take_no_step(monkeypatch):
    """Two texts of 60 words, of which every other is new, once in one and once in the other: 30 steps of both, not 61 of one."""
    after, counts, model = learned(some_texts(1, 40))
    found = lm.Tokens([b"wind or " * 30, b"or wind " * 30])
    read = np.flatnonzero(found.hashes == found.hashes[0])
    keys, places = asked_of(found, read)
    steps, step = [], lm._Mixer.step
    monkeypatch.setattr(lm._Mixer, "step", lambda mixer, lanes, inputs, *rest: steps.append(inputs[0].shape[0]) or step(mixer, lanes, inputs, *rest))
    lm._signature_bits(found, read, model, lm._Told(keys, lm._answers(after, counts, keys, 10)), places)
    assert steps == [2] * 30


def test_answers_read_by_parts_equal_those_given_straight_away(monkeypatch):
    monkeypatch.setattr(lm, "_READ_AT_ONCE", 50)
    monkeypatch.setattr(lm, "_KEYS_AT_ONCE", 80)
    after, counts, _ = learned(some_texts(4, 60))
    parts, pieces = 16, [lm.Tokens(some_texts(seed, 5)) for seed in (5, 6, 7)]
    asked = [asked_of(piece, np.arange(len(piece.keys)))[0] for piece in pieces]
    told = [{} for _ in pieces]
    for part in range(parts):
        of_part = lambda keys: next((slice(a, b) for p, a, b in lm.part_cuts(keys, parts) if p == part), slice(0, 0))
        some = of_part(after)
        answers = lm._tell_keys(after[some], counts[some], [lm._press_keys(keys[of_part(keys)]) for keys in asked], 10)
        for own, answer in zip(told, answers, strict=True):
            own[part] = answer
    for keys, own in zip(asked, told, strict=True):
        assert (lm._read_odds(keys, own, parts, 10) == lm._answers(after, counts, keys, 10)).all()


def test_keys_counted_in_place():
    for keys in (np.random.default_rng(8).integers(0, 50, 400).astype(np.uint64), np.array([7], np.uint64), np.empty(0, np.uint64)):
        expected = np.unique(keys, return_counts=True)
        assert all((a == b).all() and len(a) == len(b) for a, b in zip(lm._counted(keys.copy()), expected, strict=True))
