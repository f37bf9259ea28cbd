"""The recurrent network: slopes, plain scores of single windows, and held-out accuracy."""

import math
import random

import numpy as np
import pytest

from tests.llm.conftest import sentence
from vitaria.llm.toxicity import Network, Shape, Words, score_toxicity, vocabulary

SMALL = Shape(spellings=64, grams=64, size=4, hidden=4, attention=3, window=6, stride=3)
TEXTS = [b"you are an idiot, my friend! and so on", b"Short", b"", b" \n\t ", b"a b c d e f g h i j k", "é ü 漢字 \x1c word".encode(), b"***"]
SCHEMA = "doc_id long, text string, score double, label string"


def one_window(net, inputs):
    """Logit of one window, number by number."""
    d, h = net.dense, net.shape.hidden
    sig = lambda v: 1 / (1 + math.exp(-v))
    ways = []
    for way in "fb":
        state, states = [0.0] * h, []
        for x in inputs if way == "f" else inputs[::-1]:
            p = [sum(x[i] * d[f"w{way}"][i, j] for i in range(len(x))) + d[f"c{way}"][j] for j in range(3 * h)]
            g = [sum(state[i] * d[f"u{way}"][i, j] for i in range(h)) for j in range(3 * h)]
            z, r = [sig(p[j] + g[j]) for j in range(h)], [sig(p[h + j] + g[h + j]) for j in range(h)]
            new = [math.tanh(p[2 * h + j] + r[j] * g[2 * h + j]) for j in range(h)]
            state = [(1 - z[j]) * new[j] + z[j] * state[j] for j in range(h)]
            states.append(state)
        ways.append(states if way == "f" else states[::-1])
    both = [a + b for a, b in zip(*ways, strict=True)]
    force = []
    for s in both:
        inner = [math.tanh(sum(s[i] * d["a"][i, j] for i in range(2 * h)) + d["a0"][j]) for j in range(net.shape.attention)]
        force.append(math.exp(sum(x * v for x, v in zip(inner, d["v"], strict=True))))
    pooled = [sum(f * s[i] for f, s in zip(force, both, strict=True)) / sum(force) if force else 0.0 for i in range(2 * h)]
    return sum(x * o for x, o in zip(pooled, d["o"], strict=True)) + d["o0"][0]


def test_every_window_as_in_plain_python():
    net, words = Network.start(SMALL, 3), Words(TEXTS, SMALL)
    assert list(np.bincount(words.docs)) == [2, 1, 1, 1, 3, 1, 1]
    covered = [set() for _ in TEXTS]
    for doc, a, b in zip(words.docs, words.at, words.until, strict=True):
        covered[doc] |= set(range(a, b))
    assert sum(map(len, covered)) == len(words.starts) == 9 + 1 + 11 + 5
    vocab, which = vocabulary(words, 0, len(words.starts), SMALL)
    inputs = net.inputs(vocab)[which]
    expected = [one_window(net, inputs[a:b].tolist()) for a, b in zip(words.at, words.until, strict=True)]
    assert net.logits(words) == pytest.approx(expected, abs=1e-4)


def test_slopes_are_those_of_the_loss():
    net, words = Network.start(SMALL, 1), Words(TEXTS, SMALL)
    for n in net.dense:
        net.dense[n] = net.dense[n].astype(float)
    vocab, which = vocabulary(words, 0, len(words.starts), SMALL)
    place = words.at[:, None] + np.arange(SMALL.window)
    mask = place < words.until[:, None]
    ids = np.where(mask, which[np.minimum(place, len(which) - 1)], len(vocab.spellings))
    x, y = net.inputs(vocab).astype(float), (words.docs % 2).astype(float)

    def loss():
        found = net.windows(x, ids, mask.astype(float))
        return float(np.sum(np.logaddexp(0, found) - y * found))

    def slope(array, at):
        old, ends = array[at], []
        for step in (1e-4, -1e-4):
            array[at] = old + step
            ends.append(loss())
        array[at] = old
        return (ends[0] - ends[1]) / 2e-4

    kept = {}
    error = 1 / (1 + np.exp(-net.windows(x, ids, mask.astype(float), kept))) - y
    slopes, at_x = net.slopes(x, ids, error, kept)
    for n, array in net.dense.items():
        for at in {tuple(0 for _ in array.shape), tuple(s // 2 for s in array.shape)}:
            assert slopes[n][at] == pytest.approx(slope(array, at), abs=2e-3), n
    for at in ((0, 0), (3, 5), (8, 11)):
        assert at_x[at] == pytest.approx(slope(x, at), abs=2e-3)


def labelled(n=500, seed=2):
    rng = random.Random(seed)
    plain = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(150)]
    docs, labels = [], []
    for i in range(n):
        words = rng.choices(plain, k=rng.randint(5, 120))
        bad = i % 3 == 0
        if bad:
            words.insert(rng.randint(0, len(words)), rng.choice(["Swine", "swine!!", "zyxwv" + rng.choice(plain)]))
        docs.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return docs, labels


def test_held_out_texts(spark):
    docs, labels = labelled()
    extra = [(9000, None), (9001, ""), (None, docs[0][1]), (docs[0][0], docs[0][1]), (9002, docs[1][1] + " ok" * 30_000), (9003, "x" * 50_000), (9004, "\x00 \U0001f600")]
    table = spark.createDataFrame([(*r, 0.0, "clash") for r in docs + extra], SCHEMA).repartition(3)
    known = [(i, y, "x") for i, y in labels if i % 4] + [(1, 0, "again"), (None, 1, ""), (2, None, ""), (77777, 1, "")]
    found = score_toxicity(table, spark.createDataFrame(known, "doc_id long, toxic int, text string"), shape=Shape(spellings=1 << 10, grams=1 << 12)).collect()
    assert len(found) == len(docs) + len(extra)
    assert all(0 <= r["score"] <= 1 for r in found)
    scores = {r["doc_id"]: r["score"] for r in found}
    held = [(y, scores[i]) for i, y in labels if i % 4 == 0]
    pairs = [(a > b) + (a == b) / 2 for y, a in held if y for z, b in held if not z]
    assert sum(pairs) / len(pairs) > 0.9
    assert scores[9000] == scores[9001]


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a", 0.0, ""), (2, None, 0.0, "")], SCHEMA)
    labels = lambda rows: spark.createDataFrame(rows, "doc_id long, toxic int")
    assert {r["score"] for r in score_toxicity(docs, labels([])).collect()} == {0.5}
    assert {r["score"] for r in score_toxicity(docs, labels([(1, 1), (2, 1)])).collect()} == {1.0}
    assert score_toxicity(spark.createDataFrame([], SCHEMA), labels([(1, 1)])).count() == 0


def test_scoring_counts_as_exactly_as_the_weights_are(monkeypatch):
    """Windows are judged in 32 bits, as the weights are, and come out as in 64 but for rounding."""
    rng = random.Random(3)
    words = Words([sentence(rng, rng.randint(1, 200)).encode() for _ in range(50)], Shape())
    net, seen, plain = Network.start(Shape(), 1), [], Network.windows
    monkeypatch.setattr(Network, "windows", lambda self, x, *rest: (seen.append(x), plain(self, x, *rest))[1])
    found = net.logits(words)
    assert {x.dtype for x in seen} == {np.dtype(np.float32)}
    monkeypatch.setattr(Network, "windows", lambda self, x, *rest: plain(self, x.astype(float), *rest))
    assert np.abs(net.logits(words) - found).max() < 1e-5
