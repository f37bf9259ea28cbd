import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.conftest import awkward_rows
from vitaria.llm import packing
from vitaria.llm.fingerprints import OrderMinHash, fingerprint_neighbours, likeness

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_pieces_hold_every_token_once(docs):
    tokenizer = Tokenizer.from_file(PATH)
    rows = packing.pack_documents(docs.where("doc_id is not null").dropDuplicates(["doc_id"]), packing.word_tokens(PATH), size=256, windows=4).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    texts = {doc_id: text for doc_id, text, *_ in awkward_rows() if doc_id is not None}
    assert set(pieces) == set(texts)
    for doc_id, text in texts.items():
        ids, at = tokenizer.encode(text or "", add_special_tokens=False).ids + [1], 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            part = np.array(ids[at : at + r.length], "<u4")
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(part.tobytes()))
            at += r.length
        assert at == len(ids)
    short = 0
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        short += at < 256
        assert at <= 256 and {r.padding for r in own} == {0 if at == 256 or at.bit_count() == 1 else 256 - at}
    assert short <= 1


def test_rests_of_many_partitions_merge(docs, monkeypatch):
    monkeypatch.setattr(packing, "MERGE_AT_ONCE", 2)
    rows = packing.pack_documents(docs.repartition(9), packing.word_tokens(PATH), size=512).collect()
    filled = defaultdict(int)
    for r in rows:
        filled[r.sequence_id] += r.length
    assert sorted(filled.values())[1:] == [512] * (len(filled) - 1)
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    assert {(r.doc_row, r.doc_tokens) for r in rows if r.doc_id is None} and sum(r.doc_id is None for r in rows)


def test_packing_edges(empty, docs):
    tokens = packing.word_tokens(PATH)
    assert packing.pack_documents(empty, tokens).count() == 0
    clash = docs.withColumns({"doc": F.lit("x"), "sequence_id": F.lit(1), "place": F.lit(2)})
    assert packing.pack_documents(clash, tokens).count() == packing.pack_documents(docs, tokens).count()


def test_best_fit_keeps_few_windows_open():
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 300, 400).tolist()
    pieces = [packing._Piece(i, i, 0, np.arange(n, dtype=np.uint32), n) for i, n in enumerate(sizes)]
    windows = list(packing.best_fit(iter(pieces), 128, 3))
    assert [sum(len(p.ids) for p in w) for w in windows[:-1]] == [128] * (len(windows) - 1)
    assert sum(len(p.ids) for w in windows for p in w) == sum(sizes)


def test_words_are_remembered_within_bounds():
    encode = packing.word_tokens(PATH, held=8)()
    texts = ["a b c d e f", "g h i j a b", "k, l. m! n", "", "a\x1cb c"]
    tokenizer = Tokenizer.from_file(PATH)
    for text, ids in zip(texts, [x for t in texts for x in encode([t])], strict=True):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [1]


def test_neighbours_equal_brute_force(docs):
    rows = sorted((r for r in awkward_rows() if r[0] is not None and r[0] != 208), key=lambda r: r[0])
    frame = docs.where("doc_id is not null and doc_id <> 208").withColumns({"part": F.lit(1), "mark": F.lit(2), "lent": F.lit(3)})
    found = {r.doc_id: r for r in fingerprint_neighbours(frame).collect()}
    hashing = OrderMinHash()
    assert len(found) == len(rows)
    for (doc_id, text, *_), (_, following, *_) in zip(rows, rows[1:] + rows[:1], strict=True):
        text, following, r = text or "", following or "", found[doc_id]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        own, changed, other = (hashing.signature(x) for x in (text, edited, following))
        assert r.fingerprint == own.astype(">u4").tobytes().hex() and r.edited_fingerprint == changed.astype(">u4").tobytes().hex()
        assert (r.near_edited, r.near_next) == (likeness(own, changed), likeness(own, other))
    copies = {found[i].fingerprint for i in (3, 100, 101, 107)}
    assert len(copies) == 1


def test_neighbour_edges(docs, empty, spark):
    assert fingerprint_neighbours(empty).count() == 0
    assert fingerprint_neighbours(docs).count() == docs.count()  # null and repeated ids
    one = fingerprint_neighbours(spark.createDataFrame([(7, "abcdefgh")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0 and one[0].edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()


def brute_signature(hashing, text):
    """Entries by sorting all numbered k-mers for every function."""
    hashes = hashing.numbered(text)
    out = []
    for mask, factor in zip(hashing.masks, hashing.factors, strict=True):
        with np.errstate(over="ignore"):
            values = (hashes ^ mask) * factor
        out.append(tuple(hashes[sorted(np.argsort(values, kind="stable")[: hashing.tuple_size])].tolist()))
    return out


def test_signatures_follow_edits_and_order():
    hashing = OrderMinHash(functions=256)
    rng = np.random.default_rng(5)
    text = "".join(rng.choice(list("abcdefgh "), 3000))
    half = text[1500:] + text[:1500]
    edited = text[:2800] + "".join(rng.choice(list("abcdefgh "), 200))
    near, moved, far = (likeness(hashing.signature(text), hashing.signature(x)) for x in (edited, half, text[::-1]))
    assert near > 0.7 and moved < 0.75 * near and far < 0.05
    a, b = brute_signature(hashing, text), brute_signature(hashing, half)
    assert moved == pytest.approx(np.mean([x == y for x, y in zip(a, b, strict=True)]), abs=1e-9)
    assert (hashing.signature("") == 0).all() and (hashing.signature("ab") != 0).any()
    assert likeness(hashing.signature("aaaaaaaaaaaaaaaa"), hashing.signature("a" * 40)) < 1  # occurrences count


def test_words_that_lower_case_to_an_added_token_keep_their_ids():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    added = [x.content for x in tokenizer.get_added_tokens_decoder().values()]
    texts = [f"a {x} b {x.upper()}c {x.title()} X{x.upper()}{x}" for x in added]
    texts += ["", " \n", "Plain WORDS, again; plain words,", "\u0130stanbul \u00c9T\u00c9 \U0001f600!?", "x" * 3000, "A\x1cB\xa0c", "one\ttwo\x0bthree"]
    expected = [[*tokenizer.encode(t, add_special_tokens=False).ids, 1] for t in texts]
    for held in (300_000, 2):  # also when all words are forgotten again and again
        encode = packing.word_tokens(path, held=held)()
        for _ in range(2):
            assert [x.tolist() for x in encode(texts)] == expected
        assert [next(iter(encode([t]))).tolist() for t in texts] == expected
