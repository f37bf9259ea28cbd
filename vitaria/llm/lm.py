"""Texts scored by online logistic context mixing over bits.

Every token has a signature of ten bits: sorts of its first and last characters and its
length. The bits are predicted one after the other by several contexts, whose counts come
from all training texts and are a table by range of keys like those of the words, and by counts of the text itself; a mixer combines
the predictions in the logistic domain with weights chosen by a gate, learning from every bit,
and an adaptive table refines the result. What a signature leaves open is paid by the token's count among the
training tokens of that signature. A token never met costs the chance of a new one, which follows the text, and the bits
of its letters, predicted in the same way. The sum over a text is its total length in bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import InitVar, dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitaria.llm.exchange import pack, part_cuts, piece_count, piece_of, texts_of, unpack
from vitaria.llm.session import let_workers_import
from vitaria.llm.words import hash_spans, mix, spans
from vitaria.sinks.shared import keep_table

SIGNATURE_BITS = 10
#: Contexts of signatures: signature before, last short word before, word before; of letters: two and three before, and all.
CONTEXTS, LETTER_CONTEXTS = 3, 3
#: Tokens that the share of new words expected beforehand weighs as much as.
NEW_WEIGHT = 16
SEGMENT = 512
LANES = 2048
LETTER_LANES = 128
PIECE_BYTES = 6 << 20
_END = b"\n"  # stands for the end of a text; no word holds it
_PREFIX = 10  # first letters of a word that the context of all its letters sees
#: Parts of one unit in the logarithm of odds that an answer tells apart.
_STEPS = 2000
_SYMBOL = np.uint64((1 << SIGNATURE_BITS) - 1)
_SLICE_BITS = 16
_KEYS_AT_ONCE = 1 << 18
_READ_AT_ONCE = 1 << 16
_WIDTHS = np.array([1, 3, 5, 6, 8, 10, 13, 17])
#: Parts of a signature by the first and last two bytes of a token, and by its length.
_PAIRS = mix(np.arange(1 << 16, dtype=np.uint64))
_FIRST, _LAST = (_PAIRS >> np.uint64(60) << np.uint64(6)).astype(np.int64), (_PAIRS >> np.uint64(61)).astype(np.int64)
_WIDTH = np.searchsorted(_WIDTHS, np.arange(_WIDTHS[-1] + 1), side="right") - 1 << 3
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


class Tokens:
    """Tokens of some texts in lower case, one after the other, each text with its end."""

    def __init__(self, texts: list[bytes]):
        joined = [t.translate(_LOWER) + b" " for t in texts]
        sizes = np.array([len(t) for t in joined], np.int64)
        self.data = np.frombuffer(b"".join([*joined, _END]), np.uint8)
        starts, ends = spans(self.data[:-1])
        counts = np.diff(np.searchsorted(starts, np.cumsum(sizes)), prepend=0)
        owner = np.repeat(np.arange(len(texts)), counts)
        at = np.cumsum(counts)  # an end follows the words of each text
        last = len(self.data) - 1
        self.starts, self.ends = np.insert(starts, at, last), np.insert(ends, at, last + 1)
        self.owner = np.insert(owner, at, np.arange(len(texts)))
        self.first = np.r_[0, np.cumsum(counts + 1)[:-1]] if len(texts) else np.empty(0, np.int64)
        hashes = hash_spans(self.data, starts, ends)
        self.hashes = np.insert(hashes, at, hash_spans(self.data, np.array([last]), np.array([last + 1]))[0])
        self.signatures = self._signatures()
        self.keys = self.hashes & ~np.uint64((1 << SIGNATURE_BITS) - 1) | self.signatures.astype(np.uint64)

    def _signatures(self) -> np.ndarray:
        first = self.data[self.starts].astype(np.uint16) << np.uint16(8) | self.data[np.minimum(self.starts + 1, self.ends - 1)]
        last = self.data[self.ends - 1].astype(np.uint16) << np.uint16(8) | self.data[np.maximum(self.ends - 2, self.starts)]
        return _FIRST[first] | _WIDTH[np.minimum(self.ends - self.starts, _WIDTHS[-1])] | _LAST[last]

    @cached_property
    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``_places`` of the keys: different ones, the first token of each, and the place of every token's."""
        return _places(self.keys)

    def signatures_before(self) -> np.ndarray:
        """Signature before every token plus one, 0 where a text begins."""
        before = np.r_[0, self.signatures[:-1] + 1]
        before[self.first] = 0
        return before

    def context_words(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """The last short word and the word before at every token, as numbers of words, and the context's hash by such a number.

        Number 0 is none: contexts begin anew with each text.
        """
        hashes, number = np.r_[np.uint64(0), self.hashes[self.words[1]]], np.r_[self.words[2] + 1, 0]
        before = np.arange(-1, len(self.hashes) - 1)
        before[self.first] = -1
        return [(number[at], mix(hashes + odd)) for at, odd in ((self._short_before(), _ODD[2]), (before, _ODD[3]))]

    def contexts(self) -> list[np.ndarray]:
        """Hashes of the last short word and of the word before at every token."""
        return [hashes[number] for number, hashes in self.context_words()]

    def _short_before(self) -> np.ndarray:
        at = np.where(self.ends - self.starts <= 3, np.arange(len(self.hashes)), -1)
        at = np.r_[-1, np.maximum.accumulate(at)[:-1]][: len(self.hashes)]
        return np.where(at >= self.first[self.owner], at, -1)

    def last_short(self) -> np.ndarray:
        """Hash of the last word of up to three bytes before every token of its text, 0 if there is none: it tells the language."""
        return np.r_[self.hashes, np.uint64(0)][self._short_before()]


_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _path(values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Node before each bit of a number, the root 1, and the bits, most significant first."""
    shifts = np.arange(bits - 1, -1, -1, dtype=np.int32)
    values = values.astype(np.int32)[:, None]
    return (values | np.int32(1 << bits)) >> shifts + np.int32(1), values >> shifts & np.int32(1)


def _keys(contexts: list[np.ndarray], values: np.ndarray) -> list[np.ndarray]:
    """Keys of what comes after each context: the symbol in the last bits, the context in all others."""
    return [context & ~_SYMBOL | values.astype(np.uint64, copy=False) for context in contexts]


def _letters_of(tokens: Tokens, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """For every letter of some tokens, and the space after each: its token's place among them, its byte, its keys."""
    starts, lengths = tokens.starts[chosen], tokens.ends[chosen] - tokens.starts[chosen]
    ends = np.cumsum(lengths + 1)
    begins = ends - lengths - 1
    word = np.repeat(np.arange(len(chosen)), lengths + 1)
    value = tokens.data[np.minimum(np.repeat(starts - begins, lengths + 1) + np.arange(len(word)), len(tokens.data) - 1)].astype(np.uint64)
    value[ends - 1] = 32

    def before(letters: np.ndarray) -> np.ndarray:
        found = np.r_[np.uint64(0), letters[:-1]][: len(letters)]
        found[begins] = 0
        return found

    one = before(value)
    two = before(one)
    three = before(two)
    two |= one << np.uint64(8)
    three |= two << np.uint64(8)
    prefix, state = np.zeros(len(word), np.uint64), np.zeros(len(chosen), np.uint64)
    left = np.arange(len(chosen))
    for k in range(_PREFIX):
        left = left[lengths[left] > k]
        state[left] = (state[left] + value[begins[left] + k] + np.uint64(1)) * _ODD[k % 4]
        prefix[begins[left] + k + 1] = state[left]
    beyond = np.flatnonzero(np.arange(len(word)) - begins[word] > _PREFIX)
    prefix[beyond] = state[word[beyond]]
    # twice the numbers of the signatures' contexts, whose keys lie in the same table
    keys = [_keys([mix(x + (odd << np.uint64(1)))], value)[0] for x, odd in zip((two, three, prefix), _ODD[1:], strict=True)]
    return word, value.view(np.int64), keys


def _groups(table: Iterator[pa.RecordBatch], size: int) -> Iterator[list[bytes]]:
    """Training texts, about ``size`` bytes together."""
    texts, held = [], 0
    for batch in table:
        for at in range(0, len(batch), 256):
            for text in texts_of(pa.Table.from_batches([batch.slice(at, 256)]), "text"):
                texts.append(text)
                held += len(text)
                if held >= size:
                    yield texts
                    texts, held = [], 0
    if texts:
        yield texts


def _distinct(keys: np.ndarray) -> np.ndarray:
    """Different keys in order. Sorting many of them is faster than the table of hashes that ``np.unique`` makes."""
    keys = np.sort(keys)
    return keys[np.r_[True, keys[1:] != keys[:-1]]] if len(keys) else keys


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order and how many there are of each; there are many keys, so they are sorted in place."""
    keys.sort()
    begins = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
    return keys[begins], np.diff(begins, append=len(keys))


def _order(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of keys in order, equal ones as they come, and the ordered keys.

    Sorts numbers that hold the upper bits of a key and its index, which is much faster than sorting indices.
    Keys that have these bits in common and come out of order are left to ``np.argsort``.
    """
    low = np.uint64((1 << len(keys).bit_length()) - 1)
    order = (np.sort(keys & ~low | np.arange(len(keys), dtype=np.uint64)) & low).astype(np.int64)
    ordered = keys[order]
    if (ordered[1:] < ordered[:-1]).any():
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
    return order, ordered


def _places(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different keys in order, where each is met first, and for every key its place among them."""
    order, ordered = _order(keys)
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    place = np.empty(len(keys), np.int64)
    place[order] = np.cumsum(new) - 1
    return ordered[new], order[new], place


def _places_below(size: int, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``_places`` of numbers below a size, by a table of that size: different ones in order, and for each its place."""
    place = np.zeros(size, np.int64)
    place[numbers] = 1
    found = np.flatnonzero(place)
    place[found] = np.arange(len(found))
    return found, place[numbers]


def _press(numbers: np.ndarray) -> bytes:
    """``pack``, compressed, in the least width that holds the greatest: there are many numbers after contexts."""
    if not len(numbers):
        return b""
    numbers = numbers.astype(np.min_scalar_type(numbers.max()), copy=False)
    data = pack(numbers)
    return bytes([numbers.itemsize]) + len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _unpress(data: bytes, kind) -> np.ndarray:
    if not data:
        return np.empty(0, kind)
    return unpack(pa.decompress(data[9:], int.from_bytes(data[1:9], "little"), "zstd", asbytes=True), f"u{data[0]}").astype(kind, copy=False)


def _press_keys(keys: np.ndarray) -> bytes:
    """Sorted keys by their differences, which are small within a context."""
    return _press(np.diff(keys, prepend=np.uint64(0)))


def _unpress_keys(data: bytes) -> np.ndarray:
    return np.cumsum(_unpress(data, np.uint64), dtype=np.uint64)


def _dealt(parts: int, *columns: np.ndarray) -> Iterator[tuple[int, list[slice]]]:
    """For every part of the range that some of the sorted columns reach, where it lies in each."""
    cuts = [{p: slice(a, b) for p, a, b in part_cuts(keys, parts)} for keys in columns]
    for part in sorted(set().union(*cuts)):
        yield part, [own.get(part, slice(0, 0)) for own in cuts]


def _count_words(parts: int):
    """Keys of some training texts with their counts, by range: words, and symbols after contexts. After the
    last range, a task's counts of signatures after signatures, which are never more than these are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = np.zeros(((1 << SIGNATURE_BITS) + 1) << SIGNATURE_BITS, np.int64)
        for texts in _groups(batches, PIECE_BYTES):
            tokens = Tokens(texts)
            keys, one, place = tokens.words
            counts = np.bincount(place)
            pairs += np.bincount(tokens.signatures_before() << SIGNATURE_BITS | tokens.signatures, minlength=len(pairs))
            after, after_counts = _counted(np.concatenate(_keys(tokens.contexts(), tokens.signatures) + _letters_of(tokens, one)[2]))
            rows = [
                {"part": p, "keys": pack(keys[w]), "counts": pack(counts[w]), "after": _press_keys(after[a]), "after_counts": _press(after_counts[a])}
                for p, (w, a) in _dealt(parts, keys, after)
            ]
            yield pa.RecordBatch.from_pylist(rows, _WORD_COUNTS)
        met = np.flatnonzero(pairs)
        number = met >> _SLICE_BITS
        edges = [*np.flatnonzero(np.r_[True, number[1:] != number[:-1]]).tolist(), len(met)] if len(met) else []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            row = {"part": parts + int(number[a]), "keys": pack(met[a:b].astype(np.uint64)), "counts": pack(pairs[met[a:b]]), "after": b"", "after_counts": b""}
            yield pa.RecordBatch.from_pylist([row], _WORD_COUNTS)

    return run


_COUNTS_DDL = "part int, keys binary, counts binary, after binary, after_counts binary"
_WORD_COUNTS = pa.schema([("part", pa.int32()), *((name, pa.binary()) for name in ("keys", "counts", "after", "after_counts"))])
_VOCABULARY = pa.schema(
    [*_WORD_COUNTS, ("signatures", pa.list_(pa.int32())),
     ("tokens", pa.list_(pa.int64())), ("words", pa.list_(pa.int64())), ("once", pa.list_(pa.int64()))]
)
_VOCABULARY_DDL = _COUNTS_DDL + ", signatures array<int>, tokens array<long>, words array<long>, once array<long>"


def _summed(every: list[np.ndarray], each: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, with the sums of their counts."""
    every, each = np.concatenate(every), np.concatenate(each)
    order, every = _order(every)
    each = each[order]
    begin = np.flatnonzero(np.r_[True, every[1:] != every[:-1]]) if len(every) else np.empty(0, np.int64)
    return every[begin], np.add.reduceat(each, begin) if len(every) else each


def _add_words(table: pa.Table) -> pa.Table:
    """Counts of one range of keys over all training texts, with sums by signature."""
    column = lambda name, read, *kind: [read(x, *kind) for x in table.column(name).to_pylist()]
    keys, counts = _summed(column("keys", unpack, np.uint64), column("counts", unpack, np.int64))
    after, after_counts = _summed(column("after", _unpress_keys), column("after_counts", _unpress, np.int64))
    signature = (keys & np.uint64((1 << SIGNATURE_BITS) - 1)).astype(np.int64)
    found, place = np.unique(signature, return_inverse=True)
    tokens = np.zeros(len(found), np.int64)
    np.add.at(tokens, place, counts)
    row = {"part": table.column("part")[0].as_py(), "keys": pack(keys), "counts": pack(counts), "after": _press_keys(after), "after_counts": _press(after_counts),
           "signatures": found.tolist(),
           "tokens": tokens.tolist(), "words": np.bincount(place).tolist(), "once": np.bincount(place, counts == 1).astype(int).tolist()}
    return pa.Table.from_pylist([row], _VOCABULARY)


def _new_nodes(asked: np.ndarray, begins: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """For the root and every level which keys are the first to pass their node; ``begins`` tells where sorted runs of keys begin."""
    for level in (0, *range(bits)):
        node = asked >> np.uint64(bits - level)
        new = np.ones(len(asked), bool)
        new[1:] = node[1:] != node[:-1]
        new[begins] = True
        yield new


def _runs(news: list[np.ndarray], begins: np.ndarray) -> np.ndarray:
    """How many numbers are told of each run of keys, for the root and every level."""
    return np.array([np.add.reduceat(new, begins, dtype=np.int64) for new in news]) if len(begins) else np.zeros((len(news), 0), np.int64)


def _running(after: np.ndarray, counts: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted keys, sums of the counts before each, and for every bit of a symbol how many keys before have it set."""
    ones = np.zeros((bits, len(after) + 1), np.int32 if len(after) < 1 << 31 else np.int64)
    for level, own in enumerate(ones):
        np.cumsum((after >> np.uint64(bits - 1 - level) & np.uint64(1)).astype(bool), dtype=own.dtype, out=own[1:])
    return np.append(0, np.cumsum(counts)), ones


def _branches(after: np.ndarray, before: np.ndarray, ones: np.ndarray, asked: np.ndarray, news: list[np.ndarray]) -> Iterator[np.ndarray]:
    """What the contexts of asked keys have counted, each node on a symbol's path once, from sorted keys and what ``_running`` tells of them.

    First the count of each context, then level by level how many of a node's count are not on the branch that the first
    key passing it takes: mostly none, so the numbers compress well. ``_odds`` reads them.
    """
    bits = len(ones)
    keys, last = asked[news[0]] & ~_SYMBOL, np.uint64((1 << bits) - 1)
    start, end = np.searchsorted(after, keys), np.searchsorted(after, keys | last, side="right")
    yield before[end] - before[start]
    for level, set_before in enumerate(ones):
        first = np.flatnonzero(news[level + 1])
        keys, shift = asked[first], np.uint64(bits - 1 - level)
        if level:
            parent = np.cumsum(news[level][first]) - 1
            start, middle, end = start[parent], middle[parent], end[parent]
            one = (keys >> shift + np.uint64(1) & np.uint64(1)).astype(bool)
            start, end = np.where(one, middle, start), np.where(one, end, middle)
        middle = end - (set_before[end] - set_before[start])  # a node's keys with the bit set are its last
        one = (keys >> shift & np.uint64(1)).astype(bool)
        yield before[np.where(one, middle, end)] - before[np.where(one, start, middle)]


def _odds(told: list[np.ndarray], asked: np.ndarray, news: list[np.ndarray], bits: int) -> np.ndarray:
    """For each asked key what its context tells at every node on the symbol's path, from the numbers of ``_branches``.

    The logarithm of the odds of a one in steps, times two, plus one if the context was met there more than once.
    """
    found = np.zeros((bits, len(asked)), np.int16)
    both = told[0]
    for level, (new, aside) in enumerate(zip(news[1:], told[1:], strict=True)):
        first = np.flatnonzero(new)
        keys, shift = asked[first], np.uint64(bits - 1 - level)
        if level:
            parent, one = np.cumsum(news[level][first]) - 1, (keys >> shift + np.uint64(1) & np.uint64(1)).astype(bool)
            both = np.where(one, ones[parent], (both - ones)[parent])
        ones = np.where(keys >> shift & np.uint64(1), both - aside, aside)
        odds = np.log((ones + 0.4) / (both - ones + 0.4)).clip(-8, 8)
        found[level] = np.repeat(np.rint(odds * _STEPS).astype(np.int16) * 2 + (both > 1), np.diff(first, append=len(asked)))
    return found.T


def _answers(after: np.ndarray, counts: np.ndarray, asked: np.ndarray, bits: int) -> np.ndarray:
    """``_odds`` of any keys, given straight away by sorted keys and their counts."""
    asked, place = np.unique(asked, return_inverse=True)
    news = list(_new_nodes(asked, np.zeros(min(len(asked), 1), np.int64), bits))
    return _odds(list(_branches(after, *_running(after, counts, bits), asked, news)), asked, news, bits)[place]


@dataclass
class Model:
    """What scoring needs besides the counts of a piece's words and contexts: tables by signatures, of which there are so many."""

    own: np.ndarray  # chance of a one at every node of a signature, whatever the context
    stretched: np.ndarray  # after each signature, its prediction at every node
    signature_tokens: np.ndarray
    new: float  # share of tokens expected to be new
    tokens: int
    words: int


def _stretched(pairs: np.ndarray) -> np.ndarray:
    """Prediction at every node after each signature, from the numbers of tokens of all signatures after it."""
    below, found = pairs, np.zeros(pairs.shape, np.float32)
    for level in range(SIGNATURE_BITS - 1, -1, -1):
        zeros, ones = below[:, 0::2], below[:, 1::2]
        found[:, 1 << level : 2 << level] = np.log((ones + 0.4) / (zeros + 0.4)).clip(-8, 8)
        below = zeros + ones
    return found


def _chances(tokens: np.ndarray) -> np.ndarray:
    """Chance of a one at every node, from the numbers of tokens of all signatures."""
    below, chances = tokens.astype(float), np.full(len(tokens), 0.5)
    for level in range(SIGNATURE_BITS - 1, -1, -1):
        zeros, ones = below[0::2], below[1::2]
        chances[1 << level : 2 << level] = (ones + 0.4) / (zeros + ones + 0.8)
        below = zeros + ones
    return np.clip(chances, 0.002, 0.998).astype(np.float32)


def learn(texts: DataFrame, parts: int) -> tuple[DataFrame, Model]:
    """Counts of all words and contexts (a kept table by range of keys) and the model, from the column ``text``."""
    counted = texts.mapInArrow(_count_words(parts), _COUNTS_DDL)
    vocabulary = keep_table(counted.groupBy("part").applyInArrow(_add_words, _VOCABULARY_DDL), "vocabulary")
    pairs = np.zeros(((1 << SIGNATURE_BITS) + 1) << SIGNATURE_BITS, np.int64)
    for row in vocabulary.where(F.col("part") >= parts).select("keys", "counts").collect():
        pairs[unpack(bytes(row["keys"]), np.uint64).astype(np.int64)] = unpack(bytes(row["counts"]), np.int64)
    vocabulary = vocabulary.where(F.col("part") < parts)
    each = vocabulary.select(F.explode(F.arrays_zip("signatures", "tokens", "words", "once")).alias("s")).select("s.*")
    sums = each.groupBy("signatures").agg(*[F.sum(c).alias(c) for c in ("tokens", "words", "once")]).collect()
    tokens, words, once = (np.zeros(1 << SIGNATURE_BITS) for _ in range(3))
    for row in sums:
        tokens[row["signatures"]], words[row["signatures"]], once[row["signatures"]] = row["tokens"], row["words"], row["once"]
    new = (once.sum() + 0.5) / (tokens.sum() + 1)  # the share of words met once tells how many are yet to come

    stretched = _stretched(pairs.reshape(-1, 1 << SIGNATURE_BITS))
    model = Model(_chances(tokens), stretched.ravel(), tokens, float(new), int(tokens.sum()), int(words.sum()))
    return vocabulary, model


class _Mixer:
    """Weights and refining tables of lanes that read side by side, one set for each bit of a symbol and gate."""

    def __init__(self, lanes: int, bits: int, inputs: int, rate: float = 0.03, refine: float = 0.02):
        self.plain, self.sure = (np.full((inputs, lanes, bits), 1.5 / inputs, np.float32) for _ in range(2))
        self.table = np.tile((1 / (1 + np.exp(-np.linspace(-8, 8, 33)))).astype(np.float32), lanes * bits)
        self.begins = np.arange(0, lanes * bits * 33, 33).reshape(lanes, bits)
        self.rate, self.refine = np.float32(rate), np.float32(refine)

    def step(self, lanes: slice | np.ndarray, inputs: np.ndarray | list[np.ndarray], gate: np.ndarray, bits: np.ndarray) -> np.ndarray:
        """Cost in bits of the next symbol of some lanes; then everything used learns from its bits."""
        inputs, second = np.asarray(inputs), gate.astype(np.float32)
        first = 1 - second  # products with these two choose weights by the gate without a branch
        weights = self.plain[:, lanes] * first
        weights += self.sure[:, lanes] * second
        weights *= inputs
        dot = weights.sum(axis=0)
        np.clip(dot, -8, 8, out=dot)
        mixed = 1 / (1 + np.exp(-dot))
        own = self.begins[lanes] + ((dot + np.float32(8)) * np.float32(2)).astype(np.int64)
        refined = self.table.take(own)
        bit = bits.astype(np.float32, copy=False)
        error = (bit - mixed) * self.rate
        first *= error
        second *= error
        self.plain[:, lanes] += np.multiply(first, inputs, out=weights)
        self.sure[:, lanes] += np.multiply(second, inputs, out=weights)
        self.table[own] = refined + self.refine * (bit - refined)
        one = np.clip(np.float32(0.5) * (mixed + refined), 1 / 4096, 1 - 1 / 4096)
        return -np.log2(np.abs(one - (1 - bit))).sum(axis=1)


@dataclass
class _Told:
    """Answers to the different keys that a piece has asked for."""

    keys: np.ndarray
    answers: InitVar[np.ndarray]
    odds: np.ndarray = field(init=False)
    sure: np.ndarray = field(init=False)

    def __post_init__(self, answers: np.ndarray):
        self.odds, self.sure = (answers >> 1).astype(np.float32), (answers & 1).astype(bool)
        self.odds /= np.float32(_STEPS)

    def inputs(self, places: list[np.ndarray], out: np.ndarray) -> np.ndarray:
        """Predictions of each context are put out; returns whether the last was met at the node more than once."""
        for place, own in zip(places, out, strict=True):
            self.odds.take(place, axis=0, out=own, mode="clip")
        return self.sure.take(places[-1], axis=0)


def _side_by_side(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """In which order lanes that lie one after the other, longest first, are read side by side, and where each step ends."""
    ends = np.cumsum(sizes)
    step = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)
    return np.argsort(step.astype(np.min_scalar_type(SEGMENT)), kind="stable"), np.cumsum(np.bincount(step))


def _signature_bits(tokens: Tokens, read: np.ndarray, model: Model, told: _Told, places: list[np.ndarray]) -> np.ndarray:
    """Bits of the signature of every token read, which are those met before, given the places of their keys among the answers.

    Texts are read side by side, long ones in segments; contexts reach across.
    """
    cost = np.zeros(len(tokens.signatures))
    segment = np.cumsum((np.arange(len(cost)) - tokens.first[tokens.owner]) % SEGMENT == 0)[read]
    begins = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]]) if len(read) else read
    lengths = np.diff(np.r_[begins, len(read)])
    order = np.argsort(-lengths, kind="stable")
    pair = tokens.signatures_before()[read] << SIGNATURE_BITS | tokens.signatures[read]
    nodes_of, bits_of = _path(np.arange(1 << SIGNATURE_BITS), SIGNATURE_BITS)
    nodes_of, bits_of = nodes_of.astype(np.int64), bits_of.astype(np.float32)
    pairs, rows = _places_below(len(model.stretched), pair)
    stretched = model.stretched.take((pairs & ~int(_SYMBOL))[:, None] + nodes_of[pairs & int(_SYMBOL)])  # a row for each pair that is read
    for at in range(0, len(order), LANES):
        starts, sizes = begins[order[at : at + LANES]], lengths[order[at : at + LANES]]
        mixer = _Mixer(len(starts), SIGNATURE_BITS, CONTEXTS + 1)
        local = np.tile(model.own, len(starts))
        own, held = np.arange(len(starts))[:, None] * len(model.own), np.empty((CONTEXTS + 1, len(starts), SIGNATURE_BITS), np.float32)
        turn, ends = _side_by_side(sizes)
        turn = (np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(len(turn)))[turn]
        symbols, row, asked, costs = pair[turn] & int(_SYMBOL), rows[turn], [p[turn] for p in places], []
        for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
            nodes, bits = nodes_of.take(symbols[a:b], axis=0), bits_of.take(symbols[a:b], axis=0)
            at_node, inputs = own[: b - a] + nodes, held[:, : b - a]
            seen = local.take(at_node)
            stretched.take(row[a:b], axis=0, out=inputs[0], mode="clip")
            sure = told.inputs([p[a:b] for p in asked], inputs[1:-1])
            np.log(seen / (1 - seen), out=inputs[-1])
            costs.append(mixer.step(slice(b - a), inputs, sure, bits))
            local[at_node] = np.clip(seen + np.float32(0.05) * (bits - seen), 0.002, 0.998)
        cost[read[turn]] = np.concatenate(costs)
    return cost


def _letter_bits(tokens: Tokens, chosen: np.ndarray, told: _Told) -> np.ndarray:
    """Bits of the letters of some tokens and the space after each. Lanes read many words one after the other."""
    word, value, keys = _letters_of(tokens, chosen)
    found = [_places(k) for k in keys]
    places = [np.searchsorted(told.keys, each)[place] for each, _, place in found]
    cost = np.zeros(len(value))
    edges = np.linspace(0, len(value), LETTER_LANES + 1).astype(np.int64)
    starts, sizes = edges[:-1], np.diff(edges)
    mixer = _Mixer(LETTER_LANES, 8, LETTER_CONTEXTS)
    bits_of, least = _path(np.arange(256), 8)[1].astype(np.float32), int(sizes.min())
    for t in range(int(sizes.max())):
        lanes = slice(None) if t < least else np.flatnonzero(sizes > t)
        i = starts[lanes] + t
        inputs = np.empty((LETTER_CONTEXTS, len(i), 8), np.float32)
        sure = told.inputs([p[i] for p in places], inputs)
        cost[i] = mixer.step(lanes, inputs, sure, bits_of[value[i]])
    return np.bincount(word, cost, minlength=len(chosen))


def _again_bits(tokens: Tokens, fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which new words their text has brought before, and the bits of saying so and of which one it is."""
    if not len(fresh):
        return np.zeros(0, bool), np.zeros(0)
    owner = tokens.owner[fresh]
    order = np.lexsort((np.arange(len(fresh)), tokens.keys[fresh], owner))
    same = (tokens.keys[fresh][order][1:] == tokens.keys[fresh][order][:-1]) & (owner[order][1:] == owner[order][:-1])
    again = np.zeros(len(fresh), bool)
    again[order[1:]] = same
    begin = np.searchsorted(owner, owner)  # owners ascend
    so_far = np.r_[0, np.cumsum(again)[:-1]]
    repeats, seen = so_far - so_far[begin], np.arange(len(fresh)) - begin
    chance = np.where(seen > 0, (repeats + 0.5) / (seen + 2), 0.0)
    return again, -np.log2(np.where(again, chance / np.maximum(seen - repeats, 1), 1 - chance))


def _token_bits(tokens: Tokens, counts: np.ndarray, model: Model, after: _Told, places: list[np.ndarray], letters: _Told) -> np.ndarray:
    """Bits of every token, given the counts of all in the training texts, and the places of answers to those met there."""
    met = counts > 0
    fresh = np.flatnonzero(~met)
    before = np.r_[0, np.cumsum(~met)[:-1]] if len(met) else np.zeros(0)
    begin = tokens.first[tokens.owner]
    new = (before - before[begin] + NEW_WEIGHT * model.new) / (np.arange(len(met)) - begin + NEW_WEIGHT)
    bits = -np.log2(np.where(met, 1 - new, new))
    known = _signature_bits(tokens, np.flatnonzero(met), model, after, places)
    of_signature = np.log2(np.maximum(model.signature_tokens, 1))
    bits += np.where(met, known + of_signature[tokens.signatures] - np.log2(np.maximum(counts, 1)), 0)
    again, cost = _again_bits(tokens, fresh)
    bits[fresh] += cost
    unseen = fresh[~again]
    bits[unseen] += _letter_bits(tokens, unseen, letters)
    return bits


_ASKED = pa.schema([("part", pa.int32()), ("piece", pa.int32()), ("keys", pa.binary())])
_TOLD_DDL = "part int, piece int, counts binary"
_TOLD = pa.schema([("part", pa.int32()), ("piece", pa.int32()), ("counts", pa.binary())])
_AFTER_DDL = "part int, piece int, after binary, letters binary"
_AFTER = pa.schema([("part", pa.int32()), ("piece", pa.int32()), ("after", pa.binary()), ("letters", pa.binary())])


def _in_order(table: pa.Table) -> pa.Table:
    """Letters of new words are read one text after the other: always in the same order."""
    return table.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def _ask(parts: int):
    """Different keys of a piece, by range."""

    def run(table: pa.Table) -> pa.Table:
        keys = _distinct(Tokens(texts_of(table, "text")).keys)
        piece = table.column("piece")[0].as_py()
        return pa.Table.from_pylist([{"part": p, "piece": piece, "keys": _press_keys(keys[a:b])} for p, a, b in part_cuts(keys, parts)], _ASKED)

    return run


def _tell(asked: pa.Table, vocabulary: pa.Table) -> pa.Table:
    """To every piece the counts of its keys in their order, 0 for those that training texts have not."""
    known = np.concatenate([np.empty(0, np.uint64), *(unpack(x, np.uint64) for x in vocabulary.column("keys").to_pylist())])
    number = np.concatenate([np.empty(0, np.int64), *(unpack(x, np.int64) for x in vocabulary.column("counts").to_pylist())])
    known, number = np.append(known, np.uint64(0)), np.append(number, 0)  # a last one for keys beyond all others
    rows = []
    for row in asked.to_pylist():
        keys = _unpress_keys(row["keys"])
        at = np.searchsorted(known[:-1], keys)
        rows.append({"part": row["part"], "piece": row["piece"], "counts": _press(np.where(known[at] == keys, number[at], 0))})
    return pa.Table.from_pylist(rows, _TOLD)


def _by_part(told: pa.Table, name: str) -> dict[int, bytes]:
    """What the parts have told a piece in a column."""
    return {p: x for p, x in zip(told.column("part").to_pylist(), told.column(name).to_pylist(), strict=True) if x is not None}


def _counts_of(tokens: Tokens, told: pa.Table, parts: int) -> np.ndarray:
    """For every token its count in the training texts."""
    keys, _, place = tokens.words
    numbers = _by_part(told, "counts")
    found = np.zeros(len(keys), np.int64)
    for part, a, b in part_cuts(keys, parts):
        found[a:b] = _unpress(numbers[part], np.int64)
    return found[place]


def _context_keys(tokens: Tokens, some: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Different keys of some tokens after each context, and for every token the place of its key among them.

    Contexts are numbered in the order of their hashes, so that a table can hold the numbers, or they leave room for an index.
    """
    for number, hashes in tokens.context_words():
        used, number = _places_below(len(hashes), number[some])
        contexts, rank = np.unique(hashes[used] & ~_SYMBOL, return_inverse=True)
        codes, size = rank[number] << SIGNATURE_BITS | tokens.signatures[some], len(contexts) << SIGNATURE_BITS
        if size <= 4 * len(codes):
            codes, place = _places_below(size, codes)
        else:
            bits = np.uint64(64 - size.bit_length())
            codes, _, place = _places(codes.astype(np.uint64) << bits)
            codes >>= bits
        codes = codes.astype(np.int64)
        yield contexts[codes >> SIGNATURE_BITS] | (codes & int(_SYMBOL)).astype(np.uint64), place


def _letter_keys(tokens: Tokens, met: np.ndarray) -> np.ndarray:
    """Different keys of the letters of a piece's new words."""
    keys, first, _ = tokens.words
    return _distinct(np.concatenate(_letters_of(tokens, first[~met[first]])[2]))


def _merged(each: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Different keys of all, in order, and for the sorted keys of each their places among them."""
    keys = _distinct(np.concatenate(each))
    return keys, [np.searchsorted(keys, own) for own in each]


def _ask_after(parts: int):
    """Different keys after contexts of a piece, by range."""

    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        if not len(table):
            return _AFTER.empty_table()
        tokens, piece = Tokens(texts_of(table, "text")), table.column("piece")[0].as_py()
        met = _counts_of(tokens, told, parts) > 0
        after, letters = _distinct(np.concatenate([k[met] for k in _keys(tokens.contexts(), tokens.signatures)])), _letter_keys(tokens, met)
        rows = [{"part": p, "piece": piece, "after": _press_keys(after[a]), "letters": _press_keys(letters[b])} for p, (a, b) in _dealt(parts, after, letters)]
        return pa.Table.from_pylist(rows, _AFTER)

    return run


def _tell_keys(after: np.ndarray, counts: np.ndarray, asked: list[bytes], bits: int) -> Iterator[bytes]:
    """What is told to each piece about its keys, worked out for several pieces at once."""
    runs, held, running = [], 0, _running(after, counts, bits)
    for number, data in enumerate(asked, 1):
        runs.append(_unpress_keys(data))
        held += len(runs[-1])
        if held < _KEYS_AT_ONCE and number < len(asked):
            continue
        some = [i for i, run in enumerate(runs) if len(run)]
        begins = np.cumsum([0, *map(len, runs)])[some].astype(np.int64)
        keys = np.concatenate(runs)
        news = list(_new_nodes(keys, begins, bits))
        ends = np.cumsum(_runs(news, begins), axis=1)
        told = [np.split(x, e[:-1]) for x, e in zip(_branches(after, *running, keys, news), ends, strict=True)]
        answers = dict(zip(some, zip(*told, strict=True), strict=False))
        yield from (_press(np.concatenate(answers[i])) if i in answers else b"" for i in range(len(runs)))
        runs, held = [], 0


def _tell_after(asked: pa.Table, vocabulary: pa.Table) -> pa.Table:
    """To every piece what the contexts of the keys that it asks for have counted."""
    after = np.concatenate([np.empty(0, np.uint64), *map(_unpress_keys, vocabulary.column("after").to_pylist())])
    counts = np.concatenate([np.empty(0, np.int64), *(_unpress(x, np.int64) for x in vocabulary.column("after_counts").to_pylist())])
    told = [pa.array(_tell_keys(after, counts, asked.column(n).to_pylist(), bits), pa.binary()) for n, bits in (("after", SIGNATURE_BITS), ("letters", 8))]
    return pa.Table.from_arrays([asked.column("part"), asked.column("piece"), *told], schema=_AFTER)


_SCORES_DDL = "doc_id long, n_tokens long, n_known long, base_score double, score double, n_bytes long"
_SCORES = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()), ("n_bytes", pa.int64())]
)


def _read_odds(keys: np.ndarray, told: dict[int, bytes], parts: int, bits: int) -> np.ndarray:
    """Answers to the different keys of a piece, from what each part of the range has told."""
    if not len(keys):
        return np.zeros((0, bits), np.int16)
    numbers, begins, ends = map(np.array, zip(*part_cuts(keys, parts), strict=True))
    found, at = np.empty((len(keys), bits), np.int16), 0
    while at < len(numbers):  # some parts at a time, which stay in the cache
        to = max(at + 1, int(np.searchsorted(ends, begins[at] + _READ_AT_ONCE, side="right")))
        own, first = keys[begins[at] : ends[to - 1]], begins[at:to] - begins[at]
        news = list(_new_nodes(own, first, bits))
        edges = np.cumsum(_runs(news, first), axis=0)
        split = [np.split(_unpress(told[part], np.int64), edges[:-1, i]) for i, part in enumerate(numbers[at:to].tolist())]
        found[begins[at] : ends[to - 1]] = _odds([np.concatenate(level) for level in zip(*split, strict=True)], own, news, bits)
        at = to
    return found


def _score(model, parts: int):
    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        if not len(table):
            return _SCORES.empty_table()
        table = _in_order(table)
        known, texts = model.value, texts_of(table, "text")
        tokens = Tokens(texts)
        counts = _counts_of(tokens, told, parts)
        met = counts > 0
        own, places = zip(*_context_keys(tokens, np.flatnonzero(met)), strict=True)
        after, at = _merged(own)
        places = [a[place] for a, place in zip(at, places, strict=True)]
        after, letters = (
            _Told(keys, _read_odds(keys, _by_part(told, name), parts, bits))
            for keys, name, bits in ((after, "after", SIGNATURE_BITS), (_letter_keys(tokens, met), "letters", 8))
        )
        bits = _token_bits(tokens, counts, known, after, places, letters)
        base = np.log10((counts + 1) / (known.tokens + known.words + 1))
        per_text = lambda values: np.bincount(tokens.owner, values, minlength=len(texts))
        columns = [
            table.column("doc_id"), per_text(np.ones(len(bits))).astype(np.int64), per_text(met).astype(np.int64), per_text(base),
            -per_text(bits) * math.log10(2), np.array([len(t) for t in texts], np.int64),
        ]
        return pa.Table.from_arrays([columns[0], *map(pa.array, columns[1:])], schema=_SCORES)

    return run


def score_texts(docs: DataFrame, learns: str, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte`` of every text.

    ``learns`` names a boolean column: texts where it is true are the training texts.
    ``score`` is the model's log10 probability, ``base_score`` that of single words with one added to
    each count, ``bits_per_byte`` the total bits over the bytes of the text.

    Null and empty texts are one token, the end; their ``bits_per_byte`` is null. A null ``learns``
    is false. Without training texts all words are new and the letters cost eight bits or so.
    Null ids and repeated rows are scored like any other; an empty table gives an empty one. Letters are
    counted once for a word and some megabytes of texts, so scores of texts with new words differ a little if
    the same texts are split otherwise among files; the same input gives the same scores.
    """
    let_workers_import(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.col(learns).alias("learns"))
    parts = piece_count(rows, "text", PIECE_BYTES)
    vocabulary, model = learn(rows.where("learns").select("text"), parts)
    held = rows.select("doc_id", "text").withColumn("piece", piece_of(parts, "doc_id", "text"))
    asked = held.groupBy("piece").applyInArrow(_ask(parts), "part int, piece int, keys binary")
    words = vocabulary.select("part", "keys", "counts")
    told = asked.groupBy("part").cogroup(words.groupBy("part")).applyInArrow(_tell, _TOLD_DDL)
    asked = held.groupBy("piece").cogroup(told.groupBy("piece")).applyInArrow(_ask_after(parts), _AFTER_DDL)
    after = vocabulary.select("part", "after", "after_counts")
    after = asked.groupBy("part").cogroup(after.groupBy("part")).applyInArrow(_tell_after, _AFTER_DDL)
    told = told.unionByName(after, allowMissingColumns=True)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    scores = held.groupBy("piece").cogroup(told.groupBy("piece")).applyInArrow(_score(shared, parts), _SCORES_DDL)
    bits = -F.col("score") / math.log10(2)
    return scores.select(
        "doc_id", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score",
        F.when(F.col("n_bytes") > 0, bits / F.col("n_bytes")).alias("bits_per_byte"),
    )
