"""Scores of texts under a trigram model kept in Elias-Fano tries.

The model is dealt by the last word of the context: one part holds everything that can follow
its words.  A part's trie has three levels in the order word, word before it, word to come.  Its
levels are monotone sequences in Elias-Fano form, its pointers too, and a successor is stored
relative to its context: as its rank among the words that follow the shorter context.  Smoothed
probabilities and backoffs are 16-bit codes.  A part is built from the training n-grams of all
documents and asked for the n-grams of all documents in the task that holds it; nothing of the
model passes through the driver but the numbers of tokens and of different words, and for every
part of the vocabulary the counts that occur in it with the numbers of words that have them.
"""

from __future__ import annotations

import mmap
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from .common import LOWER, SOLID, U64, crc_bucket, id_type, joined, mixed, pack, pieces, staged, text_column, unpack, word_hashes, words

#: Text bytes of a piece that is read at once, of a block of pieces, of a part of the vocabulary, of a part of the frequent
#: words' successors, and of a part of the model.
PIECE_BYTES = 8 << 20
BLOCK_BYTES = 32 << 20
WORD_PART_BYTES = 64 << 20
PAIR_PART_BYTES = 128 << 20
#: Packed bytes of the packets that leave a task at once.
BATCH_BYTES = 4 << 20
MODEL_PART_BYTES = 10 << 20
#: Text bytes to a token, roughly: a word that follows more tokens than one part's text has is dealt to several parts.
TOKEN_BYTES = 6
#: Codes of probabilities: steps of 1/4096 of a decade, up to 16 decades.
STEPS = 4096
#: Discounts expected before anything is seen, and how many n-grams that belief weighs.
DISCOUNTS = {2: 0.85, 3: 0.92}
BELIEF = 4.0
#: Every trigram that training saw is kept; the plain model of the tests reads this too.
LEAST_TRIGRAM = 1
START = -1
#: Above the number of any word.
WIDEST = 1 << 40


def mapped(array: np.ndarray) -> np.ndarray:
    """The array in a memory map of its own, read in place; no file of any machine is behind it."""
    if not array.nbytes:
        return array
    region = mmap.mmap(-1, array.nbytes)
    region.write(np.ascontiguousarray(array).tobytes())
    return np.frombuffer(region, dtype=array.dtype)


def _in_byte() -> np.ndarray:
    """Place of every one of every byte, by byte and number of the one."""
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
    return np.argsort(1 - bits, axis=1, kind="stable").astype(np.int64)


IN_BYTE = _in_byte()
#: N-grams that are asked together, few enough for a processor's cache.
ASKED = 1 << 15
#: A stretch of a sequence is read off for a portion that has one value for so many of the stretch, or more.
DENSE = 8


# ---- Elias-Fano sequences ----------------------------------------------------------------


class EliasFano:
    """A non-decreasing sequence of integers below ``universe``.

    Each value is split into low bits, packed, and high bits, written in unary: value ``i`` sets
    bit ``high + i`` of a bit vector.  The places of the zeros say where the values of each high
    part begin, so a value is looked up among the few that share its high part.  Beside the bits
    only the number of ones before every word of 64 is kept; the place of a one or zero is found
    from it and within its word, so a sequence that is asked takes no more room than one that is not.
    """

    def __init__(self, values: np.ndarray, universe: int):
        n = len(values)
        self.n, self.bits = n, max(0, int(universe // max(n, 1)).bit_length() - 1)
        self.size = int(universe >> self.bits) + n + 1
        unary = np.zeros(-(-(self.size + 1) // 64) * 64, dtype=np.uint8)
        for a in range(0, n, ASKED):
            part = values[a : a + ASKED]
            unary[(part >> self.bits) + np.arange(a, a + len(part))] = 1
        self.upper = mapped(np.packbits(unary, bitorder="little").view(np.uint64))
        before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.upper), dtype=np.int64)])
        self.before = mapped(before.astype(np.uint32 if n < 1 << 32 else np.int64))
        self.lower = mapped(self._packed(values))

    def _packed(self, low: np.ndarray) -> np.ndarray:
        out = np.zeros((len(low) * self.bits + 7) // 8 + 8, dtype=np.uint8)
        step = 8192  # a multiple of eight values begins on a byte
        for a in range(0, len(low) if self.bits else 0, step):
            part = ((low[a : a + step, None] >> np.arange(self.bits)) & 1).astype(np.uint8)
            packed = np.packbits(part.reshape(-1), bitorder="little")
            out[a * self.bits // 8 : a * self.bits // 8 + len(packed)] = packed
        return out

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), dtype=np.int64)
        window = np.lib.stride_tricks.as_strided(self.lower[:8].view(np.uint64), (len(self.lower) - 7,), (1,))
        at = i * self.bits
        return ((window[at >> 3] >> (at & 7).astype(U64)) & U64((1 << self.bits) - 1)).astype(np.int64)

    def _place(self, i: np.ndarray, ones: bool) -> np.ndarray:
        """Places of the ones, or zeros, of the numbers ``i``, counted from 0."""
        before = self.before if ones else np.arange(0, 64 * len(self.before), 64) - self.before
        word = np.searchsorted(before, i, side="right") - 1
        left = (i - before[word]).astype(np.uint8)
        bits = self.upper[word] if ones else ~self.upper[word]
        place = word * 64
        for width in (32, 16, 8):  # into the half of the word that holds it
            count = np.bitwise_count(bits & U64((1 << width) - 1))
            further = left >= count
            left -= count * further
            shift = further.astype(np.uint8) * np.uint8(width)
            bits = bits >> shift.astype(U64)
            place += shift
        return place + IN_BYTE[(bits & U64(255)).astype(np.int64), left]

    def _start(self, high: np.ndarray) -> np.ndarray:
        """Index of the first value of every high part: the ones before the zero that opens it."""
        zero = np.maximum(high - 1, 0)
        return np.where(high > 0, self._place(zero, False) - zero, 0)

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        return ((self._place(i, True) - i) << self.bits) | self._low(i)

    def nbytes(self) -> int:
        return self.upper.nbytes + self.before.nbytes + self.lower.nbytes

    def find(self, values: np.ndarray) -> np.ndarray:
        """Index of each value, or -1.

        Values are asked in ascending order, a portion at a time.  Where a portion meets most of the stretch it spans, the
        stretch is read off; else each value is searched for within its high part.
        """
        out = np.full(len(values), -1, dtype=np.int64)
        for a in range(0, len(values) if self.n else 0, ASKED):  # what the search holds is some twenty times its values
            part = values[a : a + ASKED]
            order = np.argsort(part) if (part[1:] < part[:-1]).any() else slice(None)
            part = part[order]
            begin, end = self._start(np.array([part[0] >> self.bits, (part[-1] >> self.bits) + 1]))
            if end - begin > DENSE * len(part):
                out[a : a + ASKED][order] = self._find(part)
            elif begin < end:
                run = self._run(int(begin), int(end))
                at = np.searchsorted(run, part)
                at[at == len(run)] = 0
                out[a : a + ASKED][order] = np.where(run[at] == part, at + begin, -1)
        return out

    def _run(self, begin: int, end: int) -> np.ndarray:
        """The values from one index to another, read off in one go."""
        i = np.arange(begin, end)
        first, last = self._place(i[[0, -1]], True)
        ones = np.flatnonzero(np.unpackbits(self.upper[first >> 6 : (last >> 6) + 1].view(np.uint8), bitorder="little"))
        ones += first & ~63
        return ((ones[np.searchsorted(ones, first) :][: len(i)] - i) << self.bits) | self._low(i)

    def _find(self, values: np.ndarray) -> np.ndarray:
        """Search for the first successor of each value within its high part."""
        high, low = values >> self.bits, values & ((1 << self.bits) - 1)
        a, b = self._start(high), self._start(high + 1)
        stop = b.copy()
        while True:  # all binary searches take a step together
            open_ = np.flatnonzero(a < b)
            if not len(open_):
                break
            middle = (a[open_] + b[open_]) >> 1
            less = self._low(middle) < low[open_]
            a[open_[less]] = middle[less] + 1
            b[open_[~less]] = middle[~less]
        hit = np.flatnonzero(a < stop)
        out = np.full(len(values), -1, dtype=np.int64)
        hit = hit[self._low(a[hit]) == low[hit]]
        out[hit] = a[hit]
        return out


# ---- the trie of one part ----------------------------------------------------------------


def _coded(probability: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-np.log10(probability) * STEPS), 0, 65535).astype(np.uint16)


def _codes(probability: np.ndarray) -> np.ndarray:
    return mapped(_coded(probability))


def _counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values and their counts; ``values`` is sorted in place."""
    values.sort()
    first = np.flatnonzero(np.concatenate([[True] * bool(len(values)), values[1:] != values[:-1]]))
    return values[first], np.diff(first, append=len(values))


def _ranked(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values, and the rank of every value among them; sorted values take no sort."""
    if (values[1:] < values[:-1]).any():
        return np.unique(values, return_inverse=True)
    fresh = np.ones(len(values), dtype=bool)
    fresh[1:] = values[1:] != values[:-1]
    return values[fresh], np.cumsum(fresh, dtype=np.int32 if len(values) < 1 << 31 else np.int64) - 1


class Trie:
    """Bigrams and trigrams of one part, from counts: ``w2 -> w3`` and ``w2, w1 -> w3``.

    ``words`` are the part's words, known by their rank; ``unigram`` their base probabilities.
    Absolute discounting with interpolation: an n-gram's probability is its discounted share plus
    the discounted mass times the probability one order down; only the latter where it is unseen.
    A list of triples is emptied, so that they are let go as they are read.
    """

    def __init__(self, unigram: np.ndarray, pair: np.ndarray, pair_count: np.ndarray, triple: tuple[np.ndarray, ...] | list[np.ndarray], triple_count: np.ndarray):
        size = self.size = len(unigram)
        self.unigram = _codes(unigram)
        # level 2: successors of every word, at rank(word) * size + successor
        word, follower = pair // size, pair % size
        self.successors = EliasFano(pair, size * size)
        begin = np.searchsorted(word, np.arange(size + 1))
        self.children = EliasFano(begin, len(pair) + 1)
        total = np.bincount(word, pair_count, size)
        kinds = np.diff(begin)
        discount = self._discount(2, np.bincount(word, pair_count == 1, size), np.bincount(word, pair_count == 2, size))
        mass = discount * kinds / np.maximum(total, 1)
        mass[kinds == 0] = 1.0
        p2 = (pair_count - discount[word]) / total[word] + mass[word] * unigram[follower]
        self.p2, self.backoff2 = _codes(p2), _codes(mass)
        # level 3: contexts (word, word before it); a successor is its rank among those of the word
        w1, w2, w3 = triple
        if isinstance(triple, list):
            triple.clear()
        wide = np.int64(size)
        contexts, inverse = _ranked(w2 * wide + w1)
        del w1
        total = np.bincount(inverse, triple_count, len(contexts))
        once, twice = np.bincount(inverse, triple_count == 1, len(contexts)), np.bincount(inverse, triple_count == 2, len(contexts))
        discount = self._discount(3, once, twice)
        del once, twice
        mass = 1 - np.bincount(inverse, triple_count - discount[inverse], len(contexts)) / np.maximum(total, 1)
        self.contexts = EliasFano(contexts, size * size)
        width = np.diff(begin)[contexts // size] if len(contexts) else np.zeros(0, dtype=np.int64)
        base = np.concatenate([[0], np.cumsum(width)])
        self.base = EliasFano(base, int(base[-1]) + 1)
        at2 = self.successors.find(w2 * wide + w3)
        del w3
        p3 = np.empty(len(at2), dtype=np.uint16)
        for a in range(0, len(at2), ASKED):
            i, j = inverse[a : a + ASKED], at2[a : a + ASKED]
            p3[a : a + ASKED] = _coded((triple_count[a : a + ASKED] - discount[i]) / total[i] + mass[i] * p2[j])
        for a in range(0, len(at2), ASKED):
            at2[a : a + ASKED] += base[inverse[a : a + ASKED]] - begin[w2[a : a + ASKED]]
        del inverse, w2
        if (at2[1:] < at2[:-1]).any():
            order = np.argsort(at2, kind="stable")
            at2, p3 = at2[order], p3[order]
        self.relative = EliasFano(at2, int(base[-1]) + 1)
        self.p3, self.backoff3 = mapped(p3), _codes(mass)

    @staticmethod
    def _discount(order: int, once: np.ndarray, twice: np.ndarray) -> np.ndarray:
        """Of every context, from how many of its successors stand once and twice."""
        return (once + DISCOUNTS[order] * BELIEF) / (once + 2 * twice + BELIEF)

    def ask(self, w1: np.ndarray, w2: np.ndarray, w3: np.ndarray) -> np.ndarray:
        """Code of the probability of ``w3`` after ``w1 w2``, summed over the backoffs it takes.

        Repeated n-grams of a portion are asked once, and all in the order of the trie; those that come so are taken as they are.
        """
        out = np.zeros(len(w3), dtype=np.int64)
        wide = np.int64(self.size)
        for a in range(0, len(w3), ASKED):
            x, y, z = (w[a : a + ASKED].astype(np.int64) for w in (w1, w2, w3))
            if self.size < 1 << 21:  # three ranks of 21 bits fit into one number
                key = (y * wide + x) * wide + z
                if (key[1:] > key[:-1]).all():
                    out[a : a + ASKED] = self._ask(x, y, z)
                    continue
                key, again = np.unique(key, return_inverse=True)
                context = key // wide
                out[a : a + ASKED] = self._ask(context % wide, context // wide, key % wide)[again]
            else:
                out[a : a + ASKED] = self._ask(x, y, z)
        return out

    def _ask(self, w1: np.ndarray, w2: np.ndarray, w3: np.ndarray) -> np.ndarray:
        at2 = self.successors.find(w2 * self.size + w3)
        code = np.where(at2 >= 0, self.p2[np.maximum(at2, 0)] if len(self.p2) else 0, self.backoff2[w2].astype(np.int64) + self.unigram[w3]).astype(np.int64)
        # neighbours share their context, which is looked up once for all of them
        context = w2 * self.size + w1
        fresh = np.ones(len(context), dtype=bool)
        fresh[1:] = context[1:] != context[:-1]
        own = np.cumsum(fresh) - 1
        found = self.contexts.find(context[fresh])
        seen = np.flatnonzero(found >= 0)
        if len(seen):
            backoff, shift = np.zeros(len(found), dtype=np.int64), np.zeros(len(found), dtype=np.int64)
            backoff[seen] = self.backoff3[found[seen]]
            shift[seen] = self.base[found[seen]] - self.children[w2[fresh][seen]]
            code += backoff[own]
            inside = np.flatnonzero((found[own] >= 0) & (at2 >= 0))
            at3 = self.relative.find(shift[own[inside]] + at2[inside])
            code[inside[at3 >= 0]] = self.p3[at3[at3 >= 0]]
        return code

    def nbytes(self) -> int:
        parts = (self.successors, self.children, self.contexts, self.base, self.relative)
        return sum(p.nbytes() for p in parts) + sum(a.nbytes for a in (self.unigram, self.p2, self.backoff2, self.p3, self.backoff3))


# ---- blocks and parts --------------------------------------------------------------------


def word_numbers(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Numbers of the lower-cased words of all texts, each text closed by an end; the words; tokens per text.

    The end is the empty word, the last of the words.
    """
    buffer, offsets = joined(texts)
    low = LOWER[buffer]
    starts, stops, counts = words(low, offsets)
    at = np.concatenate([[0], np.cumsum(stops - starts)]).astype(np.int64)
    data = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(low[SOLID[low]])])
    encoded = data.dictionary_encode()
    vocabulary = pa.concat_arrays([encoded.dictionary, pa.array([b""], pa.large_binary())])
    tokens = np.full(len(starts) + len(counts), len(vocabulary) - 1, dtype=np.int32)
    own = np.ones(len(tokens), dtype=bool)
    own[np.cumsum(counts + 1) - 1] = False
    tokens[own] = encoded.indices.to_numpy(zero_copy_only=False)
    return tokens, vocabulary, counts + 1


def word_bytes(vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of words and the offsets between them."""
    _, ends, data = vocabulary.buffers()
    ends = np.frombuffer(ends, dtype=np.int64)[vocabulary.offset : vocabulary.offset + len(vocabulary) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return data[ends[0] : ends[-1]], ends - ends[0]


def part_of_words(vocabulary: pa.Array, parts: int) -> np.ndarray:
    """The part of the vocabulary that each word belongs to; the empty word belongs to the first."""
    data, ends = word_bytes(vocabulary)
    out, full = np.zeros(len(vocabulary), dtype=np.min_scalar_type(parts)), np.flatnonzero(ends[1:] > ends[:-1])
    out[full] = word_hashes(data, ends[:-1][full], ends[1:][full]) % U64(parts)
    return out


def by_count(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of words by their counts, the most frequent first, and every word's rank: frequent words get small numbers, which pack well."""
    order = np.argsort(-counts, kind="stable")
    rank = np.empty(len(counts), dtype=np.int64)
    rank[order] = np.arange(len(counts))
    return order, rank


def merged(pieces_: list[tuple[np.ndarray, pa.Array, np.ndarray]]) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """What ``word_numbers`` gives of several pieces, as of one; frequent words first."""
    encoded = pa.concat_arrays([v for _, v, _ in pieces_]).dictionary_encode()
    number, at, tokens = encoded.indices.to_numpy(zero_copy_only=False), 0, []
    for own, vocabulary, _ in pieces_:
        tokens.append(number[at + own])
        at += len(vocabulary)
    tokens = np.concatenate(tokens)
    order, rank = by_count(np.bincount(tokens))
    return rank.astype(np.int32)[tokens], encoded.dictionary.take(pa.array(order)), np.concatenate([c for _, _, c in pieces_])


class WordCounts:
    """Training counts by word number.

    Within a part of the vocabulary words are numbered by falling count, so the numbers at which
    the count changes say it all: they are few, a part of n tokens has less than the root of 2 n.
    """

    def __init__(self, bodies: list[tuple[int, bytes]], parts: int):
        self.bodies, self.parts, self.keys, self.counts = bodies, parts, None, None

    @staticmethod
    def steps(falling: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ranks at which falling counts change, as steps, and the counts from there."""
        first = np.flatnonzero(np.diff(falling, prepend=-1))
        return narrow(np.diff(first, prepend=0)), narrow(falling[first])

    def __call__(self, number: np.ndarray) -> np.ndarray:
        if self.keys is None:
            read = [(part, unpack(body)) for part, body in sorted(self.bodies)]
            self.keys = np.concatenate([part * WIDEST + np.cumsum(b[1], dtype=np.int64) for part, b in read])
            self.counts = np.concatenate([b[2].astype(np.int64) for _, b in read])
        return self.counts[np.searchsorted(self.keys, number % self.parts * WIDEST + number // self.parts, side="right") - 1]


def narrow(values: np.ndarray) -> np.ndarray:
    """Numbers that are not negative in the smallest type that holds them."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))


def _summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys and the sums of their times."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True] * bool(len(keys)), keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(times[order], first) if len(first) else np.zeros(0, dtype=np.int64)


class Dealing:
    """Which part of a model holds the n-grams after ``w1 w2``, by the words' numbers.

    A word of up to ``hot`` training tokens has one part.  The others have several, each by the
    word before; their parts are laid one behind the other around the model, so that none gets
    more of them than the next.  The start of a text, which has but one context, is dealt by the word to come.
    """

    def __init__(self, parts: int, hot: int, number: np.ndarray, count: np.ndarray):
        order = np.argsort(number)
        self.parts, self.number = parts, number[order]
        self.spread = -(-count[order] // hot)
        self.first = np.cumsum(self.spread) - self.spread

    def split(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the ascending ``number`` have several parts, and their places among those that do."""
        at = np.searchsorted(number, self.number)
        there = np.flatnonzero(at < len(number))
        there = there[number[at[there]] == self.number[there]]
        return at[there], there

    def parts_of(self, w1: np.ndarray, w2: np.ndarray, w3: np.ndarray, number: np.ndarray) -> np.ndarray:
        """The part of every n-gram; words are places among the ascending ``number``."""
        first, spread = (mixed(number.astype(U64)) % U64(self.parts)).astype(np.int32), np.ones(len(number), dtype=np.int32)
        at, own = self.split(number)
        first[at], spread[at] = self.first[own] % self.parts, self.spread[own]
        part = first[w2]
        several = np.flatnonzero(spread[w2] > 1)
        by = np.where(number[w2[several]] == START, w3[several], w1[several])
        part[several] = (part[several] + number[by] % spread[w2[several]]) % self.parts
        return part.astype(np.min_scalar_type(self.parts))

    def all_parts(self, own: int) -> list[int]:
        """The parts of one of the words that have several."""
        return sorted({int(self.first[own] + k) % self.parts for k in range(int(self.spread[own]))})


def scored(docs: DataFrame, trains: Column, hot: int | None = None, model_part: int = MODEL_PART_BYTES) -> DataFrame:
    """``doc_id, trains, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    The model is learned from the rows for which ``trains`` holds (null: not), and scores all.
    Tokens are the lower-cased words of a text and one end.  ``base_score`` is the log10
    probability under single words with half a count added, one unknown word included; ``score``
    under the trigram model, whose last resort is the base.  A null or empty text is one end.
    Repeated rows are trained on and scored each; null ids are kept; other columns are not read.
    Without training rows all tokens are unknown and every score is the base's; an empty table
    gives an empty one.

    Words that follow more tokens than half a part's share of the text has (``hot``) are dealt to several
    parts by the word before them; the successors of such a word are counted first, and every one of
    its parts gets them all, so its probabilities are the same as in a single part.  The starts of texts
    are such a word too, and their successors are those of their one context.
    """
    ids = id_type(docs)
    hot = max(1, model_part // (2 * TOKEN_BYTES)) if hot is None else hot
    total = docs.select(F.sum(F.octet_length(text_column()))).first()[0] or 0
    word_parts = max(1, -(-total // WORD_PART_BYTES))
    pair_parts = max(1, -(-total // PAIR_PART_BYTES))
    model_parts = max(1, -(-total // model_part))
    names = ["kind", "block", "part", "body", "ids", "flags"]
    packet = f"kind string, block bigint, part int, body binary, ids array<{ids}>, flags array<boolean>"

    def packets(rows: list[tuple], id_kind: pa.DataType) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.list_(id_kind), pa.list_(pa.bool_())]
        columns = list(zip(*rows)) if rows else [[]] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def cut_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, size = TaskContext.get().partitionId() << 32, [], 0
        for piece in pieces(batches, PIECE_BYTES):
            own = pc.sum(pc.binary_length(piece.column("text"))).as_py()
            if held and size + own > BLOCK_BYTES:
                yield block_of(block, held)
                block, held, size = block + 1, [], 0
            held.append((*word_numbers(piece.column("text")), piece.column("doc_id"), piece.column("trains").to_numpy(zero_copy_only=False).astype(bool)))
            size += own
        if held:
            yield block_of(block, held)

    def block_of(block: int, held: list[tuple]) -> pa.RecordBatch:
        """A block's tokens, and its words with their training counts for every part of the vocabulary."""
        tokens, vocabulary, counts = merged([h[:3] for h in held])
        flags = np.concatenate([h[4] for h in held])
        train = np.bincount(tokens[np.repeat(flags, counts)], minlength=len(vocabulary))
        part = part_of_words(vocabulary, word_parts)
        rows = [("block", block, -1, pack(narrow(tokens), narrow(counts), part), [i for h in held for i in h[3].to_pylist()], flags.tolist())]
        order = np.argsort(part, kind="stable")
        data, ends = word_bytes(vocabulary.take(pa.array(order)))
        cuts = np.searchsorted(part[order], np.arange(word_parts + 1))
        for p in np.flatnonzero(np.diff(cuts)):
            a, b = cuts[p], cuts[p + 1]
            body = pack(narrow(train[order[a:b]]), narrow(np.diff(ends[a : b + 1])), data[ends[a] : ends[b]])
            rows.append(("words", block, int(p), body, None, None))
        return packets(rows, held[0][3].type)

    def count_words(table: pa.Table) -> pa.Table:
        """Ranks of the words of one part by their training counts, per block that asked; the counts by rank for all."""
        id_kind = table.schema.field("ids").type.value_type
        blocks = table.column("block").to_numpy()
        order = np.argsort(blocks, kind="stable")
        part = table.column("part")[0].as_py()
        counts, asked = [], []
        for i in order:
            train, lengths, data = unpack(table.column("body")[int(i)].as_py())
            ends = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
            asked.append(pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(data)]))
            counts.append(train)
        encoded = pa.concat_arrays(asked).dictionary_encode()
        number = encoded.indices.to_numpy(zero_copy_only=False)
        total_count = np.bincount(number, np.concatenate(counts)).astype(np.int64)
        falling, rank = by_count(total_count)
        stats = pack(np.array([total_count.sum(), (total_count > 0).sum(), (total_count > hot).sum()], dtype=np.int64), *WordCounts.steps(total_count[falling]))
        rows, at = [("stats", -1, part, stats, None, None)], 0
        for i, c in zip(order, counts):
            rows.append(("known", int(blocks[i]), part, pack(narrow(rank[number[at : at + len(c)]])), None, None))
            at += len(c)
        return pa.Table.from_batches([packets(rows, id_kind)])

    texts = docs.select("doc_id", F.coalesce(trains, F.lit(False)).alias("trains"), text_column().alias("text"))
    blocks = staged(texts.mapInArrow(cut_blocks, packet), "lm-blocks", "kind").select(*names)
    known = staged(blocks.filter("kind = 'words'").groupBy("part").applyInArrow(count_words, packet), "lm-words", "kind").select(*names)

    stats = [(r.part, bytes(r.body)) for r in known.filter("kind = 'stats'").select("part", "body").collect()]
    sums = [(part, unpack(body)[0].tolist()) for part, body in stats]
    n_tokens, n_types = (sum(s[i] for _, s in sums) for i in range(2))
    count_of = WordCounts(stats, word_parts)
    frequent = np.concatenate([np.zeros(0, dtype=np.int64), *(np.arange(s[2]) * word_parts + part for part, s in sums)])
    often = WordCounts(stats, word_parts)(frequent) if len(frequent) else frequent
    n_training = docs.filter(F.coalesce(trains, F.lit(False))).count()
    if n_training > hot:
        frequent, often = np.append(frequent, START), np.append(often, n_training)
    dealing = Dealing(model_parts, hot, frequent, often)

    def opened(table: pa.Table):
        """A block: tokens and the two before each, token counts, whether texts train, and numbers of its words.

        Its words are known by their places among the ascending numbers; the start of a text is the first.
        """
        kinds = table.column("kind").to_pylist()
        own = kinds.index("block")
        tokens, counts, part = unpack(table.column("body")[own].as_py())
        order = np.argsort(part, kind="stable")
        cuts = np.searchsorted(part[order], np.arange(word_parts + 1))
        number = np.empty(len(part), dtype=np.int64)
        for i, kind in enumerate(kinds):
            if kind == "known":
                p = table.column("part")[i].as_py()
                number[order[cuts[p] : cuts[p + 1]]] = unpack(table.column("body")[i].as_py())[0].astype(np.int64) * word_parts + p
        order = np.argsort(number)
        place = np.empty(len(part), dtype=np.int32)
        place[order] = np.arange(1, len(part) + 1)
        number = np.concatenate([[START], number[order]])
        counts = counts.astype(np.int64)
        first = np.cumsum(counts) - counts
        w3 = place[tokens]
        del tokens
        w2 = np.concatenate([w3[:1], w3[:-1]])
        w2[first] = 0
        w1 = np.concatenate([w2[:1], w2[:-1]])
        w1[first] = 0
        flags = np.array(table.column("flags")[own].as_py(), dtype=bool)
        return table.column("block")[own].as_py(), own, w3, w2, w1, counts, flags, number

    def hot_pairs(table: pa.Table) -> pa.Table:
        """Training successors of the words that have several parts, counted in a block and dealt by both words."""
        block, _, w3, w2, _, counts, flags, number = opened(table)
        at, own = dealing.split(number)
        several = np.zeros(len(number), dtype=bool)
        several[at] = True
        use = np.flatnonzero(np.repeat(flags, counts) & several[w2])
        pair, times = _counted(w2[use].astype(np.int64) * len(number) + w3[use])
        place = np.zeros(len(number), dtype=np.int64)
        place[at] = own
        word, follower = place[pair // len(number)], pair % len(number)
        part = ((word + number[follower]) % pair_parts).astype(np.min_scalar_type(pair_parts))
        order = np.argsort(part, kind="stable")
        cuts = np.searchsorted(part[order], np.arange(pair_parts + 1))
        rows = []
        for p in np.flatnonzero(np.diff(cuts)):
            i = order[cuts[p] : cuts[p + 1]]
            steps = np.diff(word[i] * WIDEST + number[follower[i]] + 1, prepend=0)
            rows.append(("pairs", block, int(p), pack(steps, narrow(times[i])), None, None))
        return pa.Table.from_batches([packets(rows, table.schema.field("ids").type.value_type)])

    def hot_successors(table: pa.Table) -> pa.Table:
        """All training successors of these words in one part of the pairs, for every part of the model that holds such a word."""
        bodies = [unpack(b.as_py()) for b in table.column("body")]
        key = np.concatenate([np.cumsum(b[0]) for b in bodies])
        key, times = _summed(key, np.concatenate([b[1].astype(np.int64) for b in bodies]))
        cuts = np.flatnonzero(np.diff(key // WIDEST, prepend=-1, append=-1))
        rows = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            own = int(key[a] // WIDEST)
            body = pack(dealing.number[own : own + 1], narrow(np.diff(key[a:b] % WIDEST, prepend=0)), narrow(times[a:b]))
            rows += [("hot", -1, p, body, None, None) for p in dealing.all_parts(own)]
        return pa.Table.from_batches([packets(rows, table.schema.field("ids").type.value_type)])

    def deal(table: pa.Table) -> pa.Table:
        """The n-grams of a block, dealt to the parts of the model; the block's base scores go to one of them."""
        block, own, w3, w2, w1, counts, flags, number = opened(table)
        id_kind = table.schema.field("ids").type.value_type
        count = count_of(number)
        logs = np.log10((count + 0.5) / (n_tokens + 0.5 * (n_types + 1)))
        first = np.cumsum(counts) - counts
        base = np.add.reduceat(logs[w3], first) if len(first) else np.zeros(0)
        known_tokens = np.add.reduceat((count > 0)[w3], first, dtype=np.int64) if len(first) else np.zeros(0, dtype=np.int64)
        rows = [("base", block, int(block % model_parts), pack(counts, known_tokens, base), table.column("ids")[own].as_py(), flags.tolist())]
        part = dealing.parts_of(w1, w2, w3, number)
        text = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
        held = ~flags[text]
        small = np.min_scalar_type(2 * model_parts + 1)
        order = np.argsort(part.astype(small) * small.type(2) + held, kind="stable")  # of each part, those of training texts first
        part, held = part[order], held[order]
        text = text[order]  # one after the other, so that no two copies of all are held
        w1 = w1[order]
        w2 = w2[order]
        w3 = w3[order]
        del order
        cuts = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(part)]])
        asked, place = np.zeros(len(number), dtype=bool), np.zeros(len(number), dtype=np.int32)
        batches, size = [], 0
        for a, b in zip(cuts[:-1], cuts[1:]):
            if size > BATCH_BYTES:
                batches, rows, size = [*batches, packets(rows, id_kind)], [], 0
            grams = w1[a:b], w2[a:b], w3[a:b]
            for w in grams:
                asked[w] = True
            local = np.flatnonzero(asked)
            asked[local] = False
            place[local] = np.arange(len(local))
            small = np.min_scalar_type(len(local))
            c = a + int(np.searchsorted(held[a:b], True))
            texts = (narrow(np.diff(text[i:j], prepend=0)) for i, j in ((a, c), (c, b)))
            rows.append(("grams", block, int(part[a]), pack(narrow(np.diff(number[local], prepend=START)), *(place[w].astype(small) for w in grams), *texts), None, None))
            size += len(rows[-1][3])
        return pa.Table.from_batches([*batches, packets(rows, id_kind)])

    def model_part_scores(table: pa.Table) -> pa.Table:
        """Builds one part of the model and asks it for every n-gram dealt to it: summed codes by text."""
        kinds = np.array(table.column("kind").to_pylist())
        id_kind = table.schema.field("ids").type.value_type
        part = table.column("part")[0].as_py()
        passed = table.filter(pa.array(kinds == "base")).select(names)
        at = np.flatnonzero(kinds == "grams")
        at = at[np.argsort(table.column("block").to_numpy()[at], kind="stable")]
        if not len(at):
            return passed
        bodies = [unpack(table.column("body")[int(i)].as_py()) for i in at]
        blocks = [table.column("block")[int(i)].as_py() for i in at]
        successors = [unpack(table.column("body")[int(i)].as_py()) for i in np.flatnonzero(kinds == "hot")]
        del table
        steps_of, done = [b[0] for b in bodies] + [h[1] for h in successors], 0
        numbers = np.empty(sum(map(len, steps_of)) + len(successors), dtype=np.int64)
        for steps in steps_of:
            numbers[done : done + len(steps)] = np.cumsum(steps, dtype=np.int64) + START
            done += len(steps)
        numbers[done:] = [h[0][0] for h in successors]
        vocabulary = _counted(numbers)[0]
        del numbers, steps_of
        size, wide = len(vocabulary), np.int64(len(vocabulary))
        n = sum(len(b[1]) for b in bodies)
        w1, w2, w3 = (np.empty(n, dtype=np.int32) for _ in range(3))
        texts_of, flags, done = [], np.zeros(n, dtype=bool), 0
        for k, b in enumerate(bodies):  # each body is let go once it is read
            place = np.searchsorted(vocabulary, np.cumsum(b[0], dtype=np.int64) + START).astype(np.int32)
            for out, ranks in zip((w1, w2, w3), b[1:4]):
                out[done : done + len(ranks)] = place[ranks]
            flags[done : done + len(b[4])] = True
            texts_of.append(b[4:])
            done += len(b[1])
            bodies[k] = b = None
        hot_pair, hot_times = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        for word, steps, times in successors:
            hot_pair.append(np.searchsorted(vocabulary, word) * wide + np.searchsorted(vocabulary, np.cumsum(steps, dtype=np.int64) + START))
            hot_times.append(times.astype(np.int64))
        starts = len(successors) and any(h[0][0] == START for h in successors)
        del successors
        unigram = (count_of(vocabulary) + 0.5) / (n_tokens + 0.5 * (n_types + 1))
        pair = w2[flags] * wide
        pair += w3[flags]
        pair, pair_times = _counted(pair)
        hot_pair = np.concatenate(hot_pair)
        if len(hot_pair):
            whole = np.zeros(size, dtype=bool)
            whole[hot_pair // wide] = True
            keep = ~whole[pair // wide]
            pair, pair_times = _summed(np.concatenate([pair[keep], hot_pair]), np.concatenate([pair_times[keep], *hot_times]))
        key = w2 * wide
        key += w1
        context = None if size < 1 << 21 else _counted(key.copy())[0]  # three ranks of 21 bits fit into one number
        key = (key if context is None else np.searchsorted(context, key)) * wide
        key += w3
        del w1, w2, w3
        order = np.argsort(key)
        key = key[order]
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        first = np.flatnonzero(fresh)
        again = np.empty(n, dtype=np.int32 if n < 1 << 31 else np.int64)
        again[order] = np.cumsum(fresh, dtype=again.dtype) - 1
        times = np.add.reduceat(flags[order], first, dtype=again.dtype)
        key = key[first]
        del order, fresh, first, flags

        def grams(key: np.ndarray) -> list[np.ndarray]:
            before = key // wide
            before = before if context is None else context[before]
            return [(before % wide).astype(np.int32), (before // wide).astype(np.int32), (key % wide).astype(np.int32)]

        seen = times > 0
        triple, times = grams(key[seen]), times[seen]
        if starts:  # the start is the first of the words, and what follows it also follows the context of two starts
            own, rest = slice(0, int(np.searchsorted(pair, wide))), slice(int(np.searchsorted(triple[1], 1)), None)
            first = np.zeros(own.stop, dtype=np.int32), np.zeros(own.stop, dtype=np.int32), pair[own].astype(np.int32)
            triple, times = [np.concatenate([x, w[rest]]) for x, w in zip(first, triple)], np.concatenate([pair_times[own].astype(times.dtype), times[rest]])
            del first
        trie = Trie(unigram, pair, pair_times, triple, times)
        del times, seen, pair, pair_times
        code = np.empty(len(key), dtype=np.int32)
        for a in range(0, len(key), ASKED):
            code[a : a + ASKED] = trie.ask(*grams(key[a : a + ASKED]))
        del key, trie
        rows, done = [], 0
        for block, steps in zip(blocks, texts_of):
            heads = [np.flatnonzero(np.concatenate([[True] * bool(len(x)), x[1:] > 0])) for x in steps]
            texts = (narrow(np.diff(np.cumsum(x, dtype=np.int64)[h], prepend=0)) for x, h in zip(steps, heads))
            length = len(steps[0]) + len(steps[1])
            own = np.add.reduceat(code[again[done : done + length]], np.concatenate([heads[0], heads[1] + len(steps[0])]), dtype=np.int64)
            rows.append(("codes", int(block), part, pack(*texts, narrow(own)), None, None))
            done += length
        out = pa.Table.from_batches([packets(rows, id_kind)])
        return pa.concat_tables([passed.cast(out.schema), out])

    def finish(table: pa.Table) -> pa.Table:
        kinds = table.column("kind").to_pylist()
        own = kinds.index("base")
        counts, known_tokens, base = unpack(table.column("body")[own].as_py())
        code = np.zeros(len(counts), dtype=np.int64)
        for i, kind in enumerate(kinds):
            if kind == "codes":
                trained, held, more = unpack(table.column("body")[i].as_py())
                code[np.concatenate([np.cumsum(x, dtype=np.int64) for x in (trained, held)])] += more.astype(np.int64)
        return pa.table({
            "doc_id": table.column("ids")[own].values, "trains": table.column("flags")[own].values, "n_tokens": pa.array(counts, pa.int64()),
            "n_known": pa.array(known_tokens, pa.int64()), "train_tokens": pa.array(np.full(len(counts), n_tokens), pa.int64()),
            "base_score": pa.array(base, pa.float64()), "score": pa.array(-code / STEPS, pa.float64()),
        })

    both = blocks.filter("kind = 'block'").unionByName(known.filter("kind = 'known'"))
    rows = both.groupBy("block").applyInArrow(deal, packet)
    if len(dealing.number):
        pairs = both.groupBy("block").applyInArrow(hot_pairs, packet)
        rows = rows.unionByName(pairs.groupBy("part").applyInArrow(hot_successors, packet))
    codes = rows.groupBy("part").applyInArrow(model_part_scores, packet)
    return codes.groupBy("block").applyInArrow(
        finish, f"doc_id {ids}, trains boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")


def op1(docs: DataFrame) -> DataFrame:
    out = scored(docs, crc_bucket() != 1)
    return out.select("doc_id", (~F.col("trains")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
