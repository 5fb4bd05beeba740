"""A word-pair language model in a compact trie, and the log probabilities of texts.

The model: p1(w) = (c(w) + 1) / (N + V + 1), which leaves one share for all unknown words, and
p(w | v) = (c(v w) + WEIGHT p1(w)) / (c(v) + WEIGHT), for each word and the end of a text given the word
before it, or the start. Both add up to 1. As the denominator depends on v alone and each word is once
a predicted word and once a context, a text's log10 probability is a sum of what its words and
pairs give on the shard of the predicted word: log10 of the numerator of each pair and, for
each occurrence of a word, less log10(c + WEIGHT) of that word as a context (the start stands for
the end, which occurs as often). No shard needs to know what another one counted.

The trie of a shard goes from the predicted word to its contexts (suffix order). Level 1: hashes
of words, counts, quantised context denominators and quantised numerators of unseen pairs; level 2: the
contexts of each word, and the quantised numerators of seen pairs. Hashes and pointers are
Elias-Fano sequences. Contexts are stored relative to their word: the word's place in level 1 in
the upper half of the number, so the level is one monotone sequence, and a pair is found
by a successor search within the word's range. The levels are one block of bytes in a memory map,
read in place. Logarithms are kept in steps of 1/STEPS in 16 bits.

1. Count: words of the training texts by block, added up by hash; N, V and the hot words (over 1/(2 S) of
   all tokens, so at most 2 S words) are what is taken from it, S being the number of shards.
2. Shards: each block of texts sends each shard its pairs: how often each is in the training texts and
   which documents have it how often. A hot word is dealt to several shards by context; its
   count is then taken from step 1. A pair that DEFER documents or more of a block have sends no
   documents: they stay with the block, and the shard answers for the pair; so a very frequent pair
   is a few bytes a block. The shard adds counts up, builds its trie and asks it for all pairs.
3. Sum: the shards' sums and answers meet the block's documents.

S grows with the corpus: a shard has about SHARD_TOKENS tokens, and a task has one shard. All counts cover all training texts; there is
no cap on words or pairs. Words are known by 64-bit hashes; contexts by 32 bits within a word.

Edge cases: a null or empty text, or one of white space, is its end alone. A null id counts as an empty
one in the choice of training texts, and stays null. Repeated rows count, and are scored, each. With no training
text all counts are 0. No documents give no rows.
"""

from __future__ import annotations

import mmap
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from ._shared import column, materialise, whole_text
from .text_buffers import gathered, slices, words

#: Weight of p1 in p(w | v), in occurrences.
WEIGHT = 4.0
#: Steps of a quantised log10, and what is added to it so that it is above 0.
STEPS, FLOOR = 1024, 24
#: Tokens of a shard, about.
SHARD_TOKENS = 2_000_000
BLOCK, BLOCK_DOCS = 4 << 20, 30_000
#: A pair that so many documents of a block have is answered for; its documents stay with the block.
DEFER = 32
#: Pairs that a shard answers for at a time, about; what one block sent is never split.
TOGETHER = 1 << 18
#: The modulus and remainder of crc32(id) that hold a document out.
HELD_OUT = (7, 2)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
#: Names of the start and the end; neither can be a word.
START, END = b" start", b" end"
_ODD = np.uint64(0x9E3779B97F4A7C15)


def is_held_out(id_col: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.coalesce(column(id_col).cast("string"), F.lit(""))), F.lit(HELD_OUT[0])) == HELD_OUT[1]


class EliasFano:
    """A sorted sequence of n whole numbers: low bits as they are, high bits in unary, zeros counted by words of 64 bits."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, zeros: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.zeros, self.ones = n, low_bits, low, high, zeros, None

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        bits = max((top // n).bit_length() - 1, 0) if n else 0
        rest = values & np.uint64((1 << bits) - 1)
        low = np.zeros((n * bits + 63) // 64 + 1, "<u8")
        for k in range(0, n, 1 << 15):  # a multiple of 64 values fills whole words
            part = rest[k : k + (1 << 15)]
            flags = (part[:, None] >> np.arange(bits, dtype=np.uint64) & np.uint64(1)).astype(np.uint8)
            packed = np.packbits(flags.ravel(), bitorder="little")
            low[k * bits // 64 :].view(np.uint8)[: len(packed)] = packed
        upper = (values >> np.uint64(bits)).astype(np.int64)
        flags = np.zeros(((n + (top >> bits) + 1) // 64 + 1) * 64, np.uint8)
        flags[upper + np.arange(n)] = 1
        high = np.packbits(flags, bitorder="little").view("<u8")
        zeros = np.zeros(len(high) + 1, "<i8")
        np.cumsum(64 - np.bitwise_count(high).astype(np.int64), out=zeros[1:])
        return cls(n, bits, low, high, zeros)

    def _low(self, at: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(at), np.uint64)
        bit = at * self.low_bits
        word, shift = bit >> 6, (bit & 63).astype(np.uint64)
        over = np.where(shift > 0, self.low[word + 1] << (np.uint64(63) - np.maximum(shift, np.uint64(1)) + np.uint64(1)), np.uint64(0))
        return (self.low[word] >> shift | over) & np.uint64((1 << self.low_bits) - 1)

    @staticmethod
    def _selected(bits: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The place of the k-th set bit of each word."""
        at = np.zeros(len(k), np.int64)
        for width in (32, 16, 8, 4, 2, 1):
            n = np.bitwise_count(bits & np.uint64((1 << width) - 1)).astype(np.int64)
            further = k >= n
            k, at = k - n * further, at + width * further
            bits = np.where(further, bits >> np.uint64(width), bits)
        return at

    def _zero(self, k: np.ndarray) -> np.ndarray:
        """The position of the k-th zero of the high bits, from 0."""
        word = np.searchsorted(self.zeros, k, "right") - 1
        return word * 64 + self._selected(~self.high[word], k - self.zeros[word])

    def _before(self, high: np.ndarray) -> np.ndarray:
        """How many numbers have less than these high bits."""
        k = np.maximum(high - 1, 0)
        return np.where(high > 0, self._zero(k) - k, 0)

    def _search(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the place of the first number that is not below each value, whether it is the value)."""
        values = values.astype(np.uint64)
        high, low = (values >> np.uint64(self.low_bits)).astype(np.int64), values & np.uint64((1 << self.low_bits) - 1)
        most = int(self.zeros[-1]) - 1
        beyond = (high < 0) | (high > most)  # below 0: 2^63 or more
        high = np.where(beyond, most, high)
        a, z = self._before(high), self._zero(high) - high
        end = z.copy()
        open_ = np.flatnonzero(a < z)
        while len(open_):
            middle = (a[open_] + z[open_]) >> 1
            less = self._low(middle) < low[open_]
            a[open_], z[open_] = np.where(less, middle + 1, a[open_]), np.where(less, z[open_], middle)
            open_ = open_[a[open_] < z[open_]]
        here = np.flatnonzero((a < end) & ~beyond)
        found = np.zeros(len(values), bool)
        found[here] = self._low(a[here]) == low[here]
        return np.where(beyond, self.n, a), found

    def successor(self, values: np.ndarray) -> np.ndarray:
        """For each value the place of the first number that is not below it; n if there is none."""
        return self._search(values)[0] if self.n else np.zeros(len(values), np.int64)

    def find(self, values: np.ndarray) -> np.ndarray:
        """The place of each value, -1 if it is not there."""
        if not self.n:
            return np.full(len(values), -1)
        at, found = self._search(values)
        return np.where(found, at, -1)

    def at(self, places: np.ndarray) -> np.ndarray:
        """The numbers at these places."""
        if self.ones is None:
            self.ones = np.arange(len(self.zeros)) * 64 - self.zeros
        word = np.searchsorted(self.ones, places, "right") - 1
        high = word * 64 + self._selected(self.high[word], places - self.ones[word]) - places
        return high.astype(np.uint64) << np.uint64(self.low_bits) | self._low(places)

    def parts(self) -> list[np.ndarray]:
        return [np.array([self.n, self.low_bits], "<i8"), self.low, self.high, self.zeros]


def quantised(log: np.ndarray) -> np.ndarray:
    return np.clip(np.rint((log + FLOOR) * STEPS), 0, 0xFFFF).astype("<u2")


class Trie:
    """One shard's levels, read in place from their bytes."""

    def __init__(self, levels: bytes | mmap.mmap | memoryview):
        view, at, arrays = memoryview(levels), 8, []
        (n,) = struct.unpack_from("<q", view)
        for _ in range(n):
            size, kind = struct.unpack_from("<q8s", view, at)
            arrays.append(np.frombuffer(view, kind.rstrip(b"\0").decode(), size, at + 16))
            at += 16 + -(-arrays[-1].nbytes // 8) * 8
        ef = lambda k: EliasFano(*arrays[k].tolist(), *arrays[k + 1 : k + 4])
        self.words, self.counts, self.below, self.unseen = ef(0), arrays[4], arrays[5], arrays[6]
        self.starts, self.contexts, self.seen = ef(7), ef(11), arrays[15]

    @staticmethod
    def levels(hashes: np.ndarray, counts: np.ndarray, pair_word: np.ndarray, pair_context: np.ndarray, pair_counts: np.ndarray, total: int, distinct: int) -> bytes:
        """Words by sorted hash; pairs sorted by (place of the word, context)."""
        p1 = (counts + 1) / (total + distinct + 1)
        arrays = [
            *EliasFano.of(hashes).parts(), counts.astype("<i8"), quantised(np.log10(counts + WEIGHT)), quantised(np.log10(WEIGHT * p1)),
            *EliasFano.of(np.searchsorted(pair_word, np.arange(len(hashes) + 1))).parts(),
            *EliasFano.of(pair_word.astype(np.uint64) << np.uint64(32) | pair_context.astype(np.uint64)).parts(),
            quantised(np.log10(pair_counts + WEIGHT * p1[pair_word])),
        ]
        out = [struct.pack("<q", len(arrays))]
        for a in arrays:
            raw = a.tobytes()
            out += [struct.pack("<q8s", len(a), a.dtype.str.encode()), raw, b"\0" * (-len(raw) % 8)]
        return b"".join(out)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        return self.words.find(hashes)

    def pairs(self, word: np.ndarray, context: np.ndarray) -> np.ndarray:
        """Quantised numerators of known words (places) after these contexts."""
        out = self.unseen[word].astype(np.int64)
        runs = np.flatnonzero(np.diff(word, prepend=-1))
        has = self.starts.at(word[runs]) < self.starts.at(word[runs] + 1)
        some = np.flatnonzero(np.repeat(has, np.diff(runs, append=len(word))))
        at = self.contexts.find(word[some].astype(np.uint64) << np.uint64(32) | context[some].astype(np.uint64))
        some = some[at >= 0]
        out[some] = self.seen[at[at >= 0]]
        return out


def mapped(levels: bytes) -> Trie:
    """The trie in a memory map of its own, outside the heap; given back as soon as it is no longer used."""
    m = mmap.mmap(-1, len(levels))
    m.write(levels)
    return Trie(m)


def _hash(word: bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(word)


def _vocabulary(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tokens of all texts as places in a list, tokens of each text, hashes of the list). Place 0 is the end, which each text ends with."""
    lower = _LOWER[data]
    first, stop = words(lower, offsets)
    size = stop - first
    n = np.diff(np.searchsorted(first, offsets)) + 1
    ends = np.cumsum(n)
    tokens = np.zeros(int(ends[-1]) if len(ends) else 0, np.int64)
    hashes = [_hash(END)]
    if len(first):
        places = np.concatenate(([0], np.cumsum(size)))
        letters = lower[gathered(first, size)]
        cut = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(letters)]).dictionary_encode()
        is_word = np.ones(len(tokens), bool)
        is_word[ends - 1] = False
        tokens[is_word] = cut.indices.to_numpy().astype(np.int64) + 1
        hashes += map(_hash, cut.dictionary.to_pylist())
    return tokens, n, np.array(hashes, np.uint64)


def _in_blocks(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple[list[pa.Array], np.ndarray, np.ndarray]]:
    """(columns, offsets and bytes of the texts) of blocks of some BLOCK bytes and at most BLOCK_DOCS texts."""
    held, size, count = [], 0, 0

    def block() -> tuple[list[pa.Array], np.ndarray, np.ndarray]:
        [(_, offsets, data)] = slices(pa.concat_arrays([x[-1] for x in held]), 1 << 62)
        return [pa.concat_arrays([x[i] for x in held]) for i in range(len(names))], offsets, data

    for batch in batches:
        texts = batch.column("text").cast(pa.large_string())
        for at, offsets, _ in slices(texts, BLOCK // 4):
            for k in range(0, len(offsets) - 1, BLOCK_DOCS // 2):
                n = min(BLOCK_DOCS // 2, len(offsets) - 1 - k)
                here = int(offsets[k + n] - offsets[k])
                if held and (size + here > BLOCK or count + n > BLOCK_DOCS):
                    yield block()
                    held, size, count = [], 0, 0
                held.append([*(batch.column(c).slice(at + k, n) for c in names), texts.slice(at + k, n)])
                size, count = size + here, count + n
    if held:
        yield block()


def _list(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(values.astype(kind.to_pandas_dtype()), kind))


def _signed(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n): the hash of each word of docs, and of the end, and how often it occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, offsets, data in _in_blocks(batches, ()):
            tokens, _, hashes = _vocabulary(data, offsets)
            n = np.bincount(tokens, minlength=len(hashes))
            for k in range(0, len(n), 10_000):
                part = slice(k, k + 10_000)
                yield pa.RecordBatch.from_arrays([pa.array(_signed(hashes)[part]), pa.array(n[part])], names=["word", "n"])

    return docs.select(whole_text(text_col).alias("text")).mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


_SENT = {"words": pa.int64(), "n_contexts": pa.int32(), "contexts": pa.int32(), "trained": pa.int32(), "n_docs": pa.int32(), "ask": pa.int32(), "docs": pa.int16(), "times": pa.int32()}


def _shards_of(word: np.ndarray, context: np.ndarray, hot: np.ndarray, slots: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each pair; hot words are dealt over several by context."""
    slot = np.zeros(len(word), np.uint64)
    if len(hot):
        at = np.minimum(np.searchsorted(hot, word), len(hot) - 1)
        is_hot = hot[at] == word
        slot[is_hot] = (context[is_hot] * _ODD >> np.uint64(33)) % slots[at[is_hot]].astype(np.uint64)
    mixed = (word ^ slot * np.uint64(0xC2B2AE3D27D4EB4F)) * _ODD
    return ((mixed >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)


def block_pairs(tokens: np.ndarray, n: np.ndarray, hashes: np.ndarray, train: np.ndarray, hot: np.ndarray, slots: np.ndarray, shards: int) -> tuple[np.ndarray, dict[str, pa.Array], list[np.ndarray]]:
    """(shards, a list a shard of each column of _SENT, and the deferred pairs' documents: how many each has, which, how often)."""
    known, n_docs_here = len(hashes), len(n)
    starts = np.cumsum(n) - n
    before = np.concatenate(([0], tokens[:-1]))
    before[starts] = known  # the start
    names = np.append(hashes, np.uint64(_hash(START)))
    keys, times = np.unique((tokens * (known + 1) + before) * n_docs_here + np.repeat(np.arange(n_docs_here), n), return_counts=True)
    doc, pair = keys % n_docs_here, keys // n_docs_here
    first = np.flatnonzero(np.diff(pair, prepend=-1))
    word, context = names[pair[first] // (known + 1)], names[pair[first] % (known + 1)]
    many, trained = np.diff(first, append=len(pair)), np.add.reduceat(np.where(train[doc], times, 0), first)
    shard = _shards_of(word, context, hot, slots, shards)
    deferred = many >= DEFER
    ask = np.cumsum(deferred) * deferred
    kept = gathered(first[deferred], many[deferred])
    local = [many[deferred], doc[kept], times[kept]]
    order = np.lexsort((context >> np.uint64(32), word, shard))
    at = gathered(first[order], np.where(deferred, 0, many)[order])
    shard, word, context, trained, ask, sent = shard[order], word[order], context[order], trained[order], ask[order], np.where(deferred, 0, many)[order]
    new_word = np.flatnonzero((np.diff(shard, prepend=-1) != 0) | np.append(True, word[1:] != word[:-1]))
    new_shard = np.flatnonzero(np.diff(shard, prepend=-1))
    ends = np.append(new_shard[1:], len(shard))
    ends_word, ends_docs = np.searchsorted(new_word, ends), np.cumsum(sent)[ends - 1]
    values = {
        "words": (_signed(word[new_word]), ends_word), "n_contexts": (np.diff(new_word, append=len(word)), ends_word),
        "contexts": ((context >> np.uint64(32)).astype(np.uint32).view(np.int32), ends), "trained": (trained, ends), "n_docs": (sent, ends), "ask": (ask, ends),
        "docs": (doc[at], ends_docs), "times": (times[at], ends_docs),
    }
    return shard[new_shard], {name: _list(*x, _SENT[name]) for name, x in values.items()}, local


def sent_pairs(docs: DataFrame, hot: np.ndarray, slots: np.ndarray, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (shard, block, lists of _SENT) and, with ids, a row of each block's documents, dealt to any shard."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        for (ids, train), offsets, data in _in_blocks(batches, ("id", "train")):
            tokens, n, hashes = _vocabulary(data, offsets)
            shard, lists, (many, doc, times) = block_pairs(tokens, n, hashes, train.to_numpy(zero_copy_only=False), hot, slots, shards)
            own = {"ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), "n_tokens": _list(n, [len(n)], pa.int64())}
            own |= {name: _list(x, [len(x)], _SENT[name]) for name, x in (("n_docs", many), ("docs", doc), ("times", times))}
            for to, have in ((shard, lists), (np.array([(block * 31 + (block >> 32)) % shards]), own)):
                types = {name: pa.list_(t) for name, t in _SENT.items()} | {"ids": pa.list_(ids.type), "n_tokens": pa.list_(pa.int64())}
                columns = {"shard": pa.array(to.astype(np.int32)), "block": pa.array(np.full(len(to), block))} | {name: have.get(name, pa.nulls(len(to), t)) for name, t in types.items()}
                rows = pa.RecordBatch.from_arrays([*columns.values()], names=[*columns])
                for k in range(0, len(to), 64):
                    yield rows.slice(k, 64)
            block += 1

    rows = docs.select(column(id_col).alias("id"), (~is_held_out(id_col)).alias("train"), whole_text(text_col).alias("text"))
    lists = ", ".join(f"{name} array<{'long' if t == pa.int64() else 'short' if t == pa.int16() else 'int'}>" for name, t in _SENT.items())
    return rows.mapInArrow(run, f"shard int, block long, {lists}, ids array<{kind}>, n_tokens array<long>")


def _joined(rows: list[pa.RecordBatch], name: str) -> tuple[np.ndarray, np.ndarray]:
    """(values of a list column of all rows, how many each row has)."""
    parts = [r.column(name) for r in rows]
    values = np.concatenate([p.flatten().to_numpy(zero_copy_only=False) for p in parts])
    return values, np.concatenate([pc.list_value_length(p).to_numpy(zero_copy_only=False) for p in parts]).astype(np.int64)


def _unsigned(contexts: np.ndarray) -> np.ndarray:
    return contexts.astype(np.int32).view(np.uint32)


def shard_levels(rows: list[pa.RecordBatch], hot: np.ndarray, hot_counts: np.ndarray, total: int, distinct: int) -> bytes:
    """The trie of a shard from what the blocks sent to it."""
    word = _joined(rows, "words")[0].view(np.uint64)
    n_contexts, trained = _joined(rows, "n_contexts")[0], _joined(rows, "trained")[0]
    names, at = np.unique(word, return_inverse=True)
    key = np.repeat(at, n_contexts).astype(np.uint64) << np.uint64(32) | _unsigned(_joined(rows, "contexts")[0]).astype(np.uint64)
    met = trained > 0
    pairs, where = np.unique(key[met], return_inverse=True)
    n = np.bincount(where, trained[met], len(pairs)).astype(np.int64)
    pair_word = (pairs >> np.uint64(32)).astype(np.int64)
    counts = np.bincount(pair_word, n, len(names)).astype(np.int64)
    if len(hot):  # the shard has a part of these words' occurrences
        spot = np.minimum(np.searchsorted(hot, names), len(hot) - 1)
        counts = np.where(hot[spot] == names, hot_counts[spot], counts)
    known = counts > 0
    place = np.cumsum(known) - 1
    return Trie.levels(names[known], counts[known], place[pair_word], (pairs & np.uint64(0xFFFFFFFF)).astype(np.uint32), n, total, distinct)


def _few(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in slices of about TOGETHER pairs."""
    for batch in rows:
        ends, done = np.cumsum(pc.list_value_length(batch.column("contexts")).to_numpy()), 0
        while done < len(ends):
            stop = max(int(np.searchsorted(ends, (ends[done - 1] if done else 0) + TOGETHER, "right")), done + 1)
            yield batch.slice(done, stop - done)
            done = stop


def shard_answers(rows: list[pa.RecordBatch], trie: Trie, total: int, distinct: int) -> Iterator[dict[str, object]]:
    """By block: sums for documents (known, base, score), and the same for one occurrence of each pair that was asked for."""
    nothing = np.log10(1 / (total + distinct + 1))
    missing = int(quantised(np.log10(np.array([WEIGHT / (total + distinct + 1)])))[0]), int(quantised(np.log10(np.array([WEIGHT])))[0])
    for batch in _few(rows):
        word = batch.column("words").flatten().to_numpy().view(np.uint64)
        n_contexts = batch.column("n_contexts").flatten().to_numpy()
        place = trie.find(word)
        has = place >= 0
        count, below = np.zeros(len(word), np.int64), np.full(len(word), missing[1], np.int64)
        count[has], below[has] = trie.counts[place[has]], trie.below[place[has]]
        base = np.where(has, np.log10((count + 1) / (total + distinct + 1)), nothing)
        of_word = np.repeat(np.arange(len(word)), n_contexts)
        above = np.full(len(of_word), missing[0], np.int64)
        some = np.flatnonzero(has[of_word])
        above[some] = trie.pairs(place[of_word[some]], _unsigned(batch.column("contexts").flatten().to_numpy()[some]))
        gives = has[of_word].astype(np.int64), base[of_word], above - below[of_word]
        n_docs, ask = batch.column("n_docs").flatten().to_numpy(), batch.column("ask").flatten().to_numpy()
        docs, times = batch.column("docs").flatten().to_numpy().astype(np.int64), batch.column("times").flatten().to_numpy().astype(np.int64)
        of_pair = np.repeat(np.arange(len(of_word)), n_docs)
        pair_row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(batch.column("contexts")).to_numpy())
        row = pair_row[of_pair]
        keys, at = np.unique(row << 16 | docs, return_inverse=True)
        sums = [np.bincount(at, times * g[of_pair], len(keys)) for g in gives]
        asked = np.flatnonzero(ask)
        for i, block in enumerate(batch.column("block").to_pylist()):
            own, own_asked = slice(*np.searchsorted(keys >> 16, (i, i + 1))), asked[slice(*np.searchsorted(pair_row[asked], (i, i + 1)))]
            one = {"docs": keys[own] & 0xFFFF, "known": sums[0][own], "base": sums[1][own], "score": sums[2][own]}
            yield {"block": block} | one | {"ask": ask[own_asked], "ask_known": gives[0][own_asked], "ask_base": gives[1][own_asked], "ask_score": gives[2][own_asked]}


_GIVEN = {"docs": pa.int16(), "known": pa.int32(), "base": pa.float64(), "score": pa.int64(), "ask": pa.int32(), "ask_known": pa.int32(), "ask_base": pa.float64(), "ask_score": pa.int64()}


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[pa.RecordBatch], list[pa.RecordBatch]]]:
    """(shard, rows of pairs, rows of documents) of each shard; those of documents come last, so both are slices of what was read."""
    now, held, own = None, [], []
    for batch in batches:
        shard = batch.column("shard").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
        for a, z in zip(cuts, cuts[1:]):
            if a == z:
                continue
            if shard[a] != now and now is not None:
                yield now, held, own
                held, own = [], []
            now, part = int(shard[a]), batch.slice(a, z - a)
            pairs = part.column("ids").null_count
            held.append(part.slice(0, pairs))
            own.append(part.slice(pairs))
    if now is not None:
        yield now, held, own


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document; the row of a block's documents comes before its answers."""
    now, names, n_tokens, sums, local = None, None, None, None, None

    def rows() -> pa.RecordBatch:
        known, base, score = sums
        return pa.RecordBatch.from_arrays([names, pa.array(n_tokens), pa.array(np.rint(known).astype(np.int64)), pa.array(base), pa.array(np.rint(score) / STEPS)], names=["id", "n_tokens", "n_known", "base_score", "score"])

    for batch in batches:
        ids, lists = batch.column("ids"), {c: batch.column(c) for c in ("n_tokens", "n_docs", "docs", "times", *_GIVEN)}
        for i, block in enumerate(batch.column("block").to_pylist()):
            get = lambda c: lists[c][i].values.to_numpy(zero_copy_only=False)
            if ids[i].is_valid:
                if now is not None:
                    yield rows()
                now, names, n_tokens = block, ids[i].values, get("n_tokens")
                sums = np.zeros((3, len(names)))
                ends = np.cumsum(get("n_docs"))
                local = ends, get("docs").astype(np.int64), get("times").astype(np.int64)
                continue
            docs = get("docs")
            for s, c in zip(sums, ("known", "base", "score")):
                s[docs] += get(c)  # a list names a document once
            ask = get("ask")
            if len(ask):
                ends, all_docs, all_times = local
                n = np.diff(ends, prepend=0)[ask - 1]
                at = gathered(ends[ask - 1] - n, n)
                for s, c in zip(sums, ("ask_known", "ask_base", "ask_score")):
                    s += np.bincount(all_docs[at], all_times[at] * np.repeat(get(c), n), len(s))
    if now is not None:
        yield rows()


def _statistics(docs: DataFrame, id_col: str, text_col: str) -> tuple[int, int, int, np.ndarray, np.ndarray, np.ndarray]:
    """(training tokens, distinct ones, shards, and sorted hashes, counts and slots of the hot words)."""
    counts = materialise(word_counts(docs.where(~is_held_out(id_col)), text_col).where("n > 0"), "words")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    shards = max(-(-total // SHARD_TOKENS), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = counts.where(F.col("n") * (2 * shards) > total).collect()  # fewer than 2 S rows, as their counts add up to the total at most
    hot = np.array([r["word"] for r in rows], np.int64).view(np.uint64)
    n = np.array([r["n"] for r in rows], np.int64)
    order = np.argsort(hot)
    return total, distinct, shards, hot[order], n[order], -(-n[order] * 2 * shards // max(total, 1))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The model: (shard, levels), the bytes that Trie reads, of all shards."""
    total, distinct, shards, hot, hot_counts, slots = _statistics(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, held, _ in _by_shard(batches):
            if sum(r.num_rows for r in held):
                yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "levels": pa.array([shard_levels(held, hot, hot_counts, total, distinct)], pa.binary())})

    return sent_pairs(docs, hot, slots, shards, id_col, text_col).repartitionById(shards, "shard").sortWithinPartitions("shard", F.col("ids").isNotNull(), "block").mapInArrow(run, "shard int, levels binary")


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    kind = docs.schema[id_col].dataType.simpleString()
    total, distinct, shards, hot, hot_counts, slots = _statistics(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["block", "ids", "n_tokens", "n_docs", "times", *_GIVEN]
        for _, held, own in _by_shard(batches):
            for part in own:
                if part.num_rows:
                    yield pa.RecordBatch.from_arrays([part.column(c) if c in part.schema.names else pa.nulls(part.num_rows, pa.list_(_GIVEN[c])) for c in names], names=names)
            held = [r for r in held if r.num_rows]
            if not held:
                continue
            trie = mapped(shard_levels(held, hot, hot_counts, total, distinct))
            kinds = {c: own[0].schema.field(c).type for c in ("ids", "n_tokens", "n_docs", "times")}
            for x in shard_answers(held, trie, total, distinct):
                lists = {c: _list(x[c], [len(x[c])], t) for c, t in _GIVEN.items()} | {c: pa.nulls(1, t) for c, t in kinds.items()} | {"block": pa.array([x["block"]])}
                yield pa.RecordBatch.from_arrays([lists[c] for c in names], names=names)

    schema = f"block long, ids array<{kind}>, n_tokens array<long>, n_docs array<int>, times array<int>, docs array<short>, known array<int>, base array<double>, score array<long>, ask array<int>, ask_known array<int>, ask_base array<double>, ask_score array<long>"
    sent = sent_pairs(docs, hot, slots, shards, id_col, text_col).repartitionById(shards, "shard").sortWithinPartitions("shard", F.col("ids").isNotNull(), "block")
    given = sent.mapInArrow(run, schema).repartition("block").sortWithinPartitions("block", F.col("ids").isNull())
    done = given.mapInArrow(_finished, f"id {kind}, n_tokens long, n_known long, base_score double, score double")
    return done.select(F.col("id").alias(id_col), "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score").select(id_col, is_held_out(id_col).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
