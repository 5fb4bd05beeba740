"""How filters act on each other: what each removes at each step of every order.

Five filters see every whole text. A fails texts of under 200 words, B those whose distinct
words are under half of their words, C those with over 3 % capitals, D those with a symbol, E those
that are equal to a text with a smaller id. A document is its mask of failed filters, and
everything that is reported follows from how many documents of a part have each mask.

1. Scan: the bytes of a batch's texts are classified at once by a table of 256 entries;
   differences of prefix sums give each text's words, capitals, symbols and code points. Words are
   hashed by prefix sums too, and sorted by text and hash; words with equal hashes in a
   text are compared byte by byte, so what is counted as equal is equal. Texts in which two
   different words share a hash are counted by a set. A row per document is written: id,
   part, mask, SHA-256 of the text; texts are not shuffled.
2. The smallest id of each digest meets the rows on both digest and id, so a text with very many
   copies is no hot key; rows that do not meet it fail E. Repeated rows are combined before the
   shuffle. Labels meet the rows on the id.
3. Documents are counted by (part, mask), at most 32 rows a part, and each part's rows become the
   120 orders times 5 steps. Nothing else is of the size of the documents.

Edge cases: a null text is empty; an empty text has no words, fails A only (and E beside
another empty one). A null language and an empty one are one part. A null id is equal to
none and smaller than none, so its row never fails E, and it has no labels. Repeated rows
(equal id and text) count each, and none is a copy of another. Of repeated labels one with 1 is
enough. No documents give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ._shared import column, materialise, whole_text
from .text_buffers import gathered, slices, words

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT, SYMBOLS = 200, 50, 3, "#$%&*|"

_CAPITAL, _SYMBOL, _LETTER = 1, 2, 4  # classes of bytes; a code point has one byte that is no continuation
_CLASS = np.zeros(256, np.uint8)
_CLASS[ord("A") : ord("Z") + 1] |= _CAPITAL
_CLASS[[*SYMBOLS.encode()]] |= _SYMBOL
_CLASS[[b for b in range(256) if b & 0xC0 != 0x80]] |= _LETTER

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse; tables for slices of the usual size are kept."""
    global _powers
    if n <= len(_powers[0]):
        return _powers
    made = []
    for x in (_BASE, pow(_BASE, -1, 1 << 64)):
        steps = np.full(n, x, np.uint64)
        steps[0] = 1
        made.append(np.multiply.accumulate(steps))
    if n <= 1 << 22:
        _powers = tuple(made)
    return tuple(made)


def word_hashes(data: np.ndarray, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return (sums[stop] - sums[first]) * down[first]


def distinct_words(data: np.ndarray, offsets: np.ndarray, first: np.ndarray, stop: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """How many different words each text has."""
    text = np.searchsorted(offsets, first, "right") - 1
    order = np.lexsort((hashes, text))
    text, hashes, at, size = text[order], hashes[order], first[order], (stop - first)[order]
    same = np.zeros(len(order), bool)
    same[1:] = (text[1:] == text[:-1]) & (hashes[1:] == hashes[:-1])
    out = np.bincount(text[~same], minlength=len(offsets) - 1)
    pairs = np.flatnonzero(same)
    equal = size[pairs] == size[pairs - 1]
    pairs, unlike = pairs[equal], [text[pairs[~equal]]]
    byte = data[gathered(at[pairs], size[pairs])] != data[gathered(at[pairs - 1], size[pairs])]
    if byte.any():
        unlike.append(text[np.repeat(pairs, size[pairs])[byte]])
    raw = data.tobytes() if any(map(len, unlike)) else b""
    for t in np.unique(np.concatenate(unlike)).tolist():  # two words share a hash
        a, b = np.searchsorted(first, offsets[t : t + 2])
        out[t] = len({raw[i:j] for i, j in zip(first[a:b].tolist(), stop[a:b].tolist())})
    return out


def masks(texts: pa.Array) -> np.ndarray:
    """Of each text, which of the filters A to D it fails: 1, 2, 4 and 8 added up."""
    out = np.zeros(len(texts), np.int32)
    for at, offsets, data in slices(texts):
        first, stop = words(data, offsets)
        kinds = _CLASS[data]

        def count(kind: int) -> np.ndarray:
            sums = np.zeros(len(data) + 1, np.int64)
            np.cumsum(kinds & kind != 0, out=sums[1:])
            return np.diff(sums[offsets])

        n = np.diff(np.searchsorted(first, offsets))
        distinct = distinct_words(data, offsets, first, stop, word_hashes(data, first, stop))
        fails = (n < LEAST_WORDS, 100 * distinct < DISTINCT_PERCENT * n, 100 * count(_CAPITAL) > CAPITAL_PERCENT * count(_LETTER), count(_SYMBOL) > 0)
        out[at : at + len(n)] = sum(f.astype(np.int32) << i for i, f in enumerate(fails))
    return out


def _digests(texts: pa.Array) -> list[bytes]:
    return [hashlib.sha256(data[a:b]).digest() for _, offsets, data in slices(texts) for a, b in zip(offsets.tolist(), offsets[1:].tolist())]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(id, part, mask of A to D, digest) of each document."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("part"), pa.array(masks(b.column("text"))), pa.array(_digests(b.column("text")), pa.binary())], names=["id", "part", "mask", "digest"])

    rows = docs.select(column(id_col).alias("id"), F.coalesce(column(part_col).cast("string"), F.lit("")).alias("part"), whole_text(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, part string, mask int, digest binary")


def labelled_masks(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic): documents by all five filters; good and toxic count those with these labels."""
    scanned = materialise(scan(docs, id_col, text_col, part_col), "masks")
    firsts = scanned.where("id IS NOT NULL").groupBy("digest").agg(F.min("id").alias("first")).select(F.col("digest").alias("same"), "first")
    rows = scanned.groupBy("id", "part", "mask", "digest").agg(F.count(F.lit(1)).alias("n"))
    joined = rows.join(firsts, (F.col("digest") == F.col("same")) & (F.col("id") == F.col("first")), "left")
    copy = F.col("id").isNotNull() & F.col("first").isNull()
    joined = joined.select("id", "part", (F.col("mask") + F.when(copy, 1 << FILTERS.index("E")).otherwise(0)).alias("mask"), "n")
    one = lambda name: F.max(F.when(F.col(name) == 1, 1).otherwise(0)).alias(name)
    known = labels.select(column(id_col).alias("labelled"), "quality", "toxic").where("labelled IS NOT NULL").groupBy("labelled").agg(one("quality"), one("toxic"))
    marked = joined.where("id IS NOT NULL").join(known, F.col("id") == F.col("labelled"), "left").select("part", "mask", "n", "quality", "toxic")
    without = joined.where("id IS NULL").select("part", "mask", "n", F.lit(0).alias("quality"), F.lit(0).alias("toxic"))
    total = lambda c, name: F.sum(F.when(c == 1, F.col("n")).otherwise(0)).alias(name)
    return marked.unionByName(without).groupBy("part", "mask").agg(F.sum("n").alias("n"), total(F.col("quality"), "good"), total(F.col("toxic"), "toxic"))


def report(counts: DataFrame) -> DataFrame:
    """A row per part, order and step; shapley is what the filter removes, summed over all orders."""
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))  # 32 entries at most
    rows = parts.select("part", "masks", F.explode(F.array(*map(F.lit, ORDERS))).alias("filter_order")).select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    bit_at = lambda i: F.expr(f"shiftleft(1, ascii(substring(filter_order, {i}, 1)) - {ord(FILTERS[0])})")
    before = sum((F.when(F.col("step") > i, bit_at(i)).otherwise(0) for i in range(1, len(FILTERS))), F.lit(0))
    rows = rows.select("*", bit_at("step").alias("bit"), before.alias("prior"))
    has = lambda m, c: m["mask"].bitwiseAND(F.col(c)) != 0

    def total(which, value=lambda m: m["n"]) -> Column:
        return F.aggregate(F.filter("masks", which), F.lit(0).cast("long"), lambda sum_, m: sum_ + value(m).cast("long"))

    here = lambda m: has(m, "bit") & ~has(m, "prior")
    share = F.lit(len(ORDERS))  # of all orders, one in so many as filters fail has this filter first among them
    return rows.select(
        "part", "filter_order", "step",
        total(lambda m: ~has(m, "bit") & ~has(m, "prior")).alias("kept"),
        total(here).alias("removed"),
        total(lambda m: has(m, "bit") & has(m, "prior")).alias("redundant"),
        total(lambda m: m["mask"] == F.col("bit")).alias("unique_fails"),
        total(here, lambda m: m["good"]).alias("good_lost"),
        total(here, lambda m: m["toxic"]).alias("toxic_lost"),
        total(lambda m: has(m, "bit"), lambda m: m["n"] * (share / F.bit_count(m["mask"])).cast("long")).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return report(labelled_masks(docs, labels))
