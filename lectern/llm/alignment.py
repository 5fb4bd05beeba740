"""Alignment of two tokenizers: which tokens of one end where tokens of the other end.

A is a byte-level BPE of the tokenizers library, given a space and the text; B is a
SentencePiece BPE model, given the text, which adds that space itself. Both give tokens of the
same bytes, so a text is cut into groups where tokens of both end, and the tokens that end there
are linked. How often an id pair is linked in the whole corpus tells how much a link means.

1. Postings. Texts are encoded in blocks of some 4 MB; lengths of tokens and their running sums
   give the ends, and ends in common give the links. A block writes a row per document (sizes,
   digest of its groups) and, per id of B, a posting list: for each id of A linked with it the
   documents of the block and how often each has the pair.
2. Cogroup. Count lists (how often a block has each pair) and posting lists are shuffled by the id of
   B and sorted, the count lists first, by Spark's sort, which spills. A task streams through
   them: it adds up the counts of one id of B, at most one number per id of A, takes their maximum, and
   then turns that id's postings into contributions. These are added up by (block, document) in
   bounded buffers and written.
3. Sum. Contributions meet by block and are added up by document.

An id of B with more than 1/SHARES of all postings is split: its posting lists go to several slots, by
block, and each slot gets the id's counts, added up before. There are at most 2 SHARES such slots, and ids
that need them are broadcast. No list is longer than a block, no task holds more than a batch, the
counts of one id and a buffer.

Edge cases: a null or empty text has no tokens, nor has a text whose tokens' joined bytes differ from
space and text (U+2581 in a text reads as a space, for example): zeros, and an empty string in the
place of the digest. Strings of special tokens in texts are text. Repeated rows, whatever their ids, each
get their row and count each. A null id stays null. No documents give no rows.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ._shared import column, materialise, whole_text
from .text_buffers import slices
from .token_shards import TextEncoder, _gathered

#: Bytes of text in a block, and the most documents of one (their numbers are kept in 16 bits).
BLOCK, BLOCK_DOCS = 4 << 20, 30_000
#: An id of B with over 1/SHARES of the postings is split.
SHARES = 400
#: Postings worked on at a time, and contributions held before they are passed on.
STEP, HELD = 1_000_000, 2_000_000


def _byte_table(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(pieces), np.uint8), np.array([*map(len, pieces)], np.int64)


def _byte_letters() -> dict[str, int]:
    """How byte-level vocabularies write each byte: printable ones as themselves, the others by the next characters from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Pair:
    """The two tokenizers and the bytes of their tokens."""

    def __init__(self, bpe_path: str, piece_path: str):
        import sentencepiece

        self.encoder = TextEncoder(bpe_path)
        self.encoder.tokenizer.encode_special_tokens = True
        letters = _byte_letters()
        names = {i: t for t, i in self.encoder.tokenizer.get_vocab(with_added_tokens=True).items()}
        self.n_a = max(names) + 1
        self.bytes_a, self.size_a = _byte_table([bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t in (names.get(i, "") for i in range(self.n_a))])
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        self.n_b = self.pieces.get_piece_size()
        self.bytes_b, self.size_b = _byte_table([bytes([int(p[3:5], 16)]) if self.pieces.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, self.pieces.id_to_piece(i)) for i in range(self.n_b))])
        decimals = [str(i).encode() for i in range(max(self.n_a, self.n_b))]
        self.digits = np.array([d.ljust(len(decimals[-1]) + 1) for d in decimals], bytes).view(np.uint8).reshape(len(decimals), -1)
        self.n_digits = np.array([*map(len, decimals)])

    def encode_a(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of space and text of all texts, how many each has). A letter before the space is a token of its own and is taken off."""
        ids, n = self.encoder.encode(pc.binary_join_element_wise(pa.scalar("a ", pa.large_string()), texts, pa.scalar("", pa.large_string())))
        ends = np.cumsum(n)
        keep = np.ones(len(ids), bool)
        keep[ends - 1] = keep[ends - n] = False
        return ids[keep].astype(np.int64), n - 2

    def encode_b(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        got = self.pieces.encode(texts.to_pylist(), num_threads=1)
        n = np.array([*map(len, got)], np.int64)
        return np.fromiter((i for ids in got for i in ids), np.int64, int(n.sum())), n

    def _unlike(self, ids: np.ndarray, n: np.ndarray, table: np.ndarray, sizes: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Which texts differ from the joined bytes of their tokens; data has a space before each."""
        text = np.repeat(np.arange(len(n)), n)
        bad = np.bincount(text, sizes[ids], len(n)).astype(np.int64) != np.diff(offsets)
        here = ~bad[text]
        own = data if here.all() else data[np.repeat(~bad, np.diff(offsets))]
        differs = _gathered(table, sizes, ids[here]) != own
        if differs.any():
            left = np.flatnonzero(~bad)
            bad[left[np.searchsorted(np.cumsum(np.diff(offsets)[left]), np.flatnonzero(differs), "right")]] = True
        return bad

    def align(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """(tokens of A, of B and groups of each text, digests of the groups, then of each link its text, id of A and id of B)."""
        n_texts = len(texts)
        n_a, n_b, n_groups = (np.zeros(n_texts, np.int64) for _ in range(3))
        digests = [""] * n_texts
        some = np.flatnonzero(pc.binary_length(texts).to_numpy(zero_copy_only=False) > 0)
        chosen = texts.take(pa.array(some)) if len(some) < n_texts else texts
        none = np.empty(0, np.int64)
        if not len(some):
            return n_a, n_b, n_groups, digests, none, none, none
        a, count_a = self.encode_a(chosen)
        b, count_b = self.encode_b(chosen)
        [(_, offsets, data)] = slices(pc.binary_join_element_wise(pa.scalar("", pa.large_string()), chosen, pa.scalar(" ", pa.large_string())), 1 << 62)
        bad = self._unlike(a, count_a, self.bytes_a, self.size_a, data, offsets) | self._unlike(b, count_b, self.bytes_b, self.size_b, data, offsets)
        if bad.any():
            a, b = a[np.repeat(~bad, count_a)], b[np.repeat(~bad, count_b)]
            count_a, count_b, some = count_a[~bad], count_b[~bad], some[~bad]
        n_a[some], n_b[some] = count_a, count_b
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        if not len(a):
            return n_a, n_b, n_groups, digests, none, none, none
        at = np.minimum(np.searchsorted(ends_b, ends_a), len(ends_b) - 1)
        last_a = np.flatnonzero(ends_b[at] == ends_a)
        last_b = at[last_a]
        text = np.repeat(np.arange(len(some)), count_a)[last_a]
        n_groups[some] = np.bincount(text, minlength=len(some))
        for i, d in zip(some.tolist(), self._digests(a, b, last_a, last_b, text, len(some))):
            digests[i] = d
        return n_a, n_b, n_groups, digests, some[text], a[last_a], b[last_b]

    def _digests(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray, text: np.ndarray, n_texts: int) -> Iterator[str]:
        """SHA-256 of each text's groups as a1,a2|b1;a3|b2: all tokens, in the order of groups, A's before B's, each with the sign behind it."""
        size_a, size_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        ids, sign = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
        stop_a, stop_b = np.cumsum(size_a + size_b) - size_b, np.cumsum(size_a + size_b)
        ids[np.arange(len(a)) + np.repeat(stop_a - np.cumsum(size_a), size_a)] = a
        ids[np.arange(len(b)) + np.repeat(stop_b - np.cumsum(size_b), size_b)] = b
        sign[stop_a - 1], sign[stop_b - 1] = ord("|"), ord(";")
        out = []
        stops = np.zeros(n_texts + 1, np.int64)
        stops[1:] = stop_b[np.searchsorted(text, np.arange(n_texts), "right") - 1]  # every text has a group
        for k in range(n_texts):
            x, s = ids[stops[k] : stops[k + 1]], sign[stops[k] : stops[k + 1]]
            n = self.n_digits[x]
            letters = self.digits[x]
            letters[np.arange(len(x)), n] = s
            out.append(hashlib.sha256(letters[np.arange(letters.shape[1]) <= n[:, None]][:-1].tobytes()).hexdigest())
        return out


_pairs: dict[tuple[str, str], Pair] = {}


def _pair(bpe_path: str, piece_path: str) -> Pair:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if (bpe_path, piece_path) not in _pairs:
        _pairs[bpe_path, piece_path] = Pair(bpe_path, piece_path)
    return _pairs[bpe_path, piece_path]


def _lists(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list per end, of the values before it."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(values.astype(kind.to_pandas_dtype()), kind))


_POSTINGS = {"b": pa.int32(), "a": pa.list_(pa.int32()), "totals": pa.list_(pa.int64()), "runs": pa.list_(pa.int32()), "docs": pa.list_(pa.int16()), "times": pa.list_(pa.int32())}
_DOCUMENT = {"d": pa.int16(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "groups_sha256": pa.string()}


def posting_lists(doc: np.ndarray, a: np.ndarray, b: np.ndarray, n_a: int) -> dict[str, pa.Array]:
    """A row per id of B: its ids of A, how often each is linked, how many documents have it, these, and how often."""
    n_docs = int(doc.max()) + 1 if len(doc) else 1
    keys, times = np.unique((b * n_a + a) * n_docs + doc, return_counts=True)
    pair, doc = keys // n_docs, keys % n_docs
    new_pair = np.flatnonzero(np.diff(pair, prepend=-1))
    pairs = pair[new_pair]
    totals, runs = (np.add.reduceat(times, new_pair), np.diff(new_pair, append=len(pair))) if len(pairs) else (times, times)
    ids_b = pairs // n_a
    new_b = np.flatnonzero(np.diff(ids_b, prepend=-1))
    ends = np.append(new_b[1:], len(pairs)) if len(pairs) else new_b
    ends_docs = np.cumsum(runs)[ends - 1] if len(pairs) else ends
    columns = (ids_b[new_b], (pairs % n_a, ends), (totals, ends), (runs, ends), (doc, ends_docs), (times, ends_docs))
    return {name: pa.array(x.astype(np.int32)) if name == "b" else _lists(*x, kind.value_type) for (name, kind), x in zip(_POSTINGS.items(), columns)}


def blocks(docs: DataFrame, bpe_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of two kinds: documents (block, d, id, sizes, digest), where b is null, and posting lists (block, b, lists)."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pair, block = _pair(bpe_path, piece_path), TaskContext.get().partitionId() << 32

        def rows(ids: pa.Array, texts: pa.Array) -> Iterator[pa.RecordBatch]:
            *sizes, digests, doc, a, b = pair.align(texts)
            lists = posting_lists(doc, a, b, pair.n_a)
            own = dict(zip(_DOCUMENT, (pa.array(np.arange(len(ids)).astype(np.int16)), *map(pa.array, sizes), pa.array(digests))))
            for n, have in ((len(ids), own), (len(lists["b"]), lists)):
                arrays = {"block": pa.array(np.full(n, block)), "id": ids if have is own else pa.nulls(n, ids.type)}
                arrays |= {name: have[name] if name in have else pa.nulls(n, t) for name, t in (_DOCUMENT | _POSTINGS).items()}
                for k in range(0, n, 5000):
                    yield pa.RecordBatch.from_arrays([*arrays.values()], names=[*arrays]).slice(k, 5000)

        held: list[tuple[pa.Array, pa.Array]] = []
        size = count = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, size, count, block
            yield from rows(pa.concat_arrays([i for i, _ in held]), pa.concat_arrays([t for _, t in held]))
            held, size, count, block = [], 0, 0, block + 1

        for batch in batches:
            texts = batch.column("text").cast(pa.large_string())
            for at, offsets, data in slices(texts, BLOCK // 4):
                for k in range(0, len(offsets) - 1, BLOCK_DOCS // 2):
                    n = min(BLOCK_DOCS // 2, len(offsets) - 1 - k)
                    bytes_here = int(offsets[k + n] - offsets[k])
                    if held and (size + bytes_here > BLOCK or count + n > BLOCK_DOCS):
                        yield from flush()
                    held.append((batch.column("id").slice(at + k, n), texts.slice(at + k, n)))
                    size, count = size + bytes_here, count + n
        if held:
            yield from flush()

    schema = f"block long, id {kind}, d short, n_a long, n_b long, n_groups long, groups_sha256 string, b int, a array<int>, totals array<long>, runs array<int>, docs array<short>, times array<int>"
    return docs.select(column(id_col).alias("id"), whole_text(text_col).alias("text")).mapInArrow(run, schema)


def _postings_by_side(lists: DataFrame, slots: DataFrame, shares: int) -> DataFrame:
    """(b, slot, kind, block, a, totals, runs, docs, times): count lists (kind 0) and posting lists (kind 1) of each slot of an id of B."""
    hot = F.broadcast(slots)
    none = lambda *names: (F.lit(None).cast(t).alias(n) for n, t in names)
    postings = (("runs", "array<int>"), ("docs", "array<short>"), ("times", "array<int>"))
    dealt = lists.join(hot, "b", "left").withColumn("slot", F.when(F.col("slots").isNull(), 0).otherwise(F.pmod(F.xxhash64("block"), F.col("slots"))).cast("int"))
    one = dealt.select("b", "slot", F.lit(1).alias("kind"), "block", "a", F.lit(None).cast("array<long>").alias("totals"), "runs", "docs", "times")
    cold = lists.join(hot, "b", "left_anti").select("b", F.lit(0).alias("slot"), F.lit(0).alias("kind"), "block", "a", "totals", *none(*postings))
    added = lists.join(hot, "b").select("b", "slots", F.explode(F.arrays_zip("a", "totals")).alias("x")).groupBy("b", "slots", F.col("x.a").alias("a")).agg(F.sum("x.totals").alias("t"))
    listed = added.groupBy("b", "slots").agg(F.collect_list(F.struct("a", "t")).alias("x"))  # at most one entry per id of A
    warm = listed.select("b", F.explode(F.sequence(F.lit(0), F.col("slots").cast("int") - 1)).alias("slot"), F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("block"), F.col("x.a").alias("a"), F.col("x.t").alias("totals"), *none(*postings))
    return one.unionByName(cold).unionByName(warm)


def _flat(x: pa.ListArray) -> np.ndarray:
    return x.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def _sizes(x: pa.ListArray) -> np.ndarray:
    return pc.list_value_length(x).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


class _Contributions:
    """Sums by (block, document), passed on when HELD entries are there."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.n = 0

    def add(self, *columns: np.ndarray) -> None:
        self.parts.append(columns)
        self.n += len(columns[0])
        if self.n > HELD:
            self._combine()

    def _combine(self) -> None:
        block, doc, best, total = (np.concatenate(x) for x in zip(*self.parts))
        names, block = np.unique(block, return_inverse=True)
        keys, at = np.unique(block << 16 | doc, return_inverse=True)
        sums = [np.zeros(len(keys), np.int64) for _ in range(2)]
        for s, x in zip(sums, (best, total)):
            np.add.at(s, at, x)
        self.parts, self.n = [(names[keys >> 16], keys & 0xFFFF, *sums)], len(keys)

    def full(self) -> bool:
        return self.n > HELD // 2

    def rows(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            self._combine()
            block, doc, best, total = self.parts[0]
            first = np.flatnonzero(np.diff(block, prepend=-1))
            ends = np.append(first[1:], len(block)) if len(block) else first
            columns = [pa.array(block[first]), _lists(doc, ends, pa.int16()), _lists(best, ends, pa.int32()), _lists(total, ends, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "docs", "best", "total"])
        self.parts, self.n = [], 0


def _contribute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams through slots of ids of B, count lists first, and gives contributions by block."""
    out, group, last = _Contributions(), 0, None
    keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)  # (group, id of A) of the slots at hand, and how often their pair is linked
    for batch in batches:
        ends, done = np.cumsum(_sizes(batch.column("a")) + _sizes(batch.column("docs"))), 0
        while done < len(ends):
            start = int(ends[done - 1]) if done else 0
            stop = max(int(np.searchsorted(ends, start + STEP, "right")), done + 1)
            part = batch.slice(done, stop - done)
            done = stop
            b, slot, kind, block = (part.column(c).to_numpy() for c in ("b", "slot", "kind", "block"))
            name = b.astype(np.int64) << 20 | slot
            groups = group + np.cumsum(np.diff(name, prepend=name[0] if last is None else last) != 0)
            lists = part.column("a")
            n_a, a = _sizes(lists), _flat(lists)
            of_count = np.repeat(kind == 0, n_a)
            new = (np.repeat(groups, n_a) << 32 | a)[of_count]
            all_keys, at = np.unique(np.concatenate((keys, new)), return_inverse=True)
            sums = np.zeros(len(all_keys), np.int64)
            np.add.at(sums, at, np.concatenate((counts, _flat(part.column("totals")))))
            keys, counts = all_keys, sums
            if (kind == 1).any():
                first = np.flatnonzero(np.diff(keys >> 32, prepend=-1))
                most = np.repeat(np.maximum.reduceat(counts, first), np.diff(first, append=len(keys)))
                runs, times, docs = _flat(part.column("runs")), _flat(part.column("times")), _flat(part.column("docs"))
                where = np.searchsorted(keys, (np.repeat(groups, n_a) << 32 | a)[~of_count])
                links, is_best = np.repeat(counts[where], runs), np.repeat(counts[where] == most[where], runs)
                blocks_ = np.repeat(block, _sizes(part.column("docs")))
                out.add(blocks_, docs, times * is_best, times * links)
                if out.full():
                    yield from out.rows()
            group, last = int(groups[-1]), int(name[-1])
            open_ = keys >> 32 == group
            keys, counts = keys[open_], counts[open_]
    yield from out.rows()


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the contributions to the documents of each block; rows come block by block."""
    now, sums = None, np.zeros((2, BLOCK_DOCS + 1), np.int64)

    def rows() -> Iterator[pa.RecordBatch]:
        d = np.flatnonzero(sums[1])
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(d), now)), pa.array(d.astype(np.int16)), pa.array(sums[0][d]), pa.array(sums[1][d])], names=["block", "d", "n_best", "count_sum"])
        sums[:] = 0

    for batch in batches:
        lists = {c: batch.column(c) for c in ("docs", "best", "total")}
        for i, block in enumerate(batch.column("block").to_pylist()):
            if block != now and now is not None:
                yield from rows()
            now = block
            docs, best, total = (x[i].values.to_numpy() for x in lists.values())
            sums[0][docs] += best  # a list names a document once
            sums[1][docs] += total
    if now is not None:
        yield from rows()


def align_documents(docs: DataFrame, bpe_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text", shares: int = SHARES) -> DataFrame:
    """Per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    table = materialise(blocks(docs, bpe_path, piece_path, id_col, text_col), "alignment")
    lists = table.where("b IS NOT NULL").select("block", "b", "a", "totals", "runs", "docs", "times")
    sizes = table.where("b IS NOT NULL").groupBy("b").agg(F.sum(F.size("docs")).alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    slots = materialise(sizes.where(F.col("n") * shares > total).select("b", F.ceil(F.col("n") * shares / total).alias("slots")), "slots")  # at most `shares` rows
    streams = _postings_by_side(lists, slots, shares).repartition("b", "slot").sortWithinPartitions("b", "slot", "kind", "block")
    gave = streams.mapInArrow(_contribute, "block long, docs array<short>, best array<int>, total array<long>")
    sums = gave.repartition("block").sortWithinPartitions("block").mapInArrow(_add_up, "block long, d short, n_best long, count_sum long")
    own = table.where("b IS NULL").select("block", "d", F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "groups_sha256")
    value = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    joined = own.join(sums, ["block", "d"], "left")
    return joined.select(column(id_col), "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), value("n_best"), value("count_sum"), "groups_sha256")
