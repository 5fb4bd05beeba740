"""Token ids in Re-Pair compressed shards.

Texts are encoded in ascending order of their ids, each ends with an end id, and the ids
go into shards. A shard replaces frequent pairs of neighbouring symbols by new symbols
until no pair occurs LEAST times; it stores the rules, the length each symbol expands to,
and the sequence that is left. With the lengths a reader finds any position without expanding what stands
before it. A rule never reaches over an end id, so symbols never span documents.

Format of a shard (little-endian, unsigned 32 bits each unless said otherwise):
"RPS1"; the numbers of terminals, rules, rounds, symbols, documents and ids; then the
number of rules of each round, the rules (all left symbols, then all right ones), their
expanded lengths, the ids of each document, the position of every ANCHOR-th symbol, and the
symbols. Symbols below the number of terminals are token ids; the others are rules.

Shards are rows of a Parquet table (part, nth, before, n_ids, doc_ids, payload) in the
shared folder, so they are committed as a whole and survive lost executors. The texts are
shuffled once, by ranges of the id; what the shards need from each other is one number a
part.

Encoding: where all white space is single spaces and line feeds between other characters,
the tokenizer's own first cut falls before each space and on both sides of each line feed.
Such texts are cut there, a slice of some 16 MB of them at a time; the library encodes each
distinct piece, and workers remember results within a fixed bound. Any other text is encoded as
a whole by the library.

Edge cases: a null text is empty and has the end id only. Null ids come first; rows
with equal ids are ordered by text. No rows give no shards and no rows.
"""

from __future__ import annotations

import os
import re
import string
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from ._shared import column, materialise, shared_dir, whole_text

END = 2
#: Ids in a shard, about: a document is never split.
SHARD_IDS = 1 << 20
#: A pair must occur so often; a round takes all pairs at least SHARE times as frequent as the most frequent one. Rounds go on while there is such a pair.
LEAST, SHARE = 16, 0.01
ANCHOR = 1024
#: Most parts whose first positions are broadcast (a few MB); beyond, shards meet them in a join.
BROADCAST_PARTS = 100_000
#: Bytes of text that are encoded at a time, about.
SLICE = 1 << 24
#: Pieces that a worker remembers (some 40 bytes each), and the longest such piece.
MEMORY, LONGEST = 700_000, 40

#: Letters, of which the tokenizer's first cut makes one piece, and signs, which are cut off behind them and make another one.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_WORD, _LINE_WORD = f"^[{_LETTERS}]+$", f"^\\n[{_LETTERS}]+$"
_LETTERS_AND_LINES = "\n" + "".join(c for c in map(chr, range(0x250)) if re.fullmatch(f"[{_LETTERS}]", c))
#: How byte-level vocabularies write a space.
SPACE_LETTER = "\u0120"
#: What keeps a text from being cut: white space other than single spaces and line feeds between other characters.
_UNEVEN = r"[\t\r\x0b\x0c\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|[ \n][ \n]|^[ \n]|[ \n]$"


def _text(value: str) -> pa.Scalar:
    return pa.scalar(value, pa.large_string())


class TextEncoder:
    """Ids of texts by a byte-level BPE file of the tokenizers library.

    A piece is what follows a space, or a line feed with what follows it; signs behind letters
    are a piece of their own, named with a space before them, as no other piece is. The ids of pieces
    are remembered in entries: pieces names them, flat has their ids one after the other, length how many
    each has, hits in how many slices it was met lately. Words, letters only, that are
    missing go to the library together, each behind a space or all behind line feeds, whose tokens
    then tell where the next word begins; other pieces go there one by one.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.line = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.begins = {c: np.zeros(max(vocabulary.values()) + 1, bool) for c in " \n"}
        self.begins[" "][[i for t, i in vocabulary.items() if t.startswith(SPACE_LETTER)]] = True
        self.begins["\n"][self.line] = True
        self.pieces = pa.array([" "], pa.large_string())  # no signs
        self.flat, self.length, self.hits = np.empty(0, "<u4"), np.zeros(1, np.int64), np.array([1 << 60])

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _words(self, words: pa.Array, before: str) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many each has) of words behind a space, or behind a line feed and with its id."""
        rows = pa.ListArray.from_arrays(np.append(np.arange(0, len(words), 1000), len(words)).astype(np.int32), words.cast(pa.string()))
        texts = [before + row for row in pc.binary_join(rows, before).to_pylist()]
        ids = np.concatenate([np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)] or [np.empty(0, "<u4")])
        starts = np.flatnonzero(self.begins[before][ids])
        if len(starts) == len(words):
            return ids, np.diff(starts, append=len(ids))
        raw = [self._whole(before + w) for w in words.to_pylist()]
        return np.frombuffer(b"".join(raw), "<u4"), np.array([len(x) >> 2 for x in raw])

    def _other(self, piece: str) -> bytes:
        if not piece:
            return b""  # what stands before the line feed of a text
        return self._whole(piece if piece[0] == "\n" else piece[1:] if piece[0] == " " else " " + piece)

    def _entries(self, pieces: pa.Array) -> tuple[np.ndarray, int]:
        """(the entry of each piece, repeats included, how many entries may stay); what is missing is added, long pieces last."""
        if len(self.length) > MEMORY:
            self._shrink()
        known = len(self.length)
        coded = pa.concat_arrays([self.pieces, pieces]).dictionary_encode()  # names are distinct, so their codes are their entries
        entry, names = coded.indices.to_numpy()[known:].astype(np.int64), coded.dictionary[known:]
        has = lambda pattern: pc.match_substring_regex(names, pattern).to_numpy(zero_copy_only=False)
        kind = np.where(pc.utf8_length(names).to_numpy() > LONGEST, 3, np.where(has(_WORD), 0, np.where(has(_LINE_WORD), 1, 2)))
        order = np.argsort(kind, kind="stable")
        place, new = np.empty(len(order), np.int64), np.flatnonzero(entry >= known)
        place[order] = known + np.arange(len(order))
        entry[new] = place[entry[new] - known]
        names = names.take(pa.array(order))
        words, lines, others, long = np.bincount(kind, minlength=4).tolist()
        ids, length = self._words(names[:words], " ")
        ids_l, length_l = self._words(pc.utf8_ltrim(names[words : words + lines], "\n"), "\n")
        raw = [*map(self._other, names[words + lines :].to_pylist())]
        self.pieces = pa.concat_arrays([self.pieces, names])
        self.flat = np.concatenate((self.flat, ids, ids_l, np.frombuffer(b"".join(raw), "<u4")))
        self.length = np.concatenate((self.length, length, length_l, np.array([len(x) >> 2 for x in raw], np.int64)))
        self.hits = np.concatenate((self.hits, np.zeros(len(names), np.int64)))
        self.hits[entry] += 1  # once, however often a piece is repeated
        return entry, len(self.length) - long

    def _shrink(self) -> None:
        """Keeps the half that was met in most slices."""
        self._keep(np.sort(np.argpartition(-self.hits, MEMORY // 2)[: MEMORY // 2]))
        self.hits[1:] //= 2

    def _keep(self, entries: np.ndarray) -> None:
        self.flat = _gathered(self.flat, self.length, entries)
        self.pieces, self.length, self.hits = self.pieces.take(pa.array(entries)), self.length[entries], self.hits[entries]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(the ids of all texts, each with the end id, how many each has)."""
        uneven = pc.match_substring_regex(texts, _UNEVEN)
        odd = np.flatnonzero(uneven.to_numpy(zero_copy_only=False))
        even = pc.if_else(uneven, _text(""), texts) if len(odd) else texts
        # Each text is put behind a line feed, whose id then stands where the end id of the text before must be.
        lines = pc.replace_substring(pc.binary_join_element_wise(_text(""), even, _text("\n")), "\n", " \n")
        cut = pc.split_pattern(lines, " ")
        chunks = cut.flatten().dictionary_encode()
        # Letters with signs behind them are two pieces.
        distinct = chunks.dictionary
        stems = pc.utf8_rtrim(distinct, string.punctuation)
        signed = pc.and_(pc.not_equal(stems, distinct), pc.match_substring_regex(stems, f"^\\n?[{_LETTERS}]+$"))
        signs = pc.binary_join_element_wise(_text(" "), pc.utf8_ltrim(distinct.filter(signed), _LETTERS_AND_LINES), _text(""))
        entry, stay = self._entries(pa.concat_arrays([pc.if_else(signed, stems, distinct), signs.cast(pa.large_string())]))
        sign = np.zeros(len(distinct), np.int64)  # entry 0: none
        sign[signed.to_numpy(zero_copy_only=False)] = entry[len(distinct) :]
        two = np.stack((entry[: len(distinct)], sign), 1).ravel()
        flat, length = _gathered(self.flat, self.length, two), self.length[two].reshape(-1, 2).sum(1)
        if stay < len(self.length):
            self._keep(np.arange(stay))
        which, ends = chunks.indices.to_numpy().astype(np.intp), cut.value_lengths().to_numpy().cumsum()
        ids = np.append(_gathered(flat, length, which), np.uint32(END))
        n = np.cumsum(length[which])[ends - 1]
        n = np.diff(n, prepend=0)
        starts = np.cumsum(n) - n
        ids[starts] = END
        ids = ids[1:]
        if len(odd):
            whole = [np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, np.uint32) for t in texts.take(pa.array(odd)).to_pylist()]
            more = np.array([len(x) for x in whole])
            ids = np.insert(ids, np.repeat(starts[odd], more), np.concatenate(whole))
            n[odd] += more
        return ids, n


_BLOCK = 1 << 20


def _gathered(flat: np.ndarray, length: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The runs of flat, whose lengths are given, in the order of which."""
    first, parts = np.cumsum(length) - length, []
    for k in range(0, len(which), _BLOCK):
        n = length[which[k : k + _BLOCK]]
        parts.append(flat[np.repeat(first[which[k : k + _BLOCK]] - (np.cumsum(n) - n), n) + np.arange(n.sum())])
    return np.concatenate(parts) if parts else flat[:0]


_loaded: dict[str, TextEncoder] = {}


def _places(chosen: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places in pair that hold one of chosen, sorted; which one): by a hash table, as most pairs are not chosen.

    A pair whose slot is another's, which chosen pairs may share, is looked up by binary search.
    """
    kind, factor, shift = (np.uint32, 0x9E3779B1, 14) if pair.dtype == np.uint32 else (np.uint64, 0x9E3779B97F4A7C15, 46)
    slot = lambda x: (x * kind(factor) >> kind(shift)).astype(np.intp)
    table, taken = np.zeros(1 << 18, np.int32), np.zeros(1 << 18, bool)
    slots = slot(chosen)
    table[slots], taken[slots] = np.arange(len(chosen), dtype=np.int32), True
    slots = slot(pair)
    at = np.flatnonzero(taken[slots])
    which, here = table[slots[at]], pair[at]
    which = which.astype(np.intp)
    same = chosen[which] == here
    others = np.flatnonzero(~same)
    if len(others):
        spot = np.minimum(np.searchsorted(chosen, here[others]), len(chosen) - 1)
        which[others] = spot
        same[others] = chosen[spot] == here[others]
    same = np.flatnonzero(same)
    return at[same], which[same]


def compress(ids: np.ndarray, lengths: np.ndarray, terminals: int) -> bytes:
    """The shard of these documents. NumPy is much faster by indices of its own kind than by others or by masks."""
    seq = ids.astype(np.uint32)
    left, right, size = [], [], [np.ones(terminals, np.uint32)]
    rounds: list[int] = []
    top, sizes = terminals, size[0]
    counts = np.bincount(seq, minlength=terminals)
    stops = np.arange(terminals) == END  # symbols that end a document: no rule goes on behind them
    newest = 0  # from here on symbols are new since all pairs that occur LEAST times were replaced
    while len(seq) > 1:
        often = counts >= LEAST  # others are in no pair that is
        side = ((often & ~stops).astype(np.uint8) | often.astype(np.uint8) << 1)[seq.astype(np.intp)]  # 1: may be a left symbol, 2: a right one
        may = (side[:-1] & (side[1:] >> 1)).view(bool)
        if newest:
            new = seq >= newest
            may &= new[:-1] | new[1:]
        where = np.flatnonzero(may)
        if len(where) < LEAST:
            break
        kind, shift = (np.uint32, 16) if top <= 1 << 16 else (np.uint64, 32)
        low = kind((1 << shift) - 1)
        pair = (seq[:-1].astype(kind, copy=False) << kind(shift) | seq[1:])[where]
        in_order = np.sort(pair)
        first = np.flatnonzero(np.concatenate(([True], in_order[1:] != in_order[:-1])))
        count = np.diff(np.concatenate((first, [len(in_order)])))
        kinds = in_order[first]
        most = int(count.max())
        if most < LEAST:
            break
        enough = max(LEAST, int(most * SHARE))
        if enough == LEAST:
            newest = top  # later on counts of pairs of old symbols can but fall
        chosen = kinds[count >= enough]
        hit, which = _places(chosen, pair)
        at = where[hit]
        run = np.concatenate(([True], np.diff(at) != 1))  # of pairs that overlap, every second from the left
        began = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
        second = np.flatnonzero((np.arange(len(at)) - began) & 1 == 0)
        at = at[second]
        which = which[second]
        times = np.bincount(which, minlength=len(chosen))
        used = np.flatnonzero(times)
        symbol = (np.cumsum(times > 0) - 1)[which]
        a, b = (chosen[used] >> kind(shift)).astype(np.uint32), (chosen[used] & low).astype(np.uint32)
        seq[at] = top + symbol
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq = seq[np.flatnonzero(keep)]
        left.append(a)
        right.append(b)
        size.append(sizes[a] + sizes[b])
        sizes = np.concatenate((sizes, size[-1]))
        stops = np.concatenate((stops, stops[b]))
        times = times[used]
        counts = np.concatenate((counts, times))
        np.subtract.at(counts, a, times)
        np.subtract.at(counts, b, times)
        rounds.append(len(used))
        top += len(used)
    covers = sizes[seq.astype(np.intp)]
    positions = np.cumsum(covers, dtype=np.uint32) - covers
    head = struct.pack("<4s6I", b"RPS1", terminals, top - terminals, len(rounds), len(seq), len(lengths), len(ids))
    arrays = [np.array(rounds), *left, *right, *size[1:], lengths, positions[::ANCHOR], seq]
    return head + b"".join(np.asarray(x, "<u4").tobytes() for x in arrays)


class Shard:
    """Reads one shard."""

    def __init__(self, payload: bytes):
        magic, self.terminals, rules, rounds, symbols, docs, self.n_ids = struct.unpack_from("<4s6I", payload)
        if magic != b"RPS1":
            raise ValueError("not a shard")
        at = 28

        def take(n: int) -> np.ndarray:
            nonlocal at
            at += 4 * n
            return np.frombuffer(payload, "<u4", n, at - 4 * n)

        self.rounds, self.left, self.right, size, self.lengths = take(rounds), take(rules), take(rules), take(rules), take(docs)
        self.anchors, self.seq = take(-(-symbols // ANCHOR)), take(symbols)
        self.size = np.concatenate((np.ones(self.terminals, np.uint32), size))
        self._text, self._at = np.arange(self.terminals, dtype=np.uint32), np.arange(self.terminals, dtype=np.int64)
        done = 0
        for n in self.rounds.tolist():  # the rules of a round use earlier rounds only
            pairs = np.stack((self.left[done : done + n], self.right[done : done + n]), 1).ravel()
            starts = np.cumsum(size[done : done + n], dtype=np.int64) - size[done : done + n] + len(self._text)
            self._text, self._at = np.concatenate((self._text, self._expand(pairs))), np.concatenate((self._at, starts))
            done += n

    def _expand(self, symbols: np.ndarray) -> np.ndarray:
        n = self.size[symbols].astype(np.int64)
        return self._text[np.repeat(self._at[symbols] - (np.cumsum(n) - n), n) + np.arange(n.sum())]

    def ids(self) -> np.ndarray:
        return self._expand(self.seq)

    def read(self, start: int, stop: int) -> np.ndarray:
        """The ids from position start to before stop; only the symbols there are expanded."""
        stop = min(stop, self.n_ids)
        if start >= stop:
            return np.empty(0, np.uint32)
        a = max(int(np.searchsorted(self.anchors, start, "right")) - 1, 0)
        b = int(np.searchsorted(self.anchors, stop, "left"))
        part = self.seq[a * ANCHOR : b * ANCHOR]
        began = int(self.anchors[a])
        return self._expand(part)[start - began : stop - began]

    def document(self, nth: int) -> np.ndarray:
        start = int(self.lengths[:nth].sum(dtype=np.int64))
        return self.read(start, start + int(self.lengths[nth]))


_ROW = pa.schema([("part", pa.int32()), ("nth", pa.int32()), ("before", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.string())), ("payload", pa.binary())])


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, pa.Array]]:
    """The texts and keys of a batch, in equal slices of about SLICE bytes of text; a text is never split."""
    texts, keys = batch.column("text").cast(pa.large_string()), batch.column("key").cast(pa.string())
    ends, done = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64), 0
    whole = int(ends[-1]) if len(ends) else 0
    parts = max(round(whole / SLICE), 1)  # without a small rest, for which all that is remembered would be searched once more
    for stop in np.searchsorted(ends, [whole * k // parts for k in range(1, parts + 1)], "right").tolist():
        if stop > done:
            yield texts.slice(done, stop - done), keys.slice(done, stop - done)
            done = stop


def write_shards(docs: DataFrame, tokenizer_path: str, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", shard_ids: int = SHARD_IDS) -> str:
    """Encodes docs into a table of shards; returns its path (in the shared folder if none is given)."""
    kind = docs.schema[id_col].dataType.simpleString()
    path = path or f"{shared_dir(docs.sparkSession)}/shards-{uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        if tokenizer_path not in _loaded:
            _loaded[tokenizer_path] = TextEncoder(tokenizer_path)
        encoder = _loaded[tokenizer_path]
        terminals = max(encoder.tokenizer.get_vocab_size(), END + 1)
        part, nth, before = TaskContext.get().partitionId(), 0, 0
        keys, held, lengths, n = [], [], [], 0  # documents of the shard to come

        def shard() -> pa.RecordBatch:
            nonlocal nth, before, keys, held, lengths, n
            payload = compress(np.concatenate(held), np.concatenate(lengths), terminals)
            row = [[part], [nth], [before], [n], [pa.concat_arrays(keys).to_pylist()], [payload]]
            nth, before, keys, held, lengths, n = nth + 1, before + n, [], [], [], 0
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(row, _ROW)], schema=_ROW)

        for batch in batches:
            for texts, names in _slices(batch):
                ids, sizes = encoder.encode(texts)
                ends, done = np.cumsum(sizes), 0
                while done < len(ends):  # a shard ends with the document that fills it
                    start = int(ends[done - 1]) if done else 0
                    last = min(int(np.searchsorted(ends, start + shard_ids - n)), len(ends) - 1)
                    stop = int(ends[last])
                    keys.append(names.slice(done, last + 1 - done))
                    held.append(ids[start:stop])
                    lengths.append(sizes[done : last + 1])
                    n += stop - start
                    done = last + 1
                    if n >= shard_ids:
                        yield shard()
        if held:
            yield shard()

    ordered = docs.select(column(id_col).alias("key"), whole_text(text_col).alias("text")).repartitionByRange(F.col("key").asc_nulls_first()).sortWithinPartitions(F.col("key").asc_nulls_first(), "text")
    named = ordered.select(F.col("key").cast("string").alias("key"), "text")  # as a string: pandas has no whole numbers beside nulls
    shards = named.mapInArrow(run, "part int, nth int, before long, n_ids long, doc_ids array<string>, payload binary")
    shards.withColumn("doc_ids", F.col("doc_ids").cast(f"array<{kind}>")).write.option("compression", "zstd").parquet(path)
    return path


def read_documents(spark, path: str, id_col: str = "doc_id") -> DataFrame:
    """A row per document of the shards: id, start, n_tokens, ids_crc32."""
    shards = spark.read.parquet(path)
    kind = shards.schema["doc_ids"].dataType.elementType.simpleString()
    parts = materialise(shards.groupBy("part").agg(F.sum("n_ids").alias("_n")), "parts")  # a row per part
    starts = parts.select("part", (F.sum("_n").over(Window.orderBy("part")) - F.col("_n")).alias("_part_start"))
    starts = F.broadcast(starts) if parts.count() <= BROADCAST_PARTS else starts

    schema = pa.schema([(id_col, pa.string()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (first, before) in enumerate(zip(batch.column("_part_start").to_pylist(), batch.column("before").to_pylist())):
                shard = Shard(batch.column("payload")[i].as_buffer())
                ids, ends = memoryview(shard.ids().astype("<u4", copy=False)).cast("B"), np.cumsum(shard.lengths, dtype=np.int64)
                at = [0, *(4 * ends).tolist()]
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(at, at[1:])]
                columns = [batch.column("doc_ids")[i].values.cast(pa.string()), ends - shard.lengths + first + before, shard.lengths.astype(np.int64), crc]
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) if not isinstance(x, pa.Array) else x for x, f in zip(columns, schema)], schema=schema)

    rows = shards.join(starts, "part").select("_part_start", "before", F.col("doc_ids").cast("array<string>").alias("doc_ids"), "payload")
    return rows.mapInArrow(run, f"`{id_col}` string, start long, n_tokens long, ids_crc32 long").withColumn(id_col, F.col(f"`{id_col}`").cast(kind))
