"""Large JSON documents, read in parallel.

A document is cut at its commas by Spark's text reader, which deals byte ranges of a file to tasks,
from any store. Whether a comma separates elements depends on what stands before it: whether
it is within a string, and how many brackets are open. Each byte range gives a summary that can be
merged with its neighbours' (number of quotes; brackets opened less closed, if it begins outside a string
and if it begins within one), a row per range. Merged over the ranges, the summaries tell the state in which
each one begins, and a second pass cuts it into elements; those that reach over the end of a range are put
together again. No byte range waits for another one, and no file is one row.

    elements(spark, path, depth)

gives, for each element in the first `depth` levels of brackets (an object's values, an array's items) that is
a scalar or stands at that depth: file, n (1, 2, ... in the order of the document), level, k1, ..., its keys
from the outermost bracket on ('' for the place in an array), and json, the text of its value.

Text that is no JSON is an error. Escapes never reach over a comma, since a backslash before one is no JSON.
Empty objects and arrays at or above `depth` have no elements.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lectern.operators import sequence as S
from lectern.shared import materialise

_KEY = re.compile(r'\s*"((?:[^"\\]|\\.)*)"\s*:', re.S)
_OPEN = re.compile(r"\s*[\[{]")
_CLOSED = re.compile(r"[\s\]}]*")
_decoder = json.JSONDecoder()


def _scan(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ends, quotes up to each byte, brackets): brackets are +1 and -1, wherever they stand; escaped quotes don't count."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.empty(0, np.uint8)
    slash = data == ord("\\")
    quote = data == ord('"')
    if slash.any():
        at = np.arange(len(data))
        last_other = np.maximum.accumulate(np.where(slash, -1, at))  # the byte before the run of backslashes
        run = np.zeros(len(data), np.int64)
        run[1:] = np.where(slash[:-1], at[:-1] - last_other[:-1], 0)
        quote &= run % 2 == 0
    bracket = ((data == ord("[")) | (data == ord("{"))).astype(np.int64) - ((data == ord("]")) | (data == ord("}")))
    return offsets[1:] - offsets[0], np.cumsum(quote), bracket


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, block, quotes, outside, within) of each byte range: its quotes, and the change in depth for both ways to begin."""
    sums: dict[tuple[str, int], list[int]] = {}
    for batch in batches:
        for key, part in _by_block(batch):
            _, quotes, bracket = _scan(part.column("value"))
            s = sums.setdefault(key, [0, 0, 0])
            odd = quotes + s[0] & 1
            s[1] += int(bracket[odd == 0].sum())
            s[2] += int(bracket[odd == 1].sum())
            s[0] += int(quotes[-1]) if len(quotes) else 0
    if sums:
        columns = [*zip(*sums.values())]
        yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in sums]), pa.array([b for _, b in sums]), *map(pa.array, columns)], names=["file", "block", "quotes", "outside", "within"])


def _by_block(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    files, blocks = batch.column("file").dictionary_encode(), batch.column("block").to_numpy()
    cuts = np.flatnonzero((np.diff(files.indices.to_numpy()) != 0) | (np.diff(blocks) != 0)) + 1
    edges = [0, *cuts.tolist(), len(blocks)]
    for a, z in zip(edges, edges[1:]):
        if z > a:
            yield (batch.column("file")[a].as_py(), int(blocks[a])), batch.slice(a, z - a)


def _cut(depth: int):
    """Cuts byte ranges, whose rows come in order with the state they begin in, into (file, block, at, begins, level, text)."""
    names = ["file", "block", "at", "begins", "level", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, quotes, level, held, first = None, 0, 0, [], None  # held: texts of the element to come; first: where it begins

        def emit(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.string()))], names=names)

        for batch in batches:
            out = []
            for key, part in _by_block(batch):
                if key != now:
                    if held:
                        out.append((*now, *first, ",".join(held)))
                    now, quotes, level, held = key, part.column("quotes")[0].as_py(), part.column("depth")[0].as_py(), []
                    first = part.column("at")[0].as_py(), quotes % 2 == 0 and level <= depth, level
                ends, count, bracket = _scan(part.column("value"))
                odd = count + quotes & 1
                deep = np.concatenate(([level], level + np.cumsum(np.where(odd == 0, bracket, 0))))
                state = np.concatenate(([quotes & 1], odd))
                cut = np.flatnonzero((state[ends] == 0) & (deep[ends] <= depth))  # what follows these rows is another element
                at, texts, done = part.column("at").to_pylist(), part.column("value").to_pylist(), 0
                for k in cut.tolist():
                    out.append((*now, *first, ",".join([*held, *texts[done : k + 1]])))
                    held, done = [], k + 1
                    first = (at[k] + 1, True, int(deep[ends[k]]))
                held += texts[done:]
                quotes, level = quotes + (int(count[-1]) if len(count) else 0), int(deep[-1])
            if out:
                yield emit(out)
        if held:
            yield emit([(*now, *first, ",".join(held))])

    return run


def _element(text: str, level: int, depth: int) -> tuple[int, list[str | None], str | None]:
    """(level of the value, keys that are set by level, the value's text) of what stands between two separators."""
    keys: list[str | None] = [None] * depth
    at = 0
    while True:
        if level:
            m = _KEY.match(text, at)
            keys[level - 1] = json.loads(f'"{m[1]}"') if m else ""
            at = m.end() if m else at
        m = _OPEN.match(text, at)
        if not m or level == depth:
            break
        level, at = level + 1, m.end()
    rest = text[at:].lstrip()
    if rest[:1] in ("]", "}", ""):
        end, value = 0, None
        if level and keys[level - 1]:
            raise ValueError(f"no value: {text[:80]!r}")
    else:
        _, end = _decoder.raw_decode(rest)
        value = rest[:end]
    if _CLOSED.fullmatch(rest, end) is None:
        raise ValueError(f"no JSON: {rest[end : end + 80]!r}")
    return level, keys, value


def elements(spark: SparkSession, path: str, depth: int) -> DataFrame:
    pieces = spark.read.option("lineSep", ",").text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    rows = materialise(pieces, "json").repartition("file", "block").sortWithinPartitions("file", "block", "at")
    sums = materialise(rows.select("file", "block", "value").mapInArrow(_summaries, "file string, block long, quotes long, outside long, within long"), "summaries")
    before = Window.partitionBy("file").orderBy("block")  # a row per byte range
    sums = sums.withColumn("begin", F.sum("quotes").over(before) - F.col("quotes"))
    sums = sums.withColumn("change", F.when(F.col("begin") % 2 == 0, F.col("outside")).otherwise(F.col("within")))
    sums = sums.withColumn("depth", F.sum("change").over(before) - F.col("change"))
    ends = sums.groupBy("file").agg(F.sum("quotes").alias("q"), F.sum("change").alias("d"))
    if bad := ends.where("q % 2 <> 0 OR d <> 0").select("file").limit(5).collect():
        raise ValueError(f"brackets or quotes without their ends: {[r['file'] for r in bad]}")
    states = sums.select("file", "block", F.col("begin").alias("quotes"), "depth")
    started = rows.join(F.broadcast(states), ["file", "block"]).select("file", "block", "at", "quotes", "depth", "value").repartition("file", "block").sortWithinPartitions("file", "block", "at")
    cut = materialise(started.mapInArrow(_cut(depth), "file string, block long, at long, begins boolean, level int, text string"), "elements")
    # what goes on over the end of a range: its last text, then whole ranges, then the next range's first one
    place = cut.groupBy("file", "block").agg(F.max("at").alias("end"))  # a row per byte range
    marked = cut.join(F.broadcast(place), ["file", "block"])
    inner = marked.where("begins AND at < end").select("file", "block", "at", "level", "text")
    outer = marked.where("NOT (begins AND at < end)").withColumn("chain", F.sum(F.col("begins").cast("int")).over(Window.partitionBy("file").orderBy("block", "at")))  # two rows per range at most
    parts = F.array_sort(F.collect_list(F.struct("block", "at", "text")))
    chained = outer.groupBy("file", "chain").agg(F.min_by(F.struct("block", "at", "level"), F.struct("block", "at")).alias("f"), F.array_join(F.transform(parts, lambda s: s["text"]), ",").alias("text"))
    whole = inner.unionByName(chained.select("file", "f.block", "f.at", "f.level", "text"))

    names = [f"k{i}" for i in range(1, depth + 1)]

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [_element(t, d, depth) for t, d in zip(b.column("text").to_pylist(), b.column("level").to_pylist())]
            keys = [pa.array([k[i] for _, k, _ in got], pa.string()) for i in range(depth)]
            yield pa.RecordBatch.from_arrays([b.column("file"), b.column("block"), b.column("at"), pa.array([d for d, *_ in got], pa.int32()), *keys, pa.array([v for *_, v in got], pa.string())], names=["file", "block", "at", "level", *names, "json"])

    keyed = whole.mapInArrow(named, f"file string, block long, at long, level int, {', '.join(f'{k} string' for k in names)}, json string")
    order = ["file", "block", "at"]
    filled = S.carry_forward(keyed, order, names).where("json IS NOT NULL")
    own = [F.when(F.col("level") >= i, F.col(k)).alias(k) for i, k in enumerate(names, 1)]
    return S.running_id(filled, order, "n").select("file", "n", "level", *own, "json")
