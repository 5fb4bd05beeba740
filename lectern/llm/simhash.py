"""Near-duplicates by SimHash fingerprints and deletion-variant signatures.

Fingerprint: the words of the text in lower case (A to Z only), shingles of three words;
each shingle is hashed by XXH64, and a bit of the fingerprint is set if it is set in over
half of the hashes. Two texts are linked if their fingerprints differ in at most three bits.

Candidates: of two halves of 32 bits one differs in at most one bit. So each distinct
fingerprint gets, for each half and each of its bits, a signature in which that bit is a
wildcard: 64 in all. Linked fingerprints agree in a signature, and what agrees in one is
verified. A pair is reported in one signature only.

A signature that more than BIG fingerprints share is not compared pair by pair (one whose
members all come in one Arrow batch may be, so never more than a batch). Its
members agree in half the fingerprint but for one bit, so they go through the same step
again within the other half: two quarters, 16 wildcards each, and if need be two eighths.
After that at most 2^11 fingerprints can agree, so the work has a bound, no link is lost
and no two rows are ever paired without need. From signatures with over NEAR members
only what keeps the members' components together is reported, not each link.

Equal fingerprints are combined before anything is compared.

Edge cases: a null text is empty; a text without words has fingerprint 0, one with fewer
than three words has one shingle. A null doc_id takes part, but names a component only if
the component has no other. No rows give no rows. A fingerprint that many rows share is
joined by broadcast (at most 2,000 can be that frequent).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from ._shared import column, join_groups, materialise, own_columns, sortable, unused_prefix, whole_text
from .components import connected_components

WORDS, SEED, DISTANCE = 3, 42, 3
#: Most members of a signature that are compared directly; over NEAR, only components are reported.
BIG, NEAR = 4096, 32
_BLOCK = 1 << 16


def fingerprint(text: str) -> int:
    """As an unsigned number."""
    words = text.encode().lower().split()  # bytes: A to Z, and the six ASCII white-space characters
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < WORDS:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - WORDS + 1].tolist()
    ends, digest = ends[WORDS - 1 :].tolist(), xxhash.xxh64_digest
    counts = np.zeros(64, np.int64)
    for k in range(0, len(starts), _BLOCK):
        raw = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[k : k + _BLOCK], ends[k : k + _BLOCK])])
        bits = np.unpackbits(np.frombuffer(raw + bytes(-len(raw) % 2040), np.uint8)).reshape(-1, 255, 64)
        counts += bits.sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(starts)).tobytes(), "big")


def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64))


def fingerprint_of(text_col: str = "text") -> Column:
    """The fingerprint as a signed long with the same bits."""
    return F.pandas_udf(_fingerprints, "long")(whole_text(text_col))


def _masked(fp: Column, shift: int, width: int, bit: int) -> Column:
    """The `width` bits of fp from bit `shift` with one of them set to 0."""
    return F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit(~(1 << bit) & ((1 << width) - 1)).cast("long"))


def _halves(fp: Column) -> Column:
    """The 64 signatures: which half (0 is the upper one), which bit, the half without it."""
    return F.array(*(F.lit((half * 32 + bit) << 32).cast("long").bitwiseOR(_masked(fp, 32 - 32 * half, 32, bit)) for half in (0, 1) for bit in range(32)))


def _within(fp: Column, key: Column, shift: int, width: int, other: int) -> Column:
    """Signatures of one part, below a key; the last two bits tell which quarter (from the lowest) is still free."""
    return F.array(*(F.xxhash64(key, F.lit(shift), F.lit(bit), _masked(fp, shift, width, bit)).bitwiseAND(F.lit(~3).cast("long")).bitwiseOR(F.lit(other).cast("long")) for bit in range(width)))


def _components(values: np.ndarray, ok) -> tuple[np.ndarray, np.ndarray]:
    """(values, their component's smallest) of those that are linked to any other."""
    label = np.arange(len(values))
    step = max(1, (1 << 20) // len(values))
    rows = [np.nonzero(ok(values[k : k + step, None], values[None, :])) for k in range(0, len(values), step)]
    a = np.concatenate([x[0] + i * step for i, x in enumerate(rows)])
    b = np.concatenate([x[1] for x in rows])
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(values))
    return values[moved], values[label[moved]]


def _compare(level: int):
    """Of rows sorted by key: links (kind 0: a, b), and the members of big keys (kind 1: key, member)."""

    def verified(key: int):
        half, bit = key >> 37, key >> 32 & 31

        def ok(a, b):
            x = a ^ b
            near = (np.bitwise_count(x) <= DISTANCE) & (a < b)
            if level > 1:
                return near
            own = (x >> np.uint64(0 if half else 32)) & np.uint64(0xFFFFFFFF)
            near &= (own != 0) | (bit == 0)  # agreement in the whole half counts at its first bit only
            return near & (np.bitwise_count(x >> np.uint64(32)) > 1) if half else near

        return ok

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple[int, np.ndarray, np.ndarray]] = []
        rest_k, rest_v, big = np.empty(0, np.int64), np.empty(0, np.uint64), None

        def done(k: np.ndarray, v: np.ndarray) -> None:
            """k, v: whole runs of keys."""
            if len(k) < 2:
                return
            new = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
            size = np.diff(np.concatenate((new, [len(k)])))
            length = np.repeat(size, size)
            half, bit = k >> 37, (k >> 32) & 31
            for d in range(1, min(NEAR, int(size.max()))):
                i = np.flatnonzero((k[d:] == k[:-d]) & (length[:-d] <= NEAR))
                if not len(i):
                    break
                a, b = v[i], v[i + d]
                x = a ^ b
                ok = np.bitwise_count(x) <= DISTANCE
                if level == 1:
                    own = np.where(half[i] == 1, x & np.uint64(0xFFFFFFFF), x >> np.uint64(32))
                    ok &= ((own != 0) | (bit[i] == 0)) & ((half[i] == 0) | (np.bitwise_count(x >> np.uint64(32)) > 1))
                out.append((0, a[ok], b[ok]))
            for s, n in zip(new[size > NEAR].tolist(), size[size > NEAR].tolist()):
                out.append((0, *_components(v[s : s + n], verified(int(k[s])))))

        def flush() -> pd.DataFrame:
            frame = pd.DataFrame({"kind": np.concatenate([np.full(len(a), kind, np.int32) for kind, a, _ in out]), "a": np.concatenate([a.view(np.int64) for _, a, _ in out]), "b": np.concatenate([b.view(np.int64) for _, _, b in out])})
            out.clear()
            return frame

        for batch in batches:
            k = np.concatenate((rest_k, batch["key"].to_numpy(np.int64)))
            v = np.concatenate((rest_v, batch["fp"].to_numpy(np.int64).view(np.uint64)))
            if big is not None:  # rows of a key that is already known to be big
                n = int(np.searchsorted(k != big, True)) if (k != big).any() else len(k)
                out.append((1, k[:n], v[:n]))
                k, v = k[n:], v[n:]
            if len(k):
                cut = int(np.flatnonzero(k != k[-1])[-1]) + 1 if (k != k[-1]).any() else 0
                big = None
                done(k[:cut], v[:cut])
                rest_k, rest_v = k[cut:], v[cut:]
                if level < 3 and len(rest_k) > BIG:
                    big = rest_k[0]
                    out.append((1, rest_k, rest_v))
                    rest_k, rest_v = rest_k[:0], rest_v[:0]
            else:
                rest_k, rest_v = k, v
            if out:
                yield flush()
        done(rest_k, rest_v)
        if out:
            yield flush()

    return run


def links(fps: DataFrame) -> DataFrame:
    """Pairs (a, b) of the distinct fingerprints `fp` that hold each component together; each link itself where signatures have few members."""
    found = None
    rows = fps.select("fp", F.explode(_halves(F.col("fp"))).alias("key"))
    for level in (1, 2, 3):
        out = materialise(rows.repartition("key").sortWithinPartitions("key", "fp").mapInPandas(_compare(level), "kind int, a long, b long"), f"links{level}")
        pairs = out.where("kind = 0").select("a", "b")
        found = pairs if found is None else found.unionByName(pairs)
        if level == 3 or out.where("kind = 1").isEmpty():
            return found
        rows = out.where("kind = 1").select(F.col("b").alias("fp"), F.explode(_deeper(F.col("a"), F.col("b"), level)).alias("key"))


def _deeper(key: Column, fp: Column, level: int) -> Column:
    """The signatures, below a big key, of the part in which its members may still differ by more than a bit."""
    if level == 1:  # the other half, in two quarters
        cut = [F.concat(_within(fp, key, s, 16, s // 16 + 1), _within(fp, key, s + 16, 16, s // 16)) for s in (0, 32)]
        return F.when(F.shiftrightunsigned(key, 37) == 0, cut[0]).otherwise(cut[1])
    cut = [F.concat(_within(fp, key, s, 8, 0), _within(fp, key, s + 8, 8, 0)) for s in (0, 16, 32, 48)]
    free = key.bitwiseAND(F.lit(3).cast("long"))
    return F.when(free == 0, cut[0]).when(free == 1, cut[1]).when(free == 2, cut[2]).otherwise(cut[3])


def _prints(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    return materialise(docs.select(column(id_col).alias("_id"), *more, fingerprint_of(text_col).alias("fp")), "fingerprints")


def assign_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per row of docs: id, fingerprint (16 hexadecimal digits), component_id. Other columns are ignored."""
    prints = _prints(docs, id_col, text_col)
    table = materialise(component_table(prints), "components")
    return join_groups(prints, table, ["fp"], "_size").select(F.col("_id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def component_table(prints: DataFrame) -> DataFrame:
    """(fp, root, component_id, _size) for each distinct fp of prints (_id, fp); root is the smallest fp of the component, _size how many rows have fp."""
    distinct = materialise(prints.groupBy("fp").agg(F.min("_id").alias("_least"), F.count(F.lit(1)).alias("_size")), "distinct")
    stars = connected_components(links(distinct))
    linked = distinct.join(stars.withColumnRenamed("node", "fp"), "fp")
    named = materialise(linked.groupBy("root").agg(F.min("_least").alias("_id"), F.count(F.lit(1)).alias("_nodes")), "named")
    by_fp = join_groups(stars, named, ["root"], "_nodes").select(F.col("node").alias("fp"), "root", "_id")
    return distinct.join(by_fp, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), F.coalesce("_id", "_least").alias("component_id"), "_size")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, one with the smallest id, with all columns of docs, whatever their names.

    The fingerprints are worked out once, beside the ids and SHA-256 of the texts; those name
    the row that stays. The documents are shuffled once, by both.
    """
    p = unused_prefix(docs)
    sha = F.unhex(F.sha2(whole_text(text_col), 256))
    prints = _prints(docs, id_col, text_col, sha.alias("_sha"))
    least = lambda key: F.min(F.struct(key.isNull().alias("n"), key.alias("id"), F.col("fp"), F.col("_sha")))
    table = materialise(component_table(prints).select("fp", "root"), "components")
    heads = prints.groupBy("fp").agg(least(F.col("_id")).alias("_row")).join(table, "fp").groupBy("root").agg(F.min("_row").alias("_row"))
    name = lambda c: [F.coalesce(c.cast("string"), F.lit("")).alias(f"{p}id"), c.isNull().alias(f"{p}null")]
    keys = [f"{p}id", f"{p}null", f"{p}sha"]
    keep = materialise(heads.select(*name(F.col("_row.id")), F.col("_row._sha").alias(keys[2])), "heads")
    tagged = docs.select("*", *name(column(id_col)), sha.alias(keys[2]))
    first = Window.partitionBy(*keys).orderBy(*sortable(docs))  # the join has dealt the rows by the same keys
    return tagged.join(keep, keys, "left_semi").withColumn(f"{p}nth", F.row_number().over(first)).where(F.col(f"{p}nth") == 1).select(*own_columns(docs))
