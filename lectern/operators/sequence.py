"""Positions in a canonical order: running ids, start markers, id ranges.

No operator puts all rows into one task. Rows are dealt into ranges of the order, sorted in
each, and written once with their place (range in the upper bits), so what is worked out
per range and what is worked out over all ranges speak of the same rows. Over all ranges
there is a row a range only. Small inputs come out as one range, by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lectern.shared import materialise, quoted, unused_prefix

_LOCAL_BITS = 33  # of monotonically_increasing_id: what numbers the rows of a partition


def _tie(df: DataFrame) -> list[Column]:
    """A hash of the whole row: rows with equal order keys are dealt and numbered by it, so a constant key is no single range and each run gives the same ids."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return [F.xxhash64(*(F.col(quoted(c)) for c, k in kinds.items() if "map<" not in k and "variant" not in k))]


def _ranged(df: DataFrame, order: list[str], place: str) -> DataFrame:
    """df written in ranges of (order, hash of the row); place rises along it and has the range above _LOCAL_BITS."""
    by = [*(F.col(quoted(c)) for c in order), *_tie(df)]
    return materialise(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn(place, F.monotonically_increasing_id()), "ranged")


def _range_of(place: str) -> Column:
    return F.shiftright(place, _LOCAL_BITS)


def running_id(df: DataFrame, order: list[str], out: str = "id") -> DataFrame:
    """1, 2, ... as long, in the given order (nulls first; rows that tie by a hash of the row, so ids are the same in each run).

    One shuffle and one write of df; the sizes of the ranges, a row each, tell where each begins.
    """
    p = unused_prefix(df)
    rows = _ranged(df, order, f"{p}at")
    sizes = rows.groupBy(_range_of(f"{p}at").alias(f"{p}r")).agg(F.count(F.lit(1)).alias(f"{p}n"))
    starts = sizes.select(f"{p}r", (F.sum(f"{p}n").over(Window.orderBy(f"{p}r")) - F.col(f"{p}n")).alias(f"{p}b"))  # a row per range
    local = F.col(f"{p}at").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    joined = rows.join(starts, _range_of(f"{p}at") == F.col(f"{p}r"))
    return joined.select(*(F.col(quoted(c)) for c in df.columns), (local + F.col(f"{p}b") + 1).alias(out))


def _carried(rows: DataFrame, columns: list[str], p: str) -> DataFrame:
    """rows, which have their place {p}at and range {p}r, with nulls replaced by the last value before them."""
    last = lambda c, w: F.last(c, ignorenulls=True).over(w)
    ends = rows.groupBy(f"{p}r").agg(*(F.max_by(quoted(c), F.when(F.col(quoted(c)).isNotNull(), F.col(f"{p}at"))).alias(f"{p}{i}") for i, c in enumerate(columns)))
    before = Window.orderBy(f"{p}r").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    brought = ends.select(F.col(f"{p}r").alias(f"{p}q"), *(last(f"{p}{i}", before).alias(f"{p}{i}") for i in range(len(columns))))
    here = Window.partitionBy(f"{p}r").orderBy(f"{p}at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.select("*", *(last(quoted(c), here).alias(f"{p}l{i}") for i, c in enumerate(columns)))
    joined = local.join(brought, F.col(f"{p}r") == F.col(f"{p}q"))
    at = {c: F.coalesce(f"{p}l{i}", f"{p}{i}").alias(c) for i, c in enumerate(columns)}
    return joined.select(*(at.get(c, F.col(quoted(c))) for c in rows.columns))


def carry_forward(df: DataFrame, order: list[str], columns: list[str]) -> DataFrame:
    """df with the columns' nulls replaced by the last value before them in the order; null before the first."""
    p = unused_prefix(df)
    rows = _ranged(df, order, f"{p}at").withColumn(f"{p}r", _range_of(f"{p}at"))
    return _carried(rows, columns, p).select(*(F.col(quoted(c)) for c in df.columns))


def marker_ordinals(markers: DataFrame, order: str, out: str = "n") -> DataFrame:
    """Markers get their rank in the order column; a stored number is not looked at."""
    return running_id(markers, [order], out)


def _highest(markers: DataFrame, keys: list[str], ordinal: str, out: str) -> DataFrame:
    return markers.groupBy(*keys).agg(F.max(ordinal).alias(out))  # of equal positions the last marker holds


def expand_markers(positions: DataFrame, markers: dict[str, DataFrame], keys: list[str], ordinal: str, order: list[str] | None = None) -> DataFrame:
    """Each position gets, per entry of markers, the ordinal of the last marker at or before it, 0 before the first.

    Markers at unknown positions are ignored, though they used up their ordinal; markers
    out of order are legal, so the result may go down along the order. Positions that tie in the
    order are taken by their keys. All entries are carried forward in one pass.
    """
    joined = positions
    for name, m in markers.items():
        joined = joined.join(_highest(m, keys, ordinal, name), keys, "left")
    if not markers:
        return joined
    carried = carry_forward(joined, [*(order or []), *(k for k in keys if k not in (order or []))], list(markers))
    return carried.withColumns({name: F.coalesce(name, F.lit(0)) for name in markers}).select(*positions.columns, *markers)


def scan_markers(positions: DataFrame, markers: dict[str, DataFrame], keys: list[str], rank: str, order: list[str] | None = None) -> DataFrame:
    """expand_markers of markers that have no ordinal yet: the ordinal is the place in the order of their column `rank`.

    Positions and the markers of all dimensions are dealt into ranges and written together,
    once. What is worked out per range is a state that two neighbouring ranges can merge: for each
    dimension the number of markers so far, and the last ordinal met by a position. Merged
    over the ranges (a row per range and dimension), the first gives every marker its
    ordinal and the second what each range starts with. A null rank comes first. Markers with equal
    ranks and positions that tie in the order are both taken by their keys, and by the hash of the row if those are equal, too.
    """
    if not markers:
        return positions
    p, order, names = unused_prefix(positions, *markers.values()), order or keys, list(markers)
    own, kinds = positions.columns, {f.name: f.dataType for f in positions.schema.fields}
    c = lambda name: F.col(quoted(name))
    ranks = {name: m.schema[rank].dataType for name, m in markers.items()}
    blank = lambda name: F.lit(None).cast(ranks[name]).alias(f"{p}o_{name}")
    rows = positions.select(F.lit(0).alias(f"{p}d"), *map(c, own), *map(blank, names))
    for d, (name, m) in enumerate(markers.items(), 1):
        place = [(c(k).cast(kinds[k]) if k in keys else F.lit(None).cast(kinds[k])).alias(k) for k in own]
        rows = rows.unionByName(m.select(F.lit(d).alias(f"{p}d"), *place, *(c(rank).alias(f"{p}o_{n}") if n == name else blank(n) for n in names)))
    by = [F.col(f"{p}d"), *(F.when(F.col(f"{p}d") == 0, c(k)) for k in order), *(c(f"{p}o_{n}") for n in names), *map(c, keys), *_tie(rows)]
    written = materialise(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn(f"{p}at", F.monotonically_increasing_id()), "markers").withColumn(f"{p}r", _range_of(f"{p}at"))

    marks = written.where(F.col(f"{p}d") > 0)
    counts = marks.groupBy(f"{p}d", f"{p}r").agg(F.min(f"{p}at").alias(f"{p}first"), F.count(F.lit(1)).alias(f"{p}n"))
    before = Window.partitionBy(f"{p}d").orderBy(f"{p}r")  # a row per range
    begins = counts.select(F.col(f"{p}d").alias(f"{p}e"), F.col(f"{p}r").alias(f"{p}q"), (F.sum(f"{p}n").over(before) - F.col(f"{p}n") + 1 - F.col(f"{p}first")).alias(f"{p}b"))
    ordinal = marks.join(begins, (F.col(f"{p}d") == F.col(f"{p}e")) & (F.col(f"{p}r") == F.col(f"{p}q"))).withColumn(f"{p}n", F.col(f"{p}at") + F.col(f"{p}b"))
    highest = ordinal.groupBy(*map(c, keys)).agg(*(F.max(F.when(F.col(f"{p}d") == d, F.col(f"{p}n"))).alias(f"{p}v{d}") for d in range(1, len(names) + 1)))
    met = written.where(F.col(f"{p}d") == 0).join(highest, keys, "left")
    values = {name: f"{p}v{d}" for d, name in enumerate(names, 1)}
    carried = _carried(met, list(values.values()), p)
    return carried.select(*map(c, own), *(F.coalesce(carried[v], F.lit(0).cast("long")).alias(name) for name, v in values.items()))


def marker_intervals(positions: DataFrame, markers: DataFrame, key: str, ordinal: str, names: tuple[str, str, str] = ("lo", "hi", "n")) -> DataFrame:
    """(lo, hi, n): the closed range of positions for which each marker that meets a position holds."""
    at = lambda df: df.select(F.col(quoted(key)).cast("long").alias("lo"))
    known = at(positions).distinct().join(_highest(markers.select(F.col(quoted(key)).cast("long").alias("lo"), F.col(quoted(ordinal)).cast("long").alias("n")), ["lo"], "n", "n"), "lo")
    end = at(positions).agg((F.max("lo") + 1).alias("lo")).select("lo", F.lit(None).cast("long").alias("n"))  # ends the last interval
    turned = known.unionByName(end).select((-F.col("lo")).alias("down"), "lo", "n", (F.col("lo") - 1).alias("hi"))
    # from the end to the start, the end of an interval is the place before the last start that was met
    ids = running_id(turned, ["down"], "i")
    following = ids.select((F.col("i") + 1).alias("i"), F.col("hi").alias("stop"))
    return ids.join(following, "i", "left").where("n IS NOT NULL").select(*(F.col(c).alias(name) for c, name in zip(("lo", "stop", "n"), names)))


def expand_markers_by_interval(positions: DataFrame, markers: DataFrame, key: str, ordinal: str, out: str, width: int) -> DataFrame:
    """The same for one whole-number key, by joins: positions meet the intervals of the markers in blocks of `width` and more."""
    joined = range_join(positions, marker_intervals(positions, markers, key, ordinal), key, "lo", "hi", width, keep="n", rank=F.col("n"), out=out)
    return joined.withColumn(out, F.coalesce(F.col(quoted(out)), F.lit(0).cast("long")))


#: Coarse blocks are those of so many levels above the finest, or more; points meet them over so many salts.
COARSE, SALTS = 6, 16


def dyadic_blocks(ranges: DataFrame, lo: str, hi: str, base: int, level: str, block: str) -> DataFrame:
    """ranges with a row for each of the aligned blocks of 2^base, 2^(base + 1), ... positions that together hold [lo, hi].

    A range needs at most two blocks of each size, so their number grows with the logarithm
    of its length. Blocks of the finest size may reach beyond its ends. Ranges that are empty or have a null
    end have none.
    """
    start = "named_struct('a', {a}, 'z', {z}, 'o', cast(array() AS array<struct<l:int,k:bigint>>))"
    cover = f"""
        aggregate(sequence(0, 63), {start}, (s, l) -> CASE WHEN s.a > s.z OR s.a IS NULL OR s.z IS NULL THEN s ELSE named_struct(
            'a', shiftright(s.a, 1) + (s.a & 1), 'z', shiftright(s.z, 1) - (1 - (s.z & 1)),
            'o', concat(s.o, IF(s.a & 1 = 1, array(named_struct('l', l, 'k', s.a)), array()), IF(s.z & 1 = 0, array(named_struct('l', l, 'k', s.z)), array()))) END).o"""
    end = lambda c: f"shiftright(CAST({quoted(c)} AS BIGINT), {base})"
    p = unused_prefix(ranges)
    held = ranges.where(F.col(quoted(lo)) <= F.col(quoted(hi)))
    exploded = held.withColumn(f"{p}b", F.explode(F.expr(cover.format(a=end(lo), z=end(hi)))))
    return exploded.select(*(F.col(quoted(c)) for c in ranges.columns), F.col(f"{p}b.l").alias(level), F.col(f"{p}b.k").alias(block))


def range_join(points: DataFrame, ranges: DataFrame, point: str, lo: str, hi: str, width: int, keep: str, rank: Column, out: str | None = None) -> DataFrame:
    """points with `keep` of a closed range [lo, hi] that holds them (as `out`), null if none does.

    A range is written once for each dyadic block that covers it, a number of rows that grows with
    the logarithm of its length; `width` is the finest block. A point meets one block of
    each size that some range has, in an equi-join; points that are equal meet them once. Where
    ranges overlap, the one with the largest rank wins. Coarse blocks, which may hold a large
    share of the points, are joined over SALTS salts.
    """
    out = out or keep
    base = max(int(width - 1).bit_length(), 0)
    spans = ranges.select(F.col(quoted(lo)).cast("long").alias("a"), F.col(quoted(hi)).cast("long").alias("z"), F.col(quoted(keep)).alias("keep"), rank.alias("rank"))
    blocks = dyadic_blocks(spans, "a", "z", base, "level", "block")
    salts = F.when(F.col("level") >= COARSE, SALTS).otherwise(1)
    blocks = blocks.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    levels = blocks.agg(F.collect_set("level")).scalar()  # at most 64 numbers
    one = points.select(F.col(quoted(point)).cast("long").alias("at")).where("at IS NOT NULL").distinct()
    keyed = one.select("at", F.explode(levels).alias("level")).select("at", "level", F.expr(f"shiftright(shiftright(at, {base}), level)").alias("block"), F.when(F.col("level") >= COARSE, F.pmod(F.xxhash64("at"), F.lit(SALTS))).otherwise(0).cast("int").alias("salt"))
    best = keyed.join(blocks, ["level", "block", "salt"]).where("at BETWEEN a AND z").groupBy("at").agg(F.max_by("keep", "rank").alias("keep"))
    p = unused_prefix(points)
    best = best.select(F.col("at").alias(f"{p}at"), F.col("keep").alias(f"{p}keep"))
    return points.join(best, F.col(quoted(point)).cast("long") == F.col(f"{p}at"), "left").select(*(F.col(quoted(c)) for c in points.columns), F.col(f"{p}keep").alias(out))


def ranges_to_points(ranges: DataFrame, lo: str, hi: str, out: str) -> DataFrame:
    """Short ranges as one row per number."""
    return ranges.withColumn(out, F.explode(F.sequence(F.col(lo), F.col(hi))))


def neighbours(df: DataFrame, order: list[str], value: str, partition: list[str]) -> DataFrame:
    """The previous and next value in the order, within each part."""
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn("previous", F.lag(value).over(w)).withColumn("next", F.lead(value).over(w))
