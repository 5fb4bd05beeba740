"""Joins, deduplication and aggregates with a defined order.

Where the order of rows decides, it is an explicit column; no operator relies on the order
in which Spark happens to deliver rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from lectern.functions.text import strip
from lectern.shared import quoted, unused_prefix


#: A group of so many rows that also has 1/HOT of all rows is put together in two levels.
LONG, HOT = 10_000, 2000


def _c(name: str) -> Column:
    return F.col(quoted(name))


def ordered_concat(df: DataFrame, keys: list[str], order: str, text: str, tie: str | None = None, out: str = "text", long: int = LONG) -> DataFrame:
    """Per group the texts in order, joined by a space and stripped; null texts are left out, and groups without others.

    Rows with equal order and tie come in the order of their texts. Short groups are one sorted
    array each. The rows of long ones (at most HOT groups, met by broadcast) are dealt into ranges of
    (key, order), so one group lies in many tasks; each task joins its run of a group, and the runs are joined
    in the order of the ranges. What is left for one task is to copy the group's text once.
    """
    p = unused_prefix(df)
    key, k = [f"{p}k{i}" for i in range(len(keys))], len(keys)
    rows = df.where(_c(text).isNotNull()).select(*(_c(c).alias(n) for c, n in zip(keys, key)), _c(order).alias(f"{p}o"), (_c(tie) if tie else F.lit(0)).alias(f"{p}t"), _c(text).alias(f"{p}x"))
    item = F.struct(f"{p}o", f"{p}t", f"{p}x")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda s: s[f"{p}x"]), " ")
    sizes = rows.groupBy(*key).agg(F.count(F.lit(1)).alias(f"{p}n"))
    hot = F.broadcast(sizes.where((F.col(f"{p}n") >= long) & (F.col(f"{p}n") * HOT >= sizes.agg(F.sum(f"{p}n")).scalar())).select(*(F.col(n).alias(f"{p}h{i}") for i, n in enumerate(key))))
    same = reduce(Column.__and__, (F.col(n).eqNullSafe(F.col(f"{p}h{i}")) for i, n in enumerate(key)), F.lit(True))
    short = rows.join(hot, same, "left_anti").groupBy(*key).agg(strip(joined).alias(out))
    ranged = rows.join(hot, same, "left_semi").repartitionByRange(*key, f"{p}o", f"{p}t", f"{p}x").withColumn(f"{p}r", F.spark_partition_id())
    runs = ranged.groupBy(*key, f"{p}r").agg(joined.alias(f"{p}x"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(f"{p}r", f"{p}x"))), lambda s: s[f"{p}x"]), " ")
    return short.unionByName(runs.groupBy(*key).agg(strip(whole).alias(out))).select(*(F.col(n).alias(c) for n, c in zip(key, keys)), F.col(quoted(out)))


def last_wins(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Per key the row with the largest order; combined before the shuffle."""
    return _one_of(df, keys, order, F.max_by)


def first_wins(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    return _one_of(df, keys, order, F.min_by)


def _one_of(df: DataFrame, keys: list[str], order: str, pick) -> DataFrame:
    rest, p = [c for c in df.columns if c not in keys], unused_prefix(df)
    return df.groupBy(*map(_c, keys)).agg(pick(F.struct(*map(_c, rest)), _c(order)).alias(f"{p}r")).select(*map(_c, keys), f"{p}r.*")


def override(base: DataFrame, changes: DataFrame, keys: list[str], value: str) -> DataFrame:
    """base with value replaced where changes has the key, and `applied` (0 or 1). Unknown keys of changes are ignored."""
    p = unused_prefix(base, changes)
    new = changes.select(*map(_c, keys), _c(value).alias(f"{p}new"), F.lit(1).alias(f"{p}hit"))
    joined = base.join(new, keys, "left")
    return joined.select(*(F.when(F.col(f"{p}hit").isNotNull(), F.col(f"{p}new")).otherwise(_c(c)).alias(c) if c == value else _c(c) for c in base.columns), F.coalesce(f"{p}hit", F.lit(0)).alias("applied"))


def membership_flag(df: DataFrame, members: DataFrame, keys: list[str], out: str) -> DataFrame:
    """df with out = 1 where members has the key, else 0."""
    p = unused_prefix(df, members)
    return df.join(members.select(*map(_c, keys)).distinct().withColumn(f"{p}member", F.lit(1)), keys, "left").withColumn(out, F.coalesce(f"{p}member", F.lit(0))).drop(f"{p}member")


def with_defaults(df: DataFrame, other: DataFrame, keys: list[str], defaults: dict[str, object]) -> DataFrame:
    """Left join; the named columns get a default instead of null."""
    return df.join(other, keys, "left").withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def fill_counts(parents: DataFrame, children: DataFrame, parent_key: str, child_key: str, declared: str) -> DataFrame:
    """declared where it is neither null nor 0, else the number of children, else 0."""
    p = unused_prefix(parents)
    counts = _counts(children, child_key, p)
    own = F.nullif(_c(declared).cast("long"), F.lit(0).cast("long"))
    return parents.join(counts, _c(parent_key) == F.col(f"{p}k"), "left").withColumn(declared, F.coalesce(own, F.col(f"{p}n"), F.lit(0))).drop(f"{p}k", f"{p}n")


def _counts(children: DataFrame, child_key: str, p: str) -> DataFrame:
    return children.groupBy(_c(child_key).alias(f"{p}k")).agg(F.count(F.lit(1)).alias(f"{p}n"))


def declared_vs_actual(parents: DataFrame, children: DataFrame, parent_key: str, child_key: str, declared: str) -> DataFrame:
    """(parent_key, declared, actual) of parents with children whose number differs. Parents without children aren't reported."""
    p = unused_prefix(parents)
    joined = parents.join(_counts(children, child_key, p), _c(parent_key) == F.col(f"{p}k"))
    return joined.where(_c(declared) != F.col(f"{p}n")).select(_c(parent_key), _c(declared), F.col(f"{p}n").alias("actual"))


def orphans(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    return children.join(parents, children[child_key] == parents[parent_key], "left_anti")


def range_profile(df: DataFrame, ranges: dict[str, tuple[int, int]]) -> DataFrame:
    """A row per column: lo, hi, minimum, maximum, filled and status (ok, empty, outside), from one pass."""
    one = df.agg(*(x for c in ranges for x in (F.min(c).cast("long").alias(f"{c}_a"), F.max(c).cast("long").alias(f"{c}_b"), F.count(c).alias(f"{c}_n"))))
    rows = F.array(*(F.struct(F.lit(c).alias("name"), F.lit(lo).cast("long").alias("lo"), F.lit(hi).cast("long").alias("hi"), F.col(f"{c}_a").alias("minimum"), F.col(f"{c}_b").alias("maximum"), F.col(f"{c}_n").alias("filled")) for c, (lo, hi) in ranges.items()))
    status = F.when(F.col("filled") == 0, "empty").when((F.col("minimum") < F.col("lo")) | (F.col("maximum") > F.col("hi")), "outside").otherwise("ok")
    return one.select(F.explode(rows).alias("r")).select("r.*").withColumn("status", status)


def append_editions(editions: list[DataFrame]) -> DataFrame:
    """Union of editions, numbered from 1 in their order (resource_id)."""
    return reduce(DataFrame.unionByName, [e.withColumn("resource_id", F.lit(i)) for i, e in enumerate(editions, 1)])


def sorted_json(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """One row: a JSON object of all pairs in the order of the keys; the last of equal keys by value stays."""
    pairs = df.groupBy(F.col(key).alias("_k")).agg(F.max(value).alias("_v"))
    return pairs.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("_k", "_v"))))).alias(out))


def first_offenders(df: DataFrame, by: list[str], key: Column, k: int, out: str) -> DataFrame:
    """Per group the k smallest distinct keys, joined by a comma, for messages; empty where all keys are null.

    Copies go before the shuffle, and ranks above k go before the second one, so no task
    collects a group.
    """
    p = unused_prefix(df)
    distinct = df.select(*by, key.cast("string").alias(f"{p}k")).distinct()
    ranked = distinct.withColumn(f"{p}r", F.row_number().over(Window.partitionBy(*by).orderBy(F.col(f"{p}k").asc_nulls_last()))).where(F.col(f"{p}r") <= k)
    return ranked.groupBy(*by).agg(F.array_join(F.array_sort(F.collect_list(f"{p}k")), ", ").alias(out))


def upsert(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """INSERT OR REPLACE: of rows with equal keys the last one in the order stays."""
    return last_wins(rows, keys, order).drop(order)


def in_division(verses: DataFrame, texts: DataFrame, division: str, n: int, verse_key: str, text_key: str) -> DataFrame:
    """All texts of the verses in one division."""
    return verses.where(_c(division) == n).join(texts, verses[verse_key] == texts[text_key])


def summary(verses: DataFrame, division: str) -> DataFrame:
    """How many verses each division has."""
    return verses.groupBy(division).agg(F.count(F.lit(1)).alias("verses"))
