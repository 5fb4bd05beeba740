"""Stored Parquet tables: batches merged by key, and several tables put in place in one step."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.operators import relational as R
from lectern.shared import materialise, quoted, remove, unused_prefix

#: Parts of a table that merge_into makes; a row's part is a hash of its key.
PARTS, PART = 64, "part"


def _part(keys: list[str], parts: int):
    return F.pmod(F.xxhash64(*(F.col(quoted(k)) for k in keys)), F.lit(parts)).cast("int")


def read_merged(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of a table that merge_into wrote; none if there is no table yet."""
    return _stored(spark, path, schema).drop(PART)


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    whole = f"{schema}, {PART} int"
    return spark.read.schema(whole).parquet(path) if _exists(spark, path) else spark.createDataFrame([], whole)


def merge_into(path: str, batch: DataFrame, keys: list[str], order: str, replace: bool = True, parts: int = PARTS) -> None:
    """Merges a batch into the table at path: INSERT OR REPLACE by key, or, with replace false, INSERT OR IGNORE.

    Of rows of the batch with equal keys the last (replace) or first one in the order counts; the
    order column is not stored. Stored rows of a key give way, or stay. The table lies in
    parts by a hash of the key, so only the parts that the batch has keys of are read and written
    again, each in one step; a batch that is merged again, also after a failure half way,
    leaves the same rows. Null keys are equal to each other. Empty batches change nothing.
    The number of parts belongs to the table: give the same one each time.
    """
    spark, p = batch.sparkSession, unused_prefix(batch)
    if PART in batch.columns:
        raise ValueError(f"column {PART!r} is the table's own")
    new = (R.last_wins if replace else R.first_wins)(batch, keys, order).drop(order)
    columns = [quoted(c) for c in new.columns]
    new = materialise(new.withColumn(PART, _part(keys, parts)), "batch")
    touched = [r[PART] for r in new.select(PART).distinct().collect()]  # at most `parts` numbers
    if not touched:
        return
    schema = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in new.drop(PART).schema.fields)
    stored = _stored(spark, path, schema).where(F.col(PART).isin(touched))
    both = new.withColumn(f"{p}age", F.lit(1)).unionByName(stored.select(*columns, PART).withColumn(f"{p}age", F.lit(0)))
    rows = (R.last_wins if replace else R.first_wins)(both, keys, f"{p}age").drop(f"{p}age")
    # written first, as the parts it comes from are replaced
    materialise(rows, "merged").select(*columns, PART).repartition(PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


#: Bits of each column that a clustered order looks at.
BITS = 10


def curve(df: DataFrame, columns: tuple[str, ...], bits: int = BITS):
    """The place of a row along a Z-shaped curve through the columns' values, from one pass over their extremes.

    Values are scaled to `bits` bits between each column's smallest and largest value and their bits
    are interleaved, the first column's first. Nulls come first.
    """
    ends = df.agg(*(f(F.col(quoted(c)).cast("double")).alias(f"{name}{i}") for i, c in enumerate(columns) for f, name in ((F.min, "a"), (F.max, "z")))).first()
    scaled = []
    for i, c in enumerate(columns):
        low, high = ends[f"a{i}"], ends[f"z{i}"]
        width = (high - low) or 1.0 if low is not None else 1.0
        scaled.append(F.coalesce(F.floor((F.col(quoted(c)).cast("double") - F.lit(low or 0.0)) * F.lit(((1 << bits) - 1) / width)), F.lit(0)).cast("long"))
    place = F.lit(0).cast("long")
    for b in range(bits):
        for i, x in enumerate(scaled):
            place = place + F.shiftleft(F.shiftright(x, b).bitwiseAND(F.lit(1)), b * len(columns) + len(columns) - 1 - i)
    return place


def clustered(df: DataFrame, columns: tuple[str, ...], order: list[str]) -> DataFrame:
    """df in ranges along the curve through `columns`, so the statistics of files and row groups let a look-up by any of them skip most of a table."""
    if len(columns) * BITS > 62:
        raise ValueError("at most 6 columns")
    p = unused_prefix(df)
    placed = df.withColumn(f"{p}z", curve(df, columns))
    by = [f"{p}z", *map(quoted, order)]
    return placed.repartitionByRange(*by).sortWithinPartitions(*by).drop(f"{p}z")


def write_together(frames: dict[str, DataFrame], folder: str, order: dict[str, list[str]], cluster: dict[str, tuple[str, ...]] | None = None, group_bytes: int | None = None) -> None:
    """A folder per table within `folder`, sorted as it is looked up. All are written beside it first, then put in place by one rename.

    Tables named in cluster are laid out for look-ups by several columns (clustered); group_bytes is the size of a row group.
    """
    [spark] = {df.sparkSession for df in frames.values()}
    draft = f"{folder.rstrip('/')}.draft-{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    options = {"parquet.block.size": str(group_bytes), "parquet.block.row.check.min": "10"} if group_bytes else {}
    try:
        for name, df in frames.items():
            columns = (cluster or {}).get(name)
            laid = clustered(df, columns, order[name]) if columns else df.orderBy(*order[name])
            laid.write.options(**options).parquet(f"{draft}/{name}")
        remove(spark, folder)
        if not path(draft).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).rename(path(draft), path(folder)):
            raise OSError(f"could not put {folder} in place")
    finally:
        remove(spark, draft)
