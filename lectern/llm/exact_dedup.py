"""Exact deduplication: group by a 128-bit content hash, compare bytes inside the groups.

Texts are equal when they are identical after every run of ASCII white space has become
one space. The 128-bit hash (MD5) routes rows; the normalised text itself is the second
grouping key, so two texts with the same hash never share a group. Outside the groups a text is
named by both its MD5 and its SHA-256; if two different texts ever agreed in both, the job would stop.

Shuffles: one with a row per distinct text and map task (copies are combined before it,
so a group that holds a third of all rows sends a row per task). assign_groups() then
joins rows of a few dozen bytes with their groups; hot groups are broadcast (at most
2,000 can be hot) and the rest are spread by their hashes. drop_copies() shuffles the documents
once more, by id and hashes, so copies, which have different ids, are spread; rows that
agree in both are told apart within the same partitions.

Edge cases: a null text is an empty text. A null doc_id is larger than every doc_id; a
group with null ids only keeps null. Of rows with the same text and the same smallest
doc_id one is kept. No rows give no rows. Other columns are ignored by assign_groups(), whatever
their names, and returned as they are by drop_copies().
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ._shared import SPACE, column, join_groups, materialise, own_columns, sortable, unused_prefix, whole_text


def normalised(text: Column) -> Column:
    """Every run of ASCII white space as one space; lone spaces are left where they are."""
    return F.regexp_replace(text, rf"\x20[{SPACE}]+|[\x09-\x0D][{SPACE}]*", " ")


def _digest(norm: Column) -> Column:
    return F.unhex(F.md5(norm))


def _sha(norm: Column) -> Column:
    return F.unhex(F.sha2(norm, 256))


def _groups(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_digest, _sha, _keep, _size) of each distinct normalised text, written."""
    norm = docs.select(column(id_col).alias("_id"), normalised(whole_text(text_col)).alias("_norm")).withColumn("_digest", _digest(F.col("_norm")))
    texts = norm.groupBy("_digest", "_norm").agg(F.min("_id").alias("_keep"), F.count(F.lit(1)).alias("_size")).select("_digest", _sha(F.col("_norm")).alias("_sha"), "_keep", "_size")
    one = F.when(F.count(F.lit(1)) == 1, F.sum("_size")).otherwise(F.raise_error(F.lit("two texts with equal MD5 and SHA-256")).cast("long"))
    return materialise(texts.groupBy("_digest", "_sha").agg(F.min("_keep").alias("_keep"), one.alias("_size")), "groups")


def assign_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, keep_id, group_size, kept, text_sha256."""
    norm = docs.select(column(id_col).alias("_id"), normalised(whole_text(text_col)).alias("_norm"))
    rows = norm.select("_id", _digest(F.col("_norm")).alias("_digest"), _sha(F.col("_norm")).alias("_sha")).groupBy("_id", "_digest", "_sha").agg(F.count(F.lit(1)).alias("_rows"))
    joined = join_groups(materialise(rows, "rows"), _groups(docs, id_col, text_col), ["_digest", "_sha"], "_size")
    return joined.select("*", F.explode(F.sequence(F.lit(1), F.col("_rows").cast("int"))).alias("_nth")).select(
        F.col("_id").alias(id_col),
        F.col("_keep").alias("keep_id"),
        F.col("_size").alias("group_size"),
        (F.col("_id").eqNullSafe(F.col("_keep")) & (F.col("_nth") == 1)).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns."""
    p = unused_prefix(docs)
    name = lambda c: [F.coalesce(c.cast("string"), F.lit("")).alias(f"{p}id"), c.isNull().alias(f"{p}null")]
    keys = [f"{p}id", f"{p}null", f"{p}digest", f"{p}sha"]
    keep = _groups(docs, id_col, text_col).select(*name(F.col("_keep")), F.col("_digest").alias(keys[2]), F.col("_sha").alias(keys[3]))
    norm = normalised(whole_text(text_col))
    tagged = docs.select("*", *name(column(id_col)), _digest(norm).alias(keys[2]), _sha(norm).alias(keys[3]))
    first = Window.partitionBy(*keys).orderBy(*sortable(docs))  # the join has dealt the rows by the same keys
    return tagged.join(keep, keys, "left_semi").withColumn(f"{p}nth", F.row_number().over(first)).where(F.col(f"{p}nth") == 1).select(*own_columns(docs))
