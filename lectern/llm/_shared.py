"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lectern.shared import materialise, quoted, shared_dir, unused_prefix

__all__ = ["SPACE", "column", "join_groups", "materialise", "own_columns", "quoted", "shared_dir", "sortable", "unused_prefix", "whole_text"]

#: ASCII white space as the operators understand it: space and U+0009 to U+000D.
SPACE = r"\x20\x09-\x0D"


def column(name: str) -> Column:
    return F.col(quoted(name))


def whole_text(name: str = "text") -> Column:
    """The text column as a string; null counts as empty."""
    return F.coalesce(column(name).cast("string"), F.lit(""))


def own_columns(df: DataFrame) -> list[Column]:
    """The columns of df, whatever their names."""
    return [column(c) for c in df.columns]


def sortable(df: DataFrame) -> list[Column]:
    """The columns of df that have an order."""
    return [column(f.name) for f in df.schema.fields if "map<" not in (kind := f.dataType.simpleString()) and "variant" not in kind]


#: A group with this share of all rows or more is hot; so there are at most so many hot groups.
HOT_GROUPS = 2000


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str) -> DataFrame:
    """Inner join of rows with groups, which has one row per value of the keys and, in size, how many rows have it.

    Both are written tables, as they are read more than once. Rows of hot groups meet their
    groups by broadcast and are not shuffled; no other group has a share that matters.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    hot = F.col(size) * HOT_GROUPS >= total
    few = F.broadcast(groups.where(hot))  # at most HOT_GROUPS rows, since their sizes add up to total at most
    rest = rows.join(F.broadcast(groups.where(hot).select(*keys)), keys, "left_anti").join(groups.where(~hot), keys)
    return rows.join(few, keys).unionByName(rest)
