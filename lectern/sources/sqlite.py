"""SQLite tables as a Spark data source, and tables as one SQLite file.

    spark.dataSource.register(SqliteSource)
    spark.read.format("sqlite_table").option("path", file).option("table", name).load()

All columns are read as strings, since SQLite checks types per value and casts belong to the
reader of the column; `_rowid` is the position in the table. A table is read in ranges of
rowids that hold equal numbers of rows, a partition each; a table without rowids in one. Files must be at a path
that all executors see. Rows come as Arrow batches.

Filters are worked out by SQLite where the option `pushdown` is true, which read_table sets
where the session allows Python sources to take filters. What is compared is what Spark would
compare: the value as text, by its bytes, whatever the column's declared type and collation, or
the rowid as a number, which also narrows the ranges that are read at all.
"""

from __future__ import annotations

import os
import sqlite3
from collections.abc import Iterator
from contextlib import closing
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as D
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import LongType, StringType, StructField, StructType

#: Rows of a partition and of an Arrow batch.
ROWS_PER_PARTITION, BATCH = 250_000, 10_000
#: Most values of an IN list that SQLite gets.
MOST_VALUES = 500
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def _open(path: str) -> sqlite3.Connection:
    if not os.path.exists(path):
        raise FileNotFoundError(path)
    return sqlite3.connect(f"{Path(path).resolve().as_uri()}?mode=ro", uri=True)


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def tables(path: str) -> list[str]:
    """User tables in the order of the catalogue."""
    with closing(_open(path)) as db:
        return [name for (name,) in db.execute("SELECT name FROM sqlite_master WHERE type = 'table' AND name NOT LIKE 'sqlite\\_%' ESCAPE '\\' ORDER BY rowid")]


def columns(path: str, table: str) -> list[str]:
    with closing(_open(path)) as db:
        return [row[1] for row in db.execute(f"PRAGMA table_info({_quoted(table)})")]


def row_count(path: str, table: str) -> int:
    with closing(_open(path)) as db:
        return db.execute(f"SELECT count(*) FROM {_quoted(table)}").fetchone()[0]


def data_table(path: str, wanted: str | None = None) -> str:
    """The wanted table, which must exist, or the one with most rows; of equal ones the first."""
    found = tables(path)
    if wanted:
        if wanted not in found:
            raise ValueError(f"{path} has no table {wanted!r}, only {found}")
        return wanted
    if not found:
        raise ValueError(f"{path} has no tables")
    return max(found, key=lambda name: row_count(path, name))


class _Range(InputPartition):
    def __init__(self, first: int | None, last: int | None):
        self.first, self.last = first, last


class _Reader(DataSourceReader):
    def __init__(self, path: str, table: str, names: list[str]):
        self.path, self.table, self.names = path, table, names
        self.conditions: list[tuple[str, tuple]] = []  # on the columns
        self.bounds: list[tuple[str, tuple]] = []  # on the rowid

    def _where(self, more: list[tuple[str, tuple]]) -> tuple[str, list]:
        parts = [*self.conditions, *self.bounds, *more]
        return (f" WHERE {' AND '.join(f'({c})' for c, _ in parts)}" if parts else ""), [v for _, values in parts for v in values]

    def _ends(self, db: sqlite3.Connection) -> tuple[int | None, int | None]:
        """The first and last rowid within bounds; two look-ups in the table's tree."""
        where = f" WHERE {' AND '.join(f'({c})' for c, _ in self.bounds)}" if self.bounds else ""
        values = [v for _, x in self.bounds for v in x]
        one = lambda f: db.execute(f"SELECT {f}(rowid) FROM {_quoted(self.table)}{where}", values).fetchone()[0]
        return one("min"), one("max")

    def partitions(self) -> list[_Range]:
        """Ranges of ROWS_PER_PARTITION rows, however far apart their rowids are; none beyond the bounds that filters set."""
        name, parts = _quoted(self.table), []
        with closing(_open(self.path)) as db:
            try:
                low, high = self._ends(db)
            except sqlite3.OperationalError:
                return [_Range(None, None)]
            while low is not None:
                after = db.execute(f"SELECT rowid FROM {name} WHERE rowid BETWEEN ? AND ? ORDER BY rowid LIMIT 1 OFFSET ?", (low, high, ROWS_PER_PARTITION)).fetchone()
                parts.append(_Range(low, after[0] - 1 if after else high))
                low = after and after[0]
        return parts or [_Range(0, -1)]

    def read(self, part: _Range) -> Iterator[pa.RecordBatch]:
        cells = ", ".join(f"CAST({_quoted(c)} AS TEXT)" for c in self.names)
        names, kinds = [*self.names, "_rowid"], [*(pa.string() for _ in self.names), pa.int64()]
        columns = ", ".join(x for x in (cells, "rowid" if part.first is not None else "0") if x)
        where, values = self._where([("rowid BETWEEN ? AND ?", (part.first, part.last))] if part.first is not None else [])
        order = " ORDER BY rowid" if part.first is not None else ""
        with closing(_open(self.path)) as db:
            rows, n = db.execute(f"SELECT {columns} FROM {_quoted(self.table)}{where}{order}", values), 0
            while got := rows.fetchmany(BATCH):
                arrays = [pa.array(x, k) for x, k in zip(zip(*got), kinds)]
                if part.first is None:  # no rowids: rows are counted
                    arrays[-1] = pa.array(range(n + 1, n + len(got) + 1), pa.int64())
                n += len(got)
                yield pa.RecordBatch.from_arrays(arrays, names=names)


class _PushingReader(_Reader):
    """A reader that takes filters over."""

    def __init__(self, path: str, table: str, names: list[str]):
        super().__init__(path, table, names)
        with closing(_open(path)) as db:
            self.utf8 = db.execute("PRAGMA encoding").fetchone()[0] == "UTF-8"  # else bytes have another order
            try:
                db.execute(f"SELECT rowid FROM {_quoted(table)} LIMIT 0")
                self.has_rowid = "rowid" not in (c.lower() for c in names)
            except sqlite3.OperationalError:
                self.has_rowid = False

    def _sql(self, f: D.Filter) -> tuple[str, tuple] | None:
        """The condition and its values, or nothing if Spark must see to it."""
        if isinstance(f, D.Not):
            inner = self._sql(f.child)
            return inner and (f"NOT ({inner[0]})", inner[1])
        if len(f.attribute) != 1:
            return None
        [name] = f.attribute
        rowid = name == "_rowid"
        if rowid and not self.has_rowid or not rowid and name not in self.names:
            return None
        cell = "rowid" if rowid else f"CAST({_quoted(name)} AS TEXT)"
        if isinstance(f, (D.IsNull, D.IsNotNull)):
            return f"{cell} IS {'NOT ' if isinstance(f, D.IsNotNull) else ''}NULL", ()
        values = tuple(f.value) if isinstance(f, D.In) else (f.value,)
        fits = lambda v: v is None or isinstance(v, int if rowid else str)
        if len(values) > MOST_VALUES or not all(map(fits, values)) or any(isinstance(v, str) and "\0" in v for v in values):
            return None
        by_bytes = cell if rowid else f"{cell} COLLATE BINARY"
        if isinstance(f, D.EqualNullSafe):
            return f"{by_bytes} IS ?", values
        if isinstance(f, D.In):
            return f"{by_bytes} IN ({', '.join('?' * len(values))})", values
        if isinstance(f, (D.StringContains, D.StringStartsWith)):
            return None if rowid else (f"instr({cell}, ?) {'= 1' if isinstance(f, D.StringStartsWith) else '> 0'}", values)
        signs = {D.EqualTo: "=", D.GreaterThan: ">", D.GreaterThanOrEqual: ">=", D.LessThan: "<", D.LessThanOrEqual: "<="}
        if type(f) not in signs or type(f) is not D.EqualTo and not (self.utf8 or rowid):
            return None
        return f"{by_bytes} {signs[type(f)]} ?", values

    def pushFilters(self, filters: list[D.Filter]) -> Iterator[D.Filter]:
        for f in filters:
            sql = self._sql(f)
            if sql is None:
                yield f
            else:
                (self.bounds if getattr(f, "attribute", None) == ("_rowid",) else self.conditions).append(sql)


class SqliteSource(DataSource):
    """Options: path; table (else that with most rows); columns (comma-separated; else all); pushdown (needs the session's consent)."""

    @classmethod
    def name(cls) -> str:
        return "sqlite_table"

    def _names(self) -> tuple[str, str, list[str]]:
        path = self.options["path"]
        table = data_table(path, self.options.get("table"))
        have = columns(path, table)
        wanted = [c for c in self.options.get("columns", "").split(",") if c] or have
        if missing := [c for c in wanted if c not in have]:
            raise ValueError(f"{path}: {table} has no column {missing}, only {have}")
        return path, table, wanted

    def schema(self) -> StructType:
        return StructType([*(StructField(c, StringType()) for c in self._names()[2]), StructField("_rowid", LongType())])

    def reader(self, schema: StructType) -> _Reader:
        return (_PushingReader if self.options.get("pushdown") == "true" else _Reader)(*self._names())


def read_table(spark: SparkSession, path: str, table: str | None = None, only: list[str] | None = None) -> DataFrame:
    spark.dataSource.register(SqliteSource)
    reader = spark.read.format("sqlite_table").option("path", path).option("pushdown", spark.conf.get(PUSHDOWN, "false").lower())
    if table:
        reader = reader.option("table", table)
    if only:
        reader = reader.option("columns", ",".join(only))
    return reader.load()


def export(frames: dict[str, DataFrame], path: str, ddl: str, order: dict[str, list[str]]) -> None:
    """Writes frames into a new file with the given tables, compacts it and puts it in place in one step.

    The result is one file for one device, so rows stream through the driver, a partition at a time.
    """
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    draft = target.with_name(f".{target.name}.draft")
    draft.unlink(missing_ok=True)
    with closing(sqlite3.connect(draft)) as db:
        db.executescript(ddl)
        for name, df in frames.items():
            marks = ", ".join("?" * len(df.columns))
            rows = (tuple(r) for r in df.orderBy(*order[name]).toLocalIterator())
            db.executemany(f"INSERT INTO {_quoted(name)} ({', '.join(map(_quoted, df.columns))}) VALUES ({marks})", rows)
        db.commit()
        if broken := db.execute("PRAGMA foreign_key_check").fetchall():
            raise ValueError(f"rows without their parents: {broken[:5]}")
        db.execute("VACUUM")
    os.replace(draft, target)
