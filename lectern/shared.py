"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """What the cluster names in spark.checkpoint.dir.

    Where that is unset, a session on one machine (master local) gets a temporary folder of its
    own. On a cluster it is an error: each executor would write to its own disk.
    """
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = tempfile.mkdtemp(prefix="lectern-")
        atexit.register(shutil.rmtree, where, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


_local = threading.local()


def _scopes() -> list[str]:
    """The folders of the scopes that this thread is in."""
    if not hasattr(_local, "scopes"):
        _local.scopes = []
    return _local.scopes


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that materialise() writes within are removed at the end; results must have been written elsewhere by then."""
    _scopes().append(f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}")
    try:
        yield
    finally:
        remove(spark, _scopes().pop())


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder, wherever Spark can write."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet into the shared folder and reads it back.

    This cuts the lineage: a lost executor costs no recomputation of what stands before, and
    what depends on how rows were dealt to partitions is settled once.
    """
    spark = df.sparkSession
    path = f"{_scopes()[-1] if _scopes() else shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused_prefix(*frames: DataFrame) -> str:
    """A prefix that begins no column of the frames, whatever the case, so added columns clash with none."""
    taken, prefix = [c.lower() for f in frames for c in f.columns], "_"
    while any(c.startswith(prefix) for c in taken):
        prefix += "_"
    return prefix


def quoted(name: str) -> str:
    """A column name as it must be written where dots and backticks would mean something."""
    return "`" + name.replace("`", "``") + "`"
