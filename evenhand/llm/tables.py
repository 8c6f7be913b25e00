"""Reading the standard tables, and tables written to the shared folder."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenhand.session import ensure_checkpoint_dir


_recorders: list[list[str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def named(name: str) -> Column:
    """A column by its exact name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def shared_path(spark: SparkSession, what: str) -> str:
    """A new path below the folder that ``spark.checkpoint.dir`` names."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/evenhand-{what}-{uuid.uuid4().hex}"


def saved(df: DataFrame, what: str = "table") -> DataFrame:
    """Write the rows once as Parquet in the shared folder and read them from there.

    Later steps start from the files, so a lost executor costs no work done before them, and
    values such as row numbers or partition numbers stay as they were written.
    """
    path = shared_path(df.sparkSession, what)
    for paths in _recorders:
        paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def recorded(paths: list[str]):
    """Add the paths of the tables that ``saved`` writes within the block to a list."""
    _recorders.append(paths)
    try:
        yield
    finally:
        _recorders[:] = [x for x in _recorders if x is not paths]


def release(spark: SparkSession, paths: list[str]) -> None:
    """Delete recorded tables from which nothing reads any more."""
    while paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def keyed(docs: DataFrame) -> DataFrame:
    """The rows as a struct ``row`` with a unique ``rid``, saved so that the numbers stay.

    Columns of ``docs`` keep their names inside the struct and cannot clash with others.
    """
    rows = F.struct(*[named(c) for c in docs.columns]).alias("row")
    return saved(docs.select(F.monotonically_increasing_id().alias("rid"), rows), "rows")


def unkeyed(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The original columns of rows made by ``keyed``."""
    return rows.select(*[F.col("row").getField(c).alias(c) for c in columns])


def worker_state(name: str, make: Callable):
    """A value that a reused Python worker keeps from task to task."""
    held = sys.modules.setdefault("_evenhand_worker_state", types.ModuleType("_evenhand_worker_state"))
    if not hasattr(held, name):
        setattr(held, name, make())
    return getattr(held, name)
