"""Group-sized tables and the joins that attach them to rows.

A fitted table (group statistics, encodings, thresholds, boundaries) is *pinned*: when it is
proven to be small it becomes a local relation that Spark broadcasts; when it is not, it is
written to the checkpoint folder and joined by a shuffle join in which hot keys are taken out
and spread, so nothing unbounded is sent to every executor or gathered in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenhand.functions.expressions import ref
from evenhand.session import cut_lineage

BROADCAST_ROWS = 10_000
BROADCAST_STRING_BYTES = 4_096
BROADCAST_BYTES = 64 << 20
HOT_KEYS = 10_000


@dataclass(frozen=True)
class GroupTable:
    """A fitted table; ``bounded`` says that its size was checked and is small."""

    df: DataFrame
    bounded: bool
    rows: tuple[dict, ...] | None = None

    def narrow(self, *columns, where=None) -> GroupTable:
        """Filter and project; a part of a bounded table is bounded as well."""
        df = self.df if where is None else self.df.filter(where)
        return GroupTable(df.select(*columns), self.bounded)


def _strings(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def pin(df: DataFrame, max_rows: int | None = None) -> GroupTable:
    """Evaluate a group-sized DataFrame once and check its size.

    At most ``max_rows + 1`` rows reach the driver, and no string longer than
    ``BROADCAST_STRING_BYTES``: a table that breaks a bound, or is larger than
    ``BROADCAST_BYTES`` in all, is kept distributed.
    """
    max_rows = BROADCAST_ROWS if max_rows is None else max_rows
    strings = _strings(df)
    too_long = F.lit(False)
    for name in strings:
        too_long = too_long | (F.coalesce(F.octet_length(ref(name)), F.lit(0)) > BROADCAST_STRING_BYTES)
    probe = df.select(
        *[
            F.when(F.octet_length(ref(f.name)) <= BROADCAST_STRING_BYTES, ref(f.name)).alias(f.name)
            if f.name in strings
            else ref(f.name)
            for f in df.schema
        ],
        too_long.alias("__long"),
    )
    table = probe.limit(max_rows + 1).toArrow()
    small = table.num_rows <= max_rows and table.nbytes <= BROADCAST_BYTES
    if small and not any(table.column("__long").to_pylist()):
        return from_rows(df, table.drop_columns(["__long"]))
    return GroupTable(cut_lineage(df), False)


def from_rows(like: DataFrame, table: pa.Table) -> GroupTable:
    """A bounded table from an Arrow table with the schema of ``like``."""
    local = like.sparkSession.createDataFrame(table, schema=like.schema)
    return GroupTable(local, True, tuple(table.to_pylist()))


def local_table(spark, rows: list[tuple], schema: str, max_rows: int | None = None) -> GroupTable:
    """A table made on the driver from group-sized results."""
    max_rows = BROADCAST_ROWS if max_rows is None else max_rows
    fields = T.StructType.fromDDL(schema)
    data = []
    if rows:
        columns = [list(c) for c in zip(*rows, strict=True)]
        data = pa.table(dict(zip(fields.names, columns, strict=True)))
    return GroupTable(spark.createDataFrame(data, fields), len(rows) <= max_rows)


def attach(df: DataFrame, table: GroupTable, keys: list[str], spread_by: list[str] | None = None) -> DataFrame:
    """Left join ``table`` (unique on ``keys``) to rows, broadcast when it is bounded.

    ``spread_by`` are columns (all by default) whose hash spreads rows of hot keys.
    """
    if table.bounded:
        return df.join(F.broadcast(table.df), keys, "left")
    return _attach_shuffled(df, table, keys, spread_by)


def _attach_shuffled(df: DataFrame, table: GroupTable, keys: list[str], spread_by: list[str] | None) -> DataFrame:
    """Shuffle join that keeps hot keys out of the shuffle by key.

    At most ``HOT_KEYS`` keys can hold more than one ``HOT_KEYS``-th of the rows each, so their
    part of the table has a proven bound and is broadcast. Rows of those keys, and rows with a
    NULL key, then carry a hash in place of the key, so they spread over all tasks of the
    join and match nothing there.
    """
    values = [c for c in table.df.columns if c not in keys]
    counts = df.dropna(subset=keys).groupBy(*[ref(k) for k in keys]).agg(F.count(F.lit(1)).alias("__n"))
    long_key = F.lit(False)
    for k in _strings(df.select(*[ref(k) for k in keys])):
        long_key = long_key | (F.octet_length(ref(k)) > BROADCAST_STRING_BYTES)
    heavy = counts.filter((F.col("__n") * HOT_KEYS > F.lit(df.count())) & ~long_key).select(*keys)
    hot = pin(heavy.join(table.df, keys, "left").withColumn("__hot", F.lit(True)), HOT_KEYS)
    kept = {v: f"__hot_{i}" for i, v in enumerate(values)}
    marked = df.join(F.broadcast(hot.df.withColumnsRenamed(kept)), keys, "left")
    missing = F.lit(False)
    for k in keys:
        missing = missing | ref(k).isNull()
    settled = F.coalesce(F.col("__hot"), F.lit(False)) | missing
    spread = F.xxhash64(*[ref(c) for c in (spread_by or df.columns)])
    # the first key is tagged, so that a hash can never equal a key
    placed = marked.withColumn(
        "__key_0",
        F.when(settled, F.concat(F.lit("spread:"), spread.cast("string"))).otherwise(
            F.concat(F.lit("key:"), ref(keys[0]).cast("string"))
        ),
    )
    right = table.df.select(
        F.concat(F.lit("key:"), ref(keys[0]).cast("string")).alias("__right_0"),
        *[ref(k).alias(f"__right_{i}") for i, k in enumerate(keys) if i > 0],
        *[ref(v).alias(f"__cold_{i}") for i, v in enumerate(values)],
    )
    on = F.col("__key_0") == F.col("__right_0")
    for i, k in enumerate(keys):
        if i > 0:
            on = on & (ref(k) == F.col(f"__right_{i}"))
    joined = placed.join(right, on, "left")
    return joined.select(
        *[ref(c) for c in df.columns],
        *[
            F.when(F.col("__hot"), F.col(kept[v])).otherwise(F.col(f"__cold_{i}")).alias(v)
            for i, v in enumerate(values)
        ],
    )
