"""Shards by jump consistent hashing.

The key and the number of shards decide; there is no ring and no table of assignments. One shard
more takes its share of rows from all others and moves none between them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenhand.llm.running import running_sum
from evenhand.llm.tables import named, saved

LCG = 2862933555777941757


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key. All keys jump together until none lands below ``shards``."""
    state = keys.astype(np.uint64)
    shard = np.zeros(len(state), np.int64)
    target = np.zeros(len(state), np.int64)
    moving = np.arange(len(state))
    while len(moving):
        shard[moving] = target[moving]
        state[moving] = state[moving] * np.uint64(LCG) + np.uint64(1)
        spread = ((state[moving] >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
        target[moving] = ((shard[moving] + 1) * (float(1 << 31) / spread)).astype(np.int64)
        moving = moving[target[moving] < shards]
    return shard


def jump_column(key: Column, shards: int) -> Column:
    """The shard as an expression; a NULL key counts as 0."""
    if shards < 1:
        raise ValueError("there must be at least one shard")

    @F.pandas_udf("int")
    def place(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(np.int64), shards).astype(np.int32))

    return place(F.coalesce(key.cast("long"), F.lit(0).cast("long")))


def assign_shards(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row: id, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is the number of UTF-8 bytes of the text and 16 more, ``grown_shard`` the shard among
    one more. ``slot`` counts the rows of a shard from 0 by (id, text_crc32, size), NULL ids first.
    NULL text is the empty text; a NULL id goes where 0 goes; rows alike share nothing but their
    shard. Other columns are not read.
    """
    text = F.coalesce(named(text_col).cast("string"), F.lit(""))
    sized = docs.select(
        named(id_col).alias("id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    placed = saved(
        sized.select(
            "*",
            jump_column(F.col("id"), shards).alias("shard"),
            jump_column(F.col("id"), shards + 1).alias("grown_shard"),
            F.monotonically_increasing_id().alias("row"),
            F.lit(1).alias("one"),
        ),
        "placed",
    )
    slots = running_sum(placed, ["shard"], ["id", "text_crc32", "size", "row"], "one", "slot", "slots")
    return slots.select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )
