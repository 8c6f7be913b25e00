"""Running sums over rows in order, within keys of any size.

A window over a key would put all its rows into one task. Here rows are cut into ranges of
(key, order), sums of whole ranges are added up first, and a window only runs within a range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evenhand.llm.tables import saved

ROWS_PER_RANGE = 200_000


def running_sum(df: DataFrame, by: list[str], order: list[str], value: str, name: str, what: str = "ranges") -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows of the same ``by`` that come before.

    ``df`` should be cheap to read again (a saved table): the ranges are sampled from it.
    Ties in ``order`` are put in any order; give enough columns to make it total, since rows
    alike in all of them also stay in one range. NULLs in ``by`` form a key of their own, NULLs
    in ``order`` come first, and a NULL ``value`` counts as 0.
    """
    spark = df.sparkSession
    floor = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(floor, -(-df.count() // ROWS_PER_RANGE))
    ranged = saved(
        df.repartitionByRange(ranges, *[F.col(c) for c in [*by, *order]]).withColumn("__range", F.spark_partition_id()),
        what,
    )
    amount = F.coalesce(F.col(value), F.lit(0))
    keys = [F.col(c).alias(f"__by_{i}") for i, c in enumerate(by)]
    sums = ranged.groupBy(*keys, F.col("__range").alias("__at")).agg(F.sum(amount).alias("__sum"))
    # one row for each key and range it touches: at most as many rows a key as there are ranges
    earlier = Window.partitionBy(*[k for k in sums.columns if k.startswith("__by_")]).orderBy("__at")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("__before", F.coalesce(F.sum("__sum").over(earlier), F.lit(0))).drop("__sum")
    within = Window.partitionBy(*by, "__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = ranged.withColumn("__inside", F.coalesce(F.sum(amount).over(within), F.lit(0)))
    on = F.col("__range") == F.col("__at")
    for i, c in enumerate(by):
        on = on & F.col(c).eqNullSafe(F.col(f"__by_{i}"))
    return inside.join(offsets, on).select(
        *df.columns, (F.col("__inside") + F.col("__before")).cast("long").alias(name)
    )
