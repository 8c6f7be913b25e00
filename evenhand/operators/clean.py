"""Cleaning and derivation: ordered fill, clipping, per-group factors, a logistic score."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenhand.functions.expressions import clip_between, group_text, logistic, ref
from evenhand.operators.cells import as_list
from evenhand.operators.lookup import attach, local_table, pin
from evenhand.session import cut_lineage

FILL_ROWS_PER_TASK = 4_000_000


def clip(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    """Limit a column to bounds, in its own type; NULL stays NULL."""
    dtype = df.schema[column].dataType
    return df.withColumn(column, clip_between(ref(column), low, high).cast(dtype))


def scale_by_group(
    df: DataFrame, column: str, attr: str, factors: Mapping | DataFrame, spread_by: list[str] | None = None
) -> DataFrame:
    """Multiply a column by the factor of the row's group; groups without a factor keep theirs.

    ``factors`` is a mapping, or a DataFrame with the columns ``group`` and ``factor``.
    """
    if isinstance(factors, Mapping):
        rows = [(str(k), float(v)) for k, v in factors.items()]
        table = local_table(df.sparkSession, rows, "__group string, __factor double")
    else:
        table = pin(
            factors.select(
                F.col("group").cast("string").alias("__group"), F.col("factor").cast("double").alias("__factor")
            )
        )
    keyed = df.withColumn("__group", group_text(df, attr))
    joined = attach(keyed, table, ["__group"], spread_by)
    scaled = ref(column).cast("double") * F.coalesce(F.col("__factor"), F.lit(1.0))
    return joined.withColumn(column, scaled).select(*[ref(c) for c in df.columns])


def logistic_score(
    df: DataFrame,
    terms: Mapping[str, float],
    intercept: float = 0.0,
    centers: Mapping[str, float | str] | None = None,
    indicators: Iterable[tuple[Mapping[str, object], float]] = (),
    out: str = "score",
) -> DataFrame:
    """Add ``1 / (1 + exp(-z))`` of a linear score.

    ``centers`` subtracts a constant, or the column mean with the value ``"mean"`` (a scalar
    subquery). ``indicators`` are pairs of column values that must all hold and their weight.
    """
    centers = dict(centers or {})
    means = [c for c, v in centers.items() if v == "mean"]
    z: Column = F.lit(float(intercept))
    for column, weight in terms.items():
        value = ref(column).cast("double")
        if column in means:
            value = value - df.agg(F.avg(ref(column))).scalar()
        elif column in centers:
            value = value - F.lit(float(centers[column]))
        z = z + F.lit(float(weight)) * value
    for condition, weight in indicators:
        holds = F.lit(True)
        for column, wanted in condition.items():
            holds = holds & F.coalesce(ref(column) == F.lit(wanted), F.lit(False))
        z = z + F.when(holds, F.lit(float(weight))).otherwise(F.lit(0.0))
    return df.withColumn(out, logistic(z))


def ffill_bfill(
    df: DataFrame,
    columns: Iterable[str],
    order_by: Iterable[str],
    partition_by: Iterable[str] = (),
    rows_per_task: int = FILL_ROWS_PER_TASK,
) -> DataFrame:
    """Fill NULLs with the last earlier value, and with the first later one before that.

    ``order_by`` must order the rows of a partition completely. A table of more than
    ``rows_per_task`` rows is cut into ranges of (partition, order), as many as its rows need, so
    that neither a hot key nor equal values of the first order column fill a task. Each range is
    filled on its own and takes what is still missing from the nearest range of its key that has
    a value: the result is that of one window over the whole key. A NULL key is a key of its own.
    """
    columns, order, keys = as_list(columns), as_list(order_by), as_list(partition_by)
    names = [f"__k{i}" for i in range(len(keys))] or ["__k0"]
    own = [ref(k).alias(n) for k, n in zip(keys, names, strict=True)] if keys else [F.lit(0).alias("__k0")]
    keyed = df.select("*", *own)
    pieces = -(-df.count() // rows_per_task)
    if pieces <= 1:
        filled = _fill_window(keyed, columns, order, names)
    else:
        filled = _fill_ranges(keyed, columns, order, names, pieces)
    return filled.select(*[ref(c) for c in df.columns])


def _missing_aware(df: DataFrame, column: str) -> Column:
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return F.nanvl(ref(column), F.lit(None).cast(df.schema[column].dataType))
    return ref(column)


def _fill_parts(df: DataFrame, columns: list[str], order: list[str], keys: list[str]) -> dict[str, tuple]:
    """Per column the last value so far, and the first value of the whole partition.

    A row without an earlier value has no value before it at all, so the next later one is the
    first of the partition. A frame that ends at the last row and starts at the current one
    would be evaluated anew for every row; this one is evaluated once, in the same sort.
    """
    window = Window.partitionBy(*keys).orderBy(*[ref(c) for c in order])
    so_far = window.rowsBetween(Window.unboundedPreceding, 0)
    whole = window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    parts = {}
    for c in columns:
        value = _missing_aware(df, c)
        parts[c] = (
            F.last(value, ignorenulls=True).over(so_far),
            F.first(value, ignorenulls=True).over(whole),
        )
    return parts


def _fill_window(df: DataFrame, columns: list[str], order: list[str], keys: list[str]) -> DataFrame:
    parts = _fill_parts(df, columns, order, keys)
    return df.withColumns({c: F.coalesce(*both) for c, both in parts.items()})


def _fill_ranges(df: DataFrame, columns: list[str], order: list[str], keys: list[str], pieces: int) -> DataFrame:
    # the ranges are sampled, so they are written down before they are used twice
    by_order = [*[ref(k) for k in keys], *[ref(o) for o in order]]
    rows = cut_lineage(df.repartitionByRange(pieces, *by_order).withColumn("__range", F.spark_partition_id()))
    place = F.struct(*[ref(o) for o in order])
    ends = {}
    for i, c in enumerate(columns):
        value = _missing_aware(df, c)
        ends[f"__last{i}"] = F.max_by(value, F.when(value.isNotNull(), place))
        ends[f"__first{i}"] = F.min_by(value, F.when(value.isNotNull(), place))
    held = rows.groupBy(*keys, "__range").agg(*[e.alias(n) for n, e in ends.items()])
    # one row for each key and range it reaches: at most as many rows a key as there are ranges
    along = Window.partitionBy(*keys).orderBy("__range")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carried = held.select(
        *[F.col(k).alias(f"__of{k}") for k in keys],
        F.col("__range").alias("__at"),
        *[F.last(f"__last{i}", ignorenulls=True).over(before).alias(f"__before{i}") for i in range(len(columns))],
        *[F.first(f"__first{i}", ignorenulls=True).over(whole).alias(f"__after{i}") for i in range(len(columns))],
    )
    parts = _fill_parts(rows, columns, order, [*keys, "__range"])
    here = {f"__so_far{i}": so_far for i, (so_far, _) in enumerate(parts.values())}
    on = F.col("__range") == F.col("__at")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__of{k}"))
    filled = rows.withColumns(here).join(carried, on)
    # the first value of a range is that of the key where nothing precedes the range
    return filled.withColumns(
        {c: F.coalesce(f"__so_far{i}", f"__before{i}", f"__after{i}") for i, c in enumerate(columns)}
    )
