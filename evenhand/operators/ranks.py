"""Exact order statistics per group without sorting or collecting a group.

A group may hold a third of all rows, so neither a window over it nor an exact percentile
(which gathers its values in one task) is used. Instead each pass counts rows in equal-width
buckets of the interval that still contains the wanted rank, with map-side aggregation, and
keeps the bucket in which the running count reaches the rank. An interval shrinks by a factor
of ``buckets`` per pass and to the observed minimum and maximum, until one value is left. Where
an interval spans magnitudes, its buckets are of equal width in the logarithm, so the number of
passes is bounded for any doubles: two in the logarithm and six for 53 bits within a magnitude.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenhand.functions.expressions import ref
from evenhand.operators.lookup import GroupTable, attach, pin

BUCKETS = 1_024
MAX_PASSES = 16

#: Buckets for each doubling of a value in a first count, which knows no interval yet.
PREFIXES = 256
PREFIX_INFINITY = 1 << 20

# beyond the natural logarithms of the least and the largest double
LOG_FLOOR, LOG_INFINITY = 745.5, 711.0


def kth_smallest(
    df: DataFrame,
    keys: Iterable[str],
    value: str,
    wanted: GroupTable,
    rank_names: Iterable[str] = ("rank",),
    buckets: int = BUCKETS,
) -> GroupTable:
    """Locate the ``__rank``-th smallest value of each key.

    ``wanted`` has the key columns, a name column per entry of ``rank_names``, ``__rank`` and the
    smallest and largest value of the key as ``__lo`` and ``__hi``. The result has the key and
    name columns, ``at`` (the value), ``below`` and ``upto`` (rows below it, and up to and
    including it) and ``above`` (the next larger value, NULL when there is none). NULL and NaN are
    no values and have no rank; infinities are the least and the largest one.
    """
    keys, names = list(keys), list(rank_names)
    ids = [*keys, *names]
    state = wanted.narrow(
        *ids,
        "__rank",
        F.col("__lo").cast("double").alias("__lo"),
        F.col("__hi").cast("double").alias("__hi"),
        F.lit(0).cast("bigint").alias("__below"),
        F.lit(None).cast("bigint").alias("__upto"),
        F.lit(None).cast("double").alias("__above"),
    )
    number = F.nanvl(ref(value).cast("double"), F.lit(None).cast("double"))
    rows = df.select(*[ref(k) for k in keys], number.alias("__v"))
    finished, passes = False, 0
    while not finished:
        if passes == MAX_PASSES:
            raise RuntimeError(f"{value!r}: ranks are not found after {passes} passes")
        state = pin(_narrow(rows, keys, ids, state, buckets, passes))
        passes += 1
        if state.bounded:
            finished = all(r["__upto"] is not None for r in state.rows)
        else:
            finished = state.df.filter("__upto is null").isEmpty()
    return state.narrow(
        *ids,
        F.col("__lo").alias("at"),
        F.col("__below").alias("below"),
        F.col("__upto").alias("upto"),
        F.col("__above").alias("above"),
    )


def prefix(v: Column) -> Column:
    """A whole number that never falls as the value rises: its sign, and its binary logarithm in steps of 1 / ``PREFIXES``.

    NULL and NaN have none. At most about half a million numbers exist, a few thousand for scores.
    """
    size = F.floor((F.log2(F.abs(v)) + F.lit(1075.0)) * F.lit(float(PREFIXES))).cast("int") + 1
    size = F.when(F.abs(v) == float("inf"), F.lit(PREFIX_INFINITY)).otherwise(size)
    return F.when(v.isNull() | F.isnan(v), F.lit(None).cast("int")).when(v == 0, F.lit(0)).otherwise(F.signum(v).cast("int") * size)


def close_in(rows: DataFrame, attrs: dict[str, Column], value: str, state: GroupTable, kept: list[str]) -> tuple[GroupTable, int]:
    """Narrow intervals of ranks of several attributes until each is one value; also the number of passes.

    ``attrs`` gives each attribute's group as text. ``state`` is unique on (attr, group) and has ``__rank`` and the interval, in the
    form of ``kth_smallest``; ``kept`` are its further columns. A pass reads ``rows`` once whatever the number of
    attributes: a row outside all intervals of its groups is left out before anything is multiplied.
    """
    number = F.nanvl(ref(value).cast("double"), F.lit(None).cast("double"))
    names = list(attrs)
    base = rows.select(number.alias("__v"), *[c.alias(f"__g{i}") for i, c in enumerate(attrs.values())])
    core = ["attr", "group", "__rank", "__lo", "__hi", "__below", "__upto", "__above"]
    extra = state.narrow("attr", "group", *kept)
    state, passes = state.narrow(*core), 0
    while not _all_found(state):
        if passes == MAX_PASSES:
            raise RuntimeError(f"{value!r}: ranks are not found after {passes} passes")
        held, inside = base, []
        for i, attr in enumerate(names):
            still = (F.col("attr") == attr) & F.col("__upto").isNull()
            table = state.narrow(F.col("group").alias(f"__g{i}"), F.col("__lo").alias(f"__lo{i}"), F.col("__hi").alias(f"__hi{i}"), where=still)
            held = attach(held, table, [f"__g{i}"], [f"__g{i}", "__v"])
            fits = F.coalesce(F.col("__v").between(F.col(f"__lo{i}"), F.col(f"__hi{i}")), F.lit(False))
            inside.append(F.when(fits, F.struct(F.lit(attr).alias("attr"), F.col(f"__g{i}").alias("group"))))
        cells = held.select("__v", F.filter(F.array(*inside), lambda x: x.isNotNull()).alias("__in")).filter(F.size("__in") > 0)
        near = cells.select("__v", F.explode("__in").alias("__p")).select("__p.attr", "__p.group", "__v")
        passes += 1
        state = pin(_narrow(near, ["attr", "group"], ["attr", "group"], state, BUCKETS, passes))
    return GroupTable(attach(state.df, extra, ["attr", "group"]), state.bounded), passes


def _all_found(state: GroupTable) -> bool:
    if state.bounded:
        return all(r["__upto"] is not None for r in state.rows) if state.rows is not None else state.df.filter("__upto is null").isEmpty()
    return state.df.filter("__upto is null").isEmpty()


def _magnitude(v: Column) -> Column:
    """A finite number that grows with the value as its logarithm does, on both sides of 0."""
    size = F.when(F.abs(v) == float("inf"), F.lit(LOG_INFINITY)).otherwise(F.log(F.abs(v)))
    return F.when(v == 0, F.lit(0.0)).otherwise(F.signum(v) * (size + LOG_FLOOR))


def _narrow(
    rows: DataFrame, keys: list[str], ids: list[str], state: GroupTable, buckets: int, passes: int
) -> DataFrame:
    open_state = state.narrow("*", where="__upto is null")
    named = [c for c in ids if c not in keys]
    if named:
        # several wanted ranks of a key share the pass: one row per key with an array of intervals
        cells = F.collect_list(F.struct(*named, "__lo", "__hi")).alias("__open")
        intervals = GroupTable(open_state.df.groupBy(*keys).agg(cells), open_state.bounded)
    else:
        intervals = open_state.narrow(*keys, F.array(F.struct("__lo", "__hi")).alias("__open"))
    held = attach(rows.filter(F.col("__v").isNotNull()), intervals, keys, [*keys, "__v"])
    if named:
        held = held.filter(F.col("__open").isNotNull()).withColumn("__i", F.explode("__open"))
    else:
        held = held.withColumn("__i", F.col("__open")[0])
    lo, hi, v = F.col("__i.__lo"), F.col("__i.__hi"), F.col("__v")
    least, most = F.least(F.abs(lo), F.abs(hi)), F.greatest(F.abs(lo), F.abs(hi))
    # scores often fill their interval evenly, so the first pass is tried without logarithms
    even = (most < 1e300) if passes == 0 else (F.signum(lo) == F.signum(hi)) & (most <= least * buckets)
    part = F.when(even, (v - lo) / (hi - lo)).otherwise((_magnitude(v) - _magnitude(lo)) / (_magnitude(hi) - _magnitude(lo)))
    bucket = F.when(hi > lo, F.floor(part * F.lit(float(buckets)))).otherwise(F.lit(0)).cast("int")
    inside = held.filter((F.col("__v") >= F.col("__i.__lo")) & (F.col("__v") <= F.col("__i.__hi"))).select(
        *[ref(k) for k in keys],
        *[F.col(f"__i.{c}").alias(c) for c in named],
        "__v",
        F.least(bucket, F.lit(buckets - 1)).alias("__bucket"),
    )
    counts = inside.groupBy(*[ref(c) for c in ids], "__bucket").agg(
        F.count(F.lit(1)).alias("__n"), F.min("__v").alias("__min"), F.max("__v").alias("__max")
    )
    # at most ``buckets`` rows per key in this window
    along = Window.partitionBy(*[ref(c) for c in ids]).orderBy("__bucket")
    running = counts.select(
        *[ref(c) for c in ids],
        "__n",
        "__min",
        "__max",
        F.sum("__n").over(along.rowsBetween(Window.unboundedPreceding, 0)).alias("__cum"),
        F.lead("__min").over(along).alias("__next"),
    )
    found = (
        attach(running, GroupTable(state.df.withColumnsRenamed({"__above": "__old_above"}), state.bounded), ids)
        .withColumn("__need", F.col("__rank") - F.col("__below"))
        .filter((F.col("__cum") >= F.col("__need")) & (F.col("__cum") - F.col("__n") < F.col("__need")))
    )
    single = F.col("__min") == F.col("__max")
    narrowed = found.select(
        *[ref(c) for c in ids],
        "__rank",
        F.col("__min").alias("__lo"),
        F.col("__max").alias("__hi"),
        (F.col("__below") + F.col("__cum") - F.col("__n")).alias("__below"),
        F.when(single, F.col("__below") + F.col("__cum")).alias("__upto"),
        F.coalesce("__next", "__old_above").alias("__above"),
    )
    return narrowed.unionByName(state.df.filter("__upto is not null"))
