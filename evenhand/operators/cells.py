"""Confusion cells: the small table every prediction metric is computed from."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenhand.functions.expressions import group_text, ref


def as_list(columns: str | Iterable[str]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def per_attribute(df: DataFrame, attrs: list[str]) -> Column:
    """One (attr, group) pair per sensitive column; groups compare as strings."""
    return F.explode(
        F.array(*[F.struct(F.lit(a).alias("attr"), group_text(df, a).alias("group")) for a in attrs])
    )


def sums_by_attribute(df: DataFrame, attrs: list[str], by: list[str], sums: dict[str, Column]) -> DataFrame:
    """Algebraic sums per (by, attr, group), NULL groups included.

    Rows are first reduced to the intersections of the attributes, with map-side partial
    aggregation, so only the small result is repeated once per attribute.
    """
    finest = df.groupBy(*[ref(c) for c in dict.fromkeys([*by, *attrs])]).agg(
        *[c.alias(name) for name, c in sums.items()]
    )
    if len(attrs) == 1:
        return finest.select(
            *[ref(c) for c in by],
            F.lit(attrs[0]).alias("attr"),
            group_text(df, attrs[0]).alias("group"),
            *sums,
        )
    pairs = finest.select(*[ref(c) for c in by], *sums, per_attribute(df, attrs).alias("__pair"))
    return (
        pairs.select(*[ref(c) for c in by], "__pair.attr", "__pair.group", *sums)
        .groupBy(*[ref(c) for c in by], "attr", "group")
        .agg(*[F.sum(name).alias(name) for name in sums])
    )


def label_value(df: DataFrame, column: str) -> Column:
    """A label as it is; booleans and NaN as numbers and NULL."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.BooleanType):
        return ref(column).cast("int")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.nanvl(ref(column), F.lit(None).cast(kind))
    return ref(column)


def confusion_cells(df: DataFrame, y: str, yhat: str, attrs, by: Iterable[str] = ()) -> DataFrame:
    """Row counts per (attribute, group, true label, predicted label), whatever the labels are.

    Rows without a label or prediction have no cell. The NULL group is kept: it counts in the
    performance metrics and is left out of the group metrics.
    """
    attrs, by = as_list(attrs), list(by)
    known = df.filter(ref(y).isNotNull() & ref(yhat).isNotNull()).select(
        *[ref(c) for c in dict.fromkeys([*by, *attrs])],
        label_value(df, y).alias("y_true"),
        label_value(df, yhat).alias("y_pred"),
    )
    return sums_by_attribute(known, attrs, [*by, "y_true", "y_pred"], {"n": F.count(F.lit(1))}).select(
        *[ref(c) for c in by], "attr", "group", "y_true", "y_pred", "n"
    )


def group_counts(df: DataFrame, y: str, yhat: str, attrs, by: Iterable[str] = ()) -> DataFrame:
    """The four cells of each group side by side: tp, fp, fn, tn."""
    attrs, by = as_list(attrs), list(by)
    y_true, y_pred = label_value(df, y), label_value(df, yhat)
    known = df.filter(y_true.isNotNull() & y_pred.isNotNull())
    true, pred = y_true == 1, y_pred == 1
    counts = sums_by_attribute(
        known,
        attrs,
        by,
        {
            "__other": F.count_if(~y_true.isin(0, 1) | ~y_pred.isin(0, 1)),
            "tp": F.count_if(true & pred),
            "fp": F.count_if(~true & pred),
            "fn": F.count_if(true & ~pred),
            "tn": F.count_if(~true & ~pred),
        },
    )
    return counts.select(
        *[ref(c) for c in by], "attr", "group", only_binary(F.col("__other"), F.col("tp")).alias("tp"), "fp", "fn", "tn"
    )


def only_binary(other: Column, value: Column) -> Column:
    """The value, or an error if rows have labels or predictions other than 0 and 1."""
    message = F.concat(other.cast("string"), F.lit(" rows have a label or prediction that is neither 0 nor 1"))
    return F.when(other > 0, F.raise_error(message).cast("bigint")).otherwise(value)


def counts_from_cells(cells: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """The same four counts from a confusion-cell table."""
    n, true, pred = F.col("n"), F.col("y_true") == 1, F.col("y_pred") == 1

    def total(cond: Column) -> Column:
        return F.sum(F.when(cond, n).otherwise(F.lit(0)))

    other = ~F.col("y_true").isin(0, 1) | ~F.col("y_pred").isin(0, 1)
    return cells.groupBy(*[ref(c) for c in by], "attr", "group").agg(
        only_binary(total(other), total(true & pred)).alias("tp"),
        total(~true & pred).alias("fp"),
        total(true & ~pred).alias("fn"),
        total(~true & ~pred).alias("tn"),
    )
