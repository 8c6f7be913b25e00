"""Audit of a table before any model: sizes, missing values, group rates and gaps."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenhand.functions.expressions import group_text, nan_to_null, ratio, ref
from evenhand.operators.cells import as_list, sums_by_attribute
from evenhand.operators.lookup import pin
from evenhand.operators.roles import require_columns



def _is_missing(df: DataFrame, column: str) -> Column:
    value = ref(column)
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def dataset_shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and of columns."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"), F.lit(len(df.columns)).cast("bigint").alias("column_count")
    )


def missing_values(df: DataFrame) -> DataFrame:
    """Missing (NULL or NaN) values per column, with the row count, from a single pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(_is_missing(df, c)).alias(f"__{i}") for i, c in enumerate(df.columns)],
    )
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"),
                        F.col(f"__{i}").alias("missing"),
                        F.col("__rows").alias("row_count"),
                    )
                    for i, c in enumerate(df.columns)
                ]
            )
        )
    )


def group_distribution(df: DataFrame, attr: str) -> DataFrame:
    """Rows per non-null group, largest first."""
    return (
        df.select(group_text(df, attr).alias("group"))
        .dropna()
        .groupBy("group")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "group")
    )


def _label_sums(df: DataFrame, label: str) -> dict[str, Column]:
    y = F.when(~_is_missing(df, label), ref(label).cast("double"))
    return {"__sum": F.sum(y), "__known": F.count(y), "__rows": F.count(F.lit(1))}


def _rate() -> Column:
    return ratio(F.col("__sum"), F.col("__known"))


def target_rate(df: DataFrame, attr: str, label: str) -> DataFrame:
    """Mean of the label in each non-null group."""
    sums = sums_by_attribute(df, [attr], [], _label_sums(df, label))
    return sums.filter(F.col("group").isNotNull()).select("group", _rate().alias("rate"))


def target_rate_difference(df: DataFrame, attr: str, label: str) -> DataFrame:
    return target_rate(df, attr, label).agg((F.max("rate") - F.min("rate")).alias("rate_difference"))


def audit_dataset(df: DataFrame, attr: str, label: str | None = None) -> DataFrame:
    """The whole table audit as long rows (section, item, value).

    Sections: ``shape``, ``missing``, ``distribution`` and, with a label, ``target_rate`` and
    ``target_rate_difference``. The table is read once, by an aggregation over the groups of
    ``attr`` with the missing one; totals are sums of that group-sized result.
    """
    require_columns(df, [attr], "sensitive features")

    def entry(section: str, item: Column | str, value: Column) -> Column:
        item = F.lit(item) if isinstance(item, str) else item
        return F.struct(
            F.lit(section).alias("section"), item.alias("item"), value.cast("double").alias("value")
        )

    missing = {f"__miss_{i}": F.count_if(_is_missing(df, c)) for i, c in enumerate(df.columns)}
    sums = {"__rows": F.count(F.lit(1))} if label is None else _label_sums(df, label)
    groups = sums_by_attribute(df, [attr], [], {**sums, **missing})
    rate = F.lit(None).cast("double") if label is None else F.when(F.col("group").isNotNull(), _rate())
    sets = (
        groups.select("group", "__rows", *missing, rate.alias("__rate"))
        .groupingSets([["group"], []], "group")
        .agg(
            F.grouping_id().alias("__all"),
            *[F.sum(c).alias(c) for c in ("__rows", *missing)],
            F.max("__rate").alias("__high"),
            F.min("__rate").alias("__low"),
        )
        .filter((F.col("__all") == 1) | F.col("group").isNotNull())
    )
    per_group = [entry("distribution", F.col("group"), F.col("__rows"))]
    whole = [
        entry("shape", "rows", F.col("__rows")),
        entry("shape", "columns", F.lit(len(df.columns))),
        *[entry("missing", c, F.col(m)) for c, m in zip(df.columns, missing, strict=True)],
    ]
    if label is not None:
        per_group.append(entry("target_rate", F.col("group"), F.col("__high")))
        whole.append(entry("target_rate_difference", "max-min", F.col("__high") - F.col("__low")))
    return sets.select(F.inline(F.when(F.col("__all") == 1, F.array(*whole)).otherwise(F.array(*per_group))))


def rates_by_attribute(df: DataFrame, attrs: Iterable[str], label: str) -> DataFrame:
    """Label rate of every group of several attributes, highest rate first per attribute."""
    sums = sums_by_attribute(df, as_list(attrs), [], _label_sums(df, label))
    return (
        sums.filter(F.col("group").isNotNull())
        .select("attr", "group", _rate().alias("rate"), F.col("__rows").alias("n"))
        .orderBy("attr", F.desc("rate"), "group")
    )


def intersectional_rates(df: DataFrame, attrs: Iterable[str], label: str) -> DataFrame:
    """Label rate and size of every combination of groups without a NULL member."""
    attrs = as_list(attrs)
    known = df.dropna(subset=attrs)
    return (
        known.groupBy(*[ref(a) for a in attrs])
        .agg(*[c.alias(k) for k, c in _label_sums(df, label).items()])
        .select(*[ref(a) for a in attrs], _rate().alias("rate"), F.col("__rows").alias("n"))
    )


def rate_matrix(df: DataFrame, row_attr: str, column_attr: str, label: str, values: list | None = None) -> DataFrame:
    """Rates of two attributes as a matrix; a combination without rows stays NULL.

    With ``values`` each of them is a column. Without, the groups are not known beforehand and may be
    many: the result then has one row for each group of ``row_attr`` with a map ``rates`` from the
    groups of ``column_attr``, as text, to their rates.
    """
    rates = intersectional_rates(df, [row_attr, column_attr], label)
    if values is None:
        entry = F.struct(ref(column_attr).cast("string").alias("key"), F.col("rate").alias("value"))
        return rates.groupBy(ref(row_attr)).agg(F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("rates"))
    return rates.groupBy(ref(row_attr)).pivot(column_attr, values).agg(F.first("rate"))


def gap_summary(df: DataFrame, attrs: Iterable[str], label: str) -> DataFrame:
    """Overall rate, and the largest minus the smallest rate per attribute and combination.

    One pass reduces the rows to attribute intersections; every gap comes from that table.
    """
    attrs = as_list(attrs)
    df = nan_to_null(df.select(*[ref(c) for c in dict.fromkeys([*attrs, label])]))
    sums = _label_sums(df, label)
    finest = df.groupBy(*[ref(a) for a in attrs]).agg(sums["__sum"].alias("__sum"), sums["__known"].alias("__known"))
    sets = [(), *[(a,) for a in attrs]] + ([tuple(attrs)] if len(attrs) > 1 else [])
    names = ["overall", *attrs] + (["*".join(attrs)] if len(attrs) > 1 else [])
    full = (1 << len(attrs)) - 1
    ids = [full - sum(1 << (len(attrs) - 1 - attrs.index(a)) for a in s) for s in sets]
    grouped = finest.groupingSets([[ref(a) for a in s] for s in sets], *[ref(a) for a in attrs]).agg(
        F.grouping_id().alias("__id"), F.sum("__sum").alias("__sum"), F.sum("__known").alias("__known")
    )
    scope = F.lit(None).cast("string")
    known = F.lit(False)
    for name, gid, members in zip(names, ids, sets, strict=True):
        scope = F.when(F.col("__id") == gid, F.lit(name)).otherwise(scope)
        present = F.lit(True)
        for a in members:
            present = present & ref(a).isNotNull()
        known = known | ((F.col("__id") == gid) & present)
    rates = grouped.filter(known).select(scope.alias("scope"), _rate().alias("rate"))
    return rates.groupBy("scope").agg(
        F.count("rate").alias("n_groups"),
        F.when(F.col("scope") == "overall", F.max("rate")).alias("overall_rate"),
        F.when(F.col("scope") != "overall", F.max("rate") - F.min("rate")).alias("gap"),
    )
