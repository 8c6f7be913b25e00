"""Column roles, resolved from the schema on the driver without reading data."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenhand.functions.expressions import ref


@dataclass(frozen=True)
class Roles:
    features: tuple[str, ...]
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    sensitive: tuple[str, ...]
    label: str | None = None


def split_types(schema: T.StructType, columns: Iterable[str] | None = None) -> tuple[list[str], list[str]]:
    """Numeric and categorical columns in schema order.

    Strings and booleans are categorical; dates, times and nested types are refused because
    no operator of the library is defined for them.
    """
    wanted = None if columns is None else set(columns)
    numeric, categorical, refused = [], [], []
    for field in schema:
        if wanted is not None and field.name not in wanted:
            continue
        if isinstance(field.dataType, T.NumericType):
            numeric.append(field.name)
        elif isinstance(field.dataType, (T.StringType, T.BooleanType)):
            categorical.append(field.name)
        else:
            refused.append(f"{field.name}: {field.dataType.simpleString()}")
    if refused:
        raise ValueError("Columns must be numeric, string or boolean; cast or drop " + ", ".join(refused))
    return numeric, categorical


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "columns") -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"Missing {what}: {missing}")


def resolve_roles(
    df: DataFrame,
    sensitive: Iterable[str],
    label: str | None = None,
    keep: Iterable[str] = (),
) -> Roles:
    """Features are all columns that are neither sensitive, nor the label, nor in ``keep``."""
    sensitive = list(sensitive)
    if not sensitive:
        raise ValueError("sensitive columns must be provided")
    require_columns(df, sensitive, "sensitive features")
    if label is not None:
        require_columns(df, [label], "label column")
    outside = {*sensitive, *keep, *([label] if label else [])}
    features = [c for c in df.columns if c not in outside]
    if not features:
        raise ValueError("At least one non-sensitive feature is required")
    numeric, categorical = split_types(df.schema, features)
    return Roles(tuple(features), tuple(numeric), tuple(categorical), tuple(sensitive), label)


def label_domain(df: DataFrame, label: str, also: Iterable[Column] = ()) -> tuple[int, int, int, Row]:
    """Row count and the smallest and largest label of a 0/1 column; anything else raises.

    ``also`` are further aggregates of the same pass; the row they are in comes last.
    """
    require_columns(df, [label], "label column")
    y = ref(label)
    row = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        F.count_if(y.isNull() | ~y.cast("double").isin(0.0, 1.0)).alias("__bad"),
        F.min(y.cast("double")).alias("__low"),
        F.max(y.cast("double")).alias("__high"),
        *also,
    ).first()
    if row["__rows"] == 0:
        raise ValueError("training data is empty")
    if row["__bad"]:
        raise ValueError(f"label {label!r} must be 0 or 1 in every row; {row['__bad']} rows are not")
    return row["__rows"], int(row["__low"]), int(row["__high"]), row
