"""Column expressions: null-aware maxima and ratios, rounding, hashing to random numbers.

Everything here is a plain ``Column`` so it stays inside whole-stage code generation.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every floating-point column (one projection, no action)."""
    floating = {f.name: f.dataType for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    if not floating:
        return df
    return df.select(
        *[
            F.nanvl(F.col(name_of(f.name)), F.lit(None).cast(f.dataType)).alias(f.name)
            if f.name in floating
            else F.col(name_of(f.name))
            for f in df.schema
        ]
    )


def name_of(column: str) -> str:
    """Quote a column name so that dots and blanks in it are taken literally."""
    return "`" + column.replace("`", "``") + "`"


def ref(column: str) -> Column:
    return F.col(name_of(column))


def group_text(df: DataFrame, column: str) -> Column:
    """A group as text; NaN is no group, like NULL."""
    dtype = df.schema[column].dataType
    value = ref(column)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        value = F.nanvl(value, F.lit(None).cast(dtype))
    return value.cast("string")


def first_or_larger(first: Column, second: Column) -> Column:
    """Maximum that is NULL when the first argument is NULL and ignores a NULL second one."""
    return F.when(first.isNotNull(), F.greatest(first, second))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives NULL for an empty denominator (ANSI mode would raise)."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(ratio(numerator, denominator), F.lit(0.0))


def clip_between(value: Column, low=None, high=None) -> Column:
    """Limit a value to bounds; NULL stays NULL."""
    out = value
    if low is not None:
        out = F.greatest(out, F.lit(low))
    if high is not None:
        out = F.least(out, F.lit(high))
    return F.when(value.isNotNull(), out)


def round_back(value: Column, dtype: T.DataType) -> Column:
    """Return a repaired number to its column type; integers round half to even."""
    if isinstance(dtype, T.IntegralType):
        return F.rint(value).cast(dtype)
    return value.cast(dtype)


def logistic(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def hash_uniform(seed: int, *keys: Column | str) -> Column:
    """Uniform number in (0, 1) that depends only on the keys and the seed.

    The same row gets the same number in any partitioning and after any task retry. It is made from the first 52 bits of the
    md5 of the seed and the keys as text, with a bar between them, so any SQL can repeat it; NULL keys are left out.
    """
    columns = [ref(k) if isinstance(k, str) else k for k in keys]
    digits = F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in columns]).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def hash_normal(seed: int, *keys: Column | str) -> Column:
    """Standard normal number from two hashed uniforms (Box-Muller)."""
    u1 = hash_uniform(seed, *keys, F.lit("radius"))
    u2 = hash_uniform(seed, *keys, F.lit("angle"))
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)
