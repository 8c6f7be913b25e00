"""Table sources."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenhand.functions.expressions import nan_to_null, ref

FORMATS = ("csv", "parquet", "orc", "json")


def read_table(
    spark: SparkSession, path: str, format: str = "csv", schema: T.StructType | str | None = None
) -> DataFrame:
    """Read one table; NaN becomes NULL. A missing path is an error.

    CSV files have a header and their types are inferred, which costs one more pass over the
    files: give a ``schema`` for large ones.
    """
    if format not in FORMATS:
        raise ValueError(f"Unknown format: {format}")
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if format == "csv":
        reader = reader.option("header", True).option("nanValue", "NaN")
        if schema is None:
            reader = reader.option("inferSchema", True)
    return nan_to_null(reader.format(format).load(path))


@dataclass(frozen=True)
class CheckedTable:
    """Rows that fit their schema, and the lines that do not, as they are in the files."""

    rows: DataFrame
    rejected: DataFrame
    _all: DataFrame

    def counts(self) -> DataFrame:
        """(read, accepted, rejected): one pass over the files."""
        bad = F.count_if(F.col(CORRUPT).isNotNull())
        return self._all.agg(F.count(F.lit(1)).alias("read"), (F.count(F.lit(1)) - bad).alias("accepted"), bad.alias("rejected"))


CORRUPT = "_rejected_line"


def read_checked(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True) -> CheckedTable:
    """Read CSV files of which some lines may be broken: too few or too many values, or values that are not of their type.

    Every line is judged as a whole, whatever columns are used later. ``rejected`` has ``line`` and the ``file`` it is in.
    NaN becomes NULL in accepted rows. A missing path is an error.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if CORRUPT in schema.names:
        raise ValueError(f"{CORRUPT!r} cannot be the name of a column")
    reader = spark.read.schema(T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]))
    options = {"header": header, "nanValue": "NaN", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "columnPruning": False}
    found = reader.options(**options).csv(path)
    # Spark reads no line for its own sake, so a value has to be looked at along with it
    seen = F.length(F.concat_ws("", *[ref(c).cast("string") for c in schema.names])) >= 0
    held = found.filter(seen)
    rejected = held.filter(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("line"), F.input_file_name().alias("file"))
    rows = held.filter(F.col(CORRUPT).isNull()).select(*[ref(c) for c in schema.names])
    return CheckedTable(nan_to_null(rows), rejected, held)
