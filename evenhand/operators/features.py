"""Encoding and scaling of model features; a fit returns a new immutable model."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenhand.functions.expressions import ref
from evenhand.operators import lookup
from evenhand.operators.cells import as_list
from evenhand.operators.lookup import GroupTable, attach, pin
from evenhand.operators.roles import require_columns, split_types
from evenhand.session import cut_lineage

NULL_TOKEN = "nan"


def _as_text(column: str, null_token: str | None):
    text = ref(column).cast("string")
    return text if null_token is None else F.coalesce(text, F.lit(null_token))


def _distinct_values(df: DataFrame, columns: list[str], null_token: str | None) -> DataFrame:
    """Distinct (column, value) pairs of all columns in one aggregation."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), _as_text(c, null_token).alias("value")) for c in columns])
    )
    return (
        df.select(pairs.alias("__p")).select("__p.column", "__p.value").filter(F.col("value").isNotNull()).distinct()
    )


def _sorted_codes(values: DataFrame) -> GroupTable:
    """Code each value of a column with its position in sorted order.

    Small sets are ordered in one window per column. Others are range-partitioned and written
    once; a code is the position inside the partition plus the size of the partitions before.
    """
    table = pin(values)
    if table.bounded:
        order = Window.partitionBy("column").orderBy("value")
        return pin(table.df.select("column", "value", (F.row_number().over(order) - 1).cast("bigint").alias("code")))
    ranged = cut_lineage(
        table.df.repartitionByRange("column", "value").withColumn("__part", F.spark_partition_id())
    )
    # one row per column and range partition
    sizes = ranged.groupBy("column", "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("column").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pin(sizes.select("column", "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset")))
    inside = Window.partitionBy("column", "__part").orderBy("value")
    coded = attach(ranged.withColumn("__pos", F.row_number().over(inside)), offsets, ["column", "__part"]).select(
        "column", "value", (F.col("__offset") + F.col("__pos") - 1).cast("bigint").alias("code")
    )
    return GroupTable(cut_lineage(coded), False)


def _column_tables(columns: tuple[str, ...], codes: GroupTable) -> tuple[dict, dict, dict]:
    """Code table, number of classes and first class of each column.

    A column with many values does not keep the others from being broadcast.
    """
    rows = (
        codes.df.groupBy("column")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.when(F.col("code") == 0, F.col("value"))).alias("first"))
        .collect()
    )
    sizes = {r["column"]: r["n"] for r in rows}
    first = {r["column"]: r["first"] for r in rows}
    tables = {}
    for c in columns:
        table = codes.narrow("value", "code", where=F.col("column") == c)
        if not table.bounded and sizes.get(c, 0) <= lookup.BROADCAST_ROWS:
            table = pin(table.df)
        tables[c] = table
    return tables, sizes, first


def _no_codes(df: DataFrame) -> GroupTable:
    return lookup.local_table(df.sparkSession, [], "column string, value string, code bigint")


@dataclass(frozen=True)
class LabelEncoding:
    """Sorted-order codes of categorical columns.

    ``codes`` holds (column, value, code). NULL is encoded as the text ``null_token``; a value
    that was not seen in the fit takes code 0, the first class.
    """

    columns: tuple[str, ...]
    codes: GroupTable
    null_token: str = NULL_TOKEN
    tables: Mapping[str, GroupTable] = field(default_factory=dict)
    sizes: Mapping[str, int] = field(default_factory=dict)
    first: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def fit(cls, df: DataFrame, columns: Iterable[str], null_token: str = NULL_TOKEN) -> LabelEncoding:
        columns = as_list(columns)
        require_columns(df, columns)
        if not columns:
            return cls((), _no_codes(df), null_token)
        codes = _sorted_codes(_distinct_values(df, columns, null_token))
        return cls.from_codes(columns, codes, null_token)

    @classmethod
    def from_codes(cls, columns: Iterable[str], codes: GroupTable, null_token: str = NULL_TOKEN) -> LabelEncoding:
        columns = tuple(columns)
        return cls(columns, codes, null_token, *_column_tables(columns, codes))

    def _table(self, column: str, *select) -> GroupTable:
        return self.tables[column].narrow(*select)

    def transform(self, df: DataFrame, suffix: str = "", spread_by: list[str] | None = None) -> DataFrame:
        """Replace each encoded column by its integer code (or add it under ``suffix``)."""
        out = df
        for c in self.columns:
            table = self._table(c, F.col("value").alias("__value"), F.col("code").alias("__code"))
            keyed = out.withColumn("__value", _as_text(c, self.null_token))
            out = (
                attach(keyed, table, ["__value"], spread_by)
                .withColumn(c + suffix, F.coalesce("__code", F.lit(0).cast("bigint")))
                .drop("__value", "__code")
            )
        return out.select(*[ref(c) for c in [*df.columns, *[x for x in out.columns if x not in df.columns]]])

    def inverse_transform(
        self, df: DataFrame, types: Mapping[str, T.DataType] | None = None, spread_by: list[str] | None = None
    ) -> DataFrame:
        """Decode (possibly shifted) codes: round half to even, clip to the classes, look up."""
        out = df
        for c in self.columns:
            table = self._table(c, F.col("code").alias("__code"), F.col("value").alias("__value"))
            top = self.sizes.get(c, 1) - 1
            code = F.least(F.greatest(F.rint(ref(c).cast("double")), F.lit(0.0)), F.lit(float(top))).cast("bigint")
            value = F.col("__value").cast((types or {}).get(c, T.StringType()))
            out = (
                attach(out.withColumn("__code", code), table, ["__code"], spread_by)
                .withColumn(c, value)
                .drop("__code", "__value")
            )
        return out.select(*[ref(c) for c in df.columns])

    def snap(
        self, df: DataFrame, types: Mapping[str, T.DataType] | None = None, spread_by: list[str] | None = None
    ) -> DataFrame:
        """Encode and decode without a change in between, in one join per column.

        Known values stay; unseen ones become the first class.
        """
        out = df
        for c in self.columns:
            table = self._table(c, F.col("value").alias("__value"), F.lit(True).alias("__known"))
            value = F.when(F.col("__known"), F.col("__value")).otherwise(F.lit(self.first.get(c)))
            out = (
                attach(out.withColumn("__value", _as_text(c, self.null_token)), table, ["__value"], spread_by)
                .withColumn(c, value.cast((types or {}).get(c, T.StringType())))
                .drop("__value", "__known")
            )
        return out.select(*[ref(c) for c in df.columns])


@dataclass(frozen=True)
class CategoryCodes:
    """Sorted-order codes with -1 for NULL (and for values not seen in the fit)."""

    columns: tuple[str, ...]
    codes: GroupTable
    tables: Mapping[str, GroupTable] = field(default_factory=dict)

    @classmethod
    def fit(cls, df: DataFrame, columns: Iterable[str]) -> CategoryCodes:
        columns = as_list(columns)
        require_columns(df, columns)
        if not columns:
            return cls((), _no_codes(df))
        return cls.from_codes(columns, _sorted_codes(_distinct_values(df, columns, None)))

    @classmethod
    def from_codes(cls, columns: Iterable[str], codes: GroupTable) -> CategoryCodes:
        columns = tuple(columns)
        return cls(columns, codes, _column_tables(columns, codes)[0])

    def transform(self, df: DataFrame, suffix: str = "", spread_by: list[str] | None = None) -> DataFrame:
        out = df
        for c in self.columns:
            table = self.tables[c].narrow(F.col("value").alias("__value"), F.col("code").alias("__code"))
            out = (
                attach(out.withColumn("__value", ref(c).cast("string")), table, ["__value"], spread_by)
                .withColumn(c + suffix, F.coalesce("__code", F.lit(-1).cast("bigint")))
                .drop("__value", "__code")
            )
        return out.select(*[ref(c) for c in [*df.columns, *[x for x in out.columns if x not in df.columns]]])


@dataclass(frozen=True)
class StandardScaling:
    """Mean and population standard deviation per numeric column; deviation 0 scales by 1."""

    means: Mapping[str, float]
    deviations: Mapping[str, float]

    @classmethod
    def fit(cls, df: DataFrame, columns: Iterable[str]) -> StandardScaling:
        columns = as_list(columns)
        require_columns(df, columns)
        if not columns:
            return cls({}, {})
        return cls.from_row(df.agg(*cls.aggregates(columns)).first(), columns)

    @staticmethod
    def aggregates(columns: list[str]) -> list[Column]:
        """What a fit needs, to be evaluated together with other aggregates."""
        value = [F.nanvl(ref(c).cast("double"), F.lit(None).cast("double")) for c in columns]
        return [F.avg(v).alias(f"__mean_{i}") for i, v in enumerate(value)] + [
            F.stddev_pop(v).alias(f"__dev_{i}") for i, v in enumerate(value)
        ]

    @classmethod
    def from_row(cls, row, columns: list[str]) -> StandardScaling:
        return cls(
            {c: row[f"__mean_{i}"] for i, c in enumerate(columns)},
            {c: row[f"__dev_{i}"] for i, c in enumerate(columns)},
        )

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        scaled = {}
        for c, mean in self.means.items():
            deviation = self.deviations[c] or 1.0
            centred = ref(c).cast("double") - F.lit(mean).cast("double")
            scaled[c + suffix] = centred / F.lit(float(deviation))
        return df.withColumns(scaled) if scaled else df


@dataclass(frozen=True)
class FeaturePrep:
    """Numeric scaling and category codes of model features, in the original column order.

    ``null_code=-1`` is the coding of the baseline model, where NULL is a code of its own;
    otherwise NULL is the class ``"nan"`` and unseen values take the first class.
    """

    features: tuple[str, ...]
    scaling: StandardScaling
    coding: LabelEncoding | CategoryCodes

    @classmethod
    def fit(
        cls,
        df: DataFrame,
        features: Iterable[str],
        null_code: int | None = None,
        scaling: StandardScaling | None = None,
    ) -> FeaturePrep:
        features = as_list(features)
        numeric, categorical = split_types(df.schema, features)
        coder = CategoryCodes if null_code == -1 else LabelEncoding
        scaling = StandardScaling.fit(df, numeric) if scaling is None else scaling
        return cls(tuple(features), scaling, coder.fit(df, categorical))

    def names(self) -> list[str]:
        return [f"__x{i}" for i in range(len(self.features))]

    def transform(self, df: DataFrame, spread_by: list[str] | None = None) -> DataFrame:
        """Add one double column per feature, named by ``names()``."""
        coded = self.coding.transform(self.scaling.transform(df, "__std"), "__code", spread_by)
        source = {c: c + "__std" for c in self.scaling.means} | {c: c + "__code" for c in self.coding.columns}
        return coded.select(
            *[ref(c) for c in df.columns],
            *[ref(source[c]).cast("double").alias(n) for c, n in zip(self.features, self.names(), strict=True)],
        )

    def assemble(self, df: DataFrame, out: str = "features") -> DataFrame:
        """Collect the transformed columns into an ML vector; a missing feature is an error."""
        return VectorAssembler(inputCols=self.names(), outputCol=out, handleInvalid="error").transform(df)
