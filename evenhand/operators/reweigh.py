"""Reweighing (Kamiran and Calders, 2012): weights that make label and group independent."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evenhand.functions.expressions import group_text, ref
from evenhand.operators.lookup import attach, pin
from evenhand.operators.roles import require_columns


def reweigh_table(df: DataFrame, attr: str, label: str) -> DataFrame:
    """Weight P(group) P(label) / P(group, label) of every cell; NULL groups and labels have none."""
    cells = (
        df.select(group_text(df, attr).alias("group"), group_text(df, label).alias("label"))
        .dropna()
        .groupBy("group", "label")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    labels = pin(cells.groupBy("label").agg(F.sum("n").alias("__of_label")))
    total = labels.df.agg(F.sum("__of_label")).first()[0]
    # a window over the labels of one group
    of_group = F.sum("n").over(Window.partitionBy("group"))
    weight = of_group.cast("double") * F.col("__of_label") / (F.lit(float(total or 0)) * F.col("n"))
    return attach(cells, labels, ["label"]).select("group", "label", "n", weight.alias("weight"))


def reweigh(
    df: DataFrame, attr: str, label: str, out: str = "weight", spread_by: list[str] | None = None
) -> DataFrame:
    """Attach the weight of each row's cell, for the ``weightCol`` of an estimator."""
    require_columns(df, [attr, label])
    weights = pin(
        reweigh_table(df, attr, label).select(
            F.col("group").alias("__group"), F.col("label").alias("__label"), F.col("weight").alias(out)
        )
    )
    keyed = df.withColumns({"__group": group_text(df, attr), "__label": group_text(df, label)})
    return attach(keyed, weights, ["__group", "__label"], spread_by).select(*[ref(c) for c in df.columns], out)
