"""Comparison of two metric reports (before and after), as joins of small long tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenhand.functions.expressions import ref
from evenhand.operators.lookup import pin
from evenhand.operators.metrics import ADDITIONAL, FAIRNESS, PERFORMANCE


def _paired(base: DataFrame, final: DataFrame, by: list[str], metrics: Iterable[str]) -> DataFrame:
    """Metrics present in both reports, side by side."""
    keep = F.col("metric").isin(*metrics)
    keys = [*by, "metric"]
    left = base.filter(keep).select(*[ref(k) for k in keys], F.col("value").alias("baseline"))
    right = final.filter(keep).select(*[ref(k) for k in keys], F.col("value").alias("final"))
    return left.join(right, keys, "inner")


def _percent(change: Column, base: Column) -> Column:
    return F.when(base != 0, change / base * 100).when(base == 0, F.lit(0.0))


def _three_way(change: Column, up: str, down: str, same: str) -> Column:
    return F.when(change > 0, F.lit(up)).when(change < 0, F.lit(down)).otherwise(F.lit(same))


def compare_performance(base: DataFrame, final: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """Change of each performance metric: Improved, Decreased or Unchanged."""
    by = list(by)
    change = F.col("final") - F.col("baseline")
    return _paired(base, final, by, PERFORMANCE).select(
        *[ref(b) for b in by],
        "metric",
        "baseline",
        "final",
        change.alias("change"),
        _percent(change, F.col("baseline")).alias("change_pct"),
        _three_way(change, "Improved", "Decreased", "Unchanged").alias("status"),
    )


def compare_fairness(
    base: DataFrame, final: DataFrame, primary: str = FAIRNESS[0], by: Iterable[str] = ()
) -> DataFrame:
    """Improvement (baseline minus final) of each fairness metric: Better, Worse or Same."""
    by = list(by)
    gain = F.col("baseline") - F.col("final")
    return _paired(base, final, by, (*FAIRNESS, *ADDITIONAL)).select(
        *[ref(b) for b in by],
        "metric",
        "baseline",
        "final",
        gain.alias("improvement"),
        _percent(gain, F.col("baseline")).alias("improvement_pct"),
        _three_way(gain, "Better", "Worse", "Same").alias("status"),
        (F.col("metric") == primary).alias("is_primary"),
    )


def goal_summary(fairness: DataFrame, threshold: float, by: Iterable[str] = ()) -> DataFrame:
    """Whether the primary metric improved and whether it meets the threshold."""
    return fairness.filter("is_primary").select(
        *[ref(b) for b in by],
        F.col("metric").alias("primary_metric"),
        "baseline",
        "final",
        "improvement",
        "improvement_pct",
        F.coalesce(F.col("improvement") > 0, F.lit(False)).alias("goal_achieved"),
        F.coalesce(F.col("final") <= threshold, F.lit(False)).alias("threshold_met"),
        F.lit(float(threshold)).alias("threshold"),
    )


def verdict(summary: DataFrame) -> DataFrame:
    """SUCCESS when the threshold is met, else IMPROVED or FAILED."""
    return summary.withColumn(
        "verdict",
        F.when(F.col("threshold_met"), F.lit("SUCCESS"))
        .when(F.col("goal_achieved"), F.lit("IMPROVED"))
        .otherwise(F.lit("FAILED")),
    )


def comparison_series(
    base: DataFrame,
    final: DataFrame,
    kind: str = "fairness",
    threshold: float | None = 0.1,
    by: Iterable[str] = (),
) -> DataFrame:
    """Long Before/After series of the two fairness or three performance metrics for a chart.

    Raises when the reports have no metric of the kind in common, so the reports are evaluated
    here, once; the result holds their values.
    """
    by = list(by)
    if kind == "fairness":
        metrics = FAIRNESS
    elif kind == "performance":
        metrics, threshold = PERFORMANCE[:3], None
    else:
        raise ValueError(f"Unknown kind: {kind}")
    pairs = pin(_paired(base, final, by, metrics))
    if not pairs.rows and (pairs.bounded or pairs.df.isEmpty()):
        raise ValueError(f"the two reports share no {kind} metric")
    return pairs.df.select(
        *[ref(b) for b in by],
        "metric",
        F.inline(
            F.array(
                F.struct(F.lit("Before").alias("series"), F.col("baseline").alias("value")),
                F.struct(F.lit("After").alias("series"), F.col("final").alias("value")),
            )
        ),
        F.lit(threshold).cast("double").alias("threshold"),
    )
