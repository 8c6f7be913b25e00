"""Performance and fairness metrics of binary predictions, and their audit.

All metrics of any number of attributes come from one aggregation of the rows into group
counts; what follows works on a table the size of the group list.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenhand.functions.expressions import first_or_larger, ratio, ratio_or_zero, ref
from evenhand.operators.cells import as_list, confusion_cells, counts_from_cells, group_counts

PERFORMANCE = ("accuracy", "precision", "recall", "f1_score")
FAIRNESS = ("demographic_parity_difference", "equalized_odds_difference")
ADDITIONAL = ("equal_opportunity_difference", "statistical_parity_difference")


def _as_counts(data: DataFrame, y, yhat, attrs, by) -> DataFrame:
    """Accept rows with labels and predictions, confusion cells, or group counts."""
    columns = set(data.columns)
    if {"tp", "fp", "fn", "tn"} <= columns:
        return data
    if {"attr", "group", "y_true", "y_pred", "n"} <= columns:
        return counts_from_cells(data, by)
    return group_counts(data, y, yhat, attrs, by)


def group_rates(data: DataFrame, y=None, yhat=None, attrs=None, by: Iterable[str] = ()) -> DataFrame:
    """Size, selection rate, true and false positive rate of every non-null group."""
    by = list(by)
    c = _as_counts(data, y, yhat, attrs, by)
    tp, fp, fn, tn = (F.col(k) for k in ("tp", "fp", "fn", "tn"))
    return c.filter(F.col("group").isNotNull()).select(
        *[ref(b) for b in by],
        "attr",
        "group",
        (tp + fp + fn + tn).alias("n"),
        ratio(tp + fp, tp + fp + fn + tn).alias("selection_rate"),
        ratio(tp, tp + fn).alias("tpr"),
        ratio(fp, fp + tn).alias("fpr"),
    )


def selection_rate(data: DataFrame, y=None, yhat=None, attrs=None, by: Iterable[str] = ()) -> DataFrame:
    by = list(by)
    return group_rates(data, y, yhat, attrs, by).select(*by, "attr", "group", "selection_rate")


def _weighted_performance() -> dict[str, Column]:
    tp, fp, fn, tn = (F.col(k) for k in ("__tp", "__fp", "__fn", "__tn"))
    total = tp + fp + fn + tn
    positives, negatives = tp + fn, tn + fp

    def weighted(of_one: Column, of_zero: Column) -> Column:
        return ratio(positives * of_one + negatives * of_zero, total)

    return {
        "accuracy": ratio(tp + tn, total),
        "precision": weighted(ratio_or_zero(tp, tp + fp), ratio_or_zero(tn, tn + fn)),
        "recall": weighted(ratio_or_zero(tp, positives), ratio_or_zero(tn, negatives)),
        "f1_score": weighted(
            ratio_or_zero(2 * tp, positives + tp + fp), ratio_or_zero(2 * tn, negatives + tn + fn)
        ),
    }


def _wide(data: DataFrame, y, yhat, attrs, by: list[str]) -> DataFrame:
    """One row per (by, attr) with every metric as a column."""
    c = _as_counts(data, y, yhat, attrs, by)
    known = F.col("group").isNotNull()
    tp, fp, fn, tn = (F.col(k) for k in ("tp", "fp", "fn", "tn"))
    rates = c.select(
        *[ref(b) for b in by],
        "attr",
        "tp",
        "fp",
        "fn",
        "tn",
        F.when(known, ratio(tp + fp, tp + fp + fn + tn)).alias("__sel"),
        F.when(known, ratio(tp, tp + fn)).alias("__tpr"),
        F.when(known, ratio(fp, fp + tn)).alias("__fpr"),
    )
    spread = {k: F.max(k) - F.min(k) for k in ("__sel", "__tpr", "__fpr")}
    totals = rates.groupBy(*[ref(b) for b in by], "attr").agg(
        *[F.sum(k).alias(f"__{k}") for k in ("tp", "fp", "fn", "tn")],
        *[v.alias(f"{k}_gap") for k, v in spread.items()],
    )
    return totals.select(
        *[ref(b) for b in by],
        "attr",
        *[v.alias(k) for k, v in _weighted_performance().items()],
        F.col("__sel_gap").alias("demographic_parity_difference"),
        first_or_larger(F.col("__tpr_gap"), F.col("__fpr_gap")).alias("equalized_odds_difference"),
        F.col("__tpr_gap").alias("equal_opportunity_difference"),
        F.col("__sel_gap").alias("statistical_parity_difference"),
    )


def performance_metrics(data: DataFrame, y=None, yhat=None, attrs=None, by: Iterable[str] = ()) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1 (0 where nothing was predicted).

    Labels and predictions may have any number of values; each one counts with its rows.
    """
    by = list(by)
    columns = set(data.columns)
    if {"tp", "fp", "fn", "tn"} <= columns:
        return _wide(data, y, yhat, attrs, by).select(*by, "attr", *PERFORMANCE)
    cells = data if {"attr", "group", "y_true", "y_pred", "n"} <= columns else confusion_cells(data, y, yhat, attrs, by)
    n, none = F.col("n"), F.lit(0).cast("bigint")
    hit = F.when(F.col("y_true") == F.col("y_pred"), n).otherwise(none)
    sides = F.array(
        F.struct(F.col("y_true").cast("string").alias("label"), n.alias("rows"), none.alias("said"), hit.alias("hits")),
        F.struct(F.col("y_pred").cast("string").alias("label"), none.alias("rows"), n.alias("said"), none.alias("hits")),
    )
    keys = [*[ref(b) for b in by], F.col("attr")]
    labels = cells.select(*keys, F.inline(sides)).groupBy(*keys, "label").agg(*[F.sum(c).alias(c) for c in ("rows", "said", "hits")])
    rows, said, hits = (F.col(c) for c in ("rows", "said", "hits"))
    share = {
        "accuracy": hits,
        "precision": rows * ratio_or_zero(hits, said),
        "recall": rows * ratio_or_zero(hits, rows),
        "f1_score": rows * ratio_or_zero(2 * hits, rows + said),
    }
    return labels.groupBy(*keys).agg(*[ratio(F.sum(v), F.sum(rows)).alias(k) for k, v in share.items()])


def _single(name: str):
    def metric(data: DataFrame, y=None, yhat=None, attrs=None, by: Iterable[str] = ()) -> DataFrame:
        by = list(by)
        return _wide(data, y, yhat, attrs, by).select(*by, "attr", name)

    metric.__name__ = name
    metric.__doc__ = f"One row per attribute with the {name.replace('_', ' ')}."
    return metric


demographic_parity_difference = _single("demographic_parity_difference")
equalized_odds_difference = _single("equalized_odds_difference")
equal_opportunity_difference = _single("equal_opportunity_difference")
statistical_parity_difference = _single("statistical_parity_difference")


def _long(wide: DataFrame, keys: list[str], names: Iterable[str]) -> DataFrame:
    return wide.select(
        *[ref(k) for k in keys],
        F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in names])),
    )


def all_metrics(
    data: DataFrame, y=None, yhat=None, attrs=None, by: Iterable[str] = (), additional: Iterable[str] = ()
) -> DataFrame:
    """Long report (attr, metric, value) with six metrics, plus ``additional`` ones."""
    by = list(by)
    names = [*PERFORMANCE, *FAIRNESS, *check_additional(additional)]
    return _long(_wide(data, y, yhat, attrs, by), [*by, "attr"], names)


def check_additional(names: Iterable[str]) -> list[str]:
    names = as_list(names)
    unknown = sorted(set(names) - set(ADDITIONAL) - set(PERFORMANCE) - set(FAIRNESS))
    if unknown:
        raise ValueError(f"Unknown metric: {unknown}")
    return [n for n in dict.fromkeys(names) if n in ADDITIONAL]


def audit_predictions(
    data: DataFrame,
    y=None,
    yhat=None,
    attrs=None,
    threshold: float = 0.1,
    by: Iterable[str] = (),
    additional: Iterable[str] = (),
) -> DataFrame:
    """One row per attribute: metrics, violations against ``threshold`` and an overall score.

    A missing difference is no violation; the score ignores a missing odds difference.
    """
    by = list(by)
    dpd, eod = (F.col(m) for m in FAIRNESS)
    return _wide(data, y, yhat, attrs, by).select(
        *[ref(b) for b in by],
        "attr",
        *PERFORMANCE,
        *FAIRNESS,
        *check_additional(additional),
        F.coalesce(dpd > threshold, F.lit(False)).alias("demographic_parity_violation"),
        F.coalesce(eod > threshold, F.lit(False)).alias("equalized_odds_violation"),
        (F.lit(1.0) - first_or_larger(dpd, eod)).alias("overall_fairness_score"),
        F.lit(float(threshold)).alias("threshold"),
    )


def report_table(audit: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """Long form of an audit: one row per metric with its status against the threshold.

    ``status`` is only set for fairness metrics. A missing value shows as VIOLATION, as it
    cannot be shown to be within the threshold, but its ``violation`` flag stays false.
    """
    keys = [*by, "attr"]
    names = [m for m in (*PERFORMANCE, *FAIRNESS, *ADDITIONAL) if m in audit.columns]
    rows = _long(audit, [*keys, "threshold"], [*names, "overall_fairness_score"])
    fair = F.col("metric").isin(*FAIRNESS, *ADDITIONAL)
    within = F.coalesce(F.abs("value") <= F.col("threshold"), F.lit(False))
    return rows.select(
        *[ref(k) for k in keys],
        F.when(fair, F.lit("fairness"))
        .when(F.col("metric") == "overall_fairness_score", F.lit("score"))
        .otherwise(F.lit("performance"))
        .alias("kind"),
        "metric",
        "value",
        F.when(fair, F.col("threshold")).alias("threshold"),
        F.when(fair, F.coalesce(F.col("value") > F.col("threshold"), F.lit(False))).alias("violation"),
        F.when(fair, F.when(within, F.lit("OK")).otherwise(F.lit("VIOLATION"))).alias("status"),
    )


def violation_count(audit: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """Number of violated fairness criteria per attribute."""
    return audit.select(
        *[ref(b) for b in by],
        "attr",
        (
            F.col("demographic_parity_violation").cast("int") + F.col("equalized_odds_violation").cast("int")
        ).alias("violations"),
    )
