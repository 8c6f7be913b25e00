"""The end-to-end job: split, baseline audit, repair, fair training, audit, comparison."""

from __future__ import annotations

import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from evenhand.functions.expressions import nan_to_null
from evenhand.operators.audit import audit_dataset
from evenhand.operators.compare import compare_fairness, compare_performance, comparison_series, goal_summary, verdict
from evenhand.operators.learners import BaseLearner
from evenhand.operators.lookup import pin
from evenhand.operators.metrics import audit_predictions, report_table
from evenhand.operators.repair import GroupRepair, GroupRepairModel
from evenhand.operators.reweigh import reweigh
from evenhand.operators.roles import resolve_roles
from evenhand.operators.split import split_summary, stratified_split
from evenhand.operators.training import (
    BaselineModel,
    FairReduction,
    FairThresholds,
    ReductionModel,
    ThresholdedModel,
    fit_baseline,
)
from evenhand.plans.settings import REWEIGHTING, RunSettings, validate
from evenhand.sources.sinks import (
    StagedRun,
    group_size_summary,
    group_statistics,
    run_metrics,
    run_params,
    write_report,
    write_table,
)
from evenhand.sources.tables import read_table

SPLIT = "split"


@dataclass(frozen=True)
class RunResult:
    """Reports of a run (small DataFrames), the scored rows, and the fitted models."""

    run_id: str
    reports: dict[str, DataFrame]
    scored: DataFrame
    baseline: BaselineModel
    model: ReductionModel | ThresholdedModel
    repair: GroupRepairModel | None


def run_fairness(spark: SparkSession, settings: RunSettings, df: DataFrame | None = None) -> RunResult:
    """Run all stages on ``df``, or on the table that the settings name.

    The baseline is measured on the training rows it was fitted on, and the final model on the
    test rows; ``reports["metrics_by_split"]`` has the final model on all splits for a
    like-for-like comparison. Row-level work is lazy or distributed, reports are group-sized.
    """
    errors = validate(settings)
    if errors:
        raise ValueError("; ".join(errors))
    s = settings
    run_id = s.run_id or uuid.uuid4().hex
    if df is None:
        if not s.input_path:
            raise ValueError("input_path is required when no DataFrame is given")
        df = read_table(spark, s.input_path, s.input_format, s.input_schema)
    else:
        df = nan_to_null(df)
    keep = (s.id_col, s.label, SPLIT)
    resolve_roles(df, s.sensitive, s.label, [s.id_col])
    # the table is read for the cut between the splits, and once more into the copy that all later steps read
    rows = stratified_split(df, s.id_col, s.label, s.test_size, s.val_size, s.seed)
    held = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        result = _stages(spark, s, held, run_id)
    finally:
        held.unpersist()
    if s.output_path:
        write_run(spark, s, result)
    return result


def _stages(spark: SparkSession, s: RunSettings, rows: DataFrame, run_id: str) -> RunResult:
    """Everything after the split; reports are evaluated here, the scored rows are not."""
    audited, first = list(s.audited), s.sensitive[0]
    train = rows.filter(F.col(SPLIT) == "train")
    learner = BaseLearner(s.base_estimator, max_retries=s.max_retries, seed=s.seed)
    # the baseline is a plain logistic regression whatever the fair model is built on
    baseline = fit_baseline(train, s.label, s.sensitive, keep=[s.id_col, SPLIT])
    before = baseline.transform(train, "prediction", [s.id_col])
    reports = {
        "split_summary": split_summary(rows),
        "dataset_audit": audit_dataset(train.drop(SPLIT), first, s.label),
        "baseline_audit": audit_predictions(
            before, s.label, "prediction", audited, s.fairness_threshold, (), s.additional_metrics
        ),
    }
    reports = {name: pin(report).df for name, report in reports.items()}

    # the repair is a projection behind broadcast joins: cheaper to redo than to store again
    repair, repaired = _repair(s, rows, train)
    model = _train(s, learner, repaired)
    scored = model.transform(repaired, "prediction", [s.id_col])
    reports["audit_by_split"] = pin(
        audit_predictions(
            scored, s.label, "prediction", audited, s.fairness_threshold, [SPLIT], s.additional_metrics
        )
    ).df
    reports |= _compare(s, reports, run_id)
    if repair is not None:
        stats = repair.group_stats()
        reports["group_statistics"] = group_statistics(stats, run_id)
        reports["group_sizes"] = group_size_summary(stats)
    reports["params"] = run_params(spark, _params(s), run_id)
    return RunResult(run_id, reports, scored, baseline, model, repair)


def _repair(s: RunSettings, rows: DataFrame, train: DataFrame) -> tuple[GroupRepairModel | None, DataFrame]:
    """Fit on the training rows, apply to all splits in one pass."""
    if s.method == REWEIGHTING:
        return None, rows
    repair = GroupRepair(
        tuple(s.sensitive), s.method, s.repair_level, id_col=s.id_col, keep=(s.label, SPLIT), seed=s.seed
    ).fit(train)
    return repair, repair.transform(rows)


def _train(s: RunSettings, learner: BaseLearner, rows: DataFrame) -> ReductionModel | ThresholdedModel:
    train = rows.filter(F.col(SPLIT) == "train")
    if s.strategy == "thresholds":
        keep, weight = (s.id_col, SPLIT), None
        if s.method == REWEIGHTING:
            train, weight = reweigh(train, s.sensitive[0], s.label, "__weight", [s.id_col]), "__weight"
        return FairThresholds(tuple(s.sensitive), learner, keep).fit(train, s.label, [s.id_col], weight)
    return FairReduction(
        tuple(s.sensitive),
        s.constraint,
        s.id_col,
        learner,
        keep=(SPLIT,),
        eta0=s.eta0,
        max_iter=s.max_iter,
        reweighting=s.method == REWEIGHTING,
        seed=s.seed,
    ).fit(train, s.label)


def _compare(s: RunSettings, reports: dict[str, DataFrame], run_id: str) -> dict[str, DataFrame]:
    by_split = reports["audit_by_split"]

    def long(audit: DataFrame) -> DataFrame:
        return report_table(audit).filter(F.col("kind") != "score").select("attr", "metric", "value")

    base = long(reports["baseline_audit"])
    validation = long(by_split.filter(F.col(SPLIT) == "validation"))
    final = long(by_split.filter(F.col(SPLIT) == "test"))
    fairness = compare_fairness(base, final, s.primary_metric, ["attr"])
    first = F.col("attr") == s.audited[0]
    return {
        "metrics_by_split": report_table(by_split, [SPLIT]),
        "performance": compare_performance(base, final, ["attr"]),
        "fairness": fairness,
        "summary": verdict(goal_summary(fairness, s.fairness_threshold, ["attr"])),
        "fairness_series": comparison_series(base, final, "fairness", s.fairness_threshold, ["attr"]),
        "performance_series": comparison_series(base, final, "performance", None, ["attr"]),
        "metrics": run_metrics(
            base.filter(first), validation.filter(first), final.filter(first), s.primary_metric, run_id
        ),
    }


def _params(s: RunSettings) -> dict:
    return {k: v for k, v in asdict(s).items() if k != "run_id"}


def write_run(spark: SparkSession, s: RunSettings, result: RunResult) -> None:
    """Store all reports, the scored rows and the models under the run id, all or none; a rerun replaces them."""
    run_id = result.run_id
    with StagedRun(spark, s.output_path, run_id) as out:
        for name, report in result.reports.items():
            within = f"{name}/experiment={s.experiment}" if name == "metrics" else name
            write_report(report.drop("run_id"), out.path(f"{within}/run_id={run_id}"))
        write_table(result.scored, out.path(f"scored/run_id={run_id}"), mode="overwrite")
        result.baseline.save(out.path(f"baselines/{run_id}"))
        result.model.save(out.path(f"models/{run_id}"))
        if result.repair is not None:
            result.repair.save(out.path(f"repairs/{run_id}"))


__all__ = ["RunResult", "RunSettings", "run_fairness", "validate", "write_run"]
