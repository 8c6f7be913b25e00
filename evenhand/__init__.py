"""Fairness analytics on Spark: audit, repair, fair training and comparison of tables."""

from evenhand.operators.audit import (
    audit_dataset,
    dataset_shape,
    gap_summary,
    group_distribution,
    intersectional_rates,
    missing_values,
    rate_matrix,
    rates_by_attribute,
    target_rate,
    target_rate_difference,
)
from evenhand.operators.cells import confusion_cells
from evenhand.operators.clean import clip, ffill_bfill, logistic_score, scale_by_group
from evenhand.operators.compare import (
    compare_fairness,
    compare_performance,
    comparison_series,
    goal_summary,
    verdict,
)
from evenhand.operators.features import CategoryCodes, FeaturePrep, LabelEncoding, StandardScaling
from evenhand.operators.metrics import (
    all_metrics,
    audit_predictions,
    demographic_parity_difference,
    equal_opportunity_difference,
    equalized_odds_difference,
    group_rates,
    performance_metrics,
    report_table,
    selection_rate,
    statistical_parity_difference,
    violation_count,
)
from evenhand.operators.repair import GroupRepair, GroupRepairModel, fit_group_stats
from evenhand.operators.reweigh import reweigh
from evenhand.operators.roles import resolve_roles, split_types
from evenhand.operators.split import split_summary, stratified_split
from evenhand.operators.thresholds import ThresholdModel, apply_thresholds, fit_thresholds, fit_thresholds_approx
from evenhand.operators.training import FairReduction, FairThresholds, fit_baseline, load_model
from evenhand.plans.run import RunResult, run_fairness
from evenhand.plans.settings import RunSettings, validate
from evenhand.sources.sinks import group_proportions, group_size_summary, run_metrics, write_metrics, write_params
from evenhand.sources.tables import read_table

__all__ = [
    "CategoryCodes",
    "FairReduction",
    "FairThresholds",
    "FeaturePrep",
    "GroupRepair",
    "GroupRepairModel",
    "LabelEncoding",
    "RunResult",
    "RunSettings",
    "StandardScaling",
    "ThresholdModel",
    "all_metrics",
    "apply_thresholds",
    "audit_dataset",
    "audit_predictions",
    "clip",
    "compare_fairness",
    "compare_performance",
    "comparison_series",
    "confusion_cells",
    "dataset_shape",
    "demographic_parity_difference",
    "equal_opportunity_difference",
    "equalized_odds_difference",
    "ffill_bfill",
    "fit_baseline",
    "fit_group_stats",
    "fit_thresholds",
    "fit_thresholds_approx",
    "gap_summary",
    "goal_summary",
    "group_distribution",
    "group_proportions",
    "group_rates",
    "group_size_summary",
    "intersectional_rates",
    "load_model",
    "logistic_score",
    "missing_values",
    "performance_metrics",
    "rate_matrix",
    "rates_by_attribute",
    "read_table",
    "report_table",
    "resolve_roles",
    "reweigh",
    "run_fairness",
    "run_metrics",
    "scale_by_group",
    "selection_rate",
    "split_summary",
    "split_types",
    "statistical_parity_difference",
    "stratified_split",
    "target_rate",
    "target_rate_difference",
    "validate",
    "verdict",
    "violation_count",
    "write_metrics",
    "write_params",
]
