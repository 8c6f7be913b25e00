"""Settings of a fairness run and their validation, on the driver before any Spark action."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from numbers import Real

from evenhand.operators.learners import BASE_ESTIMATORS
from evenhand.operators.metrics import ADDITIONAL, FAIRNESS, PERFORMANCE
from evenhand.operators.repair import METHODS
from evenhand.operators.training import CONSTRAINTS

REWEIGHTING = "reweighting"
STRATEGIES = ("reduction", "thresholds")
# fixed names of configuration files
TRANSFORMERS = ("BiasMitigationTransformer",)
TRAINERS = ("FairnessConstrainedClassifier",)
MAX_SENSITIVE = 10
MAX_ADDITIONAL = 20


@dataclass(frozen=True)
class RunSettings:
    """One run: what to read, how to repair and train, and how to judge the result."""

    label: str
    sensitive: tuple[str, ...]
    id_col: str
    input_path: str | None = None
    input_format: str = "csv"
    input_schema: str | None = None
    test_size: float = 0.2
    val_size: float = 0.2
    seed: int = 42
    method: str = "mean_matching"
    repair_level: float = 1.0
    strategy: str = "reduction"
    constraint: str = "demographic_parity"
    base_estimator: str = "LogisticRegression"
    max_iter: int = 20
    eta0: float = 60.0
    max_retries: int = 3
    report_on: tuple[str, ...] = ()
    primary_metric: str = FAIRNESS[0]
    fairness_threshold: float = 0.1
    additional_metrics: tuple[str, ...] = ()
    experiment: str = "fairness"
    run_id: str | None = None
    tags: dict = field(default_factory=dict)
    output_path: str | None = None

    @classmethod
    def from_sections(cls, config: Mapping, id_col: str, **more) -> RunSettings:
        """Settings from a mapping of sections, as they are kept in a configuration file.

        ``data``, ``preprocessing``, ``training`` and ``evaluation`` are read as named below, and
        ``tracking`` or ``mlflow`` for the experiment. The names of the transformer and of the training
        method, where they are given, have to be ones that exist. ``more`` overrides.
        """
        data, pre, train, judge = (config.get(k) or {} for k in ("data", "preprocessing", "training", "evaluation"))
        tracking = config.get("tracking") or config.get("mlflow") or {}
        for section, key, names in ((pre, "transformer", TRANSFORMERS), (train, "method", TRAINERS)):
            name = (section.get(key) or {}).get("name")
            if name is not None and name not in names:
                raise ValueError(f"{key} {name!r} is none of {', '.join(names)}")
        repair = (pre.get("transformer") or {}).get("parameters") or {}
        fit = (train.get("method") or {}).get("parameters") or {}
        given = {
            "label": data.get("target_column", ""),
            "sensitive": data.get("sensitive_features", ()),
            "input_path": data.get("input_path"),
            "test_size": data.get("test_size"),
            "val_size": data.get("val_size"),
            "seed": data.get("random_state"),
            "method": repair.get("method"),
            "repair_level": repair.get("repair_level"),
            "constraint": fit.get("constraint"),
            "base_estimator": fit.get("base_estimator"),
            "max_retries": fit.get("max_retries", train.get("max_retries")),
            "primary_metric": judge.get("primary_metric"),
            "fairness_threshold": judge.get("fairness_threshold"),
            "additional_metrics": judge.get("additional_metrics"),
            "experiment": tracking.get("experiment_name"),
            "run_id": tracking.get("run_name"),
            "tags": tracking.get("tags"),
        }
        chosen = {k: tuple(v) if isinstance(v, list) else v for k, v in given.items() if v is not None}
        return cls(**{**chosen, "id_col": id_col, **more})

    @property
    def audited(self) -> tuple[str, ...]:
        """Attributes of the reports: the first sensitive one unless others are named."""
        return self.report_on or tuple(self.sensitive[:1])


def validate(settings: RunSettings) -> list[str]:
    """All problems of the settings as messages; an empty list means they are usable."""
    errors = []

    def number(value, low, high, low_open=False) -> bool:
        if not isinstance(value, Real) or isinstance(value, bool):
            return False
        return (low < value if low_open else low <= value) and value <= high

    s = settings
    if not s.label:
        errors.append("no label column is named (target_column)")
    if not s.id_col:
        errors.append("no id column is named")
    if isinstance(s.sensitive, str) or not hasattr(s.sensitive, "__len__"):
        errors.append("sensitive columns are given as a list or tuple")
    elif len(s.sensitive) == 0:
        errors.append("no sensitive column is named")
    elif len(s.sensitive) > MAX_SENSITIVE:
        errors.append(f"{len(s.sensitive)} sensitive columns are named, {MAX_SENSITIVE} are allowed")
    if not number(s.test_size, 0.01, 0.99):
        errors.append(f"the test share has to lie within 0.01 and 0.99; it is {s.test_size}")
    elif not number(s.val_size, 0.0, 1.0) or not s.test_size + s.val_size < 1:
        errors.append(f"nothing is left to train on: test share {s.test_size}, validation share {s.val_size}")
    if not number(s.repair_level, 0.0, 1.0):
        errors.append(f"the repair level is a share from 0 to 1; it is {s.repair_level}")
    if not number(s.fairness_threshold, 0.0, 1.0, low_open=True):
        errors.append(f"the fairness threshold is above 0 and at most 1; it is {s.fairness_threshold}")
    known = {*PERFORMANCE, *FAIRNESS, *ADDITIONAL}
    if len(s.additional_metrics) > MAX_ADDITIONAL:
        errors.append(f"{len(s.additional_metrics)} more metrics are asked for, {MAX_ADDITIONAL} are allowed")
    errors += [f"there is no metric {m!r}" for m in s.additional_metrics if m not in known]
    if s.primary_metric not in {*FAIRNESS, *ADDITIONAL}:
        errors.append(f"{s.primary_metric!r} cannot be the primary metric")
    if s.method not in (*METHODS, REWEIGHTING):
        errors.append(f"there is no repair method {s.method!r}")
    if s.strategy not in STRATEGIES:
        errors.append(f"there is no training strategy {s.strategy!r}")
    if s.constraint not in CONSTRAINTS:
        errors.append(f"Unknown constraint: {s.constraint}")
    if s.base_estimator not in BASE_ESTIMATORS:
        errors.append(f"Unknown base estimator: {s.base_estimator}")
    if not isinstance(s.max_retries, int) or s.max_retries < 1:
        errors.append("max_retries counts attempts, from 1 on")
    return errors
