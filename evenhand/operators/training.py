"""Fair training: a baseline, a reduction to weighted classification, and group thresholds.

The reduction is exponentiated gradient (Agarwal et al., 2018) with a choice of the mixture's weights. Weights of rows
depend only on the label and the group, so an iteration is a join with a table of two rows per group, one weighted fit,
and one aggregation by group and label (see ``games``).
"""

from __future__ import annotations

import json
import logging
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field

import numpy as np
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from evenhand.functions.expressions import group_text, hash_uniform, ref
from evenhand.operators import games
from evenhand.operators.cells import as_list
from evenhand.operators.features import CategoryCodes, FeaturePrep, LabelEncoding, StandardScaling
from evenhand.operators.games import Few, Many, mix
from evenhand.operators.learners import BaseLearner, ConstantScorer, ForestScorer, LinearScorer
from evenhand.operators.lookup import GroupTable, attach, from_rows, local_table, pin
from evenhand.operators.newton import fit_newton
from evenhand.operators.roles import label_domain, require_columns, resolve_roles, split_types
from evenhand.operators.thresholds import ThresholdModel, apply_thresholds, fit_thresholds, fit_thresholds_approx
from evenhand.session import cut_lineage

log = logging.getLogger(__name__)
CONSTRAINTS = ("demographic_parity", "equalized_odds")
#: The error of a mixture has settled when ``PATIENCE`` iterations lower it by less than ``SETTLED`` each.
SETTLED, PATIENCE, LEAST_ITERATIONS = 0.002, 4, 10
#: Gradient at which an answer to multipliers, which change again at once, is good enough.
ANSWER_TOL = 1e-4
PSEUDO_HIGH, PSEUDO_LOW = 0.8, 0.2


def _learner(base_estimator) -> BaseLearner:
    return base_estimator if isinstance(base_estimator, BaseLearner) else BaseLearner(base_estimator)


# ---- fitted models ---------------------------------------------------------------------------


@dataclass(frozen=True)
class BaselineModel:
    """An unconstrained classifier without the sensitive columns."""

    prep: FeaturePrep
    scorer: LinearScorer | ConstantScorer | ForestScorer
    sensitive: tuple[str, ...]
    info: dict = field(default_factory=dict)

    def transform(self, df: DataFrame, out: str = "prediction", spread_by: list[str] | None = None) -> DataFrame:
        """Add the 0/1 prediction and ``probability``, the score of class 1."""
        ready = self.prep.transform(df, spread_by)
        scored = self.scorer.with_scores(ready, self.prep.names(), out, "probability")
        return scored.drop(*self.prep.names())

    def fairness_info(self) -> dict:
        return dict(self.info)

    def save(self, path: str) -> None:
        _save(path, "baseline", self.prep, [self.scorer], self.info, {"sensitive": list(self.sensitive)})


@dataclass(frozen=True)
class ReductionModel:
    """A weighted mix of classifiers; a prediction draws one of them by a hash of the row id."""

    prep: FeaturePrep
    scorers: tuple
    weights: tuple[float, ...]
    sensitive: tuple[str, ...]
    id_col: str
    seed: int
    info: dict = field(default_factory=dict)
    history: tuple[dict, ...] = ()

    def transform(self, df: DataFrame, out: str = "prediction", spread_by: list[str] | None = None) -> DataFrame:
        """Add ``expected`` (weight of the classifiers that say 1), the prediction drawn from it,
        and ``pseudo_probability``, which is fixed at 0.8 or 0.2 by the prediction."""
        require_columns(df, [self.id_col])
        ready = self.prep.transform(df, spread_by or [self.id_col])
        scored = mixed_votes(ready, self.prep.names(), self.scorers, self.weights, "expected")
        drawn = scored.withColumn(
            out, (F.col("expected") >= hash_uniform(self.seed, ref(self.id_col).cast("string"))).cast("int")
        )
        return drawn.withColumn(
            "pseudo_probability", F.when(F.col(out) == 1, F.lit(PSEUDO_HIGH)).otherwise(F.lit(PSEUDO_LOW))
        ).drop(*self.prep.names())

    def fairness_info(self) -> dict:
        return dict(self.info)

    def save(self, path: str) -> None:
        extra = {
            "weights": list(self.weights),
            "sensitive": list(self.sensitive),
            "id_col": self.id_col,
            "seed": self.seed,
            "history": list(self.history),
        }
        _save(path, "reduction", self.prep, self.scorers, self.info, extra)


@dataclass(frozen=True)
class ThresholdedModel:
    """An unconstrained classifier with its own decision threshold per group."""

    prep: FeaturePrep
    scorer: LinearScorer | ConstantScorer | ForestScorer
    thresholds: ThresholdModel
    sensitive: tuple[str, ...]
    info: dict = field(default_factory=dict)

    def transform(self, df: DataFrame, out: str = "prediction", spread_by: list[str] | None = None) -> DataFrame:
        """Add ``probability`` of class 1 and the prediction by the group's threshold."""
        ready = self.prep.transform(df, spread_by)
        scored = self.scorer.with_scores(ready, self.prep.names(), "__hard", "probability")
        scored = scored.drop("__hard", *self.prep.names())
        return apply_thresholds(scored, "probability", self.thresholds, out, spread_by=spread_by)

    def fairness_info(self) -> dict:
        return dict(self.info)

    def save(self, path: str) -> None:
        extra = {"sensitive": list(self.sensitive), "null_token": self.thresholds.null_token}
        _save(path, "thresholds", self.prep, [self.scorer], self.info, extra)
        self.thresholds.table.df.write.mode("overwrite").parquet(f"{path}/thresholds")


def mixed_votes(df: DataFrame, names: list[str], scorers, weights, out: str) -> DataFrame:
    """Weighted share of classifiers that predict 1.

    Linear members are summed in one expression; equal members are merged first. Forests are
    applied one after another.
    """
    merged: dict = {}
    for scorer, weight in zip(scorers, weights, strict=True):
        merged[scorer] = merged.get(scorer, 0.0) + weight
    total: Column = F.lit(0.0)
    scored, temporary = df, []
    for i, (scorer, weight) in enumerate(merged.items()):
        if isinstance(scorer, ConstantScorer):
            vote = F.lit(float(scorer.value))
        elif isinstance(scorer, LinearScorer):
            vote = (scorer.margin(names) > 0).cast("double")
        else:
            column = f"__vote{i}"
            scored = scorer.with_scores(scored, names, column)
            temporary.append(column)
            vote = F.col(column).cast("double")
        total = total + F.lit(float(weight)) * vote
    return scored.withColumn(out, F.least(total, F.lit(1.0))).drop(*temporary)


# ---- training --------------------------------------------------------------------------------


def _features_for(df: DataFrame, sensitive, label: str, keep: Iterable[str], features) -> list[str]:
    sensitive = list(sensitive)
    if features is not None:
        features = as_list(features)
        require_columns(df, features, "features")
        resolve_roles(df.select(*[ref(c) for c in dict.fromkeys([*sensitive, label, *features])]), sensitive, label)
        return features
    return list(resolve_roles(df, sensitive, label, keep).features)


def _prepare(df: DataFrame, label: str, features: list[str], null_code: int | None = None):
    """Check the label and fit the scaling in one pass; encodings take one more."""
    numeric, _ = split_types(df.schema, features)
    n, low, high, row = label_domain(df, label, StandardScaling.aggregates(numeric))
    scaling = StandardScaling.from_row(row, numeric)
    return n, low, high, FeaturePrep.fit(df, features, null_code, scaling)


def fit_baseline(
    df: DataFrame,
    label: str,
    sensitive: Iterable[str] | str,
    keep: Iterable[str] = (),
    base_estimator: str | BaseLearner = "LogisticRegression",
    features: Iterable[str] | None = None,
    weight: str | None = None,
) -> BaselineModel:
    """Train without the sensitive columns: scaled numbers, category codes, L2 logistic loss."""
    sensitive = as_list(sensitive)
    learner = _learner(base_estimator)
    features = _features_for(df, sensitive, label, [*keep, *([weight] if weight else [])], features)
    n, low, high, prep = _prepare(df, label, features, null_code=-1)
    info = _info("none", learner, sensitive, low, high)
    if low == high:
        return BaselineModel(prep, ConstantScorer(low), tuple(sensitive), info)
    weights = [ref(weight).cast("double").alias("__w")] if weight else []
    ready = _training_rows(prep.transform(df), prep, [ref(label).cast("double").alias("__y"), *weights])
    try:
        total = ready.agg(F.sum("__w")).first()[0] if weight else n
        scorer = learner.fit(ready, prep.names(), "__y", float(total), "__w" if weight else None)
    finally:
        ready.unpersist()
    return BaselineModel(prep, scorer, tuple(sensitive), {**info, "converged": getattr(scorer, "converged", True)})


def _training_rows(df: DataFrame, prep: FeaturePrep, columns: list[Column]) -> DataFrame:
    """The narrow numeric table the iterations read, kept in memory and on disk."""
    return df.select(*prep.names(), *columns).persist(StorageLevel.MEMORY_AND_DISK)


def _info(constraint: str, learner: BaseLearner, sensitive: list[str], low: int, high: int, **more) -> dict:
    return {
        "constraint": constraint,
        "base_estimator": learner.kind,
        "sensitive_features": list(sensitive),
        "classes": sorted({low, high}),
        "is_fitted": True,
        **more,
    }


@dataclass(frozen=True)
class FairThresholds:
    """Threshold optimisation after unconstrained training; with ``error`` from sketches in one pass."""

    sensitive: tuple[str, ...]
    base_estimator: str | BaseLearner = "LogisticRegression"
    keep: tuple[str, ...] = ()
    features: tuple[str, ...] | None = None
    error: float | None = None

    def fit(
        self, df: DataFrame, label: str, spread_by: list[str] | None = None, weight: str | None = None
    ) -> ThresholdedModel:
        learner = _learner(self.base_estimator)
        keep = [*self.keep, *([weight] if weight else [])]
        features = _features_for(df, self.sensitive, label, keep, self.features)
        n, low, high, prep = _prepare(df, label, features)
        attrs = [ref(a).alias(f"__a{i}") for i, a in enumerate(self.sensitive)]
        weights = [ref(weight).cast("double").alias("__w")] if weight else []
        columns = [ref(label).cast("double").alias("__y"), *weights, *attrs]
        ready = _training_rows(prep.transform(df, spread_by), prep, columns)
        try:
            total = ready.agg(F.sum("__w")).first()[0] if weight else n
            scorer = (
                ConstantScorer(low)
                if low == high
                else learner.fit(ready, prep.names(), "__y", float(total), "__w" if weight else None)
            )
            scored = scorer.with_scores(ready, prep.names(), "__hard", "__score").select(
                "__score", "__y", *[F.col(f"__a{i}").alias(a) for i, a in enumerate(self.sensitive)]
            )
            if self.error is None:
                thresholds = fit_thresholds(scored, "__score", "__y", list(self.sensitive))
            else:
                thresholds = fit_thresholds_approx(scored, "__score", "__y", list(self.sensitive), self.error)
        finally:
            ready.unpersist()
        info = _info("demographic_parity", learner, list(self.sensitive), low, high, strategy="group thresholds")
        info["converged"] = getattr(scorer, "converged", True)
        return ThresholdedModel(prep, scorer, thresholds, tuple(self.sensitive), info)


@dataclass(frozen=True)
class FairReduction:
    """Training under a fairness constraint by exponentiated gradient.

    Each iteration fits the classifier that answers the present multipliers, from the coefficients of the last
    one, and then looks for the weights of all classifiers so far, and of the two constants, that keep every difference within
    ``tolerance`` (``eps`` by default) with the least error. So from the second iteration on the mixture is within
    the tolerance, and further iterations lower its error, until it has settled or ``max_iter`` is reached. A first classifier
    within the tolerance is taken alone. If the tolerance is not reached, ``fairness_info`` has ``converged`` false, and it is logged, or an
    error with ``on_unconverged="raise"``. The sensitive columns are constrained in combination, any number of them (over
    ``games.FEW_GROUPS`` their state is a table), and are not features, so error rises as the gap falls. ``reweighting`` weighs the
    error of each (group, label) cell so that label and group are independent.
    """

    sensitive: tuple[str, ...]
    constraint: str = "demographic_parity"
    id_col: str = "id"
    base_estimator: str | BaseLearner = "LogisticRegression"
    keep: tuple[str, ...] = ()
    features: tuple[str, ...] | None = None
    eps: float = 0.01
    eta0: float = 60.0
    max_iter: int = 20
    tolerance: float | None = None
    reweighting: bool = False
    seed: int = 42
    on_unconverged: str = "warn"

    def __post_init__(self) -> None:
        if self.on_unconverged not in ("warn", "raise"):
            raise ValueError(f"unconverged training warns or raises; not {self.on_unconverged!r}")
        if self.constraint not in CONSTRAINTS:
            raise ValueError(f"Unknown constraint: {self.constraint}")
        if not self.sensitive:
            raise ValueError("sensitive_features must be provided")

    def fit(self, df: DataFrame, label: str) -> ReductionModel:
        learner = _learner(self.base_estimator)
        require_columns(df, [self.id_col])
        features = _features_for(df, self.sensitive, label, [*self.keep, self.id_col], self.features)
        n, low, high, prep = _prepare(df, label, features)
        info = _info(self.constraint, learner, list(self.sensitive), low, high, strategy="reduction")
        spread = [self.id_col]
        if low == high:
            return ReductionModel(
                prep, (ConstantScorer(low),), (1.0,), tuple(self.sensitive), self.id_col, self.seed, info
            )
        groups, n_groups = _group_index(df, list(self.sensitive))
        keyed = attach(
            df.withColumns({f"__k{i}": _key_text(df, s) for i, s in enumerate(self.sensitive)}),
            groups,
            [f"__k{i}" for i in range(len(self.sensitive))],
            spread,
        )
        y = ref(label).cast("int")
        ready = _training_rows(prep.transform(keyed, spread), prep, [y.alias("__y"), F.col("__g")])
        try:
            kind = Few if groups.bounded else Many
            game = kind(ready, n_groups, self.constraint, self.reweighting)
            scorers, weights, gap, history = self._iterate(ready, prep.names(), learner, game, n)
        finally:
            ready.unpersist()
        tolerance = self.eps if self.tolerance is None else self.tolerance
        info |= {"converged": gap <= tolerance, "gap": gap, "iterations": len(history)}
        info["fits_converged"] = all(getattr(s, "converged", True) for s in scorers)
        if gap > tolerance:
            message = f"gap {gap:.4f} after {len(history)} iterations, the tolerance is {tolerance}"
            if self.on_unconverged == "raise":
                raise RuntimeError(message)
            log.warning(message)
        return ReductionModel(
            prep, scorers, weights, tuple(self.sensitive), self.id_col, self.seed, info, tuple(history)
        )

    def _iterate(self, ready: DataFrame, names: list[str], learner: BaseLearner, game: Few | Many, n: int):
        """Scorers with their weights, the gap of the mixture, and what happened at each iteration."""
        tolerance = self.eps if self.tolerance is None else self.tolerance
        bound = 1.0 / self.eps
        constants = self._constant_errors(game)
        scorers, errors, history = [], [], []
        weights, gap, settled = None, 0.0, 0
        for step in range(self.max_iter):
            weighting = game.weighting(bound)
            scorer = self._best_response(ready, names, learner, weighting, scorers, float(n))
            own, error = game.record(scorer.with_scores(ready, names, "__h"))
            scorers.append(scorer)
            errors.append(error)
            if step == 0:
                # the multipliers have not spoken yet: the classifier stands for itself
                weights, gap, mixed = np.array([0.0, 0.0, 1.0]), own, error
                done = own <= tolerance
            else:
                before = mixed
                weights, gap, mixed = mix(game, errors, constants, tolerance, weights if step > 1 else None)
                settled = settled + 1 if step > 1 and before - mixed < SETTLED else 0
                done = step + 1 >= LEAST_ITERATIONS and settled >= PATIENCE
            history.append({"iteration": step + 1, "gap": gap, "error": mixed, "iterate_gap": own, "iterate_error": error})
            if done:
                break
            game.move(self.eta0 / bound, self.eps)
        members = [ConstantScorer(0), ConstantScorer(1), *scorers]
        kept = [(m, float(w)) for m, w in zip(members, weights, strict=True) if w > 0]
        return tuple(m for m, _ in kept), tuple(w for _, w in kept), gap, history

    @staticmethod
    def _constant_errors(game: Few | Many) -> tuple[float, float]:
        """Errors of always 0 and always 1."""
        if isinstance(game, Few):
            wrong = (game.moments.weight * game.moments.counts).sum(axis=0) / game.moments.n
        else:
            wrong = [v / game.n for v in game.state.agg(F.sum(F.col("w0") * F.col("c0")), F.sum(F.col("w1") * F.col("c1"))).first()]
        return float(wrong[1]), float(wrong[0])

    def _best_response(self, ready, names, learner, weighting, scorers, n: float):
        """The classifier that is cheapest under the weights of the cells, starting from the last linear one."""
        if weighting.constant is not None:
            return ConstantScorer(int(weighting.constant))
        weighted = weighting.of(ready, names)
        # a shuffle join is made once for all steps of the fit
        many = weighting.table is not None and not weighting.table.bounded
        if many:
            weighted = weighted.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if learner.kind != "LogisticRegression":
                return learner.fit(weighted, names, "__label", n, "__weight")
            linear = [s for s in scorers if isinstance(s, LinearScorer)]
            start = np.array([*linear[-1].coefficients, linear[-1].intercept]) if linear else None
            tol = max(learner.tol, ANSWER_TOL)
            fit = fit_newton(weighted, names, F.col("__label"), F.col("__weight"), n, 1.0 / (learner.c * n), start, tol)
            return LinearScorer(fit.intercept, fit.coefficients, fit.converged, 1, fit.gradient)
        finally:
            if many:
                weighted.unpersist()


def _key_text(df: DataFrame, column: str) -> Column:
    return F.coalesce(F.concat(F.lit("v"), group_text(df, column)), F.lit("n"))


def _group_index(df: DataFrame, sensitive: list[str]) -> tuple[GroupTable, int]:
    """Number the combinations of sensitive values, and how many there are; a missing value is a value of its own."""
    keys = [f"__k{i}" for i in range(len(sensitive))]
    combos = df.select(*[_key_text(df, s).alias(k) for s, k in zip(sensitive, keys, strict=True)]).distinct()
    table = pin(combos, games.FEW_GROUPS)
    if not table.bounded:
        numbered = cut_lineage(table.df.withColumn("__g", F.monotonically_increasing_id()))
        return GroupTable(numbered, False), numbered.count()
    ordered = sorted(tuple(r[k] for k in keys) for r in table.rows)
    schema = ", ".join(f"{k} string" for k in keys) + ", __g int"
    indexed = local_table(df.sparkSession, [(*combo, i) for i, combo in enumerate(ordered)], schema, games.FEW_GROUPS)
    return from_rows(indexed.df, indexed.df.toArrow()), len(ordered)


# ---- persistence -----------------------------------------------------------------------------


def _save(path: str, kind: str, prep: FeaturePrep, scorers, info: dict, extra: dict) -> None:
    """Parquet tables for encodings and linear members, ML format for forests, one metadata row."""
    codes = prep.coding.codes.df
    spark = codes.sparkSession
    members = []
    distinct = list(dict.fromkeys(scorers))
    for i, scorer in enumerate(distinct):
        if isinstance(scorer, ForestScorer):
            scorer.model.write().overwrite().save(f"{path}/forest_{i}")
            members.append({"forest": i})
        else:
            members.append(asdict(scorer))
    meta = {
        "kind": kind,
        "features": list(prep.features),
        "means": dict(prep.scaling.means),
        "deviations": dict(prep.scaling.deviations),
        "coded": list(prep.coding.columns),
        "null_code": -1 if isinstance(prep.coding, CategoryCodes) else None,
        "members": members,
        "order": [distinct.index(s) for s in scorers],
        "info": info,
        **extra,
    }
    codes.write.mode("overwrite").parquet(f"{path}/codes")
    spark.createDataFrame([(json.dumps(meta),)], "metadata string").write.mode("overwrite").parquet(
        f"{path}/metadata"
    )


def load_model(spark: SparkSession, path: str) -> BaselineModel | ReductionModel | ThresholdedModel:
    """Load a saved classifier, for scoring in another job."""
    meta = json.loads(spark.read.parquet(f"{path}/metadata").first()["metadata"])
    codes = pin(spark.read.parquet(f"{path}/codes"))
    if meta["null_code"] == -1:
        coding = CategoryCodes.from_codes(meta["coded"], codes)
    else:
        coding = LabelEncoding.from_codes(meta["coded"], codes)
    prep = FeaturePrep(tuple(meta["features"]), StandardScaling(meta["means"], meta["deviations"]), coding)
    members = []
    for m in meta["members"]:
        if "forest" in m:
            members.append(ForestScorer(RandomForestClassificationModel.load(f"{path}/forest_{m['forest']}")))
        elif "value" in m:
            members.append(ConstantScorer(m["value"]))
        else:
            members.append(LinearScorer(m["intercept"], tuple(m["coefficients"]), m.get("converged", True), m.get("attempts", 1), m.get("gradient")))
    scorers = [members[i] for i in meta["order"]]
    sensitive, info = tuple(meta["sensitive"]), meta["info"]
    if meta["kind"] == "baseline":
        return BaselineModel(prep, scorers[0], sensitive, info)
    if meta["kind"] == "thresholds":
        table = pin(spark.read.parquet(f"{path}/thresholds"))
        thresholds = ThresholdModel(sensitive, table, meta["null_token"])
        return ThresholdedModel(prep, scorers[0], thresholds, sensitive, info)
    return ReductionModel(
        prep,
        tuple(scorers),
        tuple(meta["weights"]),
        sensitive,
        meta["id_col"],
        meta["seed"],
        info,
        tuple(meta["history"]),
    )
