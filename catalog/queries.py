"""The registered queries: each runs one operator over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import evenhand as eh
from catalog.inputs import LI_KEY, SEGMENT_FACTORS, docs, ev, li, scored, scored_nulls, table
from evenhand.functions.expressions import hash_uniform, logistic
from evenhand.operators.features import FeaturePrep
from evenhand.operators.learners import BaseLearner, ConstantScorer
from evenhand.operators.lookup import attach, pin
from evenhand.operators.thresholds import apply_thresholds, fit_thresholds, fit_thresholds_approx
from evenhand.operators.training import ReductionModel
from evenhand.plans.run import run_fairness
from evenhand.plans.settings import RunSettings
from evenhand.session import ensure_checkpoint_dir
from evenhand.sources.sinks import (
    StagedRun,
    group_proportions,
    group_size_summary,
    group_statistics,
    read_runs,
    run_metrics,
    run_params,
    write_report,
)
from evenhand.sources.tables import read_checked

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SEGMENT, PRIORITY, REGION = "c_mktsegment", "o_orderpriority", "n_regionkey"
FLAG, STATUS = "l_returnflag", "l_linestatus"


def register(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Round doubles, whose last digits depend on the order of summation."""
    return df.select(
        *[
            F.round(F.col(f.name), special.get(f.name, digits)).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


# ---- dataset audit ---------------------------------------------------------------------------


@register
def dataset_shape(spark, sf_dir):
    return eh.dataset_shape(li(spark, sf_dir))


@register
def missing_values(spark, sf_dir):
    return eh.missing_values(li(spark, sf_dir).withColumn(FLAG, F.nullif(FLAG, F.lit("R"))))


@register
def group_distribution(spark, sf_dir):
    return eh.group_distribution(scored_nulls(spark, sf_dir), SEGMENT)


@register
def target_rate_by_group(spark, sf_dir):
    return rounded(eh.target_rate(docs(spark, sf_dir), "source", "quality"))


@register
def target_rate_difference(spark, sf_dir):
    return rounded(eh.target_rate_difference(li(spark, sf_dir), FLAG, "label"))


@register
def dataset_audit(spark, sf_dir):
    return rounded(eh.audit_dataset(docs(spark, sf_dir), "lang", "quality"))


@register
def dataset_audit_unlabelled(spark, sf_dir):
    return rounded(eh.audit_dataset(scored_nulls(spark, sf_dir), SEGMENT))


@register
def rates_by_attribute(spark, sf_dir):
    return rounded(eh.rates_by_attribute(scored_nulls(spark, sf_dir), [SEGMENT, PRIORITY, REGION], "y_true"))


@register
def intersectional_rates(spark, sf_dir):
    return rounded(eh.intersectional_rates(scored_nulls(spark, sf_dir), [SEGMENT, PRIORITY], "y_true"))


@register
def rate_matrix(spark, sf_dir):
    return rounded(eh.rate_matrix(li(spark, sf_dir), FLAG, STATUS, "label", ["F", "O"]))


@register
def gap_summary(spark, sf_dir):
    return rounded(eh.gap_summary(scored_nulls(spark, sf_dir), [SEGMENT, PRIORITY], "y_true"))


# ---- prediction metrics ----------------------------------------------------------------------


@register
def confusion_cells(spark, sf_dir):
    return eh.confusion_cells(scored_nulls(spark, sf_dir), "y_true", "y_pred", SEGMENT)


@register
def performance_metrics(spark, sf_dir):
    return rounded(eh.performance_metrics(scored_nulls(spark, sf_dir), "y_true", "y_pred", SEGMENT))


@register
def performance_metrics_multiclass(spark, sf_dir):
    """Three price bands, foretold from the offer."""
    band = lambda c: F.when(F.col(c) < 90000, "low").when(F.col(c) < 210000, "middle").otherwise("high")
    rows = scored_nulls(spark, sf_dir).select(SEGMENT, band("o_totalprice").alias("y"), band("offer").alias("p"))
    return rounded(eh.performance_metrics(rows, "y", "p", SEGMENT))


@register
def selection_rate(spark, sf_dir):
    return rounded(eh.selection_rate(scored_nulls(spark, sf_dir), "y_true", "y_pred", SEGMENT))


@register
def demographic_parity(spark, sf_dir):
    return rounded(eh.demographic_parity_difference(scored_nulls(spark, sf_dir), "y_true", "y_pred", SEGMENT))


@register
def statistical_parity(spark, sf_dir):
    return rounded(eh.statistical_parity_difference(scored(spark, sf_dir), "y_true", "y_pred", PRIORITY))


@register
def group_tpr_fpr(spark, sf_dir):
    return rounded(eh.group_rates(scored(spark, sf_dir), "y_true", "y_pred", SEGMENT))


@register
def equalized_odds(spark, sf_dir):
    return rounded(eh.equalized_odds_difference(scored(spark, sf_dir), "y_true", "y_pred", SEGMENT))


@register
def equal_opportunity(spark, sf_dir):
    return rounded(eh.equal_opportunity_difference(scored(spark, sf_dir), "y_true", "y_pred", SEGMENT))


@register
def all_metrics(spark, sf_dir):
    return rounded(eh.all_metrics(scored(spark, sf_dir), "y_true", "y_pred", SEGMENT))


@register
def prediction_audit(spark, sf_dir):
    return rounded(eh.audit_predictions(scored(spark, sf_dir), "y_true", "y_pred", SEGMENT))


@register
def prediction_audit_multi(spark, sf_dir):
    return rounded(
        eh.audit_predictions(scored_nulls(spark, sf_dir), "y_true", "y_pred", [SEGMENT, PRIORITY, REGION])
    )


@register
def fairness_status(spark, sf_dir):
    audit = eh.audit_predictions(
        scored(spark, sf_dir),
        "y_true",
        "y_pred",
        [SEGMENT, PRIORITY],
        additional=["equal_opportunity_difference", "statistical_parity_difference"],
    )
    return rounded(eh.report_table(audit))


@register
def violation_count(spark, sf_dir):
    return eh.violation_count(eh.audit_predictions(scored(spark, sf_dir), "y_true", "y_pred", [SEGMENT, PRIORITY]))


# ---- comparison ------------------------------------------------------------------------------


def _two_reports(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Reports of two prediction rules, from one pass over the rows."""
    rules = F.array(
        F.struct(F.lit("before").alias("rule"), F.col("y_pred").alias("p")),
        F.struct(F.lit("after").alias("rule"), F.col("y_pred2").alias("p")),
    )
    rows = scored(spark, sf_dir).select("y_true", SEGMENT, F.inline(rules))
    report = pin(eh.all_metrics(rows, "y_true", "p", SEGMENT, by=["rule"])).df.select("rule", "metric", "value")
    return report.filter("rule = 'before'").drop("rule"), report.filter("rule = 'after'").drop("rule")


@register
def compare_performance(spark, sf_dir):
    return rounded(eh.compare_performance(*_two_reports(spark, sf_dir)))


@register
def compare_fairness(spark, sf_dir):
    return rounded(eh.compare_fairness(*_two_reports(spark, sf_dir), "equalized_odds_difference"))


@register
def goal_verdict(spark, sf_dir):
    fairness = eh.compare_fairness(*_two_reports(spark, sf_dir), "demographic_parity_difference")
    return rounded(eh.verdict(eh.goal_summary(fairness, 0.1)))


@register
def comparison_series(spark, sf_dir):
    return rounded(eh.comparison_series(*_two_reports(spark, sf_dir), "fairness", 0.1))


@register
def comparison_series_performance(spark, sf_dir):
    return rounded(eh.comparison_series(*_two_reports(spark, sf_dir), "performance"))


@register
def run_metric_rows(spark, sf_dir):
    base, final = _two_reports(spark, sf_dir)
    return rounded(run_metrics(base, None, final, "demographic_parity_difference", "run-1"))


# ---- split, cleaning, features ---------------------------------------------------------------


@register
def stratified_split(spark, sf_dir):
    return eh.stratified_split(scored(spark, sf_dir).select("id", "y_true"), "id", "y_true")


@register
def split_summary(spark, sf_dir):
    rows = scored(spark, sf_dir).select("id", "y_true")
    return rounded(eh.split_summary(eh.stratified_split(rows, "id", "y_true", test=0.25, val=0.15, seed=7)))


@register
def ffill_bfill(spark, sf_dir):
    return eh.ffill_bfill(ev(spark, sf_dir), ["value"], ["ts", "event_id"], ["user_id"])


@register
def ffill_bfill_global(spark, sf_dir):
    return eh.ffill_bfill(ev(spark, sf_dir), ["value"], ["ts", "event_id"])


@register
def clip(spark, sf_dir):
    return eh.clip(li(spark, sf_dir), "l_quantity", 5.0, 40.0).select(*LI_KEY, "l_quantity")


@register
def scale_by_group(spark, sf_dir):
    rows = scored_nulls(spark, sf_dir).select("id", SEGMENT, "o_totalprice")
    return rounded(eh.scale_by_group(rows, "o_totalprice", SEGMENT, SEGMENT_FACTORS), 4)


@register
def logistic_score(spark, sf_dir):
    """How likely an order line is to be returned late: long shipping, large discounts, one mode."""
    shipped = table(spark, sf_dir, "lineitem").select(*LI_KEY, "l_quantity", "l_discount", "l_tax", STATUS)
    out = eh.logistic_score(
        shipped,
        {"l_quantity": -0.035, "l_discount": 11.0, "l_tax": 4.5},
        intercept=0.8,
        centers={"l_discount": "mean", "l_quantity": 20.0},
        indicators=[({STATUS: "O", "l_linenumber": 1}, -0.7), ({"l_linenumber": 7}, 1.1)],
    )
    return rounded(out.select(*LI_KEY, "score"))


def _flag_rows(spark, sf_dir) -> DataFrame:
    """Order lines with a missing and (for an encoding fitted without it) an unseen flag."""
    return li(spark, sf_dir).select(*LI_KEY, F.nullif(FLAG, F.lit("A")).alias(FLAG), STATUS)


@register
def label_encode(spark, sf_dir):
    rows = _flag_rows(spark, sf_dir)
    encoding = eh.LabelEncoding.fit(rows, [FLAG, STATUS])
    return encoding.transform(rows)


@register
def label_unseen(spark, sf_dir):
    rows = li(spark, sf_dir).select(*LI_KEY, FLAG)
    encoding = eh.LabelEncoding.fit(rows.filter(F.col(FLAG) != "R"), [FLAG])
    return encoding.transform(rows)


@register
def label_roundtrip(spark, sf_dir):
    rows = _flag_rows(spark, sf_dir)
    encoding = eh.LabelEncoding.fit(rows, [FLAG])
    shifted = encoding.transform(rows).withColumn(FLAG, F.col(FLAG) + F.col("l_linenumber") * 0.5 - 1)
    return encoding.inverse_transform(shifted)


@register
def category_codes(spark, sf_dir):
    rows = _flag_rows(spark, sf_dir)
    return eh.CategoryCodes.fit(rows, [FLAG, STATUS]).transform(rows)


@register
def standard_scale(spark, sf_dir):
    rows = li(spark, sf_dir).select(*LI_KEY, "l_quantity", "l_extendedprice")
    return rounded(eh.StandardScaling.fit(rows, ["l_quantity", "l_extendedprice"]).transform(rows))


@register
def assembled_features(spark, sf_dir):
    features = ["l_extendedprice", FLAG, "l_quantity"]
    rows = li(spark, sf_dir).select(
        *LI_KEY, "l_quantity", "l_extendedprice", F.nullif(FLAG, F.lit("A")).alias(FLAG)
    )
    prep = eh.FeaturePrep.fit(rows, features)
    vector = vector_to_array(F.col("features"))
    return rounded(
        prep.assemble(prep.transform(rows)).select(*LI_KEY, *[vector[i].alias(f"x{i}") for i in range(3)])
    )


# ---- repair ----------------------------------------------------------------------------------


def _repair_rows(spark, sf_dir, *features) -> DataFrame:
    return li(spark, sf_dir).select(*LI_KEY, *features, FLAG, STATUS)


def _repair(method, level, attrs, keep, **more) -> eh.GroupRepair:
    return eh.GroupRepair(tuple(attrs), method, level, keep=tuple(keep), **more)


@register
def csv_checked_rows(spark, sf_dir):
    """Orders as lines of text, some cut short and some with a price that is no number: what is accepted and what is not."""
    price = F.when(F.col("o_orderkey") % 101 == 0, F.lit("many")).otherwise(F.format_string("%.2f", "o_totalprice"))
    whole = F.concat_ws(",", F.col("o_orderkey").cast("string"), price, F.col("o_orderpriority"))
    line = F.when(F.col("o_orderkey") % 97 == 0, F.substring_index(whole, ",", 2)).otherwise(whole)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/evenhand-lines-{uuid.uuid4().hex}"
    table(spark, sf_dir, "orders").select(line.alias("line")).write.text(path)
    checked = read_checked(spark, path, "id bigint, price double, priority string", header=False)
    good = checked.rows.groupBy("priority").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("price"), 2).alias("total"))
    bad = checked.rejected.select(F.when(F.contains("line", F.lit("many")), "no number").otherwise("too short").alias("priority"))
    return good.unionByName(bad.groupBy("priority").agg(F.count(F.lit(1)).alias("n"), F.lit(None).cast("double").alias("total")))


@register
def run_param_rows(spark, sf_dir):
    """Parameters of a run, written and read back: settings, and what the table says about itself."""
    sizes = {r["o_orderpriority"]: r["n"] for r in table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")).collect()}
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/evenhand-runs-{uuid.uuid4().hex}"
    params = {"data": {"sizes": sizes}, "training": {"attributes": [SEGMENT, PRIORITY], "seed": None}}
    with StagedRun(spark, root, "run-1") as out:
        write_report(run_params(spark, params, "run-1").drop("run_id"), out.path("params/run_id=run-1"))
    return read_runs(spark, root, "params").select("run_id", "key", "value")


@register
def group_statistics_rows(spark, sf_dir):
    """Statistics of the groups of a fitted repair, written as a run and read back."""
    rows = li(spark, sf_dir).select("l_quantity", "l_tax", FLAG)
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/evenhand-runs-{uuid.uuid4().hex}"
    stats = group_statistics(_repair("mean_matching", 1.0, [FLAG], []).fit(rows).group_stats(), "run-1")
    with StagedRun(spark, root, "run-1") as out:
        write_report(stats.drop("run_id"), out.path("group_statistics/run_id=run-1"))
    return rounded(read_runs(spark, root, "group_statistics").select("run_id", "attr", "group", "feature", "statistic", "value"))


@register
def group_stats(spark, sf_dir):
    rows = li(spark, sf_dir).select("l_quantity", "l_extendedprice", "l_discount", FLAG, STATUS)
    return rounded(_repair("mean_matching", 1.0, [FLAG, STATUS], []).fit(rows).group_stats(), 4)


@register
def overall_means(spark, sf_dir):
    rows = li(spark, sf_dir).select("l_quantity", "l_extendedprice", "l_discount", FLAG)
    return rounded(_repair("mean_matching", 1.0, [FLAG], []).fit(rows).overall_means(), 4)


def _covariance_fit(spark, sf_dir) -> eh.GroupRepairModel:
    tax = F.when(F.col(FLAG) != "R", F.col("l_tax")).otherwise(F.nullif("l_tax", F.lit(0.04)))
    rows = li(spark, sf_dir).select("l_quantity", "l_discount", tax.alias("l_tax"), FLAG)
    return _repair("covariance_matching", 1.0, [FLAG], []).fit(rows)


@register
def group_covariance(spark, sf_dir):
    return rounded(_covariance_fit(spark, sf_dir).group_cov())


@register
def overall_covariance(spark, sf_dir):
    return rounded(_covariance_fit(spark, sf_dir).overall_cov())


@register
def group_covariance_wide(spark, sf_dir):
    """30 features, above what one expression sums: outer products added up by the tasks."""
    wide = [(F.col("l_quantity") * i + F.col("l_tax") * (100 * (i % 3))).alias(f"f{i:02d}") for i in range(1, 31)]
    rows = li(spark, sf_dir).select(*wide, FLAG)
    return rounded(_repair("covariance_matching", 1.0, [FLAG], []).fit(rows).group_cov(), 4)


def _segment_stats(spark, sf_dir) -> DataFrame:
    rows = scored_nulls(spark, sf_dir).select("o_totalprice", "c_acctbal", SEGMENT, PRIORITY)
    return _repair("mean_matching", 1.0, [SEGMENT, PRIORITY], []).fit(rows).group_stats()


@register
def group_sizes(spark, sf_dir):
    return rounded(group_size_summary(_segment_stats(spark, sf_dir)))


@register
def group_shares(spark, sf_dir):
    return rounded(group_proportions(_segment_stats(spark, sf_dir)))


@register
def repair_mean(spark, sf_dir):
    rows = _repair_rows(spark, sf_dir, "l_quantity", "l_extendedprice").withColumn(FLAG, F.nullif(FLAG, F.lit("N")))
    model = _repair("mean_matching", 0.8, [FLAG], [*LI_KEY, STATUS]).fit(rows)
    return rounded(model.transform(rows), 4)


@register
def repair_mean_two_attrs(spark, sf_dir):
    rows = _repair_rows(spark, sf_dir, "l_quantity", "l_extendedprice")
    model = _repair("mean_matching", 1.0, [FLAG, STATUS], LI_KEY).fit(rows)
    return rounded(model.transform(rows), 4)


@register
def repair_mean_integer(spark, sf_dir):
    """Integers with a clear group difference, rounded after each of two attributes."""
    rows = _integer_rows(spark, sf_dir)
    model = _repair("mean_matching", 0.7, [FLAG, STATUS], LI_KEY).fit(rows)
    return model.transform(rows)


def _integer_rows(spark, sf_dir) -> DataFrame:
    flagged = F.when(F.col(FLAG) == "R", 5).otherwise(0)
    filled = F.when(F.col(STATUS) == "F", 2).otherwise(0)
    amount = F.col("l_linenumber") * 3 + flagged + filled
    return li(spark, sf_dir).select(*LI_KEY, amount.cast("int").alias("amount"), FLAG, STATUS)


@register
def repair_mean_digest(spark, sf_dir):
    """Group means after a full repair of a biased feature all equal the population mean; rows
    without a group stay as they are."""
    rows = scored_nulls(spark, sf_dir).select(
        "id", SEGMENT, (F.col("o_totalprice") * F.when(F.col(SEGMENT) == "AUTOMOBILE", 1.5).otherwise(1.0)).alias("price")
    )
    fixed = _repair("mean_matching", 1.0, [SEGMENT], ["id"]).fit(rows).transform(rows)
    return rounded(
        fixed.groupBy(SEGMENT).agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("price").alias("mean_price"),
            F.min("price").alias("min_price"),
            F.max("price").alias("max_price"),
        ),
        3,
    )


@register
def repair_covariance(spark, sf_dir):
    """Fitted on the table as it is, applied to rows with other spreads."""
    rows = _repair_rows(spark, sf_dir, "l_quantity", "l_discount").drop(STATUS)
    model = _repair("covariance_matching", 0.6, [FLAG], LI_KEY).fit(rows)
    changed = rows.withColumn("l_quantity", F.col("l_quantity") * 1.5).withColumn(
        "l_discount", F.col("l_discount") * F.when(F.col(FLAG) == "A", 0.7).otherwise(3.0)
    )
    return rounded(model.transform(changed))


@register
def repair_multivariate_full(spark, sf_dir):
    rows = _repair_rows(spark, sf_dir, "l_quantity", "l_discount", "l_tax").drop(STATUS)
    return rounded(_repair("multivariate_repair", 1.0, [FLAG], LI_KEY).fit(rows).transform(rows))


@register
def repair_multivariate_noise(spark, sf_dir):
    rows = scored(spark, sf_dir).select("id", SEGMENT, "o_totalprice", "c_acctbal")
    return rounded(_repair("multivariate_repair", 0.5, [SEGMENT], [], id_col="id").fit(rows).transform(rows), 4)


@register
def repair_covariance_four(spark, sf_dir):
    """Four features, whose determinant has no closed form here, next to a category that is left alone."""
    rows = _repair_rows(spark, sf_dir, "l_quantity", "l_extendedprice", "l_discount", "l_tax").withColumn(
        "kind", F.when(F.col("l_linenumber") > 3, "late").otherwise("early")
    )
    model = _repair("covariance_matching", 0.6, [FLAG], [*LI_KEY, STATUS, "kind"]).fit(rows)
    return rounded(model.transform(rows.withColumns({"l_quantity": F.col("l_quantity") * 1.5, "l_tax": F.col("l_tax") * 0.8})))


@register
def repair_categories(spark, sf_dir):
    """Multivariate repair shifts category codes as well and decodes them."""
    rows = _repair_rows(spark, sf_dir, "l_quantity").withColumn(
        "kind", F.when(F.col(FLAG) == "R", F.lit("c")).when(F.col("l_linenumber") > 3, F.lit("b")).otherwise(F.lit("a"))
    )
    keep = [*LI_KEY, STATUS]
    return rounded(_repair("multivariate_repair", 1.0, [FLAG], keep).fit(rows).transform(rows))


@register
def reweighing(spark, sf_dir):
    rows = docs(spark, sf_dir).select("doc_id", "lang", "quality")
    return rounded(eh.reweigh(rows, "lang", "quality"))


# ---- thresholds and models -------------------------------------------------------------------


@register
def fit_group_thresholds(spark, sf_dir):
    model = fit_thresholds(scored_nulls(spark, sf_dir), "score", "y_pred", [SEGMENT, PRIORITY])
    return rounded(model.thresholds())


@register
def fit_group_thresholds_dirty(spark, sf_dir):
    """Scores that are missing, infinite, or of very different magnitudes."""
    n, score = F.col("id") % 11, F.col("score")
    dirty = (
        F.when(n == 0, F.lit(float("nan")))
        .when(n == 1, F.lit(float("inf")))
        .when(n == 2, F.lit(float("-inf")))
        .when(n == 3, score * 1e-300)
        .when(n == 4, score * -1e250)
        .otherwise(score)
    )
    # rows without a score have no label here either
    label = F.when(n != 0, F.col("y_pred"))
    rows = scored_nulls(spark, sf_dir).withColumns({"score": dirty, "y_pred": label})
    return fit_thresholds(rows, "score", "y_pred", [SEGMENT, PRIORITY]).thresholds()


@register
def fit_group_thresholds_approx(spark, sf_dir):
    """Thresholds from sketches: each group's selection rate against the closest one, within the stated error."""
    rows = scored_nulls(spark, sf_dir).withColumn("score", F.col("o_totalprice") / 600_000)
    attrs, error = [SEGMENT, PRIORITY], 0.002
    exact = fit_thresholds(rows, "score", "y_pred", attrs)
    model = fit_thresholds_approx(rows, "score", "y_pred", attrs, error)
    rate = rows.agg(F.avg("y_pred").alias("rate"))
    pairs = F.inline(F.array(*[F.struct(F.lit(a).alias("attr"), F.coalesce(a, F.lit("nan")).alias("group")) for a in attrs]))
    near = attach(rows.select("score", pairs), model.table.narrow("attr", "group", "threshold"), ["attr", "group"])
    taken = near.groupBy("attr", "group").agg(F.avg((F.col("score") >= F.col("threshold")).cast("double")).alias("taken"))
    joined = attach(taken, exact.table, ["attr", "group"]).crossJoin(F.broadcast(rate))
    farther = F.abs(F.col("taken") - F.col("rate")) - F.abs(F.col("selected") / F.col("n") - F.col("rate"))
    return joined.select("attr", "group", "n", (farther <= error).alias("within_error"))


@register
def ffill_bfill_pieces(spark, sf_dir):
    """Cut into many ranges: text and ties in the first order column, one value in half of the rows."""
    rows = ev(spark, sf_dir).withColumn("kind", F.when(F.col("event_id") % 2 == 0, "even").otherwise(F.col("event_type")))
    filled = eh.ffill_bfill(rows, ["value"], ["kind", "event_id"], ["user_id"], rows_per_task=400)
    return filled.select("event_id", "user_id", "kind", "value")


@register
def threshold_predict(spark, sf_dir):
    rows = scored_nulls(spark, sf_dir).select("id", SEGMENT, REGION, "score", "y_pred")
    model = fit_thresholds(rows, "score", "y_pred", [REGION, SEGMENT], null_token=None)
    return apply_thresholds(rows, "score", model, unseen="none").select("id", "prediction")


def _model_rows(spark, sf_dir) -> DataFrame:
    """Two labels; the feature ``offer`` carries the segment into the models."""
    return scored(spark, sf_dir).select("id", SEGMENT, PRIORITY, "offer", "c_acctbal", "y_true", "y_pred")


FEATURES = ("offer", "c_acctbal")


@register
def baseline_model_audit(spark, sf_dir):
    rows = _model_rows(spark, sf_dir)
    model = eh.fit_baseline(rows, "y_pred", [SEGMENT], features=FEATURES)
    return eh.audit_predictions(model.transform(rows, "prediction", ["id"]), "y_pred", "prediction", SEGMENT)


@register
def baseline_model_gradient(spark, sf_dir):
    """The gradient of the penalised loss at the fitted coefficients: zero for each of them."""
    rows = _model_rows(spark, sf_dir)
    model = eh.fit_baseline(rows, "y_pred", [SEGMENT], features=FEATURES)
    names, scorer = model.prep.names(), model.scorer
    error = logistic(scorer.margin(names)) - F.col("y_pred")
    slopes = {
        feature: F.avg(error * F.col(name)) + F.lit(weight) / F.count(F.lit(1))
        for feature, name, weight in zip(FEATURES, names, scorer.coefficients, strict=True)
    }
    parts = [F.struct(F.lit(f).alias("feature"), F.abs(F.round(g, 3)).alias("gradient")) for f, g in slopes.items()]
    parts.append(F.struct(F.lit("intercept").alias("feature"), F.abs(F.round(F.avg(error), 3)).alias("gradient")))
    return model.prep.transform(rows).agg(F.array(*parts).alias("g")).select(F.inline("g"))


@register
def retried_fit(spark, sf_dir):
    """A fit that always runs out of iterations, and one that does not: attempts, outcome, and the gradient it reports."""
    rows = _model_rows(spark, sf_dir)
    n, out = rows.count(), None
    for name, learner in (("hasty", BaseLearner(max_iter=1, max_retries=3, tol=1e-12)), ("patient", BaseLearner(max_iter=200, tol=1e-9))):
        model = eh.fit_baseline(rows, "y_pred", [SEGMENT], features=FEATURES, base_estimator=learner)
        names, scorer = model.prep.names(), model.scorer
        penalty = 10.0 ** (scorer.attempts - 1) / n
        error = logistic(scorer.margin(names)) - F.col("y_pred")
        slopes = [F.abs(F.avg(error * F.col(c)) + F.lit(penalty * w)) for c, w in zip(names, scorer.coefficients, strict=True)]
        steepest = model.prep.transform(rows).agg(F.greatest(F.abs(F.avg(error)), *slopes).alias("g"))
        told = F.lit(scorer.gradient).cast("double")
        row = steepest.select(
            F.lit(name).alias("fit"),
            F.lit(scorer.attempts).alias("attempts"),
            F.lit(scorer.converged).alias("converged"),
            F.coalesce(F.abs(told - F.col("g")) < 1e-9, F.lit(True)).alias("gradient_as_reported"),
            (F.col("g") < 1e-4).alias("flat"),
        )
        out = row if out is None else out.unionByName(row)
    return out


@register
def forest_model_audit(spark, sf_dir):
    rows = _model_rows(spark, sf_dir)
    forest = BaseLearner("RandomForest")
    model = eh.fit_baseline(rows, "y_pred", [SEGMENT], features=[*FEATURES, PRIORITY], base_estimator=forest)
    return eh.audit_predictions(model.transform(rows, "prediction", ["id"]), "y_pred", "prediction", SEGMENT)


def _fair(spark, sf_dir, constraint: str, label: str) -> DataFrame:
    rows = _model_rows(spark, sf_dir)
    fair = eh.FairReduction((SEGMENT,), constraint, "id", features=FEATURES)
    return fair.fit(rows, label).transform(rows)


@register
def fair_dp(spark, sf_dir):
    fair = _fair(spark, sf_dir, "demographic_parity", "y_pred")
    return eh.audit_predictions(fair, "y_pred", "prediction", SEGMENT)


@register
def fair_eo(spark, sf_dir):
    fair = _fair(spark, sf_dir, "equalized_odds", "y_true")
    return eh.audit_predictions(fair, "y_true", "prediction", SEGMENT)


def _fair_properties(spark, sf_dir, constraint: str, label: str) -> DataFrame:
    """What a constrained fit promises, from the scored rows: its gap is within the tolerance, the one it
    reports, and below that of the unconstrained fit; draws follow ``expected``."""
    rows = _model_rows(spark, sf_dir)
    model = eh.FairReduction((SEGMENT,), constraint, "id", features=FEATURES).fit(rows, label)
    plain = eh.fit_baseline(rows, label, [SEGMENT], features=FEATURES).transform(model.transform(rows), "plain", ["id"])
    events = [label] if constraint == "equalized_odds" else []

    def gap(column: str):
        return F.max(F.abs(F.col(f"{column}_group") - F.col(f"{column}_all")))

    sums = [F.sum(c).alias(c) for c in ("expected", "plain")]
    groups = plain.groupBy(SEGMENT, *events).agg(F.count(F.lit(1)).alias("n"), *sums)
    whole = groups.groupBy(*events).agg(
        *[(F.sum(c) / F.sum("n")).alias(f"{c}_all") for c in ("expected", "plain")], F.sum("n").alias("all")
    )
    rates = groups.withColumns({f"{c}_group": F.col(c) / F.col("n") for c in ("expected", "plain")})
    joined = rates.join(F.broadcast(whole), events) if events else rates.crossJoin(F.broadcast(whole))
    info = model.fairness_info()
    draw = hash_uniform(model.seed, F.col("id").cast("string"))
    wrong = plain.agg(
        F.count_if(F.col("prediction") != (F.col("expected") >= draw).cast("int")).alias("wrong_draws"),
        F.count_if(F.col("pseudo_probability") != F.when(F.col("prediction") == 1, 0.8).otherwise(0.2)).alias("wrong_scores"),
    )
    gaps = joined.agg(F.sum("n").alias("n"), gap("expected").alias("fair"), gap("plain").alias("unfair"))
    return gaps.crossJoin(F.broadcast(wrong)).select(
        "n",
        (F.abs(F.col("fair") - info["gap"]) < 1e-9).alias("gap_as_reported"),
        ((F.col("fair") <= 0.01 + 1e-9) & F.lit(info["converged"])).alias("converged"),
        (F.col("fair") < F.col("unfair")).alias("fairer"),
        "wrong_draws",
        "wrong_scores",
    )


@register
def fair_dp_properties(spark, sf_dir):
    return _fair_properties(spark, sf_dir, "demographic_parity", "y_pred")


@register
def fair_eo_properties(spark, sf_dir):
    return _fair_properties(spark, sf_dir, "equalized_odds", "y_true")


@register
def fair_probability(spark, sf_dir):
    fair = _fair(spark, sf_dir, "demographic_parity", "y_pred")
    return fair.select("id", "expected", "prediction", "pseudo_probability")


@register
def fair_draws(spark, sf_dir):
    """Predictions drawn by the hash of the id from a mix with known weights."""
    rows = _model_rows(spark, sf_dir).select("id", SEGMENT, "offer", "c_acctbal")
    prep = FeaturePrep.fit(rows, FEATURES)
    mixed = ReductionModel(prep, (ConstantScorer(0), ConstantScorer(1)), (0.7, 0.3), (SEGMENT,), "id", 42)
    return mixed.transform(rows).select("id", "expected", "prediction", "pseudo_probability")


@register
def fair_thresholds_audit(spark, sf_dir):
    rows = _model_rows(spark, sf_dir)
    model = eh.FairThresholds((SEGMENT,), features=FEATURES).fit(rows, "y_pred")
    return eh.audit_predictions(model.transform(rows), "y_pred", "prediction", SEGMENT)


@register
def single_class_model(spark, sf_dir):
    rows = _model_rows(spark, sf_dir).withColumn("y", (F.abs("offer") >= 0).cast("int"))
    model = eh.fit_baseline(rows, "y", [SEGMENT], features=FEATURES)
    return model.transform(rows).groupBy(SEGMENT, "prediction").agg(F.count(F.lit(1)).alias("n"))


@register
def fairness_run_reports(spark, sf_dir):
    rows = _model_rows(spark, sf_dir).select("id", SEGMENT, PRIORITY, *FEATURES, "y_pred")
    settings = RunSettings("y_pred", (SEGMENT, PRIORITY), "id", repair_level=0.8, run_id="run-1")
    return pin(run_fairness(spark, settings, rows).reports["metrics"]).df


@register
def fairness_run_thresholds(spark, sf_dir):
    rows = _model_rows(spark, sf_dir).select("id", SEGMENT, *FEATURES, "y_pred")
    settings = RunSettings("y_pred", (SEGMENT,), "id", strategy="thresholds", method="reweighting", run_id="run-2")
    return run_fairness(spark, settings, rows).reports["metrics_by_split"]
