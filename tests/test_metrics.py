import math

import numpy as np
import pandas as pd
import pytest

import evenhand as eh

SCHEMA = "y int, p int, g string"


def audit(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    return eh.audit_predictions(df, "y", "p", "g", **kw).first().asDict()


def test_all_positive_predictions(spark):
    r = audit(spark, [(1, 1, "A"), (1, 1, "B"), (0, 1, "A"), (0, 1, "B")])
    assert (r["accuracy"], r["precision"], r["recall"]) == (0.5, 0.25, 0.5)
    assert math.isclose(r["f1_score"], 1 / 3)
    assert (r["demographic_parity_difference"], r["equalized_odds_difference"]) == (0, 0)
    assert r["overall_fairness_score"] == 1


def test_one_group(spark):
    r = audit(spark, [(1, 1, "A"), (1, 0, "A"), (0, 1, "A"), (0, 0, "A")])
    assert [r[m] for m in ("accuracy", "precision", "recall", "f1_score")] == [0.5] * 4
    assert (r["demographic_parity_difference"], r["equalized_odds_difference"]) == (0, 0)


def test_one_row_without_negatives_uses_the_tpr_part(spark):
    r = audit(spark, [(1, 1, "A")])
    assert [r[m] for m in ("accuracy", "precision", "recall", "f1_score")] == [1] * 4
    assert (r["demographic_parity_difference"], r["equalized_odds_difference"]) == (0, 0)


def test_without_positives_the_odds_difference_is_missing(spark):
    rows = [(0, 1, "A"), (0, 0, "B")]
    r = audit(spark, rows)
    assert r["equalized_odds_difference"] is None
    assert r["demographic_parity_difference"] == 1
    assert r["overall_fairness_score"] == 0
    assert r["equalized_odds_violation"] is False and r["demographic_parity_violation"] is True
    df = spark.createDataFrame(rows, SCHEMA)
    report = {x["metric"]: x for x in eh.report_table(eh.audit_predictions(df, "y", "p", "g")).collect()}
    assert report["equalized_odds_difference"]["status"] == "VIOLATION"
    assert report["equalized_odds_difference"]["violation"] is False


def test_null_group_counts_in_accuracy_only(spark):
    rows = [(1, 1, "A"), (1, 1, "B"), (0, 1, "A"), (0, 1, "B"), (1, 0, None)]
    r = audit(spark, rows)
    assert r["accuracy"] == 2 / 5
    assert r["demographic_parity_difference"] == 0
    df = spark.createDataFrame(rows, SCHEMA)
    assert {x["group"] for x in eh.selection_rate(df, "y", "p", "g").collect()} == {"A", "B"}
    assert None in {x["group"] for x in eh.confusion_cells(df, "y", "p", "g").collect()}


def direct_metrics(pdf, attr):
    """Direct computation of the six metrics with pandas."""
    out = {"accuracy": float((pdf.y == pdf.p).mean())}
    totals = {"precision": 0.0, "recall": 0.0, "f1_score": 0.0}
    for label in (0, 1):
        support, predicted = (pdf.y == label).sum(), (pdf.p == label).sum()
        tp = ((pdf.y == label) & (pdf.p == label)).sum()
        totals["precision"] += support * (tp / predicted if predicted else 0)
        totals["recall"] += support * (tp / support if support else 0)
        totals["f1_score"] += support * (2 * tp / (support + predicted) if support + predicted else 0)
    out |= {k: v / len(pdf) for k, v in totals.items()}
    sel = pdf.groupby(attr).p.mean()
    tpr, fpr = pdf[pdf.y == 1].groupby(attr).p.mean(), pdf[pdf.y == 0].groupby(attr).p.mean()
    out["demographic_parity_difference"] = sel.max() - sel.min()
    out["equalized_odds_difference"] = max(tpr.max() - tpr.min(), fpr.max() - fpr.min())
    return out


@pytest.fixture(scope="module")
def biased():
    rng = np.random.default_rng(5)
    n = 1000
    race = rng.choice(["coast", "plain", "hills"], n, p=[0.2, 0.5, 0.3])
    y = (rng.random(n) < 0.35).astype(int)
    p = np.where(rng.random(n) < 0.15 + 0.2 * (race == "hills"), 1 - y, y)
    pdf = pd.DataFrame({"y": y, "p": p, "race": race, "sex": rng.choice(["M", "F"], n)})
    pdf.loc[::50, "race"] = None
    return pdf


@pytest.mark.parametrize("partitions", [1, 16])
def test_metrics_equal_pandas_for_several_attributes(spark, biased, partitions):
    df = spark.createDataFrame(biased).repartition(partitions)
    rows = eh.all_metrics(df, "y", "p", ["race", "sex"]).collect()
    for attr in ("race", "sex"):
        got = {r["metric"]: r["value"] for r in rows if r["attr"] == attr}
        want = direct_metrics(biased, attr)
        assert got.keys() == want.keys()
        for k, v in want.items():
            assert math.isclose(got[k], v, abs_tol=1e-12), k


def test_cells_counts_and_rows_give_the_same_report(spark, biased):
    df = spark.createDataFrame(biased)
    from_rows = eh.all_metrics(df, "y", "p", ["race", "sex"]).collect()
    from_cells = eh.all_metrics(eh.confusion_cells(df, "y", "p", ["race", "sex"])).collect()
    assert sorted(from_rows) == sorted(from_cells)


def test_additional_metrics_and_unknown_name(spark, biased):
    df = spark.createDataFrame(biased)
    extra = ["equal_opportunity_difference", "statistical_parity_difference"]
    got = {r["metric"]: r["value"] for r in eh.all_metrics(df, "y", "p", "race", additional=extra).collect()}
    assert got["statistical_parity_difference"] == got["demographic_parity_difference"]
    assert got["equal_opportunity_difference"] <= got["equalized_odds_difference"]
    with pytest.raises(ValueError, match="Unknown metric"):
        eh.all_metrics(df, "y", "p", "race", additional=["nonsense"])


def test_audit_by_split_is_one_report_per_split(spark, biased):
    df = spark.createDataFrame(biased.assign(split=np.where(biased.index % 3 == 0, "test", "train")))
    rows = {r["split"]: r for r in eh.audit_predictions(df, "y", "p", "race", by=["split"]).collect()}
    want = direct_metrics(biased[biased.index % 3 == 0], "race")
    assert math.isclose(rows["test"]["equalized_odds_difference"], want["equalized_odds_difference"])
    assert set(rows) == {"test", "train"}


def test_the_rows_are_shuffled_only_as_partial_counts(spark, biased):
    df = spark.createDataFrame(biased)
    plan = eh.audit_predictions(df, "y", "p", "race")._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Join" not in plan and plan.count("Aggregate") == 2


def test_labels_of_many_values(spark):
    df = spark.createDataFrame([(2, 2, "a"), (1, 3, "a"), (0, 0, "b"), (2, 3, None), (None, 1, "a")], "y int, p int, g string")
    got = eh.performance_metrics(df, "y", "p", "g").first()
    assert got["accuracy"] == 0.5
    assert math.isclose(got["precision"], 3 / 4) and math.isclose(got["recall"], 0.5)
    assert math.isclose(got["f1_score"], (2 * (2 / 3) + 0 + 1) / 4)
    with pytest.raises(Exception, match="neither 0 nor 1"):
        eh.audit_predictions(df, "y", "p", "g").collect()
