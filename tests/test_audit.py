import math

import numpy as np
import pandas as pd
import pytest

import evenhand as eh


@pytest.fixture(scope="module")
def people():
    rng = np.random.default_rng(3)
    n = 1000
    pdf = pd.DataFrame(
        {
            "age": rng.integers(16, 80, n).astype(float),
            "income": rng.gamma(3.0, 700.0, n),
            "race": rng.choice(["coast", "plain", "hills", "delta"], n, p=[0.4, 0.3, 0.2, 0.1]),
            "sex": rng.choice(["M", "F"], n),
            "target": (rng.random(n) < 0.42).astype(int),
        }
    )
    pdf.loc[:9, "race"] = None
    pdf.loc[5:20, "age"] = np.nan
    return pdf


def test_audit_equals_pandas(spark, people):
    rows = eh.audit_dataset(spark.createDataFrame(people), "race", "target").collect()
    got = {(r["section"], r["item"]): r["value"] for r in rows}
    assert got["shape", "rows"] == len(people) and got["shape", "columns"] == 5
    for column, missing in people.isnull().sum().items():
        assert got["missing", column] == missing
    for group, n in people.race.value_counts().items():
        assert got["distribution", group] == n
    rates = people.groupby("race").target.mean()
    for group, rate in rates.items():
        assert math.isclose(got["target_rate", group], rate)
    assert math.isclose(got["target_rate_difference", "max-min"], rates.max() - rates.min())
    assert len(rows) == 2 + 5 + 4 + 4 + 1


def test_audit_without_a_label_has_no_target_rows(spark, people):
    sections = {r["section"] for r in eh.audit_dataset(spark.createDataFrame(people), "race").collect()}
    assert sections == {"shape", "missing", "distribution"}


def test_missing_sensitive_column_is_an_error(spark, people):
    with pytest.raises(ValueError, match="Missing sensitive"):
        eh.audit_dataset(spark.createDataFrame(people), "nope")


def test_distribution_is_ordered_by_size(spark, people):
    rows = eh.group_distribution(spark.createDataFrame(people), "race").collect()
    assert [r["group"] for r in rows] == ["coast", "plain", "hills", "delta"]


def test_rates_and_gaps_equal_pandas(spark, people):
    df = spark.createDataFrame(people)
    combos = people.groupby(["race", "sex"]).target.mean()
    got = {(r["race"], r["sex"]): r["rate"] for r in eh.intersectional_rates(df, ["race", "sex"], "target").collect()}
    assert got.keys() == set(combos.index)
    assert all(math.isclose(got[k], combos[k]) for k in got)
    gaps = {r["scope"]: r for r in eh.gap_summary(df, ["race", "sex"], "target").collect()}
    assert math.isclose(gaps["overall"]["overall_rate"], people.target.mean())
    by_sex = people.groupby("sex").target.mean()
    assert math.isclose(gaps["sex"]["gap"], by_sex.max() - by_sex.min())
    assert math.isclose(gaps["race*sex"]["gap"], combos.max() - combos.min())
    assert gaps["race*sex"]["n_groups"] == len(combos)
    rates = eh.rates_by_attribute(df, ["race", "sex"], "target").collect()
    race = [r["rate"] for r in rates if r["attr"] == "race"]
    assert race == sorted(race, reverse=True) and len(race) == 4


def test_matrix_has_null_for_a_missing_combination(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 0), ("b", "x", 1), (None, "y", 1)], "r string, c string, t int")
    maps = {r["r"]: r["rates"] for r in eh.rate_matrix(df, "r", "c", "t").collect()}
    assert maps["a"] == {"x": 1.0, "y": 0.0} and "y" not in maps["b"]
    rows = {r["r"]: r for r in eh.rate_matrix(df, "r", "c", "t", ["x", "y"]).collect()}
    assert rows["a"]["x"] == 1 and rows["a"]["y"] == 0
    assert rows["b"]["y"] is None and set(rows) == {"a", "b"}


def test_comparison_statuses(spark):
    base = spark.createDataFrame(
        [("accuracy", 0.5), ("recall", 0.5), ("precision", 0.0), ("demographic_parity_difference", 0.2), ("equalized_odds_difference", 0.0)],
        "metric string, value double",
    )
    final = spark.createDataFrame(
        [("accuracy", 0.6), ("recall", 0.5), ("precision", 0.3), ("demographic_parity_difference", 0.15), ("equalized_odds_difference", 0.1)],
        "metric string, value double",
    )
    perf = {r["metric"]: r for r in eh.compare_performance(base, final).collect()}
    assert perf["accuracy"]["status"] == "Improved" and math.isclose(perf["accuracy"]["change_pct"], 20)
    assert perf["recall"]["status"] == "Unchanged"
    assert perf["precision"]["change_pct"] == 0
    fair = eh.compare_fairness(base, final, "demographic_parity_difference")
    rows = {r["metric"]: r for r in fair.collect()}
    assert rows["demographic_parity_difference"]["status"] == "Better"
    assert rows["equalized_odds_difference"]["status"] == "Worse"
    assert eh.verdict(eh.goal_summary(fair, 0.1)).first()["verdict"] == "IMPROVED"
    assert eh.verdict(eh.goal_summary(fair, 0.2)).first()["verdict"] == "SUCCESS"
    other = eh.compare_fairness(base, final, "equalized_odds_difference")
    assert eh.verdict(eh.goal_summary(other, 0.05)).first()["verdict"] == "FAILED"
    with pytest.raises(ValueError, match="share no"):
        eh.comparison_series(base, final.filter("metric = 'accuracy'"), "fairness")


def test_nan_is_no_group_and_numbers_are_groups(spark):
    rows = [(1.0, 1, 1), (1.0, 0, 0), (2.0, 1, 0), (float("nan"), 1, 0), (None, 0, 0)]
    df = spark.createDataFrame(rows, "g double, y int, p int")
    assert {r["group"]: r["n"] for r in eh.group_distribution(df, "g").collect()} == {"1.0": 2, "2.0": 1}
    assert {r["group"] for r in eh.target_rate(df, "g", "y").collect()} == {"1.0", "2.0"}
    assert eh.audit_predictions(df, "y", "p", "g").first()["demographic_parity_difference"] == 0.5
    fixed = eh.GroupRepair(("g",)).fit(df.withColumn("x", df.y * 1.0)).group_stats().collect()
    assert {r["group"] for r in fixed} == {"1.0"}
    weights = eh.reweigh(df, "g", "y").collect()
    assert [r["weight"] is None for r in weights] == [False, False, False, True, True]
