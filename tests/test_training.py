import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import evenhand as eh
from evenhand.operators import games, lookup, newton
from evenhand.operators.learners import BaseLearner, ConstantScorer, LinearScorer
from evenhand.operators.ranks import prefix
from evenhand.operators.thresholds import apply_thresholds, fit_thresholds, fit_thresholds_approx
from evenhand.operators.games import Moments as _Moments
from evenhand.operators.training import load_model


@pytest.fixture(scope="module")
def people():
    rng = np.random.default_rng(42)
    n = 2000
    race = rng.choice(["coast", "plain", "hills"], n, p=[0.45, 0.35, 0.2])
    age = rng.normal(40, 10, n) + np.where(race == "coast", 8, 0)
    income = rng.normal(50, 10, n)
    z = 0.15 * (age - 42) + 0.05 * (income - 50)
    return pd.DataFrame(
        {
            "id": np.arange(n),
            "age": age,
            "income": income,
            "job": rng.choice(["clerk", "driver"], n),
            "race": race,
            "sex": rng.choice(["M", "F"], n),
            "y": (rng.random(n) < 1 / (1 + np.exp(-z))).astype(int),
        }
    )


# ---- thresholds ------------------------------------------------------------------------------


def direct_thresholds(pdf, attr):
    """The least of all candidates: by distance to the overall rate, 0.5 first, then by score."""
    rate = pdf.y.mean()

    def least(scores):
        candidates = [(abs((scores >= t).mean() - rate), t != 0.5, t) for t in {0.5, *scores}]
        return min(candidates)[2]

    return {g: least(s) for g, s in pdf.groupby(attr).score}


def test_three_row_case(spark):
    df = spark.createDataFrame([(0.7, 1, "A"), (0.2, 0, "B"), (0.6, 1, "A")], "score double, y int, g string")
    model = fit_thresholds(df, "score", "y", "g")
    assert {r["group"]: r["threshold"] for r in model.thresholds().collect()} == {"A": 0.7, "B": 0.2}


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("digits", [1, 2, 15])
def test_thresholds_equal_the_direct_search(spark, seed, digits):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(5, 400))
    pdf = pd.DataFrame(
        {
            "score": np.round(rng.beta(rng.uniform(0.2, 3), rng.uniform(0.2, 3), n), digits),
            "y": rng.integers(0, 2, n),
            "g": rng.choice(list("abcd"), n, p=[0.6, 0.2, 0.15, 0.05]),
            "h": rng.integers(0, 3, n),
        }
    )
    pdf["y"] = pdf.y if seed else 0
    model = fit_thresholds(spark.createDataFrame(pdf), "score", "y", ["g", "h"])
    got = {(r["attr"], r["group"]): r["threshold"] for r in model.thresholds().collect()}
    want = {("g", g): t for g, t in direct_thresholds(pdf, "g").items()}
    want |= {("h", str(g)): t for g, t in direct_thresholds(pdf, "h").items()}
    assert got == want


@pytest.mark.parametrize("n,digits,error", [(1, 1, 0.2), (7, 15, 0.004), (300, 1, 0.004), (300, 15, 0.2), (20_000, 15, 0.004), (20_000, 3, 0.004)])
def test_thresholds_from_sketches_are_within_their_error(spark, n, digits, error):
    rng = np.random.default_rng(n + digits)
    pdf = pd.DataFrame({"score": np.round(rng.beta(2, 3, n), digits), "y": rng.integers(0, 2, n), "g": rng.choice(list("abc"), n, p=[0.7, 0.2, 0.1])})
    pdf["h"] = pdf.g.map({"a": None, "b": "x", "c": "x"})
    model = fit_thresholds_approx(spark.createDataFrame(pdf, "score double, y int, g string, h string"), "score", "y", ["g", "h"], error)
    assert model.passes == 1 and model.error == error
    got = {(r["attr"], r["group"]): r for r in model.thresholds().collect()}
    rate = pdf.y.mean()
    for attr, groups in (("g", pdf.g), ("h", pdf.h.fillna("nan"))):
        want = direct_thresholds(pdf.assign(**{attr: groups}), attr)
        assert {g for a, g in got if a == attr} == set(want)
        for g, t in want.items():
            scores = pdf.score[groups == g]
            row = got[attr, g]
            taken = (scores >= row["threshold"]).mean()
            assert row["n"] == len(scores)
            assert abs(taken - rate) - abs((scores >= t).mean() - rate) <= error + 1e-12
            assert abs(row["selected"] / row["n"] - taken) <= error


def test_sketches_need_a_possible_error_and_rows(spark):
    df = spark.createDataFrame([(0.5, None, "a")], "score double, y int, g string")
    with pytest.raises(ValueError, match="error of a rank"):
        fit_thresholds_approx(df, "score", "y", "g", 0.0)
    with pytest.raises(ValueError, match="training data is empty"):
        fit_thresholds_approx(df, "score", "y", "g")


@pytest.mark.parametrize("attrs", [["g"], ["g", "h"], ["g", "h", "k", "l"]])
def test_each_pass_reads_the_rows_once(spark, attrs):
    rng = np.random.default_rng(3)
    n = 4000
    pdf = pd.DataFrame({"score": rng.random(n), "y": rng.integers(0, 2, n), **{a: rng.integers(0, 9, n).astype(str) for a in "ghkl"}})
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    plain = spark.createDataFrame(pdf)
    model = fit_thresholds(plain.mapInArrow(counted, plain.schema), "score", "y", attrs)
    assert model.passes in (2, 3)
    assert read.value == n * model.passes
    read.value = 0
    fit_thresholds_approx(plain.mapInArrow(counted, plain.schema), "score", "y", attrs)
    assert read.value == n


def test_prefixes_never_fall_as_values_rise(spark):
    rng = np.random.default_rng(4)
    values = np.concatenate([rng.normal(size=500), 10.0 ** rng.uniform(-320, 308, 500), [0.0, -0.0, np.inf, -np.inf, 5e-324, -5e-324, 1e308]])
    values = np.unique(np.concatenate([values, -values, np.nextafter(2.0 ** np.arange(-20, 20), 0), 2.0 ** np.arange(-20, 20)]))
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    found = [r["p"] for r in df.select("v", prefix(F.col("v")).alias("p")).orderBy("v").collect()]
    assert found == sorted(found)
    missing = spark.createDataFrame([(None,), (float("nan"),)], "v double").select(prefix(F.col("v")).alias("p")).collect()
    assert [r["p"] for r in missing] == [None, None]


def test_thresholds_of_many_groups_stay_distributed(spark, monkeypatch):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"score": rng.random(600), "y": rng.integers(0, 2, 600), "g": rng.integers(0, 30, 600).astype(str)})
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 3)
    df = spark.createDataFrame(pdf)
    model = fit_thresholds(df, "score", "y", "g")
    assert not model.table.bounded
    want = direct_thresholds(pdf, "g")
    assert {r["group"]: r["threshold"] for r in model.thresholds().collect()} == want
    out = apply_thresholds(df, "score", model).toPandas()
    assert (out.prediction == (out.score >= out.g.map(want)).astype(int)).all()


def test_last_known_attribute_decides(spark):
    df = spark.createDataFrame([(0.7, 1, "A", 1), (0.2, 0, "B", 2), (0.6, 1, "A", 2)], "score double, y int, g string, k int")
    model = fit_thresholds(df, "score", "y", ["g", "k"], null_token=None)
    t = {(r["attr"], r["group"]): r["threshold"] for r in model.thresholds().collect()}
    new = spark.createDataFrame(
        [(1, 0.65, "A", 9), (2, 0.65, "Z", 9), (3, 0.65, "A", 1), (4, 0.65, None, 2)], "id int, score double, g string, k int"
    )
    out = {r["id"]: r["prediction"] for r in apply_thresholds(new, "score", model, unseen="none").collect()}
    assert out == {1: int(0.65 >= t["g", "A"]), 2: 0, 3: int(0.65 >= t["k", "1"]), 4: int(0.65 >= t["k", "2"])}
    first = {r["id"]: r["prediction"] for r in apply_thresholds(new, "score", model, unseen="first").collect()}
    assert first[2] == int(0.65 >= t["g", "A"])


# ---- reduction -------------------------------------------------------------------------------


def test_costs_follow_the_derivative_of_the_lagrangian():
    """Numerically differentiate error + sum(multiplier * difference) by each cell's votes."""
    rng = np.random.default_rng(0)
    counts = rng.integers(5, 40, (3, 2)).astype(float)
    for constraint in ("demographic_parity", "equalized_odds"):
        m = _Moments(constraint, counts)
        lam = rng.normal(size=m.shape)

        def lagrangian(votes, m=m, lam=lam):
            error = (counts[:, 1] - votes[:, 1] + votes[:, 0]).sum() / counts.sum()
            return error + (lam * m.differences(votes)).sum()

        votes = counts * rng.random((3, 2))
        for g in range(3):
            for y in (0, 1):
                step = votes.copy()
                step[g, y] += 1e-4
                slope = (lagrangian(step) - lagrangian(votes)) / 1e-4
                assert math.isclose(slope, m.costs(lam)[g, y], rel_tol=1e-6, abs_tol=1e-9)


@pytest.mark.parametrize("constraint,metric", [("demographic_parity", "demographic_parity_difference"), ("equalized_odds", "equalized_odds_difference")])
def test_reduction_lowers_the_disparity(spark, people, constraint, metric):
    df = spark.createDataFrame(people)
    quick = BaseLearner(max_iter=20, max_retries=1)
    plain = eh.fit_baseline(df, "y", "race", keep=["id"], base_estimator=quick)
    before = eh.audit_predictions(plain.transform(df), "y", "prediction", "race").first()[metric]
    model = eh.FairReduction(("race",), constraint, "id", quick, keep=("sex",), max_iter=8).fit(df, "y")
    scored = model.transform(df)
    after = eh.audit_predictions(scored, "y", "prediction", "race").first()[metric]
    assert after < before * 0.75
    rows = scored.select("expected", "prediction", "pseudo_probability").distinct().collect()
    assert all(0 <= r["expected"] <= 1 and r["prediction"] in (0, 1) for r in rows)
    assert all(r["pseudo_probability"] == (0.8 if r["prediction"] else 0.2) for r in rows)
    assert model.history[-1]["gap"] < model.history[0]["gap"]
    info = model.fairness_info()
    assert info["constraint"] == constraint and info["sensitive_features"] == ["race"] and info["classes"] == [0, 1]
    again = model.transform(df.repartition(16)).select("id", "prediction").collect()
    assert sorted(again) == sorted(scored.select("id", "prediction").collect())


@pytest.mark.parametrize("constraint", ["demographic_parity", "equalized_odds"])
def test_reduction_reaches_its_tolerance_in_both_forms(spark, people, monkeypatch, constraint):
    df = spark.createDataFrame(people)
    fair = eh.FairReduction(("race", "sex"), constraint, "id", features=("age", "income"), max_iter=4)
    few = fair.fit(df, "y")
    info = few.fairness_info()
    assert info["converged"] and info["gap"] <= 0.01 and info["iterations"] == 4
    assert few.history[0]["gap"] > 0.01 and few.history[0]["error"] < few.history[-1]["error"] < 0.5
    # the reported gap is that of the expected predictions
    scored = few.transform(df).toPandas()
    by = [scored.y] if constraint == "equalized_odds" else [pd.Series(0, index=scored.index)]
    groups = scored.groupby([*by, scored.race, scored.sex]).expected.mean()
    whole = scored.groupby(by).expected.mean()
    assert math.isclose(max(abs(groups.loc[e] - whole.loc[e]).max() for e in whole.index), info["gap"], abs_tol=1e-9)
    monkeypatch.setattr(games, "FEW_GROUPS", 2)
    many = fair.fit(df, "y")
    assert math.isclose(many.fairness_info()["gap"], info["gap"], abs_tol=1e-9)
    np.testing.assert_allclose(many.weights, few.weights, atol=1e-6)
    for a, b in zip(many.scorers, few.scorers, strict=True):
        assert type(a) is type(b)
        if isinstance(a, LinearScorer):
            np.testing.assert_allclose([*a.coefficients, a.intercept], [*b.coefficients, b.intercept], rtol=1e-5, atol=1e-6)


def test_one_group_more_than_the_driver_holds(spark):
    n = games.FEW_GROUPS + 1
    df = spark.range(2 * n).select(
        "id",
        (F.col("id") % n).alias("g"),
        (F.hash("id") % 1000 / 1000 + F.col("id") % n % 2).alias("x"),
        (F.col("id") % n % 2 + F.hash("id") % 2 > 0).cast("int").alias("y"),
    )
    model = eh.FairReduction(("g",), id_col="id", max_iter=2).fit(df, "y")
    info = model.fairness_info()
    assert info["converged"] and info["iterations"] == 2
    assert model.history[0]["gap"] > 0.1
    rates = model.transform(df).groupBy("g").agg(F.avg("expected").alias("rate"), F.count(F.lit(1)).alias("n"))
    whole = rates.agg(F.sum(F.col("rate") * F.col("n")) / F.sum("n")).first()[0]
    assert math.isclose(rates.agg(F.max(F.abs(F.col("rate") - whole))).first()[0], info["gap"], abs_tol=1e-9)


def test_weights_of_a_mixture_need_few_constraints(monkeypatch):
    rng = np.random.default_rng(2)
    found = rng.normal(size=(3000, 5))
    mixture = np.full(5, 0.2)
    monkeypatch.setattr(games, "ACTIVE", 64)
    rows = games._foremost(found, mixture)
    assert len(rows) <= 64
    assert np.abs(rows @ mixture).max() == np.abs(found @ mixture).max() and np.abs(rows).max() == np.abs(found).max()
    # one classifier is fair and bad, another unfair and good: half of each is just fair enough
    weights = games.mixture_weights(np.array([0.5, 0.1]), np.array([[0.0, 0.2]]), 0.1)
    np.testing.assert_allclose(weights, [0.5, 0.5], atol=0.03)


def test_newton_needs_few_steps_from_a_near_start(spark, people):
    df = spark.createDataFrame(people).select((F.col("age") / 50).alias("a"), (F.col("income") / 50).alias("b"), "y", (1 + F.col("id") % 3).alias("w")).persist()
    x = np.column_stack([people.age / 50, people.income / 50, np.ones(len(people))])
    y, w, n = people.y.to_numpy(), 1 + people.id.to_numpy() % 3, float((1 + people.id % 3).sum())
    steps = []

    def fit(penalty, start=None):
        calls = []
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(newton, "_sums", lambda *a: calls.append(1) or sums(*a))
            scorer = newton.fit_newton(df, ["a", "b"], F.col("y"), F.col("w"), n, penalty, start, 1e-9)
        steps.append(len(calls))
        return np.array([*scorer.coefficients, scorer.intercept]), scorer.converged

    sums = newton._sums
    point, converged = fit(0.01)
    p = 1 / (1 + np.exp(-x @ point))
    slope = x.T @ (w * (p - y)) / n + 0.01 * point * [1, 1, 0]
    assert converged and np.abs(slope).max() < 1e-9
    near, converged = fit(0.011, point)
    assert converged and steps[1] < steps[0]
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(newton, "FEW_TASKS", 0)
        np.testing.assert_allclose(fit(0.01)[0], point, rtol=1e-8)
    df.unpersist()


def test_reduction_stops_at_the_tolerance_and_forests_work(spark, people):
    df = spark.createDataFrame(people)
    forest = BaseLearner("RandomForest", num_trees=3, max_depth=3)
    model = eh.FairReduction(("race", "sex"), "demographic_parity", "id", forest, max_iter=3, tolerance=1.0).fit(df, "y")
    assert len(model.scorers) == 1
    assert model.transform(df).filter("prediction not in (0, 1)").isEmpty()


def test_reweighting_in_the_reduction_uses_the_cell_weights():
    counts = np.array([[1.0, 3.0], [3.0, 1.0]])
    m = _Moments("demographic_parity", counts, reweighting=True)
    np.testing.assert_allclose(m.weight, [[2, 2 / 3], [2 / 3, 2]])


def test_unseen_group_is_scored(spark, people):
    df = spark.createDataFrame(people)
    quick = BaseLearner(max_iter=10, max_retries=1)
    new = df.limit(10).withColumn("race", F.lit("Unknown"))
    for model in (
        eh.FairReduction(("race",), id_col="id", base_estimator=quick, max_iter=2).fit(df, "y"),
        eh.FairThresholds(("race",), quick, keep=("id",)).fit(df, "y"),
    ):
        assert model.transform(new).filter("prediction in (0, 1)").count() == 10


def test_thresholded_model_equalises_selection(spark, people):
    df = spark.createDataFrame(people)
    model = eh.FairThresholds(("race",), BaseLearner(max_iter=50), keep=("id",)).fit(df, "y")
    scored = model.transform(df)
    audit = eh.audit_predictions(scored, "y", "prediction", "race").first()
    assert audit["demographic_parity_difference"] < 0.02
    bounds = scored.agg(F.min("probability"), F.max("probability")).first()
    assert 0 <= bounds[0] <= bounds[1] <= 1


@pytest.mark.parametrize("value", [0, 1])
def test_single_class(spark, value):
    df = spark.createDataFrame([(i, i, "AB"[i % 2], value) for i in range(4)], "id int, x int, race string, y int")
    models = [
        eh.fit_baseline(df, "y", "race", keep=["id"]),
        eh.FairReduction(("race",), id_col="id").fit(df, "y"),
        eh.FairThresholds(("race",), keep=("id",)).fit(df, "y"),
    ]
    for model in models:
        assert {r["prediction"] for r in model.transform(df).collect()} == {value}
        assert model.fairness_info()["classes"] == [value]


def test_input_errors(spark):
    df = spark.createDataFrame([(1, 1.0, "A", 2), (2, 2.0, "B", 0)], "id int, x double, g string, y int")
    with pytest.raises(ValueError, match="must be 0 or 1"):
        eh.fit_baseline(df, "y", "g", keep=["id"])
    with pytest.raises(ValueError, match="Unknown constraint"):
        eh.FairReduction(("g",), "invalid_constraint")
    with pytest.raises(ValueError, match="sensitive_features must be provided"):
        eh.FairReduction(())
    with pytest.raises(ValueError, match="Unknown base estimator"):
        BaseLearner("Boosting")
    with pytest.raises(ValueError, match="Missing sensitive"):
        eh.fit_baseline(df, "y", "race")
    with pytest.raises(ValueError, match="empty"):
        eh.fit_baseline(df.filter("false"), "y", "g", keep=["id"])


def test_logistic_fit_equals_newton_on_the_same_loss(spark, people):
    """Penalty 1/(C n) on the mean loss, intercept not penalised."""
    df = spark.createDataFrame(people)
    model = eh.fit_baseline(df, "y", ["race", "sex"], features=["age", "income"], base_estimator=BaseLearner(tol=1e-10))
    x = people[["age", "income"]].to_numpy()
    x = np.column_stack([(x - x.mean(0)) / x.std(0), np.ones(len(x))])
    y, w = people.y.to_numpy(), np.zeros(3)
    ridge = np.diag([1.0, 1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ w))
        w -= np.linalg.solve((x.T * (p * (1 - p))) @ x + ridge, x.T @ (p - y) + ridge @ w)
    np.testing.assert_allclose([*model.scorer.coefficients, model.scorer.intercept], w, rtol=1e-4, atol=1e-5)


def test_retry_doubles_iterations(spark, people, monkeypatch):
    from evenhand.operators import learners

    asked = []
    original = learners.LogisticRegression

    def recording(**kw):
        asked.append((kw["maxIter"], kw["regParam"]))
        return original(**kw)

    monkeypatch.setattr(learners, "LogisticRegression", recording)
    df = spark.createDataFrame(people)
    eh.fit_baseline(df, "y", "race", keep=["id", "sex"], base_estimator=BaseLearner(max_iter=1, max_retries=3, tol=1e-12))
    assert [m for m, _ in asked] == [1, 2, 4]
    assert math.isclose(asked[1][1], asked[0][1] * 10)


@pytest.mark.parametrize("kind", ["LogisticRegression", "RandomForest"])
def test_saved_models_score_the_same(spark, people, tmp_path, kind):
    df = spark.createDataFrame(people)
    learner = BaseLearner(kind, max_iter=10, max_retries=1, num_trees=3)
    models = [
        eh.fit_baseline(df, "y", "race", keep=["id"], base_estimator=learner),
        eh.FairReduction(("race",), id_col="id", base_estimator=learner, max_iter=3).fit(df, "y"),
        eh.FairThresholds(("race",), learner, keep=("id",)).fit(df, "y"),
    ]
    for i, model in enumerate(models):
        path = str(tmp_path / f"model{i}")
        model.save(path)
        again = load_model(spark, path)
        assert again.fairness_info() == model.fairness_info()
        want = model.transform(df).select("id", "prediction").orderBy("id").collect()
        assert again.transform(df).select("id", "prediction").orderBy("id").collect() == want


def test_equal_members_are_merged(spark):
    from evenhand.operators.training import mixed_votes

    df = spark.createDataFrame([(1.0,), (-1.0,)], "a double")
    members = [LinearScorer(0.0, (1.0,)), LinearScorer(0.0, (1.0,)), ConstantScorer(1), ConstantScorer(0)]
    rows = mixed_votes(df, ["a"], members, [0.25] * 4, "e").collect()
    assert [r["e"] for r in rows] == [0.75, 0.25]


def test_ranks_of_any_doubles_take_few_passes(spark, monkeypatch):
    from evenhand.operators import ranks

    rng = np.random.default_rng(8)
    scores = [*(10.0 ** rng.uniform(-300, 300, 400) * rng.choice([-1, 1], 400)), math.inf, math.inf, -math.inf, 0.0, math.nan, None]
    df = spark.createDataFrame([(s, int(i % 2), "a") for i, s in enumerate(map(lambda s: None if s is None else float(s), scores))], "score double, y int, g string")
    passes = []
    narrow = ranks._narrow
    monkeypatch.setattr(ranks, "_narrow", lambda *args: passes.append(1) or narrow(*args))
    got = fit_thresholds(df, "score", "y", "g").thresholds().collect()[0]
    known = np.array(sorted(s for s in scores if s is not None and not math.isnan(s)))
    candidates = [(abs((known >= t).mean() - 0.5), t != 0.5, t) for t in {0.5, *known}]
    assert got["threshold"] == min(candidates)[2] and got["n"] == len(known)
    assert len(passes) <= 9


def test_unconverged_training_is_reported(spark, people):
    df = spark.createDataFrame(people)
    hasty = eh.FairReduction(("race",), keep=("sex",), max_iter=1, eps=1e-4)
    info = hasty.fit(df, "y").fairness_info()
    assert info["converged"] is False and info["gap"] > 1e-4 and info["iterations"] == 1
    with pytest.raises(RuntimeError, match="gap"):
        eh.FairReduction(("race",), keep=("sex",), max_iter=1, eps=1e-4, on_unconverged="raise").fit(df, "y")
    with pytest.raises(RuntimeError, match="no convergence"):
        eh.fit_baseline(df, "y", ["race", "sex"], base_estimator=BaseLearner(max_iter=1, max_retries=1, on_unconverged="raise"))
