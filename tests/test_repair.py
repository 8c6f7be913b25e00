import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import evenhand as eh
from evenhand.operators import lookup
from evenhand.operators import repair as repair_module


def fix(df, sensitive=("g",), fit_on=None, **kw):
    return eh.GroupRepair(tuple(sensitive), **kw).fit(fit_on or df).transform(df)


@pytest.fixture(scope="module")
def people():
    rng = np.random.default_rng(11)
    n = 1000
    race = rng.choice(["coast", "plain", "hills"], n, p=[0.4, 0.35, 0.25])
    sex = rng.choice(["M", "F"], n)
    return pd.DataFrame(
        {
            "id": np.arange(n),
            "age": rng.uniform(20, 60, n) - 6.5 * (race == "hills"),
            "income": rng.gamma(4.0, 800.0, n) + 950 * (race == "coast") + 310 * (sex == "F"),
            "years": rng.integers(1, 15, n) + 4 * (race == "plain"),
            "job": np.where(race == "coast", "manager", rng.choice(["clerk", "driver", "manager"], n)),
            "race": race,
            "sex": sex,
        }
    )


def test_small_groups_meet_at_the_mean(spark):
    df = spark.createDataFrame(
        [(1.0, 10.0, "A"), (2.0, 20.0, "B"), (3.0, 30.0, "A"), (4.0, 40.0, "B")], "x double, z double, g string"
    )
    rows = sorted((r["x"], r["z"]) for r in fix(df).collect())
    assert rows == [(1.5, 15.0), (1.5, 15.0), (3.5, 35.0), (3.5, 35.0)]


def test_group_of_one_row_stays(spark):
    df = spark.createDataFrame([(1.0, "A"), (2.0, "A"), (3.0, "B")], "x double, g string")
    assert sorted(r["x"] for r in fix(df).collect()) == [1.5, 2.5, 3.0]


def test_single_group_is_unchanged(spark):
    df = spark.createDataFrame([(1.0, "A"), (2.0, "A"), (3.0, "A")], "x double, g string")
    assert sorted(r["x"] for r in fix(df).collect()) == [1.0, 2.0, 3.0]


def test_integer_groups_of_one_and_unknown_method(spark):
    df = spark.createDataFrame([(1, "A"), (2, "B")], "x int, g string")
    assert sorted(r["x"] for r in fix(df).collect()) == [1, 2]
    with pytest.raises(ValueError, match="Unknown method"):
        fix(df, method="invalid_method")
    with pytest.raises(ValueError, match="repair_level"):
        fix(df, repair_level=1.5)


def test_integers_round_half_to_even(spark):
    df = spark.createDataFrame([(1, 10, "A"), (2, 20, "B"), (3, 30, "A"), (4, 40, "B")], "x int, z int, g string")
    rows = sorted((r["x"], r["z"]) for r in fix(df, repair_level=0.5).collect())
    assert rows == [(1, 12), (2, 18), (3, 32), (4, 38)]


def test_errors(spark):
    df = spark.createDataFrame([(1.0, "A")], "x double, g string")
    with pytest.raises(ValueError, match="At least one non-sensitive"):
        eh.GroupRepair(("x", "g")).fit(df)
    with pytest.raises(ValueError, match="Missing sensitive"):
        eh.GroupRepair(("nope",)).fit(df)
    with pytest.raises(ValueError, match="numeric, string or boolean"):
        eh.GroupRepair(("g",)).fit(df.withColumn("d", F.current_date()))


def test_level_zero_is_identity_and_columns_keep_order_and_type(spark, people):
    df = spark.createDataFrame(people)
    for method in ("mean_matching", "covariance_matching"):
        out = fix(df, ["race"], method=method, repair_level=0.0, keep=("id",))
        assert out.columns == df.columns and out.dtypes == df.dtypes
        got = out.toPandas().sort_values("id")
        if method == "mean_matching":
            np.testing.assert_allclose(got["income"], people["income"], rtol=1e-10)
            assert list(got["job"]) == list(people["job"]) and list(got["years"]) == list(people["years"])
        assert list(got["race"]) == list(people["race"])


def test_full_level_makes_group_means_equal(spark, people):
    df = spark.createDataFrame(people)
    out = fix(df, ["race"], keep=("id",)).toPandas()
    for feature in ("age", "income"):
        means = out.groupby("race")[feature].mean()
        np.testing.assert_allclose(means, people[feature].mean(), rtol=1e-9)
    assert list(out.sort_values("id")["job"]) == list(people["job"])


def moved(values, rows, fitted, overall, level, spread):
    """Rows of one group after repair: the shift, and the spread they are brought to."""
    shifted = values[rows] + level * (overall - fitted.mean(axis=0))
    if not spread or rows.sum() < 2 or shifted.shape[1] < 2:
        return shifted
    have, want = np.cov(shifted.T), np.cov(fitted.T, ddof=0)
    if min(np.linalg.det(have), np.linalg.det(want)) <= 1e-8:
        return shifted
    ratio = np.sqrt(np.diag(want) / (np.diag(have) + 1e-8)).clip(0.5, 2.0)
    return overall + (shifted - overall) * ratio


def brute_force(pdf, fit, attrs, features, encoders, method, level):
    """Group after group, in numpy: codes, moments, then whole numbers where the column has them."""
    code = lambda frame: frame[features].apply(
        lambda c: c.map(lambda v: encoders[c.name].index(v) if v in encoders[c.name] else 0) if c.name in encoders else c
    )
    values, base = code(pdf), code(fit).to_numpy(float)
    whole = [np.issubdtype(t, np.integer) for t in values.dtypes]
    values = values.to_numpy(float)
    for attr in attrs:
        sizes = fit[attr].value_counts()
        for g in pdf[attr].dropna().unique():
            if sizes.get(g, 0) > 1:
                rows = (pdf[attr] == g).to_numpy()
                fitted = base[(fit[attr] == g).to_numpy()]
                new = moved(values, rows, fitted, base.mean(axis=0), level, method == "covariance_matching")
                values[rows] = np.where(whole, np.round(new), new)
    out = pdf.copy()
    for i, f in enumerate(features):
        last = len(encoders.get(f, ())) - 1
        out[f] = [encoders[f][int(np.clip(np.round(v), 0, last))] for v in values[:, i]] if f in encoders else values[:, i]
    return out


@pytest.mark.parametrize("wide", [24, 1])
@pytest.mark.parametrize("method", ["covariance_matching", "multivariate_repair"])
@pytest.mark.parametrize("features", [["age", "income"], ["age", "income", "years"], ["age", "income", "years", "job"]])
def test_methods_equal_brute_force_on_other_rows(spark, people, monkeypatch, method, features, wide):
    """Two attributes one after another, integers and category codes, rows unlike the fitted ones.

    ``wide`` switches to the covariances of many features.
    """
    if wide == 1 and method == "multivariate_repair" and len(features) != 3:
        pytest.skip("covered by the other sizes")
    monkeypatch.setattr(repair_module, "WIDE_FEATURES", wide)
    level = 1.0 if method == "multivariate_repair" else 0.6
    changed = people.copy()
    changed["age"], changed["income"] = changed["age"] * 1.4, changed["income"] * 0.8 + 100
    columns = ["id", *features, "race", "sex"]
    fit, df = spark.createDataFrame(people[columns]), spark.createDataFrame(changed[columns])
    out = fix(df, ["race", "sex"], fit_on=fit, method=method, repair_level=level, id_col="id")
    got = out.toPandas().sort_values("id").reset_index(drop=True)
    encoders = {"job": ["clerk", "driver", "manager"]} if "job" in features else {}
    want = brute_force(changed[columns], people[columns], ["race", "sex"], features, encoders, method, level)
    for f in features:
        if f in encoders:
            assert (got[f] == want[f]).all()
        else:
            np.testing.assert_allclose(got[f], want[f], rtol=1e-8)


def test_many_features_use_summed_matrices(spark, monkeypatch):
    """More features than aggregates are used for, in several partitions and small task buffers."""
    monkeypatch.setattr(repair_module, "WIDE_TASK_BYTES", 1)
    rng = np.random.default_rng(3)
    k, n = 30, 900
    x = rng.normal(size=(n, k)) @ rng.normal(size=(k, k)) + 1e4
    names = [f"f{i}" for i in range(k)]
    pdf = pd.DataFrame(x, columns=names).assign(g=rng.choice(list("ab"), n), h=rng.choice(list("xyz"), n))
    pdf.loc[pdf.index[pdf.h == "z"][0], "f3"] = np.nan
    model = eh.GroupRepair(("g", "h"), "covariance_matching").fit(spark.createDataFrame(pdf).repartition(5))
    got = {(r["group"], r["f_i"], r["f_j"]): r["cov"] for r in model.group_cov().collect()}
    for group in ("x", "y"):
        want = np.cov(pdf[pdf.h == group][names].to_numpy().T, ddof=0)
        mine = np.array([[got[group, names[min(i, j)], names[max(i, j)]] for j in range(k)] for i in range(k)])
        np.testing.assert_allclose(mine, want, rtol=1e-6, atol=1e-8)
    assert got["z", "f0", "f1"] == 0 and math.isclose(got["z", "f3", "f3"], pdf[pdf.h == "z"].f3.var(), rel_tol=1e-9)
    whole = {(r["f_i"], r["f_j"]): r["cov"] for r in model.overall_cov().collect()}
    assert whole["f0", "f1"] == 0


def test_single_feature_covariance_matches_the_mean_only(spark, people):
    df = spark.createDataFrame(people[["id", "income", "race"]])
    by_cov = fix(df, ["race"], method="covariance_matching", id_col="id").toPandas().sort_values("id")
    by_mean = fix(df, ["race"], id_col="id").toPandas().sort_values("id")
    np.testing.assert_allclose(by_cov["income"], by_mean["income"], rtol=1e-10)


def test_missing_value_stops_the_rescaling_of_its_group_only(spark, people):
    changed = people[["id", "age", "income", "race"]].copy()
    changed["income"] *= 3
    changed.loc[changed[changed.race == "plain"].index[0], "age"] = np.nan
    fit = spark.createDataFrame(people[["id", "age", "income", "race"]])
    out = fix(spark.createDataFrame(changed), ["race"], fit_on=fit, method="covariance_matching", id_col="id").toPandas()
    spread = out.groupby("race").income.std() / changed.groupby("race").income.std()
    assert math.isclose(spread["plain"], 1.0, rel_tol=1e-9) and math.isclose(spread["coast"], 0.5, rel_tol=1e-6)
    diagonal = eh.GroupRepair(("race",), "covariance_matching", id_col="id").fit(spark.createDataFrame(changed)).group_cov()
    cells = {(r["group"], r["f_i"], r["f_j"]): r["cov"] for r in diagonal.collect()}
    black = changed[changed.race == "plain"]
    assert cells["plain", "age", "income"] == 0
    assert math.isclose(cells["plain", "age", "age"], black.age.var(), rel_tol=1e-9)
    white = changed[changed.race == "coast"]
    assert math.isclose(cells["coast", "age", "age"], white.age.var(ddof=0), rel_tol=1e-9)


def test_noise_has_its_moments_and_ignores_partitioning(spark):
    base = spark.range(20_000).select("id", F.lit(0.0).alias("x"), F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("g"))
    df = base.withColumn("x", (F.col("id") % 1000).cast("double"))
    model = eh.GroupRepair(("g",), "multivariate_repair", 0.5, id_col="id", seed=7).fit(df)
    one = model.transform(df.repartition(1)).toPandas().sort_values("id")
    many = model.transform(df.repartition(16)).toPandas().sort_values("id")
    assert (one["x"].to_numpy() == many["x"].to_numpy()).all()
    source = df.toPandas().sort_values("id")
    mean = source.groupby("g").x.transform("mean")
    noise = one["x"].to_numpy() - (source["x"] + 0.5 * (source["x"].mean() - mean)).to_numpy()
    scale = source.groupby("g").x.transform("std").to_numpy() * 0.05
    z = noise / scale
    assert abs(z.mean()) < 0.03 and abs(z.std() - 1) < 0.03
    assert abs(np.corrcoef(z[:-1], z[1:])[0, 1]) < 0.03


def test_noise_spares_a_group_with_one_row_here_and_needs_an_id(spark):
    fit = spark.createDataFrame([(i, float(i), "AB"[i % 2]) for i in range(10)], "id int, x double, g string")
    here = spark.createDataFrame([(1, 4.0, "A"), (2, 5.0, "B"), (3, 6.0, "B")], "id int, x double, g string")
    out = {r["id"]: r["x"] for r in fix(here, fit_on=fit, method="multivariate_repair", repair_level=0.5, id_col="id").collect()}
    assert math.isclose(out[1], 4.0 + 0.5 * (4.5 - 4.0)) and out[2] != 5.0 - 0.25
    with pytest.raises(ValueError, match="needs id_col"):
        fix(here, method="multivariate_repair", repair_level=0.5)


def test_unseen_and_null_groups_and_categories(spark):
    fit = spark.createDataFrame(
        [(1.0, "a", "A"), (3.0, "b", "A"), (5.0, None, "B"), (7.0, "b", "B")], "x double, c string, g string"
    )
    new = spark.createDataFrame([(1.0, "zzz", "Z"), (2.0, None, None), (3.0, "b", "A")], "x double, c string, g string")
    rows = {r["g"]: (r["x"], r["c"]) for r in fix(new, fit_on=fit).collect()}
    assert rows == {"Z": (1.0, "a"), None: (2.0, "nan"), "A": (5.0, "b")}
    kept = {r["g"]: r["c"] for r in fix(new, fit_on=fit, unseen="keep").collect()}
    assert kept == {"Z": "zzz", None: None, "A": "b"}


def test_details_and_round_trip(spark, people, tmp_path):
    df = spark.createDataFrame(people)
    model = eh.GroupRepair(("race", "sex"), "covariance_matching", 0.8, id_col="id").fit(df)
    details = model.details()
    assert details["method"] == "covariance_matching" and details["repair_level"] == 0.8
    assert details["sensitive_features"] == ["race", "sex"]
    assert details["non_sensitive_features"] == ["age", "income", "years", "job"]
    stats = details["group_statistics"].toPandas()
    white = stats[(stats.group == "coast") & (stats.feature == "income")].iloc[0]
    assert math.isclose(white["std"], people[people.race == "coast"].income.std(), rel_tol=1e-9)
    assert details["overall_covariance"].count() == 10
    model.save(str(tmp_path / "m"))
    again = eh.GroupRepairModel.load(spark, str(tmp_path / "m"))
    assert sorted(again.transform(df).collect()) == sorted(model.transform(df).collect())


@pytest.mark.parametrize("method,level", [("mean_matching", 0.7), ("covariance_matching", 0.7), ("multivariate_repair", 0.7)])
def test_unbounded_tables_give_the_same_rows(spark, people, monkeypatch, method, level):
    df = spark.createDataFrame(people)
    settings = dict(method=method, repair_level=level, id_col="id")
    small = fix(df, ["race", "sex"], **settings).toPandas().sort_values("id")
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 1)
    large = fix(df, ["race", "sex"], **settings).toPandas().sort_values("id")
    for f in ("age", "income"):
        np.testing.assert_allclose(small[f], large[f], rtol=1e-9)
    assert list(small["job"]) == list(large["job"]) and list(small["years"]) == list(large["years"])
