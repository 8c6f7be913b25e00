import hashlib
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import evenhand as eh
from evenhand.operators import lookup, split
from evenhand.operators.ranks import kth_smallest


def direct_split(ids, labels, test, val, seed):
    """Order each class by the hash of the id and cut."""
    pdf = pd.DataFrame({"id": ids, "y": labels})
    pdf["h"] = [hashlib.md5(f"{i}:{seed}".encode()).hexdigest() for i in pdf.id]
    out = {}
    for _, part in pdf.groupby("y", dropna=False):
        part = part.sort_values("h")
        n = len(part)
        n_test = math.floor(n * test + 0.5)
        n_val = min(math.floor(n * val + 0.5), n - n_test)
        for pos, i in enumerate(part.id):
            out[i] = "test" if pos < n_test else "validation" if pos < n_test + n_val else "train"
    return out


@pytest.mark.parametrize("partitions", [1, 16])
@pytest.mark.parametrize("limit", [0, 10, 1_000_000])
def test_split_equals_direct_ordering(spark, monkeypatch, partitions, limit):
    """``limit`` makes the boundary search look at more hash digits before it sorts."""
    monkeypatch.setattr(split, "EXACT_ROWS", limit)
    rng = np.random.default_rng(1)
    ids, labels = list(range(3000)), [int(v) for v in rng.random(3000) < 0.2]
    df = spark.createDataFrame(list(zip(ids, labels, strict=True)), "id int, y int").repartition(partitions)
    out = eh.stratified_split(df, "id", "y", 0.25, 0.15, 9)
    assert {r["id"]: r["split"] for r in out.collect()} == direct_split(ids, labels, 0.25, 0.15, 9)


def test_split_of_tiny_classes_nulls_and_bad_fractions(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, None), (4, None)], "id int, y int")
    rows = eh.stratified_split(df, "id", "y").collect()
    assert len(rows) == 4 and {r["split"] for r in rows} <= {"train", "validation", "test"}
    for test, val in ((1.5, 0.1), (0.6, 0.5), (0.001, 0.1)):
        with pytest.raises(ValueError):
            eh.stratified_split(df, "id", "y", test, val)
    no_val = eh.stratified_split(spark.range(100).withColumn("y", F.lit(1)), "id", "y", 0.2, 0.0)
    assert {r["split"]: r["n"] for r in eh.split_summary(no_val).collect()} == {"test": 20, "train": 80}


def test_split_keeps_the_class_share_and_copies_of_an_id_together(spark):
    df = spark.range(5000).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    both = eh.stratified_split(df.union(df), "id", "y")
    per_id = both.groupBy("id").agg(F.countDistinct("split").alias("k")).agg(F.max("k")).first()[0]
    assert per_id == 1
    shares = eh.stratified_split(df, "id", "y").groupBy("split").agg(F.avg("y").alias("r")).collect()
    assert all(abs(r["r"] - 0.1) < 0.001 for r in shares)


def test_the_split_does_not_shuffle_rows(spark):
    df = spark.range(1000).select("id", (F.col("id") % 2).alias("y"))
    plan = eh.stratified_split(df, "id", "y")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Window" not in plan


@pytest.mark.parametrize("unbounded", [False, True])
def test_kth_smallest_equals_sorting(spark, monkeypatch, unbounded):
    if unbounded:
        monkeypatch.setattr(lookup, "BROADCAST_ROWS", 0)
    rng = np.random.default_rng(2)
    parts = {"a": rng.normal(size=2000), "b": np.round(rng.lognormal(size=500), 1), "c": np.array([7.0] * 50)}
    rows = [(k, float(v)) for k, vs in parts.items() for v in vs]
    df = spark.createDataFrame(rows, "k string, v double")
    wanted = [(k, r) for k, vs in parts.items() for r in {1, len(vs) // 3, len(vs)}]
    want = spark.createDataFrame(
        [(k, str(r), r, float(parts[k].min()), float(parts[k].max())) for k, r in wanted],
        "k string, name string, __rank long, __lo double, __hi double",
    )
    got = kth_smallest(df, ["k"], "v", lookup.pin(want), ["name"], buckets=16).df.collect()
    assert len(got) == len(wanted)
    for r in got:
        values = np.sort(parts[r["k"]])
        at = values[int(r["name"]) - 1]
        larger = values[values > at]
        assert r["at"] == at and r["below"] == (values < at).sum() and r["upto"] == (values <= at).sum()
        assert r["above"] == (larger.min() if len(larger) else None)


@pytest.fixture(scope="module")
def readings():
    rng = np.random.default_rng(4)
    n = 2000
    user = np.where(rng.random(n) < 0.4, 0, rng.integers(1, 40, n))
    pdf = pd.DataFrame({"id": np.arange(n), "t": rng.integers(0, 700, n), "user": user, "v": rng.normal(size=n), "s": rng.choice(list("abc"), n)})
    pdf.loc[rng.random(n) < 0.6, "v"] = np.nan
    pdf.loc[rng.random(n) < 0.6, "s"] = None
    pdf.loc[(pdf.t < 150) & (pdf.user == 0), ["v", "s"]] = [np.nan, None]
    return pdf


@pytest.mark.parametrize("partition_by", [["user"], []])
@pytest.mark.parametrize("rows_per_task", [10**6, 60, 5])
def test_fill_equals_pandas(spark, readings, partition_by, rows_per_task):
    df = spark.createDataFrame(readings).withColumn("v", F.nanvl("v", F.lit(None).cast("double"))).repartition(7)
    out = eh.ffill_bfill(df, ["v", "s"], ["t", "id"], partition_by, rows_per_task).toPandas().sort_values("id")
    ordered = readings.sort_values(["t", "id"])
    if partition_by:
        filled = ordered.groupby("user")[["v", "s"]].transform(lambda c: c.ffill().bfill())
    else:
        filled = ordered[["v", "s"]].ffill().bfill()
    want = filled.sort_index()
    pd.testing.assert_series_equal(out["v"].reset_index(drop=True), want["v"].reset_index(drop=True), check_names=False)
    got_s = [None if pd.isna(x) else x for x in out["s"]]
    assert got_s == [None if pd.isna(x) else x for x in want["s"]]
    assert list(out.columns) == list(readings.columns)


def test_fill_orders_by_timestamps_and_keeps_a_null_key_apart(spark):
    df = spark.createDataFrame(
        [(i, f"2024-01-01 00:{i:02d}:00", None if i % 2 else "k", None if i % 3 else float(i)) for i in range(40)],
        "id int, ts string, k string, v double",
    ).withColumn("ts", F.to_timestamp("ts"))
    whole = eh.ffill_bfill(df, ["v"], ["ts"], ["k"]).orderBy("id").collect()
    parts = eh.ffill_bfill(df, ["v"], ["ts"], ["k"], rows_per_task=4).orderBy("id").collect()
    assert whole == parts and all(r["v"] is not None for r in whole)


def test_clip_scale_and_score(spark):
    df = spark.createDataFrame([(1, 5.0, "a"), (2, 50.0, "b"), (3, None, None)], "id int, x double, g string")
    assert [r["x"] for r in eh.clip(df, "x", 10, 40).orderBy("id").collect()] == [10.0, 40.0, None]
    assert eh.clip(df, "id", 2, 2).dtypes == df.dtypes
    scaled = eh.scale_by_group(df, "x", "g", {"a": 2.0}).orderBy("id").collect()
    assert [r["x"] for r in scaled] == [10.0, 50.0, None]
    factors = spark.createDataFrame([("b", 0.5)], "group string, factor double")
    assert eh.scale_by_group(df, "x", "g", factors).orderBy("id").collect()[1]["x"] == 25.0
    out = eh.logistic_score(df, {"x": 0.1}, -1.0, {"x": "mean"}, [({"g": "a"}, 0.5)]).orderBy("id").collect()
    assert math.isclose(out[0]["score"], 1 / (1 + math.exp(-(-1.0 + 0.1 * (5 - 27.5) + 0.5))))
    assert out[2]["score"] is None


@pytest.mark.parametrize("unbounded", [False, True])
def test_label_encoding(spark, monkeypatch, unbounded):
    if unbounded:
        monkeypatch.setattr(lookup, "BROADCAST_ROWS", 2)
    values = [f"v{i:03d}" for i in range(200)] + [None] + ["v007"] * 500
    df = spark.createDataFrame(list(enumerate(values)), "id int, c string")
    encoding = eh.LabelEncoding.fit(df, ["c"])
    classes = sorted({v or "nan" for v in values})
    rows = encoding.transform(df).orderBy("id").collect()
    assert [r["c"] for r in rows] == [classes.index(v or "nan") for v in values]
    back = encoding.inverse_transform(encoding.transform(df)).orderBy("id").collect()
    assert [r["c"] for r in back] == [v or "nan" for v in values]
    new = spark.createDataFrame([(1, "unseen"), (2, "v003")], "id int, c string")
    assert [r["c"] for r in encoding.transform(new).orderBy("id").collect()] == [0, classes.index("v003")]
    shifted = spark.createDataFrame([(1, -4.0), (2, 0.5), (3, 1.5), (4, 1e9)], "id int, c double")
    decoded = [r["c"] for r in encoding.inverse_transform(shifted).orderBy("id").collect()]
    assert decoded == [classes[0], classes[0], classes[2], classes[-1]]
    codes = eh.CategoryCodes.fit(df, ["c"]).transform(df).orderBy("id").collect()
    known = sorted({v for v in values if v})
    assert [r["c"] for r in codes] == [-1 if v is None else known.index(v) for v in values]


def test_long_strings_are_not_broadcast_but_encoded(spark):
    long = "x" * 10_000
    df = spark.createDataFrame([(1, long), (2, "a"), (3, long + "y")], "id int, c string")
    encoding = eh.LabelEncoding.fit(df, ["c"])
    assert not encoding.codes.bounded
    assert [r["c"] for r in encoding.transform(df).orderBy("id").collect()] == [1, 0, 2]


def test_scaling_uses_population_deviation_and_ignores_missing(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0), (float("nan"), 5.0)], "x double, k double")
    scaling = eh.StandardScaling.fit(df, ["x", "k"])
    assert scaling.means["x"] == 2.0 and scaling.deviations["x"] == 1.0
    rows = scaling.transform(df).collect()
    assert [r["x"] for r in rows[:2]] == [-1.0, 1.0] and rows[0]["k"] == 0.0


def test_reweighing(spark):
    rows = [("A", 1)] * 3 + [("A", 0)] + [("B", 1)] + [("B", 0)] * 3
    df = spark.createDataFrame(rows, "g string, y int")
    out = eh.reweigh(df, "g", "y")
    weights = {(r["g"], r["y"]): r["weight"] for r in out.collect()}
    assert all(math.isclose(weights[k], v) for k, v in {("A", 1): 2 / 3, ("A", 0): 2, ("B", 1): 2, ("B", 0): 2 / 3}.items())
    assert math.isclose(out.agg(F.sum("weight")).first()[0], 8)


def test_roles(spark):
    df = spark.createDataFrame([(1, "a", True, 2.0, 1)], "id int, g string, b boolean, x double, y int")
    roles = eh.resolve_roles(df, ["g"], "y", ["id"])
    assert roles.features == ("b", "x") and roles.numeric == ("x",) and roles.categorical == ("b",)
    assert eh.split_types(df.schema, ["x", "g"]) == (["x"], ["g"])


def test_rows_without_an_id_share_a_split(spark):
    df = spark.createDataFrame([(i if i % 3 else None, i % 2) for i in range(3000)], "id long, y int")
    split = eh.stratified_split(df, "id", "y")
    assert split.filter("id is null").select("y", "split").distinct().count() == 2
    assert {r["split"] for r in split.filter("id is not null").select("split").distinct().collect()} == {"train", "validation", "test"}


@pytest.mark.parametrize("rows_per_task", [10**6, 50])
def test_fill_with_ties_and_text_in_the_first_order_column(spark, rows_per_task):
    rows = [(i, "same" if i % 10 else f"t{i:04}", None if i % 3 else float(i)) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, day string, v double").repartition(5)
    got = {r["id"]: r["v"] for r in eh.ffill_bfill(df, ["v"], ["day", "id"], (), rows_per_task).collect()}
    last, expected = None, {}
    for i, _, v in sorted(rows, key=lambda r: (r[1], r[0])):
        last = v if v is not None else last
        expected[i] = last
    first = next(v for _, _, v in sorted(rows, key=lambda r: (r[1], r[0])) if v is not None)
    assert got == {i: first if v is None else v for i, v in expected.items()}
