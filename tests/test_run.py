import math
from dataclasses import replace

import numpy as np
import pandas as pd
import pytest

import evenhand as eh
from evenhand.plans.run import run_fairness, write_run
from evenhand.plans.settings import RunSettings, validate
from evenhand.sources.sinks import StagedRun, complete_runs, read_runs, write_table
from evenhand.sources.tables import read_checked, read_table

GOOD = RunSettings("target", ("race", "sex"), "id")


@pytest.mark.parametrize(
    "change,message",
    [
        ({"test_size": 1.5}, "test share has to lie"),
        ({"test_size": 0.6, "val_size": 0.5}, "nothing is left"),
        ({"sensitive": ()}, "no sensitive column"),
        ({"sensitive": tuple("abcdefghijk")}, "11 sensitive columns"),
        ({"sensitive": "race"}, "as a list or tuple"),
        ({"repair_level": 1.5}, "share from 0 to 1"),
        ({"fairness_threshold": -0.1}, "above 0 and at most 1"),
        ({"additional_metrics": tuple(["accuracy"] * 21)}, "21 more metrics"),
        ({"additional_metrics": ("nope",)}, "no metric"),
        ({"primary_metric": "nope"}, "cannot be the primary"),
        ({"method": "nope"}, "no repair method"),
        ({"strategy": "nope"}, "no training strategy"),
        ({"constraint": "nope"}, "Unknown constraint"),
        ({"base_estimator": "nope"}, "Unknown base estimator"),
        ({"max_retries": 0}, "counts attempts"),
        ({"label": ""}, "target_column"),
    ],
)
def test_validation(spark, change, message):
    assert validate(GOOD) == []
    bad = replace(GOOD, **change)
    assert any(message in e for e in validate(bad))
    with pytest.raises(ValueError):
        run_fairness(spark, bad, spark.range(1))


@pytest.fixture(scope="module")
def csv_path(tmp_path_factory):
    rng = np.random.default_rng(0)
    n = 1500
    race = rng.choice(["north", "south", "islands"], n, p=[0.45, 0.35, 0.2])
    sex = rng.choice(["M", "F"], n)
    age = rng.uniform(18, 67, n)
    income = 900 + 31 * age + rng.gamma(2.0, 350.0, n) - 420 * (race == "islands") + 150 * (sex == "M")
    z = (income - np.median(income)) / 600 - 0.02 * (age - 45)
    pdf = pd.DataFrame(
        {
            "id": np.arange(n),
            "age": age,
            "income": income,
            "job": rng.choice(["clerk", "driver"], n),
            "race": race,
            "sex": sex,
            "target": (rng.random(n) < 1 / (1 + np.exp(-z))).astype(int),
        }
    )
    path = tmp_path_factory.mktemp("input") / "people.csv"
    pdf.to_csv(path, index=False)
    return str(path)


def test_reading(spark, csv_path, tmp_path):
    df = read_table(spark, csv_path)
    assert dict(df.dtypes)["income"] == "double" and df.count() == 1500
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        read_table(spark, str(tmp_path / "missing.csv")).count()
    with pytest.raises(ValueError, match="Unknown format"):
        read_table(spark, csv_path, "xml")
    broken = tmp_path / "nan.csv"
    broken.write_text("a,b\n1.5,x\nNaN,y\n,z\n")
    assert [r["a"] for r in read_table(spark, str(broken), schema="a double, b string").orderBy("b").collect()] == [1.5, None, None]


@pytest.mark.parametrize(
    "change",
    [
        {},
        {"method": "covariance_matching", "constraint": "equalized_odds", "repair_level": 0.5},
        {"method": "multivariate_repair", "strategy": "thresholds", "repair_level": 0.5},
        {"method": "reweighting"},
        {"method": "reweighting", "strategy": "thresholds", "base_estimator": "RandomForest"},
    ],
)
def test_whole_run(spark, csv_path, tmp_path, change):
    held = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    settings = replace(
        GOOD,
        input_path=csv_path,
        max_iter=2,
        run_id="r1",
        output_path=str(tmp_path / "out"),
        report_on=("race", "sex"),
        additional_metrics=("equal_opportunity_difference",),
        **change,
    )
    result = run_fairness(spark, settings)
    reports = {k: v.toPandas() for k, v in result.reports.items()}
    assert reports["split_summary"].n.sum() == 1500
    assert set(reports["audit_by_split"].split) == {"train", "validation", "test"}
    assert set(reports["baseline_audit"].attr) == {"race", "sex"}
    metrics = reports["metrics"].set_index("metric").value
    for stage in ("baseline", "validation", "final"):
        for m in ("accuracy", "f1_score", "demographic_parity_difference", "equal_opportunity_difference"):
            assert 0 <= metrics[f"{stage}_{m}"] <= 1
    gain = metrics["baseline_demographic_parity_difference"] - metrics["final_demographic_parity_difference"]
    assert math.isclose(metrics["fairness_improvement"], gain, abs_tol=1e-12)
    assert set(reports["summary"].verdict) <= {"SUCCESS", "IMPROVED", "FAILED"}
    assert set(reports["fairness_series"].series) == {"Before", "After"}
    root = settings.output_path
    stored = spark.read.parquet(f"{root}/metrics")
    assert set(stored.columns) == {"run_id", "stage", "metric", "value", "experiment"}
    assert stored.count() == len(reports["metrics"])
    params = {r["key"]: r["value"] for r in spark.read.parquet(f"{root}/params").collect()}
    assert params["sensitive"] == "race,sex" and params["method"] == settings.method
    model = eh.load_model(spark, f"{root}/models/r1")
    rows = read_table(spark, csv_path)
    if result.repair is not None:
        repair = eh.GroupRepairModel.load(spark, f"{root}/repairs/r1")
        rows = repair.transform(rows)
        assert spark.read.parquet(f"{root}/group_statistics").filter("statistic = 'mean'").count() > 0
    again = model.transform(rows, spread_by=["id"]).select("id", "prediction").orderBy("id").collect()
    assert again == result.scored.select("id", "prediction").orderBy("id").collect()
    for name in ("baseline_audit", "summary", "scored", *(["group_sizes"] if result.repair else [])):
        assert spark.read.parquet(f"{root}/{name}").count() > 0
    if not change:  # a rerun of the same id takes the place of the first; nothing stays in memory
        write_run(spark, settings, result)
        assert spark.read.parquet(f"{root}/metrics").count() == len(reports["metrics"])
        assert spark.read.parquet(f"{root}/scored").count() == 1500
        assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == held
        assert {r['run_id'] for r in complete_runs(spark, root).collect()} == {'r1'}
        assert read_runs(spark, root, 'metrics').count() == len(reports['metrics'])


def test_the_table_is_read_for_the_split_and_once_more(spark, csv_path):
    df, read = read_table(spark, csv_path), spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    settings = replace(GOOD, input_path=None, max_iter=2, run_id="r3", report_on=("race", "sex"))
    result = run_fairness(spark, settings, df.mapInArrow(counted, df.schema))
    assert {k for k, v in result.reports.items() if v.count() == 0} == set()
    # twice for the cut: by the first digits of the hashes, and within those of the cut
    assert read.value == 3 * 1500
    assert result.scored.count() == 1500


def test_a_run_that_breaks_off_is_never_read(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "runs")
    numbers = spark.range(3)

    def write(run_id, names, rows=numbers, broken=False):
        with StagedRun(spark, root, run_id) as out:
            for name in names:
                write_table(rows, out.path(f"{name}/run_id={run_id}"))
            if broken:
                raise RuntimeError("lost")

    assert complete_runs(spark, root).count() == 0
    with pytest.raises(RuntimeError, match="lost"):
        write("a", ["x"], broken=True)
    assert complete_runs(spark, root).count() == 0 and not (tmp_path / "runs" / "x").exists()
    with pytest.raises(ValueError, match="no complete run"):
        read_runs(spark, root, "x")
    write("a", ["x", "y"])
    # a rerun that breaks off leaves the first as it was; one that is done takes its place
    with pytest.raises(RuntimeError, match="lost"):
        write("a", ["x"], spark.range(9), broken=True)
    assert read_runs(spark, root, "x").count() == 3
    write("a", ["x", "y"], spark.range(5))
    write("b", ["x"])
    assert read_runs(spark, root, "x").groupBy("run_id").count().orderBy("run_id").collect() == [("a", 5), ("b", 3)]
    with pytest.raises(OSError, match="z/run_id=b was never written"):
        with StagedRun(spark, root, "b") as out:
            out.path("z/run_id=b")
    assert read_runs(spark, root, "x").count() == 8
    # broken off while files are moved: the run does not count until it is done again
    move, moved = StagedRun._move, []

    def breaks(self, relative):
        moved.append(relative)
        if len(moved) == 2:
            raise RuntimeError("lost")
        move(self, relative)

    with monkeypatch.context() as patch:
        patch.setattr(StagedRun, "_move", breaks)
        with pytest.raises(RuntimeError, match="lost"):
            write("b", ["x", "y"], spark.range(7))
    assert {r["run_id"] for r in complete_runs(spark, root).collect()} == {"a"}
    assert read_runs(spark, root, "x").count() == 5
    write("b", ["x", "y"], spark.range(7))
    assert read_runs(spark, root, "x").count() == 12
    assert list((tmp_path / "runs" / "_staging").glob("*/*")) == []


def test_lines_that_do_not_fit_are_kept_apart(spark, tmp_path):
    path = tmp_path / "people.csv"
    path.write_text('id,x,name\n1,1.5,a\n2,NaN,"b, c"\n3,oops,c\n4,2.5\n5,2.5,d,more\n6,,\n\n"7",1e3,"q"\n')
    checked = read_checked(spark, str(path), "id int, x double, name string")
    assert [tuple(r) for r in checked.rows.orderBy("id").collect()] == [(1, 1.5, "a"), (2, None, "b, c"), (6, None, None), (7, 1000.0, "q")]
    assert checked.rows.columns == ["id", "x", "name"]
    assert {r["line"] for r in checked.rejected.collect()} == {"3,oops,c", "4,2.5", "5,2.5,d,more"}
    assert all(r["file"].endswith("people.csv") for r in checked.rejected.collect())
    assert checked.counts().collect() == [(7, 4, 3)]
    # a line is judged as a whole whatever is asked of it
    assert checked.rows.select("id").count() == checked.rows.count() == 4 and checked.rejected.count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        read_checked(spark, str(tmp_path / "none"), "id int").rows.count()
    with pytest.raises(ValueError, match="name of a column"):
        read_checked(spark, str(path), "id int, _rejected_line string")


def test_run_needs_its_columns(spark, csv_path):
    df = read_table(spark, csv_path)
    with pytest.raises(ValueError, match="Missing label"):
        run_fairness(spark, replace(GOOD, label="nope"), df)
    with pytest.raises(ValueError, match="input_path"):
        run_fairness(spark, GOOD)


def test_settings_from_sections():
    config = {
        "data": {"input_path": "x.csv", "target_column": "hired", "sensitive_features": ["race", "sex"], "test_size": 0.25},
        "preprocessing": {"transformer": {"parameters": {"repair_level": 0.9, "method": "reweighting"}}},
        "training": {"method": {"parameters": {"base_estimator": "RandomForest", "constraint": "equalized_odds", "max_retries": 5}}},
        "evaluation": {"primary_metric": "equalized_odds_difference", "fairness_threshold": 0.05, "additional_metrics": ["accuracy"]},
        "tracking": {"experiment_name": "hiring", "run_name": None, "tags": {"v": "1"}},
    }
    s = RunSettings.from_sections(config, "id", val_size=0.15)
    assert (s.label, s.sensitive, s.test_size, s.val_size, s.seed) == ("hired", ("race", "sex"), 0.25, 0.15, 42)
    assert (s.method, s.repair_level, s.base_estimator, s.constraint) == ("reweighting", 0.9, "RandomForest", "equalized_odds")
    assert (s.max_retries, s.fairness_threshold, s.experiment, s.run_id) == (5, 0.05, "hiring", None)
    assert validate(s) == []
    empty = RunSettings.from_sections({}, "id")
    assert {e.split(" ")[0] for e in validate(empty)} >= {"no"}


@pytest.mark.parametrize("section,key", [("preprocessing", "transformer"), ("training", "method")])
def test_sections_name_only_what_exists(section, key):
    with pytest.raises(ValueError, match="Nope"):
        RunSettings.from_sections({section: {key: {"name": "Nope", "parameters": {}}}}, "id")
    assert RunSettings.from_sections({section: {key: {"name": None}}}, "id").method == "mean_matching"


def test_only_a_named_tracking_section_is_read():
    assert RunSettings.from_sections({"oddly_named": {"experiment_name": "x"}}, "id").experiment == "fairness"
    assert RunSettings.from_sections({"tracking": {"experiment_name": "x"}}, "id").experiment == "x"
