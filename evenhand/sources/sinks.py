"""Run results as appended tables: metrics, parameters, group statistics."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUNS = "runs"


class StagedRun:
    """The files of a run: written to a folder of their own, and moved to their places when all are there.

    A run counts from the moment its manifest (``runs/run_id=...``, a row for each path) is written, which is the last step. A
    rerun first takes its manifest away, so a run that broke off while its files were moved counts as none until it is
    done again. Use as a context manager: leaving it by an error deletes what was staged and leaves an earlier run of the id as it was.
    """

    def __init__(self, spark: SparkSession, root: str, run_id: str) -> None:
        self.spark, self.root, self.run_id = spark, root.rstrip("/"), run_id
        self.staging = f"{self.root}/_staging/{run_id}-{uuid.uuid4().hex}"
        self.paths: list[str] = []

    def path(self, relative: str) -> str:
        """Where to write what is to be at ``relative`` below the root."""
        self.paths.append(relative)
        return f"{self.staging}/{relative}"

    def __enter__(self) -> StagedRun:
        return self

    def __exit__(self, kind, error, trace) -> None:
        try:
            if kind is None:
                self._commit()
        finally:
            self._delete(self.staging)

    def _commit(self) -> None:
        for relative in self.paths:
            staged = self._path(f"{self.staging}/{relative}")
            if not self._files(staged).exists(staged):
                raise OSError(f"{relative} was never written")
        self._delete(f"{self.root}/{RUNS}/run_id={self.run_id}")
        for relative in self.paths:
            self._move(relative)
        rows = [(p,) for p in self.paths]
        write_report(self.spark.createDataFrame(rows, "path string"), f"{self.root}/{RUNS}/run_id={self.run_id}")

    def _move(self, relative: str) -> None:
        place = self._path(f"{self.root}/{relative}")
        files = self._files(place)
        files.mkdirs(place.getParent())
        files.delete(place, True)
        if not files.rename(self._path(f"{self.staging}/{relative}"), place):
            raise OSError(f"{relative} could not be moved to its place")

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _files(self, path):
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _delete(self, path: str) -> None:
        found = self._path(path)
        self._files(found).delete(found, True)


def complete_runs(spark: SparkSession, root: str) -> DataFrame:
    """(run_id, path) of all runs whose files are all in their places; none if nothing was ever written."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{RUNS}")
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], "run_id string, path string")
    return spark.read.schema("path string, run_id string").parquet(f"{root.rstrip('/')}/{RUNS}").select("run_id", "path")


def read_runs(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The rows of a report, of complete runs only."""
    paths = complete_runs(spark, root).filter((F.col("path") == name) | F.startswith("path", F.lit(f"{name}/")))
    found = [f"{root.rstrip('/')}/{r['path']}" for r in paths.collect()]
    if not found:
        raise ValueError(f"no complete run has {name!r}")
    return spark.read.option("basePath", f"{root.rstrip('/')}/{name}").parquet(*found)


def _finite(column: str = "value"):
    value = F.col(column)
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))


def run_metrics(
    baseline: DataFrame | None,
    validation: DataFrame | None,
    final: DataFrame,
    primary: str,
    run_id: str,
) -> DataFrame:
    """(run_id, stage, metric, value) of a run; missing and infinite values are left out.

    Each input is a long (metric, value) report. Besides the prefixed metrics there are
    ``primary_fairness_metric``, ``fairness_improvement`` and ``fairness_improvement_pct``.
    """
    parts = []
    for stage, report in (("baseline", baseline), ("validation", validation), ("final", final)):
        if report is not None:
            parts.append(
                report.select(
                    F.lit(stage).alias("stage"), F.concat(F.lit(stage + "_"), "metric").alias("metric"), "value"
                )
            )
    is_primary = F.col("metric") == primary
    last = final.filter(is_primary).select("metric", F.col("value").alias("final"))
    parts.append(
        last.select(
            F.lit("summary").alias("stage"),
            F.lit("primary_fairness_metric").alias("metric"),
            F.col("final").alias("value"),
        )
    )
    if baseline is not None:
        pair = baseline.filter(is_primary).select("metric", F.col("value").alias("base")).join(last, "metric")
        gain = F.col("base") - F.col("final")
        percent = F.when(F.col("base") != 0, gain / F.col("base") * 100).when(F.col("base") == 0, F.lit(0.0))
        parts.append(
            pair.select(
                F.lit("summary").alias("stage"),
                F.inline(
                    F.array(
                        F.struct(F.lit("fairness_improvement").alias("metric"), gain.alias("value")),
                        F.struct(F.lit("fairness_improvement_pct").alias("metric"), percent.alias("value")),
                    )
                ),
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.filter(_finite()).select(F.lit(run_id).alias("run_id"), "stage", "metric", "value")


def write_metrics(report: DataFrame, path: str, experiment: str) -> None:
    """Append a run's metric rows; report-sized, so one file per run."""
    report.withColumn("experiment", F.lit(experiment)).coalesce(1).write.mode("append").partitionBy(
        "experiment"
    ).parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    """Write a report-sized table as one file, in place of what is there."""
    report.coalesce(1).write.mode("overwrite").parquet(path)


def run_params(spark: SparkSession, params: Mapping, run_id: str) -> DataFrame:
    """(run_id, key, value) of a nested mapping, with dotted keys."""
    rows: list[tuple[str, str, str]] = []

    def walk(prefix: str, value) -> None:
        if isinstance(value, Mapping):
            for k, v in value.items():
                walk(f"{prefix}.{k}" if prefix else str(k), v)
        elif isinstance(value, (list, tuple)):
            rows.append((run_id, prefix, ",".join(str(v) for v in value)))
        else:
            rows.append((run_id, prefix, None if value is None else str(value)))

    walk("", params)
    return spark.createDataFrame(rows, "run_id string, key string, value string")


def write_params(spark: SparkSession, params: Mapping, path: str, run_id: str) -> None:
    run_params(spark, params, run_id).coalesce(1).write.mode("append").parquet(path)


def group_size_summary(stats: DataFrame) -> DataFrame:
    """Per attribute the smallest, largest and mean group size, its population deviation, and
    the number of groups."""
    return (
        _sizes(stats)
        .groupBy("attr")
        .agg(
            F.min("size").alias("size_min"),
            F.max("size").alias("size_max"),
            F.avg("size").alias("size_mean"),
            F.stddev_pop("size").alias("size_std"),
            F.count(F.lit(1)).alias("group_count"),
        )
    )


def group_proportions(stats: DataFrame) -> DataFrame:
    """Size of each fitted group and its share of its attribute."""
    sizes = _sizes(stats)
    totals = sizes.groupBy("attr").agg(F.sum("size").alias("__total"))
    return sizes.join(totals, "attr").select("attr", "group", "size", (F.col("size") / F.col("__total")).alias("proportion"))


def _sizes(stats: DataFrame) -> DataFrame:
    return stats.groupBy("attr", "group").agg(F.max("size").alias("size"))


def group_statistics(stats: DataFrame, run_id: str) -> DataFrame:
    """One row per (attr, group, feature, statistic), with the sizes and proportions."""
    shared = group_proportions(stats).select(
        "attr",
        "group",
        F.lit(None).cast("string").alias("feature"),
        F.inline(
            F.array(
                F.struct(F.lit("size").alias("statistic"), F.col("size").cast("double").alias("value")),
                F.struct(F.lit("proportion").alias("statistic"), F.col("proportion").alias("value")),
            )
        ),
    )
    each = stats.select(
        "attr",
        "group",
        "feature",
        F.inline(
            F.array(
                F.struct(F.lit("mean").alias("statistic"), F.col("mean").alias("value")),
                F.struct(F.lit("std").alias("statistic"), F.col("std").alias("value")),
            )
        ),
    )
    return shared.unionByName(each).filter(_finite()).select(F.lit(run_id).alias("run_id"), "*")


def write_table(df: DataFrame, path: str, partition_by: Iterable[str] = (), mode: str = "append") -> None:
    """Write a result of any size with its own partitions."""
    writer = df.write.mode(mode)
    parts = list(partition_by)
    if parts:
        writer = writer.partitionBy(*parts)
    writer.parquet(path)
