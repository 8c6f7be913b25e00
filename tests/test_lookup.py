"""Size checks of fitted tables, and joins whose keys are very uneven."""

import pytest
from pyspark.sql import functions as F

from evenhand.operators import lookup
from evenhand.operators.lookup import attach, pin


def test_pin_checks_rows_string_lengths_and_bytes(spark, monkeypatch):
    df = spark.range(10).select(F.col("id").cast("string").alias("k"))
    assert pin(df).bounded and len(pin(df).rows) == 10
    assert not pin(df, 9).bounded
    assert not pin(spark.createDataFrame([("x" * 5000,)], "k string")).bounded
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 8)
    large = pin(df)
    assert not large.bounded and large.df.count() == 10 and large.rows is None


@pytest.fixture()
def uneven(spark):
    """A third of the rows in one key, a third without a key, a sixth in a key the table lacks."""
    key = (
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 3 == 1, F.lit(None).cast("string"))
        .when(F.col("id") % 2 == 0, "unknown")
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string")))
    )
    rows = spark.range(6000).select("id", key.alias("k"), (F.col("id") % 2).cast("int").alias("j"))
    keys = [("hot", 0), ("hot", 1)] + [(f"k{i}", i % 2) for i in range(50)]
    table = spark.createDataFrame([(k, j, f"v-{k}-{j}", float(i)) for i, (k, j) in enumerate(keys)], "k string, j int, v string, w double")
    return rows, table


@pytest.mark.parametrize("hot_keys", [10_000, 20, 1])
def test_shuffled_attach_equals_broadcast(spark, monkeypatch, uneven, hot_keys):
    rows, table = uneven
    want = attach(rows, pin(table), ["k", "j"]).orderBy("id").collect()
    monkeypatch.setattr(lookup, "HOT_KEYS", hot_keys)
    large = pin(table, 1)
    got = attach(rows, large, ["k", "j"], ["id"]).select("id", "k", "j", "v", "w").orderBy("id").collect()
    assert [(r["id"], r["k"], r["j"], r["v"], r["w"]) for r in want] == [tuple(r) for r in got]


def test_hot_and_missing_keys_spread_over_the_tasks_of_the_join(spark, monkeypatch, uneven):
    rows, table = uneven
    monkeypatch.setattr(lookup, "HOT_KEYS", 20)
    settings = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = attach(rows, pin(table, 1), ["k", "j"], ["id"])
        sizes = [r["n"] for r in joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 6000 and len(sizes) == 8
    # by key alone, the partition of the NULLs would hold 2000 rows
    assert max(sizes) < 6000 / 8 * 1.3
