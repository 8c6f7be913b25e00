"""Standard inputs of the registered queries, each with the SQL of the same relation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenhand.sources.tables import read_table

LI_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
# list prices to net prices: discounts agreed with three segments, a surcharge for the smallest orders' one
SEGMENT_FACTORS = {"FURNITURE": 0.94, "HOUSEHOLD": 1.03, "MACHINERY": 0.87}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet", "parquet")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with customer groups, a label, two prediction rules and a score."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    # the offer favours one segment and disfavours another
    boost = (
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", 60000.0)
        .when(F.col("c_mktsegment") == "MACHINERY", -40000.0)
        .otherwise(0.0)
    )
    price = F.col("o_totalprice")
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").alias("id"),
            "c_mktsegment",
            "o_orderpriority",
            "n_regionkey",
            "o_totalprice",
            (price + boost).alias("offer"),
            "c_acctbal",
            (price > 250000).cast("int").alias("y_true"),
            (price + boost + 5 * F.col("c_acctbal") > 275000).cast("int").alias("y_pred"),
            (price + 2 * F.col("c_acctbal") > 262000).cast("int").alias("y_pred2"),
            (F.floor(F.least(price, F.lit(500000.0)) / 500) / 1000).alias("score"),
        )
    )


SCORED = """scored AS (
  SELECT o_orderkey AS id, c_mktsegment, o_orderpriority, n_regionkey, o_totalprice,
         o_totalprice + CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 60000.0::DOUBLE
              WHEN 'MACHINERY' THEN -40000.0::DOUBLE ELSE 0.0::DOUBLE END AS offer, c_acctbal,
         CAST(o_totalprice > 250000 AS INTEGER) AS y_true,
         CAST(o_totalprice + CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 60000.0 WHEN 'MACHINERY' THEN -40000.0
              ELSE 0.0 END + 5 * c_acctbal > 275000 AS INTEGER) AS y_pred,
         CAST(o_totalprice + 2 * c_acctbal > 262000 AS INTEGER) AS y_pred2,
         floor(least(o_totalprice, 500000) / 500) / 1000 AS score
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


def scored_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows with the BUILDING segment missing."""
    return scored(spark, sf_dir).withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("BUILDING")))


SCORED_NULLS = (
    SCORED
    + """,
scored_nulls AS (SELECT * REPLACE (nullif(c_mktsegment, 'BUILDING') AS c_mktsegment) FROM scored)"""
)


def li(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with a binary label; ``l_returnflag`` and ``l_linestatus`` are the groups."""
    return table(spark, sf_dir, "lineitem").select(
        *LI_KEY,
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        "l_returnflag",
        "l_linestatus",
        (F.col("l_discount") > 0.05).cast("int").alias("label"),
    )


LI = """li AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
         l_returnflag, l_linestatus, CAST(l_discount > 0.05 AS INTEGER) AS label FROM lineitem)"""


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return labels.join(documents, "doc_id").select("doc_id", "lang", "source", "n_chars", "quality", "toxic")


DOCS = """docs AS (
  SELECT doc_id, lang, source, n_chars, quality, toxic FROM labels JOIN documents USING (doc_id))"""


def ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose value is missing for errors."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
    )


EV = """ev AS (
  SELECT event_id, ts, user_id, event_type, CASE WHEN event_type <> 'error' THEN value END AS value FROM events)"""
