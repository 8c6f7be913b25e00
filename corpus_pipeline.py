"""From a table of documents to sampled token sequences, in stages that are each written and read again.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept. All but the last
return the columns of documents. A stage's result has to be written before the next stage starts, which
first deletes the intermediate tables of those before.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from evenhand.llm import digest_runs, mixing, near_dups, rule_ledger, segment_sampling
from evenhand.llm.tables import recorded, release, shared_path, table


_temporary: list[str] = []


def staged(stage):
    """Deletes what the stages before have left in the shared folder, and records what this one writes there."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark, _temporary)
        with recorded(_temporary):
            return stage(spark, docs, sf_dir)

    return run_stage


@staged
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no rule of the current policy."""
    return rule_ledger.apply_policy(docs)


@staged
def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the smallest id."""
    return digest_runs.drop_duplicates(docs)


@staged
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one with the smallest id."""
    return near_dups.drop_near_duplicates(docs)


@staged
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: not at all, once or twice."""
    return mixing.mixed_rows(docs)


@staged
def segmentations(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled token sequences of each document, with the probability of having been sampled."""
    return segment_sampling.sample_segmentations(docs, segment_sampling.default_model())


STAGES = [
    ("quality", quality),
    ("exact_duplicates", exact_duplicates),
    ("near_duplicates", near_duplicates),
    ("mixture", mixture),
    ("segmentations", segmentations),
]

#: Sampling has no SQL; the stages before it are tested against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = shared_path(spark, name)
            docs.write.parquet(path)
            docs = spark.read.schema(docs.schema).parquet(path)
    return docs
