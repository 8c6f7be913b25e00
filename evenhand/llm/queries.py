"""Registered queries of the operators, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenhand.llm import chat, digest_runs, hard_negatives, jump_shards, language_id, merkle, mixing, near_dups, pii, repeated_bytes, rule_ledger, segment_sampling, token_files
from evenhand.llm.tables import table


def op1_pii_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    counts = [F.size(F.filter("base", pii.of_kind(k))).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.spelled(F.col("base")), 256).alias("base_sha256"),
        pii.spelled(F.col("spans")).alias("spans"),
    )


def op2_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = rule_ledger.rule_ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return ledger.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (F.col("failures").bitwiseAND(F.lit(rule_ledger.BASE)) != 0).alias("base_failed"),
        rule_ledger.passes().alias("kept"),
        "failures",
    )


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"))


def op4_weighted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.duplicate_classes(table(spark, sf_dir, "documents"))


def op5_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jump_shards.assign_shards(table(spark, sf_dir, "documents"), 40)


def op6_prefix_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes.remove_repeats(table(spark, sf_dir, "documents"))


def op7_gumbel_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return segment_sampling.sample_segmentations(documents, segment_sampling.default_model())


def op8_source_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op9_chat_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    given = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    rendered = chat.format_conversations(given.unionByName(own)).withColumnRenamed("conv_id", "conv")
    turns = F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit("\n"), t, F.lit("\n")))
    return chat.read_back(rendered).select(
        F.col("conv").alias("conv_id"),
        F.size("texts").cast("long").alias("n_turns"),
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.length(F.array_join("learned", "")).cast("long").alias("loss_chars"),
        F.sha2(F.array_join("learned", ""), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op10_digest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_runs.duplicate_groups(table(spark, sf_dir, "documents"))


def op11_coordinate_pruning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine_embeddings(table(spark, sf_dir, "embeddings"))


def op12_nearest_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.document_languages(table(spark, sf_dir, "documents"))


def op13_merkle_witnesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.document_manifest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pii_boosting,
        op2_rule_ledger,
        op3_token_files,
        op4_weighted_minhash,
        op5_jump_shards,
        op6_prefix_doubling,
        op7_gumbel_segments,
        op8_source_schedule,
        op9_chat_events,
        op10_digest_runs,
        op11_coordinate_pruning,
        op12_nearest_centroid,
        op13_merkle_witnesses,
    )
}
