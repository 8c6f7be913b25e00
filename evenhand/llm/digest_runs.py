"""Exact duplicates by merging sorted runs of digests in rounds.

A run is what one partition of the input holds: one entry for each of its texts, with the number of
rows and the smallest identifier, sorted by digest. So there are as many runs as the input has
partitions. In each round ``2 ** LOG_FAN`` neighbouring runs are merged into one: their entries are
exchanged by ranges of (run, digest), the ranges of the parts are sorted, and a pass over each range
in order puts neighbours of one verified digest together, keeping the smallest identifier. Rounds go on until
one run is left. A run is cut into ranges, so no task ever holds a whole one, and a range is never
crowded by a text: after the first pass a run has one entry for it.

The result goes back down by the same run numbers: a text that a third of all rows share is never
joined as one key, but as one key a run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenhand.llm.tables import keyed, named, saved, unkeyed

LOG_FAN = 3
BLANKS = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """Each run of blanks as one space; NULL as the empty text."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), BLANKS, " ")


def _merge(entries: DataFrame) -> DataFrame:
    """One entry for each text of a run: rows counted, the smallest identifier kept (NULL last, then by row)."""
    return entries.groupBy("run", "digest", "proof").agg(F.sum("n").alias("n"), F.min("least").alias("least"))


def first_runs(level: DataFrame) -> DataFrame:
    """The sorted run of each partition: run, digest, proof, n, least."""
    one = level.select(
        "run",
        "digest",
        "proof",
        F.lit(1).cast("long").alias("n"),
        F.struct(F.col("id").isNull().alias("missing"), F.col("id"), F.col("rid")).alias("least"),
    )
    return saved(_merge(one).sortWithinPartitions("run", "digest", "proof"), "runs")


def merge_round(runs: DataFrame) -> DataFrame:
    """Neighbouring runs merged in order of their digests, ``2 ** LOG_FAN`` into one.

    The ranges are sorted by what they are aggregated by, so the aggregation is a pass in order
    that neither sorts nor exchanges again.
    """
    met = runs.withColumn("run", F.shiftright("run", LOG_FAN))
    return _merge(met.repartitionByRange("run", "digest").sortWithinPartitions("run", "digest", "proof"))


def digests(rows: DataFrame, id_col: str, text_col: str, rid: str) -> DataFrame:
    text = normalised(named(text_col))
    return rows.select(named(rid).alias("rid"), named(id_col).alias("id"), text.alias("t")).select(
        "rid",
        "id",
        F.spark_partition_id().alias("run"),
        F.sha2("t", 256).alias("digest"),
        # compared along with the digest: two texts of one digest would have to agree here as well
        F.struct(F.length("t").alias("length"), F.xxhash64("t").alias("hash")).alias("proof"),
    )


def duplicate_groups(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", rid: str | None = None) -> DataFrame:
    """One row for each row of ``rows``: id, keep_id, group_size, kept, text_sha256 (and rid if given).

    Texts are equal when they agree after each run of blanks (space, tab to carriage return)
    became one space. NULL text is the empty text. Of a group the row with the smallest id stays,
    a NULL id only if all are NULL (keep_id is then NULL); of rows that share that id, exactly one.
    An empty table gives no rows. Other columns are not read.
    """
    own = rid is None
    if own:
        rows = rows.withColumn("__rid", F.monotonically_increasing_id())
    level = saved(digests(rows, id_col, text_col, "__rid" if own else rid), "digests")
    leaves = first_runs(level)
    merged, left = leaves, leaves.agg(F.coalesce(F.max("run"), F.lit(0)) + 1).first()[0]
    while left > 1:
        left = -(-left // (1 << LOG_FAN))
        merged = merge_round(merged)
    root = merged.select("digest", "proof", F.col("n").alias("group_size"), F.col("least").alias("stays"))
    per_run = leaves.select("run", "digest", "proof").join(root, ["digest", "proof"])
    found = level.join(per_run, ["run", "digest", "proof"]).select(
        *([] if own else ["rid"]),
        F.col("id").alias(id_col),
        F.col("stays.id").alias("keep_id"),
        "group_size",
        (F.col("rid") == F.col("stays.rid")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
    return found


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns."""
    rows = keyed(docs)
    texts = rows.select("rid", F.col("row").getField(id_col).alias("id"), F.col("row").getField(text_col).alias("text"))
    stay = duplicate_groups(texts, "id", "text", "rid").filter("kept").select("rid")
    return unkeyed(rows.join(stay, "rid", "left_semi"), docs.columns)
