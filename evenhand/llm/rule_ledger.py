"""Quality rules kept as a ledger of bits.

Every rule is evaluated once for a text. The ledger holds what was measured and one bit for each
rule that failed. Policies are versioned sets of bits: applying one, or asking what dropping a rule
from it would change, is bit arithmetic on the ledger and reads no text again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenhand.llm.tables import named

BLANKS = r"[\x20\x09-\x0D]+"
WINDOW = 3

#: Rule names by bit. Conditions are over the measured columns; ratios are in whole numbers.
RULES = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 12 * n_words",
    "capitals": "100 * n_capitals > 40 * word_chars",
}
BITS = {name: 1 << i for i, name in enumerate(RULES)}
BASE = BITS["few_words"] | BITS["repeated_windows"]


@dataclass(frozen=True)
class Policy:
    """A version and the rules of which none may fail."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BITS[r] for r in dict.fromkeys(self.rules))


POLICIES = {
    p.version: p
    for p in (
        Policy("length-1", ("few_words",)),
        Policy("base-1", ("few_words", "repeated_windows")),
        Policy("prose-1", tuple(RULES)),
    )
}
CURRENT = POLICIES["prose-1"]


def _measured(docs: DataFrame) -> DataFrame:
    """``docs`` has a column ``t`` without NULLs; all measurements, each from whole texts."""
    words = F.array_remove(F.split("t", BLANKS, -1), "")
    lines = F.filter(F.split("t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    split = docs.withColumns({"w": words, "lines": lines})
    last = F.size("w") - (WINDOW - 1)
    windows = F.when(
        last > 0,
        F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(*[F.element_at("w", i + k) for k in range(WINDOW)])),
    ).otherwise(F.array().cast("array<bigint>"))
    counted = split.select(
        "*",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("t", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace("t", r"\P{Lu}+", "")).cast("long").alias("n_capitals"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("windows"),
    ).drop("w", "lines", "t")
    # windows with their places, sorted, only where some window occurs twice
    again = F.size(F.array_distinct("windows")) < F.size("windows")
    places = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    placed = counted.withColumn("places", F.when(again, places)).drop("windows")
    same = placed.withColumn(
        "starts",
        F.sort_array(
            F.transform(
                F.filter(
                    "places",
                    lambda x, k: ((k > 0) & (F.get("places", k - 1)["h"] == x["h"]))
                    | F.coalesce(F.get("places", k + 1)["h"] == x["h"], F.lit(False)),
                ),
                lambda x: x["i"],
            )
        ),
    ).drop("places")
    # each start covers WINDOW words or as many as lie before the next start
    covered = F.aggregate(
        F.zip_with("starts", F.slice("starts", 2, F.greatest(F.size("starts"), F.lit(1))), lambda a, b: F.least(b - a, F.lit(WINDOW))),
        F.lit(0).cast("long"),
        lambda n, x: n + x,
    )
    return same.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("starts")


def failure_bits() -> Column:
    bits = F.lit(0)
    for name, condition in RULES.items():
        bits = bits.bitwiseOR(F.when(F.expr(condition), F.lit(BITS[name])).otherwise(F.lit(0)))
    return bits


def rule_ledger(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), rows: bool = False) -> DataFrame:
    """The measurements and ``failures``, one bit a failed rule, for every row.

    NULL or blank text has no words and fails ``few_words`` only. ``keep`` names columns to take
    along as they are; ``rows`` takes the whole row as a struct ``row``. Other columns are not read,
    and repeated rows get the same entry. Windows of words are compared by 64-bit hashes within a
    text.
    """
    carried = [F.struct(*[named(c) for c in docs.columns]).alias("row")] if rows else [named(c) for c in keep]
    texts = docs.select(*carried, F.coalesce(named(text_col).cast("string"), F.lit("")).alias("t"))
    return _measured(texts).withColumn("failures", failure_bits())


def passes(policy: Policy = CURRENT) -> Column:
    return F.col("failures").bitwiseAND(F.lit(policy.mask)) == 0


def apply_policy(docs: DataFrame, policy: Policy = CURRENT, text_col: str = "text") -> DataFrame:
    """The rows that fail no rule of the policy, with all their columns."""
    # a filter on row numbers is not moved below them, so the measurements are not worked out again for it
    ledger = rule_ledger(docs, text_col, rows=True).withColumn("place", F.monotonically_increasing_id())
    kept = ledger.filter(passes(policy) & (F.col("place") >= 0))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def ablations(ledger: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """One row for each rule of the policy: rows it fails, and rows kept once it is left out.

    Rows are first counted by their bits, at most ``2 ** len(RULES)`` combinations.
    """
    counts = ledger.groupBy(F.col("failures").bitwiseAND(F.lit(policy.mask)).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BITS[r]).alias("bit")) for r in dict.fromkeys(policy.rules)])
    each = counts.select("bits", "n", F.explode(rules).alias("r"))
    fails = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    only = F.col("bits") == F.col("r.bit")
    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        F.lit(policy.version).alias("version"),
        F.coalesce(F.sum(F.when(fails, F.col("n"))), F.lit(0)).alias("failed"),
        F.coalesce(F.sum(F.when(only, F.col("n"))), F.lit(0)).alias("kept_without"),
    )
