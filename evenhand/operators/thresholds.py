"""Per-group decision thresholds that bring selection rates to the overall positive rate."""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from evenhand.functions.expressions import group_text, ref
from evenhand.operators.cells import as_list
from evenhand.operators.features import NULL_TOKEN
from evenhand.operators.lookup import GroupTable, attach, pin
from evenhand.operators.ranks import close_in, prefix
from evenhand.operators.roles import require_columns

DEFAULT_THRESHOLD = 0.5


def _group_text(df: DataFrame, attr: str, null_token: str | None):
    """Groups as text; a NULL string or boolean is the group ``null_token``, a NULL number none."""
    text = group_text(df, attr)
    if null_token is None or isinstance(df.schema[attr].dataType, T.NumericType):
        return text
    return F.coalesce(text, F.lit(null_token))


@dataclass(frozen=True)
class ThresholdModel:
    """Table (attr, group, threshold, n, selected) and the attributes in order of application.

    ``passes`` is how often the rows were read. ``error`` bounds, for thresholds from sketches, how much farther from the
    wanted rate a group's selection rate may be than the closest possible one.
    """

    attrs: tuple[str, ...]
    table: GroupTable
    null_token: str | None = NULL_TOKEN
    passes: int = 1
    error: float = 0.0

    def thresholds(self) -> DataFrame:
        return self.table.df


def _counted(df: DataFrame, score: str, label: str, attrs: list[str], null_token: str | None, by: list, *measures):
    """One count of the rows by all attributes at once, kept; and the positive and the labelled rows in it."""
    require_columns(df, [score, label, *attrs])
    number = F.nanvl(ref(score).cast("double"), F.lit(None).cast("double"))
    groups = [_group_text(df, a, null_token).alias(f"__g{i}") for i, a in enumerate(attrs)]
    rows = df.select(number.alias("__v"), ref(label).cast("double").alias("__y"), *groups)
    keys = [F.col(f"__g{i}") for i in range(len(attrs))]
    cells = rows.groupBy(*keys, *by).agg(
        F.count("__v").alias("n"),
        F.count_if(F.col("__v") >= DEFAULT_THRESHOLD).alias("at_default"),
        F.sum("__y").alias("positives"),
        F.count("__y").alias("labelled"),
        *measures,
    )
    cells = cells.persist(StorageLevel.MEMORY_AND_DISK)
    target = cells.agg(F.sum("positives").alias("positives"), F.sum("labelled").alias("rows")).first()
    if not target["rows"]:
        cells.unpersist()
        raise ValueError("training data is empty")
    return cells, int(target["positives"]), int(target["rows"])


def _by_group(cells: DataFrame, attrs: list[str]) -> DataFrame:
    """Cells once for each attribute that has a group there; only now are rows multiplied, and these are counts."""
    pairs = [F.struct(F.lit(a).alias("attr"), F.col(f"__g{i}").alias("group")) for i, a in enumerate(attrs)]
    each = cells.withColumn("__p", F.explode(F.array(*pairs))).select("__p.attr", "__p.group", *cells.columns[len(attrs) :])
    return each.filter(F.col("group").isNotNull() & (F.col("n") > 0))


def _rank(n: Column, positives: int, rows: int) -> Column:
    """Rank from below of the smallest score with at least ``positives / rows`` of ``n`` at or above it."""
    share = F.lit(positives).cast("decimal(19,0)") * n.cast("decimal(19,0)")
    above = F.greatest(F.ceil(share / F.lit(rows).cast("decimal(19,0)")).cast("bigint"), F.lit(1))
    return n - F.least(above, n) + 1


def _closest(candidates: list[tuple[Column, Column, bool]], rate: float) -> Column:
    """Of (score, selected, is 0.5) the closest to the rate: 0.5 before other scores, smaller ones before larger ones."""
    structs = [
        F.when(
            value.isNotNull(),
            F.struct(
                F.abs(selected.cast("double") / F.col("n") - F.lit(rate)).alias("gap"),
                F.lit(0 if default else 1).alias("other"),
                value.alias("threshold"),
                selected.alias("selected"),
            ),
        )
        for value, selected, default in candidates
    ]
    return F.least(*structs) if len(structs) > 1 else structs[0]


def fit_thresholds(
    df: DataFrame, score: str, label: str, attrs: Iterable[str] | str, null_token: str | None = NULL_TOKEN
) -> ThresholdModel:
    """The score of each group whose ``score >= threshold`` rate is closest to the mean label.

    0.5 is kept unless a score is strictly closer; among equally close scores the smaller wins.
    The rate falls with the threshold, so only the score at the target rank and the next larger
    one can be best. They are found by counting, not by sorting a group: the first pass counts rows by all attributes and
    a prefix of the score, and further ones (none for scores of few digits) look into the prefixes that hold a rank. A NULL or NaN
    score is none; infinite scores are the least and the largest.
    """
    attrs = as_list(attrs)
    bounds = (F.min("__v").alias("__min"), F.max("__v").alias("__max"))
    cells, positives, rows = _counted(df, score, label, attrs, null_token, [prefix(F.col("__v")).alias("__at")], *bounds)
    try:
        counts = _by_group(cells, attrs).groupBy("attr", "group", "__at").agg(
            *[F.sum(c).alias(c) for c in ("n", "at_default")], F.min("__min").alias("__min"), F.max("__max").alias("__max")
        )
        # a group has at most as many rows here as there are prefixes
        whole = Window.partitionBy("attr", "group")
        along = whole.orderBy("__at")
        running = counts.select(
            "attr",
            "group",
            "__min",
            "__max",
            F.sum("n").over(whole).alias("n"),
            F.sum("at_default").over(whole).alias("at_default"),
            (F.sum("n").over(along) - F.col("n")).alias("__below"),
            F.sum("n").over(along).alias("__cum"),
            F.lead("__min").over(along).alias("__above"),
        ).withColumn("__rank", _rank(F.col("n"), positives, rows))
        found = running.filter((F.col("__cum") >= F.col("__rank")) & (F.col("__below") < F.col("__rank")))
        single = F.col("__min") == F.col("__max")
        state = pin(
            found.select(
                "attr",
                "group",
                "__rank",
                F.col("__min").alias("__lo"),
                F.col("__max").alias("__hi"),
                "__below",
                F.when(single, F.col("__cum")).alias("__upto"),
                "__above",
                "n",
                "at_default",
            )
        )
    finally:
        cells.unpersist()
    groups = {a: _group_text(df, a, null_token) for a in attrs}
    located, passes = close_in(df, groups, score, state, ["n", "at_default"])
    n = F.col("n")
    best = _closest(
        [
            (F.lit(DEFAULT_THRESHOLD), F.col("at_default"), True),
            (F.col("__lo"), n - F.col("__below"), False),
            (F.col("__above"), n - F.col("__upto"), False),
        ],
        positives / rows,
    )
    chosen = located.df.withColumn("__best", best).select("attr", "group", "__best.threshold", "n", "__best.selected")
    table = pin(chosen) if located.bounded else GroupTable(chosen, False)
    return ThresholdModel(tuple(attrs), table, null_token, 1 + passes)


def sketch_size(error: float) -> int:
    """Size of a KLL sketch whose ranks are off by at most ``error`` (of 99 % of sketches, by the published bound)."""
    return int(min(max(math.ceil((2.296 / error) ** (1 / 0.9723)), 8), 65_535))


def fit_thresholds_approx(
    df: DataFrame,
    score: str,
    label: str,
    attrs: Iterable[str] | str,
    error: float = 0.002,
    null_token: str | None = NULL_TOKEN,
) -> ThresholdModel:
    """``fit_thresholds`` in one pass over the rows, from a quantile sketch of each group's scores.

    Rows are sketched once by all attributes together, and the sketches merged for each group. Ranks of a sketch are off by at most
    a quarter of ``error``, and candidates are read from it at that distance, so a group's selection rate is at most ``error``
    farther from the wanted rate than with ``fit_thresholds``. ``selected`` is estimated, but for the threshold 0.5.
    """
    if not 0.0001 <= error < 1:
        raise ValueError(f"the error of a rank lies between 0.0001 and 1; not {error}")
    attrs, steps = as_list(attrs), math.ceil(4 / error)
    size = F.lit(sketch_size(error / 4))
    sketch = F.kll_sketch_agg_double("__v", size).alias("__sketch")
    cells, positives, rows = _counted(df, score, label, attrs, null_token, [], sketch)
    rate, n = positives / rows, F.col("n")
    try:
        merged = _by_group(cells, attrs).groupBy("attr", "group").agg(
            F.sum("n").alias("n"), F.sum("at_default").alias("at_default"), F.kll_merge_agg_double("__sketch", size).alias("__sketch")
        )
        ranks = F.lit([i / steps for i in range(steps + 1)])
        read = merged.select("attr", "group", "n", "at_default", F.kll_sketch_get_quantile_double("__sketch", ranks).alias("__read"))

        def candidate(value: Column, i: Column) -> Column:
            """A score where it is read first; about that share of the rows is below it."""
            below = F.when(i == 0, 0.0).otherwise((i - F.lit(0.5)) / steps)
            chosen = _closest([(value, F.round(n * (F.lit(1.0) - below)).cast("bigint"), False)], rate)
            return F.when((i == 0) | (value != F.get("__read", F.greatest(i - 1, F.lit(0)))), chosen)

        default = _closest([(F.lit(DEFAULT_THRESHOLD), F.col("at_default"), True)], rate)
        best = F.least(default, F.array_min(F.transform("__read", candidate)))
        chosen = read.withColumn("__best", best).select("attr", "group", "__best.threshold", "n", "__best.selected")
        return ThresholdModel(tuple(attrs), pin(chosen), null_token, 1, error)
    finally:
        cells.unpersist()


def apply_thresholds(
    df: DataFrame,
    score: str,
    model: ThresholdModel,
    out: str = "prediction",
    unseen: str = "first",
    spread_by: list[str] | None = None,
) -> DataFrame:
    """Add the 0/1 prediction ``score >= threshold of the row's group``.

    With several attributes the last one with a known group decides; without any the prediction
    is 0. ``unseen="first"`` gives a text group that was not fitted the threshold of the first
    group in sorted order; ``"none"`` treats it as unknown.
    """
    if unseen not in ("first", "none"):
        raise ValueError(f"Unknown rule for unseen groups: {unseen}")
    require_columns(df, [score, *model.attrs])
    out_df = df
    votes = []
    first = {}
    if unseen == "first":
        first = {
            r["attr"]: r["threshold"]
            for r in model.table.df.groupBy("attr")
            .agg(F.min_by("threshold", "group").alias("threshold"))
            .collect()
        }
    for i, attr in enumerate(model.attrs):
        table = model.table.narrow(
            F.col("group").alias("__group"), F.col("threshold").alias(f"__t{i}"), where=F.col("attr") == attr
        )
        keyed = out_df.withColumn("__group", _group_text(df, attr, model.null_token))
        out_df = attach(keyed, table, ["__group"], spread_by).drop("__group")
        threshold = F.col(f"__t{i}")
        if attr in first and not isinstance(df.schema[attr].dataType, T.NumericType):
            threshold = F.coalesce(threshold, F.lit(float(first[attr])))
        votes.append(
            F.when(threshold.isNotNull(), F.coalesce(ref(score) >= threshold, F.lit(False)).cast("int"))
        )
    prediction = F.coalesce(*reversed(votes), F.lit(0))
    return out_df.withColumn(out, prediction).select(*[ref(c) for c in df.columns if c != out], out)
