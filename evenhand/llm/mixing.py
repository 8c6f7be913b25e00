"""Mixing sources to target weights with a low-discrepancy schedule.

Each source's documents, shuffled by a hash, form a stream of words that is cut into blocks of equal size (one word
more or less), and a source gets as many slots as its target has blocks. Small sources have smaller blocks, so that few slots
more or less are few words there as well. The mix is a sequence of slots. Slot ``t`` has the golden-ratio point ``t * phi
mod 1``, which falls into one source's part of the cumulative slots; the slots of a source are
ranked in order and take its blocks one after the other, from the start again once they are used
up. Any stretch of the schedule is close to the targets, and so is the whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenhand.llm.running import running_sum
from evenhand.llm.tables import keyed, named, saved, unkeyed
from evenhand.operators.lookup import attach, pin

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
BLOCK_WORDS = 64
#: A source has at least so many blocks, or one for each word.
LEAST_BLOCKS = 64
SEED = 17

#: The circle of points in whole steps, and the odd step nearest to the golden ratio of it.
CIRCLE = 1 << 32
STEP = 2654435769


def word_count(text: Column) -> Column:
    words = F.array_remove(F.split(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", -1), "")
    return F.size(words).cast("long")


def sized_rows(rows: DataFrame, id_col: str, source_col: str, text_col: str, rid: str | None) -> DataFrame:
    source = named(source_col).cast("string")
    return saved(
        rows.select(
            (named(rid) if rid else F.monotonically_increasing_id()).alias("rid"),
            named(id_col).alias("id"),
            # a key that is never NULL and sorts by code point, NULL last
            F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source)).alias("key"),
            word_count(named(text_col)).alias("size"),
        ),
        "sized",
    )


def targets(sized: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """key, place, source_size, weight, target, blocks, slots, low and high (its part of the circle), for each source.

    Weights repeat along the sources in order. No target is above ``MOST`` times its source's size;
    what is cut off is shared again by weight until nothing is above.
    """
    sizes = saved(
        sized.groupBy("key").agg(F.sum("size").alias("source_size")).withColumn("one", F.lit(1)), "source-sizes"
    )
    place = running_sum(sizes, [], ["key"], "one", "place", "places").drop("one")
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("place") % len(WEIGHTS) + 1).cast("int"))
    weighed = saved(place.withColumn("weight", weight), "weights")
    most = F.col("source_size") * MOST
    totals = weighed.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    goal = SHARE * (totals["size"] or 0)
    level, full = (goal / totals["weight"] if totals["weight"] else 0.0), -1
    while True:
        # the level at which the sources that are not full share what the full ones leave
        above = most <= F.lit(level) * F.col("weight")
        now = weighed.agg(
            F.count(F.when(above, 1)).alias("full"),
            F.coalesce(F.sum(F.when(above, most)), F.lit(0)).alias("used"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)).alias("open"),
        ).first()
        if now["full"] <= full or not now["open"]:
            break
        full, level = now["full"], (goal - now["used"]) / now["open"]
    target = F.least(most.cast("double"), F.lit(float(level)) * F.col("weight"))
    words = F.greatest(F.least(F.floor(F.col("source_size") / LEAST_BLOCKS), F.lit(block)), F.lit(1))
    cut = weighed.withColumns({"target": target, "blocks": F.ceil(F.col("source_size") / words).cast("long")})
    slots = F.coalesce(F.col("target") * F.col("blocks") / F.nullif("source_size", F.lit(0)), F.lit(0.0))
    shares = saved(cut.withColumn("slots", slots), "targets")
    summed = running_sum(
        shares.withColumn("units", F.round(F.col("slots") * 1000).cast("long")), [], ["place"], "units", "low_units", "shares"
    )
    total = summed.agg(F.sum("units")).first()[0] or 0
    on_circle = lambda c: F.floor(c / F.lit(max(float(total), 1.0)) * CIRCLE).cast("long")
    return summed.withColumns(
        {"low": on_circle(F.col("low_units")), "high": on_circle(F.col("low_units") + F.col("units"))}
    ).drop("units", "low_units")


def schedule(sources: DataFrame) -> DataFrame:
    """slot, key, pass and block for every slot of the mix; blocks are numbered from 0 in each source."""
    spark = sources.sparkSession
    number = sources.agg(F.sum("slots")).first()[0] or 0.0
    slots = spark.range(round(number)).select(
        F.col("id").alias("slot"), (F.pmod("id", F.lit(CIRCLE // 2)) * STEP % CIRCLE).alias("point"), F.lit(0).alias("edge")
    )
    # sources in order of their parts; how many parts begin at or before a point tells the source
    parts = saved(sources.filter(F.col("high") > F.col("low")).withColumn("one", F.lit(1)), "parts")
    parts = saved(running_sum(parts, [], ["place"], "one", "nth", "parts").drop("one"), "parts")
    edges = parts.select(F.lit(-1).cast("long").alias("slot"), F.col("low").alias("point"), F.lit(1).alias("edge"))
    line = saved(edges.unionByName(slots), "points").withColumn("late", 1 - F.col("edge"))
    counted = running_sum(line, [], ["point", "late", "slot"], "edge", "begun", "points")
    own = saved(
        counted.filter(F.col("edge") == 0).select("slot", (F.col("begun") - 1).alias("nth"), F.lit(1).alias("one")), "slots"
    )
    ranked = running_sum(own, ["nth"], ["slot"], "one", "rank", "ranks").drop("one")
    known = attach(ranked, pin(parts.select("nth", "key", "blocks")), ["nth"])
    return known.filter(F.col("rank") < MOST * F.col("blocks")).select(
        "slot", "key", F.floor(F.col("rank") / F.col("blocks")).alias("pass"), (F.col("rank") % F.col("blocks")).alias("block")
    )


def pieces(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """rid, key, block, words: the part of each document in each block of its source's stream.

    Of a source's blocks the first ones have a word more than the others, until its words are used up.
    """
    shuffled = sized.withColumn("order", F.xxhash64("id", F.lit(SEED)))
    placed = running_sum(shuffled, ["key"], ["order", "id", "size", "rid"], "size", "start", "streams")
    some = placed.filter(F.col("size") > 0).withColumn("end", F.col("start") + F.col("size"))
    least = F.floor(F.col("source_size") / F.col("blocks")).cast("long").alias("least")
    filled = sources.filter("blocks > 0")
    known = attach(some, pin(filled.select("key", least, (F.col("source_size") % F.col("blocks")).alias("longer"))), ["key"], ["rid"])
    longer = F.col("longer") * (F.col("least") + 1)

    def block_of(word: Column) -> Column:
        behind = F.col("longer") + F.floor((word - longer) / F.col("least"))
        return F.when(word < longer, F.floor(word / (F.col("least") + 1))).otherwise(behind).cast("long")

    def first_word(block: Column) -> Column:
        return block * F.col("least") + F.least(block, F.col("longer"))

    each = known.select("*", F.explode(F.sequence(block_of(F.col("start")), block_of(F.col("end") - 1))).alias("block"))
    low, high = F.greatest("start", first_word(F.col("block"))), F.least("end", first_word(F.col("block") + 1))
    return each.select("rid", "key", "block", (high - low).alias("words"))


def mix(
    rows: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    rid: str | None = None,
    block: int = BLOCK_WORDS,
) -> DataFrame:
    """One row for each row: id, size, source_size, target, taken (and rid if given).

    ``size`` counts words; ``taken`` is how many of them the mix takes, up to ``MOST`` times each. A
    source's taken words differ from its target by a few blocks, each of at most ``block`` words and at most about a 64th of
    the source. NULL text and texts of
    blanks have size 0 and nothing taken; rows without a source form one, the last in order. Rows
    that share an id are separate. An empty table gives no rows; other columns are not read.
    """
    sized = sized_rows(rows, id_col, source_col, text_col, rid)
    sources = saved(targets(sized, block), "sources")
    uses = schedule(sources).groupBy("key", "block").agg(F.count(F.lit(1)).alias("times"))
    taken = (
        pieces(sized, sources)
        .join(uses, ["key", "block"])
        .groupBy("rid")
        .agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    )
    known = attach(sized, pin(sources.select("key", "source_size", "target")), ["key"], ["rid"])
    return known.join(taken, "rid", "left").select(
        *(["rid"] if rid else []),
        F.col("id").alias(id_col),
        "size",
        "source_size",
        "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
    )


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The rows as often as the mix takes most of them: not at all, once or twice."""
    rows = keyed(docs)
    inner = rows.select("rid", *[F.col("row").getField(c).alias(c) for c in dict.fromkeys((id_col, source_col, text_col))])
    taken = mix(inner, id_col, source_col, text_col, "rid")
    times = F.round(F.col("taken") / F.col("size")).cast("int")
    chosen = taken.filter(F.col("size") > 0).select("rid", times.alias("times")).filter("times > 0")
    repeated = rows.join(chosen, "rid").withColumn("again", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return unkeyed(repeated, docs.columns)
