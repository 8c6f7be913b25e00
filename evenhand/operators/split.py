"""Stratified split by a hash of the row id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenhand.functions.expressions import ref
from evenhand.operators.lookup import GroupTable, attach, pin
from evenhand.operators.roles import require_columns

PREFIX_DIGITS = 3
MORE_DIGITS = 4
EXACT_ROWS = 1_000_000


def _row_hash(id_col: str, seed: int) -> Column:
    # a missing id hashes as a value of its own, which no id has as its text
    return F.md5(F.concat(F.coalesce(ref(id_col).cast("string"), F.lit("\0missing")), F.lit(f":{seed}")))


def _class_key(label: str) -> Column:
    """The label as a never missing key; NULL is a class of its own."""
    return F.coalesce(F.concat(F.lit("v"), ref(label).cast("string")), F.lit("n"))


def check_fractions(test: float, val: float) -> None:
    if not 0.01 <= test <= 0.99:
        raise ValueError(f"the test share has to lie within 0.01 and 0.99; it is {test}")
    if not 0.0 <= val < 1.0 or not 0 < test + val < 1:
        raise ValueError(f"nothing is left to train on: test share {test}, validation share {val}")


def stratified_split(
    df: DataFrame, id_col: str, label: str, test: float = 0.2, val: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add a ``split`` column: in each label class the rows with the smallest hashes are test,
    the next ones validation, the others train, with the class proportions kept.

    Only the two boundary hashes of each class are looked up; assigning rows is a comparison in
    a projection, with no shuffle or sort of the rows. The result depends on ids and seed, not
    on partitioning. Rows that share an id always share a split, those without an id as well.
    """
    check_fractions(test, val)
    require_columns(df, [id_col, label])
    hashed = df.select(_class_key(label).alias("__class"), _row_hash(id_col, seed).alias("__md5"))
    cuts = _boundary_hashes(hashed, test, val)
    keyed = df.withColumns({"__class": _class_key(label), "__md5": _row_hash(id_col, seed)})
    joined = attach(keyed, cuts, ["__class"], [id_col])
    split = (
        F.when(F.col("__md5") <= F.col("__test_cut"), F.lit("test"))
        .when(F.col("__md5") <= F.col("__val_cut"), F.lit("validation"))
        .otherwise(F.lit("train"))
    )
    return joined.withColumn("split", split).select(*[ref(c) for c in df.columns], "split")


def _boundary_hashes(hashed: DataFrame, test: float, val: float) -> GroupTable:
    """The last test hash and the last validation hash of each class.

    Rows are counted by the first hash digits; only the prefix in which a running count passes
    a target is looked into, with more digits while it holds over ``EXACT_ROWS`` rows.
    """
    counts = hashed.groupBy("__class", F.substring("__md5", 1, PREFIX_DIGITS).alias("__prefix")).agg(
        F.count(F.lit(1)).alias("__rows")
    )
    # a class has at most 16 ** PREFIX_DIGITS rows here
    whole = Window.partitionBy("__class")
    n = F.sum("__rows").over(whole)
    n_test = F.floor(n * F.lit(float(test)) + 0.5)
    n_val = F.least(F.floor(n * F.lit(float(val)) + 0.5), n - n_test)
    targets = F.explode(
        F.array(
            F.struct(F.lit("test").alias("cut"), F.col("__test").alias("rank")),
            F.struct(F.lit("validation").alias("cut"), (F.col("__test") + F.col("__val")).alias("rank")),
        )
    )
    ranked = counts.select(
        "__class", "__prefix", "__rows", n_test.alias("__test"), n_val.alias("__val"), _running("__prefix", ["__class"])
    ).withColumn("__target", targets)
    at = pin(
        _holding(ranked.withColumns({"__cut": F.col("__target.cut"), "__need": F.col("__target.rank")}), "__prefix")
    )
    digits = PREFIX_DIGITS
    while _largest(at) > EXACT_ROWS and digits < 32:
        digits += MORE_DIGITS
        inside = _inside(hashed, at).groupBy(
            "__class", "__cut", "__need", F.substring("__md5", 1, digits).alias("__prefix")
        )
        deeper = inside.agg(F.count(F.lit(1)).alias("__rows"))
        at = pin(_holding(deeper.withColumn("__upto", _upto("__prefix", ["__class", "__cut"])), "__prefix"))
    exact = (
        _inside(hashed, at).groupBy("__class", "__cut", "__need", "__md5").agg(F.count(F.lit(1)).alias("__rows"))
    )
    found = _holding(exact.withColumn("__upto", _upto("__md5", ["__class", "__cut"])), "__md5")
    return pin(
        found.groupBy("__class").agg(
            F.max(F.when(F.col("__cut") == "test", F.col("__md5"))).alias("__test_cut"),
            F.max(F.when(F.col("__cut") == "validation", F.col("__md5"))).alias("__val_cut"),
        )
    )


def _upto(order: str, keys: list[str]) -> Column:
    along = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return F.sum("__rows").over(along)


def _running(order: str, keys: list[str]) -> Column:
    return _upto(order, keys).alias("__upto")


def _holding(ranked: DataFrame, place: str) -> DataFrame:
    """The place in which the running count reaches the need, and what is needed inside it."""
    before = F.col("__upto") - F.col("__rows")
    return ranked.filter((F.col("__need") > before) & (F.col("__need") <= F.col("__upto"))).select(
        "__class", "__cut", place, "__rows", (F.col("__need") - before).alias("__need")
    )


def _largest(at: GroupTable) -> int:
    if at.rows is not None:
        return max((r["__rows"] for r in at.rows), default=0)
    return at.df.agg(F.max("__rows")).first()[0] or 0


def _inside(hashed: DataFrame, at: GroupTable) -> DataFrame:
    """Rows of the boundary prefixes, once per cut."""
    cuts = GroupTable(
        at.df.groupBy("__class").agg(F.collect_list(F.struct("__cut", "__prefix", "__need")).alias("__cuts")),
        at.bounded,
    )
    return (
        attach(hashed, cuts, ["__class"], ["__md5"])
        .select("__class", "__md5", F.explode("__cuts").alias("__at"))
        .filter(F.startswith("__md5", "__at.__prefix"))
        .select("__class", "__md5", "__at.__cut", "__at.__need")
    )


def split_summary(df: DataFrame) -> DataFrame:
    """Rows and share of the total per split."""
    counts = df.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    # three rows at most are left in this window
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))
    return counts.select("split", "n", (F.col("n") / total).alias("ratio"))
