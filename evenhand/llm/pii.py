r"""Personal data found by candidate gradient boosting.

Generators with high recall propose spans, which may overlap. A span of one of the plain formats
that passes its check (the base) is always taken. Boosted trees learn what such spans look like, from
format and context, and thresholds calibrated on rows the trees have not seen select further spans. All
of it is expressions and JVM-side trees.

Labels come from a distance. Positive are base spans and what other generators propose in their
place; negative are plain matches that fail their check, proposals whose plain value fails the check
of its kind, handles and hosts without a domain, and parts of base spans of another kind. What is left are proposals in
other spellings that could be right, and only these are scored. The trees see the kind, the shape of
the value in its plain spelling and the context, but neither which generator it was nor anything a check
decides by, so what they learn from plain spans carries over to the others.

Trees and thresholds come from all labelled spans. What the trees see is yes or no throughout, so equal spans
are counted first and weigh what they count, and no split points have to be found from a sample.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenhand.llm.tables import named, saved

KINDS = ("email", "ip", "card", "phone")

_LOCAL, _LABEL = r"[A-Za-z0-9._%+-]", r"[A-Za-z0-9-]"
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


@dataclass(frozen=True)
class Generator:
    """Proposes the leftmost matches of a pattern; ``base`` patterns have a check of their own."""

    name: str
    kind: str
    pattern: str
    base: bool = False


# A base pattern starts a match only where its plain form could, and never gives characters back:
# the same matches as the plain form, in linear time. Card runs need the 13 digits the check asks for.
GENERATORS = (
    Generator("email", "email", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++", True),
    Generator("ip", "ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", True),
    Generator("card", "card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,}+", True),
    Generator("phone", "phone", r"\+[0-9][\x20().0-9-]+[0-9]", True),
    Generator(
        "spelled_email",
        "email",
        rf"(?<!{_LOCAL}){_LOCAL}{{1,64}}+\x20?[\[(]\x20?(?i:at)\x20?[\])]\x20?{_LABEL}{{1,63}}+"
        rf"(?:\x20?(?:\.|[\[(]\x20?(?i:dot)\x20?[\])])\x20?{_LABEL}{{1,63}}+)++",
    ),
    Generator("handle", "email", rf"(?<!{_LOCAL}){_LOCAL}*+@{_LABEL}++(?!\.?[A-Za-z0-9@-])"),
    Generator("spelled_ip", "ip", r"(?<![0-9])[0-9]{1,3}(?:\x20?[\[(]\x20?(?:\.|(?i:dot))\x20?[\])]\x20?[0-9]{1,3}){3}(?![0-9])"),
    Generator("inner_card", "card", r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}([\x20./_-])[0-9]{4}\1[0-9]{4}\1[0-9]{4})(?![0-9])"),
    Generator("local_phone", "phone", r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])"),
    Generator("prefixed_phone", "phone", r"(?<![0-9+])00[1-9][\x20().0-9-]{7,20}[0-9](?![0-9])"),
)
CUES = {
    "mail": r"(?i)mail|contact|write|@",
    "phone": r"(?i)phone|tel|call|mobile|fax|whatsapp",
    "card": r"(?i)card|visa|credit|payment|iban|account",
    "host": r"(?i)\bip\b|host|server|address|login",
    "number": r"(?i)\bno\.?\b|number|order|invoice|version|\bv\b|isbn|id\b",
}
BEFORE, AFTER = 32, 16
#: Numbers are seen as whether they reach each of these.
STEPS = {
    "length": (6, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19, 20, 22, 24, 28, 32, 48),
    "n_letters": (1, 2, 4, 6, 8, 10, 12, 14, 16, 18, 20, 24, 28, 32, 48),
    "n_dots": (1, 2, 3, 4, 5),
    "n_breaks": (1, 2, 3, 4, 5, 6, 8),
    "varied": (2, 3, 4, 5, 6, 7, 8, 9, 10),
}


@dataclass(frozen=True)
class Training:
    """The trees, and what their thresholds have to reach."""

    trees: int = 10
    depth: int = 3
    step: float = 0.3
    precision: float = 0.99
    support: int = 20
    bins: int = 100
    seed: int = 7


def _proposals(text: Column, generator: Generator, number: int) -> Column:
    """Matches of a pattern with the text around them; ``gap`` is what lies before each."""
    matches = F.regexp_extract_all(text, F.lit(generator.pattern), F.lit(0))
    between = F.split(text, generator.pattern, -1)
    return F.zip_with(
        matches,
        F.zip_with(between, F.slice(between, 2, F.size(between)), lambda a, b: F.struct(a.alias("a"), b.alias("b"))),
        lambda m, p: F.when(
            m.isNotNull(),
            F.struct(
                F.lit(number).alias("generator"),
                m.alias("match"),
                F.length(p["a"]).alias("gap"),
                F.right(p["a"], F.lit(BEFORE)).alias("before"),
                F.left(p["b"], F.lit(AFTER)).alias("after"),
            ),
        ),
    )


def _luhn(digits: Column) -> Column:
    doubled = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(doubled, F.lit(0), lambda n, d: n + d) % 10 == 0


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All proposals of all texts, and one row without a span for a text that has none."""
    texts = docs.select(
        F.monotonically_increasing_id().alias("rid"),
        named(id_col).alias("id"),
        F.coalesce(named(text_col).cast("string"), F.lit("")).alias("t"),
    )
    found = F.when(
        F.col("t").rlike(r"[0-9@]|[\[(]\x20?(?i:at)\x20?[\])]"),
        F.filter(
            F.flatten(F.array(*[_proposals(F.col("t"), g, i) for i, g in enumerate(GENERATORS)])),
            lambda c: c.isNotNull(),
        ),
    )
    each = texts.select("rid", "id", F.posexplode_outer(found).alias("at", "c")).select("rid", "id", "at", "c.*")
    each = each.repartition("rid")
    own = Window.partitionBy("rid", "generator").orderBy("at")
    size = F.length("match")
    passed = F.sum(F.col("gap") + size).over(own.rowsBetween(Window.unboundedPreceding, 0))
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("generator") + 1)
    placed = each.select(
        "rid",
        "id",
        "generator",
        pick([g.kind for g in GENERATORS]).alias("kind"),
        pick([KINDS.index(g.kind) for g in GENERATORS]).alias("kind_no"),
        pick([g.base for g in GENERATORS]).alias("plain"),
        (passed - size).alias("start"),
        passed.alias("end"),
        "match",
        "before",
        "after",
        F.regexp_replace("match", "[^0-9]", "").alias("digits"),
    )
    # the value in its plain spelling, and whether it passes the check of its kind
    at_signs = F.regexp_replace("match", r"\x20?[\[(]\x20?(?i:at)\x20?[\])]\x20?", "@")
    dots = F.regexp_replace(at_signs, r"\x20?[\[(]\x20?(?:\.|(?i:dot))\x20?[\])]\x20?", ".")
    plainly = placed.withColumn("value", F.when(F.col("plain"), F.col("match")).otherwise(dots))
    n = F.length("digits")
    sound = (
        F.when(F.col("kind") == "ip", F.col("value").rlike(rf"^(?:{_OCTET}\.){{3}}{_OCTET}$"))
        .when(F.col("kind") == "card", F.when(n.between(13, 19), _luhn(F.col("digits"))).otherwise(False))
        .when(F.col("kind") == "phone", n.between(9, 15))
        .otherwise(F.col("plain") | F.col("value").rlike(rf"^{_LOCAL}+@{_LABEL}+(?:\.{_LABEL}+)*\.[A-Za-z]{{2,}}$"))
    )
    checked = plainly.withColumn("sound", sound).withColumn("valid", F.col("plain") & F.col("sound"))

    def met(*by: str) -> Column:
        line = Window.partitionBy(*by).orderBy("start", "generator")
        left = F.max(F.when(F.col("valid"), F.col("end"))).over(line.rowsBetween(Window.unboundedPreceding, -1))
        right = F.min(F.when(F.col("valid"), F.col("start"))).over(line.rowsBetween(1, Window.unboundedFollowing))
        return F.coalesce(left > F.col("start"), F.lit(False)) | F.coalesce(right < F.col("end"), F.lit(False))

    return checked.withColumns({"meets": met("rid", "kind"), "inside": met("rid")})


def _measured(spans: DataFrame) -> DataFrame:
    """Add the numbers of ``STEPS``, as ``m_`` columns."""
    value = F.col("value")
    return spans.withColumns(
        {
            "m_length": F.length(value),
            "m_n_letters": F.length(F.regexp_replace(value, r"[^A-Za-z]", "")),
            "m_n_dots": F.length(F.regexp_replace(value, r"[^.]", "")),
            "m_n_breaks": F.length(F.regexp_replace(value, r"[^\x20()-]", "")),
            "m_varied": F.size(F.array_distinct(F.split("digits", ""))),
        }
    )


def _features() -> dict[str, Column]:
    """What the trees see of measured spans: 0 or 1 each, and marked as such for them."""
    last, first = F.right("before", F.lit(1)), F.left("after", F.lit(1))
    found = {f"is_{kind}": F.col("kind") == kind for kind in KINDS}
    found |= {f"{name}_{least}": F.col(f"m_{name}") >= least for name, steps in STEPS.items() for least in steps}
    found |= {"glued_left": last.rlike(r"[\p{L}0-9_.-]"), "glued_right": first.rlike(r"[\p{L}0-9_-]")}
    found |= {f"cue_{name}": F.col("before").rlike(cue) for name, cue in CUES.items()}
    return {
        f"f_{name}": F.coalesce(c.cast("double"), F.lit(0.0)).alias(f"f_{name}", metadata={"ml_attr": {"type": "binary"}})
        for name, c in found.items()
    }


def _label() -> Column:
    return F.when(F.col("valid") | (~F.col("plain") & F.col("meets")), 1.0).when(
        F.col("plain") | F.col("inside") | ~F.col("sound"), 0.0
    )


def labelled(spans: DataFrame, training: Training) -> DataFrame:
    """How many spans (weight) have the same label, kind and features, of all that have a label; every fourth is held out."""
    features = _features()
    held = F.pmod(F.xxhash64("rid", "generator", "start", F.lit(training.seed)), F.lit(4)) == 0
    each = _measured(spans.withColumn("label", _label()).filter(F.col("label").isNotNull()))
    each = each.select("label", "kind", held.alias("held"), *features.values())
    return each.groupBy(*each.columns).agg(F.count("*").cast("double").alias("weight"))


def _score(found: DataFrame, training: Training) -> DataFrame:
    """Add ``chosen``: candidates beyond the base that pass the calibrated threshold of their kind."""
    features = _features()
    spans = found.filter(F.col("generator").isNotNull())
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    known = assembler.transform(labelled(spans, training))
    known = saved(known.select("label", "kind", "held", "weight", "features"), "labelled")
    if known.filter("not held").select("label").distinct().count() < 2:
        return found.withColumn("chosen", F.lit(False))
    model = GBTClassifier(
        weightCol="weight", maxIter=training.trees, maxDepth=training.depth, stepSize=training.step, maxBins=16, seed=training.seed
    ).fit(known.filter("not held"))
    probability = vector_to_array("probability")[1]
    bins = (
        model.transform(known.filter("held"))
        .groupBy("kind", F.floor(probability * training.bins).alias("bin"))
        .agg(F.sum(F.col("label") * F.col("weight")).alias("right"), F.sum("weight").alias("n"))
        .collect()
    )
    thresholds = {k: _threshold([b for b in bins if b["kind"] == k], training) for k in KINDS}
    limit = F.lit(2.0)
    for kind, value in thresholds.items():
        limit = F.when(F.col("kind") == kind, F.lit(value)).otherwise(limit)
    rest = _measured(spans.filter(_label().isNull()))
    scored = model.transform(assembler.transform(rest.select("*", *features.values())))
    chosen = scored.filter(probability >= limit).select(*found.columns).withColumn("chosen", F.lit(True))
    others = found.filter(F.col("generator").isNull() | F.col("valid")).withColumn("chosen", F.lit(False))
    # what is not chosen leaves only the text's own row, so that every text keeps one
    unchosen = (
        found.select("rid", "id").distinct().select(*[
            F.col(c) if c in ("rid", "id") else F.lit(None).cast(found.schema[c].dataType).alias(c) for c in found.columns
        ]).withColumn("chosen", F.lit(False))
    )
    return others.unionByName(chosen).unionByName(unchosen)


def _threshold(bins: list, training: Training) -> float:
    """Lowest score from which held-out candidates reach the precision; 2 if there is no such."""
    best, right, n = 2.0, 0.0, 0
    for b in sorted(bins, key=lambda b: -b["bin"]):
        right, n = right + b["right"], n + b["n"]
        if n >= training.support and right >= training.precision * n:
            best = b["bin"] / training.bins
    return max(best, 0.5)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", training: Training = Training()) -> DataFrame:
    """One row for each row: id, base and spans, arrays of (kind_no, kind, start, end).

    ``base`` has the spans that pass the plain checks, ``spans`` those and the ones the trees chose;
    both are sorted by kind (in the order of ``KINDS``) and start, in code points, end exclusive.
    NULL and empty texts have none. Repeated rows give repeated results. Without labelled candidates
    of both classes nothing is added to the base. Other columns are not read.
    """
    found = saved(candidates(docs, id_col, text_col), "candidates")
    scored = _score(found, training)
    span = F.struct("kind_no", "kind", "start", "end")
    return scored.groupBy("rid").agg(
        F.first("id").alias(id_col),
        F.sort_array(F.collect_list(F.when(F.col("valid"), span))).alias("base"),
        F.sort_array(F.collect_set(F.when(F.col("valid") | F.col("chosen"), span))).alias("spans"),
    ).drop("rid")


def of_kind(kind: str):
    """A test of spans for ``filter``."""
    return lambda span: span["kind"] == kind


def spelled(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", training: Training = Training()) -> DataFrame:
    """The rows with each span of ``find_pii`` replaced by its kind in brackets; ids must be unique."""
    spans = find_pii(docs, id_col, text_col, training).select(F.col(id_col).alias("__id"), F.col("spans").alias("__spans"))
    by_place = F.array_sort(
        F.transform("__spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    text = F.coalesce(named(text_col).cast("string"), F.lit(""))
    walked = F.aggregate(
        by_place,
        start,
        lambda a, s: F.when(
            s["start"] >= a["at"],
            F.struct(
                F.concat(
                    a["out"],
                    F.substring(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")),
                    F.lit("["), s["kind"], F.lit("]"),
                ).alias("out"),
                s["end"].alias("at"),
            ),
        ).otherwise(F.struct(a["out"].alias("out"), F.greatest(a["at"], s["end"]).alias("at"))),
        lambda a: F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), F.length(text))),
    )
    joined = docs.join(spans, named(id_col).eqNullSafe(F.col("__id")), "left")
    changed = F.when(F.size("__spans") > 0, walked).otherwise(named(text_col))
    return joined.select(*[changed.alias(c) if c == text_col else named(c) for c in docs.columns])
