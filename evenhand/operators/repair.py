"""Repair of feature distributions: move each group towards the whole population.

A fit is one grouping-sets aggregation over all sensitive columns and the total. Mean matching
is then a lazy projection behind one broadcast join per sensitive column. Covariance matching
needs the covariance of the rows it is applied to, so it runs one aggregation per column.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenhand.functions.expressions import clip_between, group_text, hash_normal, nan_to_null, ref, round_back
from evenhand.operators.features import NULL_TOKEN, LabelEncoding
from evenhand.operators.lookup import GroupTable, attach, pin
from evenhand.operators.roles import require_columns, resolve_roles

METHODS = ("mean_matching", "covariance_matching", "multivariate_repair")
DETERMINANT_FLOOR = 1e-8
VARIANCE_FLOOR = 1e-8
SCALE_RANGE = (0.5, 2.0)
NOISE_SHARE = 0.1
CLOSED_FORM = 3
WIDE_FEATURES = 24
WIDE_TASK_BYTES = 128 << 20


def _pairs(k: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(k) for j in range(i, k)]


def _narrow_rows(df: DataFrame, attrs: list[str], features: list[str]) -> tuple[DataFrame, list[str], list[str]]:
    """Groups as text and features as doubles with NULL for missing, under plain names."""
    keys = [f"__g{i}" for i in range(len(attrs))]
    xs = [f"__x{i}" for i in range(len(features))]
    rows = df.select(
        *[group_text(df, a).alias(k) for a, k in zip(attrs, keys, strict=True)],
        *[ref(f).cast("double").alias(x) for f, x in zip(features, xs, strict=True)],
    )
    return nan_to_null(rows), keys, xs


def group_moments(df: DataFrame, attrs: list[str], features: list[str], covariance: bool) -> DataFrame:
    """Size, means, deviations and optionally covariances of every group and of the whole table.

    Row per (attr, group) with the arrays ``mean``, ``std`` and ``cov`` in feature order; the
    whole table is the row with a NULL ``attr``. One aggregation over grouping sets, with
    map-side partial aggregation. A group with a missing feature value gets the diagonal of
    sample variances instead of a covariance matrix. Many features would need too many
    covariance aggregates: their matrices are summed by ``_cross_moments``.
    """
    rows, keys, xs = _narrow_rows(df, attrs, features)
    k, size = len(xs), F.count(F.lit(1))
    wide = covariance and k > WIDE_FEATURES
    aggs = [size.alias("size"), F.grouping_id().alias("__id")]
    for i, x in enumerate(xs):
        aggs += [F.avg(x).alias(f"mean_{i}"), F.stddev_samp(x).alias(f"std_{i}"), F.count(x).alias(f"known_{i}")]
    if covariance and not wide:
        aggs += [F.covar_pop(xs[i], xs[j]).alias(f"cov_{i}_{j}") for i, j in _pairs(k)]
    grouped = rows.groupingSets([[key] for key in keys] + [[]], *keys).agg(*aggs)
    full = (1 << len(keys)) - 1
    attr, group = F.lit(None).cast("string"), F.lit(None).cast("string")
    for position, (name, key) in enumerate(zip(attrs, keys, strict=True)):
        here = F.col("__id") == full - (1 << (len(keys) - 1 - position))
        attr = F.when(here, F.lit(name)).otherwise(attr)
        group = F.when(here, F.col(key)).otherwise(group)
    complete = F.lit(True)
    for i in range(k):
        complete = complete & (F.col(f"known_{i}") == F.col("size"))
    measures = [
        "size",
        F.array(*[F.col(f"mean_{i}") for i in range(k)]).alias("mean"),
        F.array(*[F.col(f"std_{i}") for i in range(k)]).alias("std"),
    ]
    diagonal = F.array(
        *[F.col(f"std_{i}") * F.col(f"std_{i}") if i == j else F.lit(0.0) for i, j in _pairs(k)]
    )
    if covariance and not wide:
        matrix = F.array(*[F.col(f"cov_{i}_{j}") for i, j in _pairs(k)])
        measures.append(F.when(complete, matrix).otherwise(diagonal).alias("cov"))
    elif wide:
        measures += [complete.alias("__complete"), diagonal.alias("__diagonal")]
    out = grouped.select(attr.alias("attr"), group.alias("group"), *measures)
    out = out.filter(F.col("attr").isNull() | F.col("group").isNotNull())
    if not wide:
        return out
    fitted = pin(out)
    cross = _cross_moments(rows, dict(zip(attrs, keys, strict=True)), xs, fitted, whole=True)
    matched = fitted.df.withColumns({"__a": F.coalesce("attr", F.lit("")), "__g": F.coalesce("group", F.lit(""))}).join(
        cross, ["__a", "__g"], "left"
    )
    cov = F.when(F.col("__complete"), F.col("__cov")).otherwise(F.col("__diagonal"))
    return matched.select("attr", "group", "size", "mean", "std", cov.alias("cov"))


def _cross_moments(rows: DataFrame, keys: dict[str, str], xs: list[str], means: GroupTable, whole: bool) -> DataFrame:
    """Population covariance (upper triangle as an array) of the complete rows of each group.

    Each task sums outer products about the group's mean, a matrix product per group and Arrow
    batch, and hands over what it has when its matrices reach ``WIDE_TASK_BYTES``; Spark adds
    the partial sums up, one row per group and feature. ``means`` has (attr, group, mean); with
    too many groups for the driver all rows are taken about the origin of the first one.
    """
    k = len(xs)
    known = means.rows if means.bounded else [r.asDict() for r in means.df.take(1)]
    centres = {
        (r["attr"] or "", r["group"] or ""): np.array([0.0 if m is None else m for m in r["mean"]]) for r in known
    }
    middle = next(iter(centres.values()), np.zeros(k))
    names = list(keys.items())
    held = max(1, WIDE_TASK_BYTES // (8 * k * (k + 1)))

    def partial(batches):
        sums: dict[tuple[str, str], list] = {}

        def flush():
            frames = []
            for (attr, group), (n, s, ss) in sums.items():
                frames.append(
                    pd.DataFrame(
                        {"__a": attr, "__g": group, "i": np.arange(k), "n": n, "s": s, "ss": list(ss)}
                    )
                )
            sums.clear()
            return frames

        for pdf in batches:
            x = pdf[xs].to_numpy(dtype=float)
            good = ~np.isnan(x).any(axis=1)
            for attr, key in [*names, *([("", None)] if whole else [])]:
                if key is None:
                    members = {"": np.flatnonzero(good)}
                else:
                    codes, groups = pd.factorize(pdf[key])
                    codes = np.where(good, codes, -1)
                    members = {g: np.flatnonzero(codes == c) for c, g in enumerate(groups)}
                for group, index in members.items():
                    if not len(index):
                        continue
                    part = x[index] - centres.get((attr, group), middle)
                    total = sums.setdefault((attr, group), [0, np.zeros(k), np.zeros((k, k))])
                    total[0] += len(index)
                    total[1] += part.sum(axis=0)
                    total[2] += part.T @ part
                    if len(sums) >= held:
                        yield from flush()
        yield from flush()

    parts = rows.select(*[key for _, key in names], *xs).mapInPandas(
        partial, "__a string, __g string, i int, n long, s double, ss array<double>"
    )
    added = parts.groupBy("__a", "__g", "i").agg(
        F.sum("n").alias("n"),
        F.sum("s").alias("s"),
        vector_to_array(Summarizer.sum(array_to_vector("ss"))).alias("ss"),
    )
    # k rows per group
    whole_rows = added.groupBy("__a", "__g").agg(
        F.max("n").alias("__n"), F.array_sort(F.collect_list(F.struct("i", "s", "ss"))).alias("__rows")
    )
    n = F.col("__n").cast("double")

    def row_of(row: Column) -> Column:
        later = F.sequence(row["i"], F.lit(k - 1))
        return F.transform(
            later, lambda j: row["ss"][j] / n - row["s"] / n * (F.element_at("__rows", j + 1)["s"] / n)
        )

    return whole_rows.select("__a", "__g", "__n", F.flatten(F.transform("__rows", row_of)).alias("__cov"))


@dataclass(frozen=True)
class GroupRepair:
    """Settings of a repair; ``fit`` returns a ``GroupRepairModel``.

    ``keep`` columns (ids, label, split) pass through untouched. With ``unseen="first"`` a
    category that the fit has not seen becomes the first class and NULL becomes ``null_token``;
    ``"keep"`` leaves categories alone in mean matching, which does not change them anyway.
    """

    sensitive: tuple[str, ...]
    method: str = "mean_matching"
    repair_level: float = 1.0
    id_col: str | None = None
    keep: tuple[str, ...] = ()
    seed: int = 42
    unseen: str = "first"
    null_token: str = NULL_TOKEN

    def __post_init__(self) -> None:
        if self.method not in METHODS:
            raise ValueError(f"Unknown method: {self.method}")
        if not 0.0 <= self.repair_level <= 1.0:
            raise ValueError("repair_level must be between 0.0 and 1.0")
        if self.unseen not in ("first", "keep"):
            raise ValueError(f"Unknown rule for unseen categories: {self.unseen}")

    def fit(self, df: DataFrame) -> GroupRepairModel:
        kept = [*self.keep, *([self.id_col] if self.id_col else [])]
        roles = resolve_roles(df, self.sensitive, keep=kept)
        features = list(roles.features)
        if self.unseen == "keep" and self.method == "mean_matching":
            coded, encoding = df, LabelEncoding.fit(df, [])
            features = list(roles.numeric)
        else:
            encoding = LabelEncoding.fit(df, roles.categorical, self.null_token)
            spread = [self.id_col] if self.id_col else None
            coded = encoding.transform(df, spread_by=spread)
        covariance = self.method != "mean_matching"
        moments = pin(group_moments(coded, list(roles.sensitive), features, covariance))
        whole = moments.df.filter(F.col("attr").isNull()).drop("attr", "group").first().asDict()
        groups = moments.narrow("*", where=F.col("attr").isNotNull() & (F.col("size") > 1))
        return GroupRepairModel(self, tuple(features), encoding, groups, whole, df.schema)


@dataclass(frozen=True)
class GroupRepairModel:
    settings: GroupRepair
    features: tuple[str, ...]
    encoding: LabelEncoding
    groups: GroupTable
    whole: dict
    schema: T.StructType

    # ---- application ---------------------------------------------------------------------

    def transform(self, df: DataFrame) -> DataFrame:
        """Repair rows; columns, their order and their types stay as they are."""
        s = self.settings
        require_columns(df, s.sensitive, "sensitive features")
        require_columns(df, self.features, "features")
        if s.method == "multivariate_repair" and s.repair_level < 1 and s.id_col is None:
            raise ValueError("multivariate_repair below level 1 needs id_col to draw its noise")
        spread = [s.id_col] if s.id_col else None
        types = {f.name: f.dataType for f in df.schema}
        if s.method == "mean_matching":
            out = self.encoding.snap(df, types, spread)
            return self._match_means(out, types, spread).select(*[ref(c) for c in df.columns])
        coded_types = {**types, **{c: T.LongType() for c in self.encoding.columns}}
        out = self.encoding.transform(df, spread_by=spread)
        for attr in s.sensitive:
            if s.method == "covariance_matching":
                out = self._match_covariance(out, attr, coded_types, spread)
            else:
                out = self._repair_with_noise(out, attr, coded_types, spread)
        return self.encoding.inverse_transform(out, types, spread).select(*[ref(c) for c in df.columns])

    def _of(self, attr: str, *measures) -> GroupTable:
        return self.groups.narrow(F.col("group").alias("__group"), *measures, where=F.col("attr") == attr)

    def _shift(self, i: int) -> Column:
        return F.lit(float(self.settings.repair_level)) * (self._overall(i) - F.col("mean")[i])

    def _overall(self, i: int) -> Column:
        return F.lit(self.whole["mean"][i]).cast("double")

    def _shifted_features(self) -> list[tuple[int, str]]:
        return [(i, f) for i, f in enumerate(self.features) if f not in self.encoding.columns]

    def _match_means(self, df: DataFrame, types: dict, spread: list[str] | None) -> DataFrame:
        """Add every attribute's shift; integers are rounded after each attribute."""
        moved = self._shifted_features()
        out = df
        for a, attr in enumerate(self.settings.sensitive):
            shifts = self._of(attr, F.struct(*[self._shift(i).alias(f"_{i}") for i, _ in moved]).alias(f"__s{a}"))
            if not moved:
                continue
            out = attach(out.withColumn("__group", group_text(df, attr)), shifts, ["__group"], spread).drop(
                "__group"
            )
        repaired = {}
        for i, f in moved:
            value = ref(f)
            for a in range(len(self.settings.sensitive)):
                shift = F.col(f"__s{a}")[f"_{i}"]
                value = F.when(shift.isNull(), value).otherwise(
                    round_back(value.cast("double") + shift, types[f])
                )
            repaired[f] = value
        return out.withColumns(repaired) if repaired else out

    def _match_covariance(self, df: DataFrame, attr: str, types: dict, spread: list[str] | None) -> DataFrame:
        k = len(self.features)
        shift_only = self._shifted_features() if k == 1 else list(enumerate(self.features))
        shifts = [self._shift(i).alias(f"shift_{i}") for i, _ in shift_only]
        if k == 1:
            # a single feature has no covariance matrix: only its mean is matched
            adjust = self._of(attr, *shifts, F.lit(1.0).alias("scale_0"))
        else:
            adjust = self._scales(df, attr, shifts)
        joined = attach(df.withColumn("__group", group_text(df, attr)), adjust, ["__group"], spread)
        repaired = {}
        for i, f in shift_only:
            centre = self._overall(i)
            moved = ref(f).cast("double") + F.col(f"shift_{i}")
            scaled = F.when(F.col(f"scale_{i}").isNull(), moved).otherwise(
                (moved - centre) * F.col(f"scale_{i}") + centre
            )
            repaired[f] = F.when(F.col(f"shift_{i}").isNull(), ref(f)).otherwise(round_back(scaled, types[f]))
        return (joined.withColumns(repaired) if repaired else joined).select(*[ref(c) for c in df.columns])

    def _scales(self, df: DataFrame, attr: str, shifts: list[Column]) -> GroupTable:
        """Shift and scale of each fitted group of ``attr``, from the covariance of these rows.

        A constant shift leaves the covariance as it is, so the rows are aggregated unshifted.
        """
        k = len(self.features)
        rows, (key,), xs = _narrow_rows(df, [attr], list(self.features))
        rows = rows.filter(F.col(key).isNotNull())
        size = F.count(F.lit(1))
        complete = size > 1
        for x in xs:
            complete = complete & (F.count(x) == size)
        if k > WIDE_FEATURES:
            means = F.array(*[F.avg(x) for x in xs]).alias("mean")
            here = pin(rows.groupBy(F.lit(attr).alias("attr"), F.col(key).alias("group")).agg(means, complete.alias("ok")))
            cross = _cross_moments(rows, {attr: key}, xs, here, whole=False).select(
                F.col("__g").alias(key),
                F.transform("__cov", lambda c: c * F.try_divide("__n", F.col("__n") - 1)).alias("__now"),
            )
            current = here.df.join(cross, F.col("group") == F.col(key), "left").select(
                F.col("group").alias("__group"), F.when(F.col("ok"), F.col("__now")).alias("now")
            )
        else:
            matrix = F.array(*[F.covar_samp(xs[i], xs[j]) for i, j in _pairs(k)])
            current = rows.groupBy(F.col(key).alias("__group")).agg(F.when(complete, matrix).alias("now"))
        fitted = self._of(attr, *shifts, "cov")
        both = attach(current, fitted, ["__group"]).filter(F.col("cov").isNotNull())
        invertible = (_determinant("now", k) > DETERMINANT_FLOOR) & (_determinant("cov", k) > DETERMINANT_FLOOR)
        invertible = F.coalesce(invertible, F.lit(False))
        scales = []
        for i in range(k):
            at = _pairs(k).index((i, i))
            scale = F.sqrt(F.col("cov")[at] / (F.col("now")[at] + F.lit(VARIANCE_FLOOR)))
            scales.append(F.when(invertible, clip_between(scale, *SCALE_RANGE)).alias(f"scale_{i}"))
        return pin(both.select("__group", *[f"shift_{i}" for i in range(k)], *scales))

    def _repair_with_noise(self, df: DataFrame, attr: str, types: dict, spread: list[str] | None) -> DataFrame:
        s = self.settings
        noisy = s.repair_level < 1
        amplitude = (1.0 - s.repair_level) * NOISE_SHARE
        k = len(self.features)
        measures = [self._shift(i).alias(f"shift_{i}") for i in range(k)]
        if noisy:
            measures += [(F.col("std")[i] * F.lit(amplitude)).alias(f"noise_{i}") for i in range(k)]
        table = self._of(attr, *measures)
        if noisy:
            here = df.groupBy(group_text(df, attr).alias("__group")).agg(F.count(F.lit(1)).alias("__rows"))
            single = pin(here.filter("__group is not null and __rows = 1").select("__group", F.lit(True).alias("__one")))
            quiet = attach(table.df, single, ["__group"])
            loud = F.col("__one").isNull()
            table = GroupTable(
                quiet.withColumns({n: F.when(loud, F.col(n)).otherwise(0.0) for n in (f"noise_{i}" for i in range(k))}),
                table.bounded,
            )
        joined = attach(df.withColumn("__group", group_text(df, attr)), table, ["__group"], spread)
        repaired = {}
        for i, f in enumerate(self.features):
            value = ref(f).cast("double") + F.col(f"shift_{i}")
            if noisy:
                draw = hash_normal(s.seed, ref(s.id_col).cast("string"), F.lit(attr), F.lit(f))
                value = value + F.coalesce(F.col(f"noise_{i}"), F.lit(0.0)) * draw
            repaired[f] = F.when(F.col(f"shift_{i}").isNull(), ref(f)).otherwise(round_back(value, types[f]))
        return joined.withColumns(repaired).select(*[ref(c) for c in df.columns])

    # ---- what was fitted -----------------------------------------------------------------

    def _long(self, names: list[str], value) -> Column:
        return F.inline(F.array(*[value(i, f) for i, f in enumerate(names)]))

    def group_stats(self) -> DataFrame:
        """(attr, group, feature, mean, std, size) of every fitted group."""
        return self.groups.df.select(
            "attr",
            "group",
            "size",
            self._long(
                list(self.features),
                lambda i, f: F.struct(
                    F.lit(f).alias("feature"), F.col("mean")[i].alias("mean"), F.col("std")[i].alias("std")
                ),
            ),
        ).select("attr", "group", "feature", "mean", "std", "size")

    def overall_means(self) -> DataFrame:
        spark = self.groups.df.sparkSession
        rows = list(zip(self.features, self.whole["mean"], strict=True))
        return spark.createDataFrame(rows, "feature string, mean double")

    def group_cov(self) -> DataFrame:
        """(attr, group, f_i, f_j, cov) for f_i at or before f_j in feature order."""
        self._need_covariance()
        pairs = _pairs(len(self.features))
        first, second = (F.lit([self.features[p[side]] for p in pairs])[F.col("__at")] for side in (0, 1))
        cells = self.groups.df.select("attr", "group", F.posexplode("cov").alias("__at", "cov"))
        return cells.select("attr", "group", first.alias("f_i"), second.alias("f_j"), "cov")

    def overall_cov(self) -> DataFrame:
        self._need_covariance()
        rows = [
            (self.features[i], self.features[j], self.whole["cov"][at])
            for at, (i, j) in enumerate(_pairs(len(self.features)))
        ]
        return self.groups.df.sparkSession.createDataFrame(rows, "f_i string, f_j string, cov double")

    def _need_covariance(self) -> None:
        if self.settings.method == "mean_matching":
            raise ValueError("mean_matching does not fit covariances")

    def details(self) -> dict:
        """Method, level, columns, and the fitted tables as DataFrames."""
        info = {
            "method": self.settings.method,
            "repair_level": self.settings.repair_level,
            "sensitive_features": list(self.settings.sensitive),
            "non_sensitive_features": list(self.features),
            "group_statistics": self.group_stats(),
            "overall_means": self.overall_means(),
        }
        if self.settings.method != "mean_matching":
            info["covariance_matrices"] = self.group_cov()
            info["overall_covariance"] = self.overall_cov()
        return info

    # ---- persistence ---------------------------------------------------------------------

    def save(self, path: str) -> None:
        """Write the fitted tables as Parquet and the settings as a one-row table."""
        s = self.settings
        meta = {
            "settings": {**s.__dict__, "sensitive": list(s.sensitive), "keep": list(s.keep)},
            "features": list(self.features),
            "encoded": list(self.encoding.columns),
            "whole": self.whole,
            "schema": self.schema.jsonValue(),
        }
        spark = self.groups.df.sparkSession
        spark.createDataFrame([(json.dumps(meta),)], "metadata string").write.mode("overwrite").parquet(
            f"{path}/metadata"
        )
        self.groups.df.write.mode("overwrite").parquet(f"{path}/groups")
        self.encoding.codes.df.write.mode("overwrite").parquet(f"{path}/codes")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> GroupRepairModel:
        meta = json.loads(spark.read.parquet(f"{path}/metadata").first()["metadata"])
        settings = dict(meta["settings"])
        settings["sensitive"], settings["keep"] = tuple(settings["sensitive"]), tuple(settings["keep"])
        repair = GroupRepair(**settings)
        codes = pin(spark.read.parquet(f"{path}/codes"))
        encoding = LabelEncoding.from_codes(meta["encoded"], codes, repair.null_token)
        groups = pin(spark.read.parquet(f"{path}/groups"))
        schema = T.StructType.fromJson(meta["schema"])
        return cls(repair, tuple(meta["features"]), encoding, groups, meta["whole"], schema)


def _determinant(matrix: str, k: int) -> Column:
    """Determinant of a symmetric matrix given as the array of its upper triangle; NULL if any
    entry is."""
    places = {pair: at for at, pair in enumerate(_pairs(k))}

    def at(i: int, j: int) -> Column:
        return F.col(matrix)[places[min(i, j), max(i, j)]]

    if k == 2:
        return at(0, 0) * at(1, 1) - at(0, 1) * at(0, 1)
    if k == CLOSED_FORM:
        return (
            at(0, 0) * (at(1, 1) * at(2, 2) - at(1, 2) * at(1, 2))
            - at(0, 1) * (at(0, 1) * at(2, 2) - at(1, 2) * at(0, 2))
            + at(0, 2) * (at(0, 1) * at(1, 2) - at(1, 1) * at(0, 2))
        )
    usable = F.col(matrix).isNotNull() & ~F.exists(matrix, lambda x: x.isNull())
    return F.when(usable, _determinants(F.col(matrix), F.lit(k)))


@F.pandas_udf(T.DoubleType())
def _determinants(triangles: pd.Series, sides: pd.Series) -> pd.Series:
    """Determinants of a batch of group-sized matrices."""
    values = []
    for entries, k in zip(triangles, sides, strict=True):
        if entries is None:
            values.append(None)
            continue
        matrix = np.zeros((k, k))
        matrix[np.triu_indices(k)] = np.asarray(entries, dtype=float)
        values.append(float(np.linalg.det(matrix + np.triu(matrix, 1).T)))
    return pd.Series(values, dtype=float)


def fit_group_stats(df: DataFrame, attrs: Iterable[str], features: Iterable[str]) -> DataFrame:
    """Group statistics without a repair: one row per (attr, group, feature), sizes above one."""
    model = GroupRepair(tuple(attrs), unseen="keep").fit(df.select(*attrs, *features))
    return model.group_stats()
