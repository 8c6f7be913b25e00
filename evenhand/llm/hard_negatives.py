"""Hard negatives by exact search for large inner products, with pruning by coordinates.

Rows are dealt out in order of their length and searched in buckets of similar length. A bucket holds, for each
coordinate, its directions' values in sorted order. What an anchor still asks for (its score to reach) becomes a
least cosine for the bucket. Where that exceeds 1 the whole bucket is skipped; elsewhere it bounds the values that
a row can have in the anchor's focus coordinates (its largest ones). The feasible ranges are cut out of the sorted
lists and intersected, and what is left is verified by exact inner products.

Anchors go through the rows in blocks of a bounded number. Each task keeps the best rows of each anchor, and the
few of each task are merged by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenhand.llm.tables import named, saved

BUCKET = 1024
FOCUS = 4
ANCHORS = 4096
ROWS_PER_PART = 50_000
#: Beyond this share of a bucket in the narrowest range, the anchor is verified along with others.
DENSE = 0.7
SLACK = 1e-9
#: Scores are whole numbers of 64 bits. Sums of products are exact in doubles up to EXACT; larger ones are summed as integers.
EXACT, LARGEST = 1 << 53, (1 << 63) - 1


@dataclass
class Anchors:
    """Anchors of a block: row numbers, labels, vectors, and for negatives the score ranges (anchor, slot)."""

    rid: np.ndarray
    label: np.ndarray
    whole: np.ndarray
    low: np.ndarray | None = None
    high: np.ndarray | None = None
    vectors: np.ndarray = field(init=False)
    length: np.ndarray = field(init=False)
    unit: np.ndarray = field(init=False)
    focus: np.ndarray = field(init=False)
    angle: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.vectors = self.whole.astype(np.float64)
        self.length = np.sqrt((self.vectors**2).sum(axis=1))
        self.unit = self.vectors / np.where(self.length > 0, self.length, 1)[:, None]
        self.focus = np.argsort(-np.abs(self.unit), axis=1, kind="stable")[:, :FOCUS]
        self.angle = np.arccos(np.clip(np.take_along_axis(self.unit, self.focus, axis=1), -1, 1))


class Bucket:
    """Rows of similar length, with a sorted list of values for each coordinate of their directions."""

    def __init__(self, rid: np.ndarray, ids: np.ndarray, label: np.ndarray, whole: np.ndarray) -> None:
        self.rid, self.ids, self.label, self.whole = rid, ids, label, whole
        self.vectors = vectors = whole.astype(np.float64)
        length = np.sqrt((vectors**2).sum(axis=1))
        self.shortest, self.longest = float(length.min()), float(length.max())
        self.unit = vectors / np.where(length > 0, length, 1)[:, None]
        self.order = np.argsort(self.unit, axis=0, kind="stable")
        self.values = np.take_along_axis(self.unit, self.order, axis=0)

    def products(self, found: np.ndarray | slice, anchors: Anchors, asked) -> np.ndarray:
        """Exact inner products of rows with one anchor, or with several (a row for each anchor)."""
        sizes = (float(np.abs(x.whole).max(initial=0)) for x in (self, anchors))
        if np.prod([*sizes, self.whole.shape[1]]) < EXACT:
            return np.rint(anchors.vectors[asked] @ self.vectors[found].T).astype(np.int64)
        return anchors.whole[asked] @ self.whole[found].T

    def cosines(self, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The least cosine with which a row of the bucket can have each score; -1 where any can."""
        widest = np.where(scores > 0, self.longest, self.shortest) * lengths
        out = np.full(len(scores), -1.0)
        bounded = (widest > 0) & (scores > -LARGEST)
        out[bounded] = scores[bounded] / widest[bounded] - SLACK
        # a row or an anchor of length 0 has score 0 only
        out[(widest == 0) & (scores > 0)] = 2.0
        return out

    def candidates(self, anchors: Anchors, asked: np.ndarray, cosine: np.ndarray) -> Iterator[tuple[int, np.ndarray | None]]:
        """For each anchor number in ``asked`` the rows in all feasible ranges; None for most of the bucket."""
        widest = np.arccos(np.clip(cosine, -1, 1))[:, None]
        angle = anchors.angle[asked]
        least = np.cos(np.minimum(angle + widest, np.pi)) - SLACK
        most = np.cos(np.maximum(angle - widest, 0)) + SLACK
        focus = anchors.focus[asked]
        start, stop = np.empty(focus.shape, np.int64), np.empty(focus.shape, np.int64)
        for f in np.unique(focus):
            at = focus == f
            start[at] = np.searchsorted(self.values[:, f], least[at], "left")
            stop[at] = np.searchsorted(self.values[:, f], most[at], "right")
        sizes = stop - start
        narrowest = sizes.argmin(axis=1)
        for i, anchor in enumerate(asked):
            n = narrowest[i]
            if sizes[i, n] > DENSE * len(self.rid):
                yield anchor, None
                continue
            found = self.order[start[i, n] : stop[i, n], focus[i, n]]
            for j in range(focus.shape[1]):
                if j != n and len(found):
                    value = self.unit[found, focus[i, j]]
                    found = found[(value >= least[i, j]) & (value <= most[i, j])]
            if len(found):
                yield anchor, found


@dataclass
class Best:
    """The first ``k`` rows by (score falling, id, row number), for each anchor and slot."""

    anchors: int
    slots: int
    k: int

    def __post_init__(self) -> None:
        self.rows: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        self.least = np.full((self.anchors, self.slots), -LARGEST)

    def offer(self, anchor: int, slot: int, score: np.ndarray, ids: np.ndarray, rid: np.ndarray) -> None:
        if (anchor, slot) in self.rows:
            held = self.rows[anchor, slot]
            score, ids, rid = (np.concatenate(x) for x in zip(held, (score, ids, rid), strict=True))
        if len(score) > self.k:
            first = np.lexsort((rid, ids, -score))[: self.k]
            score, ids, rid = score[first], ids[first], rid[first]
        self.rows[anchor, slot] = score, ids, rid
        if len(score) == self.k:
            self.least[anchor, slot] = score.min()


SCHEMA = "anchor long, slot int, score long, id long, rid long"


def _search(anchors: Anchors, k: int, same: bool):
    """A task's rows against a block of anchors: the first ``k`` of the same label, or of each range of scores and another label."""
    slots = 1 if same else anchors.low.shape[1]

    def offer(best: Best, bucket: Bucket, anchor: int, found: np.ndarray | slice, scores: np.ndarray) -> None:
        rid, ids, label = bucket.rid[found], bucket.ids[found], bucket.label[found]
        right = (label == anchors.label[anchor]) & (rid != anchors.rid[anchor]) if same else label != anchors.label[anchor]
        for slot in range(slots):
            fits = right & (scores >= best.least[anchor, slot])
            if not same:
                fits &= (scores >= anchors.low[anchor, slot]) & (scores <= anchors.high[anchor, slot])
            if fits.any():
                best.offer(anchor, slot, scores[fits], ids[fits], rid[fits])

    def through(best: Best, bucket: Bucket) -> None:
        wanted = best.least if same else np.maximum(best.least, anchors.low)
        if not same:
            # a slot whose range is empty asks for nothing
            wanted = np.where(anchors.low > anchors.high, LARGEST, wanted)
        scores = wanted.min(axis=1)
        asked = np.flatnonzero(scores < LARGEST)
        cosine = bucket.cosines(scores[asked], anchors.length[asked])
        asked, cosine = asked[cosine <= 1], cosine[cosine <= 1]
        dense = []
        for anchor, found in bucket.candidates(anchors, asked, cosine):
            if found is None:
                dense.append(anchor)
            else:
                offer(best, bucket, anchor, found, bucket.products(found, anchors, anchor))
        for start in range(0, len(dense), BUCKET):
            part = dense[start : start + BUCKET]
            for anchor, exact in zip(part, bucket.products(slice(None), anchors, part), strict=True):
                offer(best, bucket, anchor, slice(None), exact)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, width = Best(len(anchors.rid), slots, k), anchors.vectors.shape[1]
        for batch in batches:
            for start in range(0, batch.num_rows, BUCKET):
                part = batch.slice(start, BUCKET)
                through(best, Bucket(*(part[c].to_numpy() for c in ("rid", "id", "label")), matrix(part["v"], width)))
        out = [(int(anchors.rid[a]), s, int(x), int(y), int(z)) for (a, s), rows in best.rows.items() for x, y, z in zip(*rows, strict=True)]
        names = ("anchor", "slot", "score", "id", "rid")
        types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        columns = list(zip(*out, strict=True)) or [()] * len(names)
        yield pa.record_batch({n: pa.array(c, t) for n, c, t in zip(names, columns, types, strict=True)})

    return run


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of up to ``width`` components, padded with zeros."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy()
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def prepared(rows: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int = 256) -> tuple[DataFrame, int]:
    """Rows that take part, numbered and stored by falling length: rid, id, label, v (whole numbers); and their width."""
    width = max(1, rows.agg(F.max(F.size(named(vector_col)))).first()[0] or 0)
    limit = F.lit(isqrt(LARGEST // width))
    whole = F.transform(named(vector_col), lambda x: F.floor(x.cast("double") * scale))
    taking = rows.filter(
        named(id_col).isNotNull()
        & named(label_col).isNotNull()
        & named(vector_col).isNotNull()
        & ~F.exists(named(vector_col), lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    ).select(
        F.monotonically_increasing_id().alias("rid"),
        named(id_col).cast("long").alias("id"),
        named(label_col).cast("long").alias("label"),
        F.transform(whole, lambda x: F.greatest(F.least(x, limit), -limit).cast("long")).alias("v"),
    )
    length = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    stored = saved(taking.withColumn("length", length), "vectors")
    n, cores = stored.count(), stored.sparkSession.sparkContext.defaultParallelism
    parts = max(1, -(-n // ROWS_PER_PART), min(cores, -(-n // (4 * BUCKET))))
    # rows alike have the same length: their numbers spread them
    return saved(stored.repartitionByRange(parts, F.desc("length"), F.xxhash64("rid")).sortWithinPartitions(F.desc("length")).drop("length"), "buckets"), width


def _first(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each anchor and slot, of the few rows that each task found."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id", "rid")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(
    rows: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 10,
    least: int = 30,
    most: int = 90,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    scale: int = 256,
) -> DataFrame:
    """For each anchor and each of its positives the first rows of other labels within a range of the positive's score.

    ``anchors`` is a condition on the column ``id``. A score is the inner product of components ``floor(scale * x)``;
    higher scores come first, ties by smaller id and then by row. Positives are an anchor's first other rows of its label. A
    negative's score lies between ``least`` and ``most`` percent of the positive's; a positive below 0 has none.
    Rows with NULL id, label or vector, or with a NULL or non-finite component, take no part. A shorter vector counts as padded
    with zeros. Components so large that a score could leave 64 bits count as the largest that cannot. Repeated rows are rows of their own, and so are anchors. Other
    columns are not read. Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    """
    data, width = prepared(rows, id_col, vector_col, label_col, scale)
    asking = saved(data.filter(anchors), "anchors")
    blocks = max(1, -(-asking.count() // ANCHORS))
    results = None
    for i in range(blocks):
        table = asking.filter(F.pmod(F.xxhash64("rid"), F.lit(blocks)) == i).select("rid", "id", "label", "v").orderBy("rid").toArrow()
        rid, label = table["rid"].to_numpy(), table["label"].to_numpy()
        whole = matrix(table["v"], width)
        near = saved(_first(data.mapInArrow(_search(Anchors(rid, label, whole), positives, True), SCHEMA), positives), "positives")
        place = {int(r): n for n, r in enumerate(rid)}
        low, high = np.full((len(rid), positives), LARGEST), np.full((len(rid), positives), -LARGEST)
        for r in near.select("anchor", "rank", "score").collect():
            low[place[r["anchor"]], r["rank"] - 1] = -(-least * r["score"] // 100)
            high[place[r["anchor"]], r["rank"] - 1] = most * r["score"] // 100
        search = _search(Anchors(rid, label, whole, low, high), negatives, False)
        hard = _first(data.mapInArrow(search, SCHEMA), negatives)
        pairs = hard.select("anchor", F.col("slot"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
        ids = asking.select(F.col("rid").alias("anchor"), F.col("id").alias("anchor_id"))
        of = near.select("anchor", (F.col("rank") - 1).alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
        done = saved(
            pairs.join(of, ["anchor", "slot"])
            .join(ids, "anchor")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"),
            "hard",
        )
        results = done if results is None else results.unionByName(done)
    return results


def mine_embeddings(rows: DataFrame) -> DataFrame:
    """Hard negatives of every hundredth vector; the labels of every seventh are moved by one first."""
    moved = F.when(named("vec_id") % 7 == 0, (named("label") + 1) % 10).otherwise(named("label"))
    relabelled = rows.select(named("vec_id").alias("vec_id"), named("embedding").alias("embedding"), moved.alias("label"))
    return mine(relabelled, F.col("id") % 100 == 0)
