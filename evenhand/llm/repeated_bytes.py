"""Removal of byte strings that occur more than once, by distributed prefix doubling.

Every byte that a repeated string of ``LENGTH`` bytes covers is removed. A string's positions are
narrowed down first, then decided exactly.

Positions that are ranked are anchors: the smallest of ``SPAN`` successive hashes of ``GRAM`` bytes,
leftmost if equal, of each place in a text. Every ``LENGTH``-byte window belongs to the anchor that
its first ``SPAN`` hashes give, so equal windows have the same anchor at the same distance, and the same
anchors follow as long as they lie well inside the window. Doubling ranks runs of the pieces between
anchors: the rank of a run of ``2 n`` pieces is that of the pair of ranks at distance ``n``. A rank that
only one position has is dropped with all longer runs through it; an anchor whose run would grow past
what all its windows share, the core, is a candidate.

The windows of a candidate are decided together if the whole stretch they cover occurs twice. Copies of a
whole text are removed as such. What is left
are the candidates around places where texts begin to differ. Their windows are compared with each other and with
one example of each repeated stretch of the same core: first in runs of ``RUN``, which have stretches and cores of
their own, then one by one in the runs that these leave open.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evenhand.llm.tables import named, recorded, release, saved, worker_state
from evenhand.llm.word_hashes import bytes_of, chunks, mix

LENGTH = 400
GRAM = 24
SPAN = 112
REACH = SPAN + GRAM - 1
#: All windows of an anchor contain this many bytes from it on.
CORE = LENGTH - SPAN + 1
#: Windows of undecided anchors are decided this many at a time before they are compared one by one.
RUN = 8
CHUNK_BYTES = 1 << 20
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_ODD = np.uint64(0xD1342543DE82EF95)


class Bytes:
    """Hashes of any span of some bytes, from running sums."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        held = worker_state("byte_powers", lambda: [np.ones(1, np.uint64)] * 4)
        if len(held[0]) < n + 1:
            size = 1 << n.bit_length()
            for i, base in enumerate([b for base in _BASES for b in (base, pow(base, -1, 1 << 64))]):
                powers = np.full(size, base, np.uint64)
                powers[0] = 1
                held[i] = np.multiply.accumulate(powers)
        values = data.astype(np.uint64) + np.uint64(1)
        self.powers = held
        self.sums = []
        for i in range(2):
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(values * held[2 * i][:n], out=sums[1:])
            self.sums.append(sums)

    def hash(self, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
        sums, inverse = self.sums[which], self.powers[2 * which + 1]
        return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * _ODD)

    def key(self, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """96 bits: a long and an integer."""
        short = (self.hash(starts, ends, 1) >> np.uint64(32)).astype(np.uint32)
        return self.hash(starts, ends).view(np.int64), short.view(np.int32)


class Anchors:
    """Anchors of texts that lie one after the other in ``data``.

    For each: its place ``at``, its ``text``, and ``first`` and ``last``, the window starts that belong to it.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.bytes, self.offsets = Bytes(data), offsets
        n = len(data) - GRAM + 1
        begins, ends = offsets[:-1], offsets[1:]
        number = np.maximum(ends - begins - REACH + 1, 0)
        texts = np.repeat(np.arange(len(begins)), number)
        starts = np.arange(len(texts)) - np.repeat(np.cumsum(number) - number, number) + begins[texts]
        if not len(starts):
            self.at = self.text = self.first = self.last = self.chosen = np.zeros(0, np.int64)
            return
        places = np.arange(n)
        least = (self.bytes.hash(places, places + GRAM) & np.uint64(0xFFFFFFFF00000000)) | places.astype(np.uint64)
        width = 1
        while width * 2 <= SPAN:
            least = np.minimum(least[: len(least) - width], least[width:])
            width *= 2
        rest = SPAN - width
        if rest:
            least = np.minimum(least[: len(least) - rest], least[rest:])
        self.chosen = np.full(len(data), -1)
        self.chosen[starts] = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        anchor = self.chosen[starts]
        new = np.flatnonzero(np.diff(anchor, prepend=-1) | (np.diff(texts, prepend=-1) != 0))
        self.at, self.text, self.first = anchor[new], texts[new], starts[new]
        self.last = np.append(starts[new[1:] - 1], starts[-1])

    def pieces(self) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the piece up to the next anchor (0: none), and the number of pieces in the core (0: no window)."""
        n = len(self.at)
        hashes, counts = np.zeros(n, np.int64), np.zeros(n, np.int32)
        if n:
            more = np.flatnonzero(self.text[:-1] == self.text[1:])
            hashes[more] = self.bytes.hash(self.at[more], self.at[more + 1] + GRAM).view(np.int64)
            whole = np.flatnonzero(self.first + LENGTH <= self.offsets[1:][self.text])
            end = self.chosen[self.at[whole] + CORE - REACH]
            # anchors of one text ascend, and texts follow each other
            counts[whole] = np.searchsorted(self.at, end) - whole
        return hashes, counts

    def windows(self, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last start of the windows of some anchors."""
        return self.first[items], np.minimum(self.last[items], self.offsets[1:][self.text[items]] - LENGTH)


def _lists(values: list[np.ndarray] | np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(values))


def texts_and_pieces(rows: DataFrame) -> DataFrame:
    """rid, id, n_bytes, sha256, packed (the compressed text), hashes and counts of its anchors' pieces."""
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=4)
        for batch in batches:
            column = batch.column(2)
            for a, b in chunks(column, CHUNK_BYTES):
                data, offsets = bytes_of(column, a, b)
                anchors = Anchors(data, offsets)
                hashes, counts = anchors.pieces()
                number = np.bincount(anchors.text, minlength=b - a)
                whole = memoryview(np.ascontiguousarray(data))
                texts = [whole[x:y] for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        batch.column(1).slice(a, b - a),
                        pa.array(np.diff(offsets)),
                        pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
                        pa.array([packer.compress(t) for t in texts], pa.binary()),
                        _lists(hashes, number),
                        _lists(counts, number),
                    ],
                    names=["rid", "id", "n_bytes", "sha256", "packed", "hashes", "counts"],
                )

    return rows.mapInArrow(
        run,
        f"rid long, id {id_type}, n_bytes long, sha256 string, packed binary, hashes array<long>, counts array<int>",
    )


def among(rows: DataFrame, found: DataFrame, *key: str) -> DataFrame:
    """The rows whose key (of integers) is in ``found``.

    Keys are compared inverted: ``found`` comes from groups of the key, and a join by the key itself would use their
    partitions as they are, so that Spark could not split a key that very many rows share.
    """
    inverted = found.select(*[F.bitwise_not(c).alias(f"__{c}") for c in key])
    return rows.join(inverted, [F.bitwise_not(c) == F.col(f"__{c}") for c in key], "left_semi")


def repeated(rows: DataFrame, *key: str) -> DataFrame:
    """The rows whose key another row has as well."""
    return among(rows, rows.groupBy(*key).agg(F.count("*").alias("__n")).filter("__n > 1"), *key)


def elsewhere(ranked: DataFrame) -> DataFrame:
    """The rows whose rank occurs in another text, or at another anchor of its own.

    That copies of one text have it at the same anchor does not count: they are removed as a whole.
    """
    places = ranked.groupBy("rank").agg(F.min("place").alias("a"), F.max("place").alias("b"))
    return among(ranked, places.filter("a <> b"), "rank").drop("place")


def candidates(texts: DataFrame) -> DataFrame:
    """rid, item of the anchors of which the runs of pieces occur elsewhere, as far as doubling reaches into the core."""
    each = texts.select("rid", "sha256", F.posexplode(F.arrays_zip("hashes", "counts")).alias("item", "p"))
    ranked = each.filter("p.hashes <> 0").select(
        "rid", "item", F.col("p.counts").alias("count"), F.col("p.hashes").alias("rank"), F.xxhash64("sha256", "item").alias("place")
    )
    active, length, found = saved(elsewhere(ranked), "ranks"), 1, None
    while True:
        # twice the length would reach past the core of these: they have come through
        ends = active.filter(F.col("count").between(length, 2 * length - 1)).select("rid", "item")
        found = ends if found is None else found.unionByName(ends)
        # the rank at the distance of the length; only texts in which some core has more pieces go on
        ahead = Window.partitionBy("rid").orderBy("item").rangeBetween(length, length)
        whole = Window.partitionBy("rid")
        pairs = active.withColumns({"then": F.first("rank").over(ahead), "most": F.max("count").over(whole)})
        pairs = pairs.filter((F.col("most") >= 2 * length) & F.col("then").isNotNull())
        pairs = pairs.select("rid", "item", "count", F.xxhash64("rank", "then").alias("rank"))
        active, length = saved(repeated(pairs, "rank"), "ranks"), 2 * length
        if active.isEmpty():
            return found


def _unpacked(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows whose texts make up a chunk, with the bytes and offsets of the texts."""
    unpack = zstandard.ZstdDecompressor().decompress
    held, first, size = [], 0, 0
    packed = batch.column(column).to_pylist()
    for i, p in enumerate(packed):
        held.append(unpack(p))
        size += len(held[-1])
        if size >= CHUNK_BYTES or i + 1 == len(packed):
            offsets = np.concatenate([[0], np.cumsum([len(t) for t in held])])
            yield first, i + 1, np.frombuffer(b"".join(held), np.uint8), offsets
            held, first, size = [], i + 1, 0


def _flat(column: pa.ListArray, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
    """Values of the lists of rows ``a`` to ``b``, and the row of each."""
    part = column.slice(a, b - a)
    sizes = np.diff(part.offsets.to_numpy())
    return part.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(b - a), sizes)


def _runs(data: Bytes, at: np.ndarray, ahead: np.ndarray, number: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """The windows of some entries in runs of at most ``width``, cut at fixed distances from the anchor.

    For each run: its entry, ahead, number, a hash of the bytes that windows at all distances of the run share, and the
    key of the stretch that its windows cover. Equal windows are equally far from their anchors, so they share that hash.
    """
    nearest = ahead - number + 1
    sizes = ahead // width - nearest // width + 1
    each = np.repeat(np.arange(len(at)), sizes)
    base = (np.arange(len(each)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + (nearest // width)[each]) * width
    at, ahead, nearest = at[each], np.minimum(base + width - 1, ahead[each]), np.maximum(base, nearest[each])
    core = data.hash(at - base, at - base + LENGTH - width + 1).view(np.int64)
    return each, ahead, ahead - nearest + 1, core, *data.key(at - ahead, at - nearest + LENGTH)


def stretches(texts: DataFrame, found: DataFrame) -> DataFrame:
    """rid, packed, and for each anchor: its place (at), the distance of its first window (ahead) and the number of its
    windows, a hash of its core (rank), and a key (key, more) of the stretch its windows cover."""
    lists = found.groupBy("rid").agg(F.collect_list("item").alias("items"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in _unpacked(batch, 1):
                anchors = Anchors(data, offsets)
                item, row = _flat(batch.column(2), a, b)
                items = np.searchsorted(anchors.text, np.arange(b - a))[row] + item
                at, (first, last) = anchors.at[items], anchors.windows(items)
                _, ahead, number, core, key, more = _runs(anchors.bytes, at, at - first, last - first + 1, SPAN)
                sizes = np.bincount(row, minlength=b - a)
                small = [x.astype(np.int32) for x in (at - offsets[row], ahead, number)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(a, b - a) for c in range(2)] + [_lists(x, sizes) for x in (*small, core, key, more)],
                    names=["rid", "packed", "at", "ahead", "number", "rank", "key", "more"],
                )

    joined = texts.select("rid", "packed").join(lists, "rid").select("rid", "packed", "items")
    return joined.mapInArrow(
        run,
        "rid long, packed binary, at array<int>, ahead array<int>, number array<int>, rank array<long>, key array<long>, more array<int>",
    )


def settled(runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of runs of windows, those that are repeated whole, and what has to be compared in shorter runs.

    The latter are runs that share their core with others but have a stretch of their own (``own``), and one example of
    each repeated stretch of the same core.
    """
    names = ["rid", "at", "ahead", "number"]
    classes = saved(
        runs.groupBy("rank", "key", "more").agg(F.count("*").alias("n"), F.min(F.struct(*names, "own")).alias("one")), "classes"
    )
    whole = runs.filter("own").join(classes.filter("n > 1").select("rank", "key", "more"), ["rank", "key", "more"], "left_semi")
    own = (F.col("n") == 1) & F.col("one.own")
    # a core that only one stretch has is that of no repeated window
    several = classes.groupBy("rank").agg(F.count("*").alias("classes"), F.max(own).alias("open"))
    unsettled = among(classes, several.filter("classes > 1 and open"), "rank")
    return whole.select(*names), unsettled.select(*[F.col(f"one.{c}") for c in names], own.alias("own"))


def shorter(packed: DataFrame, asked: DataFrame, width: int) -> DataFrame:
    """rid, at, ahead, number, own, rank, key, more of the runs of ``width`` windows of what is asked for."""
    names = ["at", "ahead", "number", "own"]
    lists = asked.groupBy("rid").agg(*[F.collect_list(c).alias(c) for c in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in _unpacked(batch, 1):
                (at, row), (ahead, _), (number, _), (own, _) = (_flat(batch.column(c), a, b) for c in range(2, 6))
                each, ahead, number, *keys = _runs(Bytes(data), at + offsets[row], ahead, number, width)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a).take(pa.array(row[each])),
                        *[pa.array(x.astype(np.int32)) for x in (at[each], ahead, number)],
                        pa.array(own[each].astype(bool)),
                        *[pa.array(x) for x in keys],
                    ],
                    names=["rid", *names, "rank", "key", "more"],
                )

    joined = packed.select("rid", "packed").join(lists, "rid").select("rid", "packed", *names)
    return joined.mapInArrow(run, "rid long, at int, ahead int, number int, own boolean, rank long, key long, more int")


def cut(packed: DataFrame, runs: DataFrame) -> DataFrame:
    """rid, n_removed, n_spans, sha256 and kept (the bytes that remain) of texts that lose some."""
    lists = runs.groupBy("rid").agg(F.collect_list(F.col("at") - F.col("ahead")).alias("starts"), F.collect_list("number").alias("numbers"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in _unpacked(batch, 1):
                (start, row), (number, _) = _flat(batch.column(2), a, b), _flat(batch.column(3), a, b)
                first = start + offsets[row]
                edge = np.zeros(len(data) + 1, np.int64)
                np.add.at(edge, first, 1)
                np.add.at(edge, first + number - 1 + LENGTH, -1)
                gone = np.cumsum(edge[:-1]) > 0
                rows = []
                for i in range(b - a):
                    lost = gone[offsets[i] : offsets[i + 1]]
                    kept = data[offsets[i] : offsets[i + 1]][~lost].tobytes()
                    spans = int(lost[0]) + int((lost[1:] & ~lost[:-1]).sum()) if len(lost) else 0
                    rows.append((int(lost.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
                removed, spans, sums, kept = map(list, zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array(removed, pa.int64()),
                        pa.array(spans, pa.int64()),
                        pa.array(sums),
                        pa.array(kept, pa.binary()),
                    ],
                    names=["rid", "n_removed", "n_spans", "cut_sha256", "kept"],
                )

    joined = packed.select("rid", "packed").join(lists, "rid").select("rid", "packed", "starts", "numbers")
    return joined.mapInArrow(run, "rid long, n_removed long, n_spans long, cut_sha256 string, kept binary")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row: id, n_bytes, n_removed, n_spans, kept_sha256.

    Strings are judged on the whole input, within and across texts, and never reach from one text into another.
    NULL text is the empty text; texts shorter than ``LENGTH`` bytes lose nothing; repeated rows of
    longer texts lose everything. An empty table gives no rows; other
    columns are not read.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("rid"),
        named(id_col).alias("id"),
        F.coalesce(named(text_col).cast("string"), F.lit("")).alias("t"),
    )
    used: list[str] = []
    with recorded(used):
        texts = saved(texts_and_pieces(rows), "texts")
        found = candidates(texts)
    packed = saved(stretches(texts, found), "stretches")
    texts = saved(texts.select("rid", "id", "n_bytes", "sha256"), "sizes")
    release(docs.sparkSession, used)
    lists = ["at", "ahead", "number", "rank", "key", "more"]
    item = packed.select("rid", F.explode(F.arrays_zip(*lists)).alias("i")).select("rid", *[F.col(f"i.{c}") for c in lists])
    whole, asked = settled(item.withColumn("own", F.lit(True)))
    runs, asked = settled(saved(shorter(packed, asked, RUN), "runs"))
    windows = saved(shorter(packed, asked, 1).drop("rank"), "windows")
    single = repeated(windows, "key", "more").filter("own").select("rid", "at", "ahead", "number")
    done = cut(packed, whole.unionByName(runs).unionByName(single))
    copies = texts.filter(F.col("n_bytes") >= LENGTH).groupBy("sha256").agg(F.count("*").alias("copies"))
    # compared as bytes for the reason that ``among`` inverts keys
    copies = copies.filter("copies > 1").select(F.unhex("sha256").alias("copied"))
    out = texts.join(done.drop("kept"), "rid", "left").join(copies, F.unhex("sha256") == F.col("copied"), "left")
    copied = F.col("copied").isNotNull()
    return out.select(
        F.col("id").alias(id_col),
        "n_bytes",
        F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copied, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copied, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("cut_sha256", "sha256")).alias("kept_sha256"),
    )
