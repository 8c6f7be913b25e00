"""Near duplicates by improved consistent weighted sampling over TF-IDF shingles.

A text is its shingles of five words, each weighing its count times an inverse document frequency.
The frequency only matters for shingles that more than one text in ``RARE`` has; all rarer ones
weigh 1. The most frequent million are broadcast; if there are more, the others are joined to the texts
that have them. Thirty samples are drawn from each text such that two texts agree
in one with the probability of their weighted Jaccard similarity. Three samples make up a band,
texts that share a band are compared, and links are the pairs whose exact weighted similarity reaches
the threshold. Classes are the connected components of the links.

Comparing is done without listing the pairs of a group. Equal word sequences are one node. First
each node is compared with the smallest node of its bands; nodes that this has joined need no more
comparing. Nodes of bands that are still in different classes draw 512 further samples of one bit, which tell
similarities of 0.7 from 0.8, and come together with their texts, a block of a band in a task. Pairs whose
further samples agree as often as those of similar texts do are compared there, best first, unless pairs before have joined
their classes, and a link is given out only if it joins two: at most one for each node. A pair is
looked at in the first band that it shares only. A band shared by
very many nodes is divided by pairs of the other samples, chosen such that two nodes that agree often
enough to be compared have at least one pair in common, so that dividing loses no link.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenhand.llm.components import components
from evenhand.llm.tables import keyed, named, recorded, release, saved, unkeyed
from evenhand.llm.word_hashes import bytes_of, chunks, mix, shingle_hashes, with_counts, word_hashes

THRESHOLD = 0.8
BANDS, ROWS = 10, 3
RARE = 1024
LEAST = 0.8
FINER = 4
#: So many of the frequent shingles are broadcast.
FREQUENT = 1 << 20
#: The first count leaves out more the larger its blocks are: partitions are joined for it to so many texts
#: or bytes, as long as no core is left idle, and each is one block unless its shingles are too many to hold.
COUNTED_TEXTS, COUNTED_BYTES, BLOCK_SHINGLES = 1 << 14, 1 << 27, 1 << 24
#: Open buckets are dealt into blocks of so many nodes, and each two blocks are compared by themselves.
BLOCK_NODES = 2048
#: Bands that more nodes share are divided. Below two blocks dividing costs more than it saves: nodes that are similar
#: at all meet in several of the parts.
FULL_BAND = 2 * BLOCK_NODES
#: Pairs that agree in so many of the 30 samples may be compared. Two texts at the threshold agree
#: in fewer with a probability of 0.3 %, at 0.85 of 0.004 %.
AGREE = 17
#: Samples are packed for this by four bits each.
NIBBLES = 15
#: Further samples that only nodes of open buckets draw, one bit of each, so that a comparison is an exclusive or and a
#: bit count. Pairs are compared that agree in so many of them too. Two texts at the threshold agree in
#: fewer with a probability of 0.05 %, at a similarity of 0.65 they agree in as many with one of 4 %.
FINE, PACKED = 512, 64
AGREE_FINE = (438,)
#: Pairs of a block are looked at for so many of its nodes at a time, and so many shingles of texts are kept meanwhile.
STRIP_NODES, KEPT_SHINGLES = 256, 1 << 22


def _divisions() -> list[list[tuple[int, int]]]:
    """For each band, pairs of the samples outside it: nodes that share the band and agree in ``AGREE`` samples agree in a pair.

    The samples are dealt to one group fewer than still have to agree, so two of these fall into one group.
    """
    groups = AGREE - ROWS - 1
    others = [[j for j in range(BANDS * ROWS) if j // ROWS != band] for band in range(BANDS)]
    return [[pair for g in range(groups) for pair in combinations(rest[g::groups], 2)] for rest in others]


DIVISIONS = _divisions()

_QUANTILES = 1 << 16


def _gamma_tables() -> tuple[np.ndarray, np.ndarray]:
    """Quantiles of the Gamma(2, 1) distribution, and of its logarithm, at the middle of equal steps."""
    p = (np.arange(_QUANTILES) + 0.5) / _QUANTILES
    x = np.sqrt(2 * p) + p
    for _ in range(60):  # Newton steps on 1 - (1 + x) exp(-x) = p
        x = np.maximum(x - (1 - (1 + x) * np.exp(-x) - p) / np.maximum(x * np.exp(-x), 1e-300), x / 2)
    return x.astype(np.float32), np.log(x).astype(np.float32)


GAMMA, LOG_GAMMA = _gamma_tables()
ALL_SEEDS = mix(np.arange(1, BANDS * ROWS + FINE + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
SEEDS, FINE_SEEDS = ALL_SEEDS[: BANDS * ROWS], ALL_SEEDS[BANDS * ROWS :]


def idf(df: np.ndarray, n: int) -> np.ndarray:
    """Between ``LEAST`` for a shingle of every text and 1 for a rare one.

    What many copies have in common must not weigh so little that their own number keeps them apart.
    """
    return LEAST + (1 - LEAST) * np.minimum(1.0, np.log(np.maximum(n / df, 1.0)) / np.log(RARE))


class Weights:
    """Weights of shingles, from a sorted table of the frequent ones and the weight of all others."""

    def __init__(self, hashes: np.ndarray, weights: np.ndarray, other: float = 1.0):
        self.hashes, self.weights, self.other = hashes, weights, other

    def of(self, shingles: np.ndarray, counts: np.ndarray, listed: pa.ListArray | None = None) -> np.ndarray:
        """Weight times count; ``listed`` has weights of further shingles, as (hash, weight) lists of the texts."""
        each = np.full(len(shingles), self.other)
        tables = [(self.hashes, self.weights)]
        if listed is not None:
            hashes, weights = (x.to_numpy(zero_copy_only=False) for x in listed.flatten().flatten())
            hashes, first = np.unique(hashes.astype(np.int64).view(np.uint64), return_index=True)
            tables.append((hashes, weights[first]))
        for hashes, weights in tables:
            if len(hashes):
                at = np.searchsorted(hashes, shingles)
                at[at == len(hashes)] = 0
                hit = np.flatnonzero(hashes[at] == shingles)
                each[hit] = weights[at[hit]]
        return counts * each


def sample(shingles: np.ndarray, weights: np.ndarray, starts: np.ndarray, seeds: np.ndarray = SEEDS) -> np.ndarray:
    """Samples of each text (its shingles begin at ``starts``): 32 bits of the chosen element and level."""
    odd = np.flatnonzero(weights != 1.0)
    logs = np.log(weights[odd]).astype(np.float32)
    out = np.empty((len(starts), len(seeds)), np.uint32)
    for j, seed in enumerate(seeds):
        h = mix(shingles ^ seed)
        r = GAMMA[(h >> np.uint64(48)).astype(np.intp)]
        log_c = LOG_GAMMA[((h >> np.uint64(32)) & np.uint64(0xFFFF)).astype(np.intp)]
        beta = (h & np.uint64(0xFFFF)).astype(np.float32) * np.float32(1 / 65536)
        # weight 1 has logarithm 0 and so level 0
        value = log_c - r * (np.float32(1) - beta)
        chosen = h * np.uint64(0xD6E8FEB86659FD93)
        if len(odd):
            level = np.floor(logs / r[odd] + beta[odd])
            value[odd] = log_c[odd] - r[odd] * (level - beta[odd] + np.float32(1))
            chosen[odd] += mix(level.astype(np.int64).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
        bits = value.view(np.uint32)
        ordered = np.where(bits >> 31, ~bits, bits | np.uint32(0x80000000)).astype(np.uint64)
        out[:, j] = np.minimum.reduceat((ordered << np.uint64(32)) | (chosen >> np.uint64(32)), starts) & np.uint64(0xFFFFFFFF)
    return out


def _texts(rows: DataFrame) -> DataFrame:
    return rows.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))


def counted(found: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The values that are there ``least`` times or more, and how often; sorts ``found`` in place to need no copies."""
    found.sort()
    if len(found) < least:
        return found[:0], np.zeros(0, np.int64)
    long = found[: len(found) - least + 1] == found[least - 1 :]
    long[1:] &= found[1 : len(long)] != found[: len(long) - 1]
    first = np.flatnonzero(long)
    hashes = found[first]
    return hashes, np.searchsorted(found, hashes, "right") - first


def in_blocks(rows: DataFrame, n: int, size: int) -> DataFrame:
    """The ``n`` texts, ``size`` bytes in all, in partitions for the first count."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return _texts(rows).coalesce(max(cores, n // COUNTED_TEXTS, size // COUNTED_BYTES))


def frequent_shingles(rows: DataFrame) -> tuple[tuple[np.ndarray, np.ndarray, float], DataFrame | None]:
    """What ``Weights`` takes, and the rows (hash, weight) of the frequent shingles that it has no room for, if any.

    Frequent are those that two texts or more and one text in ``RARE`` or more have. All others weigh the same:
    1, or in fewer than ``RARE`` texts the weight of a shingle that one text has.

    Two passes over all texts. The first counts within blocks of texts and gives out what reaches
    the block's part of a limit four times finer; what can reach the limit overall is then among
    those whose sum comes near it. The second pass counts those exactly; if they are too many to broadcast,
    it counts all.
    """
    spark = rows.sparkSession
    n, size = _texts(rows).agg(F.count("*"), F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()
    limit = max(n / RARE, 2)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, texts = [], 0

        def count():
            least = max(1, texts // (RARE * FINER) + bool(texts % (RARE * FINER)))
            found = np.concatenate(held)
            held.clear()
            hashes, number = counted(found, least)
            head = pa.RecordBatch.from_arrays(
                [pa.array([0]), pa.array([0]), pa.array([least - 1]), pa.array([True])], names=["hash", "n", "slack", "block"]
            )
            k = len(hashes)
            body = pa.RecordBatch.from_arrays(
                [pa.array(hashes.view(np.int64)), pa.array(number), pa.array(np.full(k, least - 1)), pa.array(np.zeros(k, bool))],
                names=["hash", "n", "slack", "block"],
            )
            return [head, body]

        for batch in batches:
            column = batch.column(0)
            for first, last in chunks(column):
                words, counts = word_hashes(*bytes_of(column, first, last))
                held.append(with_counts(*shingle_hashes(words, counts))[0])
                texts += last - first
                if sum(map(len, held)) >= BLOCK_SHINGLES:
                    yield from count()
                    held, texts = [], 0
        if held:
            yield from count()

    def everything(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            for first, last in chunks(column):
                words, counts = word_hashes(*bytes_of(column, first, last))
                hashes, number = np.unique(with_counts(*shingle_hashes(words, counts))[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(number)], names=["hash", "n"])

    def recount(candidates):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(candidates.value), np.int64)
            for batch in batches:
                column = batch.column(0)
                for first, last in chunks(column):
                    words, counts = word_hashes(*bytes_of(column, first, last))
                    found = with_counts(*shingle_hashes(words, counts))[0]
                    at = np.searchsorted(candidates.value, found)
                    at[at == len(total)] = 0
                    total += np.bincount(at[candidates.value[at] == found], minlength=len(total))
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(candidates.value[some].view(np.int64)), pa.array(total[some])], names=["hash", "n"]
            )

        return run

    passing = []
    with recorded(passing):
        local = saved(in_blocks(rows, n, size).mapInArrow(blocks, "hash long, n long, slack long, block boolean"), "local-counts")
    slack = local.filter("block").agg(F.sum("slack")).first()[0] or 0
    summed = local.filter("not block").groupBy("hash").agg(F.sum("n").alias("n"), F.sum("slack").alias("slack"))
    with recorded(passing):
        near = saved(summed.filter(F.col("n") + slack - F.col("slack") >= limit).select("hash"), "candidates")
    if near.count() <= 2 * FREQUENT:
        hashes = np.sort(near.toArrow().column(0).to_numpy().astype(np.int64).view(np.uint64))
        exact = _texts(rows).mapInArrow(recount(spark.sparkContext.broadcast(hashes)), "hash long, n long") if len(hashes) else local.select("hash", "n").limit(0)
    else:
        exact = _texts(rows).mapInArrow(everything, "hash long, n long")
    kept = saved(exact.groupBy("hash").agg(F.sum("n").alias("n")).filter(F.col("n") >= limit), "frequent")
    release(spark, passing)
    most = kept.count() > FREQUENT
    table = (kept.orderBy(F.desc("n"), "hash").limit(FREQUENT) if most else kept).toArrow()
    found = table.column("hash").to_numpy().astype(np.int64).view(np.uint64)
    often = table.column("n").to_numpy()
    order = np.argsort(found)
    head = found[order], idf(often, n)[order], float(idf(np.ones(1), n)[0])
    if not most:
        return head, None
    last_n, last_hash = table.column("n")[-1].as_py(), table.column("hash")[-1].as_py()
    rest = kept.filter((F.col("n") < last_n) | ((F.col("n") == last_n) & (F.col("hash") > last_hash)))
    share = F.log(F.greatest(F.lit(n) / F.col("n"), F.lit(1.0))) / float(np.log(RARE))
    return head, rest.select("hash", (LEAST + (1 - LEAST) * F.least(F.lit(1.0), share)).alias("weight"))


def listed_weights(texts: DataFrame, rest: DataFrame) -> DataFrame:
    """The texts (rid, t) with ``listed``: (hash, weight) of those of their shingles that are in ``rest``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            for first, last in chunks(column):
                words, counts = word_hashes(*bytes_of(column, first, last))
                shingles, texts, _ = with_counts(*shingle_hashes(words, counts))
                rids = batch.column(0).slice(first, last - first).take(pa.array(texts))
                yield pa.RecordBatch.from_arrays([rids, pa.array(shingles.view(np.int64))], names=["rid", "hash"])

    each = texts.select("rid", "t").mapInArrow(run, "rid long, hash long").join(rest, "hash")
    lists = each.groupBy("rid").agg(F.collect_list(F.struct("hash", "weight")).alias("listed"))
    return texts.join(lists, "rid", "left")


SKETCH = "rid long, words binary, size long, weight double, bands array<long>, low long, high long"


def sketches(texts: DataFrame, weights) -> DataFrame:
    """rid, words (a hash of the word sequence), size, weight, bands and packed samples of every text (rid, t, listed if given)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Weights(*weights.value)
        for batch in batches:
            column = batch.column(1)
            for first, last in chunks(column):
                words, counts = word_hashes(*bytes_of(column, first, last))
                keys = [xxhash.xxh3_128_digest(words[a:b].tobytes()) for a, b in zip(counts[:-1], counts[1:], strict=True)]
                shingles, texts, number = with_counts(*shingle_hashes(words, counts))
                listed = batch.column(2).slice(first, last - first) if batch.num_columns > 2 else None
                weight = table.of(shingles, number, listed)
                some, starts = np.unique(texts, return_index=True)
                total = np.zeros(last - first)
                samples = np.zeros((last - first, len(SEEDS)), np.uint32)
                if len(some):
                    total[some] = np.add.reduceat(weight, starts)
                    samples[some] = sample(shingles, weight, starts)
                grouped = samples.reshape(last - first, BANDS, ROWS).astype(np.uint64)
                bands = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (last - first, BANDS)).copy()
                for k in range(ROWS):
                    bands = mix((bands ^ grouped[:, :, k]) * np.uint64(0xE7037ED1A0B428DB))
                nibbles = (samples & np.uint32(15)).astype(np.int64) << (4 * (np.arange(len(SEEDS)) % NIBBLES))
                starts = pa.array(np.arange(0, bands.size + 1, BANDS, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array(keys, pa.binary()),
                        pa.array(np.diff(counts)),
                        pa.array(total),
                        pa.ListArray.from_arrays(starts, pa.array(bands.reshape(-1).view(np.int64))),
                        pa.array(nibbles[:, :NIBBLES].sum(axis=1)),
                        pa.array(nibbles[:, NIBBLES:].sum(axis=1)),
                    ],
                    names=["rid", "words", "size", "weight", "bands", "low", "high"],
                )

    return texts.mapInArrow(run, SKETCH)


def fine_samples(texts: DataFrame, weights) -> DataFrame:
    """rid and the further samples, packed, of every text (rid, t, listed if given) that has words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Weights(*weights.value)
        for batch in batches:
            column = batch.column(1)
            for first, last in chunks(column):
                words, counts = word_hashes(*bytes_of(column, first, last))
                shingles, texts, number = with_counts(*shingle_hashes(words, counts))
                listed = batch.column(2).slice(first, last - first) if batch.num_columns > 2 else None
                some, starts = np.unique(texts, return_index=True)
                if not len(some):
                    continue
                samples = sample(shingles, table.of(shingles, number, listed), starts, FINE_SEEDS)
                bits = (samples.astype(np.uint64) & np.uint64(1)) << (np.arange(FINE, dtype=np.uint64) % np.uint64(PACKED))
                packed = np.bitwise_or.reduce(bits.reshape(len(some), FINE // PACKED, PACKED), axis=2)
                ends = pa.array(np.arange(0, packed.size + 1, FINE // PACKED, dtype=np.int32))
                lists = pa.ListArray.from_arrays(ends, pa.array(packed.reshape(-1).view(np.int64)))
                rids = batch.column(0).slice(first, last - first).take(pa.array(some))
                yield pa.RecordBatch.from_arrays([rids, lists], names=["rid", "fine"])

    return texts.mapInArrow(run, "rid long, fine array<long>")


def buckets(nodes: DataFrame) -> DataFrame:
    """bucket, node, low, high, band, step: bands that two nodes or more share, the fullest ones also divided.

    ``step`` is the number of the pair of samples that divides, -1 for a band that need not be divided,
    and NULL for the whole of one that is divided, which is there for its smallest node only.
    """
    each = nodes.select("node", "low", "high", F.posexplode("bands").alias("band", "key"))
    counts = each.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    shared = each.join(counts, "key")
    whole = shared.select(
        F.col("key").alias("bucket"), "node", "low", "high", "band", F.when(F.col("n") <= FULL_BAND, -1).alias("step")
    )
    pairs = F.lit([[list(pair) for pair in band] for band in DIVISIONS])
    many = shared.filter(F.col("n") > FULL_BAND).select(
        "key", "node", "low", "high", "band", F.posexplode(F.get(pairs, F.col("band"))).alias("step", "pair")
    )
    divided = many.select(
        F.xxhash64("key", "step", _nibble(F.col("pair")[0]), _nibble(F.col("pair")[1])).alias("bucket"),
        *["node", "low", "high", "band", "step"],
    )
    again = divided.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket")
    return whole.unionByName(divided.join(again, "bucket", "left_semi"))


def _nibble(j: Column) -> Column:
    """The bits that are kept of sample ``j``."""
    half = F.when(j < NIBBLES, F.col("low")).otherwise(F.col("high"))
    return F.call_function("shiftright", half, j % NIBBLES * 4).bitwiseAND(F.lit(15))


def differing(x: str, y: str, half: str) -> Column:
    """One bit for each of half the samples, at the place of its four, set if two nodes do not agree in it."""
    differ = F.col(f"{x}.{half}").bitwiseXOR(F.col(f"{y}.{half}"))
    differ = differ.bitwiseOR(F.shiftright(differ, 1))
    return differ.bitwiseOR(F.shiftright(differ, 2)).bitwiseAND(F.lit(int("1" * NIBBLES, 16)))


def fine_agreement(x: str, y: str) -> Column:
    """In how many of the further samples two nodes agree."""
    apart = (F.bit_count(F.col(f"{x}.fine")[k].bitwiseXOR(F.col(f"{y}.fine")[k])) for k in range(FINE // PACKED))
    return F.lit(FINE) - reduce(add, apart)


def agreement(x: str, y: str) -> Column:
    """In how many samples two nodes agree, from the packed samples (one more in 16 of the others)."""
    return F.lit(2 * NIBBLES) - F.bit_count(differing(x, y, "low")) - F.bit_count(differing(x, y, "high"))


def first_shared(x: str, y: str) -> Column:
    """Whether a bucket is of the first band that the two nodes share, and of its first pair of samples that they do."""
    holds = F.lit(True)
    for k in range(BANDS):
        differ = F.col(f"{x}.bands")[k] != F.col(f"{y}.bands")[k]
        holds = holds & (differ | (F.col(f"{x}.band") <= k))
    halves = [[[sum(1 << 4 * (j % NIBBLES) for j in pair if j // NIBBLES == h) for h in (0, 1)] for pair in band] for band in DIVISIONS]
    masks = F.get(F.lit(halves).cast("array<array<array<bigint>>>"), F.col(f"{x}.band"))
    low, high = differing(x, y, "low"), differing(x, y, "high")
    earlier = F.slice(masks, F.lit(1), F.greatest(F.col(f"{x}.step"), F.lit(0)))
    apart = lambda m: (m[0].bitwiseAND(low) != 0) | (m[1].bitwiseAND(high) != 0)
    return holds & F.forall(earlier, apart)


def cells(left: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each node of a bucket of ``blocks`` blocks in block i, at every (i, j) from i on, and at every (i, j) as one of block j.

    So any two nodes of a bucket meet at one (i, j), and nothing has to hold or go through a whole bucket.
    """
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    placed = left.withColumn("block", block)
    first = placed.withColumn("i", F.col("block")).withColumn("j", F.explode(F.sequence("block", F.col("blocks") - 1)))
    second = placed.withColumn("j", F.col("block")).withColumn("i", F.explode(F.sequence(F.lit(0), "block")))
    return first, second


def together(left: DataFrame) -> DataFrame:
    """Each node of a bucket once at every (i, j) where ``cells`` has it, with its ``block``."""
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    placed = left.withColumn("block", block).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return placed.withColumn("i", F.least("block", "with")).withColumn("j", F.greatest("block", "with")).drop("with", "blocks")


def agreeing(left: DataFrame, least: int, above: int, threshold: float) -> DataFrame:
    """Pairs (a, b) of nodes of one bucket and different parts, each pair once.

    They agree in ``AGREE`` samples, and in ``least`` or more but fewer than ``above`` of the further ones. This lists what
    ``joining`` goes through; the number of pairs grows with the square of a bucket.
    """
    on = (
        (F.col("x.bucket") == F.col("y.bucket"))
        & (F.col("x.i") == F.col("y.i"))
        & (F.col("x.j") == F.col("y.j"))
        & ((F.col("x.i") < F.col("x.j")) | (F.col("x.node") < F.col("y.node")))
        & (F.col("x.part") != F.col("y.part"))
        & (F.least("x.weight", "y.weight") >= threshold * F.greatest("x.weight", "y.weight") - 1e-9)
        & (agreement("x", "y") >= AGREE)
        & (fine_agreement("x", "y") >= least)
        & (fine_agreement("x", "y") < above)
        & first_shared("x", "y")
    )
    first, second = cells(left)
    found = first.alias("x").join(second.alias("y"), on)
    return found.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))


class Bags:
    """Shingles of single texts, sorted, with their weights."""

    def __init__(self, weights):
        self.table = Weights(*weights)

    def of(self, text: bytes, listed: pa.ListArray | None) -> tuple[np.ndarray, np.ndarray]:
        data = np.frombuffer(text, np.uint8)
        words, counts = word_hashes(data, np.array([0, len(data)]))
        shingles, _, number = with_counts(*shingle_hashes(words, counts))
        order = np.argsort(shingles)
        return shingles[order], self.table.of(shingles, number, listed)[order]


def similar(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray], threshold: float) -> bool:
    """Whether two bags have a weighted Jaccard similarity of ``threshold`` or more."""
    _, i, j = np.intersect1d(x[0], y[0], assume_unique=True, return_indices=True)
    least = np.minimum(x[1][i], y[1][j]).sum()
    return least >= threshold * (x[1].sum() + y[1].sum() - least) - 1e-9


def verified(pairs: DataFrame, text: DataFrame, weights, threshold: float) -> DataFrame:
    """The pairs (a, b) whose texts (rid, t, listed if given) have a weighted Jaccard similarity of ``threshold`` or more."""
    own = [c for c in text.columns if c != "rid"]
    # few bytes but much work each: dealt by number, as adaptive execution would join them into one task by size
    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = pairs.repartition(tasks, "a", "b").sortWithinPartitions("a")
    text = text.hint("merge")
    right = pairs.join(text, F.col("b") == F.col("rid")).select("a", "b", *[F.col(c).alias(f"{c}b") for c in own])
    both = right.join(text, F.col("a") == F.col("rid"))
    both = both.select("a", "b", "t", "tb", *[c for c in ("listed", "listedb") if "listed" in own])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bags = Bags(weights.value)
        held, own = None, None
        for batch in batches:
            a, b = batch.column(0), batch.column(1)
            left, other = batch.column(2).cast(pa.binary()), batch.column(3).cast(pa.binary())
            lists = batch.columns[4:]
            keep = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                if held != a[i].as_py():
                    held, own = a[i].as_py(), bags.of(left[i].as_py(), lists[0].slice(i, 1) if lists else None)
                theirs = bags.of(other[i].as_py(), lists[1].slice(i, 1) if lists else None)
                keep[i] = similar(own, theirs, threshold)
            at = pa.array(np.flatnonzero(keep))
            yield pa.RecordBatch.from_arrays([a.take(at), b.take(at)], names=["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def _agreed(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """One bit for each of half the samples, as ``differing`` has it, but set if two packed nodes agree in it."""
    differ = x ^ y
    differ |= differ >> 1
    differ |= differ >> 2
    return ~differ & int("1" * NIBBLES, 16)


def candidates(cell: dict[str, np.ndarray], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of the nodes of the pairs of a cell that may be similar, those that agree best first; what ``agreeing`` has."""
    n, crossed = len(cell["node"]), cell["i"][0] != cell["j"][0]
    band, step = int(cell["band"][0]), int(cell["step"][0])
    earlier = DIVISIONS[band][: max(step, 0)]
    fine = cell["fine"].view(np.uint64)  # bits of negative numbers would be counted without their sign
    found = []
    for first in range(0, n, STRIP_NODES):
        x = slice(first, min(first + STRIP_NODES, n))
        apart = cell["part"][x, None] != cell["part"][None, :]
        if crossed:
            apart &= cell["block"][x, None] < cell["block"][None, :]
        else:
            apart &= np.arange(n)[x, None] < np.arange(n)[None, :]
        w, v = cell["weight"][x, None], cell["weight"][None, :]
        apart &= np.minimum(w, v) >= threshold * np.maximum(w, v) - 1e-9
        agreed = np.full(apart.shape, FINE, np.int16)
        for k in range(FINE // PACKED):
            agreed -= np.bitwise_count(fine[x, None, k] ^ fine[None, :, k])
        a, b = np.nonzero(apart & (agreed >= AGREE_FINE[-1]))
        agreed = agreed[a, b]
        a = a + first
        low, high = (_agreed(cell[half][a], cell[half][b]) for half in ("low", "high"))
        keep = np.bitwise_count(low).astype(int) + np.bitwise_count(high) >= AGREE
        for k in range(band):
            keep &= cell["bands"][a, k] != cell["bands"][b, k]
        bit = lambda s: ((low if s < NIBBLES else high) >> 4 * (s % NIBBLES)) & 1
        for s, t in earlier:
            keep &= (bit(s) & bit(t)) == 0
        found.append((agreed[keep], a[keep].astype(np.int32), b[keep].astype(np.int32)))
    agreed, a, b = (np.concatenate(f) for f in zip(*found, strict=True))
    order = np.argsort(-agreed, kind="stable")
    return a[order], b[order]


def joining(left: DataFrame, weights, threshold: float) -> DataFrame:
    """Links (a, b) of nodes of one bucket that join all parts that pairs of similar nodes of the bucket's cells join.

    ``left`` has what ``agreeing`` takes, and each node's text (t, listed if given). A pair whose parts others have
    joined before is not compared, and a cell gives out no more links than it joins parts.
    """
    columns = ["bucket", "i", "j", "node", "block", "part", "weight", "band", "step", "low", "high", "bands", "fine", "t"]
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = together(left).select(*columns, *[c for c in ("listed",) if c in left.columns])
    met = met.repartition(tasks, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "node")

    def compare(rows: pa.Table, bags: Bags) -> list[tuple[int, int]]:
        plain = {c: rows.column(c).to_numpy() for c in columns[:11]}
        lists = {c: rows.column(c).combine_chunks().flatten().to_numpy().reshape(len(rows), -1) for c in ("bands", "fine")}
        a, b = candidates(plain | lists, threshold)
        if not len(a):
            return []
        text = rows.column("t").cast(pa.binary())
        listed = rows.column("listed").combine_chunks() if "listed" in rows.column_names else None
        above = np.unique(plain["part"], return_inverse=True)[1].tolist()
        top = list(range(len(rows)))
        held, size, links = {}, 0, []

        def root(part: int) -> int:
            while top[part] != part:
                top[part] = part = top[top[part]]
            return part

        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            p, q = root(above[x]), root(above[y])
            if p == q:
                continue
            if size > KEPT_SHINGLES:
                held, size = {}, 0
            for k in (x, y):
                if k not in held:
                    held[k] = bags.of(text[k].as_py(), None if listed is None else listed.slice(k, 1))
                    size += len(held[k][0])
            if similar(held[x], held[y], threshold):
                top[p] = q
                links.append((int(plain["node"][x]), int(plain["node"][y])))
        return links

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bags, held, last = Bags(weights.value), [], None

        def done() -> pa.RecordBatch:
            links = np.array(compare(pa.Table.from_batches(held), bags), np.int64).reshape(-1, 2)
            ends = [pa.array(f(links, axis=1)) for f in (np.min, np.max)] if len(links) else [pa.array([], pa.int64())] * 2
            return pa.RecordBatch.from_arrays(ends, names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in range(3)], axis=1)
            new = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for first, end in zip([0, *new.tolist()], [*new.tolist(), len(keys)], strict=True):
                if held and tuple(keys[first]) != last:
                    yield done()
                    held = []
                held.append(batch.slice(first, end - first))
                last = tuple(keys[first])
        if held:
            yield done()

    return met.mapInArrow(run, "a long, b long")


def still_open(shared: DataFrame, edges: DataFrame) -> DataFrame:
    """The rows of buckets whose nodes the links have not joined into one class, with each node's ``part`` and the bucket's ``blocks``."""
    classes = components(edges)
    place = shared.join(classes.withColumnRenamed("id", "node"), "node", "left")
    place = place.select(*shared.columns, F.coalesce("component", "node").alias("part"))
    blocks = F.ceil(F.count("*") / BLOCK_NODES).cast("int").alias("blocks")
    apart = place.groupBy("bucket").agg(F.min("part").alias("least"), F.max("part").alias("most"), blocks).filter("least < most")
    return place.join(apart.select("bucket", "blocks"), "bucket")


def links(rows: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Nodes (rid, node: the smallest row of the same words) and links between nodes.

    The links connect all nodes that pairs of similar nodes connect; pairs already connected by
    others may not be among them.
    """
    spark = rows.sparkSession
    head, rest = frequent_shingles(rows)
    weights = spark.sparkContext.broadcast(head)
    text = rows.select("rid", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    if rest is not None:
        text = saved(listed_weights(text, rest), "listed")
    sketch = saved(sketches(text, weights), "sketches")
    first = sketch.groupBy("words").agg(F.min("rid").alias("node"))
    member = sketch.select("rid", "words").join(first, "words").select("rid", "node")
    node = sketch.join(first.select(F.col("node").alias("rid")), "rid", "left_semi").filter("size > 0")
    node = saved(node.select(F.col("rid").alias("node"), "weight", "bands", "low", "high"), "nodes")
    shared = saved(buckets(node), "buckets")
    leaders = shared.groupBy("bucket").agg(F.min(F.struct("node", "low", "high")).alias("first"))
    # joins that carry texts are by shuffle whatever the size, so that a small table tells what a large one will need
    text = saved(text.join(shared.select(F.col("node").alias("rid")).distinct().hint("merge"), "rid", "left_semi"), "compared")
    stars = shared.alias("x").join(leaders, "bucket").filter(F.col("first.node") < F.col("node"))
    stars = stars.filter((F.coalesce("step", F.lit(-1)) < 0) | (agreement("x", "first") >= AGREE))
    stars = stars.select(F.col("first.node").alias("a"), F.col("node").alias("b")).distinct()
    known = saved(verified(stars, text, weights, threshold), "star-links")
    passing = []
    with recorded(passing):
        left = saved(still_open(shared.filter("step is not null"), known), "open")
        own = text.join(left.select(F.col("node").alias("rid")).distinct().hint("merge"), "rid", "left_semi")
        drawn = node.select("node", "weight", "bands").join(fine_samples(own, weights).withColumnRenamed("rid", "node"), "node")
        drawn = saved(own.withColumnRenamed("rid", "node").join(drawn.hint("merge"), "node"), "fine")
    found = saved(joining(left.join(drawn.hint("merge"), "node"), weights, threshold), "links")
    release(spark, passing)
    return member, known.unionByName(found)


def duplicate_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rid: str | None = None, threshold: float = THRESHOLD
) -> DataFrame:
    """One row for each row: id, class_id, class_size, kept (and rid if given).

    Rows are in one class if links of similarity ``threshold`` or more connect them; ``class_id`` is
    the smallest id of the class (NULL if all are), and of the rows that have it one is kept. NULL text is
    the empty text; texts without words are one class, a text of fewer than five words is one
    shingle, and rows of the same words are always in one class. An empty table gives no rows;
    other columns are not read.
    """
    if rid is None:
        rows = keyed(docs.select(named(id_col).alias("id"), named(text_col).alias("text")))
        rows = rows.select("rid", F.col("row.id").alias("id"), F.col("row.text").alias("text"))
    else:
        rows = docs.select(named(rid).alias("rid"), named(id_col).alias("id"), named(text_col).alias("text"))
    member, edges = links(rows.select("rid", "text"), threshold)
    classes = components(edges)
    part = member.join(classes.withColumnRenamed("id", "node"), "node", "left")
    part = part.select("rid", F.coalesce("component", "node").alias("part"))
    placed = saved(rows.select("rid", "id").join(part, "rid"), "classes")
    order = F.struct(F.col("id").isNull().alias("missing"), F.col("id").alias("id"), F.col("rid").alias("rid"))
    found = placed.groupBy("part").agg(F.min(order).alias("stays"), F.count("*").alias("class_size"))
    return placed.join(found, "part").select(
        *(["rid"] if rid else []),
        F.col("id").alias(id_col),
        F.col("stays.id").alias("class_id"),
        "class_size",
        (F.col("rid") == F.col("stays.rid")).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, one of each class, with all their columns."""
    rows = keyed(docs)
    inner = rows.select("rid", F.col("row").getField(id_col).alias("id"), F.col("row").getField(text_col).alias("text"))
    stay = duplicate_classes(inner, "id", "text", "rid").filter("kept").select("rid")
    return unkeyed(rows.join(stay, "rid", "left_semi"), docs.columns)
