"""Merkle manifest of a dataset, with a witness for every row.

Leaves of a key are appended in order to blocks of ``BLOCK`` leaves. A block's subtrees stay open until
their siblings are complete; each completed sibling extends the witnesses of what is open beside it.
Blocks are spread over tasks, and their roots are appended in the same way by the next round, until each
key has one root; the roots of the keys are appended in turn. Every ``FAN`` consecutive nodes become their
hash, and the last run of a level may be shorter. A block is aligned to a power of ``FAN``, so its
subtrees are subtrees of the whole. A witness ends up as the pieces of its rounds, one after another.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenhand.llm.running import running_sum
from evenhand.llm.tables import named, saved

FAN = 3
LEVELS = 6
BLOCK = FAN**LEVELS
SIZE = 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def parent(digests: list[bytes]) -> bytes:
    """Hash of the hexadecimal digests of a run."""
    return sha256(b"".join(d.hex().encode() for d in digests)).digest()


class OpenBlock:
    """A streaming append of at most ``BLOCK`` digests; ``witnesses`` grow as siblings are completed.

    The piece of a level is a byte (nodes of the run times ``FAN``, plus the own place) and the digests
    of the siblings from left to right.
    """

    def __init__(self) -> None:
        self.open: list[list[tuple[bytes, int, int]]] = [[] for _ in range(LEVELS + 1)]
        self.witnesses: list[bytearray] = []

    def append(self, digest: bytes) -> None:
        first = len(self.witnesses)
        self.witnesses.append(bytearray())
        self._complete(0, digest, first, first + 1)

    def _complete(self, level: int, digest: bytes, first: int, end: int) -> None:
        run = self.open[level]
        run.append((digest, first, end))
        if level < LEVELS and len(run) == FAN:
            self._merge(level)

    def _merge(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        for place, (_, first, end) in enumerate(run):
            piece = bytes([len(run) * FAN + place]) + b"".join(d for i, (d, _, _) in enumerate(run) if i != place)
            for leaf in range(first, end):
                self.witnesses[leaf] += piece
        self._complete(level + 1, parent([d for d, _, _ in run]), run[0][1], run[-1][2])

    def close(self, alone: bool) -> bytes:
        """The root. A block that is ``alone`` in its tree ends at its first single node, others at their full height."""
        for level in range(LEVELS):
            if alone and len(self.open[level]) == 1 and not any(self.open[level + 1 :]):
                return self.open[level][0][0]
            if self.open[level]:
                self._merge(level)
        return self.open[LEVELS][0][0]


def _appended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (key, pos) with their block's witness, and the block's root at its first row."""
    pending, witnesses, roots = None, [], []
    block, at = OpenBlock(), None

    def close() -> None:
        nonlocal block
        root = block.close(alone=at[1] == 0 and len(block.witnesses) < BLOCK)
        witnesses.extend(map(bytes, block.witnesses))
        roots.extend([root] + [None] * (len(block.witnesses) - 1))
        block = OpenBlock()

    def ready() -> pa.RecordBatch:
        nonlocal pending
        done, pending = pending.slice(0, len(roots)), pending.slice(len(roots))
        columns = [*done.columns, pa.chunked_array([pa.array(witnesses, pa.binary())]), pa.chunked_array([pa.array(roots, pa.binary())])]
        out = pa.table(columns, names=[*done.column_names, "witness", "block_root"]).combine_chunks()
        witnesses.clear()
        roots.clear()
        return out.to_batches()

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        pending = rows if pending is None else pa.concat_tables([pending, rows])
        for key, of, digest in zip(batch["key"].to_pylist(), batch["block"].to_pylist(), batch["digest"].to_pylist(), strict=True):
            if at is not None and at != (key, of):
                close()
            at = (key, of)
            block.append(digest)
        if roots:
            yield from ready()
    if block.witnesses:
        close()
        yield from ready()


def _round(nodes: DataFrame, what: str) -> DataFrame:
    """One append of nodes (key, pos, digest and others): their blocks, witnesses within them and roots."""
    placed = nodes.withColumn("block", F.floor(F.col("pos") / BLOCK).cast("long"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema)
    ordered = placed.repartition("key", "block").sortWithinPartitions("key", "pos")
    return saved(ordered.mapInArrow(_appended, f"{schema}, witness binary, block_root binary"), what)


def _roots(done: DataFrame) -> DataFrame:
    return done.filter(F.col("block_root").isNotNull())


def _rounds(nodes: DataFrame, what: str) -> list[DataFrame]:
    """Rounds until each key has a single root; a round has a node for each block of the one before."""
    rounds = []
    while True:
        done = _round(nodes, what)
        rounds.append(done)
        nodes = _roots(done).select("key", F.col("block").alias("pos"), F.col("block_root").alias("digest"))
        if nodes.filter("pos > 0").isEmpty():
            return rounds


def _extended(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """Rows of the first round with the pieces of all later ones; ``above`` has one row for each key.

    A block is joined to its own rows, never more than ``BLOCK``, so no key gathers its rows anywhere.
    """
    for i, done in reversed(list(enumerate(rounds))):
        on = ["key"] if i == len(rounds) - 1 else ["key", "block"]
        lower = done.join(above, on)
        rest = [c for c in above.columns if c not in ("key", "block", "upper")]
        whole = F.concat("witness", "upper")
        if i == 0:
            own = [c for c in done.columns if c not in ("witness", "block_root", "block")]
            return lower.select(*own, whole.alias("witness"), *rest)
        above = lower.select("key", F.col("pos").alias("block"), whole.alias("upper"), *rest)
    raise ValueError("there is always a round")


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    """Digest of a row: each value as its length in bytes, a colon and itself, NULL as a dash."""
    return F.unhex(F.sha2(F.concat(*[_field(v) for v in values]), 256))


def manifest(leaves: DataFrame) -> DataFrame:
    """Leaves with their position, witness, and the roots over them.

    ``leaves`` has ``source`` (NULL is a source of its own and the first), ``id`` (any type with an order, NULL
    first), ``leaf`` (binary), and other columns that stay. Leaves of a source ascend by id, and by digest where
    ids repeat. Added: ``pos`` within the source, ``witness`` (see ``OpenBlock``), ``subroot`` of the source and
    ``root`` of all. No rows give no rows. Not to be used as other columns: key, pos, block, digest, witness,
    subroot, root.
    """
    kept = [c for c in leaves.columns if c not in ("source", "leaf")]
    key = F.when(F.col("source").isNull(), "-").otherwise(F.concat(F.lit("="), "source"))
    rows = saved(leaves.select(key.alias("key"), F.col("leaf").alias("digest"), *kept, F.lit(1).alias("one"), F.monotonically_increasing_id().alias("rid")), "leaves")
    placed = running_sum(rows, ["key"], ["id", "digest", "rid"], "one", "pos", "positions").drop("one", "rid")
    sources = _rounds(placed, "witnesses")
    one = F.lit(1).alias("one")
    subroots = saved(_roots(sources[-1]).select("key", F.col("block_root").alias("digest"), one), "subroots")
    ordered = running_sum(subroots, [], ["key"], "one", "pos", "sources")
    tops = _rounds(ordered.select(F.lit("").alias("key"), "pos", "digest", F.col("key").alias("source")), "tops")
    root = _roots(tops[-1]).select("key", F.col("block_root").alias("root"), F.lit(b"").alias("upper"))
    above = _extended(tops, root).select(
        F.col("source").alias("key"), F.col("witness").alias("upper"), F.col("digest").alias("subroot"), "root"
    )
    found = _extended(sources, above)
    return found.select(
        F.when(F.col("key") != "-", F.substring("key", 2, 1 << 30)).alias("source"),
        *kept,
        F.col("digest").alias("leaf"),
        "pos",
        "witness",
        "subroot",
        "root",
    )


def siblings(witness: bytes) -> Iterator[tuple[int, list[bytes]]]:
    """Own place and siblings, level by level."""
    at = 0
    while at < len(witness):
        nodes, place = divmod(witness[at], FAN)
        end = at + 1 + (nodes - 1) * SIZE
        yield place, [witness[i : i + SIZE] for i in range(at + 1, end, SIZE)]
        at = end


def folded(digest: bytes, witness: bytes) -> bytes:
    """The root that a leaf and its witness lead to."""
    for place, others in siblings(witness):
        digest = parent([*others[:place], digest, *others[place:]])
    return digest


@F.pandas_udf(T.BinaryType())
def folded_root(digests: pd.Series, witnesses: pd.Series) -> pd.Series:
    return pd.Series([folded(d, w) for d, w in zip(digests, witnesses, strict=True)], dtype=object)


@F.pandas_udf(T.BinaryType())
def proof_digest(witnesses: pd.Series) -> pd.Series:
    """Hash of all siblings of a witness."""
    return pd.Series([parent([d for _, others in siblings(w) for d in others]) for w in witnesses], dtype=object)


def document_manifest(docs: DataFrame) -> DataFrame:
    """The manifest of documents, proved for each row against a copy in which some texts have lost their line ends.

    A row is tampered with where 2 divides the crc32 of its decimal doc_id (NULL as the empty text). Returns doc_id, leaf, subroot, root and
    proof_sha256 in lowercase hexadecimal, ``folded_root`` from the leaf of the copy and the original witness, and
    ``verified`` where that is the root. Repeated rows have their own places; other columns are not read.
    """
    values = {c: named(c) for c in FIELDS}
    number = F.coalesce(values["doc_id"].cast("string"), F.lit(""))
    touched = (F.crc32(F.encode(number, "UTF-8")) % 2 == 0) & F.contains(values["text"], F.lit("\n"))
    copy = leaf(*[F.replace(v, F.lit("\n"), F.lit("")) if c == "text" else v for c, v in values.items()])
    leaves = docs.select(
        values["doc_id"].alias("id"),
        values["source"].cast("string").alias("source"),
        leaf(*values.values()).alias("leaf"),
        F.when(touched, copy).alias("copy"),
    )
    whole = manifest(leaves).select("*", proof_digest("witness").alias("proof"), folded_root(F.coalesce("copy", "leaf"), "witness").alias("led_to"))

    def spelled(column: str) -> Column:
        return F.lower(F.hex(column))

    return whole.select(
        F.col("id").alias("doc_id"),
        spelled("leaf").alias("leaf"),
        spelled("subroot").alias("subroot"),
        spelled("root").alias("root"),
        spelled("proof").alias("proof_sha256"),
        spelled("led_to").alias("folded_root"),
        (F.col("led_to") == F.col("root")).alias("verified"),
    )
