"""Token ids in files of independent zstandard frames.

A file holds frames one after the other, each with ids of one document only (a long document has
several), then a skippable frame with the document index, then a skippable frame with the seek
table: size, original size and checksum of each frame. A reader takes the two tables from the end
of the file and decompresses the frames of the documents it wants, nothing else.

All integers are little-endian; ids are unsigned 32-bit.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evenhand.llm.tables import named, saved, shared_path, worker_state

END_ID = 0
FRAME_IDS = 1 << 18
LEVEL = 3
CACHED_WORDS = 1_000_000
CACHED_LENGTH = 64
JOINED = 256
CHUNK_CHARS = 1 << 20

# Fixed values of the zstandard formats: skippable frame numbers, and the mark at a file's end.
INDEX_MAGIC = 0x184D2A50
SEEK_MAGIC = 0x184D2A5E
SEEK_END = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

MANIFEST = "part int, file string, docs long, tokens long"
_ENTRY = np.dtype([("packed", "<u4"), ("size", "<u4"), ("checksum", "<u4")])
_DOC = np.dtype([("id", "<i8"), ("missing", "u1"), ("frame", "<u4"), ("tokens", "<u8")])


class WordEncoder:
    """Encodes texts with a byte-level BPE tokenizer, keeping the ids of words it has seen.

    The tokenizer always begins a new piece at a space that follows a non-blank, so such texts are
    encoded word by word, new words many at a time. Texts with a space after another blank are
    encoded as a whole. Words are kept in two generations of bounded size, so that frequent ones stay.
    """

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(definition)
        self.after_blank = re.compile(r"\s ").search
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        # a byte-level vocabulary writes a space as U+0120
        self.spaced = np.zeros(max(vocabulary.values()) + 1, bool)
        self.spaced[[i for piece, i in vocabulary.items() if piece.startswith("\u0120")]] = True

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, "<u4").tobytes() for e in self._fast(texts)]

    def _fast(self, texts: list[str]) -> list:
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word with a space before it: many words are one text, cut at its spaces."""
        out: list[bytes] = []
        for at in range(0, len(words), JOINED):
            some = words[at : at + JOINED]
            ids = np.asarray(self._fast([" " + " ".join(some)])[0].ids, "<u4")
            begins = np.flatnonzero(self.spaced[ids])
            if len(begins) == len(some):
                whole, ends = ids.tobytes(), [*(4 * begins[1:]).tolist(), 4 * len(ids)]
                out += [whole[a:b] for a, b in zip((4 * begins).tolist(), ends, strict=True)]
            else:
                out += self._encode([" " + w for w in some])
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as bytes."""
        if len(self.young) > CACHED_WORDS:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        split = [[t] if self.after_blank(t) else t.split(" ") for t in texts]
        found = [list(map(young.get, words)) for words in split]
        # the first piece of a text has no space before it, so it is not one of the kept words
        gaps = [[i for i, ids in enumerate(row) if ids is None and i] if None in row else [] for row in found]
        unknown = {words[i] for words, places in zip(split, gaps, strict=True) for i in places}
        back = [w for w in unknown if w in old]
        young.update(zip(back, map(old.__getitem__, back), strict=True))
        unknown.difference_update(back)
        short = [w for w in unknown if w and len(w) <= CACHED_LENGTH]
        young.update(zip(short, self._encode_words(short), strict=True))
        alone = [w for w in unknown if not w or len(w) > CACHED_LENGTH]
        young.update(zip(alone, self._encode([" " + w for w in alone]), strict=True))
        heads = self._encode([words[0] for words in split])
        out = []
        for head, words, row, places in zip(heads, split, found, gaps, strict=True):
            row[0] = head
            for i in places:
                row[i] = young[words[i]]
            out.append(b"".join(row))
        for word in alone:  # long words are not kept
            if len(word) > CACHED_LENGTH:
                del young[word]
        return out


def write_file(sink, documents: Iterable[tuple[int | None, bytes]]) -> tuple[int, int]:
    """Write (id, ids as bytes) in the given order; documents and ids written."""
    packer = zstandard.ZstdCompressor(level=LEVEL)
    frames, docs, tokens = [], [], 0
    for doc_id, ids in documents:
        count = len(ids) // 4
        docs.append((doc_id or 0, doc_id is None, len(frames), count))
        tokens += count
        for at in range(0, len(ids), 4 * FRAME_IDS):
            part = ids[at : at + 4 * FRAME_IDS]
            packed = packer.compress(part)
            sink.write(packed)
            frames.append((len(packed), len(part), xxhash.xxh64_intdigest(part) & 0xFFFFFFFF))
    index = packer.compress(np.array(docs, _DOC).tobytes())
    sink.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
    table = np.array(frames, _ENTRY).tobytes()
    foot = struct.pack("<IBI", len(frames), CHECKSUM_FLAG, SEEK_END)
    sink.write(struct.pack("<II", SEEK_MAGIC, len(table) + len(foot)) + table + foot)
    return len(docs), tokens


class TokenFile:
    """Random access to the documents of a file."""

    def __init__(self, source, size: int):
        self.source = source
        foot = self._read(size - 9, 9)
        count, flags, mark = struct.unpack("<IBI", foot)
        if mark != SEEK_END or flags != CHECKSUM_FLAG:
            raise ValueError("not a token file")
        table_at = size - 9 - count * _ENTRY.itemsize
        self.frames = np.frombuffer(self._read(table_at, count * _ENTRY.itemsize), _ENTRY)
        self.ends = np.cumsum(self.frames["packed"].astype(np.int64))
        index_at = int(self.ends[-1]) if count else 0
        magic, length = struct.unpack("<II", self._read(index_at, 8))
        if magic != INDEX_MAGIC:
            raise ValueError("the document index is missing")
        packed = self._read(index_at + 8, length)
        self.docs = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), _DOC)

    def _read(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        return self.source.read(size)

    def document(self, i: int) -> bytes:
        """The ids of the document at place ``i``, its frames checked."""
        first = int(self.docs["frame"][i])
        last = int(self.docs["frame"][i + 1]) if i + 1 < len(self.docs) else len(self.frames)
        parts = []
        for k in range(first, last):
            packed = int(self.frames["packed"][k])
            part = zstandard.ZstdDecompressor().decompress(
                self._read(int(self.ends[k]) - packed, packed), max_output_size=int(self.frames["size"][k])
            )
            if xxhash.xxh64_intdigest(part) & 0xFFFFFFFF != int(self.frames["checksum"][k]):
                raise ValueError(f"frame {k} does not match its checksum")
            parts.append(part)
        return b"".join(parts)

    def find(self, doc_id: int) -> list[int]:
        """Places of a document id."""
        return np.flatnonzero((self.docs["id"] == doc_id) & (self.docs["missing"] == 0)).tolist()


def _filesystem(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if re.match(r"\w+:/", path) else os.path.abspath(path))


def open_file(path: str) -> TokenFile:
    files, inner = _filesystem(path)
    return TokenFile(files.open_input_file(inner), files.get_file_info(inner).size)


def write_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Encode all texts and write files in ascending id order; returns the manifest, one row a file.

    NULL text is the empty text, which has the end id only. NULL ids come first; rows that share an
    id are ordered by a hash of their text. ``vocabulary`` is the path of a tokenizer file that the
    driver reads. A repeated task writes a file of its own, and the manifest names the one that
    counts. An empty table has an empty manifest. There are at most as many files as shuffle partitions or as
    partitions of ``docs``, whichever is more, so files do not grow with a table.
    """
    spark = docs.sparkSession
    path = path or shared_path(spark, "tokens")
    with open(vocabulary, encoding="utf-8") as f:
        definition = spark.sparkContext.broadcast(f.read())
    text = F.coalesce(named(text_col).cast("string"), F.lit(""))
    rows = docs.select(named(id_col).cast("long").alias("id"), text.alias("t"))
    order = [F.col("id"), F.xxhash64("t"), F.monotonically_increasing_id()]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions())
    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions("id", F.xxhash64("t"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = worker_state("encoder", lambda: WordEncoder(definition.value))
        task = TaskContext.get()
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        end = struct.pack("<I", END_ID)

        def documents():
            batch = first
            while batch is not None:
                texts, keys, a = batch.column("t").to_pylist(), batch.column("id").to_pylist(), 0
                while a < len(texts):
                    b, size = a + 1, len(texts[a])
                    while b < len(texts) and size + len(texts[b]) <= CHUNK_CHARS:
                        size, b = size + len(texts[b]), b + 1
                    yield from ((i, ids + end) for i, ids in zip(keys[a:b], encoder.encode(texts[a:b]), strict=True))
                    a = b
                batch = next(batches, None)

        file = f"{path}/part-{task.partitionId():06d}-{task.taskAttemptId()}.zst"
        files, inner = _filesystem(file)
        files.create_dir(os.path.dirname(inner), recursive=True)
        with files.open_output_stream(inner, compression=None) as sink:
            count, tokens = write_file(sink, documents())
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array([task.partitionId()], pa.int32()), "file": [file], "docs": [count], "tokens": [tokens]}
        )

    return saved(ordered.mapInArrow(write, MANIFEST), "manifest")


def read_tokens(manifest: DataFrame, first: int | None = None, last: int | None = None) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of documents, read from the files.

    ``start`` counts the ids of all documents before. With ``first`` or ``last`` only documents of
    that range of ids are decompressed.
    """
    parts = max(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), manifest.count())
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row a file
    placed = manifest.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    files = placed.select("file", "base").repartition(parts, "file")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                source = open_file(file)
                docs = source.docs
                present = docs["missing"] == 0
                wanted = np.ones(len(docs), bool)
                if first is not None:
                    wanted &= present & (docs["id"] >= first)
                if last is not None:
                    wanted &= present & (docs["id"] <= last)
                starts = base + np.cumsum(docs["tokens"].astype(np.int64)) - docs["tokens"].astype(np.int64)
                places = np.flatnonzero(wanted)
                sums = np.fromiter((zlib.crc32(source.document(i)) for i in places), np.int64, len(places))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(docs["id"][places].astype(np.int64), mask=~present[places]),
                        pa.array(starts[places]),
                        pa.array(docs["tokens"][places].astype(np.int64)),
                        pa.array(sums),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def round_trip(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Write all documents and read them back."""
    return read_tokens(write_tokens(docs.select("doc_id", "text"), vocabulary or default_vocabulary()))
