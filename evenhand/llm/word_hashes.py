"""Hashes of words and of word shingles, for whole Arrow columns of text at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from evenhand.llm.tables import worker_state

SHINGLE = 5
CHUNK_BYTES = 1 << 21

_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEPS = [np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit permutation that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x *= _STEPS[0]
    x ^= x >> np.uint64(29)
    x *= _STEPS[1]
    x ^= x >> np.uint64(32)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64, at least ``n`` of each."""
    held = worker_state("powers", lambda: [np.ones(1, np.uint64), np.ones(1, np.uint64)])
    if len(held[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, base in enumerate((int(_BASE), pow(int(_BASE), -1, 1 << 64))):
            powers = np.full(size, base, np.uint64)
            powers[0] = 1
            held[i] = np.multiply.accumulate(powers)
    return held[0], held[1]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of texts of at most ``limit`` bytes, or of one text."""
    ends = np.frombuffer(column.buffers()[1], np.int32 if column.type == pa.string() else np.int64)
    ends = ends[column.offset : column.offset + len(column) + 1].astype(np.int64)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(ends, ends[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, last
        first = last


def bytes_of(column: pa.Array, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of texts ``first`` to ``last`` and the offsets of each; NULL has none."""
    kind = np.int32 if column.type == pa.string() else np.int64
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset + first : column.offset + last + 1].astype(np.int64)
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word (bytes between blanks), and for each text the number of words before it."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    full = offsets[1:] > offsets[:-1]
    before = np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    before[offsets[:-1][full]] = False
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, inside[1:]
    after[offsets[1:][full] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    powers, inverse = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:n], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    return hashes, np.searchsorted(starts, offsets)


def shingle_hashes(words: np.ndarray, counts: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each run of ``size`` words, and the text of each; a shorter text is one run."""
    n = np.diff(counts)
    texts = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(words)) - counts[:-1][texts]
    first = (place == 0) | (place <= n[texts] - size)
    at = np.flatnonzero(first)
    length = np.minimum(n[texts[at]], size)
    found = np.full(len(at), 0x27D4EB2F165667C5, np.uint64)
    for k in range(size):
        some = length > k
        step = words[np.minimum(at + k, len(words) - 1)]
        found = np.where(some, mix((found ^ step) * _STEPS[2] + np.uint64(k + 1)), found)
    return found, texts[at]


def with_counts(shingles: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's shingles once, with how often it has them: hashes, texts, counts."""
    own = mix(shingles ^ (texts.astype(np.uint64) + np.uint64(1)) * _BASE)
    ordered = np.sort(own)
    repeated = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    counts = np.ones(len(own), np.int64)
    if len(repeated):
        where = np.searchsorted(repeated, own)
        where[where == len(repeated)] = 0
        again = np.flatnonzero(repeated[where] == own)
        _, first, number = np.unique(own[again], return_index=True, return_counts=True)
        keep = np.ones(len(own), bool)
        keep[again] = False
        keep[again[first]] = True
        counts[again[first]] = number
        shingles, texts, counts = shingles[keep], texts[keep], counts[keep]
    return shingles, texts, counts
