"""Sampled segmentations of texts into SentencePiece pieces, drawn without replacement.

A text's lattice has a node at every character and an edge for every piece of the vocabulary that
matches there; characters that no piece has are spelled in bytes. A segmentation's probability is
the product of its pieces' weights over the sum for all segmentations, which a forward pass gives.
Choosing, backwards from the end of each word, one incoming edge after the other makes the
segmentations the leaves of a tree whose nodes have known probabilities.

The ``k`` leaves of greatest Gumbel-perturbed log-probability are a sample without replacement. They
are found best-first: the root's Gumbel value is drawn once, a leaf that continues a node inherits its
value, and what a leaf leaves aside at each choice becomes a node whose value is drawn below the leaf's. The
open node of the greatest value is continued next; no segmentation is listed that is not emitted. The
value at which the search stops turns a sample's probability into the probability that it is included.

No piece reaches over a space that follows another character, so words are independent parts of the
lattice, and equal words of a chunk share theirs. All random numbers are hashes of the row's key and
of the place in the lattice: partitioning and retries change nothing.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenhand.llm.tables import named, worker_state
from evenhand.llm.word_hashes import mix

SAMPLES = 2
SEED = 23
CHUNK_CHARS = 1 << 20
STORED_EDGES = 6_000_000
#: A Gumbel value is at most this far above its location, as 53 random bits go; and how far down nodes are looked at first.
NOISE = 38.0
FINE = float(1 << 36)
FAR = -60.0
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD1342543DE82EF95


class Vocabulary:
    """Pieces of a SentencePiece model that can be matched, by hash, and their log-weights.

    Pieces are numbered by how early they were merged; the weight falls with that rank as word
    frequencies do. A byte weighs as much as the last piece.
    """

    def __init__(self, proto: bytes):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        size = model.get_piece_size()
        plain = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int64)
        # the model writes a space as U+2581
        texts = {i: model.id_to_piece(i).replace("▁", " ") for i in plain}
        if any(" " in t.lstrip(" ") for t in texts.values()):
            raise ValueError("a piece of this model reaches over a space")
        self.spelled: list[bytes] = [b""] * size
        for i, t in texts.items():
            self.spelled[i] = t.encode()
        for b, i in enumerate(self.byte_ids.tolist()):
            self.spelled[i] = bytes([b])
        self.longest = max(map(len, texts.values()))
        whole = np.frombuffer("".join(texts.values()).encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.fromiter(map(len, texts.values()), np.int64, len(texts))
        ends = np.cumsum(lengths)
        prefix, inverse = prefix_hashes(whole)
        hashes = span_hashes(prefix, inverse, ends - lengths, ends)
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], np.array(plain, np.int64)[order]
        rank = np.argsort(np.argsort(np.array(plain)))
        self.weights = -np.log(rank + 10.0)[order]
        self.byte_weight = -np.log(len(plain) + 10.0)
        self.likely = np.zeros(1 << 20, bool)
        self.likely[(self.hashes >> np.uint64(44)).astype(np.intp)] = True

        self.bytes = np.frombuffer(b"".join(self.spelled), np.uint8)
        self.size = np.fromiter(map(len, self.spelled), np.int64, size)
        self.begin = np.cumsum(self.size) - self.size

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[memoryview]:
        """The texts of sequences of ids that follow each other: pieces joined, without the space put before."""
        size = self.size[ids]
        ends = np.cumsum(size)
        out = memoryview(self.bytes[np.repeat(self.begin[ids] - (ends - size), size) + np.arange(size.sum())])
        stop = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        return [out[a + 1 : b] for a, b in zip(stop[:-1], stop[1:], strict=True)]


def prefix_hashes(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums from which the hash of any span of code points follows, and inverse powers."""
    n = len(points)
    held = worker_state("point_powers", lambda: [np.ones(1, np.uint64)] * 2)
    if len(held[0]) < n + 1:
        size = 1 << n.bit_length()
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            powers = np.full(size, base, np.uint64)
            powers[0] = 1
            held[i] = np.multiply.accumulate(powers)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * held[0][:n], out=sums[1:])
    return sums, held[1]


def span_hashes(sums: np.ndarray, inverse: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * _GOLD)


def stir(keys: np.ndarray, part) -> np.ndarray:
    """A hash of keys and a further integer, or integers."""
    return mix((keys ^ np.asarray(part, np.int64).astype(np.uint64)) * _GOLD + np.uint64(1))


def uniform(keys: np.ndarray, part) -> np.ndarray:
    """Numbers between 0 and 1, both excluded, from a hash of keys and a further integer."""
    return ((stir(keys, part) >> np.uint64(11)).astype(np.float64) + 0.5) * (1.0 / (1 << 53))


def below(location: np.ndarray, bound: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel values at a location, given that they are under a bound."""
    with np.errstate(divide="ignore", over="ignore", invalid="ignore"):
        value = location - np.log(np.exp(location - bound) - np.log(u))
    return np.where(np.isneginf(location), -np.inf, value)


@dataclass
class Lattice:
    """Incoming edges of all nodes of all distinct words, node by node.

    ``share`` is the log-probability of an edge among those into its node, ``upto`` the sum of the
    probabilities of the node's edges up to it. An ``id`` under 0 is a character spelled in bytes.
    """

    first: np.ndarray
    number: np.ndarray
    start: np.ndarray
    id: np.ndarray
    width: np.ndarray
    share: np.ndarray
    upto: np.ndarray
    begin: np.ndarray
    end: np.ndarray


def build(points: np.ndarray, starts: np.ndarray, ends: np.ndarray, vocabulary: Vocabulary) -> Lattice:
    """The lattice of the words at the given places."""
    lengths = ends - starts
    words = np.repeat(np.arange(len(starts)), lengths)
    offset = np.cumsum(lengths) - lengths
    inside = np.arange(len(words)) - offset[words]
    chars = points[starts[words] + inside]
    left = lengths[words] - inside
    # a word's nodes: before each of its characters, and one at its end
    node = np.arange(len(words)) + words
    sums, inverse = prefix_hashes(chars)
    found = [[], [], [], [], []]
    single = np.zeros(len(words), bool)
    for length in range(1, vocabulary.longest + 1):
        at = np.flatnonzero(left >= length)
        if not len(at):
            break
        h = span_hashes(sums, inverse, at, at + length)
        maybe = np.flatnonzero(vocabulary.likely[(h >> np.uint64(44)).astype(np.intp)])
        where = np.minimum(np.searchsorted(vocabulary.hashes, h[maybe]), len(vocabulary.hashes) - 1)
        hit = vocabulary.hashes[where] == h[maybe]
        at, where = at[maybe[hit]], where[hit]
        if length == 1:
            single[at] = True
        for held, x in zip(
            found,
            (node[at], node[at] + length, vocabulary.ids[where], np.ones(len(at), np.int64), vocabulary.weights[where]),
            strict=True,
        ):
            held.append(x)
    rare = np.flatnonzero(~single)
    size = 1 + (chars[rare] > 0x7F).astype(np.int64) + (chars[rare] > 0x7FF) + (chars[rare] > 0xFFFF)
    for held, x in zip(
        found, (node[rare], node[rare] + 1, -1 - chars[rare].astype(np.int64), size, size * vocabulary.byte_weight), strict=True
    ):
        held.append(x)
    start, end, ids, width, weight = map(np.concatenate, found)
    depth = np.zeros(len(words) + len(starts), np.int64)
    depth[node] = inside
    depth[node[lengths[words] == inside + 1] + 1] = lengths
    # by depth, node and weight
    within = (end << 16) | np.minimum((weight * -2000).astype(np.int64), 0xFFFF)
    order = np.argsort(within)
    order = order[np.argsort(depth[end[order]].astype(np.int32), kind="stable")]
    start, end, ids, width, weight = (x[order] for x in (start, end, ids, width, weight))
    share, upto = np.empty(len(end)), np.empty(len(end))
    total = np.zeros(len(depth))
    first, number = np.zeros(len(depth), np.int64), np.zeros(len(depth), np.int64)
    stops = np.flatnonzero(np.diff(depth[end], append=-1)) + 1
    a = 0
    for b in stops:  # all edges that end at the same depth
        at = np.flatnonzero(np.diff(end[a:b], prepend=-1))
        nodes, count = end[a:b][at], np.diff(at, append=b - a)
        value = total[start[a:b]] + weight[a:b]
        top = np.maximum.reduceat(value, at)
        each = np.repeat(np.arange(len(nodes)), count)
        mass = np.exp(value - top[each])
        whole = np.add.reduceat(mass, at)
        total[nodes] = top + np.log(whole)
        share[a:b] = value - total[nodes][each]
        units = np.rint(mass / whole[each] * FINE).astype(np.int64)
        run = np.cumsum(units)
        upto[a:b] = (run - (run[at] - units[at])[each]) / FINE
        first[nodes], number[nodes] = at + a, count
        a = b
    begin = offset + np.arange(len(starts))
    return Lattice(
        first.astype(np.int32),
        number.astype(np.int32),
        start.astype(np.int32),
        ids.astype(np.int32),
        width.astype(np.int8),
        share.astype(np.float32),
        upto.astype(np.float32),
        begin.astype(np.int32),
        (begin + lengths).astype(np.int32),
    )


class Store:
    """Lattices of words met so far, in arrays that grow; begun anew once they reach a bound."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.hashes, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.lattice: Lattice | None = None

    def words(self, hashes: np.ndarray, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number, in the store's lattice, of each of some distinct words."""
        if self.lattice is not None and len(self.lattice.start) > STORED_EDGES:
            self.__init__(self.vocabulary)
        at = np.minimum(np.searchsorted(self.hashes, hashes), max(len(self.hashes) - 1, 0))
        known = self.hashes[at] == hashes if len(self.hashes) else np.zeros(len(hashes), bool)
        new = np.flatnonzero(~known)
        found = np.empty(len(hashes), np.int64)
        if len(self.hashes):
            found[known] = self.numbers[at[known]]
        if len(new):
            count = 0 if self.lattice is None else len(self.lattice.begin)
            found[new] = count + np.arange(len(new))
            self._append(build(points, starts[new], ends[new], self.vocabulary))
            merged, numbers = np.concatenate([self.hashes, hashes[new]]), np.concatenate([self.numbers, found[new]])
            order = np.argsort(merged)
            self.hashes, self.numbers = merged[order], numbers[order]
        return found

    def _append(self, more: Lattice) -> None:
        have = self.lattice
        if have is None:
            self.lattice = more
            return
        edges, nodes = len(have.start), len(have.first)
        for name, shift in (("first", edges), ("start", nodes), ("begin", nodes), ("end", nodes)):
            setattr(have, name, np.concatenate([getattr(have, name), getattr(more, name) + np.int32(shift)]))
        for name in ("number", "id", "width", "share", "upto"):
            setattr(have, name, np.concatenate([getattr(have, name), getattr(more, name)]))


@dataclass
class Leaf:
    """A segmentation of every text of a chunk: the edges chosen, word by word, and their number a word."""

    edges: np.ndarray
    count: np.ndarray

    @property
    def offset(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.count)])


def draw(lattice: Lattice, words: np.ndarray, keys: np.ndarray, places: np.ndarray, sample: int) -> Leaf:
    """A segmentation of each word, by chance: ``keys`` of its text and ``places`` in it seed the choice."""
    seeds = stir(stir(keys, sample), places)
    node = lattice.end[words]
    begin = lattice.begin[words]
    active = np.arange(len(words))
    taken, step = [], 0
    count = np.zeros(len(words), np.int64)
    while len(active):
        x = uniform(seeds[active], step)
        edge = lattice.first[node]
        last = edge + lattice.number[node] - 1
        more = np.flatnonzero((x > lattice.upto[edge]) & (edge < last))
        while len(more):
            edge[more] += 1
            more = more[(x[more] > lattice.upto[edge[more]]) & (edge[more] < last[more])]
        taken.append((active, edge))
        count[active] += 1
        node = lattice.start[edge]
        going = node != begin[active]
        active, node, step = active[going], node[going], step + 1
    offset = np.cumsum(count) - count
    edges = np.empty(int(count.sum()), np.int64)
    for k, (who, edge) in enumerate(taken):
        edges[offset[who] + k] = edge
    return Leaf(edges, count)


def _tops(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` greatest values of each segment and their places."""
    best = np.full((len(starts), k), -np.inf)
    where = np.full((len(starts), k), -1)
    some = np.flatnonzero(ends > starts)
    values = values.copy()
    if not len(some):
        return best, where
    segment = np.repeat(np.arange(len(some)), (ends - starts)[some])
    for j in range(k):
        top = np.maximum.reduceat(values, starts[some])
        hit = np.flatnonzero((values == top[segment]) & ~np.isneginf(values))
        owner, first = np.unique(segment[hit], return_index=True)
        best[some[owner], j], where[some[owner], j] = top[owner], hit[first]
        values[hit[first]] = -np.inf
    return best, where


class Search:
    """Best-first search for the texts of a chunk side by side."""

    def __init__(self, lattice: Lattice, words: np.ndarray, texts: np.ndarray, n_texts: int, keys: np.ndarray, k: int):
        self.lattice, self.words, self.texts, self.keys, self.k = lattice, words, texts, keys, k
        self.bounds = np.searchsorted(texts, np.arange(n_texts + 1))
        self.places = np.arange(len(words)) - self.bounds[:-1][texts]
        self.open: list[list[tuple]] = [[] for _ in range(n_texts)]
        self.leaves: list[Leaf] = []
        self.scores: list[tuple[np.ndarray, np.ndarray]] = []
        self.excluded: list[dict[int, tuple[int, int, frozenset]]] = []

    def run(self) -> tuple[list[Leaf], np.ndarray, np.ndarray, np.ndarray]:
        """Leaves, their log-probabilities and Gumbel values (-inf: no such leaf), and the value at which each search stops."""
        n = len(self.keys)
        top = -np.log(-np.log(uniform(self.keys, 1 << 40)))
        self._add(draw(self.lattice, self.words, self.keys[self.texts], self.places, 0), top, np.zeros(n, np.int64), {})
        for s in range(1, self.k):
            self._next(s)
        stop = np.array([max((o[0] for o in held), default=-np.inf) for held in self.open])
        probabilities = np.array([p for p, _ in self.scores])
        return self.leaves, probabilities, np.array([g for _, g in self.scores]), stop

    def _add(self, leaf: Leaf, value: np.ndarray, since: np.ndarray, excluded: dict) -> None:
        """Record a leaf and open what it leaves aside from choice ``since`` of each text on."""
        number = len(self.leaves)
        offset = leaf.offset
        share = self.lattice.share[leaf.edges].astype(np.float64)
        # sums in whole units, so that they do not depend on the texts before
        line = np.concatenate([[0], np.cumsum(np.rint(share * FINE).astype(np.int64))])
        starts, ends = offset[self.bounds[:-1]], offset[self.bounds[1:]]
        before = (line[:-1] - np.repeat(line[starts], ends - starts)) / FINE
        far = np.flatnonzero(before >= FAR)
        best, where = self._aside(leaf, far, before, share, value, since, excluded)
        # what lies further can only count if its bound is above the last one taken
        upto = np.bincount(self.texts[np.repeat(np.arange(len(leaf.count)), leaf.count)[far]], minlength=len(starts))
        if ((best[:, -1] < FAR + NOISE) & (upto < ends - starts)).any():
            best, where = self._aside(leaf, np.arange(len(share)), before, share, value, since, excluded)
        for j in range(best.shape[1]):
            for text in np.flatnonzero(~np.isneginf(best[:, j])).tolist():
                self.open[text].append((best[text, j], number, int(where[text, j] - starts[text])))
        self.leaves.append(leaf)
        self.scores.append(((line[ends] - line[starts]) / FINE, value))
        self.excluded.append(excluded)

    def _aside(self, leaf, at, before, share, value, since, excluded) -> tuple[np.ndarray, np.ndarray]:
        """The greatest values, and their places, of what a leaf leaves aside at the choices ``at``."""
        number = len(self.leaves)
        offset = leaf.offset
        starts = offset[self.bounds[:-1]]
        word = np.searchsorted(offset, at, side="right") - 1
        owner = self.texts[word]
        place = at - starts[owner]
        # the node that each chosen edge ends at
        node = np.where(at == offset[word], self.lattice.end[self.words[word]], self.lattice.start[leaf.edges[np.maximum(at - 1, 0)]])
        with np.errstate(divide="ignore"):
            aside = np.log(-np.expm1(np.minimum(share[at], 0.0)))
        aside[self.lattice.number[node] == 1] = -np.inf
        begins = np.searchsorted(owner, np.arange(len(starts) + 1))
        for text, (turn, fork, edges) in excluded.items():
            i = int(begins[text]) + int(np.searchsorted(place[begins[text] : begins[text + 1]], turn))
            if i < begins[text + 1] and place[i] == turn:
                aside[i] = self._left(fork, edges)
        aside[place < since[owner]] = -np.inf
        u = uniform(stir(self.keys, (1 << 41) + number)[owner], place)
        values = below(before[at] + aside, value[owner], u)
        best, where = _tops(values, begins[:-1], begins[1:], self.k - number)
        return best, np.where(where >= 0, at[np.maximum(where, 0)] if len(at) else where, -1)

    def _chance(self, text: int, sample: int, place: int) -> float:
        return float(uniform(stir(self.keys[text : text + 1], sample), place)[0])

    def _others(self, node: int, out: frozenset) -> list[int]:
        """The edges into a node that are not among ``out``."""
        first = int(self.lattice.first[node])
        return [e for e in range(first, first + int(self.lattice.number[node])) if e not in out]

    def _left(self, node: int, out: frozenset) -> float:
        """Log-probability of a node's other edges."""
        rest = self._others(node, out)
        return float(np.log(np.exp(self.lattice.share[rest]).sum())) if rest else -np.inf

    def _next(self, s: int) -> None:
        """Continue the open node of the greatest value of every text to its best leaf."""
        n = len(self.keys)
        fresh = draw(self.lattice, self.words, self.keys[self.texts], self.places, s)
        value, since, excluded = np.full(n, -np.inf), np.zeros(n, np.int64), {}
        parent = np.full(n, -1)
        turn = np.full(n, -1)  # the word in which a text turns off its parent
        special: list[tuple[int, list[int]]] = []
        for text, held in enumerate(self.open):
            if not held:
                continue
            best = max(range(len(held)), key=lambda i: held[i][0])
            value[text], number, place = held.pop(best)
            leaf = self.leaves[number]
            offset = self._offsets(number)
            at = int(offset[self.bounds[text]]) + place
            word = int(np.searchsorted(offset, at, side="right")) - 1
            first = at == offset[word]
            node = int(self.lattice.end[self.words[word]] if first else self.lattice.start[leaf.edges[at - 1]])
            passed = self.excluded[number].get(text)
            out = passed[2] if passed and passed[0] == place else frozenset([int(leaf.edges[at])])
            edge = self._choose(node, out, self._chance(text, (1 << 42) + s, place))
            path = leaf.edges[int(offset[word]) : at].tolist() + [edge]
            path += self._finish(word, edge, text, s)
            parent[text], turn[text], since[text] = number, word, place
            excluded[text] = (place, node, out | {edge})
            special.append((word, path))
        if not special:
            self.leaves.append(Leaf(np.zeros(0, np.int64), np.zeros(len(self.words), np.int64)))
            self.scores.append((np.full(n, -np.inf), value))
            self.excluded.append({})
            return
        count = np.where((parent >= 0)[self.texts], fresh.count, 0)
        source = np.full(len(self.words), -1)
        index = np.arange(len(self.words))
        for number in range(s):
            old = (parent[self.texts] == number) & (index < turn[self.texts])
            count[old], source[old] = self.leaves[number].count[old], number
        for word, path in special:
            count[word], source[word] = len(path), -2
        offset = np.cumsum(count) - count
        edges = np.empty(int(count.sum()), np.int64)
        for number, leaf in [(-1, fresh), *enumerate(self.leaves)]:
            mine = np.flatnonzero((source == number) & (count > 0))
            if len(mine):
                step = np.arange(int(count[mine].sum())) - np.repeat(np.cumsum(count[mine]) - count[mine], count[mine])
                edges[np.repeat(offset[mine], count[mine]) + step] = leaf.edges[np.repeat(leaf.offset[:-1][mine], count[mine]) + step]
        for word, path in special:
            edges[offset[word] : offset[word] + len(path)] = path
        self._add(Leaf(edges, count), value, since, excluded)
        gone = np.flatnonzero(parent < 0)
        self.scores[-1][0][gone] = -np.inf

    def _offsets(self, number: int) -> np.ndarray:
        if not hasattr(self, "_held"):
            self._held: dict[int, np.ndarray] = {}
        if number not in self._held:
            self._held[number] = self.leaves[number].offset
        return self._held[number]

    def _choose(self, node: int, out: frozenset, x: float) -> int:
        rest = self._others(node, out)
        mass = np.exp(self.lattice.share[rest])
        return rest[min(int(np.searchsorted(np.cumsum(mass), x * mass.sum(), side="right")), len(rest) - 1)]

    def _finish(self, word: int, edge: int, text: int, s: int) -> list[int]:
        """The rest of a word once an edge of it has been chosen."""
        lattice, path, step = self.lattice, [], 0
        node, begin = int(lattice.start[edge]), int(lattice.begin[self.words[word]])
        while node != begin:
            x = self._chance(text, (1 << 43) + s, step)
            edge = int(lattice.first[node])
            last = edge + int(lattice.number[node]) - 1
            while x > lattice.upto[edge] and edge < last:
                edge += 1
            path.append(edge)
            node, step = int(lattice.start[edge]), step + 1
        return path

    def ids(self, leaf: Leaf, byte_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The piece ids of all texts in reading order, and how many each text has."""
        width = self.lattice.width[leaf.edges].astype(np.int64)
        word = np.repeat(np.arange(len(self.words)), leaf.count)
        size = np.bincount(word, width, len(self.words)).astype(np.int64)
        # edges were chosen from the end of a word to its beginning
        upto = np.cumsum(width)
        begin = np.concatenate([[0], upto])[leaf.offset[:-1]]
        at = (np.cumsum(size) - size)[word] + size[word] - (upto - begin[word])
        ids = self.lattice.id[leaf.edges].astype(np.int64)
        out = np.empty(int(width.sum()), np.int32)
        plain = ids >= 0
        out[at[plain]] = ids[plain]
        points, where, bytes_of = -1 - ids[~plain], at[~plain], width[~plain]
        for n, lead in ((1, 0x00), (2, 0xC0), (3, 0xE0), (4, 0xF0)):
            some = np.flatnonzero(bytes_of == n)
            for k in range(n):
                bits = points[some] >> (6 * (n - 1 - k))
                byte = (bits | lead) if k == 0 else ((bits & 0x3F) | 0x80)
                out[where[some] + k] = byte_ids[byte]
        ends = np.concatenate([[0], np.cumsum(size)])
        return out, ends[self.bounds[1:]] - ends[self.bounds[:-1]]


SAMPLE = "sample int, ids array<int>, log_prob double, gumbel double, inclusion double, decoded_crc32 long"


def _segment(texts: list[str], keys: np.ndarray, store: Store, k: int):
    """For each sample: text numbers, ids, number of ids, log-probabilities, Gumbel values and inclusion."""
    whole = np.frombuffer("".join(" " + t if t else "" for t in texts).encode("utf-32-le"), np.uint32)
    lengths = np.fromiter((len(t) + 1 if t else 0 for t in texts), np.int64, len(texts))
    begins = np.cumsum(lengths) - lengths
    space = whole == 32
    first = space.copy()
    first[1:] &= ~space[:-1]
    first[begins[lengths > 0]] = True
    starts = np.flatnonzero(first)
    ends = np.append(starts[1:], len(whole))
    owner = np.searchsorted(begins[lengths > 0], starts, side="right") - 1
    owner = np.flatnonzero(lengths > 0)[owner] if len(starts) else owner
    sums, inverse = prefix_hashes(whole)
    hashes = span_hashes(sums, inverse, starts, ends)
    order = np.argsort(hashes)
    fresh = np.diff(hashes[order], prepend=hashes[order[:1]] ^ np.uint64(1)) != 0
    index = order[fresh]
    words = np.empty(len(order), np.int64)
    words[order] = np.cumsum(fresh) - 1
    words = store.words(hashes[index], whole, starts[index], ends[index])[words]
    if store.lattice is None:
        store.lattice = build(whole, starts, ends, store.vocabulary)
    search = Search(store.lattice, words, owner, len(texts), keys, k)
    leaves, probability, value, stop = search.run()
    for s, leaf in enumerate(leaves):
        ids, count = search.ids(leaf, store.vocabulary.byte_ids)
        chosen = np.flatnonzero(~np.isneginf(value[s])) if s else np.arange(len(texts))
        inclusion = np.ones(len(texts))
        ended = ~np.isneginf(stop)
        inclusion[ended] = -np.expm1(-np.exp(probability[s][ended] - stop[ended]))
        yield chosen, ids, count, probability[s], value[s], inclusion


def sample_segmentations(
    docs: DataFrame, model: str, samples: int = SAMPLES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, sample, ids, log_prob, gumbel, inclusion, decoded_crc32: up to ``samples`` rows for each row.

    The samples of a text are distinct, in order of falling Gumbel value. ``inclusion`` is the
    probability of being among them, given where the search stopped; 1 if the text has no more
    segmentations. ``decoded_crc32`` is that of the text decoded from the ids, in UTF-8. NULL and empty
    texts have one segmentation without pieces. The id seeds the choice, so rows of the same id and text are alike;
    a NULL id seeds like 0. ``model`` is a file that the driver reads. Other columns are not read.
    """
    if samples < 1:
        raise ValueError("ask for at least one sample")
    with open(model, "rb") as f:
        proto = docs.sparkSession.sparkContext.broadcast(f.read())
    id_type = docs.select(named(id_col)).schema[0].dataType.simpleString()
    seed = F.coalesce(F.xxhash64(named(id_col)), F.lit(0))
    rows = docs.select(named(id_col).alias("id"), seed.alias("key"), F.coalesce(named(text_col).cast("string"), F.lit("")).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = worker_state("segment_store", lambda: Store(Vocabulary(proto.value)))
        vocabulary = store.vocabulary
        for batch in batches:
            lengths = pc.utf8_length(batch.column(2)).to_pylist()
            keys = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            a = 0
            while a < len(lengths):
                b, size = a + 1, lengths[a]
                while b < len(lengths) and size + lengths[b] <= CHUNK_CHARS:
                    size, b = size + lengths[b], b + 1
                texts = batch.column(2).slice(a, b - a).to_pylist()
                part = batch.column(0).slice(a, b - a)
                for s, (chosen, ids, count, probability, value, inclusion) in enumerate(
                    _segment(texts, mix(keys[a:b] ^ np.uint64(SEED)), store, samples)
                ):
                    size = count[chosen]  # texts without this sample have no ids
                    sums = [zlib.crc32(t) for t in vocabulary.decode(ids, size)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.take(pa.array(chosen)),
                            pa.array(np.full(len(chosen), s, np.int32)),
                            pa.ListArray.from_arrays(
                                pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(ids)
                            ),
                            pa.array(probability[chosen]),
                            pa.array(value[chosen]),
                            pa.array(inclusion[chosen]),
                            pa.array(np.array(sums, np.int64)),
                        ],
                        names=["id", "sample", "ids", "log_prob", "gumbel", "inclusion", "decoded_crc32"],
                    )
                a = b

    return rows.mapInArrow(run, f"id {id_type}, {SAMPLE}").withColumnRenamed("id", id_col)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")
