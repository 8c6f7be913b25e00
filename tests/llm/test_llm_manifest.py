"""The Merkle manifest against a tree built in plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from evenhand.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = (*row[:4], text)
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def path(levels, i):
    for nodes in levels[:-1]:
        first = i // 3 * 3
        yield i - first, [n for j, n in enumerate(nodes[first : first + 3]) if j != i - first]
        i //= 3


def expected(rows):
    sources = defaultdict(list)
    for row in rows:
        sources[row[1]].append(row)
    for of in sources.values():
        of.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([leaf(r, r[4]) for r in sources[s]]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    for n, s in enumerate(names):
        for i, row in enumerate(sources[s]):
            proof = [*path(trees[s], i), *path(top, n)]
            even = zlib.crc32(("" if row[0] is None else str(row[0])).encode()) % 2 == 0
            led = leaf(row, row[4].replace("\n", "") if even and row[4] is not None else row[4])
            for place, others in proof:
                led = digest(*others[:place], led, *others[place:])
            siblings = digest(*[d for _, others in proof for d in others])
            yield row[0], leaf(row, row[4]), trees[s][-1][0], top[-1][0], siblings, led, led == top[-1][0]


def same(spark, rows):
    found = merkle.document_manifest(spark.createDataFrame(rows, SCHEMA)).collect()
    return sorted(map(tuple, found), key=repr) == sorted(expected(rows), key=repr)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28, 80, 243, 728, 729])
def test_block_of_any_size(n):
    leaves = [digest(str(i)) for i in range(n)]
    block = merkle.OpenBlock()
    for i, d in enumerate(leaves):
        block.append(bytes.fromhex(d))
    root = block.close(alone=n < merkle.BLOCK)
    assert root.hex() == tree(leaves)[-1][0]
    assert all(merkle.folded(bytes.fromhex(d), bytes(w)) == root for d, w in zip(leaves, block.witnesses, strict=True))


def test_rows_of_all_kinds(spark):
    rng = random.Random(5)
    rows = [
        (None, None, None, None, None),
        (None, None, None, None, None),
        (7, "é", "de", 3, "a\nb"),
        (7, "é", "de", 3, "a\nb"),
        (7, "é", "de", 3, ""),
        (0, "", "", 0, ""),
        (-4, "z", None, 9, "x\n" * 300_000),
        *[(i, rng.choice(["a", "B", "a\n", "𝄞", "￿"]), "en", i, f"t\n{i}") for i in range(100)],
    ]
    assert same(spark, rows)


@pytest.mark.parametrize("n", [1, 728, 729, 730, 1500])
def test_sources_over_a_block(spark, n):
    assert same(spark, [(i, "hot", "en", i, f"t\n{i}") for i in range(n)] + [(n, "other", "en", 0, "")])


def test_many_sources(spark):
    assert same(spark, [(i, f"s{i}", "en", i, "\n") for i in range(800)])


def test_no_rows_and_other_columns(spark):
    assert merkle.document_manifest(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, "a", "en", 2, "x", 5, "k"), (2, "a", "en", 2, "y", 5, "k")]
    wide = spark.createDataFrame(rows, SCHEMA + ", pos int, key string").withColumnRenamed("key", "root")
    found = merkle.document_manifest(wide).collect()
    assert sorted(map(tuple, found)) == sorted(expected([r[:5] for r in rows]))
