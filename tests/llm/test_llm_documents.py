"""Operators on documents: brute force on a small table of awkward texts, and the edge cases."""

import hashlib
import math
import os
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from evenhand.llm import digest_runs, jump_shards, mixing, near_dups, pii, repeated_bytes, rule_ledger
from evenhand.llm import segment_sampling, token_files
from evenhand.llm.tables import recorded

SCHEMA = "doc_id long, text string, lang string, source string, kept boolean, rid string, size long, row string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    base, long = prose(1, 120), prose(2, 3000)
    near = base.split()
    near[60] = "other"
    passage = prose(3, 90)
    found = [
        base, base, base.replace(" ", "\n", 3), " ".join(near), None, "", " \t ", "one", "one two three", "a b c d e",
        long, long + " end", prose(4, 30) + " " + passage, passage + " " + prose(5, 40), "é ü 𝄞 " * 60, "aaaa" * 300,
        "aaaa" * 300, "x y z " * 40, "# * $ | < > " * 20, "THE END!! " * 60, "line one here\nline one here\n" * 30,
        "mail a.b@c.example.com%d@e.f.org or 10.0.0.255 and 256.1.1.1", "4111 1111 1111 1111 and 4111-1111-1111-1112",
        "call +1 (555) 555-0100 or +44 1", "1.2.3.4.5.6.7.8 00000255.1.1.1", "double  space \n text ▁ <|endoftext|> ",
    ]
    return [(i, t) for i, t in enumerate(found)] + [(3, " ".join(near)), (None, base), (None, None), (7, "one")]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", None if k % 4 == 0 else f"s{k % 3}", True, "r", 5, "w") for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by(rows, *cols):
    return sorted((tuple(r[c] for c in cols) for r in rows), key=lambda t: tuple((x is None, str(type(x)), x or 0) for x in t))


def flat(rows):
    return sorted(rows, key=lambda t: tuple((x is None, str(type(x)), x or 0) for x in t))


# --- personal data ---------------------------------------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits)))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def plain_spans(text):
    found = [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if passes(k, m[0])]
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def test_pii_base_is_the_plain_formats(docs, texts, empty):
    found = pii.find_pii(docs).select("doc_id", pii.spelled(F.col("base")).alias("base")).collect()
    assert by(found, "doc_id", "base") == flat([(i, plain_spans(t)) for i, t in texts])
    assert pii.find_pii(empty).count() == 0


def test_pii_trees_add_what_looks_like_the_base(spark):
    r = random.Random(5)
    number = lambda: f"({r.randint(200, 999)}) 555-{r.randint(1000, 9999)}"
    rows = [(i, f"{prose(i, 12)} +1 {number()} {prose(i + 1, 9)}") for i in range(300)]
    rows += [(1000 + i, f"{prose(i, 8)} {r.randint(256, 999)}.1.1.1 +12 3 {prose(i, 5)}") for i in range(300)]
    rows += [(5000, f"{prose(9, 12)} {number()} {prose(8, 9)}"), (5001, "nothing here")]
    got = {x["doc_id"]: x for x in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == len(rows)
    assert all(set(x["base"]) <= set(x["spans"]) for x in got.values())
    assert [s["kind"] for s in got[5000]["spans"]] == ["phone"] and got[5000]["base"] == []
    assert got[5001]["spans"] == [] and not any(got[1000 + i]["spans"] for i in range(300))


def test_pii_trees_add_other_spellings(spark):
    r = random.Random(6)

    def card(odd, sep=""):
        digits = [4] + [r.randrange(10) for _ in range(14)]
        total = sum(d if i % 2 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits))
        digits.append((-total + odd) % 10)
        return sep.join("".join(map(str, digits[i : i + 4])) for i in range(0, 16, 4))

    rows = []
    for i in range(200):
        ip = ".".join(str(r.randrange(256)) for _ in range(4))
        rows.append((i, f"{prose(i, 9)} write to ann{i}@mail{i % 9}.example.org or {prose(i + 1, 6)} paid by visa {card(0)} {prose(i, 5)}"))
        rows.append((1000 + i, f"{prose(i, 9)} the server {ip} and {prose(i, 7)} order number {card(3)} {prose(i + 2, 5)}"))
        rows.append((2000 + i, f"{prose(i, 7)} version 3.{r.randrange(300, 900)}.1.{i} by git@host{i % 7} or @nick{i} {prose(i, 9)}"))
    rows += [
        (5000, f"{prose(3, 9)} write to bob (at) mail (dot) example (dot) org, {prose(4, 6)}"),
        (5001, f"{prose(3, 9)} contact Eve.K [AT] example.com {prose(5, 6)}"),
        (5002, f"{prose(6, 9)} paid by visa {card(0, '.')} {prose(8, 5)}"),
        (5003, f"{prose(7, 9)} the server 192[.]168[.]20[.]7 and {prose(9, 7)}"),
        (5004, f"{prose(3, 9)} write to root@host7 {prose(4, 6)} order number {card(3, '.')} and 192[.]168[.]20[.]700 {prose(5, 5)}"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = dict(rows)
    found = pii.find_pii(docs).collect()
    got = {x["doc_id"]: [(s["kind"], texts[x["doc_id"]][s["start"] : s["end"]]) for s in x["spans"]] for x in found}
    assert all(set(x["base"]) <= set(x["spans"]) for x in found) and not any(x["base"] for x in found if x["doc_id"] >= 5000)
    assert got[5000] == [("email", "bob (at) mail (dot) example (dot) org")]
    assert got[5001] == [("email", "Eve.K [AT] example.com")]
    assert [kind for kind, _ in got[5002]] == ["card"] and got[5003] == [("ip", "192[.]168[.]20[.]7")]
    assert got[5004] == [] and not any(got[2000 + i] for i in range(200))
    sizes = {x["doc_id"]: len(x["spans"]) for x in found}
    assert all(sizes[i] == 2 and sizes[1000 + i] == 1 for i in range(200))


def test_pii_trees_learn_from_all_labelled_spans(spark):
    rows = [(i, " ".join(f"{a} {i % 200}.{i // 200}.7.{a}" for a in range(100))) for i in range(400)]
    rows += [(1000 + i, f"order 900.{i}.7.1") for i in range(100)]
    found = pii.candidates(spark.createDataFrame(rows, "doc_id long, text string"))
    spans = found.filter("generator is not null and kind = 'ip'").cache()
    counts = {}
    for r in pii.labelled(spans, pii.Training()).collect():
        counts[r["label"]] = counts.get(r["label"], 0) + r["weight"]
    assert counts == {1.0: 40_000, 0.0: 100}
    assert all(set(r) <= {0.0, 1.0} for r in pii._measured(spans).select(*pii._features().values()).distinct().collect())


def test_pii_redaction_replaces_spans(spark):
    docs = spark.createDataFrame([(1, "to a@b.org, +1 (555) 555-0100."), (2, None), (3, "none")], "doc_id long, text string")
    assert by(pii.redact(docs).collect(), "doc_id", "text") == [(1, "to [email], [phone]."), (2, None), (3, "none")]


# --- quality rules ---------------------------------------------------------------------------------


def measures(text):
    w = words(text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = Counter(grams)
    again = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(again)


def test_ledger_measures(docs, texts, empty):
    cols = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert by(rule_ledger.rule_ledger(docs).collect(), *cols) == flat([(i, *measures(t)) for i, t in texts])
    assert rule_ledger.rule_ledger(empty).count() == 0


def test_policies_and_ablations_are_bit_arithmetic(docs):
    ledger = rule_ledger.rule_ledger(docs)
    bits = [r["failures"] for r in ledger.collect()]
    mask = rule_ledger.CURRENT.mask
    got = {r["rule"]: (r["failed"], r["kept_without"]) for r in rule_ledger.ablations(ledger).collect()}
    assert got == {
        rule: (sum(bool(x & bit) for x in bits), sum(x & mask == bit for x in bits)) for rule, bit in rule_ledger.BITS.items()
    }
    kept = rule_ledger.apply_policy(docs)
    assert kept.schema == docs.schema and kept.count() == sum(x & mask == 0 for x in bits)


# --- exact duplicates ------------------------------------------------------------------------------


def test_exact_groups(docs, texts, empty):
    groups = defaultdict(list)
    for i, t in texts:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    expected, stay = [], []
    for text, ids in groups.items():
        least = min((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        expected += [(i, least, len(ids), digest) for i in ids]
        stay.append(least)
    got = digest_runs.duplicate_groups(docs).collect()
    assert by(got, "doc_id", "keep_id", "group_size", "text_sha256") == flat(expected)
    assert flat([(r["doc_id"],) for r in got if r["kept"]]) == flat([(i,) for i in stay])
    dropped = digest_runs.drop_duplicates(docs)
    assert dropped.schema == docs.schema and by(dropped.collect(), "doc_id") == flat([(i,) for i in stay])
    assert digest_runs.duplicate_groups(empty).count() == 0 and digest_runs.drop_duplicates(empty).count() == 0


def test_runs_are_sorted_and_merged_in_rounds(spark):
    r = random.Random(4)
    rows = [(r.randrange(5000), "hot" if i % 3 == 0 else f"t {r.randrange(40)}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(70)
    level = digest_runs.digests(docs.withColumn("r", F.monotonically_increasing_id()), "doc_id", "text", "r")
    runs = digest_runs.first_runs(level)
    sizes = []
    for left in (70, 9, 2, 1):
        assert runs.agg(F.max("run")).first()[0] == left - 1
        entries = runs.withColumn("p", F.spark_partition_id()).collect()
        for p in {e["p"] for e in entries}:
            own = [(e["run"], e["digest"]) for e in entries if e["p"] == p]
            assert own == sorted(set(own))
        assert sum(e["n"] for e in entries) == len(rows)
        sizes.append(len(entries))
        runs = digest_runs.merge_round(runs)
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] == len({t for _, t in rows})
    plan = digest_runs.merge_round(runs)._jdf.queryExecution().executedPlan().toString()
    merging = plan[: plan.index("rangepartitioning")]
    assert "hashpartitioning" not in merging and merging.count("Sort [") == 1
    groups = defaultdict(list)
    for i, t in rows:
        groups[t].append(i)
    got = digest_runs.duplicate_groups(docs).collect()
    assert by(got, "doc_id", "keep_id", "group_size") == flat([(i, min(groups[t]), len(groups[t])) for i, t in rows])
    assert sum(x["kept"] for x in got) == len(groups)


# --- near duplicates -------------------------------------------------------------------------------


def weighted_classes(texts):
    bags = []
    for _, t in texts:
        w = words(t)
        bags.append(Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter())
    n, df = len(texts), Counter(s for b in bags for s in b)
    idf = {s: 0.8 + 0.2 * min(1, math.log(n / c) / math.log(1024)) for s, c in df.items() if c >= n / 1024}
    weights = [{s: c * idf.get(s, 1.0) for s, c in b.items()} for b in bags]
    part = list(range(n))

    def top(i):
        while part[i] != i:
            i = part[i]
        return i

    for i in range(n):
        for j in range(i):
            both = sum(min(x, weights[j].get(s, 0)) for s, x in weights[i].items())
            most = sum(weights[i].values()) + sum(weights[j].values()) - both
            if both >= 0.8 * most - 1e-9:
                part[max(top(i), top(j))] = min(top(i), top(j))
    return [top(i) for i in range(n)]


def test_near_classes(docs, texts, empty):
    groups = defaultdict(list)
    for (i, _), part in zip(texts, weighted_classes(texts), strict=True):
        groups[part].append(i)
    expected = [(i, min((x for x in ids if x is not None), default=None), len(ids)) for ids in groups.values() for i in ids]
    got = near_dups.duplicate_classes(docs).collect()
    assert by(got, "doc_id", "class_id", "class_size") == flat(expected)
    assert sum(r["kept"] for r in got) == len(groups)
    dropped = near_dups.drop_near_duplicates(docs)
    assert dropped.schema == docs.schema and dropped.count() == len(groups)
    assert near_dups.duplicate_classes(empty).count() == 0


def test_near_copies_of_a_large_group_are_one_class(spark):
    base = prose(11, 200).split()
    rows = []
    for i in range(400):
        copy = list(base)
        copy[(i * 7) % 200] = f"w{i}"
        rows.append((i, " ".join(copy)))
    rows += [(1000 + i, prose(100 + i, 150)) for i in range(50)]
    got = {r["doc_id"]: r["class_id"] for r in near_dups.duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {got[i] for i in range(400)} == {0} and all(got[1000 + i] == 1000 + i for i in range(50))


def packed(samples):
    return [sum((v & 15) << 4 * j for j, v in enumerate(samples[h : h + 15])) for h in (0, 15)]


@pytest.mark.parametrize("band", [0, 4, 9])
def test_pairs_that_share_only_a_full_band_are_compared(spark, band, monkeypatch):
    monkeypatch.setattr(near_dups, "FULL_BAND", 256)
    r = random.Random(band)
    drawn = [[r.randrange(16) for _ in range(30)] for _ in range(2 * near_dups.FULL_BAND)]
    for k in range(0, len(drawn), 2):  # two neighbours agree in 14 samples outside the band, and in no other band
        x, y = drawn[k], drawn[k + 1]
        others = [b for b in range(10) if b != band]
        places = [3 * b + j for b in others for j in r.sample(range(3), 2)]
        same = set(r.sample(places, 14))
        for j in range(30):
            y[j] = x[j] if j in same else (x[j] + r.randrange(1, 16)) % 16
    for s in drawn:
        s[3 * band : 3 * band + 3] = 1, 2, 3
    rows = [(i, 1.0, [hash((b, *s[3 * b : 3 * b + 3])) for b in range(10)], *packed(s)) for i, s in enumerate(drawn)]
    node = spark.createDataFrame(rows, "node long, weight double, bands array<long>, low long, high long")
    shared = near_dups.buckets(node).filter("step is not null").withColumn("part", F.col("node")).withColumn("blocks", F.lit(1))
    left = shared.join(node.select("node", "weight", "bands"), "node").withColumn("fine", F.array_repeat(F.lit(-1).cast("long"), 8))
    found = near_dups.agreeing(left, 438, 513, 0.8).collect()
    wanted = {(i, j) for i in range(len(drawn)) for j in range(i) if sum(map(int.__eq__, drawn[i], drawn[j])) >= 17}
    assert len(found) == len(wanted) and {(r["b"], r["a"]) for r in found} == wanted and len(wanted) >= near_dups.FULL_BAND


def test_dividing_full_bands_loses_no_link(spark, monkeypatch):
    rows = []
    for k in range(500):  # pairs at a similarity of 0.80 to 0.83
        base = prose(1000 + k, 200).split()
        rows.append((2 * k, " ".join(base)))
        for j in range(4):
            base[20 + 40 * j + k % 7] = "other"
        rows.append((2 * k + 1, " ".join(base)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    whole = by(near_dups.duplicate_classes(table).collect(), "doc_id", "class_id")
    monkeypatch.setattr(near_dups, "FULL_BAND", 1)
    assert by(near_dups.duplicate_classes(table).collect(), "doc_id", "class_id") == whole
    assert sum(i != c for i, c in whole) > 485


def test_frequent_shingles_past_the_broadcast_keep_their_weight(docs, texts, spark, monkeypatch):
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), "text")
    (hashes, weights, other), rest = near_dups.frequent_shingles(rows)
    counts = Counter(s for _, t in texts for s in {tuple(w[i : i + 5]) for w in [words(t)] if w for i in range(max(1, len(w) - 4))})
    assert rest is None and len(hashes) == sum(c > 1 for c in counts.values())
    assert other == pytest.approx(0.8 + 0.2 * math.log(len(texts)) / math.log(1024))
    text = rows.select("rid", F.coalesce("text", F.lit("")).alias("t"))
    whole = by(near_dups.sketches(text, spark.sparkContext.broadcast((hashes, weights, other))).collect(), "words", "weight")
    monkeypatch.setattr(near_dups, "FREQUENT", 5)
    head, rest = near_dups.frequent_shingles(rows)
    assert len(head[0]) == 5 and rest.count() == len(hashes) - 5
    text = near_dups.listed_weights(text, rest)
    listed = by(near_dups.sketches(text, spark.sparkContext.broadcast(head)).collect(), "words", "weight")
    assert [w for w, _ in listed] == [w for w, _ in whole]
    assert [x for _, x in listed] == pytest.approx([x for _, x in whole], rel=1e-12)


def test_first_count_of_few_texts_is_not_one_task(spark):
    rows = spark.range(100).select(F.lit("a b c d e f").alias("text")).repartition(40)
    cores = spark.sparkContext.defaultParallelism
    assert near_dups.in_blocks(rows, 100, 1100).rdd.getNumPartitions() == cores
    assert near_dups.in_blocks(rows, 100, 30 << 27).rdd.getNumPartitions() == 30  # long texts


def test_open_buckets_are_compared_block_by_block(spark, monkeypatch):
    monkeypatch.setattr(near_dups, "BLOCK_NODES", 16)
    rows = [(7, i, i % 5, 0, 0, -1, 1.0, [0] * 10, [i % 5 - 2] * 8) for i in range(200)]
    columns = "bucket long, node long, low long, high long, band int, step int, weight double, bands array<long>, fine array<long>"
    shared = spark.createDataFrame(rows, columns)
    left = near_dups.still_open(shared, spark.createDataFrame([(0, 1)], "a long, b long"))
    for side in near_dups.cells(left):
        assert max(r["count"] for r in side.groupBy("bucket", "i", "j").count().collect()) < 40
    found = near_dups.agreeing(left, 512, 513, 0.8).collect()
    wanted = {(i, j) for j in range(200) for i in range(j) if (j - i) % 5 == 0}
    assert len(found) == len(wanted) and {(r["a"], r["b"]) for r in found} == wanted


@pytest.mark.parametrize("nodes", [2048, 40])
def test_cells_give_out_few_links_that_join_what_all_pairs_join(spark, monkeypatch, nodes):
    monkeypatch.setattr(near_dups, "BLOCK_NODES", nodes)
    rows = []
    for k in range(4):
        base = prose(500 + k, 200).split()
        for i in range(50):  # many copies of a text, similar to some of the others only
            copy = list(base)
            for j in range(i % 5 + 1):
                copy[(i * 7 + j * 37) % 200] = f"w{i % 25}"
            rows.append((100 * k + i, " ".join(copy)))
    text = spark.createDataFrame(rows, "rid long, t string")
    none = near_dups.np.zeros(0)
    head = spark.sparkContext.broadcast((none.astype("uint64"), none, 1.0))
    sketch = near_dups.sketches(text, head).withColumnRenamed("rid", "node").cache()
    shared = near_dups.buckets(sketch).filter("step is not null")
    drawn = sketch.select("node", "weight", "bands").join(near_dups.fine_samples(text, head).withColumnRenamed("rid", "node"), "node")
    left = near_dups.still_open(shared, spark.createDataFrame([(0, 0)], "a long, b long")).join(drawn, "node").cache()
    pairs = near_dups.verified(near_dups.agreeing(left, near_dups.AGREE_FINE[-1], 513, 0.8), text, head, 0.8).cache()
    links = near_dups.joining(left.join(text.withColumnRenamed("rid", "node"), "node"), head, 0.8).cache()
    parts = [by(near_dups.components(x).collect(), "id", "component") for x in (pairs, links)]
    assert parts[0] == parts[1] and 4 < len({c for _, c in parts[0]}) + 200 - len(parts[0]) < 200
    assert links.join(pairs, ["a", "b"], "left_anti").isEmpty()
    assert links.count() < left.count() and (nodes < 200 or links.count() < pairs.count())


def test_further_samples_agree_as_often_as_texts_are_similar(spark):
    rows, similar = [], {}
    for k in range(120):  # three copies with words exchanged at equal distances
        base = prose(3000 + k, 200).split()
        for m, changed in enumerate((0, 4, 14)):
            copy = list(base)
            for j in range(changed):
                copy[5 + j * (190 // max(changed, 1))] = f"x{k}"
            rows.append((3 * k + m, " ".join(copy)))
    grams = {i: {tuple(t.split()[j : j + 5]) for j in range(196)} for i, t in rows}
    text = spark.createDataFrame(rows, "rid long, t string")
    none = near_dups.np.zeros(0)
    head = spark.sparkContext.broadcast((none.astype("uint64"), none, 1.0))
    fine = near_dups.fine_samples(text, head)
    drawn = {r["rid"]: [x >> j & 1 for x in r["fine"] for j in range(64)] for r in fine.collect()}
    x, y = fine.alias("x"), fine.alias("y")
    pairs = x.join(y, F.expr("x.rid div 3 = y.rid div 3 and x.rid < y.rid"))
    for r in pairs.select(F.col("x.rid").alias("a"), F.col("y.rid").alias("b"), near_dups.fine_agreement("x", "y").alias("n")).collect():
        a, b = r["a"], r["b"]
        assert r["n"] == sum(map(int.__eq__, drawn[a], drawn[b]))
        j = len(grams[a] & grams[b]) / len(grams[a] | grams[b])
        assert abs(r["n"] - 512 * (1 + j) / 2) < 56
        similar[a, b] = j, r["n"]
    assert all(n >= near_dups.AGREE_FINE[-1] for j, n in similar.values() if j >= 0.8)
    assert all(n < near_dups.AGREE_FINE[-1] for j, n in similar.values() if j <= 0.6) and min(similar.values())[0] < 0.6


def test_classes_of_the_whole_table_against_all_pairs(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    texts, wanted = [(r["doc_id"], r["text"]) for r in rows], defaultdict(set)
    bags = [Counter(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else Counter() for w in (words(t) for _, t in texts)]
    holders = defaultdict(list)
    for i, b in enumerate(bags):
        for s in b:
            holders[s].append(i)
    n = len(texts)
    weight = {s: 0.8 + 0.2 * min(1, math.log(n / len(h)) / math.log(1024)) for s, h in holders.items()}
    rare = 0.8 + 0.2 * min(1, math.log(n) / math.log(1024))
    weight = {s: w if len(holders[s]) >= max(n / 1024, 2) else rare for s, w in weight.items()}
    total = [sum(c * weight[s] for s, c in b.items()) for b in bags]
    part = list(range(n))

    def top(i):
        while part[i] != i:
            i = part[i]
        return i

    blank = [i for i, b in enumerate(bags) if not b]
    for i in blank:
        part[top(i)] = top(blank[0])
    for i, b in enumerate(bags):
        both = Counter()
        for s, c in b.items():
            for j in holders[s]:
                if j < i:
                    both[j] += min(c, bags[j][s]) * weight[s]
        for j, least in both.items():
            if least >= 0.8 * (total[i] + total[j] - least) - 1e-9:
                part[max(top(i), top(j))] = min(top(i), top(j))
    for i, (doc, _) in enumerate(texts):
        wanted[top(i)].add(doc)
    got = defaultdict(set)
    for r in near_dups.duplicate_classes(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect():
        got[r["class_id"]].add(r["doc_id"])
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, wanted.values()))


def test_counted_keeps_what_is_there_often_enough():
    r = random.Random(5)
    for size, least in [(0, 1), (1, 1), (1, 2), (50, 1), (50, 3), (300, 4)]:
        found = [r.randrange(20) for _ in range(size)]
        hashes, number = near_dups.counted(near_dups.np.array(found, "uint64"), least)
        assert dict(zip(hashes.tolist(), number.tolist(), strict=True)) == {k: n for k, n in Counter(found).items() if n >= least}


# --- shards ----------------------------------------------------------------------------------------


def jump_hash(key, shards):
    key, b, j = key % 2**64, -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2**31 / ((key >> 33) + 1)))
    return b


def test_shards(docs, texts, empty):
    got = jump_shards.assign_shards(docs, 5).collect()
    expected = [
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()), jump_hash(i or 0, 5), jump_hash(i or 0, 6))
        for i, t in texts
    ]
    assert by(got, "doc_id", "size", "text_crc32", "shard", "grown_shard") == flat(expected)
    for shard in {r["shard"] for r in got}:
        rows = sorted((r for r in got if r["shard"] == shard), key=lambda r: r["slot"])
        assert [r["slot"] for r in rows] == list(range(len(rows)))
        ids = [r["doc_id"] for r in rows if r["doc_id"] is not None]
        assert ids == sorted(ids)
    assert all(r["grown_shard"] in (r["shard"], 5) for r in got)
    assert jump_shards.assign_shards(empty, 5).count() == 0
    with pytest.raises(ValueError):
        jump_shards.jump_column(F.lit(1), 0)


# --- repeated bytes --------------------------------------------------------------------------------


def without_repeats(rows, length=400):
    rows = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(t[p : p + length] for _, t in rows for p in range(len(t) - length + 1))
    out = []
    for i, t in rows:
        gone = [False] * len(t)
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                gone[p : p + length] = [True] * length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(x for x, g in zip(t, gone, strict=True) if not g)
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return flat(out)


def test_repeated_bytes(docs, texts, empty):
    got = repeated_bytes.remove_repeats(docs).collect()
    assert by(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == without_repeats(texts)
    assert repeated_bytes.remove_repeats(empty).count() == 0


def test_repeats_that_barely_reach_the_length(spark):
    r = random.Random(7)
    letters = lambda n: "".join(r.choice("abcdé ") for _ in range(n))
    passages, rows = [letters(n) for n in (399, 400, 401, 450, 700)], []
    for i in range(30):
        p = passages[i % 5]
        rows.append((i, letters(r.randint(0, 300)) + p[r.randint(0, 3) :] + letters(r.randint(0, 300)) + (p if i % 7 == 0 else "")))
    rows.append((99, "ab" * 250 + letters(50) + "ab" * 199))
    got = repeated_bytes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert by(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == without_repeats(rows)


def test_repeats_are_narrowed_down_and_tables_dropped(spark):
    r = random.Random(11)
    letters = lambda n: "".join(r.choice("abcdé ") for _ in range(n))
    passages, rows = [letters(1500) for _ in range(3)] + ["abc" * 400], []
    for i in range(40):
        p, a, n = passages[i % 4], r.randint(0, 500), r.randint(390, 900)
        rows.append((i, letters(r.randint(0, 200)) + p[a : a + n] + letters(r.randint(0, 200))))
    rows += [(40, rows[3][1]), (41, None), (42, "")]
    docs, paths = spark.createDataFrame(rows, "doc_id long, text string"), []
    with recorded(paths):
        got = repeated_bytes.remove_repeats(docs).collect()
    assert by(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == without_repeats(rows)
    kept = {re.search(r"evenhand-(\w+)-", p)[1]: p for p in paths if os.path.exists(p.removeprefix("file:"))}
    assert not kept.keys() & {"texts", "ranks"}
    windows = spark.read.parquet(kept["runs"]).agg({"number": "sum"}).first()[0]
    assert 0 < spark.read.parquet(kept["windows"]).count() < windows / 2


# --- mixing ----------------------------------------------------------------------------------------


def wanted(sizes):
    keys = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {k: (5, 2, 1)[i % 3] for i, k in enumerate(keys)}
    goal, full = 1.5 * sum(sizes.values()), set()
    while True:
        left = goal - sum(2 * sizes[k] for k in full)
        rest = sum(weight[k] for k in keys if k not in full)
        over = {k for k in keys if k not in full and left * weight[k] / rest > 2 * sizes[k]}
        if not over:
            return {k: 2.0 * sizes[k] if k in full else left * weight[k] / rest for k in keys}
        full |= over


@pytest.mark.parametrize("lengths", [[[40]] * 3, [[40], [7, 3], [1], [300, 2], [5000]], [[1]] * 5, [[63, 65, 64]] * 2 + [[9000]]])
def test_small_sources_come_near_their_targets(spark, lengths):
    rows = [(100 * i + j, " ".join(["w"] * n), f"s{i}") for i, of in enumerate(lengths) for j, n in enumerate(of)]
    sizes = {f"s{i}": sum(of) for i, of in enumerate(lengths)}
    goal, taken = wanted(sizes), Counter()
    for x in mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect():
        assert 0 <= x["taken"] <= 2 * x["size"]
        taken[f"s{x['doc_id'] // 100}"] += x["taken"]
    for s, g in goal.items():
        block = min(64, max(1, sizes[s] // 64))
        assert abs(taken[s] - g) <= max(0.02 * g, 2 * (block + 1)), (s, taken[s], g)


def test_mix(spark, empty):
    r = random.Random(3)
    rows = [(i, prose(i, r.randint(0, 200)), r.choice(["b", "a", "a", "a", "c", None])) for i in range(150)]
    rows += [(500, None, "a"), (501, "", None), (503, "x y", "empty"), (502, "", "nothing")]
    rows.append(rows[7])
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs, block=8).collect()
    sizes, taken = Counter({s: 0 for _, _, s in rows}), Counter()
    for _, t, s in rows:
        sizes[s] += len(words(t))
    goal = wanted(sizes)
    source = {i: s for i, _, s in rows}
    for x in got:
        assert 0 <= x["taken"] <= 2 * x["size"]
        s = source[x["doc_id"]]
        taken[s] += x["taken"]
        assert x["source_size"] == sizes[s] and x["target"] == pytest.approx(goal[s])
    assert len(got) == len(rows)
    for s in ("a", "b", "c", None):
        assert abs(taken[s] - goal[s]) <= 40
        assert abs(taken[s] - goal[s]) <= max(0.02 * goal[s], 8)
    assert by(mixing.mix(docs, block=8).collect(), "doc_id", "size", "taken") == by(got, "doc_id", "size", "taken")
    assert mixing.mix(empty).count() == 0
    mixed = mixing.mixed_rows(docs, "doc_id")
    assert mixed.schema == docs.schema and max(Counter(r["doc_id"] for r in mixed.collect()).values()) <= 4


# --- token files -----------------------------------------------------------------------------------


def test_token_files_round_trip(docs, texts, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(token_files.default_vocabulary())
    encoded = lambda t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
    crc = lambda ids: zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
    got = token_files.round_trip(docs).collect()
    assert by(got, "doc_id", "n_tokens", "ids_crc32") == flat([(i, len(encoded(t)), crc(encoded(t))) for i, t in texts])
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    order = [-1 if r["doc_id"] is None else r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert order == sorted(order)
    assert token_files.round_trip(empty).count() == 0


def test_readers_take_single_documents_and_check_frames(docs, texts, tmp_path):
    manifest = token_files.write_tokens(docs, token_files.default_vocabulary(), path=str(tmp_path))
    files = [r["file"] for r in manifest.collect()]
    some = token_files.read_tokens(manifest, 10, 11).collect()
    assert sorted(r["doc_id"] for r in some) == [10, 11]
    opened = [token_files.open_file(f) for f in files]
    assert sum(len(f.find(10)) for f in opened) == 1
    name = next(f for f, o in zip(files, opened, strict=True) if o.find(10))
    path = name.removeprefix("file:")
    data = bytearray(open(path, "rb").read())
    place = token_files.open_file(name).docs["id"].tolist().index(10)
    frame = int(token_files.open_file(name).docs["frame"][place])
    data[len(data) - 9 - 12 * len(token_files.open_file(name).frames) + 12 * frame + 8] ^= 1
    open(path, "wb").write(data)
    with pytest.raises(ValueError, match="checksum"):
        token_files.open_file(name).document(place)


def test_files_follow_the_partitions_of_the_table(spark):
    table = spark.createDataFrame([(i, prose(i, 5)) for i in range(300)], "doc_id long, text string").repartition(21)
    manifest = token_files.write_tokens(table, token_files.default_vocabulary())
    assert 15 < manifest.count() <= 21
    got = sorted((r["doc_id"], r["start"], r["n_tokens"]) for r in token_files.read_tokens(manifest).collect())
    assert [i for i, _, _ in got] == list(range(300))
    assert all(a[1] + a[2] == b[1] for a, b in zip(got, got[1:], strict=False))


def test_word_encoder_gives_the_tokens_of_whole_texts(texts, monkeypatch):
    from tokenizers import Tokenizer

    definition = open(token_files.default_vocabulary()).read()
    tokenizer, r = Tokenizer.from_str(definition), random.Random(2)
    some = [t or "" for _, t in texts] + ["", " ", "a  b", "  x", " a b ", "x\n y", "x \ny", "w" * 300 + " " + "v" * 100, "é𝄞 " * 40, "a\u00a0 b"]
    some += [" ".join(r.choice(("in", "the", "é", "", "\t", "3.5", "z" * 70, prose(i, 1))) for i in range(30)) for _ in range(60)]
    wanted = [tokenizer.encode(t, add_special_tokens=False).ids for t in some]
    for kept in (1_000_000, 20):
        monkeypatch.setattr(token_files, "CACHED_WORDS", kept)
        encoder = token_files.WordEncoder(definition)
        for _ in range(2):
            got = [x for at in range(0, len(some), 7) for x in encoder.encode(some[at : at + 7])]
            assert [list(struct.unpack(f"<{len(x) // 4}I", x)) for x in got] == wanted
        assert all(len(w) <= token_files.CACHED_LENGTH for w in encoder.young)


# --- sampled segmentations -------------------------------------------------------------------------


def test_segmentations_decode_and_differ(docs, texts, empty):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=segment_sampling.default_model())
    found = segment_sampling.sample_segmentations(docs, segment_sampling.default_model(), 3).collect()
    rows = defaultdict(list)
    for r in found:
        rows[r["doc_id"], r["decoded_crc32"]].append(r)
    expected = Counter((i, zlib.crc32((t or "").encode())) for i, t in texts)
    assert set(rows) == set(expected)
    for (i, t) in texts:
        mine = rows[i, zlib.crc32((t or "").encode())]
        times = expected[i, zlib.crc32((t or "").encode())]
        assert len({tuple(r["ids"]) for r in mine}) * times == len(mine)
        if not t:
            assert all(r["ids"] == [] and r["inclusion"] == 1 for r in mine)
        assert all(model.decode(r["ids"]) == (t or "") for r in mine)
        assert all(0 < r["inclusion"] <= 1 and r["log_prob"] <= 1e-9 for r in mine)
    again = segment_sampling.sample_segmentations(docs.repartition(7), segment_sampling.default_model(), 3).collect()
    assert by(again, "doc_id", "sample", "gumbel") == by(found, "doc_id", "sample", "gumbel")
    assert segment_sampling.sample_segmentations(empty, segment_sampling.default_model()).count() == 0


def test_samples_follow_the_lattice_without_replacement():
    import numpy as np

    vocabulary = segment_sampling.Vocabulary(open(segment_sampling.default_model(), "rb").read())
    text, n = " then", 20_000
    weight = dict(zip(vocabulary.ids.tolist(), vocabulary.weights.tolist(), strict=True))
    ids = {vocabulary.spelled[i].decode(): i for i in weight}
    found = {}

    def walk(at, path, total):
        if at == len(text):
            found[path] = math.exp(total)
        for end in range(at + 1, len(text) + 1):
            if text[at:end] in ids:
                i = ids[text[at:end]]
                walk(end, (*path, i), total + weight[i])

    walk(0, (), 0.0)
    whole = sum(found.values())
    share = {p: x / whole for p, x in found.items()}
    keys = segment_sampling.mix(np.arange(n, dtype=np.uint64) + np.uint64(5))
    drawn, estimate = defaultdict(list), np.zeros(n)
    for _, (chosen, flat_ids, count, _, _, inclusion) in enumerate(
        segment_sampling._segment(["then"] * n, keys, segment_sampling.Store(vocabulary), 3)
    ):
        ends = np.concatenate([[0], np.cumsum(count)])
        for i in chosen.tolist():
            path = tuple(flat_ids[ends[i] : ends[i + 1]].tolist())
            drawn[i].append(path)
            estimate[i] += share[path] / inclusion[i]
    pairs = Counter((d[0], d[1]) for d in drawn.values())
    for (a, b), c in pairs.most_common(4):
        assert c / n == pytest.approx(share[a] * share[b] / (1 - share[a]), abs=0.012)
    assert estimate.mean() == pytest.approx(1.0, abs=0.01)
