"""Language of a text by its nearest centroid.

A text becomes counts of character n-grams (one to three characters, any run of other characters than letters
is one blank), hashed into ``SLOTS`` and weighed by TF-IDF at unit length. Each language has several centroids,
found by clustering, and the nearest one by cosine decides. A text that is farther from its centroid than nearly
all of the centroid's own is rejected: it keeps its language, and ``rejected`` says so.

Document frequencies come from all training rows; only the clustering reads a bounded sample of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenhand.llm.tables import named, saved, worker_state

LOG_SLOTS = 14
SLOTS = 1 << LOG_SLOTS
UNKNOWN = "und"
CHARACTERS = 1 << 20
ROWS = 256
MIXERS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


@dataclass(frozen=True)
class Training:
    """``rows`` bounds the different texts of a language that are clustered; all other figures are of all rows."""

    rows: int = 1000
    centroids: int = 4
    rounds: int = 12
    kept: float = 0.995


@dataclass(frozen=True)
class LanguageModel:
    """Languages, their centroids (unit rows), how far (1 - cosine) each one reaches, and the idf of the slots."""

    languages: tuple[str, ...]
    centroids: np.ndarray
    reach: np.ndarray
    idf: np.ndarray


def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def counts(text: str) -> np.ndarray | None:
    """How often each slot occurs in the whole text; None if it has no letter."""
    is_letter = worker_state("letters", _letters)
    text, total, tail, blank = text.lower(), None, np.array([32], np.uint32), True
    for start in range(0, len(text), CHARACTERS):
        points = np.frombuffer(text[start : start + CHARACTERS].encode("utf-32-le", "surrogatepass"), "<u4")
        letter = is_letter[points]
        if total is None:
            if not letter.any():
                continue
            total = np.zeros(SLOTS, np.int64)
        # a blank stays only behind a letter
        stays = letter.copy()
        stays[1:] |= letter[:-1]
        stays[0] |= not blank
        blank = not letter[-1]
        found = np.where(letter, points, np.uint32(32))[stays].astype(np.uint32)
        total += _grams(tail, found)
        tail = np.concatenate([tail, found])[-2:]
    if total is not None and not blank:
        total += _grams(tail, np.array([32], np.uint32))
    return total


def _grams(before: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Counts of the n-grams that end in ``points``; ``before`` has up to two characters ahead of them."""
    x = np.concatenate([before, points])
    skip = len(before)
    shift = np.uint32(32 - LOG_SLOTS)
    one = (x + np.uint32(1)) * MIXERS[0]
    two = ((one[:-1] ^ (one[:-1] >> np.uint32(15))) + x[1:]) * MIXERS[1]
    three = ((two[:-1] ^ (two[:-1] >> np.uint32(13))) + x[2:]) * MIXERS[2]
    grams = [one[skip:], two[max(skip - 1, 0) :], three[max(skip - 2, 0) :]]
    return np.bincount(np.concatenate(grams) >> shift, minlength=SLOTS)


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, length, out=np.zeros_like(rows), where=length > 0)


def vectors(found: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return _unit(np.log1p(found.astype(np.float32)) * idf)


def _presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Document frequencies within a task, and its number of texts as slot -1."""
    total, texts = np.zeros(SLOTS, np.int64), 0
    for batch in batches:
        for text in batch["text"]:
            found = counts(text.as_py() or "")
            if found is not None:
                total += found > 0
                texts += 1
    slots = np.flatnonzero(total)
    yield pa.record_batch(
        {"slot": pa.array([-1, *slots.tolist()], pa.int32()), "n": pa.array([texts, *total[slots].tolist()], pa.int64())}
    )


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of sampled texts as arrays of slots and counts."""
    for batch in batches:
        langs, slots, amounts = [], [], []
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
            found = counts(text or "")
            if found is not None:
                at = np.flatnonzero(found)
                langs.append(lang)
                slots.append(at.astype("<u2").tobytes())
                amounts.append(found[at].astype("<u4").tobytes())
        yield pa.record_batch({"lang": pa.array(langs, pa.string()), "slots": pa.array(slots, pa.binary()), "amounts": pa.array(amounts, pa.binary())})


def clustered(rows: np.ndarray, k: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means. The first centre is the row nearest to the mean, the next ones the farthest from those so far."""
    mean = _unit(rows.sum(axis=0, keepdims=True))
    chosen = [int(np.argmax(rows @ mean[0]))]
    nearest = rows @ rows[chosen[0]]
    while len(chosen) < min(k, len(rows)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, rows @ rows[chosen[-1]])
    centres = rows[chosen]
    for _ in range(rounds):
        of = np.argmax(rows @ centres.T, axis=1)
        sums = np.stack([rows[of == c].sum(axis=0) if (of == c).any() else centres[c] for c in range(len(centres))])
        moved = _unit(sums)
        if np.allclose(moved, centres, atol=1e-6):
            break
        centres = moved
    return centres, np.argmax(rows @ centres.T, axis=1)


def _fit_language(idf: np.ndarray, training: Training):
    def fit(table: pa.Table) -> pa.Table:
        found = np.zeros((table.num_rows, SLOTS), np.float32)
        for i, (slots, amounts) in enumerate(zip(table["slots"], table["amounts"], strict=True)):
            found[i, np.frombuffer(slots.as_py(), "<u2")] = np.frombuffer(amounts.as_py(), "<u4")
        # the order in which rows arrive must not matter
        found = found[np.lexsort((found.sum(axis=1), found @ np.arange(SLOTS, dtype=np.float32)))]
        rows = vectors(found, idf)
        centres, of = clustered(rows, training.centroids, training.rounds)
        away = 1 - np.einsum("ij,ij->i", rows, centres[of])
        used = [c for c in range(len(centres)) if (of == c).any()]
        return pa.table(
            {
                "lang": pa.array([table["lang"][0].as_py()] * len(used), pa.string()),
                "n": pa.array([int((of == c).sum()) for c in used], pa.int64()),
                "reach": pa.array([float(np.quantile(away[of == c], training.kept)) for c in used], pa.float64()),
                "centre": pa.array([centres[c].astype("<f4").tobytes() for c in used], pa.binary()),
            }
        )

    return fit


def fit_languages(rows: DataFrame, training: Training = Training()) -> LanguageModel:
    """Learn from (text, lang); rows without a language, or with a text without letters, teach nothing.

    The driver gets document frequencies by slot and the centroids: ``SLOTS`` numbers, and as many for each of
    ``training.centroids`` centroids of a language. No rows give a model without languages.
    """
    labelled = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    found = labelled.select("text").mapInArrow(_presence, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect()
    total = sum(r["n"] for r in found if r["slot"] < 0)
    frequency = np.zeros(SLOTS, np.float64)
    for r in found:
        if r["slot"] >= 0:
            frequency[r["slot"]] = r["n"]
    idf = np.log((1 + total) / (1 + frequency)).astype(np.float32) + np.float32(1)
    if not total:
        return LanguageModel((), np.zeros((0, SLOTS), np.float32), np.zeros(0), idf)
    # texts with the smallest hashes: about twice the bound by a threshold, then exactly the bound
    order = F.xxhash64("text")
    sizes = labelled.groupBy("lang").agg(F.approx_count_distinct(order).alias("texts"))
    share = F.least(F.lit(1.0), F.lit(2.0 * training.rows) / F.col("texts"))
    limits = {r["lang"]: r["share"] for r in sizes.select("lang", share.alias("share")).collect()}
    limit = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])[F.col("lang")]
    near = labelled.filter(F.pmod(order, F.lit(1 << 30)) <= limit * (1 << 30)).select("lang", "text", order.alias("__at"))
    # copies of a text would come in together, however many there are
    near = near.groupBy("lang", "__at").agg(F.min("text").alias("text"))
    ranked = near.withColumn("__rank", F.row_number().over(Window.partitionBy("lang").orderBy("__at")))
    sample = ranked.filter(F.col("__rank") <= training.rows).select("lang", "text").mapInArrow(_sparse, "lang string, slots binary, amounts binary")
    fitted = sample.groupBy("lang").applyInArrow(_fit_language(idf, training), "lang string, n long, reach double, centre binary")
    centres = sorted(fitted.collect(), key=lambda r: (r["lang"], -r["n"], r["centre"]))
    return LanguageModel(
        tuple(r["lang"] for r in centres),
        np.stack([np.frombuffer(r["centre"], "<f4") for r in centres]) if centres else np.zeros((0, SLOTS), np.float32),
        np.array([r["reach"] for r in centres]),
        idf,
    )


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """The rows with ``lang_pred``, ``score`` (cosine to the nearest centroid) and ``rejected``.

    NULL text and text without a letter are ``und`` with score 0 and rejected, and so is every text if the
    model has no language. Languages at the same cosine go in order of their names. Columns of those names are replaced.
    """
    added = ("lang_pred", "score", "rejected", "__text")
    kept = [c for c in docs.columns if c not in added]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, max(whole.num_rows, 1), ROWS):
                batch = whole.slice(start, ROWS)
                found = [counts(t.as_py() or "") if len(model.languages) else None for t in batch["__text"]]
                known = [i for i, f in enumerate(found) if f is not None]
                lang, score, rejected = [UNKNOWN] * len(found), [0.0] * len(found), [True] * len(found)
                if known:
                    near = vectors(np.stack([found[i] for i in known]), model.idf) @ model.centroids.T
                    for i, best, cosine in zip(known, near.argmax(axis=1), near.max(axis=1), strict=True):
                        lang[i], score[i] = model.languages[best], float(min(max(cosine, 0.0), 1.0))
                        rejected[i] = bool(1 - cosine > model.reach[best])
                columns = [batch.column(i) for i, c in enumerate(batch.schema.names) if c != "__text"]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                    names=[*[c for c in batch.schema.names if c != "__text"], *added[:3]],
                )

    rows = docs.select(*[named(c) for c in kept], named(text_col).cast("string").alias("__text"))
    schema = rows.drop("__text").schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return rows.mapInArrow(predict, schema)


def held_out(id_col: str = "doc_id") -> Column:
    """A fifth of the rows by the crc32 of the decimal id; a NULL id counts as the empty text, so it is held out."""
    return F.crc32(F.encode(F.coalesce(named(id_col).cast("string"), F.lit("")), "UTF-8")) % 5 == 0


def document_languages(docs: DataFrame, training: Training = Training()) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected of every document; the model learns from those not held out.

    Other columns than doc_id, text and lang are not read. An empty table gives no rows.
    """
    rows = docs.select(named("doc_id").alias("doc_id"), named("text").cast("string").alias("text"), named("lang").cast("string").alias("lang"), held_out().alias("held_out"))
    model = fit_languages(rows.filter(~F.col("held_out")).select("text", "lang"), training)
    return identify(rows.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score", "rejected")
