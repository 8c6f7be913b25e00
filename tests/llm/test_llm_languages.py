"""Languages by nearest centroid: held-out accuracy, whole texts, and rows of all kinds."""

import zlib

import numpy as np
import pytest

from evenhand.llm import language_id
from evenhand.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string"


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    told = {r["doc_id"]: r for r in QUERIES["op12_nearest_centroid"](spark, sf_dir).collect()}
    rows = docs.collect()
    assert len(told) == len(rows)
    assert all(told[r["doc_id"]]["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    out = [r for r in rows if told[r["doc_id"]]["held_out"]]
    assert np.mean([told[r["doc_id"]]["lang_pred"] == r["lang"] for r in out]) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in told.values())


def test_held_out_rows_teach_nothing(spark):
    rows = [(i, "aaa bbb" if i % 2 else "xyz zyx", "one" if i % 2 else "two") for i in range(200)]
    wrong = [(i, t, "held" if zlib.crc32(str(i).encode()) % 5 == 0 else g) for i, t, g in rows]
    told = language_id.document_languages(spark.createDataFrame(wrong, SCHEMA)).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in told} == {i: g for i, _, g in rows}


@pytest.mark.parametrize("text", ["", "!? 12\n", "a", "Ab c", "é  ö\n\nß1x", "x" * 40, "a1b2c3d4e5f6g7h8", " a ", "𝄞 ab"])
@pytest.mark.parametrize("characters", [1, 2, 3, 7])
def test_pieces_of_a_long_text_count_as_the_whole(monkeypatch, text, characters):
    whole = language_id.counts(text)
    monkeypatch.setattr(language_id, "CHARACTERS", characters)
    pieces = language_id.counts(text)
    assert (whole is None) == (pieces is None) == (not any(c.isalpha() for c in text))
    assert whole is None or (whole == pieces).all()


def test_counts_are_of_letters_and_blanks():
    assert (language_id.counts("Ab, c!") == language_id.counts("ab\n\n c")).all()
    # blank, a, blank: three grams of one character but the leading blank, two of two, one of three
    assert language_id.counts("a").sum() == 2 + 2 + 1


def test_rows_of_all_kinds(spark):
    known = [(i, f"der die und {i}", "de") for i in range(40)] + [(i, f"the and of {i}", "en") for i in range(40, 80)]
    odd = [(None, None, None), (1001, None, "de"), (1002, "", "de"), (1003, "12 !", None), (1004, "the and " * 300_000, None), (1004, "the and", "en"), (1004, "the and", "en")]
    wide = spark.createDataFrame([(*r, "x", 1.0) for r in known + odd], SCHEMA + ", lang_pred string, score double")
    told = language_id.document_languages(wide).collect()
    assert len(told) == len(known + odd)
    found = {}
    for r in told:
        found.setdefault(r["doc_id"], []).append((r["lang_pred"], r["score"] > 0, r["rejected"]))
    assert found[None] == found[1001] == found[1002] == found[1003] == [("und", False, True)]
    assert {f[0] for f in found[1004]} == {"en"} and len(found[1004]) == 3
    assert next(r["held_out"] for r in told if r["doc_id"] is None)


def test_no_language_is_known(spark):
    told = language_id.document_languages(spark.createDataFrame([(1, "abc", None), (2, "abc", None)], SCHEMA)).collect()
    assert {(r["lang_pred"], r["score"]) for r in told} == {("und", 0.0)}
    assert language_id.document_languages(spark.createDataFrame([], SCHEMA)).count() == 0


def test_far_texts_are_rejected(spark):
    rows = [(i, f"the and of to in is that it {chr(97 + i % 26)}", "en") for i in range(300)]
    model = language_id.fit_languages(spark.createDataFrame(rows, SCHEMA))
    told = language_id.identify(spark.createDataFrame([(1, "жзий клмн"), (2, "the and of to in is that it b")], "id long, text string"), model)
    assert {r["id"]: (r["lang_pred"], r["rejected"]) for r in told.collect()} == {1: ("en", True), 2: ("en", False)}
    assert told.columns == ["id", "text", "lang_pred", "score", "rejected"]


def test_one_hot_text(spark):
    rows = [(i, "the and of", "en") for i in range(5000)] + [(5000 + i, f"der die {i}", "de") for i in range(50)]
    model = language_id.fit_languages(spark.createDataFrame(rows, SCHEMA), language_id.Training(rows=20))
    assert model.languages.count("en") == 1 and "de" in model.languages
