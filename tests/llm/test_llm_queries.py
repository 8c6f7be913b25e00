"""Chat transcripts, the registered queries against their SQL, and the pipeline."""

import os

import pytest
from oracle import compare, connect

import corpus_pipeline
from evenhand.llm import chat
from evenhand.llm.oracle import ORACLE
from evenhand.llm.queries import QUERIES


def folded(spark, events):
    df = spark.createDataFrame(events, "conv long, seq long, kind string, msg string, role string, text string")
    rows = chat.final_messages(df).collect()
    return [(r["conv"], r["role"], r["text"]) for r in sorted(rows, key=lambda r: (r["conv"], r["start"]))]


def test_events_fold_into_final_messages(spark):
    log = [
        (1, 0, "message", "u1", "user", "hi"),
        (1, 1, "message", "a1", "assistant", None),
        (1, 2, "delta", "a1", None, "Hel"),
        (1, 3, "delta", "a1", None, "lo"),
        (1, 4, "edit", "u1", "user", "hi!"),
        (1, 5, "message", "u2", "user", "and then"),
        (1, 6, "regenerate", "a1", None, None),
        (1, 7, "delta", "a1", None, "Good "),
        (1, 8, "delta", "a1", None, "day"),
        (1, 9, "message", "u3", "user", "bye"),
        (2, 0, None, None, "user", None),
        (2, 1, None, None, "assistant", "x"),
    ]
    expected = [(1, "user", "hi!"), (1, "assistant", "Good day"), (1, "user", "bye"), (2, "user", ""), (2, "assistant", "x")]
    assert folded(spark, log) == expected
    assert folded(spark, log[::-1]) == expected
    assert folded(spark, []) == []


@pytest.mark.parametrize("text", ["", None, r"<\s>", "</s>[INST]", r"[\\INST] [/INST]<\\/s>", "<<s>", "s>[", "a\nb", r"$1 \1", "é𝄞"])
def test_rendering_reads_back(spark, text):
    rows = [(1, 0, text, "sys"), (1, 1, "user", text), (1, 2, "assistant", text), (1, 2, "assistant", "b"), (None, None, None, None)]
    table = spark.createDataFrame([(*r, "x", 3) for r in rows], "conv_id long, turn int, role string, text string, formatted string, loss int")
    rendered = chat.format_conversations(table)
    back = {r["conv"]: r for r in chat.read_back(rendered.withColumnRenamed("conv_id", "conv")).collect()}
    ordered = sorted((("assistant", text or ""), ("assistant", "b")))
    assert list(zip(back[1]["roles"], back[1]["texts"], strict=True)) == [(text or "", "sys"), ("user", text or ""), *ordered]
    learned = [t for _, t in ordered]
    assert back[1]["learned"] == (["sys", *learned] if text == "assistant" else learned)
    assert back[None]["texts"] == [""]


def test_conversations_become_logs_that_fold_back(spark):
    rows = [(c, t, ("user", "assistant", None)[t % 3], None if t == 5 else f"<{c} {t}> " + "é𝄞x " * (t * c)) for c in range(4) for t in range(40)]
    rows += [(7, 0, "user", "ab𝄞" * 700_000), (7, 1, "assistant", "same"), (7, 1, "assistant", "same"), (None, None, None, None)]
    table = spark.createDataFrame([(*r, "m", 1) for r in rows], "conv_id long, turn int, role string, text string, msg string, seq int")
    log = chat.conversation_events(table)
    assert {r["kind"] for r in log.select("kind").distinct().collect()} == {"message", "delta", "edit", "regenerate"}
    assert log.filter("msg is null").count() == 0 and log.groupBy("conv", "seq").count().filter("count > 1").count() == 0
    assert log.filter("text = 'withdrawn'").count() > 20
    got = {}
    for r in sorted(chat.final_messages(log).collect(), key=lambda r: r["start"]):
        got.setdefault(r["conv"], []).append((r["role"], r["text"]))
    wanted = {}
    for c, _, role, text in rows:
        wanted.setdefault(c, []).append((role or "", text or ""))
    assert got == wanted


def test_no_conversations_give_none(spark):
    empty = spark.createDataFrame([], "conv_id long, turn int, role string, text string")
    assert chat.format_conversations(empty).count() == 0


@pytest.fixture(scope="module")
def duck(sf_dir):
    if not os.path.isdir(sf_dir):
        pytest.skip("no test tables here")
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_against_sql(spark, sf_dir, duck, name):
    assert compare(QUERIES[name](spark, sf_dir), duck, ORACLE[name]) == []


def test_pipeline_stages(spark, sf_dir, duck, tmp_path):
    docs, counts = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = str(tmp_path / name)
        stage(spark, docs, sf_dir).write.parquet(path)
        out = spark.read.parquet(path)
        assert out.columns == columns
        ids = {r["doc_id"] for r in out.select("doc_id").collect()}
        assert ids <= {r["doc_id"] for r in docs.select("doc_id").collect()}
        counts.append((name, ids))
        docs = out
    kept = {r[0] for r in duck.execute(f"SELECT doc_id FROM ({ORACLE['op2_rule_ledger']}) WHERE kept").fetchall()}
    assert counts[0][1] == kept
    ids = ",".join(map(str, kept))
    first = f"""SELECT min(doc_id) FROM documents WHERE doc_id IN ({ids})
        GROUP BY regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')"""
    assert counts[1][1] == {r[0] for r in duck.execute(first).fetchall()}
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert {r["doc_id"] for r in last.select("doc_id").collect()} == counts[-1][1]
