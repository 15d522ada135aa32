"""The pipeline against its stages done the plain way."""

from __future__ import annotations

import duckdb

import __spark_entry__ as entry_point
import corpus_pipeline
from tests.llm.cases import EDGES, components, frame
from tests.llm.test_texts import plain_spans
from tests.llm.test_tokens import check_packing
from txnlake.llm.op2_quality_rules import ORACLE_SQL as QUALITY

SF_DIR = "/root/testdata/sf0.001"


def plain(rows):
    """The (id, text) rows that the first four stages leave; terms need more copies than there are here."""
    latest = {}
    for doc_id, text in rows:
        latest[text] = max(latest.get(text, doc_id), doc_id)
    rows = sorted((i, t) for t, i in latest.items())
    rows = [(i, t) for (i, t), (_, _, least) in zip(rows, components(rows), strict=True) if i == least]
    out = []
    for doc_id, text in rows:
        spans = [(a, b, f"[{k}]") for k, own in plain_spans(text).items() for a, b in own]
        done, at = "", 0
        for a, b, mark in sorted(spans, key=lambda s: (s[0], -s[1])):
            if a >= at:
                done += text[at:a] + mark
            at = max(at, b)
        out.append((doc_id, done + text[at:]))
    return out


def test_pipeline_is_its_stages_done_plainly(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    good = con.execute(f"SELECT doc_id, text FROM documents JOIN ({QUALITY}) USING (doc_id) WHERE kept").fetchall()
    packed = entry_point.queries()["pipeline"](spark, SF_DIR).cache()
    sequences, tokens = check_packing(plain(good), packed, 2048)
    assert sequences <= tokens / 2048 * 1.1 + 1


def test_stages_take_odd_rows_and_keep_the_columns(spark):
    docs = frame(spark, [*EDGES, *[(50 + i, f"this is a plain and clean sentence of some length number {i} " + " ".join(f"w{i}{k}" for k in range(4 * i))) for i in range(5)]], clash=True)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, None)
        assert docs.columns == columns, name
    assert {50, 51, 52, 53, 54} <= {r.doc_id for r in docs.collect()}
    assert corpus_pipeline.STAGES[-1][1](spark, docs, None).count() >= 5


def test_stages_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").filter("false")
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF_DIR)
        assert after.count() == 0, name
        docs = after if name != "best_fit_packing" else docs
    assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_sizes_follow_the_texts(spark):
    docs = spark.createDataFrame([(1, "write me@example.com", "en", "s", 20)], "doc_id long, text string, lang string, source string, n_chars long")
    assert dict(corpus_pipeline.STAGES)["pii"](spark, docs, None).first()[:] == (1, "write [email]", "en", "s", 13)
