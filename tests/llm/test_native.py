"""Quality rules and exact dedup: against plain versions, their SQL, and their plans."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import EDGES, frame, measures, sorted_rows
from txnlake.llm import op2_quality_rules as op2
from txnlake.llm import op10_exact_dedup as op10
from txnlake.llm.registry import oracle_sql, queries

SF_DIR = "/root/testdata/sf0.001"
NATIVE = ("op2_quality_rules", "op10_exact_dedup")


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, name):
    df = queries()[name](spark, SF_DIR)
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    cursor = con.execute(oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(repr, cursor.fetchall())) == sorted(repr(tuple(r)) for r in df.select(*names).collect())
    plan = df._jdf.queryExecution().executedPlan().toString()
    native = ("Python", "Arrow", "Pandas") if name in NATIVE else ()
    for node in (*native, "Cartesian", "NestedLoop"):
        assert node not in plan


@pytest.mark.parametrize("clash", [False, True])
def test_measures_of_odd_rows(spark, clash):
    got = sorted_rows(op2.measure(frame(spark, EDGES, clash)))
    assert got == sorted(((i, *measures(t)) for i, t in EDGES), key=repr)


def test_measures_of_random_texts(spark):
    rng = random.Random(4)
    rows = [
        (i, "".join(rng.choice(["a ", "b ", "c\n", "dd ", "\n", "|", "é ", "\t"]) for _ in range(rng.randint(0, 80))))
        for i in range(400)
    ]
    assert sorted_rows(op2.measure(frame(spark, rows))) == sorted(((i, *measures(t)) for i, t in rows), key=repr)


def test_policies_and_ablations(spark):
    rows = [*EDGES, *[(100 + i, "a b c d e f g h i j k l " * (1 + i % 2)) for i in range(6)]]
    ledger = op2.ledger(frame(spark, rows))
    bits = [r.fail_bits for r in ledger.collect()]
    mask = op2.mask(op2.CURRENT)
    for r in op2.ablations(ledger).collect():
        bit = 1 << list(op2.RULES).index(r.rule)
        assert (r.n_fail, r.n_only) == (sum(b & bit > 0 for b in bits), sum(b & mask == bit for b in bits))
    whole = frame(spark, rows, clash=True)
    kept = op2.keep_good(whole)
    assert kept.columns == whole.columns
    assert kept.count() == sum(b & mask == 0 for b in bits)


def deduplicated(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = max(known) if known else None
        first = ids.index(best)
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, best, len(ids), k == first, digest) for k, i in enumerate(ids)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("clash", [False, True])
@pytest.mark.parametrize("tracked", [512, 4096])
def test_dedup_of_odd_rows(spark, clash, tracked, monkeypatch):
    monkeypatch.setattr(op10, "TRACKED", tracked)
    rows = EDGES + [(200 + i, "hot text") for i in range(60)] + [(None, "hot text"), (259, "hot text")]
    df = frame(spark, rows, clash)
    assert sorted_rows(op10.exact_dedup(df)) == deduplicated(rows)
    kept = op10.keep_one_copy(df)
    assert kept.columns == df.columns
    assert sorted(repr(r.text or "") for r in kept.collect()) == sorted({repr(t or "") for _, t in rows})
    assert [r.doc_id for r in kept.collect() if r.text == "hot text"] == [259]


def test_heavy_digests_are_bounded_and_exact(spark, monkeypatch):
    monkeypatch.setattr(op10, "HEAVY", 3)
    rows = [(i, f"t{min(i % 40, 5)}") for i in range(4000)]
    assert op10.heavy_winners(op10.digests(frame(spark, rows))).count() <= 3
    assert sorted_rows(op10.exact_dedup(frame(spark, rows))) == deduplicated(rows)


def test_empty_tables(spark):
    empty = frame(spark, [], clash=True)
    assert op10.exact_dedup(empty).count() == op10.keep_one_copy(empty).count() == 0
    assert op2.quality_rules(empty).count() == op2.keep_good(empty).count() == 0
    assert op2.ablations(op2.ledger(empty)).count() == 0


def test_sound_documents_pass(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = op2.quality_rules(docs).filter("not base_failed").join(labels, "doc_id")
    lost = judged.filter("quality = 1").agg(F.avg((~F.col("kept")).cast("int"))).first()[0]
    assert lost < 0.02


def test_rows_of_a_heavy_digest_that_tie_are_dropped_where_they_are_read(spark):
    """A third of all rows without an id, a third that repeat the winner's: one row each reaches the shuffle."""
    rows = [(None, "no id")] * 1000 + [(9, "same id")] * 1000 + [(i, f"t{i}") for i in range(100, 1100)]
    docs = frame(spark, rows)
    stored = op10.digests(docs).cache()
    winners = op10.heavy_winners(stored)
    left = stored.join(winners, "text_sha256", "left").filter(~op10._loses())
    assert left.groupBy("text_sha256").count().agg(F.max("count")).first()[0] == 1
    assert sorted_rows(op10.exact_dedup(docs)) == deduplicated(rows)


def test_windows_of_a_very_long_text(spark):
    """Many words that all repeat, and texts without a space: figures as by the definition."""
    rng = random.Random(1)
    half = " ".join(f"w{rng.randrange(500_000)}" for _ in range(100_000))
    got = {}
    for row in [(1, f"{half} {half}"), (2, "x" * 5_000_000), (3, "日本" * 1_500_000)]:
        got[row[0]] = op2.quality_rules(frame(spark, [row])).first()
    assert (got[1].n_words, got[1].n_repeat_words, got[1].base_failed) == (200_000, 200_000, True)
    assert (got[2].n_words, got[2].word_chars, got[3].word_chars) == (1, 5_000_000, 3_000_000)
