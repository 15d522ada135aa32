"""Sharding: sizes and checksums, gapless slots, shares, and what a further shard moves."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.cases import EDGES, frame, sorted_rows
from txnlake.llm import op7_sharding as op7


@pytest.mark.parametrize("clash", [False, True])
def test_odd_rows(spark, clash):
    docs = frame(spark, EDGES, clash)
    got = op7.shard(docs)
    want = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), "key") for i, t in EDGES]
    assert sorted_rows(got, "doc_id", "size", "text_crc32", "law") == sorted(want, key=repr)
    shard_of = defaultdict(set)
    for r in got.collect():
        shard_of[r.doc_id].add((r.shard, r.grown_shard))
        assert 0 <= r.shard < 8
    assert all(len(s) == 1 for s in shard_of.values())
    assert op7.shard(docs.filter("false")).count() == 0


def many(spark, n=20_000):
    return spark.range(n).select((F.col("id") * 7).alias("doc_id"), F.lit("t").alias("text"))


def test_slots_have_no_gaps_over_many_tasks(spark):
    slots = defaultdict(list)
    for r in op7.shard(many(spark, 3000).repartition(9)).collect():
        slots[r.shard].append(r.slot)
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    assert sum(map(len, slots.values())) == 3000


def test_a_further_shard_takes_its_share_for_itself_only(spark):
    rows = op7.shard(many(spark)).collect()
    moved = [r for r in rows if r.shard != r.grown_shard]
    assert {r.grown_shard for r in moved} == {8}
    assert abs(len(moved) / len(rows) - 1 / 9) < 0.01
    assert all(abs(n / len(rows) - 1 / 8) < 0.01 for n in Counter(r.shard for r in rows).values())


def test_neither_order_nor_tasks_nor_texts_matter(spark):
    a = op7.shard(many(spark, 500).repartition(7)).select("doc_id", "shard").sort("doc_id").collect()
    b = op7.shard(many(spark, 500).orderBy(F.desc("doc_id")).withColumn("text", F.lit("other"))).select("doc_id", "shard")
    assert a == b.sort("doc_id").collect()


def test_weights(spark):
    rows = op7.shard(many(spark), [1.0, 2.0, 5.0], None)
    assert rows.filter("grown_shard is not null").count() == 0
    n = Counter(r.shard for r in rows.collect())
    assert [round(n[k] / 20_000, 2) for k in range(3)] == pytest.approx([1 / 8, 2 / 8, 5 / 8], abs=0.02)
    assert {r.shard for r in op7.shard(many(spark, 50), [3.0]).collect()} == {0}
    for bad in ([], [1.0, 0.0]):
        with pytest.raises(ValueError):
            op7.shard(many(spark, 5), bad)


def test_files_by_shard(spark, tmp_path):
    docs = frame(spark, EDGES, clash=True)
    op7.write_shards(docs, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(EDGES) and set(docs.columns) | {"shard"} == set(back.columns)
    placed = {(r.doc_id, r.shard) for r in op7.shard(docs).collect()}
    assert {(r.doc_id, r.shard) for r in back.collect()} == placed
