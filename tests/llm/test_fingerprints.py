"""Fingerprints: brute force over all shingles, estimates, merging, and the order of documents."""

from __future__ import annotations

import hashlib
import random
from base64 import b64decode

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import EDGES, frame, near_copies, shingles
from txnlake.llm import op13_document_fingerprints as op13

LIMIT = (1 << op13.HASH_BITS) // op13.SCALE


def hash_of(shingle: tuple) -> int:
    """One shingle's hash: that of a text which is nothing else."""
    return int(op13.sketches(pa.array([" ".join(shingle)]), scale=1)[0][0])


def plain(text: str | None) -> str:
    every = sorted({hash_of(s) for s in shingles(text)})
    kept = [h for h in every if h < LIMIT] or every[:1]
    return op13.written(np.array(kept, np.uint64))


def values(fingerprint: str) -> set[int]:
    raw = b64decode(fingerprint)
    return {int.from_bytes(raw[k : k + 6]) for k in range(0, len(raw), 6)}


def likeness(one: str, other: str) -> float:
    a, b = values(one), values(other)
    return len(a & b) / len(a | b) if a | b else 1.0


def order(row):
    return (row[0] is None, -(row[0] or 0))


@pytest.mark.parametrize("clash", [False, True])
def test_fingerprints(spark, clash):
    rows = [*EDGES, *near_copies(2, 4, 10)]
    got = sorted((tuple(r) for r in op13.fingerprints(frame(spark, rows, clash)).collect()), key=repr)
    assert got == sorted(((i, plain(t)) for i, t in rows), key=repr)


def test_against_the_next_document(spark):
    rng = random.Random(1)
    rows = [(i, t) for i, t in EDGES if i not in (5, None)] + near_copies(3, 4, 20) + [(1000, "é" * 10), (1001, "")]
    rng.shuffle(rows)
    in_order = sorted(rows, key=order)
    want = []
    for (i, text), (_, following) in zip(in_order, in_order[1:] + in_order[:1], strict=True):
        text, following = text or "", following or ""
        n = len(text) // 3
        new = text[: len(text) - n] + following[:n]
        own, of_new, of_next = plain(text), plain(new), plain(following)
        digest = hashlib.sha256(new.encode()).hexdigest()
        want.append((i, len(text), digest, own, of_new, likeness(own, of_new), likeness(own, of_next)))
    for clash in (False, True):
        got = op13.against_next(frame(spark, rows, clash).repartition(5)).select(*op13.RESULT[:7]).collect()
        assert sorted(map(tuple, got), key=order) == want


@pytest.mark.parametrize("parts", [1, 40])
def test_parts_of_any_size(spark, parts):
    rows = [(i, f"text number {i} of some words more than five") for i in range(97)]
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.doc_id: r for r in op13.against_next(frame(spark, rows)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == 97
    for i, text in rows:
        new = op13.edited(text, rows[i - 1][1])
        assert got[i].edited_sha256 == hashlib.sha256(new.encode()).hexdigest()


def test_rows_of_one_id(spark):
    """A third of all rows equal, and as many without an id: each has exactly one successor."""
    rows = [(5, "the same row of six words")] * 300 + [(None, f"no id {i}") for i in range(300)]
    rows += [(i, f"other {i}") for i in range(10, 300)]
    got = op13.against_next(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    same = op13.edited(rows[0][1], rows[0][1])
    digest = hashlib.sha256(same.encode()).hexdigest()
    assert sum(r.doc_id == 5 and r.edited_sha256 == digest and r.near_next == 1 for r in got) == 299


def test_one_row_and_none(spark):
    (only,) = op13.against_next(frame(spark, [(1, "a b c d e f")])).collect()
    assert only.near_next == 1 and only.edited_sha256 == hashlib.sha256(b"a b c d a b").hexdigest()
    assert op13.against_next(frame(spark, [])).count() == 0
    assert op13.fingerprints(frame(spark, [], clash=True)).count() == 0


def test_estimates(spark):
    """Containment of short texts in long ones, and likeness, next to the true shares."""
    rng = random.Random(7)
    words = [f"w{rng.randrange(10**6)}" for _ in range(40_000)]
    pairs = []
    for k in range(20):
        a = 1000 * k
        part = words[a : a + 1500] + [f"x{rng.randrange(10**6)}" for _ in range(75 * k)]
        pairs.append((k, " ".join(words), " ".join(part)))
    df = spark.createDataFrame(pairs, "doc_id long, text string, part string")
    whole = op13.fingerprints(df).withColumnRenamed("fingerprint", "whole")
    parts = op13.fingerprints(df.select("doc_id", F.col("part").alias("text"))).withColumnRenamed("fingerprint", "part")
    found = whole.join(parts, "doc_id").select(
        "doc_id",
        op13.containment(F.col("part"), F.col("whole")).alias("held"),
        op13.likeness(F.col("part"), F.col("whole")).alias("near"),
    )
    for r in found.collect():
        a, b = shingles(pairs[r.doc_id][1]), shingles(pairs[r.doc_id][2])
        assert abs(r.held - len(a & b) / len(b)) < 0.1
        assert abs(r.near - len(a & b) / len(a | b)) < 0.02


def test_merged_fingerprints(spark):
    rows = [(i, t) for i, t in EDGES if i] + near_copies(5, 3, 6)
    prints = op13.fingerprints(frame(spark, rows)).withColumn("g", F.col("doc_id") % 3)
    sets: dict[int, set] = {}
    for i, t in rows:
        sets.setdefault(i % 3, set()).update(hash_of(s) for s in shingles(t))
    for scale in (op13.SCALE, 64):
        limit = (1 << op13.HASH_BITS) // scale
        for r in op13.merged(prints, "g", scale=scale).collect():
            want = sorted(h for h in sets[r.g] if h < limit) or sorted(sets[r.g])[:1]
            assert r.fingerprint == op13.written(np.array(want, np.uint64))


def test_very_long_texts(spark):
    rows = [(1, "x" * 10_000_000), (2, "word " * 2_000_000), (3, "日本 語" * 1_000_000)]
    got = {r.doc_id: r for r in op13.against_next(frame(spark, rows)).collect()}
    assert [got[i].n_chars for i in (1, 2, 3)] == [len(t) for _, t in rows]
    assert got[2].near_edited == likeness(got[2].fingerprint, got[2].edited_fingerprint)
