"""Texts of about ten megabytes, without spaces, of many repeated words, and of Chinese: every operator and the pipeline."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.cases import frame
from tests.llm.test_tokens import check_packing
from txnlake.llm import op1_language_id as op1
from txnlake.llm import op3_jaccard_join as op3
from txnlake.llm import op4_byte_bpe as op4
from txnlake.llm import op5_license_scan as op5
from txnlake.llm import op6_best_fit_packing as op6
from txnlake.llm import op7_sharding as op7
from txnlake.llm import op8_pii as op8
from txnlake.llm import op9_token_counts as op9
from txnlake.llm import op10_exact_dedup as op10

MAIL = " me@example.com "


def made() -> list[tuple[int, str]]:
    rng = random.Random(11)
    half = " ".join(f"w{rng.randrange(300_000)}" for _ in range(250_000))
    chinese = "".join(rng.choices("日本語文章漢字中国人民大学生", k=3_300_000))
    near = f"changed {half.partition(' ')[2]}"
    return [
        (1, "x" * 10_000_000),
        (2, f"{half} {half} MIT License{MAIL}"),
        (3, chinese),
        (4, f"a@{'b-' * 5_000_000}{MAIL}"),
        (5, f"{half} {half} MIT License{MAIL}"),
        (6, f"{near} {near} MIT License{MAIL}"),
    ]


ROWS = made()
TEXTS = dict(ROWS)


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("long") / "documents.parquet")
    rows = frame(spark, ROWS).select("*", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.char_length("text").cast("long").alias("n_chars"))
    rows.write.parquet(path)
    return spark.read.parquet(path)


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_languages(docs):
    got = by_id(op1.language_id(docs.filter("doc_id <= 3")))
    assert set(got) == {1, 2, 3} and all(0 <= r.score <= 1 for r in got.values())


def test_near_copies(docs):
    got = by_id(op3.jaccard_components(docs))
    assert [got[k].component_id for k in sorted(got)] == [1, 2, 3, 4, 2, 2]
    assert (got[1].n_shingles, got[3].n_shingles) == (1, 1)


def test_byte_bpe(docs):
    got = by_id(op4.digests(op4.encode(docs.filter("doc_id <= 4"))))
    tokens = op4.encoding(op4.RANKS)
    for k, text in ROWS[:4]:
        ids = np.array(tokens.encode_ordinary(text), "<u4")
        assert got[k].n_tokens == len(ids)
        assert got[k].ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert got[k].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_licenses(docs):
    got = by_id(op5.license_scan(docs))
    assert [got[k].n_base for k in sorted(got)] == [0, 1, 0, 0, 1, 1]
    assert got[2].n_words == 500_004 + 1 and got[2].labels == "mit"


def test_packing(docs):
    packed = op6.pack(docs).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("length").alias("most")).collect()
    assert {r.doc_id for r in packed} == set(TEXTS) and max(r.most for r in packed) <= 2048


def test_shards(docs):
    got = by_id(op7.shard(docs))
    assert all(got[k].size == len(t.encode()) + 1 and got[k].text_crc32 == zlib.crc32(t.encode()) for k, t in TEXTS.items())


def test_personal_data(docs):
    got = by_id(op8.pii(docs))
    assert [got[k].n_email for k in sorted(got)] == [0, 1, 0, 1, 1, 1]
    at = TEXTS[4].index(MAIL) + 1
    assert got[4].spans == f"email:{at}:{at + len(MAIL) - 2}"


def test_token_counts(docs):
    got = by_id(op9.token_counts(docs.filter("doc_id <= 3")))
    library = op9.tokenizer(op9.VOCABULARY)
    for k, text in ROWS[:3]:
        assert got[k].n_tokens == len(library.encode(text, add_special_tokens=False))


def test_exact_copies(docs):
    assert {k: r.keep_id for k, r in by_id(op10.exact_dedup(docs)).items()} == {1: 1, 2: 5, 3: 3, 4: 4, 5: 5, 6: 6}


def test_pipeline(spark, docs):
    """Texts of one word fail the rules, and so do those of repeated words; with the rules passed, the rest is whole."""
    left = docs.filter("doc_id <> 1")
    for name, stage in corpus_pipeline.STAGES[1:4]:
        left = stage(spark, left, None)
        assert left.columns == docs.columns, name
    texts = {r.doc_id: r.text for r in left.collect()}
    assert set(texts) == {3, 4, 5} and "@example" not in texts[4] + texts[5] and texts[3] == TEXTS[3]
    judged = corpus_pipeline.STAGES[0][1](spark, docs, None)
    assert judged.count() == 0
    check_packing(sorted(texts.items()), corpus_pipeline.STAGES[4][1](spark, left, None).cache(), 2048)
