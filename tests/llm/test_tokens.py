"""BPE, token counts and packing: against the libraries and by their own rules."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import EDGES, frame, sorted_rows
from txnlake.llm import chunks
from txnlake.llm import op4_byte_bpe as op4
from txnlake.llm import op6_best_fit_packing as op6
from txnlake.llm import op9_token_counts as op9

rng = random.Random(3)
LONG = [
    (1000, "".join(rng.choice("ab '\n\t é1!s<|endoftext|>") for _ in range(6000))),
    (1001, "a" * 3000),
    (1002, " " * 3000),
    (1003, "\n \n" * 900),
    (1004, "<|endoftext|> " * 300),
    (1004, "<|endoftext|> " * 300),
    (1005, "日本語の文章です。" * 200),
    (None, "it's x 12 " * 300),
]


@pytest.fixture(params=[(65_536, 2_048), (500, 60)], ids=["whole", "chunked"])
def sizes(request, monkeypatch):
    monkeypatch.setattr(chunks, "CHUNK", request.param[0])
    monkeypatch.setattr(chunks, "OVERLAP", request.param[1])


def test_bpe_is_the_librarys_and_decodes_to_the_text(spark, sizes):
    rows = EDGES + LONG
    tokens = op4.encoding(op4.RANKS)
    want = []
    for doc_id, text in rows:
        ids = tokens.encode_ordinary(text or "")
        packed = np.array(ids, dtype="<u4").tobytes()
        want.append((doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    encoded = op4.encode(frame(spark, rows, clash=True))
    assert sorted_rows(op4.digests(encoded)) == sorted(want, key=repr)
    decoded = op4.decode(encoded)
    assert sorted_rows(decoded) == sorted([(i, bytearray((t or "").encode())) for i, t in rows], key=repr)


def test_both_sides_of_a_cut_are_encoded_alone():
    """Also without a space between words."""
    tokens, n = op4.encoding(op4.RANKS), 0
    pool = ["日", "本", "語", "。", "、", "ア", "한", "a", "B", "é", "1", "２", "'", "'s", "'ll", "!", "-", " ", "\n", "\t", "\u3000", "\x85", "\u0301"]
    for _ in range(1500):
        text = "".join(rng.choices(pool, k=rng.randint(2, 14)))
        for cut in op4.stable_cuts(text, 0, True, (0, len(text))):
            n += 1
            assert tokens.encode_ordinary(text[:cut]) + tokens.encode_ordinary(text[cut:]) == tokens.encode_ordinary(text), (text, cut)
    assert n > 3000
    chinese = "".join(rng.choice("日本語文章漢字") + ("。" if k % 9 == 8 else "") for k in range(5000))
    assert len(op4.stable_cuts(chinese, 0, True, (0, len(chinese)))) > 1000


def test_cuts_fall_between_pre_tokens():
    text = LONG[0][1][:900]
    ends = {m.end() for m in op4._pre_tokens().finditer(text)}
    cuts = op4.stable_cuts(text, 0, True, (0, len(text)))
    assert cuts and set(cuts) <= ends


def test_token_counts_are_the_librarys(spark, sizes):
    rows = EDGES + LONG
    library = op9.tokenizer(op9.VOCABULARY)
    want = []
    for doc_id, text in rows:
        n = len(library.encode(text or "", add_special_tokens=False))
        want.append((doc_id, len((text or "").encode()), n, n > 2048))
    assert sorted_rows(op9.token_counts(frame(spark, rows, clash=True))) == sorted(want, key=repr)


def test_words_are_counted_as_the_whole_text_is():
    pool = "aAzZß éÉ'sSİıΣς̸́ \n\t\x0b\x0c\r\x1c\x85 　日①½²<|endoftext|>.,!?–한"
    column = ["".join(rng.choice(pool) for _ in range(rng.randrange(100))) for _ in range(2000)]
    column += ["<|endoftext|>x<|startoftext|>", "a<|endoftext|> b", "é ́e"]
    library = op9.tokenizer(op9.VOCABULARY)
    want = [len(library.encode(t, add_special_tokens=False)) for t in column]
    known = op9.Known(op9.VOCABULARY)
    assert op9.count_texts(pa.array(column), known).tolist() == want
    assert op9.count_texts(pa.array(column), known).tolist() == want


def test_a_full_memory_of_words_starts_anew(monkeypatch):
    monkeypatch.setattr(op9, "KNOWN_CHARS", 40)
    column = [" ".join(f"word{rng.randrange(30)}" for _ in range(9)) for _ in range(20)]
    column += ["long" * 50 + " a b", "long" * 50, "日本" * 3000]
    known = op9.Known(op9.VOCABULARY)
    for text in column:
        want = len(op9.tokenizer(op9.VOCABULARY).encode(text, add_special_tokens=False))
        assert op9.count_texts(pa.array([text]), known).tolist() == [want]
        assert sum(map(len, known.counts)) <= 40 and not any(len(w) > op9.LONG_WORD for w in known.counts)


def test_ids_for_packing_are_the_vocabularys():
    pool = "aA é ñ ÿ ſ „–’ \n\r\t!1²ªĀž<|endoftext|>\x85\xa0日"
    column = ["".join(rng.choice(pool) for _ in range(rng.randrange(60))) for _ in range(1500)]
    library = op9.tokenizer(op6.VOCABULARY)
    for text, ids in zip(column, op6.token_ids(column, op6.VOCABULARY, op4.RANKS), strict=True):
        assert ids.tolist() == [*library.encode(text, add_special_tokens=False).ids, op6.END]


def check_packing(rows, packed, capacity):
    library = op9.tokenizer(op6.VOCABULARY)
    want = []
    for doc_id, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, op6.END], dtype="<u4")
        first = len(ids) % capacity or capacity
        starts = [0, *range(first, len(ids), capacity)]
        for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
            want.append((doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
    assert sorted_rows(packed, "doc_id", "piece", "start", "length", "ids_crc32") == sorted(want, key=repr)
    sequences = defaultdict(list)
    for r in packed.collect():
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), sum(w[3] for w in want)


@pytest.mark.parametrize("capacity", [16, 2048])
def test_packing(spark, capacity):
    rows = EDGES + LONG + [(2000 + i, "some words " * rng.randrange(40)) for i in range(300)]
    packed = op6.pack(frame(spark, rows, clash=True).repartition(5), capacity).cache()
    n, tokens = check_packing(rows, packed, capacity)
    assert n <= 1.1 * tokens / capacity + 2


def test_packing_can_keep_the_tokens(spark):
    rows = [(1, "a b c"), (2, None)]
    got = {r.doc_id: r.ids for r in op6.pack(frame(spark, rows), with_ids=True).collect()}
    assert got[2] == [op6.END] and len(got[1]) == 4


def test_plans_fit_and_are_tight():
    for seed in range(40):
        r = random.Random(seed)
        capacity = r.choice([10, 50, 2048])
        counts = {r.randint(1, capacity): r.randint(1, 9) for _ in range(r.randint(0, 200))}
        filled: dict[int, list] = defaultdict(list)
        for length, runs in op6.plan(counts, capacity).items():
            at = 0
            for since, n, first, offset in runs:
                assert since == at
                at += n
                for k in range(n):
                    filled[first + k].append((offset, length))
            assert at == counts[length]
        for parts in filled.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= capacity
        large = [n for n, c in counts.items() for _ in range(c) if 3 * n > capacity]
        total = sum(n * c for n, c in counts.items())
        least = max(-(-total // capacity), sum(2 * n > capacity for n in large), -(-len(large) // 2))
        assert len(filled) <= 1.25 * least + 1
    assert op6.plan({}) == {}


def test_empty_tables(spark):
    empty = frame(spark, [], clash=True)
    assert op4.digests(op4.encode(empty)).count() == 0
    assert op9.token_counts(empty).count() == 0
    assert op6.pack(empty).count() == 0


def test_counts_of_one_row_in_many_tasks(spark):
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text")).repartition(7)
    rows = op6.pack(docs).collect()
    assert {(r.sequence_id, r.offset) for r in rows} == {(0, 4 * k) for k in range(40)}
