"""Fill-in-middle: against its definition, its SQL is compared in test_native."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from tests.llm.cases import EDGES, frame
from txnlake.llm import op12_fill_in_middle as op12

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")
ALPHABET = ["a", "Zb", "é", "日", "😀", " ", "\n", "0", "<", "P", ">", "<P>", "@", "[", "`", "{", "\x7f", "\x80", "\0", "Ⅷ"]


def plain(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    units = UNIT.findall(text)
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < 20:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def random_rows(seed, n=400):
    rng = random.Random(seed)
    return [(i, "".join(rng.choice(ALPHABET) for _ in range(rng.choice([0, 1, 2, 7, 8, 9, 40])))) for i in range(n)]


@pytest.mark.parametrize("clash", [False, True])
def test_outputs(spark, clash):
    rows = [*EDGES, *random_rows(1), *[(None, "<S"), (-7, "a<<P")], *[(70 + i, "ab cd ef gh") for i in range(200)]]
    found = op12.fill_in_middle(frame(spark, rows, clash))
    got = sorted((tuple(r) for r in found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output").collect()), key=repr)
    assert got == sorted((plain(*r) for r in rows), key=repr)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    texts = found.select("doc_id", op12.restored().alias("text")).collect()
    assert sorted((tuple(r) for r in texts), key=repr) == sorted(((i, t or "") for i, t in rows), key=repr)


def test_ranks_and_selections():
    """Marks of single words and words in a row, at every place, over more than one slice."""
    rng = random.Random(3)
    text = "".join(rng.choice(ALPHABET) for _ in range(3000))
    data = np.frombuffer(text.encode(), np.uint8)
    for at_once in (1, 2, 1 << 17):
        op12.AT_ONCE, before = at_once, op12.AT_ONCE
        try:
            units, chars = op12.marked(data, np.array([len(data)]))
        finally:
            op12.AT_ONCE = before
        ends = np.cumsum([len(u.encode()) for u in UNIT.findall(text)])
        assert (units.select(np.arange(len(ends))) + 1 == ends).all()
        assert (units.rank(np.arange(len(data) + 1)) == np.searchsorted(ends, np.arange(len(data) + 1), "right")).all()
        starts = np.cumsum([0, *[len(c.encode()) for c in text]])[:-1]
        assert (chars.rank(starts) == np.arange(len(starts))).all()


def test_very_long_texts(spark):
    rows = [(1, "word" * 2_500_000), (2, "日本" * 1_700_000), (3, "a b\n" * 2_500_000)]
    got = sorted(tuple(r) for r in op12.digests(frame(spark, rows)).collect())
    for (doc_id, n, form, prefix, middle, output, restored), row in zip(got, rows, strict=True):
        want = plain(*row)
        assert (doc_id, n, form, prefix, middle) == want[:5]
        assert output == hashlib.sha256(want[5].encode()).hexdigest()
        assert restored == hashlib.sha256(row[1].encode()).hexdigest()


def test_empty_table(spark):
    assert op12.digests(frame(spark, [], clash=True)).count() == 0
