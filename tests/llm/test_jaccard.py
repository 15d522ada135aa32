"""The Jaccard join against a comparison of all pairs."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.cases import EDGES, components, frame, near_copies, shingles, sorted_rows
from txnlake.llm import components as cc
from txnlake.llm import op3_jaccard_join as op3

RESULT = ("doc_id", "n_shingles", "component_id")


@pytest.mark.parametrize("clash", [False, True])
def test_odd_rows(spark, clash):
    rows = EDGES + [(20, "one two three four"), (21, "ONE two three  FOUR"), (22, "one two three four five")]
    docs = frame(spark, rows, clash)
    assert sorted_rows(op3.jaccard_components(docs), *RESULT) == sorted(components(rows), key=repr)
    kept = op3.keep_one_of_each_component(docs)
    assert kept.columns == docs.columns
    # One of each component, and one of each row without words.
    words = {c for _, n, c in components(rows) if n}
    empty = {(i, t) for i, t in rows if not shingles(t)}
    assert kept.count() == len(words) + len(empty)


@pytest.mark.parametrize("block", [4096, 12])
@pytest.mark.parametrize("seed", [1, 2])
def test_families_of_near_copies(spark, monkeypatch, seed, block):
    monkeypatch.setattr(op3, "BLOCK", block)
    monkeypatch.setattr(op3, "PART", 20 if block < 100 else 1 << 20)
    monkeypatch.setattr(op3, "AT_ONCE", 64 if block < 100 else 1 << 14)
    rows = near_copies(seed)
    got = sorted_rows(op3.jaccard_components(frame(spark, rows)), *RESULT)
    want = sorted(components(rows), key=repr)
    assert got == want
    assert len({c for _, _, c in want}) < len(rows) / 2


def test_links_that_only_the_trees_find(spark, monkeypatch):
    # Without the first comparisons every link has to come from the trees.
    monkeypatch.setattr(op3, "BLOCK", 10)
    rows = near_copies(3, n_bases=4, copies=20)
    calls = []
    links = op3.links

    def no_first(pairs, of):
        calls.append(1)
        return links(pairs.filter("false") if len(calls) == 1 else pairs, of)

    monkeypatch.setattr(op3, "links", no_first)
    assert sorted_rows(op3.jaccard_components(frame(spark, rows)), *RESULT) == sorted(components(rows), key=repr)


@pytest.mark.parametrize("frequent", [0, 1 << 16])
def test_the_order_of_shingles_changes_nothing(spark, monkeypatch, frequent):
    rows = near_copies(4, n_bases=3, copies=15)
    if not frequent:
        monkeypatch.setattr(op3, "frequent_shingles", lambda docs: np.zeros(0, np.uint64))
    assert sorted_rows(op3.jaccard_components(frame(spark, rows)), *RESULT) == sorted(components(rows), key=repr)


def test_ids_that_repeat_with_other_texts(spark):
    rows = [(1, "a b c d e f"), (1, "p q r s t u"), (2, "a b c d e f"), (3, "p q r s t u"), (1, "a b c d e f")]
    assert sorted_rows(op3.jaccard_components(frame(spark, rows)), *RESULT) == sorted(components(rows), key=repr)
    kept = op3.keep_one_of_each_component(frame(spark, rows))
    assert sorted_rows(kept) == [(1, "a b c d e f"), (1, "p q r s t u")]


def test_empty_table(spark):
    empty = frame(spark, [], clash=True)
    assert op3.jaccard_components(empty).count() == op3.keep_one_of_each_component(empty).count() == 0


def test_shingle_sets_have_the_right_sizes():
    rng = random.Random(6)
    texts = [None, "", " a\x0b", "A b a B a b a b", *["".join(rng.choices("aB é\n\t\x1c ", k=rng.randrange(60))) for _ in range(500)]]
    sets = op3.shingle_sets(pa.array(texts))
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    same = {}
    for text, own in zip(texts, sets, strict=True):
        assert same.setdefault(shingles(text), own.tobytes()) == own.tobytes()


def test_trees_keep_every_pair_that_may_link():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 60, size=400).astype(np.uint64)
    sets = []
    for _ in range(150):
        size = rng.integers(150, 400)
        sets.append(np.unique(np.concatenate([rng.choice(base, size, replace=False), rng.integers(0, 1 << 60, size=rng.integers(0, 60)).astype(np.uint64)])))
    n = np.array([len(s) for s in sets])
    order = np.argsort(n)
    sets, n = [sets[k] for k in order], n[order]
    comp = np.arange(len(sets))
    one = op3.tree(op3.folded([op3.bitmap(s) for s in sets]), n, comp)
    found = {(int(a), int(b)) for p, q in op3.dual_traversal(one, one, True) for a, b in zip(p, q, strict=True)}
    linked = set()
    for b in range(len(sets)):
        for a in range(b):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 80 * (n[a] + n[b] - both):
                linked.add((a, b))
    assert linked <= found
    assert all(a < b for a, b in found)
    assert len(found) < len(sets) * (len(sets) - 1) / 2


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 130)] + [(200, 201), (201, 200), (5, 5)]
    got = cc.components(spark.createDataFrame(links, "u long, v long")).collect()
    want = {i: 0 for i in range(1, 41)} | {k: 100 for k in range(101, 130)} | {201: 200}
    assert {r.u: r.v for r in got} == want and len(got) == len(want)
    assert cc.components(spark.createDataFrame([], "u long, v long")).count() == 0
