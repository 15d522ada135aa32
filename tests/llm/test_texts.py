"""Language, licenses and personal data: against plain versions, and held-out rows."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import EDGES, frame, sorted_rows
from txnlake.llm import op1_language_id as op1
from txnlake.llm import op5_license_scan as op5
from txnlake.llm import op8_pii as op8
from txnlake.llm.registry import queries

# Language -------------------------------------------------------------------


def test_held_out_languages(spark):
    got = queries()["op1_language_id"](spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    out = [r for r in rows if r.held_out]
    assert 150 < len(out) < 350
    assert sum(r.lang == r.lang_pred for r in out) / len(out) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def training(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("der hund und die katze", "de"), ("the dog and a cat here", "en"), ("это собака и кошка", "ru")] * 60)]
    rows += [(900, "no label at all", None), (901, None, "en"), (None, "the cat", "en")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_mixed_texts_are_labelled_by_spans(spark):
    model = op1.train(training(spark))
    assert model.languages == ["de", "en", "ru"]
    text = "the dog and a cat here the dog and a cat. Der Hund und die Katze, der Hund und die Katze это"
    got = op1.label(frame(spark, [(1, text)]), model).first()
    assert [text[s.start : s.end].split()[0] for s in got.spans] == ["the", "Der", "это"]
    assert [s.lang for s in got.spans] == ["en", "de", "ru"]
    letters = {s.lang: sum(c.isalpha() for c in text[s.start : s.end]) for s in got.spans}
    assert got.lang_pred == max(letters, key=letters.get)
    assert got.score == pytest.approx(max(letters.values()) / sum(letters.values()))


@pytest.mark.parametrize("clash", [False, True])
def test_language_of_odd_rows(spark, clash):
    docs = frame(spark, EDGES, clash)
    docs = docs if clash else docs.withColumn("lang", F.lit("en"))
    rows = op1.language_id(docs).collect()
    assert len(rows) == len(EDGES)
    texts = dict(EDGES)
    for r in rows:
        if r.doc_id is None:
            continue
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in texts[r.doc_id] or ""))
        assert (r.score == 0) == (r.lang_pred == "und")
    model = op1.Model([], np.zeros((op1.BUCKETS, 0)), np.zeros((op1.OTHER + 1, 0), dtype=bool))
    assert {(r.lang_pred, r.score) for r in op1.label(docs, model).collect()} == {("und", 0.0)}
    assert op1.language_id(docs.filter("false")).count() == 0


def test_prediction_does_not_look_at_id_lang_or_source(spark):
    model = op1.train(training(spark))
    a = op1.label(spark.createDataFrame([(1, "the dog", "de", "x")], "doc_id long, text string, lang string, source string"), model)
    b = op1.label(spark.createDataFrame([(2, "the dog", "ru", "y")], "doc_id long, text string, lang string, source string"), model)
    assert a.drop("doc_id").collect() == b.drop("doc_id").collect()


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(1)
    for _ in range(20):
        lengths = rng.integers(1, 6, size=4)
        text = np.repeat(np.arange(4) * 2, lengths)
        scores = rng.normal(size=(len(text), 3)) * 3
        got = op1.viterbi(scores, text, 2.0)

        def value(path, own):
            return sum(own[i, k] for i, k in enumerate(path)) - 2.0 * sum(a != b for a, b in itertools.pairwise(path))

        for t in np.unique(text):
            own = scores[text == t]
            best = max(value(p, own) for p in itertools.product(range(3), repeat=len(own)))
            assert value(got[text == t], own) == pytest.approx(best)


# Licenses -------------------------------------------------------------------


def scanned(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places, labels = [], set()
    for phrase, label in op5.BASE.items():
        parts = phrase.split()
        found = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
        places += found
        labels |= {label} if found else set()
    ends = (min(places), max(places)) if places else (None, None)
    return (len(words), len(places), *ends, ",".join(sorted(labels)))


@pytest.mark.parametrize("clash", [False, True])
def test_base_phrases(spark, clash):
    rng = random.Random(2)
    vocabulary = ["gnu", "General", "public", "LICENSE", "apache", "cc", "BY", "mit", "é", "x9", ",", "-", "\n", "nc"]
    rows = EDGES + [(500 + i, rng.choice(["", " "]).join(rng.choices(vocabulary, k=60))) for i in range(50)]
    rows += [(600 + i, " ".join(rng.choices(vocabulary, k=200))) for i in range(50)]
    rows += [(700, "CC-BY cc by, MIT\nLicense; the GNU General Public License (gnu general public license)")]
    got = op5.license_scan(frame(spark, rows, clash)).collect()
    want = sorted([(i, *scanned(t)) for i, t in rows], key=repr)
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]
    assert sorted((tuple(r[n] for n in names) for r in got), key=repr) == want
    for r in got:
        assert 0 <= r.score < 1 or r.score == 1
        labels = [x for x in r.labels.split(",") if x]
        assert labels == sorted(set(labels)) and set(filter(None, r.base_labels.split(","))) <= set(labels)
    assert op5.license_scan(frame(spark, [], clash)).count() == 0


@pytest.mark.parametrize(
    ("text", "labels", "asks"),
    [
        ("MIT", {"mit"}, 1),
        ("MIT OR GPL-3.0-only", {"mit", "gpl"}, 1),
        ("MIT AND GPL-3.0-only", {"mit", "gpl"}, 3),
        ("MIT OR Apache-2.0 AND GPL-2.0", {"mit", "apache", "gpl"}, 1),
        ("(MIT OR Apache-2.0) AND GPL-2.0", {"mit", "apache", "gpl"}, 3),
        ("GPL-2.0 WITH Classpath-exception-2.0 and mit", {"gpl", "mit"}, 2),
        ("LicenseRef-Odd-Id", {"licenseref-odd-id"}, 3),
        ("DocumentRef-a.b:LicenseRef-c OR MIT", {"documentref-a.b:licenseref-c", "mit"}, 1),
        ("MIT OR Odd-Id", {"mit"}, 1),
        ("MIT AND Odd-Id", {"mit"}, 3),
        ("GPL-2.0-only WITH unheard-of-exception", {"gpl"}, 3),
        ("GPL-2.0+ WITH GCC-exception-2.0 OR GPL-2.0", {"gpl"}, 2),
        ("GPL-2.0-with-classpath-exception", {"gpl"}, 2),
        ("GPLv3 AND LGPL-2.1+ AND AGPL-3.0-or-later", {"gpl", "lgpl", "agpl"}, 3),
        ("Apache-2.0+ OR BSD-3-Clause-LBNL OR 0BSD", {"apache", "bsd", "0bsd"}, 0),
        ("CC-BY-NC-SA-4.0", {"cc-by-nc-sa"}, 3),
        ("CC-BY-NC-ND-3.0-IGO AND CC-BY-SA-2.5 AND CC-BY-3.0-US", {"cc-by-nc-nd", "cc-by-sa", "cc-by"}, 3),
        ("CC0-1.0 OR Unlicense", {"public-domain"}, 0),
        ("MITRE", set(), 3),
        ("iscsi", set(), 3),
        ("mplus", set(), 3),
        ("Unlicensed", set(), 3),
        ("see file", set(), 3),
        ("GPL-2.0-onlyx", set(), 3),
        ("MIT OR", {"mit"}, 1),
        ("(MIT", set(), 0),
        (") MIT", set(), 0),
        ("", set(), 0),
    ],
)
def test_expressions(text, labels, asks):
    assert op5.evaluate(op5.to_rpn(text)) == (labels, asks)


def test_tags_add_labels():
    n, starts, base, labels, score, asks = op5.scan("// SPDX-License-Identifier: (LGPL-2.1 OR MIT)\nMIT License")
    assert (base, labels, asks) == ("mit", ["lgpl", "mit"], 1) and starts == [n - 2]
    assert op5.scan("SPDX-License-Identifier:")[3] == []
    assert op5.scan("All rights reserved.")[3] == ["all-rights-reserved"]


NAMES = ["MIT", "GPL-2.0-only", "Apache-2.0", "CC-BY-SA-4.0", "LicenseRef-x.y", "see", "MITRE", "ISC", "LGPL-2.1+"]
LABELS = ["mit", "gpl", "apache", "cc-by-sa", "licenseref-x.y", None, None, "isc", "lgpl"]


def expression(rng, depth=3):
    """An expression and the labels in it."""
    kind = rng.random()
    if depth == 0 or kind < 0.3:
        k = rng.randrange(len(NAMES))
        return NAMES[k], {LABELS[k]} - {None}
    if kind < 0.4:
        k = rng.randrange(5)
        return f"{NAMES[k]} WITH {rng.choice(['LLVM-exception', 'other-one'])}", {LABELS[k]}
    (a, x), (b, y) = expression(rng, depth - 1), expression(rng, depth - 1)
    return (f"({a} {rng.choice(['OR', 'and'])} {b})" if kind < 0.7 else f"{a} {rng.choice(['or', 'AND'])} {b}"), x | y


def test_whole_labels(spark):
    """The column of all labels by plain searches: phrases word by word, tags by how they were made."""
    rng = random.Random(6)
    phrases = [*op5.BASE.items(), *op5.NOTICES.items()]
    filler = ["Lorem", "license", "public", "domain", "cc", "by", "nc", "the", "MIT", "gnu"]
    rows, want = [], {}
    for i in range(200):
        tags, labels = [], set()
        for _ in range(rng.randrange(3)):
            text, found = expression(rng)
            tags.append(f"// SPDX-License-Identifier: {text}\n")
            labels |= found
        notice = [rng.choice(phrases)[0].title()] if rng.random() < 0.3 else []
        text = " ".join(rng.choices(filler, k=rng.randrange(30)) + notice) + "\n" + "".join(tags)
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())
        joined = " " + " ".join(words) + " "
        want[i] = ",".join(sorted(labels | {label for phrase, label in phrases if f" {phrase} " in joined}))
        rows.append((i, text))
    assert {r.doc_id: r.labels for r in op5.license_scan(frame(spark, rows)).collect()} == want


# Personal data --------------------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, text):
    digits = [int(c) for c in text if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "card":
        total = 0
        for i, d in enumerate(reversed(digits)):
            d = d * 2 if i % 2 else d
            total += d - 9 if d > 9 else d
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return True


def plain_spans(text):
    return {k: [m.span() for m in re.finditer(p, text) if passes(k, m[0])] for k, p in PLAIN.items()}


def test_entities_of_random_texts():
    rng = random.Random(9)
    parts = ["a.b", "@", "x-y", ".", "1", "22", "255", "256", "4111 1111 1111 1111", "+1 (555) 123-4567", " ", "-", "_", "%", "é", "10.0.0.1", "00.1.2.3"]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randrange(14)))
        assert op8.entities(text) == plain_spans(text), text


@pytest.mark.parametrize("clash", [False, True])
def test_pii_of_odd_rows(spark, clash):
    rows = [*EDGES, (800, "1" * 5000), (801, "9." * 3000), (802, "+" * 3000), (803, "a@b.c_d@e.f")]
    got = {}
    for r in op8.pii(frame(spark, rows, clash)).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == len(rows)
    for doc_id, text in rows:
        spans = plain_spans(text or "")
        written = ",".join(f"{k}:{a}:{b}" for k, own in spans.items() for a, b in own)
        counts = [len(own) for own in spans.values()]
        digest = hashlib.sha256(written.encode()).hexdigest()
        assert any(
            [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts and r.base_sha256 == digest and r.spans.startswith(written)
            for r in got[doc_id]
        )
    docs = frame(spark, rows, clash)
    clean = op8.sanitise(docs)
    assert clean.columns == docs.columns and clean.count() == len(rows)
    assert not any("me@example.com" in (r.text or "") for r in clean.collect())
    assert op8.pii(docs.filter("false")).count() == op8.sanitise(docs.filter("false")).count() == 0


def corpus():
    rng = random.Random(5)
    filler = lambda n: " ".join(rng.choice(["the", "a", "tree", "house", "runs", "blue", "sky"]) for _ in range(n))
    rows = [(i, f"{filler(30)}.") for i in range(200)]
    rows += [(300 + i, f"{filler(20)} Operator Zanzibar, me{i}@example.com {filler(20)}") for i in range(12)]
    rows += [(400 + i, f"{filler(20)} me{i}@example.org {filler(20)}") for i in range(8)]
    rows += [(500, f"zanzibar {filler(9)}")]
    return rows


def test_revealing_terms(spark):
    """Whole documents count, however far a term stands from an address, and every place is changed."""
    rows = corpus()
    docs = frame(spark, rows)
    found = op8.found(docs).cache()
    got = {(r.kind, r.term): r.disclosure for r in op8.disclosures(found, op8.document_frequencies(docs)).collect()}
    assert got["email", "operator"] == 1.0 and op8.GENERALISE < got["email", "zanzibar"] < 1.0
    p, holds = 20 / len(rows), 13
    assert got["email", "zanzibar"] == pytest.approx(1 - math.log(12 / holds) / math.log(p))

    texts = dict(sorted_rows(op8.sanitise(docs), "doc_id", "text"))
    assert "Operator" not in texts[300]
    spans = {r.doc_id: r.spans for r in op8.pii(docs).collect()}
    at = dict(rows)[300].index("Operator")
    assert f"term:{at}:{at + 8}" in spans[300]
    assert "term" not in spans[400]


def test_emails_equal_the_pattern():
    pattern = re.compile(op8.PATTERNS["email"])
    rng = random.Random(2)
    for n in range(20_000):
        text = "".join(rng.choice("ab.@@-_% 1é") for _ in range(rng.randint(0, 24)))
        assert op8.emails(text) == [m.span() for m in pattern.finditer(text)], text


@pytest.mark.parametrize(
    "text",
    ["x" * 5_000_000 + "@", "@" + "x" * 5_000_000, "a@" + "b-" * 2_500_000, "a@b." * 1_250_000, "@" * 5_000_000, "a.b-" * 1_250_000 + "@c.d"],
)
def test_emails_take_time_that_grows_with_the_text(text):
    started = time.monotonic()
    op8.entities(text)
    assert time.monotonic() - started < 20


def test_a_kind_that_all_documents_hold_reveals_nothing(spark):
    rows = [(i, "write to me@example.com now") for i in range(9)]
    assert all("term" not in r.spans for r in op8.pii(frame(spark, rows)).collect())


def test_overlapping_spans_are_replaced_once():
    # What a second span has beyond the first goes too.
    assert op8.cleaned("abcdef", [(1, 4, "X"), (2, 3, "Y"), (3, 5, "Z")]) == "aXf"
    assert op8.cleaned("abcdef", [(1, 3, "X"), (4, 5, "Y")]) == "aXdYf"
    assert op8.cleaned("abcdef", []) == "abcdef"
