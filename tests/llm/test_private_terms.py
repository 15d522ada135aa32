"""Risky terms in whole texts: op8 and the pipeline against brute force, with terms that are risky."""

from __future__ import annotations

import math
import random
import re

import duckdb
import pytest

import corpus_pipeline
from tests.llm.cases import components, frame, sorted_rows
from tests.llm.test_texts import plain_spans
from tests.llm.test_tokens import check_packing
from txnlake.llm import op8_pii as op8
from txnlake.llm.op2_quality_rules import ORACLE_SQL as QUALITY

JOINED = re.compile(r"[a-z0-9]+(?:[-'_][a-z0-9]+)*", re.IGNORECASE)


def plain_terms(text):
    """(term, start, end) outside entities; for ASCII texts."""
    inside = {k for own in plain_spans(text).values() for a, b in own for k in range(a, b)}
    out = set()
    for m in JOINED.finditer(text):
        for part in [m, *re.compile("[a-z0-9]+", re.IGNORECASE).finditer(text, *m.span())]:
            if len(part[0]) > 1 and not inside & set(range(*part.span())):
                out.add((part[0].lower(), *part.span()))
    return out


def plain_risky(rows):
    """term and disclosure of the terms that are to be changed, from the definition."""
    holds, kinds = {}, {}
    for n, (_, text) in enumerate(rows):
        for kind, own in plain_spans(text).items():
            if own:
                kinds.setdefault(kind, set()).add(n)
        for t, _, _ in plain_terms(text):
            holds.setdefault(t, set()).add(n)
    pairs = [(k, t) for k in kinds for t in holds if holds[t] & kinds[k]]
    out = {}
    for kind, term in pairs:
        p, df, n = len(kinds[kind]) / len(rows), len(holds[term]), len(holds[term] & kinds[kind])
        q = n / df
        if p == 1 or q <= p:
            continue
        z = 1.96
        low = (q + z * z / (2 * df) - z * math.sqrt(q * (1 - q) / df + z * z / (4 * df * df))) / (1 + z * z / df)
        tail = q * math.log(q / p) + ((1 - q) * math.log((1 - q) / (1 - p)) if q < 1 else 0)
        if df * tail >= math.log(len(holds) / 0.05) and 1 - math.log(low) / math.log(p) >= 0.8:
            out[term] = max(out.get(term, 0), 1 - math.log(q) / math.log(p))
    for term, disclosure in plain_risky_by_entity(rows, holds):
        out[term] = max(out.get(term, 0), disclosure)
    return out


def plain_value(kind, match):
    return kind, match.lower() if kind in ("email", "ip") else re.sub("[^0-9]", "", match)


def plain_risky_by_entity(rows, holds):
    """(term, disclosure) for single entities, by looking from each term place to its left and right."""
    docs_of, texts_of, pairs = {}, {}, {}
    for n, (_, text) in enumerate(rows):
        marks = sorted((a, b, plain_value(k, text[a:b])) for k, own in plain_spans(text).items() for a, b in own)
        for *_, value in marks:
            docs_of.setdefault(value, set()).add(n)
            texts_of.setdefault(value, set()).add(text)
        for t, a, b in plain_terms(text):
            for near in ([m for m in marks if m[1] <= a][-1:], [m for m in marks if m[0] >= b][:1]):
                for *_, value in near:
                    pairs.setdefault((value, t), set()).add(n)
    again = {value for value, texts in texts_of.items() if len(texts) > 1}
    hypotheses = len(again) * sum(len(d) > 1 for d in holds.values())
    for (value, term), held in pairs.items():
        bits = zip(*[op8.signature({t for t, _, _ in plain_terms(rows[n][1])}) for n in held], strict=True)
        m = min(len(set(column)) for column in bits)
        p, q = len(docs_of[value]) / len(rows), len(held) / len(holds[term])
        if value not in again or m < 2 or q <= p or p == 1:
            continue
        z, trials = 1.96, m / q
        low = (q + z * z / (2 * trials) - z * math.sqrt(q * (1 - q) / trials + z * z / (4 * trials**2))) / (1 + z * z / trials)
        tail = q * math.log(q / p) + ((1 - q) * math.log((1 - q) / (1 - p)) if q < 1 else 0)
        if trials * tail >= math.log(hypotheses / 0.05) and 1 - math.log(low) / math.log(p) >= 0.8:
            yield term, 1 - math.log(q) / math.log(p)


def plain_general(word):
    if re.fullmatch("[0-9]+", word):
        return f"{word[0]}{'0' * (len(word) - 1)}-{word[0]}{'9' * (len(word) - 1)}"
    return word[0] + "." if "A" <= word[0] <= "Z" else "[term]"


def plain_clean(rows):
    risky = plain_risky(rows)
    out = []
    for doc_id, text in rows:
        spans = [(a, b, f"[{k}]") for k, own in plain_spans(text).items() for a, b in own]
        spans += [(a, b, plain_general(text[a:b]) if risky[t] < 0.999 else "") for t, a, b in plain_terms(text) if t in risky]
        done, at = "", 0
        for a, b, mark in sorted(spans, key=lambda s: (s[0], -s[1])):
            if a >= at:
                done += text[at:a] + mark
            at = max(at, b)
        out.append((doc_id, done + text[at:]))
    return out


def corpus():
    """Names in any distance from addresses, of several shapes, some also where no address is."""
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randint(3, 8))) for _ in range(400)]
    filler = lambda n: " ".join(rng.choice([*words[:20], "the", "and", "of"]) if rng.random() < 0.6 else rng.choice(words) for _ in range(n))
    rows = [(i, f"{filler(90)}.") for i in range(250)]
    rows += [(300 + i, f"Zanzibar {filler(60)} me{i}@example.com {filler(20)} Jean-Luc, O'Hara {filler(9)} agent47.") for i in range(20)]
    rows += [(400 + i, f"{filler(60)} me{i}@example.org {filler(30)}") for i in range(6)]
    rows += [(500, f"{filler(40)} ZANZIBAR/other (zanzibar's) {filler(30)}")]
    return rows


def test_every_place_of_a_risky_term_is_changed(spark):
    rows = corpus()
    risky = plain_risky(rows)
    assert {"zanzibar", "jean-luc", "o'hara", "agent47"} <= set(risky) and risky["zanzibar"] < 0.999 <= risky["agent47"]
    docs = frame(spark, rows)
    texts = dict(sorted_rows(op8.sanitise(docs), "doc_id", "text"))
    assert texts == dict(plain_clean(rows))
    assert "Z./other ([term]'s)" in texts[500]
    assert "jean" not in texts[300].lower() and "agent47" not in texts[300]
    spans = {r.doc_id: r.spans for r in op8.pii(docs).collect()}
    for doc_id, text in rows:
        got = [tuple(map(int, x.split(":")[1:])) for x in spans[doc_id].split(",") if x.startswith("term:")]
        assert got == sorted((a, b) for t, a, b in plain_terms(text) if t in risky)


def test_terms_too_many_to_send_are_joined(spark, monkeypatch):
    rows = corpus()
    sent = sorted_rows(op8.pii(frame(spark, rows)))
    assert any("term:" in r[-1] for r in sent)
    monkeypatch.setattr(op8, "SENT_TERMS", 0)
    assert sorted_rows(op8.pii(frame(spark, rows))) == sent
    assert dict(sorted_rows(op8.sanitise(frame(spark, rows)), "doc_id", "text")) == dict(plain_clean(rows))


def test_filter_only_steers_the_work(spark, monkeypatch):
    rows = corpus()
    monkeypatch.setattr(op8, "SENT_TERMS", 0)
    # So few bits that all terms pass.
    monkeypatch.setattr(op8, "FILTER_BITS", 8)
    monkeypatch.setattr(op8, "_filter", lambda risky: op8.zlib.compress(b"\xff"))
    assert dict(sorted_rows(op8.sanitise(frame(spark, rows)), "doc_id", "text")) == dict(plain_clean(rows))


def test_a_term_seen_once_is_not_judged(spark):
    rows = [(i, f"plain text number{i}") for i in range(3000)] + [(5000, "lonely words at me@example.com")]
    docs = frame(spark, rows)
    assert op8.disclosures(op8.found(docs), op8.document_frequencies(docs)).filter("least >= 0.8").count() == 0


@pytest.mark.parametrize(
    ("text", "terms"),
    [
        ("O'Brien", {"o'brien", "brien"}),
        ("_zanzibar_ “Köln”", {"zanzibar", "köln"}),
        ("a b 7", set()),
        ("हिन्दी ét", {"हिन्दी", "ét"}),
        ("Jean-Luc47 me@example.com x-y", {"jean-luc47", "jean", "luc47", "x-y"}),
    ],
)
def test_terms(text, terms):
    own = op8._all(op8.entities(text))
    assert op8.terms_in(text, own) == {t for t, _, _ in op8.places(text, own)} == terms
    assert op8.terms_in(text + " 10.0.0.1", op8._all(op8.entities(text + " 10.0.0.1"))) == terms


def test_pipeline_changes_every_place(spark, tmp_path):
    rows = [(i, t, "en", "s", len(t)) for i, t in corpus()]
    frame_of = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    frame_of.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    good = con.execute(f"SELECT doc_id, text FROM documents JOIN ({QUALITY}) USING (doc_id) WHERE kept").fetchall()
    latest = {}
    for doc_id, text in good:
        latest[text] = max(latest.get(text, doc_id), doc_id)
    left = sorted((i, t) for t, i in latest.items())
    left = [(i, t) for (i, t), (_, _, least) in zip(left, components(left), strict=True) if i == least]
    assert {"zanzibar", "jean-luc", "agent47"} <= set(plain_risky(left))
    packed = corpus_pipeline.run(spark, str(tmp_path)).cache()
    check_packing(plain_clean(left), packed, 2048)


def people():
    """Names that stand beside one address or number, among many addresses; a text and its near copies with others."""
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randint(3, 7))) for _ in range(300)]
    filler = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(i, f"{filler(70)}.") for i in range(300)]
    rows += [(400 + i, f"{filler(30)} you{i}@example.com {filler(30)}") for i in range(120)]
    rows += [(600 + i, f"{filler(20)} Quentin {filler(9)} Q.Doe@example.com 7731 {filler(9)} you{i}@example.org Otherly{i} {filler(9)}") for i in range(9)]
    rows += [(650, f"{filler(20)} 7731 {filler(9)}")]
    base = f"{filler(40)} Rareword Seldomly {filler(20)}".split()
    for i in range(12):
        # Six of them copies, six with a word changed.
        near = base if i < 6 else [*base[: 3 * i], words[i], *base[3 * i + 1 :]]
        rows.append((700 + i, f"{' '.join(near)} solo@example.net"))
    return rows


def test_a_name_beside_one_address_is_found(spark):
    rows = people()
    risky = plain_risky(rows)
    assert {"quentin", "7731"} <= set(risky) and risky["7731"] < 0.999 <= risky["quentin"]
    # One text and its copies are no evidence.
    assert not {"rareword", "seldomly"} & {t for t, _ in plain_risky_by_entity(rows, plain_holds(rows))}
    docs = frame(spark, rows)
    texts = dict(sorted_rows(op8.sanitise(docs), "doc_id", "text"))
    assert texts == dict(plain_clean(rows))
    assert "Quentin" not in texts[600] and "7000-7999" in texts[650]


def plain_holds(rows):
    holds = {}
    for n, (_, text) in enumerate(rows):
        for t, _, _ in plain_terms(text):
            holds.setdefault(t, set()).add(n)
    return holds


@pytest.mark.parametrize(("word", "less"), [("7", "7-7"), ("1987", "1000-1999"), ("Zoë", "Z."), ("ZOE", "Z."), ("zoe", "[term]"), ("日本", "[term]")])
def test_generalised(word, less):
    assert op8.generalised(word) == less


def test_entities_are_the_same_however_written():
    assert op8.entity_of("card", "4111 1111 1111 1111") == op8.entity_of("card", "4111-1111-1111-1111")
    assert op8.entity_of("email", "Me@Example.com") == op8.entity_of("email", "me@example.com") != op8.entity_of("ip", "me@example.com")
