"""Randomly damaged lines against a model of the rules in plain Python."""

from __future__ import annotations

import json
import math
import random

from tests.conftest import line
from txnlake.operators import ingest
from txnlake.schemas import PAYLOAD, required

ALPHABET = "{}[]\",:0123456789eE+-. \t\r\\'nulltrefasu/*\ufeff\u2028\x0b"
STAMP = json.loads(line())["transaction_timestamp"]


def damage(rng: random.Random, text: str) -> str:
    for _ in range(rng.choice((1, 1, 1, 2, 3))):
        at = rng.randrange(len(text) + 1)
        to = min(len(text), at + rng.choice((1, 1, 2, 8, 40)))
        text = rng.choice(
            (
                text[:at] + rng.choice(ALPHABET) + text[at:],
                text[:at] + rng.choice(ALPHABET) + text[at + 1 :],
                text[:at] + text[to:],
                text[:at] + text[at:to] * 2 + text[to:],
                text[:at],
                text + rng.choice(ALPHABET),
                rng.choice(ALPHABET) + text,
                text + rng.choice(("", ",", "]", "],", ",null],[", " ")) + line(),
            )
        )
    return text


def refuse(token: str):
    raise ValueError(token)


def expected(text: str) -> str | None:
    """The class, or None where it hangs on reading a damaged timestamp."""
    try:
        fields = json.loads(text, parse_constant=refuse)
    except ValueError:
        return "parse_failed"
    if not isinstance(fields, dict):
        return "parse_failed"
    names = required(PAYLOAD)
    if not set(names) <= set(fields):
        return "missing_fields"
    amount = fields["amount"]
    number = isinstance(amount, (int, float)) and not isinstance(amount, bool)
    if number and amount <= 0:
        return "non_positive_amount"
    if not number or math.isinf(float(amount)) or any(fields[n] is None for n in names):
        return "bad_value"
    return "ok" if fields["transaction_timestamp"] == STAMP else None


def test_damaged_lines(spark):
    rng = random.Random(20240131)
    bases = [
        line(),
        line(note={"a": [1, {"b": "}],["}]}, status="x}y"),
        line(amount=-3.5),
        line(amount=None, country=...),
        line(currency=...),
    ]
    texts = sorted({damage(rng, rng.choice(bases)) for _ in range(6000)})
    rows = spark.createDataFrame([(t,) for t in texts], "value string")
    got = {r.value: r.reason for r in ingest.classify(rows).collect()}
    assert len(got) == len(texts)
    wrong = [
        (text, want, got[text])
        for text in texts
        if (want := expected(text)) != got[text]
        and not (want is None and got[text] in ("ok", "bad_value"))
    ]
    assert wrong == []
    counts = [sum(c == kind for c in got.values()) for kind in ("ok", "parse_failed")]
    assert min(counts) > 100
