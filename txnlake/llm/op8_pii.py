"""Information-theoretic sanitisation of personal data.

Patterns find the protected entities. Corpus co-occurrence then tells how
strongly a term gives an entity away: with p the share of documents that hold an
entity of a kind, and q that share among the documents that hold the term, the
disclosure is 1 - log(q) / log(p), the pointwise mutual information in units of
the entity's own information: 0 if the term says nothing, 1 if it says all.

A term is risky if its disclosure is GENERALISE or more even at the lower end of
the Wilson interval of q, and its count is too high for chance: the Chernoff
bound of the binomial tail under p, times the number of different terms of all
documents, is at most CHANCE.

Terms are judged for the kinds and for each entity value that stands in two
different texts or more. There a term counts where the entity is the nearest one
before or after it, so that a document with many entities gives two pairs a place
and not all pairs. Copies and near copies count once as evidence: a text sets a
bit by its smallest term hash under each of ORDERS orders, and the bits that a
pair has, under the order that gives least, stand for independent texts in the
interval and in the bound (63 at most, which is far beyond what either needs).

Every place of a risky term, in any document, is generalised (a number to its
range, a name to its initial, another word to a placeholder), or removed if the
disclosure itself is REMOVE or more.

Terms are words in lower case, of two characters or more, outside entities.
Words joined by a hyphen, an apostrophe or an underscore are a term together,
and each of them is a term.

Defined results: a null text counts as empty and has no entities. A term that is
risky for several kinds counts with the highest disclosure. Very long texts are
searched in time that grows with their length, each in a portion of its own. A kind that
every document holds carries no information and gives no terms. Equal rows get
equal spans. An empty table gives no rows. Columns other than id and text are
not looked at.
"""

from __future__ import annotations

import hashlib
import math
import re
import string
import unicodedata
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from txnlake.llm.common import map_arrow, portions, stored, texts

#: Fixed kinds and patterns, in the order in which spans are listed. `emails` finds its own without going back.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Characters without which a kind cannot occur.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}

#: Width of the interval around a share, in standard deviations (95 %).
WIDTH = 1.96
#: Terms of a kind that may pass for risky by chance alone.
CHANCE = 0.05
GENERALISE, REMOVE = 0.8, 0.999
#: Odd factors that put 32-bit hashes of terms into different orders.
ORDERS = (1, 0x9E3779B1, 0x85EBCA6B)
#: Counts held by a task before it passes them on, and characters of their terms.
HELD_COUNTS, HELD_CHARS = 250_000, 16_000_000
#: As many risky terms, of so many characters in all, are sent to the tasks; more are joined. It steers work only.
SENT_TERMS, SENT_CHARS = 100_000, 2_000_000
#: Bits of the filter that tells which terms may be risky, a power of two; it steers work only.
FILTER_BITS = 1 << 22

_COMPILED = {kind: re.compile(p) for kind, p in PATTERNS.items()}
_LOCAL = string.ascii_letters + string.digits + "._%+-"
_DOMAIN = re.compile(PATTERNS["email"].partition("@")[2].replace("]+", "]++"))
#: What belongs to a word besides letters and digits: marks, and the joiners of some scripts.
_MARKS = "".join(c for c in map(chr, range(0x20000)) if unicodedata.category(c)[0] == "M") + "\u200c\u200d\U000e0100-\U000e01ef"
_WORD = rf"[^\W_]+(?:[{_MARKS}]+[^\W_]*)*"
_TERM = re.compile(rf"{_WORD}(?:[-'_\u2019\u2010\u2011]{_WORD})*")
_PART = re.compile(_WORD)
#: The same terms, found faster, in texts that hold none of _RARE.
_PLAIN_TERM = re.compile(r"\w+(?:[-'\u2019\u2010\u2011]\w+)*")
_RARE = {c for c in map(chr, [*range(0x20000), *range(0xE0100, 0xE01F0)]) if unicodedata.category(c)[0] == "M"} | {"_", "\u200c", "\u200d"}
Span = tuple[int, int]


def _digits(text: str) -> list[int]:
    return [ord(c) - 48 for c in text if "0" <= c <= "9"]


def luhn(digits: list[int]) -> bool:
    doubled = [d * 2 - 9 * (d > 4) for d in digits[-2::-2]]
    return (sum(digits[-1::-2]) + sum(doubled)) % 10 == 0


CHECKS: dict[str, Callable[[str], bool]] = {
    "email": lambda m: True,
    "ip": lambda m: all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.split(".")),
    "card": lambda m: 13 <= len(d := _digits(m)) <= 19 and luhn(d),
    "phone": lambda m: 9 <= len(_digits(m)) <= 15,
}


def emails(text: str) -> list[Span]:
    """The matches of the email pattern, in time that grows with the text.

    An address has one @. Its local part is what stands before that, back to the
    end of the address before; no character is looked at for two of them.
    """
    out: list[Span] = []
    since, at = 0, text.find("@")
    while at >= 0:
        local = at - since - len(text[since:at].rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if local else None
        if domain:
            out.append((at - local, domain.end()))
        since = domain.end() if domain else at + 1
        at = text.find("@", since)
    return out


def entities(text: str) -> dict[str, list[Span]]:
    """Spans by kind: leftmost, not overlapping within a kind, failing matches dropped."""

    def matches(kind: str, pattern: re.Pattern[str]) -> Iterable[Span]:
        if kind == "email":
            return emails(text)
        return [m.span() for m in pattern.finditer(text) if CHECKS[kind](m[0])]

    return {kind: list(matches(kind, p)) if NEEDS.get(kind, "") in text else [] for kind, p in _COMPILED.items()}


def entity_of(kind: str, match: str) -> int:
    """A 64-bit number for an entity's value, however it is written: letter case and signs between digits do not count."""
    value = match.lower() if kind in ("email", "ip") else "".join(map(str, _digits(match)))
    return int.from_bytes(hashlib.blake2b(f"{kind}:{value}".encode(), digest_size=8).digest(), "big", signed=True)


def signature(terms: Iterable[str]) -> list[int]:
    """A bit under each order for a text with these terms; near copies mostly have the same."""
    hashes = [zlib.crc32(term.encode()) for term in terms]
    return [1 << min((h * order) % 2**32 for h in hashes) % 63 for order in ORDERS]


def generalised(word: str) -> str:
    """A number becomes the range of its first digit, a word that begins with a capital its initial, others a placeholder."""
    if word.isdecimal() and word.isascii():
        step = 10 ** (len(word) - 1)
        first = int(word[0]) * step
        return f"{first}-{first + step - 1}"
    return f"{word[0]}." if word[0].isupper() else "[term]"


def _covered(spans: Iterable[Span]) -> tuple[list[int], list[int]]:
    """Starts and ends of the parts of a text that some span covers."""
    starts: list[int] = []
    ends: list[int] = []
    for start, end in sorted(spans):
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends


def _term_pattern(text: str) -> re.Pattern[str]:
    return _PLAIN_TERM if _RARE.isdisjoint(text) else _TERM


def places(text: str, covered: tuple[list[int], list[int]]) -> Iterator[tuple[str, int, int]]:
    """Terms that overlap no covered part, with their starts and ends."""
    starts, ends = covered
    for match in _term_pattern(text).finditer(text):
        at, word = match.start(), match[0]
        spans = [(0, len(word))]
        parts = [m.span() for m in _PART.finditer(word)]
        if len(parts) > 1:
            spans += parts
        for a, b in spans:
            # The last entity that begins before the term's end is the one that could reach into it.
            k = bisect_left(starts, at + b) - 1
            if b - a > 1 and (k < 0 or ends[k] <= at + a):
                yield word[a:b].lower(), at + a, at + b


def terms_in(text: str, covered: tuple[list[int], list[int]]) -> set[str]:
    """The different terms of `places`."""
    if covered[0]:
        return {term for term, _, _ in places(text, covered)}
    words = set(_term_pattern(text).findall(text))
    words |= {part for word in words if not word.isalnum() for part in _PART.findall(word)}
    return {word.lower() for word in words if len(word) > 1}


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
_PLACES = pa.list_(pa.struct([("term", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
_TERMS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("disclosure", pa.float64())]))
TERM = "struct<start:int,end:int,disclosure:double>"
FOUND = "doc_id bigint, digest string, spans array<struct<kind:string,start:int,end:int>>, entities array<bigint>"
BESIDE = f"entity bigint, term string, n bigint, {', '.join(f'b{k} bigint' for k in range(len(ORDERS)))}"
MARKED = "doc_id bigint, digest string, places array<struct<term:string,start:int,end:int>>"


def _all(own: dict[str, list[Span]]) -> tuple[list[int], list[int]]:
    return _covered(s for of_kind in own.values() for s in of_kind)


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def found(docs: DataFrame, risky: dict[str, float] | None = None) -> DataFrame:
    """Per document its digest, spans and different entities: FOUND; given terms to change, also `terms`, their places."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            column = [text or "" for text in batch.column(1).to_pylist()]
            owns = [entities(text) for text in column]
            spans = [
                [{"kind": k, "start": a, "end": b} for k, of_kind in own.items() for a, b in of_kind] for own in owns
            ]
            values = [
                sorted({entity_of(k, text[a:b]) for k, of_kind in own.items() for a, b in of_kind})
                for text, own in zip(column, owns, strict=True)
            ]
            columns = [
                batch.column(0),
                pa.array(map(_digest, column), pa.string()),
                pa.array(spans, _SPANS),
                pa.array(values, pa.list_(pa.int64())),
            ]
            if risky is not None:
                at = [_places_of(text, own, risky) for text, own in zip(column, owns, strict=True)]
                columns.append(pa.array(at, _TERMS))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "digest", "spans", "entities", "terms"][: len(columns)])

    return map_arrow(texts(docs), find, FOUND if risky is None else f"{FOUND}, terms array<{TERM}>")


def document_frequencies(docs: DataFrame) -> DataFrame:
    """term, df: the number of documents that hold it, and n_<kind>: of those, the ones with such an entity."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        together: dict[str, Counter[str]] = {kind: Counter() for kind in PATTERNS}

        def out() -> pa.RecordBatch:
            numbers = [held.values(), *[[of_kind[t] for t in held] for of_kind in together.values()]]
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), *[pa.array(list(n), pa.int64()) for n in numbers]],
                names=["term", "df", *[f"n_{kind}" for kind in together]],
            )

        for batch in portions(batches):
            for text in batch.column(1).to_pylist():
                own = entities(text or "")
                terms = terms_in(text or "", _all(own))
                held.update(terms)
                for kind, spans in own.items():
                    if spans:
                        together[kind].update(terms)
            if len(held) > HELD_COUNTS or sum(map(len, held)) > HELD_CHARS:
                yield out()
                for counts in (held, *together.values()):
                    counts.clear()
        if held:
            yield out()

    numbers = ["df", *[f"n_{kind}" for kind in PATTERNS]]
    counts = map_arrow(texts(docs), count, f"term string, {', '.join(f'{n} bigint' for n in numbers)}")
    return counts.groupBy("term").agg(*[F.sum(n).alias(n) for n in numbers])


def counted(frequencies: DataFrame) -> tuple[DataFrame, int, int]:
    """The terms that stand with any kind, the number of all terms, and of those in two documents or more."""
    seen = Observation()
    total = F.count(F.lit(1)).alias("terms"), F.count_if(F.col("df") > 1).alias("twice")
    any_kind = " + ".join(f"n_{k}" for k in PATTERNS)
    held = stored(frequencies.observe(seen, *total).filter(f"{any_kind} > 0"), "frequencies")
    return held, seen.get["terms"], seen.get["twice"]


def _judged(pairs: DataFrame, hypotheses: int) -> DataFrame:
    """`disclosure` and its lower end `least` of the pairs that are beyond chance, from the shares p and q and the trials behind q."""
    q, base, trials = F.col("q"), F.col("p"), F.col("trials")
    square = WIDTH * WIDTH
    spread = WIDTH * F.sqrt(q * (1 - q) / trials + square / (4 * trials * trials))
    low = (q + square / (2 * trials) - spread) / (1 + square / trials)
    rest = F.when(q < 1, (1 - q) * F.log((1 - q) / (1 - base))).otherwise(0.0)
    bound = math.log(max(hypotheses, 1) / CHANCE)
    beyond_chance = (base < 1) & (q > base) & (trials * (q * F.log(q / base) + rest) >= bound)
    return pairs.filter(beyond_chance).select(
        "*", (1 - F.log(q) / F.log(base)).alias("disclosure"), (1 - F.log(low) / F.log(base)).alias("least")
    )


def _by_kind(rows: DataFrame, held: DataFrame, n_terms: int) -> DataFrame:
    n_docs = rows.count()
    of_kind = rows.select(F.explode(F.array_distinct(F.col("spans.kind"))).alias("kind")).groupBy("kind")
    p = {r["kind"]: r["n"] / n_docs for r in of_kind.agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per kind
    by_kind = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"n_{k}").alias("n")) for k in PATTERNS])
    share = F.coalesce(*[F.when(F.col("kind") == k, F.lit(x)) for k, x in p.items() if x < 1], F.lit(None))
    pairs = held.select("term", "df", F.inline(by_kind)).filter("n > 0").withColumn("p", share.cast("double"))
    pairs = pairs.filter("p IS NOT NULL").withColumns({"q": F.col("n") / F.col("df"), "trials": F.col("df")})
    return _judged(pairs, n_terms).select("kind", "term", "disclosure", "least")


def disclosures(rows: DataFrame, frequencies: DataFrame) -> DataFrame:
    """kind, term, disclosure and its lower end `least`, where a term stands with a kind more often than by chance."""
    held, n_terms, _ = counted(frequencies)
    return _by_kind(rows, held, n_terms)


def repeated(rows: DataFrame) -> DataFrame:
    """entity and n_docs, of the entities that stand in two different texts or more."""
    of_entity = rows.select("digest", F.explode("entities").alias("entity")).groupBy("entity")
    counts = of_entity.agg(F.count(F.lit(1)).alias("n_docs"), F.min("digest").alias("a"), F.max("digest").alias("b"))
    return counts.filter("a < b").select("entity", "n_docs")


def neighbours(text: str, own: dict[str, list[Span]]) -> set[tuple[int, str]]:
    """(entity, term) where the entity is the nearest before or after a place of the term."""
    marks = sorted((a, b, k) for k, of_kind in own.items() for a, b in of_kind)
    starts, values = [a for a, _, _ in marks], [entity_of(k, text[a:b]) for a, b, k in marks]
    out = set()
    for term, _, end in places(text, _all(own)):
        k = bisect_left(starts, end)
        out.update((value, term) for value in values[max(k - 1, 0) : k + 1])
    return out


def beside(docs: DataFrame, maybe: bytes) -> DataFrame:
    """BESIDE: per entity that passes the filter and term next to it, the documents and the bits of their texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = zlib.decompress(maybe)
        held: dict[tuple[int, str], list[int]] = {}
        chars = 0

        def out() -> pa.RecordBatch:
            entity, term = zip(*held, strict=True)
            numbers = [pa.array(column, pa.int64()) for column in zip(*held.values(), strict=True)]
            return pa.RecordBatch.from_arrays(
                [pa.array(entity, pa.int64()), pa.array(term, pa.string()), *numbers],
                names=["entity", "term", "n", *[f"b{k}" for k in range(len(ORDERS))]],
            )

        for batch in portions(batches):
            for text in batch.column(1).to_pylist():
                own = entities(text or "")
                values = {entity_of(k, text[a:b]) for k, of_kind in own.items() for a, b in of_kind}
                values = {v for v in values if _passes(bits, str(v))}
                if not values:
                    continue
                pairs = {pair for pair in neighbours(text, own) if pair[0] in values}
                marks = signature(terms_in(text, _all(own))) if pairs else []
                for pair in pairs:
                    if pair not in held:
                        held[pair] = [0] * (1 + len(ORDERS))
                        chars += len(pair[1])
                    numbers = held[pair]
                    numbers[0] += 1
                    for k, mark in enumerate(marks, 1):
                        numbers[k] |= mark
                if len(held) > HELD_COUNTS or chars > HELD_CHARS:
                    yield out()
                    held, chars = {}, 0
        if held:
            yield out()

    bits = [f"b{k}" for k in range(len(ORDERS))]
    counts = map_arrow(texts(docs.filter(F.lit(bool(maybe)))), count, BESIDE)
    return counts.groupBy("entity", "term").agg(F.sum("n").alias("n"), *[F.bit_or(b).alias(b) for b in bits])


def entity_disclosures(docs: DataFrame, rows: DataFrame, held: DataFrame, n_twice: int) -> DataFrame:
    """entity, term, disclosure and `least`, where a term stands next to one entity more often than by chance.

    Chance counts the terms of two documents or more with the entities of two texts or more.
    """
    known = stored(repeated(rows), "repeated")
    maybe = _filter(known.select(F.col("entity").cast("string").alias("term")))
    independent = F.least(*[F.bit_count(f"b{k}") for k in range(len(ORDERS))])
    pairs = beside(docs, maybe).withColumn("m", independent).filter("m > 1")
    q = F.col("n") / F.col("df")
    pairs = pairs.join(known, "entity").join(held.select("term", "df"), "term")
    pairs = pairs.withColumns({"p": F.col("n_docs") / F.lit(rows.count()), "q": q, "trials": F.col("m") / q})
    return _judged(pairs, n_twice * known.count()).select("entity", "term", "disclosure", "least")


def _filter(risky: DataFrame) -> bytes:
    """A bit for each hash that a risky term has, packed; empty if there is none."""
    slot = F.crc32(F.encode("term", "UTF-8")) % FILTER_BITS + 1
    packed = (
        risky.select(slot.alias("slot"))
        .groupBy(F.expr("bitmap_bucket_number(slot)").alias("k"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(slot))").alias("bits"))
        .collect()  # of 4 KB each, FILTER_BITS in all
    )
    bits = bytearray(FILTER_BITS // 8 if packed else 0)
    for r in packed:
        bits[(r["k"] - 1) * len(r["bits"]) : r["k"] * len(r["bits"])] = r["bits"]
    return zlib.compress(bits) if packed else b""


def _passes(bits: bytes, term: str) -> bool:
    slot = zlib.crc32(term.encode()) % (8 * len(bits))
    return bool(bits[slot >> 3] >> (slot & 7) & 1)


def marked(docs: DataFrame, maybe: bytes) -> DataFrame:
    """Per document that holds any, all places of terms that pass the filter: MARKED."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = zlib.decompress(maybe)
        for batch in portions(batches):
            rows = []
            for doc_id, text in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                covered = _all(entities(text or ""))
                terms = {t for t in terms_in(text or "", covered) if _passes(bits, t)}
                if terms:
                    at = [{"term": t, "start": a, "end": b} for t, a, b in places(text, covered) if t in terms]
                    rows.append((doc_id.as_py(), _digest(text), at))
            if rows:
                ids, digests, at = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(digests, pa.string()), pa.array(at, _PLACES)],
                    names=["doc_id", "digest", "places"],
                )

    return map_arrow(texts(docs.filter(F.lit(bool(maybe)))), mark, MARKED)


def risky_terms(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What `found` gives, and the terms to change with their disclosure."""
    rows = stored(found(docs), "entities")
    held, n_terms, n_twice = counted(document_frequencies(docs))
    of_kinds, of_entities = _by_kind(rows, held, n_terms), entity_disclosures(docs, rows, held, n_twice)
    columns = ["term", "disclosure", "least"]
    judged = of_kinds.select(columns).unionAll(of_entities.select(columns)).filter(F.col("least") >= GENERALISE)
    return rows, stored(judged.groupBy("term").agg(F.max("disclosure").alias("disclosure")), "terms")


def _sent(risky: DataFrame) -> dict[str, float] | None:
    """The risky terms, if they are few and short enough for each task to hold them all."""
    size = risky.agg(F.count(F.lit(1)).alias("n"), F.sum(F.char_length("term")).alias("chars")).first()
    if size["n"] > SENT_TERMS or (size["chars"] or 0) > SENT_CHARS:
        return None
    return {r["term"]: r["disclosure"] for r in risky.collect()}  # SENT_TERMS at most


def _places_of(text: str, own: dict[str, list[Span]], risky: dict[str, float]) -> list[dict]:
    """Places of risky terms in order: start, end, disclosure."""
    covered = _all(own)
    if not risky or risky.keys().isdisjoint(terms_in(text, covered)):
        return []
    at = sorted((a, b, risky[t]) for t, a, b in places(text, covered) if t in risky)
    return [{"start": a, "end": b, "disclosure": d} for a, b, d in at]


def _joined_places(docs: DataFrame, risky: DataFrame) -> DataFrame:
    """Per document that holds any, the terms to change, by a join: no task holds all terms."""
    # The filter lets some other terms pass; the join does not.
    return (
        marked(docs, _filter(risky))
        .select("doc_id", "digest", F.inline("places"))
        .join(risky, "term")
        .groupBy("doc_id", "digest", "start", "end")
        .agg(F.max("disclosure").alias("disclosure"))
        .groupBy("doc_id", "digest")
        .agg(F.sort_array(F.collect_list(F.struct("start", "end", "disclosure"))).alias("terms"))
    )


def _with_terms(rows: DataFrame, terms: DataFrame) -> DataFrame:
    named = terms.select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), "terms")
    same = (F.col("digest") == F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    return rows.join(named, same, "left").drop("_id", "_digest")


def _written(spans: Column) -> Column:
    """kind:start:end of each, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def all_spans(docs: DataFrame) -> DataFrame:
    """What `found` gives, with the terms to change: start, end, disclosure; null or empty if there are none."""
    rows, risky = risky_terms(docs)
    sent = _sent(risky)
    if sent is None:
        return _with_terms(rows, _joined_places(docs, risky))
    if not sent:
        return rows.withColumn("terms", F.lit(None).cast(f"array<{TERM}>"))
    return found(docs, sent)


def pii(docs: DataFrame) -> DataFrame:
    """A row per document: entities by kind, their digest, and all spans with the terms to change."""
    term = F.transform(
        F.coalesce("terms", F.array()),
        lambda t: F.struct(F.lit("term").alias("kind"), t["start"].alias("start"), t["end"].alias("end")),
    )
    number = [F.size(F.expr(f"filter(spans, s -> s.kind = '{k}')")).cast("long").alias(f"n_{k}") for k in PATTERNS]
    return all_spans(docs).select(
        "doc_id",
        *number,
        F.sha2(_written(F.col("spans")), 256).alias("base_sha256"),
        _written(F.concat("spans", term)).alias("spans"),
    )


def cleaned(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each span replaced; of overlapping ones the first and longest counts."""
    out, at = [], 0
    for start, end, mark in sorted(spans, key=lambda s: (s[0], -s[1])):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame) -> DataFrame:
    """All documents with their columns; entities and revealing terms in the texts are replaced.

    A null text stays null.
    """
    _, risky = risky_terms(docs)
    sent = _sent(risky)
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("doc")
    if sent is None:
        digest = F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest")
        rows = docs.select("doc_id", "text", digest, rest)
        rows = _with_terms(rows, _joined_places(docs, risky)).select("text", "doc", "terms")
    else:
        rows = docs.select("text", rest)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            out = []
            joined = batch.column(2).to_pylist() if sent is None else [None] * batch.num_rows
            for text, of_doc in zip(batch.column(0).to_pylist(), joined, strict=True):
                own = entities(text or "")
                at = _places_of(text or "", own, sent) if sent is not None else of_doc or []
                spans = [(a, b, f"[{k}]") for k, of_kind in own.items() for a, b in of_kind]
                for t in at:
                    a, b = t["start"], t["end"]
                    spans.append((a, b, generalised(text[a:b]) if t["disclosure"] < REMOVE else ""))
                out.append(text if text is None else cleaned(text, spans))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), batch.column(1)], names=["text", "doc"])

    schema = f"text string, doc {rows.schema['doc'].dataType.simpleString()}"
    cleaned_rows = map_arrow(rows, clean, schema)
    return cleaned_rows.select(
        *[F.col("text") if c == "text" else F.col("doc").getField(c).alias(c) for c in docs.columns]
    )
