"""Language identification of mixed-language texts.

The scripts of a word's letters narrow down the candidate languages. Each word
gets a score per candidate from the character trigrams of the training texts,
and a Viterbi pass over the words, with a penalty for changing the language,
labels spans. A text's language is the one with most letters in its spans.

Defined results: a null text, and one without letters, is `und` with score 0 and
no spans, and so is every text if nothing was learned. Rows without a language
teach nothing. Of languages with equally many letters, and of equal paths, the
first by name counts. A very long text is a portion of its own, and takes memory
for its words. Repeated rows each give a row. An empty table gives no rows.
Columns other than id, text and lang are not looked at; id and lang decide only
what is learned from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlake.llm.common import map_arrow, portions, texts

UNDETERMINED = "und"
#: Training texts per language, on average: the bound of the sample.
SAMPLE = 2_000
#: Buckets into which trigrams are hashed, and the count each starts with.
BUCKETS, SMOOTHING = 1 << 16, 0.5
#: What a change of language costs, and how much one word can say at most (log odds).
SWITCH, MOST = 8.0, 6.0
#: The score of a language that does not use the word's script.
EXCLUDED = -1e6
#: A language uses a script if so large a part of its letters is of it.
USES_SCRIPT = 0.01

#: First code points of scripts that stand in one block or in adjacent ones.
SCRIPTS = {
    "latin": (0x41, 0x250), "greek": (0x370, 0x400), "cyrillic": (0x400, 0x530), "armenian": (0x530, 0x590),
    "hebrew": (0x590, 0x600), "arabic": (0x600, 0x780), "devanagari": (0x900, 0x980), "bengali": (0x980, 0xA00),
    "tamil": (0xB80, 0xC00), "thai": (0xE00, 0xE80), "georgian": (0x10A0, 0x1100), "hangul": (0xAC00, 0xD7B0),
    "kana": (0x3040, 0x3100), "han": (0x3400, 0xA000), "latin_more": (0x1E00, 0x1F00),
}
OTHER = len(SCRIPTS)


@cache
def _letters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each code point: whether it is a letter, its lower case, its script."""
    is_letter = np.array([chr(c).isalpha() for c in range(0x110000)])
    lower = np.arange(0x110000, dtype=np.uint32)
    for c in np.flatnonzero(is_letter):
        small = chr(c).lower()
        if len(small) == 1:
            lower[c] = ord(small)
    script = np.full(0x110000, OTHER, dtype=np.int8)
    for k, (a, b) in enumerate(SCRIPTS.values()):
        script[a:b] = k
    return is_letter, lower, script


@dataclass
class Words:
    """The words of a few texts: a word is a run of letters."""

    text: np.ndarray  # number of the text
    start: np.ndarray  # place in the text
    length: np.ndarray
    script: np.ndarray
    buckets: np.ndarray  # of every trigram, words one behind another
    first: np.ndarray  # of each word among the buckets


def words_of(column: list[str]) -> Words:
    """Words and hashed trigrams; a word of n letters has n of them, edges included."""
    is_letter, lower, script = _letters()
    codes = np.frombuffer("\0".join(["", *column, ""]).encode("utf-32-le"), dtype="<u4")
    begins = np.cumsum([1] + [len(t) + 1 for t in column])[:-1] if column else np.zeros(0, dtype=np.int64)
    letter = is_letter[codes]
    edges = np.diff(letter.astype(np.int8))
    start, end = np.flatnonzero(edges == 1) + 1, np.flatnonzero(edges == -1) + 1
    small = np.where(letter, lower[codes], 0).astype(np.uint64)
    at = np.flatnonzero(letter)
    hashed = small[at - 1] * np.uint64(0x9E3779B1) + small[at] * np.uint64(0x85EBCA77)
    hashed += small[at + 1] * np.uint64(0xC2B2AE3D)
    hashed ^= hashed >> np.uint64(15)
    hashed *= np.uint64(0x2545F4914F6CDD1D)
    length = end - start
    text = np.searchsorted(begins, start, side="right") - 1
    return Words(
        text,
        start - begins[text],
        length,
        script[codes[start]],
        ((hashed >> np.uint64(32)) % np.uint64(BUCKETS)).astype(np.int64),
        np.cumsum(length) - length,
    )


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # bucket, language: log of the trigram's share
    candidate: np.ndarray  # script, language: whether the language uses the script


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def train(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Trigram shares by language from the labelled rows that are not held out.

    Rows are chosen by a hash, about `sample` of each language, whatever the size
    of the table. What reaches the driver is a count per bucket and language.
    """
    labelled = docs.select("doc_id", "text", "lang").filter(
        F.coalesce(~held_out(), F.lit(True)) & F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    # A row per language.
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros((OTHER + 1, 0), dtype=bool))
    share = F.lit(0.0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, sample / n))).otherwise(share)
    chosen = labelled.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share * (1 << 30))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(languages)
        grams, letters = np.zeros((BUCKETS, n), dtype=np.int64), np.zeros((OTHER + 1, n), dtype=np.int64)
        for batch in portions(batches):
            found = words_of(batch.column(0).to_pylist())
            lang = np.array([languages.index(x) for x in batch.column(1).to_pylist()], dtype=np.int64)[found.text]
            np.add.at(letters, (found.script, lang), found.length)
            flat = found.buckets * n + np.repeat(lang, found.length)
            grams += np.bincount(flat, minlength=BUCKETS * n).reshape(BUCKETS, n)
        for kind, table in ((0, grams), (1, letters)):
            key, lang = np.nonzero(table)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(key), kind)), pa.array(key), pa.array(lang), pa.array(table[key, lang])],
                names=["kind", "key", "lang", "n"],
            )

    counted = (
        map_arrow(chosen.select("text", "lang"), count, "kind bigint, key bigint, lang bigint, n bigint")
        .groupBy("kind", "key", "lang")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    kind, key, lang, n = (c.to_numpy() for c in counted.columns)
    grams, letters = np.zeros((BUCKETS, len(languages))), np.zeros((OTHER + 1, len(languages)))
    grams[key[kind == 0], lang[kind == 0]] = n[kind == 0]
    letters[key[kind == 1], lang[kind == 1]] = n[kind == 1]
    scores = np.log(grams + SMOOTHING) - np.log(grams.sum(axis=0) + SMOOTHING * BUCKETS)
    return Model(languages, scores.astype(np.float32), letters >= USES_SCRIPT * np.maximum(letters.sum(axis=0), 1))


def word_scores(found: Words, model: Model) -> np.ndarray:
    """Log odds of each language for each word, against the best one; MOST below it at most.

    Where no language uses a word's script, all of them stay candidates.
    """
    if not len(found.length):
        return np.zeros((0, len(model.languages)), dtype=np.float32)
    total = np.add.reduceat(model.scores[found.buckets], found.first, axis=0)
    fits = model.candidate[found.script]
    fits |= ~fits.any(axis=1, keepdims=True)
    total = np.where(fits, total, -np.inf)
    return np.where(fits, np.maximum(total - total.max(axis=1, keepdims=True), -MOST), EXCLUDED)


def viterbi(scores: np.ndarray, text: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best language of each word, over all texts at once.

    Texts are taken from the longest to the shortest, so that those that still
    have a word at each step stand at the front.
    """
    n, n_langs = scores.shape
    best = np.zeros(n, dtype=np.int64)
    if not n:
        return best
    firsts = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
    lengths = np.diff(np.r_[firsts, n])
    order = np.argsort(-lengths, kind="stable")
    firsts, lengths = firsts[order], lengths[order]
    active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
    came_from = np.zeros((n, n_langs), dtype=np.int16)
    state = scores[firsts].astype(np.float64)
    own = np.arange(n_langs, dtype=np.int16)
    for step in range(1, lengths[0]):
        k = active[step]
        before = state[:k]
        top = before.argmax(axis=1)
        changed = before[np.arange(k), top] - switch
        stays = before >= changed[:, None]
        at = firsts[:k] + step
        came_from[at] = np.where(stays, own, top[:, None])
        state[:k] = np.where(stays, before, changed[:, None]) + scores[at]
    now = state.argmax(axis=1)
    for step in range(lengths[0] - 1, -1, -1):
        k = active[step]
        at = firsts[:k] + step
        best[at] = now[:k]
        now[:k] = came_from[at, now[:k]]
    return best


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))
SCHEMA = "doc_id bigint, lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>"


def label(docs: DataFrame, model: Model) -> DataFrame:
    """Per document its language, the share of its letters labelled so, and the labelled spans.

    A span goes from the first letter of its first word to the end of its last one.
    """

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_langs = len(model.languages)
        for batch in portions(batches):
            rows = batch.num_rows
            found = words_of([t or "" for t in batch.column(1).to_pylist()])
            if n_langs:
                best = viterbi(word_scores(found, model), found.text)
                flat = found.text * n_langs + best
                letters = np.bincount(flat, weights=found.length, minlength=rows * n_langs).reshape(rows, n_langs)
            else:
                found.text, best, letters = found.text[:0], np.zeros(0, dtype=np.int64), np.zeros((rows, 1))
            total = letters.sum(axis=1)
            top = letters.argmax(axis=1)
            score = letters[np.arange(rows), top] / np.maximum(total, 1)
            pred = [model.languages[k] if n else UNDETERMINED for k, n in zip(top, total, strict=True)]
            # A span begins where the text or the language changes.
            text, n = found.text, len(found.text)
            begins = np.flatnonzero(np.r_[True, (text[1:] != text[:-1]) | (best[1:] != best[:-1])]) if n else best
            last = np.r_[begins[1:], n][: len(begins)] - 1
            offsets = np.searchsorted(text[begins], np.arange(rows + 1)).astype(np.int32)
            names = pa.array(model.languages, pa.string()).take(pa.array(best[begins]))
            values = pa.StructArray.from_arrays(
                [
                    pa.array(found.start[begins].astype(np.int32)),
                    pa.array((found.start[last] + found.length[last]).astype(np.int32)),
                    names,
                ],
                fields=list(_SPANS.value_type),
            )
            spans = pa.ListArray.from_arrays(pa.array(offsets), values)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(pred, pa.string()), pa.array(score), spans],
                names=["doc_id", "lang_pred", "score", "spans"],
            )

    return map_arrow(texts(docs), labelled, SCHEMA)


def language_id(docs: DataFrame) -> DataFrame:
    """Learn from the rows not held out and label every row."""
    return label(docs, train(docs)).select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
        F.size("spans").alias("n_spans"),
    )
