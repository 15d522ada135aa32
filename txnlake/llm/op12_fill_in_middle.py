"""Fill-in-middle transformation, cutting texts at units found eight bytes at a time.

A unit is a run of ASCII letters or any other character. The UTF-8 of a whole
batch of texts is viewed as 64-bit words. Arithmetic on a word marks the bytes
that end a unit, `bitwise_count` counts them, a search in the running counts
finds the word that holds the k-th end, and a multiplication finds it in there.
No text is split into units. Per document, numbers drawn from a hash of its id
say where it is cut and in which form it is written.

Defined results: a null text counts as empty and stays plain, as does a text
that holds one of the marks. A null id is drawn for as if it were empty text.
Repeated rows are cut alike. A very long text stands in a portion of its own and
takes about four times its bytes. An empty table gives no rows. Columns other
than id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlake.llm.common import map_arrow, portions, texts

SEED = 1
#: Of 100 documents, those that are cut, and of 100 of these, those with the suffix first.
CUT, SUFFIX_FIRST = 90, 20
PLAIN, PSM, SPM = "plain", "psm", "spm"
PREFIX_MARK, SUFFIX_MARK, MIDDLE_MARK = "<P>", "<S>", "<M>"

#: Words that are marked at a time.
AT_ONCE = 1 << 17
_U = np.uint64


def _every_byte(value: int) -> np.uint64:
    return _U(value * 0x0101010101010101)


_HIGH, _LOW = _every_byte(0x80), _every_byte(0x01)


def _letters(words: np.ndarray) -> np.ndarray:
    """The high bit of each byte that is an ASCII letter."""
    low = (words | _every_byte(0x20)) & _every_byte(0x7F)
    from_a, beyond_z = low + _every_byte(0x80 - ord("a")), low + _every_byte(0x80 - ord("z") - 1)
    return from_a & ~beyond_z & ~words & _HIGH


def _continuations(words: np.ndarray) -> np.ndarray:
    """The high bit of each byte that goes on with a character."""
    return words & ~(words << _U(1)) & _HIGH


def _of_next_byte(marks: np.ndarray, after: np.uint64) -> np.ndarray:
    """The marks, each moved to the byte before; `after` is the word behind the last one."""
    return (marks >> _U(8)) | (np.r_[marks[1:], after] << _U(56))


class Marked:
    """Marked bytes of a buffer, with counts and places of them."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        self.before = np.r_[0, np.cumsum(np.bitwise_count(marks), dtype=np.int64)]

    def rank(self, upto: np.ndarray) -> np.ndarray:
        """Marks in front of each byte place."""
        word, byte = upto >> 3, (upto & 7).astype(np.uint64)
        # Numpy shifts by 64 give 0.
        return self.before[word] + np.bitwise_count(self.marks[word] << (_U(64) - _U(8) * byte))

    def select(self, k: np.ndarray) -> np.ndarray:
        """The byte place of the k-th mark, counted from 0."""
        word = np.searchsorted(self.before, k, side="right") - 1
        # Byte i of the product counts the marks in bytes 0 to i.
        counts = ((self.marks[word] >> _U(7)) * _LOW).astype("<u8").view(np.uint8).reshape(-1, 8)
        return word * 8 + (counts <= (k - self.before[word])[:, None]).sum(axis=1)


def marked(data: np.ndarray, ends: np.ndarray) -> tuple[Marked, Marked]:
    """The bytes that end a unit, and those that begin a character; `ends` are the ends of texts with any."""
    n_words = len(data) // 8 + 1
    words = np.zeros(n_words * 8, np.uint8)
    words[: len(data)] = data
    words = words.view("<u8")
    unit_ends, starts = np.empty_like(words), np.empty_like(words)
    for a in range(0, n_words, AT_ONCE):
        own = words[a : a + AT_ONCE]
        behind = words[a + AT_ONCE : a + AT_ONCE + 1] if a + AT_ONCE < n_words else np.zeros(1, "<u8")
        letters, goes_on = _letters(own), _continuations(own)
        next_letter = _of_next_byte(letters, _letters(behind)[0])
        next_goes_on = _of_next_byte(goes_on, _continuations(behind)[0])
        unit_ends[a : a + AT_ONCE] = (letters & ~next_letter) | (~letters & ~next_goes_on & _HIGH)
        starts[a : a + AT_ONCE] = ~goes_on & _HIGH
    unit_ends.view(np.uint8)[ends - 1] = 0x80
    return Marked(unit_ends), Marked(starts)


def _transformed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in portions(batches):
        column = pc.fill_null(batch.column(1).cast(pa.large_string()), "")
        buffer = column.buffers()[2]
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        first, last = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
        raw = memoryview(buffer)[offsets[0] : offsets[-1]] if buffer else memoryview(b"")
        units, chars = marked(np.frombuffer(raw, np.uint8), last[last > first])
        done = units.rank(first)
        n = units.rank(last) - done
        h1, h2, form_draw, order_draw = (batch.column(k).to_numpy() for k in range(2, 6))
        one, other = h1 % (n + 1), h2 % (n + 1)
        cuts = []
        for k in (np.minimum(one, other), np.maximum(one, other)):
            cuts.append(np.where(k > 0, units.select(np.maximum(done + k - 1, 0)) + 1, first) if len(raw) else first)
        has_mark = pc.match_substring_regex(column, "<[PSM]>").to_numpy(zero_copy_only=False)
        plain = (n == 0) | has_mark | (form_draw % 100 >= CUT)
        forms = np.where(plain, PLAIN, np.where(order_draw % 100 < SUFFIX_FIRST, SPM, PSM))
        out = []
        for form, a, b, c, d in zip(forms, first.tolist(), cuts[0].tolist(), cuts[1].tolist(), last.tolist(), strict=True):
            if form == PLAIN:
                out.append(raw[a:d].tobytes())
            elif form == PSM:
                out.append(b"".join((b"<P>", raw[a:b], b"<S>", raw[c:d], b"<M>", raw[b:c])))
            else:
                out.append(b"".join((b"<S>", raw[c:d], b"<P>", raw[a:b], b"<M>", raw[b:c])))
        at = [chars.rank(x) for x in (first, *cuts)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(n),
                pa.array(forms, pa.string()),
                pa.array(at[1] - at[0], mask=plain),
                pa.array(at[2] - at[1], mask=plain),
                pa.array(out, pa.binary()).cast(pa.string()),
            ],
            names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
        )


def draws(seed: int = SEED) -> list[Column]:
    """Four numbers below 2**32 from a hash of the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def fill_in_middle(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output: a row per document. Narrow."""
    rows = texts(docs).select("doc_id", "text", *draws(seed))
    schema = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    return map_arrow(rows, _transformed, schema)


def restored(form: str = "form", output: str = "output") -> Column:
    """The text, from form and output alone: a mark stands in a cut output only where one was put."""
    parts = F.split(F.col(output), "<[PSM]>", -1)
    return (
        F.when(F.col(form) == PSM, F.concat(parts[1], parts[3], parts[2]))
        .when(F.col(form) == SPM, F.concat(parts[2], parts[3], parts[1]))
        .otherwise(F.col(output))
    )


def digests(docs: DataFrame) -> DataFrame:
    """What the query returns: digests in place of outputs and restored texts."""
    return fill_in_middle(docs).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(), 256).alias("restored_sha256"),
    )


ORACLE_SQL = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), drawn AS (
  SELECT *, len(units)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
  FROM cut
), parts AS (
  SELECT doc_id, text, n,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(units[1 : least(h1 % (n + 1), h2 % (n + 1))], '') AS prefix,
         array_to_string(units[least(h1 % (n + 1), h2 % (n + 1)) + 1 : greatest(h1 % (n + 1), h2 % (n + 1))], '') AS middle,
         array_to_string(units[greatest(h1 % (n + 1), h2 % (n + 1)) + 1 :], '') AS suffix
  FROM drawn
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
              WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
