"""Token counts of a word-level BPE, with very long texts counted in overlapping chunks.

A text of up to CHUNK characters is counted where it is read, each different
word of a task once. A longer one is
cut into overlapping chunks, each encoded with offsets. Neighbours are spliced
at the first stable boundary that both have in their overlap: a token that
starts with an ASCII character after an ASCII space. Normalisation, special
strings and words all stop at such a place. Where there is none, chunk and
overlap are widened for that text until the chunks meet or one holds it whole.

Defined results: a null text counts as empty and has no tokens. Words of more than
LONG_WORD characters are counted and not remembered, so that texts without spaces
don't fill a task's memory. Repeated rows
each give a row. An empty table gives no rows. Columns other than id and text
are not looked at.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.llm import chunks
from txnlake.llm.common import map_arrow, portions, stored, texts

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
LIMIT = 2048
#: A task remembers the counts of words of up to LONG_WORD characters, with KNOWN_CHARS in all.
LONG_WORD, KNOWN_CHARS = 64, 8_000_000
#: By how much chunks and overlaps grow where neighbours don't meet.
WIDEN = 8


@cache
def tokenizer(path: str):
    """The library's tokenizer, once per process, on the task's own thread only."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Known:
    """Tokens by word, as far as they are remembered."""

    def __init__(self, path: str):
        self.tokenizer, self.counts, self.chars = tokenizer(path), {}, 0

    def count(self, words: list[str]) -> list[int]:
        """Tokens of different words."""
        new = [w for w in words if w not in self.counts]
        found = dict(zip(new, map(len, self.tokenizer.encode_batch_fast(new, add_special_tokens=False)), strict=True))
        out = [found[w] if w in found else self.counts[w] for w in words]
        short = {w: n for w, n in found.items() if len(w) <= LONG_WORD}
        self.chars += sum(map(len, short))
        if self.chars > KNOWN_CHARS:
            self.counts, self.chars = {}, 0
        else:
            self.counts.update(short)
        return out


def count_texts(column: pa.Array, known: Known) -> np.ndarray:
    """Tokens of each text, as the sum over its words.

    An ASCII space is never part of a token or of a special string, and neither
    normalisation nor the split into words looks across one.
    """
    split = pc.ascii_split_whitespace(pc.fill_null(column.cast(pa.string()), ""))
    coded = split.flatten().dictionary_encode()
    words = coded.dictionary.to_pylist()
    of_word = np.array(known.count(words), dtype=np.int64)
    upto = np.r_[0, np.cumsum(of_word[coded.indices.to_numpy()])] if words else np.zeros(1, dtype=np.int64)
    ends = np.cumsum(pc.list_value_length(split).to_numpy())
    return np.diff(np.r_[0, upto[ends]])


def _counts(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(path)
        for batch in portions(batches):
            column = batch.column(1)
            n_bytes = pc.fill_null(pc.binary_length(column), 0).cast(pa.int64())
            n_tokens = pa.array(count_texts(column, known), pa.int64())
            columns = [batch.column(0), n_bytes, n_tokens]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_tokens"])

    return count


def stable_starts(body: str, starts: list[int]) -> list[int]:
    """Token starts with an ASCII character behind an ASCII space."""
    return [x for x in starts if x and body[x - 1] in " \n\t\r" and "!" <= body[x] <= "~"]


def _chunk_tokens(path: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, "body"):
            rows = batch.to_pydict()
            # Of a chunk that is the whole text, the number of tokens is all that is needed.
            whole = [at == 0 and last for at, last in zip(rows["start"], rows["last"], strict=True)]
            found = [
                (tokenizer(path).encode_batch_fast if only else tokenizer(path).encode_batch)([body], add_special_tokens=False)[0]
                for body, only in zip(rows["body"], whole, strict=True)
            ]
            n_tokens = [len(x) for x in found]
            starts = [[] if only else [a for a, _ in x.offsets] for x, only in zip(found, whole, strict=True)]
            stable = [
                [at + x for x in stable_starts(body, own)]
                for at, body, own in zip(rows["start"], rows["body"], starts, strict=True)
            ]
            starts = [[at + x for x in own] for at, own in zip(rows["start"], starts, strict=True)]
            kept = [batch.column(batch.schema.get_field_index(n)) for n in ("uid", "k", "start", "last")]
            sizes, ints = pa.array([len(x) for x in rows["body"]], pa.int32()), pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*kept, sizes, pa.array(n_tokens, pa.int64()), pa.array(starts, ints), pa.array(stable, ints)],
                names=["uid", "k", "start", "last", "size", "n_tokens", "starts", "stable"],
            )

    return encode


def _spliced_counts(long: DataFrame, path: str) -> DataFrame:
    """uid and n_tokens of texts longer than a chunk."""
    chunk, overlap, done = chunks.CHUNK, chunks.OVERLAP, []
    left = long
    while True:
        encoded = map_arrow(
            chunks.overlapping(left, chunk, overlap),
            _chunk_tokens(path),
            "uid bigint, k int, start int, last boolean, size int, n_tokens bigint, starts array<int>, stable array<int>",
        )
        own = F.filter("starts", lambda x: (x >= F.col("since")) & (x < F.col("upto")))
        met = stored(
            chunks.spliced(encoded)
            .withColumn("n", F.when((F.col("k") == 0) & F.col("last"), F.col("n_tokens")).otherwise(F.size(own)))
            .groupBy("uid")
            .agg(F.min("whole").alias("whole"), F.sum("n").alias("n_tokens")),
            "chunk-counts",
        )
        done.append(met.filter("whole").select("uid", "n_tokens"))
        if met.filter("not whole").isEmpty():
            break
        left = left.join(met.filter("not whole").select("uid"), "uid", "left_semi")
        chunk, overlap = chunk * WIDEN, overlap * WIDEN
    total = done[0]
    for more in done[1:]:
        total = total.unionByName(more)
    return total


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit: a row per document."""
    rows = texts(docs)
    is_long = F.coalesce(F.char_length("text") > chunks.CHUNK, F.lit(False))
    short = map_arrow(rows.filter(~is_long), _counts(vocabulary), "doc_id bigint, n_bytes bigint, n_tokens bigint")
    # Stored, so that the row numbers stay what they are when a task is repeated.
    long = stored(rows.filter(is_long).withColumn("uid", F.monotonically_increasing_id()), "long-texts")
    counted = long.join(_spliced_counts(long, vocabulary), "uid").select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "n_tokens"
    )
    return short.unionByName(counted).withColumn("over_limit", F.col("n_tokens") > limit)
