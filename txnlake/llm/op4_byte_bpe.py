"""Byte-level BPE, encoding and decoding.

A text of up to CHUNK characters is encoded where it is read. A longer one is
cut into overlapping chunks that are pre-tokenised in parallel and stitched at
boundaries that neighbours agree on; then the pieces between are encoded and
joined by document. A text without a common boundary in some overlap (a run of
one kind of characters longer than that) is encoded in one piece. Decoding concatenates the bytes of the ids.

Defined results: a null text counts as empty and has no ids; special tokens are
ordinary text. Repeated rows each give a row. An empty table gives no rows.
Columns other than id and text are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import unicodedata
from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.llm import chunks
from txnlake.llm.common import map_arrow, portions, stored, texts

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@cache
def encoding(ranks: str) -> tiktoken.Encoding:
    """The encoder of a rank file, once per process."""
    with open(ranks, "rb") as lines:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(ranks, pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})


@cache
def _pre_tokens() -> regex.Pattern:
    return regex.compile(public_tokenizers.PATTERN)


def _kind(c: str) -> str | None:
    """L, N, or P for all others; S for the spaces of ASCII; None outside scripts whose kinds are settled."""
    if c in " \t\n\r":
        return "S"
    if not ("!" <= c < "\u0370" or "\u3001" <= c < "\ua000" or "\uac00" <= c < "\ud7a4" or "\uff01" <= c < "\uff61"):
        return None
    own = unicodedata.category(c)
    return own[0] if own[0] in "LN" else None if own in ("Cn", "Zs", "Zl", "Zp", "Cc") else "P"


@lru_cache(maxsize=1 << 16)
def _changes(a: str, b: str) -> bool:
    """Whether there is a boundary between two characters wherever they meet."""
    before, after = _kind(a), _kind(b)
    return before not in (None, "S", after) and after is not None and (a != "'" or after == "S")


def stable_cuts(body: str, start: int, last: bool, within: tuple[int, int]) -> list[int]:
    """Pre-token boundaries that no other text around them could move.

    A pre-token is of one kind of characters (letters, numbers, others), but for a
    space in front and for letters behind an apostrophe. So where one kind follows
    another, or a space follows any, what stands on either side is encoded alike
    without the other. A match at the end of a chunk may go on behind it and gives
    no boundary.
    """
    found = []
    for match in _pre_tokens().finditer(body):
        end = match.end()
        if end == len(body) and not last:
            break
        if any(a <= end < b for a, b in (within, (0, chunks.OVERLAP))) and end < len(body):
            if _changes(body[end - 1], body[end]):
                found.append(start + end)
    return found


def _pre_tokenised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.to_pydict()
        cuts = [
            stable_cuts(body, start, last, (chunks.CHUNK, len(body)))
            for body, start, last in zip(rows["body"], rows["start"], rows["last"], strict=True)
        ]
        yield batch.append_column("stable", pa.array(cuts, pa.list_(pa.int32())))


def _encoder(ranks: str, keep: tuple[str, ...]):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoding(ranks)
        for batch in portions(batches):
            column = batch.column(batch.schema.get_field_index("text")).to_pylist()
            ids = [np.array(tokens.encode_ordinary(t or ""), dtype=np.int32) for t in column]
            offsets = np.zeros(len(ids) + 1, dtype=np.int32)
            np.cumsum([len(x) for x in ids], out=offsets[1:])
            values = np.concatenate(ids) if ids else np.zeros(0, dtype=np.int32)
            column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
            kept = [batch.column(batch.schema.get_field_index(n)) for n in keep]
            yield pa.RecordBatch.from_arrays([*kept, column], names=[*keep, "ids"])

    return encode


def encode(docs: DataFrame, ranks: str = RANKS) -> DataFrame:
    """doc_id and ids: the tokens of every text."""
    rows = texts(docs)
    is_long = F.coalesce(F.char_length("text") > chunks.CHUNK, F.lit(False))
    short = map_arrow(rows.filter(~is_long), _encoder(ranks, ("doc_id",)), "doc_id bigint, ids array<int>")
    # Stored, so that the row numbers stay what they are when a task is repeated.
    long = stored(rows.filter(is_long).withColumn("uid", F.monotonically_increasing_id()), "long-texts")
    cut = chunks.overlapping(long, chunks.CHUNK, chunks.OVERLAP)
    pre = map_arrow(
        cut, _pre_tokenised, "uid bigint, k int, start int, last boolean, body string, stable array<int>"
    ).withColumn("size", F.char_length("body"))
    met = stored(chunks.spliced(pre), "chunks")
    part = F.col("body").substr(F.col("since") - F.col("start") + 1, F.col("upto") - F.col("since"))
    parts = met.filter("whole").select("uid", "k", part.alias("text"))
    apart = long.join(met.filter("not whole").select("uid").distinct(), "uid", "left_semi")
    pieces = parts.unionByName(apart.select("uid", F.lit(0).alias("k"), "text"))
    ids = (
        map_arrow(pieces, _encoder(ranks, ("uid", "k")), "uid bigint, k int, ids array<int>")
        .groupBy("uid")
        .agg(F.sort_array(F.collect_list(F.struct("k", "ids"))).alias("parts"))
        .select("uid", F.flatten("parts.ids").alias("ids"))
    )
    return short.unionByName(long.select("uid", "doc_id").join(ids, "uid").select("doc_id", "ids"))


def decoded_bytes(tokens: tiktoken.Encoding, ids: pa.ListScalar) -> bytes:
    return tokens.decode_bytes(ids.values.to_numpy().tolist())


def decode(rows: DataFrame, ranks: str = RANKS) -> DataFrame:
    """doc_id and decoded: the bytes that the ids stand for."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoding(ranks)
        for batch in batches:
            texts = [decoded_bytes(tokens, ids) for ids in batch.column(1)]
            columns = [batch.column(0), pa.array(texts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "decoded"])

    return map_arrow(rows.select("doc_id", "ids"), decoded, "doc_id bigint, decoded binary")


def digests(encoded: DataFrame, ranks: str = RANKS) -> DataFrame:
    """Length and digest of the ids, and digest of the bytes they decode to, per document."""

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoding(ranks)
        for batch in batches:
            out = []
            for ids in batch.column(1):
                of_ids = hashlib.sha256(ids.values.to_numpy().astype("<u4").tobytes()).hexdigest()
                of_text = hashlib.sha256(decoded_bytes(tokens, ids)).hexdigest()
                out.append((len(ids), of_ids, of_text))
            lengths, a, b = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lengths, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_arrow(encoded.select("doc_id", "ids"), digested, schema)
