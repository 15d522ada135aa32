"""Document fingerprints as threshold-scaled sketches.

A text's fingerprint keeps the hash of every different five-word shingle that
falls below a fixed fraction of all hash values, so its size follows the text's,
and shares of fingerprints estimate shares of the shingles, also between texts
of very different lengths. What one text keeps does not depend on any other,
so fingerprints can be merged and thinned later without the texts. A text of
words without such a hash keeps its smallest one.

A fingerprint is text: eight characters (base 64) for each 48-bit hash, in
ascending order.

Defined results: a null text counts as empty; texts without words have the
empty fingerprint, and two empty ones are alike. Fewer than five words are one
shingle. For the comparison with the next document, a null id stands behind all
others, rows of the same id stand in the order of a hash of their texts, and
equal rows follow each other; a single row follows itself. A very long text is
a portion of its own and takes a few times its bytes. An empty table gives no
rows. Columns other than id and text are not looked at.
"""

from __future__ import annotations

import hashlib
from base64 import b64encode
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlake.llm.common import map_arrow, portions, stored, texts

SHINGLE = 5
#: One of so many hashes is kept.
SCALE = 8
HASH_BITS = 48
#: Characters of a hash in a fingerprint.
WIDTH = 8
#: Of this part of a text's characters the end is replaced, to compare it with an edited one.
EDITED = 3

#: Odd multipliers, one for each place of a shingle, and one for shorter texts.
_BY_PLACE = np.array(
    [0xA3DA4E166B4389A7, 0x1F16DC43929AF4CB, 0xD8C44E5C0F760285, 0x4FA9D65E2CACCF8B, 0x79DCE6E5FD29F057], np.uint64
)
_SHORT = np.array([0xA24BAED4963EE407], np.uint64)


def _scrambled(x: np.ndarray) -> np.ndarray:
    """48 bits that depend on all 64."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9FB21C651E98DF25)
    return (x ^ (x >> np.uint64(32))) >> np.uint64(64 - HASH_BITS)


def _word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word of all texts, each different one hashed once, and where each text's words begin."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(column))
    words = split.flatten()
    filled = pc.greater(pc.binary_length(words), 0)
    upto = np.r_[0, np.cumsum(filled.to_numpy(zero_copy_only=False))]
    offsets = upto[np.r_[0, np.cumsum(pc.list_value_length(split).to_numpy())]]
    coded = words.filter(filled).dictionary_encode()
    different = coded.dictionary
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w.as_buffer()) for w in different), np.uint64, len(different))
    return hashes[coded.indices.to_numpy()], offsets


def sketches(column: pa.Array, scale: int = SCALE) -> list[np.ndarray]:
    """Each text's kept hashes, ascending. The texts may not be null."""
    words, offsets = _word_hashes(column)
    n_runs = max(len(words) - SHINGLE + 1, 0)
    runs = np.zeros(n_runs, np.uint64)
    for k in range(SHINGLE):
        runs += words[k : k + n_runs] * _BY_PLACE[k]
    runs = _scrambled(runs)
    below = np.flatnonzero(runs < np.uint64((1 << HASH_BITS) // scale))
    kept = runs[below]
    ends = np.maximum(offsets[1:] - SHINGLE + 1, offsets[:-1])
    since, upto = np.searchsorted(below, offsets[:-1]), np.searchsorted(below, ends)
    out = []
    for a, b, i, j in zip(offsets[:-1], offsets[1:], since, upto, strict=True):
        if b - a >= SHINGLE:
            out.append(np.unique(kept[i:j]) if j > i else runs[a : b - SHINGLE + 1].min(keepdims=True))
        elif b > a:
            n = int(b - a)
            out.append(_scrambled((words[a:b] * _BY_PLACE[:n]).sum(keepdims=True) + _SHORT * np.uint64(n)))
        else:
            out.append(words[:0])
    return out


def _packed(sketch: np.ndarray) -> bytes:
    """Six bytes a hash."""
    return sketch.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    whole = np.zeros((len(data) // 6, 8), np.uint8)
    whole[:, 2:] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return whole.reshape(-1).view(">u8").astype(np.uint64)


def written(sketch: np.ndarray) -> str:
    return b64encode(_packed(sketch)).decode()


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint: a row per document. Narrow."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            column = pc.fill_null(batch.column(1), "")
            made = pa.array(map(written, sketches(column)), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), made], names=["doc_id", "fingerprint"])

    return map_arrow(texts(docs), make, "doc_id bigint, fingerprint string")


# --------------------------------------------------------------------------
# Fingerprints as columns: no texts are needed any more.


def hashes_of(fingerprint: Column) -> Column:
    return F.regexp_extract_all(fingerprint, F.lit(f".{{{WIDTH}}}"), F.lit(0))


def containment(part: Column, whole: Column) -> Column:
    """Share of the shingles of one text that the other one has, estimated; null if it has none."""
    own = hashes_of(part)
    return F.size(F.array_intersect(own, hashes_of(whole))) / F.nullif(F.size(own), F.lit(0))


def likeness(one: Column, other: Column) -> Column:
    """Share of the shingles of either text that both have, estimated; 1 for two texts without words."""
    a, b = hashes_of(one), hashes_of(other)
    either = F.size(F.array_union(a, b))
    return F.when(either == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.nullif(either, F.lit(0)))


def merged(rows: DataFrame, by: str, fingerprint: str = "fingerprint", scale: int = SCALE) -> DataFrame:
    """`by` and the fingerprint of each group's texts together, as if of one set of shingles.

    A larger `scale` thins it at the same time, which bounds the result for large
    groups. Each hash of a group is aggregated before it is shuffled.
    """
    if scale < 2:
        raise ValueError("a scale is 2 or more")
    limit = f"{(1 << HASH_BITS) // scale:012X}"
    one = F.explode_outer(hashes_of(F.col(fingerprint))).alias("hash")
    different = rows.select(by, one).groupBy(by, "hash").agg(F.hex(F.unbase64("hash")).alias("value"))
    small = F.col("value") < limit
    return (
        different.groupBy(by)
        .agg(
            F.sort_array(F.collect_list(F.when(small, F.struct("value", "hash")))).alias("kept"),
            F.min(F.when(F.col("value").isNotNull(), F.struct("value", "hash"))).alias("least"),
        )
        .select(
            by,
            F.when(F.size("kept") > 0, F.array_join("kept.hash", ""))
            .otherwise(F.coalesce("least.hash", F.lit("")))
            .alias("fingerprint"),
        )
    )


# --------------------------------------------------------------------------
# Each document against an edited version of itself and against the next one.


def _share(part: int, whole: int, of_nothing: float | None) -> float | None:
    return part / whole if whole else of_nothing


Row = tuple[int | None, str, np.ndarray]
#: A document as it is stored: what its fingerprint and that of the edited text share, and what each has besides.
_STORED = {
    "doc_id": pa.int64(),
    "n_chars": pa.int64(),
    "digest": pa.binary(),
    "shared": pa.binary(),
    "own_only": pa.binary(),
    "edited_only": pa.binary(),
    "near_next": pa.float64(),
    "held_by_next": pa.float64(),
}
_EDGE = {"place": pa.string(), "part": pa.int32(), "text": pa.string()}
_RESULT = {
    "doc_id": pa.int64(),
    "n_chars": pa.int64(),
    "edited_sha256": pa.string(),
    "fingerprint": pa.string(),
    "edited_fingerprint": pa.string(),
    "near_edited": pa.float64(),
    "near_next": pa.float64(),
    "kept_by_edited": pa.float64(),
    "held_by_next": pa.float64(),
}
RESULT = tuple(_RESULT)
_TYPES = {pa.int64(): "bigint", pa.int32(): "int", pa.string(): "string", pa.float64(): "double", pa.binary(): "binary"}


def _ddl(columns: dict[str, pa.DataType]) -> str:
    return ", ".join(f"{name} {_TYPES[kind]}" for name, kind in columns.items())


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by the beginning of the one that follows."""
    n = len(text) // EDITED
    return text[: len(text) - n] + following[:n]


def _compared(pairs: Iterable[tuple[Row, Row]]) -> list[tuple]:
    """Rows of _STORED."""
    pairs = list(pairs)
    changed = [edited(one[1], other[1]) for one, other in pairs]
    out = []
    for (one, other), new, of_new in zip(pairs, changed, sketches(pa.array(changed, pa.string())), strict=True):
        own, following = one[2], other[2]
        shared = np.intersect1d(own, of_new, assume_unique=True)
        parts = (shared, np.setdiff1d(own, shared, assume_unique=True), np.setdiff1d(of_new, shared, assume_unique=True))
        with_next = len(np.intersect1d(own, following, assume_unique=True))
        near_next = _share(with_next, len(own) + len(following) - with_next, 1.0)
        digest = hashlib.sha256(new.encode()).digest()
        out.append((one[0], len(one[1]), digest, *map(_packed, parts), near_next, _share(with_next, len(own), None)))
    return out


def _batch(rows: list[tuple], columns: dict[str, pa.DataType]) -> pa.RecordBatch:
    lists = zip(*rows, strict=True) if rows else [[] for _ in columns]
    arrays = [pa.array(list(x), kind) for x, kind in zip(lists, columns.values(), strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose next row is in the same part; the part's first and last row with their texts."""
    part, last = TaskContext.get().partitionId(), None
    columns = _STORED | _EDGE
    nothing = (None,) * (len(_STORED) - 1)
    for batch in portions(batches):
        column = pc.fill_null(batch.column(1), "")
        rows: list[Row] = list(zip(batch.column(0).to_pylist(), column.to_pylist(), sketches(column), strict=True))
        if last is None:
            yield _batch([(rows[0][0], *nothing, "first", part, rows[0][1])], columns)
        else:
            rows = [last, *rows]
        last = rows[-1]
        yield _batch([(*r, None, None, None) for r in _compared(zip(rows[:-1], rows[1:], strict=True))], columns)
    if last is not None:
        yield _batch([(last[0], *nothing, "last", part, last[1])], columns)


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last rows of the parts: doc_id, text and the following text."""
    for batch in portions(batches):
        ids, own, following = batch.column(0).to_pylist(), batch.column(1), batch.column(2)
        pairs = zip(
            zip(ids, own.to_pylist(), sketches(own), strict=True),
            zip(ids, following.to_pylist(), sketches(following), strict=True),
            strict=True,
        )
        yield _batch(_compared(pairs), _STORED)


def _written_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """_RESULT from _STORED."""
    for batch in batches:
        rows = []
        for doc_id, n_chars, digest, *packed, near_next, held in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            shared, own, new = map(_unpacked, packed)
            prints = [written(np.sort(np.r_[shared, x])) for x in (own, new)]
            near = _share(len(shared), len(shared) + len(own) + len(new), 1.0)
            kept = _share(len(shared), len(shared) + len(own), None)
            rows.append((doc_id, n_chars, digest.hex(), *prints, near, near_next, kept, held))
        yield _batch(rows, _RESULT)


def against_next(docs: DataFrame) -> DataFrame:
    """RESULT: a row per document, compared with its edited text and with the next document by descending id.

    Documents are range-partitioned in that order, each text moves once. A task
    passes its rows in order and holds two at a time; the rows on both sides of a
    task's ends, two per task, are then brought together. Equal rows are spread by
    their place in the input.
    """
    spark = docs.sparkSession
    rows = texts(docs).select(
        "doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), F.monotonically_increasing_id().alias("at")
    )
    order = [F.desc_nulls_last("doc_id"), F.desc("h"), F.asc("at")]
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    done = stored(map_arrow(sorted_rows, _neighbours, _ddl(_STORED | _EDGE)), "fingerprints")

    parts = sorted(r.part for r in done.filter("place = 'first'").select("part").collect())  # a number per task
    following = spark.createDataFrame(list(zip(parts, [*parts[1:], *parts[:1]], strict=True)), "part int, following int")
    lasts = done.filter("place = 'last'").select("part", "doc_id", "text")
    firsts = done.filter("place = 'first'").select(F.col("part").alias("following"), F.col("text").alias("following_text"))
    pairs = lasts.join(following, "part").join(firsts, "following").select("doc_id", "text", "following_text")
    every = done.filter("place is null").select(*_STORED).unionByName(map_arrow(pairs, _across, _ddl(_STORED)))
    return map_arrow(every, _written_out, _ddl(_RESULT))
