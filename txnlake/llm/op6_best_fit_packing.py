"""Packing documents into sequences of at most CAPACITY tokens.

Pieces are planned by length alone: there are at most CAPACITY different
lengths, so the plan works on a histogram of that size, whatever the number of
documents. Pieces above a third of the capacity fit at most twice into a
sequence and are matched greedily, the longest first and each with the longest
partner that still fits. Shorter pieces then go, the longest first, into the
smallest remaining gap that holds them, or open a new sequence. The plan says
which ranks among the pieces of a length go where; each piece looks up its own
rank, which comes from counts by task and length, not from a global sort.

Defined results: a null text counts as empty and is a piece of one token, the
end of document. Only a document of more than CAPACITY tokens is cut; its first
piece takes what is over, however long it is. Pieces of equal length are taken in
the order of their ranks, which makes no difference to the number of sequences.
Repeated rows are packed one by one. An empty table
gives no rows. Columns other than id and text are not looked at.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnlake.llm.common import map_arrow, portions, stored, texts
from txnlake.llm.op4_byte_bpe import RANKS, encoding
from txnlake.llm.op9_token_counts import tokenizer

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
CAPACITY = 2048
END = 0

#: Texts of these characters, without a special string, are split and encoded alike
#: by both libraries; the faster one is used for them.
_COMMON = regex.compile(r"[\t\n\r\x20-\x7E¡-ſ‐-‧]*+")

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, place bigint"


def token_ids(column: list[str], vocabulary: str, ranks: str) -> list[np.ndarray]:
    """The ids of each text by the vocabulary's tokenizer, special strings as its default has them."""
    fast = encoding(ranks)
    slow = tokenizer(vocabulary)
    out = []
    for text in column:
        if "<|" not in text and _COMMON.fullmatch(text):
            ids = fast.encode_ordinary(text)
        else:
            ids = slow.encode(text, add_special_tokens=False).ids
        out.append(np.array([*ids, END], dtype="<u4"))
    return out


def cuts(length: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of a document's pieces; the first takes what is over."""
    first = length % capacity or capacity
    starts = [0, *range(first, length, capacity)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], length], strict=True)]


def pieces(
    docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, ranks: str = RANKS, with_ids: bool = False
) -> DataFrame:
    """A row per piece, with its place among the pieces of its length in its task; with_ids: and ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        for batch in portions(batches):
            ids = token_ids([t or "" for t in batch.column(1).to_pylist()], vocabulary, ranks)
            rows, bodies = [], []
            for doc_id, own in zip(batch.column(0).to_pylist(), ids, strict=True):
                for k, (start, length) in enumerate(cuts(len(own), capacity)):
                    body = own[start : start + length]
                    rows.append((doc_id, k, start, length, zlib.crc32(body.tobytes()), part, int(seen[length])))
                    seen[length] += 1
                    bodies.append(body)
            columns = list(zip(*rows, strict=True))
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "place"]
            if with_ids:
                arrays.append(pa.array([b.astype("i4") for b in bodies], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return map_arrow(texts(docs), cut, PIECES + ", ids array<int>" * with_ids)


Run = tuple[int, int, int, int]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> dict[int, list[Run]]:
    """For each length its runs: first rank, pieces of the run, first sequence, offset.

    A run puts one piece into each of so many consecutive sequences, all at the
    same offset. Sequences filled alike are kept as one group, so the work grows
    with the number of lengths, not of pieces.
    """
    left = {n: c for n, c in counts.items() if c}
    runs: dict[int, list[Run]] = defaultdict(list)
    placed: dict[int, int] = defaultdict(int)
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap: groups of first sequence and number
    open_gaps: list[int] = []
    sequences = 0

    def put(length: int, first: int, n: int, offset: int) -> None:
        runs[length].append((placed[length], n, first, offset))
        placed[length] += n
        left[length] -= n
        if not left[length]:
            del left[length]

    def keep(gap: int, first: int, n: int) -> None:
        if gap:
            if not gaps[gap]:
                bisect.insort(open_gaps, gap)
            gaps[gap].append((first, n))

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        length = large[-1]
        if length not in left:
            large.pop()
            continue
        at = bisect.bisect_right(large, capacity - length) - 1
        while at >= 0 and large[at] not in left:
            large.pop(at)
            at -= 1
        partner = large[at] if at >= 0 else None
        if partner == length and left[length] == 1:
            at -= 1
            while at >= 0 and large[at] not in left:
                large.pop(at)
                at -= 1
            partner = large[at] if at >= 0 else None
        if partner is None:
            n = left[length]
        elif partner == length:
            n = left[length] // 2
        else:
            n = min(left[length], left[partner])
        put(length, sequences, n, 0)
        if partner is not None:
            put(partner, sequences, n, length)
        keep(capacity - length - (partner or 0), sequences, n)
        sequences += n

    for length in sorted(left, reverse=True):
        while length in left:
            at = bisect.bisect_left(open_gaps, length)
            if at == len(open_gaps):
                # New sequences, each filled with as many pieces of this length as it holds.
                each = capacity // length
                n = max(1, left[length] // each)
                keep(capacity, sequences, n)
                sequences += n
                continue
            gap = open_gaps[at]
            first, size = gaps[gap].pop()
            if not gaps[gap]:
                open_gaps.pop(at)
            n = min(size, left[length])
            put(length, first, n, capacity - gap)
            keep(gap - length, first, n)
            if size > n:
                keep(gap, first + n, size - n)
    return runs


def _ranked(rows: DataFrame) -> DataFrame:
    """Adds rank, the number of a piece among all of its length, from counts by task."""
    by_part = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        rows.groupBy("length", "part")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("length", "part", F.coalesce(F.sum("n").over(by_part), F.lit(0)).alias("before"))
    )
    return rows.join(before, ["length", "part"]).withColumn("rank", F.col("before") + F.col("place"))


def _placed(runs: dict[int, list[Run]], with_ids: bool):
    table = {n: tuple(np.array(c, dtype=np.int64) for c in zip(*own, strict=True)) for n, own in runs.items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = (batch.column(batch.schema.get_field_index(n)).to_numpy() for n in ("length", "rank"))
            sequence, offset = np.empty(len(ranks), dtype=np.int64), np.empty(len(ranks), dtype=np.int64)
            for n in np.unique(lengths):
                at = np.flatnonzero(lengths == n)
                since, _, first, offsets = table[int(n)]
                run = np.searchsorted(since, ranks[at], side="right") - 1
                sequence[at] = first[run] + ranks[at] - since[run]
                offset[at] = offsets[run]
            kept = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
            columns = [batch.column(batch.schema.get_field_index(n)) for n in kept]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence), pa.array(offset)], names=[*kept, "sequence_id", "offset"]
            )

    return place


def pack(docs: DataFrame, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """A row per piece with the sequence that it goes to and its place there; with_ids: and its tokens."""
    # Stored, so that place and part stay what they are when a task is repeated.
    rows = stored(pieces(docs, capacity, with_ids=with_ids), "pieces")
    # At most one row per length: `capacity` rows.
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    schema += ", ids array<int>" * with_ids + ", sequence_id bigint, offset bigint"
    return map_arrow(_ranked(rows), _placed(plan(counts, capacity), with_ids), schema)
