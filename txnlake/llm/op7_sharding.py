"""Sharding by weighted rendezvous hashing.

Each record's key gets a score for every shard, from a hash of both and the
shard's weight, and goes to the shard with the highest one. A further shard can
only win records for itself and changes nothing between the others; about its
share of the weight moves. Slots number the records of a shard without a gap:
each task counts its own, and counts by task and shard say where it starts, so
no shard is sorted or gathered in one place.

Defined results: a null text counts as empty. A record without an id goes where
all of these go. Of shards with equal scores the one with the largest number wins.
A text is measured where it is read, however long, and never moved. Repeated rows
are told apart by their slots. An empty table
gives no rows. Columns other than id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnlake.llm.common import map_arrow, stored, texts, with_row

SHARDS = 8
LAW = "key"


def rendezvous(key: str, weights: Sequence[float]) -> Column:
    """The shard of a key. With u uniform in (0, 1), weight / -ln(u) is highest in proportion to weight."""
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a weight above 0")
    scores = []
    for shard, weight in enumerate(weights):
        bits = F.shiftrightunsigned(F.xxhash64(F.col(key), F.lit(shard)), 11)
        uniform = (bits.cast("double") + 0.5) / float(1 << 53)
        scores.append(F.struct((F.lit(float(weight)) / -F.ln(uniform)).alias("score"), F.lit(shard).alias("shard")))
    if len(scores) == 1:
        return F.lit(0)
    return F.greatest(*scores)["shard"]


def _numbered(n_shards: int):
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(n_shards, dtype=np.int64)
        for batch in batches:
            shards = batch.column(batch.schema.get_field_index("shard")).to_numpy()
            place = np.empty(len(shards), dtype=np.int64)
            for shard in np.unique(shards):
                at = np.flatnonzero(shards == shard)
                place[at] = seen[shard] + np.arange(len(at))
                seen[shard] += len(at)
            parts = pa.array(np.full(len(shards), part, dtype=np.int32))
            yield batch.append_column("part", parts).append_column("place", pa.array(place))

    return number


def shard(docs: DataFrame, weights: Sequence[float] = (1.0,) * SHARDS, further: float | None = 1.0) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard: a row per document.

    `further` is the weight of one more shard, for grown_shard; null without it.
    """
    weights = list(weights)
    text = F.coalesce("text", F.lit(""))
    grown = rendezvous("doc_id", [*weights, further]) if further else F.lit(None)
    rows = texts(docs).select(
        "doc_id",
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        rendezvous("doc_id", weights).alias("shard"),
        grown.cast("int").alias("grown_shard"),
    )
    schema = "doc_id bigint, size bigint, text_crc32 bigint, shard int, grown_shard int, part int, place bigint"
    # Stored, so that part and place stay what they are when a task is repeated.
    numbered = stored(map_arrow(rows, _numbered(len(weights)), schema), "shards")
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        numbered.groupBy("shard", "part")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("shard", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    )
    return numbered.join(before, ["shard", "part"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        (F.col("before") + F.col("place")).alias("slot"),
        "grown_shard",
    )


def write_shards(docs: DataFrame, path: str, weights: Sequence[float] = (1.0,) * SHARDS) -> None:
    """The documents with all their columns as files, in a folder `shard=<n>` for each shard.

    Each task writes its rows of a shard into a file of its own, so a shard may
    be of any size.
    """
    names = [c for c in docs.columns if c != "shard"]
    placed = with_row(docs).select(rendezvous("doc_id", list(weights)).alias("shard"), "doc")
    placed.select("shard", *[F.col("doc").getField(n).alias(n) for n in names]).write.partitionBy("shard").parquet(path)
