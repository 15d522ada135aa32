"""Very long texts as overlapping chunks, and the places where neighbours meet.

A chunk's encoder reports its stable boundaries: places of the whole text at
which, by the chunk alone, encoding can be cut without changing a token. Where
two neighbours report the same boundary inside their overlap, the left one is
used before it and the right one from it on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Characters of a chunk, and how far it reaches into its successor.
CHUNK = 65_536
OVERLAP = 2_048


def overlapping(rows: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """uid, k, start, last and body: a row per chunk of each row's text, dealt over all tasks."""
    n = f"cast(ceil(char_length(text) / {chunk}) as int)"
    at = F.expr(f"sequence(0, greatest({n}, 1) - 1)")
    cut = rows.select("uid", "text", F.posexplode(at).alias("k", "_k"), F.expr(f"greatest({n}, 1)").alias("n"))
    start = F.col("k") * chunk
    return cut.select(
        "uid",
        "k",
        start.alias("start"),
        (F.col("k") == F.col("n") - 1).alias("last"),
        F.col("text").substr(start + 1, F.lit(chunk + overlap)).alias("body"),
    ).repartition("uid", "k")


def spliced(encoded: DataFrame) -> DataFrame:
    """Adds since and upto, the part that each chunk stands for, and whole: whether all meet.

    `encoded` has uid, k, start, last, size (characters of the chunk) and stable,
    the chunk's boundaries as places of the whole text.
    """
    in_text = Window.partitionBy("uid").orderBy("k")
    cut = F.array_min(F.array_intersect("stable", F.lag("stable").over(in_text)))
    rows = encoded.withColumn("since", F.when(F.col("k") == 0, 0).otherwise(cut))
    rows = rows.withColumn(
        "upto", F.when(F.col("last"), F.col("start") + F.col("size")).otherwise(F.lead("since").over(in_text))
    )
    everywhere = Window.partitionBy("uid")
    return rows.withColumn("whole", F.min(F.col("since").isNotNull()).over(everywhere))
