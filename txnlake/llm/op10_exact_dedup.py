"""Exact deduplication with a heavy-hitter split.

A Misra-Gries sketch finds the digests that many rows may share. Their exact
counts and winners, a bounded number of rows, are broadcast, and their losing
rows are decided where they are read, also those that repeat the winner's id:
of these the one with the largest number in the stored digests wins. All other
digests are shuffled.

Defined results: a null text counts as empty. Of equal texts the row with the
largest id stays; a null id loses against any id. Of rows that repeat with the
same id and text exactly one stays. A text is hashed where it is read, however
long, and never moved. An empty table gives no rows. Columns other
than id and text are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnlake.llm.common import stored, with_row

#: Counters of the sketch. A digest of more than 1 / TRACKED of all rows is found
#: for certain; at most HEAVY digests are broadcast.
TRACKED = 4096
HEAVY = 256

RESULT = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def digests(docs: DataFrame, carry: bool = False) -> DataFrame:
    """doc_id, text_sha256 and a number of the row, `at`; with `carry` also the whole row as `doc`."""
    digest = F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256")
    return with_row(docs).select("doc_id", digest, F.monotonically_increasing_id().alias("at"), *["doc"][: int(carry)])


def heavy_winners(rows: DataFrame) -> DataFrame:
    """The frequent digests with exact row count, largest id and the winner's number: HEAVY rows at most."""
    found = rows.agg(
        F.expr(f"approx_top_k(text_sha256, {HEAVY}, {TRACKED})").alias("top"),
        F.count(F.lit(1)).alias("total"),
    ).first()
    likely = [x["item"] for x in found["top"] or [] if x["count"] * TRACKED >= found["total"]]
    return (
        rows.filter(F.col("text_sha256").isin(likely))
        .groupBy("text_sha256")
        .agg(
            F.max("doc_id").alias("heavy_id"),
            F.max_by("at", F.struct(F.col("doc_id").isNotNull(), "doc_id", "at")).alias("heavy_at"),
            F.count(F.lit(1)).alias("heavy_size"),
        )
        .filter((F.col("heavy_size") > 1) & (F.col("heavy_size") * TRACKED >= F.lit(found["total"])))
    )


def _loses() -> Column:
    """A row of a heavy digest that is not the one winner."""
    return F.col("heavy_size").isNotNull() & (F.col("at") != F.col("heavy_at"))


def _may_win() -> Column:
    """As far as the id tells, which holds without the numbers of the stored rows."""
    return F.col("heavy_size").isNull() | F.col("doc_id").eqNullSafe(F.col("heavy_id"))


def exact_dedup(docs: DataFrame) -> DataFrame:
    """A row per document: RESULT."""
    rows = stored(digests(docs), "digests")
    winners = stored(heavy_winners(rows), "heavy-digests")
    split = rows.join(F.broadcast(winners), "text_sha256", "left")
    lost = split.filter(_loses()).select(
        "doc_id",
        F.col("heavy_id").alias("keep_id"),
        F.col("heavy_size").alias("group_size"),
        F.lit(False).alias("kept"),
        "text_sha256",
    )
    same = Window.partitionBy("text_sha256")
    ranked = (
        split.filter(~_loses())
        .withColumn("keep_id", F.max("doc_id").over(same))
        .withColumn("group_size", F.coalesce("heavy_size", F.count(F.lit(1)).over(same)))
        .withColumn("kept", F.row_number().over(same.orderBy(F.desc_nulls_last("doc_id"))) == 1)
    )
    return ranked.select(*RESULT).unionByName(lost)


def keep_one_copy(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns.

    Rows of heavy digests with a smaller id go before the shuffle; of what is left
    each digest sends at most one row per map task.
    """
    rows = stored(digests(docs), "digests")
    winners = stored(heavy_winners(rows), "heavy-digests")
    whole = digests(docs, carry=True).join(F.broadcast(winners), "text_sha256", "left")
    by_id = F.struct(F.col("doc_id").isNotNull(), F.col("doc_id"))
    return (
        whole.filter(_may_win())
        .groupBy("text_sha256")
        .agg(F.max_by("doc", by_id).alias("doc"))
        .select("doc.*")
    )


ORACLE_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, text_sha256
FROM (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
WINDOW same AS (PARTITION BY text_sha256)
"""
