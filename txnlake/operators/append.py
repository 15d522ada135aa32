"""Sinks: the tables, the optional rejects, and outgoing messages."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.functions.text import json_row
from txnlake.operators.summarise import by_hour, by_user
from txnlake.schemas import BATCH, DAY, DETECTED_DAY, SOURCE
from txnlake.session import hadoop_path, remove_dir, table_writes
from txnlake.settings import Tables
from txnlake.sources.tables import (
    CLUSTER_BY,
    MERGED,
    Layout,
    anomalies_layout,
    by_hour_layout,
    by_user_layout,
    partition_path,
    partitions,
    scan,
    transactions_layout,
)

Partition = tuple[date, str]


def checked_batch(batch: str) -> str:
    """A batch's name is part of a path."""
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch):
        raise ValueError(f"a batch name is letters, digits, '_', '.' and '-', not {batch!r}")
    return batch


def lay_out(rows: DataFrame, table: Layout) -> DataFrame:
    """Bring rows of one partition, type and status together, sorted for block skipping.

    `rebalance` leaves the number and size of the output tasks to adaptive
    execution: it splits a group that is too large for one task and merges small
    ones, so one heavy day or type neither stalls a task nor scatters files.
    """
    together = [name for name in CLUSTER_BY if name in table.cluster_by]
    return (
        rows.select(*table.stored)
        .hint("rebalance", table.day, BATCH, *together)
        .sortWithinPartitions(table.day, BATCH, *table.cluster_by)
    )


def insert(rows: DataFrame, table: Layout) -> None:
    """Replace the partitions of a table for which there are rows."""
    with table_writes(rows.sparkSession):
        lay_out(rows, table).write.mode("overwrite").insertInto(table.name)


def drop(spark: SparkSession, table: Layout, which: list[Partition]) -> None:
    """Remove partitions from the catalog, in one step, and then their files."""
    if not which:
        return
    listed = ", ".join(f"PARTITION ({table.day}=DATE'{day.isoformat()}', {BATCH}='{batch}')" for day, batch in which)
    spark.sql(f"ALTER TABLE {table.name} DROP IF EXISTS {listed}")
    for day, batch in which:
        remove_dir(spark, partition_path(table, day, batch))


def days_in(rows: DataFrame, table: Layout) -> set[date]:
    return {r[0] for r in rows.select(table.day).distinct().collect()}  # bounded by the table's days


def merged_without(spark: SparkSession, table: Layout, which: list[Partition]) -> DataFrame:
    """The merged rows of the days, without those that some batches wrote on them."""
    pairs = [f"{day.isoformat()}/{batch}" for day, batch in which]
    merged = scan(spark, table).filter((F.col(BATCH) == MERGED) & F.col(table.day).isin([day for day, _ in which]))
    return merged.filter(~F.concat_ws("/", table.day, SOURCE).isin(pairs))


@contextmanager
def exclusive(spark: SparkSession, table: Layout) -> Iterator[None]:
    """Rewriting merged days is for one run at a time; a file next to them says that one does.

    New batches need none of this: they touch partitions of their own.
    """
    path = f"{table.path}/_rewriting"
    target, fs = hadoop_path(spark, path)
    if not fs.createNewFile(target):
        raise RuntimeError(f"another run rewrites merged days; if none does any more, remove {path}")
    try:
        yield
    finally:
        remove_dir(spark, path)


def _write_table(rows: DataFrame, table: Layout, batch: str, may_repeat: bool) -> None:
    """Write a batch; afterwards the table holds these rows of it and no others.

    Only the batch's own partitions are replaced, and its rows in merged days with
    the same insert, so a batch that runs again after a failure leaves its rows in
    the table once. Partitions for which there are no rows any more are dropped
    after that: a write that fails takes nothing away. A batch that cannot have run
    before needs no look at old partitions.
    """
    spark = rows.sparkSession
    own = rows.withColumn(SOURCE, F.lit(batch)).withColumn(BATCH, F.lit(checked_batch(batch))).select(*table.stored)
    before = partitions(spark, table, batch) if may_repeat else []
    merged: list[Partition] = []
    if may_repeat and partitions(spark, table, MERGED):
        of_batch = scan(spark, table).filter((F.col(BATCH) == MERGED) & (F.col(SOURCE) == batch))
        merged = [(day, batch) for day in sorted(days_in(of_batch, table))]
    if not before and not merged:
        insert(own, table)
        return
    with exclusive(spark, table) if merged else nullcontext():
        now = days_in(own, table)
        rest = merged_without(spark, table, merged) if merged else None
        left = days_in(rest, table) if rest is not None else set()
        insert(own if rest is None else own.unionByName(rest.select(*table.stored)), table)
        gone = [(day, batch) for day, _ in before if day not in now]
        drop(spark, table, gone + [(day, MERGED) for day, _ in merged if day not in left])


def append_transactions(
    transactions: DataFrame, tables: Tables, batch: str, may_repeat: bool = True
) -> None:
    rows = transactions.withColumn(DAY, F.to_date("transaction_timestamp"))
    _write_table(rows, transactions_layout(tables), batch, may_repeat)


def append_anomalies(
    anomalies: DataFrame, tables: Tables, batch: str, may_repeat: bool = True
) -> None:
    rows = anomalies.withColumn(DETECTED_DAY, F.to_date("detected_at"))
    _write_table(rows, anomalies_layout(tables), batch, may_repeat)


def append_summaries(
    transactions: DataFrame, tables: Tables, batch: str, may_repeat: bool = True
) -> None:
    """What a batch's transactions add to the summaries; replaced with the batch."""
    _write_table(by_hour(transactions), by_hour_layout(tables), batch, may_repeat)
    _write_table(by_user(transactions), by_user_layout(tables), batch, may_repeat)


def append_rejects(rejects: DataFrame, path: str, batch: str, may_repeat: bool = True) -> None:
    """Refused lines as files of a folder per batch; a batch that has none any more loses its folder."""
    spark = rejects.sparkSession
    if may_repeat and rejects.isEmpty():
        remove_dir(spark, f"{path}/{BATCH}={checked_batch(batch)}")
        return
    rows = rejects.hint("rebalance").withColumn(BATCH, F.lit(checked_batch(batch)))
    with table_writes(spark):
        rows.write.mode("overwrite").partitionBy(BATCH).parquet(path)


def encode(transactions: DataFrame) -> DataFrame:
    """One JSON message per row in `value`, NULL fields written out."""
    return transactions.select(json_row(transactions).alias("value"))


def publish(transactions: DataFrame, kind: str, target: str, **options: str) -> None:
    """Send rows as messages: `kafka` to a topic, `text` to files of JSON lines."""
    messages = encode(transactions).write.options(**options)
    if kind == "kafka":
        messages.format("kafka").option("topic", target).save()
    elif kind == "text":
        messages.mode("append").text(target)
    else:
        raise ValueError(f"unknown message sink {kind!r}")
