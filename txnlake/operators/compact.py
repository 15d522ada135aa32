"""Merging the batches of closed days into few large files, by plain partition overwrite.

A day's batches are read and inserted as the day's one merged partition; then
their own partitions are dropped. Each row keeps the name of its batch, so a
batch that runs again is taken out of the merged rows (`append`). Between the two
steps, readers see the rows of these days twice, and so they do if a merge stops
there, until the next one: a batch's own partition then counts, and its rows among
the merged ones are replaced.

New batches may arrive while days are merged. A batch that runs again meanwhile
is noticed by its files: its partition stays, and its rows are taken out again.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from txnlake.functions.clock import utc_now
from txnlake.operators.append import Partition, days_in, drop, exclusive, insert, merged_without
from txnlake.schemas import BATCH, SOURCE
from txnlake.session import hadoop_path
from txnlake.settings import Tables
from txnlake.sources.tables import MERGED, Layout, layouts, partition_path, partitions, scan


def compact(spark: SparkSession, tables: Tables, before: date | None = None) -> int:
    """Merge each day before `before` (default: today) that has several partitions; number of merges."""
    before = before or utc_now().date()
    return sum(merge_days(spark, table, before) for table in layouts(tables))


def _files(spark: SparkSession, table: Layout, which: list[Partition]) -> dict[Partition, set[str]]:
    found = {}
    for day, batch in which:
        target, fs = hadoop_path(spark, partition_path(table, day, batch))
        found[day, batch] = {x.getPath().getName() for x in fs.listStatus(target)} if fs.exists(target) else set()
    return found


def merge_days(spark: SparkSession, table: Layout, before: date) -> int:
    """Merge the table's days before `before` in one job; the number of days merged."""
    of_day: dict[date, list[str]] = {}
    for day, batch in partitions(spark, table):
        if day < before:
            of_day.setdefault(day, []).append(batch)
    of_day = {day: batches for day, batches in of_day.items() if len(batches) > 1}
    if not of_day:
        return 0
    own = [(day, b) for day, batches in of_day.items() for b in batches if b != MERGED]
    with exclusive(spark, table):
        seen = _files(spark, table, own)
        pairs = [f"{day.isoformat()}/{b}" for day, b in own]
        days = [f"{day.isoformat()}/{MERGED}" for day, batches in of_day.items() if MERGED in batches]
        rows = scan(spark, table).filter(F.concat_ws("/", table.day, BATCH).isin(pairs + days))
        # A batch's own rows are newer than its merged ones.
        rows = rows.filter((F.col(BATCH) != MERGED) | ~F.concat_ws("/", table.day, SOURCE).isin(pairs))
        insert(rows.withColumn(BATCH, F.lit(MERGED)), table)
        now = _files(spark, table, own)
        changed = [p for p in own if now[p] != seen[p]]
        drop(spark, table, [p for p in own if p not in changed])
        if changed:
            _take_out(spark, table, changed)
    return len(of_day)


def _take_out(spark: SparkSession, table: Layout, which: list[Partition]) -> None:
    """Remove from merged days the rows of batches that have been written anew."""
    rest = merged_without(spark, table, which)
    left = days_in(rest, table)
    insert(rest, table)
    drop(spark, table, [(day, MERGED) for day in sorted({d for d, _ in which}) if day not in left])
