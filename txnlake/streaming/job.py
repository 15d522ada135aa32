"""The streaming job: messages into the two tables, one micro-batch at a time."""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from txnlake.functions.clock import utc_now
from txnlake.operators import counters, ingest
from txnlake.plans.batch import append_outputs, archive
from txnlake.session import remove_dir, work_dir
from txnlake.settings import DEFAULT_THRESHOLD, Tables
from txnlake.sources.lines import SOURCE_FILE
from txnlake.sources.tables import require_tables

log = logging.getLogger(__name__)

#: The name of the counters in a query's progress.
METRICS = "ingest"
OnCounters = Callable[[str, dict[str, int]], None]


class _AfterCommit(StreamingQueryListener):
    """What follows once Spark has noted a micro-batch as done: its counters are told, its files archived.

    Progress is reported after the commit. A micro-batch that runs again after a
    failure has made no progress before, so it is told once.
    """

    def __init__(self, spark: SparkSession, archive_dir: str | None, on_counters: OnCounters | None):
        self.spark, self.archive_dir, self.on_counters = spark, archive_dir, on_counters
        self.files: dict[str, list[str]] = {}  # by micro-batch of this query
        self.ended: set[str] = set()
        self.changed = threading.Condition()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        name = f"{event.progress.id}-{event.progress.batchId}"
        files = self.files.pop(name, None)
        if files is None:
            return  # another query's, or a trigger without data
        totals = event.progress.observedMetrics.get(METRICS)
        if totals is not None:
            log.info("micro-batch %s finished: %s", name, totals.asDict())
            if self.on_counters:
                self.on_counters(name, totals.asDict())
        if files:
            archive(self.spark, files, f"{self.archive_dir.rstrip('/')}/{name}")

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def wait_for_end(self, run: str, seconds: float) -> bool:
        with self.changed:
            return self.changed.wait_for(lambda: run in self.ended, seconds)


_LISTENERS: dict[str, _AfterCommit] = {}


def run_stream(
    lines: DataFrame,
    tables: Tables,
    checkpoint: str,
    *,
    threshold: float = DEFAULT_THRESHOLD,
    rejects_path: str | None = None,
    available_now: bool = False,
    interval: str | None = None,
    clock: Callable[[], datetime] = utc_now,
    on_counters: OnCounters | None = None,
    archive_dir: str | None = None,
) -> StreamingQuery:
    """Start ingesting `lines` (a streaming `value` column) and return the query.

    Runs until stopped, or with `available_now` until the present input is read.
    A micro-batch is named after the query's id, kept in the checkpoint, and its
    number. One that runs again after a failure therefore replaces its own rows
    in both tables, and a query with a new checkpoint never touches another's.

    Each micro-batch is parsed once, into a work table that every sink reads. Its
    counters are taken along the way, stand in the query's progress as `ingest`, and
    go to the log and to `on_counters` with the name of the micro-batch.

    With `archive_dir`, and lines of `stream_files`, the files of a micro-batch are
    moved there once it is done; files without a line stay. Call `await_end` to wait
    for the last ones.
    """
    spark = lines.sparkSession
    require_tables(spark, tables)
    keep = [SOURCE_FILE] if archive_dir else []
    if keep and SOURCE_FILE not in lines.columns:
        raise ValueError("only a stream of files can be archived")
    done = _AfterCommit(spark, archive_dir, on_counters)
    # Only the first micro-batch of a run can be one that ran before.
    may_repeat = True

    def ingest_batch(flagged: DataFrame, number: int) -> None:
        nonlocal may_repeat
        session = flagged.sparkSession
        query = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not query:
            raise RuntimeError("the query's id is unknown, so its batches cannot be told apart")
        name = f"{query}-{number}"
        run_ts = clock()
        staging = work_dir(session, "micro-batch")
        try:
            flagged.write.parquet(staging)
            staged = session.read.schema(flagged.schema).parquet(staging)
            append_outputs(
                ingest.stamp(staged, run_ts), tables, threshold, run_ts, name, rejects_path, may_repeat
            )
            files = staged.select(*keep).distinct().collect() if keep else []  # bounded by the source
        finally:
            remove_dir(session, staging)
        may_repeat = False
        done.files[name] = [r[0] for r in files]

    # Only refused lines are needed as text again.
    text = F.when(F.col("reason") != ingest.OK, F.col("value"))
    flagged = ingest.flag(ingest.classify(lines, *keep), threshold).withColumn("value", text)
    observed = flagged.observe(METRICS, *counters.expressions())
    writer = observed.writeStream.foreachBatch(ingest_batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    spark.streams.addListener(done)
    try:
        query = writer.start()
    except Exception:
        spark.streams.removeListener(done)
        raise
    _LISTENERS[str(query.runId)] = done
    return query


def await_end(query: StreamingQuery, seconds: float = 120) -> None:
    """Wait until the query has ended and all that follows its last micro-batch is done."""
    listener = _LISTENERS.pop(str(query.runId))
    try:
        query.awaitTermination()
    finally:
        if not listener.wait_for_end(str(query.runId), seconds):
            log.warning("the end of query %s was not reported within %s s", query.id, seconds)
        listener.spark.streams.removeListener(listener)
