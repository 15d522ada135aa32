"""The batch job: files of JSON lines into the two tables."""

from __future__ import annotations

import logging
import uuid
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.functions.clock import utc_now
from txnlake.operators import append, counters, ingest
from txnlake.session import hadoop_path, remove_dir, work_dir
from txnlake.settings import DEFAULT_THRESHOLD, Tables
from txnlake.sources.lines import read_lines
from txnlake.sources.tables import require_tables

log = logging.getLogger(__name__)


def append_outputs(
    enriched: DataFrame,
    tables: Tables,
    threshold: float,
    run_ts: datetime,
    batch: str,
    rejects_path: str | None = None,
    may_repeat: bool = True,
) -> None:
    """Write one enriched collection to its sinks. `enriched` is read once per sink.

    `may_repeat` says that the batch may have been written before, in whole or in part.
    """
    transactions = ingest.valid(enriched)
    found = ingest.extract_anomalies(transactions, threshold, run_ts)
    append.append_transactions(transactions, tables, batch, may_repeat)
    append.append_anomalies(found, tables, batch, may_repeat)
    append.append_summaries(transactions, tables, batch, may_repeat)
    if rejects_path:
        append.append_rejects(ingest.rejects(enriched), rejects_path, batch, may_repeat)


def archive(spark: SparkSession, files: list[str], folder: str) -> None:
    """Move files below `folder`, each under its own full path, so that equal names don't meet."""
    for file in files:
        source, fs = hadoop_path(spark, unquote(file))
        target, _ = hadoop_path(spark, f"{folder}{source.toUri().getPath()}")
        fs.mkdirs(target.getParent())
        if not fs.rename(source, target):
            raise OSError(f"{file} was ingested but could not be moved to {target}")


def run_batch(
    spark: SparkSession,
    input_path: str,
    tables: Tables,
    *,
    threshold: float = DEFAULT_THRESHOLD,
    rejects_path: str | None = None,
    run_ts: datetime | None = None,
    batch: str | None = None,
    archive_dir: str | None = None,
) -> dict[str, int]:
    """Ingest all files that match `input_path` and return the run's counters.

    Each line is parsed once: the outcome is written to a work table in the shared
    folder and every sink reads that. The write has no shuffle, so the counters
    taken along the way are exact, and losing an executor later costs a read of
    columnar files instead of another parse.

    `batch` names the run. Running again under the same name, over the same
    input, replaces what the first attempt wrote.

    With `archive_dir`, the files that were read, and no others, are moved there
    once all sinks are written; a run that fails leaves them where they are. Each
    run has a folder of its own in it, named after the batch.
    """
    require_tables(spark, tables)
    lines = read_lines(spark, input_path)
    if lines is None:
        log.info("no files match %s", input_path)
        return dict.fromkeys(counters.NAMES, 0)

    files = lines.inputFiles() if archive_dir else []
    run_ts = run_ts or utc_now()
    named = batch is not None
    batch = append.checked_batch(batch or str(uuid.uuid4()))
    enriched = ingest.enrich(ingest.classify(lines), threshold, run_ts)
    observed, observation = counters.observe(enriched)
    # Only refused lines are needed as text again.
    text = F.when(F.col("reason") != ingest.OK, F.col("value"))
    staging = work_dir(spark, "staging")
    try:
        observed.withColumn("value", text).write.parquet(staging)
        staged = spark.read.schema(enriched.schema).parquet(staging)
        append_outputs(staged, tables, threshold, run_ts, batch, rejects_path, may_repeat=named)
    finally:
        remove_dir(spark, staging)

    if archive_dir:
        archive(spark, files, f"{archive_dir.rstrip('/')}/{batch}")
    totals = {name: observation.get[name] for name in counters.NAMES}
    log.info("batch %s finished: %s", batch, totals)
    return totals
