
from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlake.operators import append, compact, counters, ingest
from txnlake.operators import requests as R
from txnlake.plans import batch, reports, serving, sql_functions, summaries
from txnlake.schemas import PAYLOAD, TRANSACTIONS
from txnlake.session import apply_settings, delete_at_exit, hadoop_path, work_dir
from txnlake.settings import Tables
from txnlake.sources import events
from txnlake.sources.lines import read_lines, stream_files
from txnlake.sources.tables import (
    create_tables,
    register_views,
    scan_anomalies,
    scan_transactions,
    transactions_layout,
)
from txnlake.streaming.job import await_end, run_stream

try:
    import corpus_pipeline
    import txnlake.llm.registry as llm
except ModuleNotFoundError as missing:
    # Only the absence of the subpackage is accepted, not of anything it imports.
    if missing.name not in ("corpus_pipeline", "txnlake.llm", "txnlake.llm.registry"):
        raise
    llm = None

# The time the reports are run for, and the time stamped on ingested rows.
AS_OF = datetime(2024, 1, 30, 23, 59, 59, tzinfo=timezone.utc)
RUN_TS = datetime(2024, 1, 31, 12, 0, 0, tzinfo=timezone.utc)
WEEK_HOURS = 7 * 24
OLDEST = (AS_OF - timedelta(days=reports.HISTORY_DAYS)).date()
SECOND_THRESHOLD = 300.0

Query = Callable[[SparkSession, str], DataFrame]


def _query(build: Query) -> Query:
    """Run under the package's settings; give instants as UTC wall time."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        result = build(apply_settings(spark), sf_dir)
        return result.select(
            *[
                F.col(f.name).cast("timestamp_ntz").alias(f.name)
                if isinstance(f.dataType, T.TimestampType)
                else F.col(f.name)
                for f in result.schema
            ]
        )

    return run


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.classify(events.lines(spark, sf_dir))


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.enrich(_classified(spark, sf_dir), events.THRESHOLD, RUN_TS)


def _anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.extract_anomalies(
        events.transactions(spark, sf_dir), events.THRESHOLD, RUN_TS
    )


_RAW_LINES: dict[tuple[str, str], str] = {}


def _new_home(spark: SparkSession) -> str:
    """A new work folder, deleted when the driver ends."""
    home = work_dir(spark, "run")
    delete_at_exit(spark, home)
    return home


def _through_tables(
    spark: SparkSession, sf_dir: str, job: Callable[[str, str, Tables], object]
) -> Tables:
    """Run a job from files of raw lines into two new tables.

    The files are made once per application and data folder. Everything is
    deleted when the driver ends.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _RAW_LINES:
        made = _new_home(spark)
        events.lines(spark, sf_dir).write.text(f"{made}/raw")
        _RAW_LINES[key] = f"{made}/raw"
    home = _new_home(spark)
    tables = Tables(f"{home}/dataset")
    create_tables(spark, tables)
    job(home, f"{_RAW_LINES[key]}/*.txt", tables)
    return tables


def _batch_job(spark: SparkSession, sf_dir: str) -> Tables:
    def job(home: str, files: str, tables: Tables) -> None:
        batch.run_batch(spark, files, tables, threshold=events.THRESHOLD, run_ts=RUN_TS)

    return _through_tables(spark, sf_dir, job)


_BUILT: dict[tuple[str, str], Tables] = {}


def _table(spark: SparkSession, sf_dir: str) -> Tables:
    """What the batch job makes, once per application and data folder, for reading only."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BUILT:
        _BUILT[key] = _batch_job(spark, sf_dir)
    return _BUILT[key]


def _rerun_job(spark: SparkSession, sf_dir: str) -> Tables:
    """The same batch twice: first with all days, then corrected to the later ones."""

    def job(home: str, files: str, tables: Tables) -> None:
        later = F.col("value").rlike('"transaction_timestamp":"2024-01-(1[5-9]|[23])')
        spark.read.text(files).filter(later).write.text(f"{home}/corrected")
        for path in (files, f"{home}/corrected"):
            batch.run_batch(
                spark, path, tables, threshold=events.THRESHOLD, run_ts=RUN_TS, batch="monday"
            )

    return _through_tables(spark, sf_dir, job)


def _old_files_job(spark: SparkSession, sf_dir: str) -> Tables:
    """A file of today is read first; files dated decades back arrive between the runs."""

    def job(home: str, files: str, tables: Tables) -> None:
        spark.read.text(files).repartition(3).write.text(f"{home}/held")
        held, fs = hadoop_path(spark, f"{home}/held")
        sources = [x.getPath() for x in fs.listStatus(held) if x.getPath().getName().startswith("part-")]
        inbox, _ = hadoop_path(spark, f"{home}/inbox")
        fs.mkdirs(inbox)
        for n, source in enumerate(sources):
            if n:
                fs.setTimes(source, n * 86_400_000, -1)
            fs.rename(source, hadoop_path(spark, f"{home}/inbox/{n}.txt")[0])
            await_end(
                run_stream(
                    stream_files(spark, f"{home}/inbox/*.txt"),
                    tables,
                    f"{home}/checkpoint",
                    threshold=events.THRESHOLD,
                    available_now=True,
                    clock=lambda: RUN_TS,
                )
            )

    return _through_tables(spark, sf_dir, job)


def _replayed_job(spark: SparkSession, sf_dir: str) -> Tables:
    """A stream whose last micro-batch was written but not yet noted as done, started again."""

    def job(home: str, files: str, tables: Tables) -> None:
        for _ in range(2):
            await_end(
                run_stream(
                    stream_files(spark, files, max_files_per_trigger=1),
                    tables,
                    f"{home}/checkpoint",
                    threshold=events.THRESHOLD,
                    available_now=True,
                    clock=lambda: RUN_TS,
                )
            )
            commits, fs = hadoop_path(spark, f"{home}/checkpoint/commits")
            names = [x.getPath().getName() for x in fs.listStatus(commits)]
            last = max(int(n) for n in names if n.isdigit())
            fs.delete(hadoop_path(spark, f"{home}/checkpoint/commits/{last}")[0], False)

    return _through_tables(spark, sf_dir, job)


def _merged_job(spark: SparkSession, sf_dir: str) -> Tables:
    """Three batches over the same days, merged by day; one of them is run again after that."""

    def job(home: str, files: str, tables: Tables) -> None:
        def run(k: int) -> None:
            batch.run_batch(
                spark, f"{home}/part{k}", tables, threshold=events.THRESHOLD, run_ts=RUN_TS, batch=f"part{k}"
            )

        for k in range(3):
            part = F.pmod(F.crc32(F.col("value").cast("binary")), F.lit(3)) == k
            spark.read.text(files).filter(part).write.text(f"{home}/part{k}")
            run(k)
        compact.compact(spark, tables, date(2025, 1, 1))
        run(1)

    return _through_tables(spark, sf_dir, job)


def _anomaly_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest anomalies of a table with two batches found a day apart."""
    tables = Tables(f"{_new_home(spark)}/dataset")
    create_tables(spark, tables)
    source = events.transactions(spark, sf_dir)
    for days, name, threshold in ((0, "first", events.THRESHOLD), (1, "second", SECOND_THRESHOLD)):
        found = ingest.extract_anomalies(source, threshold, RUN_TS + timedelta(days=days))
        append.append_anomalies(found.filter(F.col("amount") > threshold), tables, name)
    return serving.newest_anomalies(spark, tables, serving.MAX_LIMIT)


def _published_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged request lines published; what was sent, next to whether its id was told."""
    out = f"{_new_home(spark)}/messages"
    told = R.publish_requests(events.request_lines(spark, sf_dir), "text", out, RUN_TS)
    sent = ingest.classify(read_lines(spark, out))
    told = told.withColumn("told", F.lit(True))
    return (
        sent.join(told, "transaction_id", "left")
        .withColumn("told", F.coalesce("told", F.lit(False)))
        .select("reason", "told", *PAYLOAD.names[1:])
    )


def _stream_job(spark: SparkSession, sf_dir: str) -> Tables:
    def job(home: str, files: str, tables: Tables) -> None:
        await_end(
            run_stream(
                stream_files(spark, files),
                tables,
                f"{home}/checkpoint",
                threshold=events.THRESHOLD,
                available_now=True,
                clock=lambda: RUN_TS,
            )
        )

    return _through_tables(spark, sf_dir, job)


def _published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests accepted, published as messages, read back and classified."""
    out = f"{_new_home(spark)}/messages"
    accepted = R.normalise_requests(events.requests(spark, sf_dir), RUN_TS)
    append.publish(accepted, "text", out)
    return ingest.classify(read_lines(spark, out)).select("reason", *PAYLOAD.names[1:])


def _table_report(report: Callable[[DataFrame], DataFrame]) -> Query:
    """A report over the table that the batch job wrote, with its day partitions."""
    return lambda spark, sf: report(scan_transactions(spark, _table(spark, sf), OLDEST))


def _written_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch written, and run again with fewer days, read back by the table's name in the catalog."""
    name = transactions_layout(_rerun_job(spark, sf_dir)).name
    return spark.table(name).select(*TRANSACTIONS.names, "transaction_date", "source_batch")


def _sql_report(name: str) -> Query:
    """A report called from SQL, with the time as a bound parameter."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        sql_functions.register_functions(spark, _table(spark, sf_dir))
        return spark.sql(f"SELECT * FROM {name}(:as_of)", args={"as_of": F.lit(AS_OF)})

    return run


def _by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL text over both tables by their names."""
    register_views(spark, _table(spark, sf_dir))
    return spark.sql(
        """
        SELECT t.transaction_date, count(*) AS transactions, count(a.transaction_id) AS anomalies,
               max(a.amount) AS highest
        FROM transactions t LEFT JOIN anomalies a USING (transaction_id)
        GROUP BY t.transaction_date"""
    )


def queries() -> dict[str, Query]:
    tx = events.transactions
    built: dict[str, Query] = {
        # Reports
        "hourly_volume": lambda s, d: reports.hourly_volume(tx(s, d), AS_OF),
        "top_users": lambda s, d: reports.top_users(tx(s, d), AS_OF),
        "type_status_breakdown": lambda s, d: reports.type_status_breakdown(tx(s, d), AS_OF),
        "zscore_outliers": lambda s, d: reports.zscore_outliers(tx(s, d), AS_OF),
        "zscore_outliers_week": lambda s, d: reports.zscore_outliers(
            tx(s, d), AS_OF, scored_hours=WEEK_HOURS, limit=None
        ),
        "geo_distribution": lambda s, d: reports.geo_distribution(tx(s, d), AS_OF),
        "processing_lag": lambda s, d: reports.processing_lag(tx(s, d), AS_OF),
        # Serving reads
        "recent_transactions": lambda s, d: serving.recent_transactions(tx(s, d)),
        "recent_transactions_filtered": lambda s, d: serving.recent_transactions(
            tx(s, d), limit=500, user_id="user_7", transaction_type="deposit"
        ),
        "recent_anomalies": lambda s, d: serving.recent_anomalies(_anomalies(s, d)),
        "stats": lambda s, d: serving.stats(tx(s, d)),
        "json_rows": lambda s, d: serving.as_json(tx(s, d)),
        # Ingest
        "ingest_valid": lambda s, d: ingest.valid(_enriched(s, d)),
        "ingest_valid_bytes": lambda s, d: ingest.valid(
            ingest.enrich(
                ingest.classify(events.lines(s, d).select(F.encode("value", "UTF-8").alias("value"))),
                events.THRESHOLD,
                RUN_TS,
            )
        ),
        "ingest_rejects": lambda s, d: ingest.rejects(_classified(s, d)),
        "ingest_anomalies": lambda s, d: ingest.extract_anomalies(
            ingest.valid(_enriched(s, d)), events.THRESHOLD, RUN_TS
        ),
        "ingest_counters": lambda s, d: counters.count(_enriched(s, d)),
        "normalise_requests": lambda s, d: R.normalise_requests(
            events.requests(s, d), RUN_TS
        ).drop("transaction_id"),
        "request_checks": lambda s, d: R.check_requests(events.requests(s, d)),
        "json_encode": lambda s, d: append.encode(tx(s, d).select(*PAYLOAD.names)),
        "publish_roundtrip": _published,
        # Jobs, through files and tables
        "sink_roundtrip": lambda s, d: scan_transactions(s, _batch_job(s, d)),
        "sink_roundtrip_anomalies": lambda s, d: scan_anomalies(s, _batch_job(s, d)),
        "rerun_roundtrip": lambda s, d: scan_transactions(s, _rerun_job(s, d)),
        "rerun_roundtrip_anomalies": lambda s, d: scan_anomalies(s, _rerun_job(s, d)),
        "stream_ingest_old_files": lambda s, d: scan_transactions(s, _old_files_job(s, d)),
        "stream_replayed": lambda s, d: scan_transactions(s, _replayed_job(s, d)),
        "merged_days": lambda s, d: scan_transactions(s, _merged_job(s, d)),
        "merged_days_anomalies": lambda s, d: scan_anomalies(s, _merged_job(s, d)),
        "catalog_rerun": _written_by_name,
        "publish_requests": _published_ids,
        "stream_ingest": lambda s, d: scan_transactions(s, _stream_job(s, d)),
        "stream_ingest_anomalies": lambda s, d: scan_anomalies(s, _stream_job(s, d)),
        # Reads of the day-partitioned table
        "table_recent_transactions": lambda s, d: serving.newest_transactions(s, _table(s, d)),
        "table_recent_transactions_filtered": lambda s, d: serving.newest_transactions(
            s, _table(s, d), limit=500, user_id="user_7", transaction_type="deposit"
        ),
        "table_recent_anomalies": _anomaly_batches,
        "tables_by_name": _by_name,
        "table_hourly_volume": _table_report(lambda t: reports.hourly_volume(t, AS_OF)),
        "table_top_users": _table_report(lambda t: reports.top_users(t, AS_OF)),
        "table_type_status_breakdown": _table_report(
            lambda t: reports.type_status_breakdown(t, AS_OF)
        ),
        "table_geo_distribution": _table_report(lambda t: reports.geo_distribution(t, AS_OF)),
        "table_processing_lag": _table_report(lambda t: reports.processing_lag(t, AS_OF)),
        "table_zscore_outliers": _table_report(
            lambda t: reports.zscore_outliers(t, AS_OF, scored_hours=WEEK_HOURS, limit=None)
        ),
        **{f"sql_{name}": _sql_report(name) for name in (*_REPORTS, "zscore_outliers")},
        # From the summaries, which each batch writes next to its rows
        "summary_stats": lambda s, d: summaries.stats(s, _table(s, d)),
        "summary_stats_rerun": lambda s, d: summaries.stats(s, _rerun_job(s, d)),
        "summary_hourly_volume": lambda s, d: summaries.hourly_volume(s, _table(s, d), AS_OF),
        "summary_top_users": lambda s, d: summaries.top_users(s, _table(s, d), AS_OF),
        "summary_type_status_breakdown": lambda s, d: summaries.type_status_breakdown(
            s, _table(s, d), AS_OF
        ),
        "summary_geo_distribution": lambda s, d: summaries.geo_distribution(s, _table(s, d), AS_OF),
        "summary_zscore_outliers": lambda s, d: summaries.zscore_outliers(
            s, _table(s, d), AS_OF, scored_hours=WEEK_HOURS, limit=None
        ),
    }
    if llm:
        built |= llm.queries() | {"pipeline": corpus_pipeline.run}
    return {name: _query(build) for name, build in built.items()}


def entry(spark: SparkSession) -> DataFrame:
    """Hourly volume at sf0.001."""
    return queries()["hourly_volume"](spark, "/root/testdata/sf0.001")


# --------------------------------------------------------------------------
# The same results in SQL, written against `events` alone.

_SHAPE = """
  CAST(event_id AS VARCHAR) AS transaction_id,
  'user_' || user_id AS user_id,
  {amount} AS amount,
  {currency} AS currency,
  CASE event_type WHEN 'click' THEN 'transfer' WHEN 'view' THEN 'deposit'
    WHEN 'error' THEN 'withdrawal' WHEN 'signup' THEN 'refund' ELSE 'purchase' END
    AS transaction_type,
  ['completed','pending','failed','reversed'][1 + (event_id * 7 + user_id) % 4] AS status,
  CASE WHEN event_id % 10 <> 0 THEN 'merchant_' || (100 + event_id % 900) END AS merchant_id,
  ['grocery','electronics','restaurant','travel','fuel','pharmacy'][1 + event_id % 6]
    AS merchant_category,
  CASE WHEN user_id % 11 <> 0
    THEN ['US','DE','PL','GB','FR','NL','UA'][1 + user_id % 7] END AS country,
  {rest}
"""
_CURRENCY = "['USD','EUR','GBP','PLN','CHF'][1 + event_id % 5]"

# The transactions table.
_TX = (
    "WITH tx AS (SELECT "
    + _SHAPE.format(
        amount="value",
        currency=_CURRENCY,
        rest="""CASE WHEN event_id % 13 <> 0 THEN value > 200.0 END AS is_anomaly,
  ts AS transaction_timestamp,
  CASE WHEN event_id % 17 <> 0
    THEN ts + to_microseconds(CAST((event_id * 37 % 120) * 125000 AS BIGINT)) END AS processed_at""",
    )
    + " FROM events WHERE value > 0) "
)

# What ingest must make of each damaged line, from the damage that was done.
_RAW = (
    "WITH raw AS (SELECT "
    + _SHAPE.format(
        amount="value",
        currency=_CURRENCY,
        rest="""ts AS transaction_timestamp, event_id,
  CASE event_id % 50 WHEN 0 THEN 'parse_failed' WHEN 1 THEN 'missing_fields'
    WHEN 2 THEN 'non_positive_amount' WHEN 3 THEN 'bad_value'
    ELSE CASE WHEN value <= 0 THEN 'non_positive_amount' ELSE 'ok' END END AS reason""",
    )
    + " FROM events) "
)
_RUN = "TIMESTAMP '2024-01-31 12:00:00'"
_NOW = "TIMESTAMP '2024-01-30 23:59:59'"

_INGESTED = (
    _RAW
    + f"""
SELECT transaction_id, user_id, amount, currency, transaction_type, status, merchant_id,
  merchant_category, country, amount > 200.0 AS is_anomaly, transaction_timestamp,
  {_RUN} AS processed_at
FROM raw WHERE reason = 'ok'"""
)
_INGESTED_ANOMALIES = (
    _RAW
    + f"""
SELECT transaction_id, user_id, amount, 'Amount exceeds threshold of 200.0' AS anomaly_reason,
  transaction_timestamp, {_RUN} AS detected_at
FROM raw WHERE reason = 'ok' AND amount > 200.0"""
)
_REQUESTS = (
    "WITH req AS (SELECT "
    + _SHAPE.format(
        amount="CASE WHEN event_id % 9 = 0 THEN -value ELSE value END",
        currency=f"CASE WHEN event_id % 14 <> 0 THEN {_CURRENCY} END",
        rest=f"{_RUN} AS transaction_timestamp",
    )
    + " FROM events) "
)
_REPORTS = {
    "hourly_volume": f"""
SELECT date_trunc('hour', transaction_timestamp) AS "hour", count(*) AS total_transactions,
  round(sum(amount), 2) AS total_volume_usd, round(avg(amount), 2) AS avg_amount,
  count(*) FILTER (WHERE status = 'failed') AS failed_count
FROM tx WHERE transaction_timestamp >= {_NOW} - INTERVAL 24 HOUR GROUP BY 1""",
    "top_users": f"""
SELECT user_id, count(*) AS transaction_count, round(sum(amount), 2) AS total_spent,
  round(avg(amount), 2) AS avg_transaction, max(amount) AS max_single_transaction,
  count(*) FILTER (WHERE is_anomaly) AS anomaly_count
FROM tx WHERE transaction_timestamp >= {_NOW} - INTERVAL 7 DAY
GROUP BY user_id ORDER BY total_spent DESC, user_id LIMIT 10""",
    "type_status_breakdown": f"""
SELECT transaction_type, status, count(*) AS "count", round(sum(amount), 2) AS volume,
  round(avg(amount), 2) AS avg_amount
FROM tx WHERE CAST(transaction_timestamp AS DATE) = CAST({_NOW} AS DATE) GROUP BY 1, 2""",
    "geo_distribution": f"""
SELECT country, count(*) AS transaction_count, round(sum(amount), 2) AS total_volume,
  count(*) FILTER (WHERE is_anomaly) AS anomalies
FROM tx WHERE transaction_timestamp >= {_NOW} - INTERVAL 7 DAY GROUP BY country""",
    "processing_lag": f"""
SELECT min(lag_sec) AS min_lag_sec, avg(lag_sec) AS avg_lag_sec, max(lag_sec) AS max_lag_sec,
  count(*) AS total_processed
FROM (SELECT date_sub('second', transaction_timestamp, processed_at) AS lag_sec FROM tx
  WHERE processed_at IS NOT NULL AND transaction_timestamp >= {_NOW} - INTERVAL 1 HOUR)""",
}
_REQUEST_COLUMNS = (
    "user_id, amount, currency, transaction_type, status, merchant_id, merchant_category, country"
)


def _zscore(source: str, span: str, tail: str) -> str:
    """Z-scores by window functions: every row next to its user's figures."""
    return (
        source
        + f"""
SELECT transaction_id, user_id, amount, transaction_timestamp, country, z_score
FROM (
  SELECT *, round((amount - avg(amount) OVER w) / nullif(stddev_samp(amount) OVER w, 0), 2)
      AS z_score,
    count(*) OVER w AS history
  FROM tx WHERE transaction_timestamp >= {_NOW} - INTERVAL 30 DAY
  WINDOW w AS (PARTITION BY user_id)
)
WHERE history >= 5 AND abs(z_score) > 3
  AND transaction_timestamp >= {_NOW} - INTERVAL {span}
{tail}"""
    )


_TABLE = "WITH tx AS (" + _INGESTED + ") "
_STATS = """
SELECT count(*) AS total_transactions, round(sum(amount), 2) AS total_amount,
  count(*) FILTER (WHERE is_anomaly) AS anomaly_count,
  round(count(*) FILTER (WHERE is_anomaly) / nullif(count(*), 0) * 100, 2) AS anomaly_rate_pct
FROM tx"""


def _json(fields: list[str]) -> str:
    """JSON text as string concatenation; `fields` are strings unless marked."""
    parts = []
    for field in fields:
        name, _, kind = field.partition(":")
        if kind == "time":
            text = (
                f"""CASE WHEN {name} = date_trunc('second', {name})
 THEN strftime({name}, '"%Y-%m-%dT%H:%M:%S+00:00"')
 ELSE strftime({name}, '"%Y-%m-%dT%H:%M:%S.%f+00:00"') END"""
            )
        elif kind == "raw":
            text = f"CAST({name} AS VARCHAR)"
        else:
            text = f"""'"' || {name} || '"'"""
        parts.append(f"""'"{name}":' || coalesce({text}, 'null')""")
    return "'{' || " + " || ',' || ".join(parts) + " || '}'"


_PAYLOAD_JSON = [
    "transaction_id", "user_id", "amount:raw", "currency", "transaction_type", "status",
    "merchant_id", "merchant_category", "country", "transaction_timestamp:time",
]
_ROW_JSON = [*_PAYLOAD_JSON[:9], "is_anomaly:raw", "transaction_timestamp:time", "processed_at:time"]


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL with the same columns and rows as each query that SQL can express."""
    of_llm = llm.oracle_sql() if llm else {}
    if llm and corpus_pipeline.ORACLE_SQL:
        of_llm["pipeline"] = corpus_pipeline.ORACLE_SQL
    return _table_sql() | of_llm


def _table_sql() -> dict[str, str]:
    raw_json = {
        kind: _json([f for f in [*_PAYLOAD_JSON, "is_anomaly:raw"] if f not in left_out])
        for kind, left_out in (("whole", ()), ("no_currency", ("currency",)))
    }
    return {
        **{name: _TX + sql for name, sql in _REPORTS.items()},
        "zscore_outliers": _zscore(
            _TX, "24 HOUR", "ORDER BY abs(z_score) DESC, transaction_id LIMIT 50"
        ),
        "zscore_outliers_week": _zscore(_TX, "7 DAY", ""),
        "recent_transactions": _TX
        + "SELECT * FROM tx ORDER BY transaction_timestamp DESC, transaction_id LIMIT 50",
        "recent_transactions_filtered": _TX
        + """
SELECT * FROM tx WHERE user_id = 'user_7' AND transaction_type = 'deposit'
ORDER BY transaction_timestamp DESC, transaction_id LIMIT 500""",
        "recent_anomalies": _TX
        + f"""
SELECT transaction_id, user_id, amount, 'Amount exceeds threshold of 200.0' AS anomaly_reason,
  transaction_timestamp, {_RUN} AS detected_at
FROM tx WHERE is_anomaly ORDER BY transaction_id LIMIT 50""",
        "stats": _TX + _STATS,
        "summary_stats": _TABLE + _STATS,
        "summary_stats_rerun": _TABLE + _STATS + " WHERE transaction_timestamp >= '2024-01-15'",
        "json_rows": _TX + f"SELECT {_json(_ROW_JSON)} AS json FROM tx",
        "ingest_valid": _INGESTED,
        "ingest_valid_bytes": _INGESTED,
        "ingest_rejects": _RAW
        + f"""
SELECT CASE event_id % 50
    WHEN 0 THEN rtrim({raw_json["whole"]}, '}}')
    WHEN 1 THEN {raw_json["no_currency"]}
    ELSE {raw_json["whole"]} END AS value,
  reason, CASE WHEN reason = 'missing_fields' THEN 'currency' END AS detail
FROM (SELECT * REPLACE (
    CASE event_id % 50 WHEN 2 THEN -amount WHEN 3 THEN NULL ELSE amount END AS amount),
  CASE WHEN event_id % 13 <> 0 THEN amount > 200.0 END AS is_anomaly FROM raw)
WHERE reason <> 'ok'""",
        "ingest_anomalies": _INGESTED_ANOMALIES,
        "ingest_counters": _RAW
        + """
SELECT count(*) FILTER (WHERE reason <> 'parse_failed') AS parsed,
  count(*) FILTER (WHERE reason = 'parse_failed') AS parse_failed,
  count(*) FILTER (WHERE reason = 'ok') AS valid,
  count(*) FILTER (WHERE reason = 'missing_fields') AS invalid_missing_fields,
  count(*) FILTER (WHERE reason = 'non_positive_amount') AS invalid_non_positive_amount,
  count(*) FILTER (WHERE reason = 'bad_value') AS invalid_bad_value,
  count(*) FILTER (WHERE reason = 'ok' AND amount > 200.0) AS anomalies_flagged,
  count(*) FILTER (WHERE reason = 'ok' AND amount <= 200.0) AS normal,
  count(*) FILTER (WHERE reason = 'ok' AND amount > 200.0) AS anomalies_extracted
FROM raw""",
        "normalise_requests": _REQUESTS
        + f"""
SELECT {_REQUEST_COLUMNS}, transaction_timestamp
FROM req WHERE currency IS NOT NULL AND amount > 0""",
        "request_checks": _REQUESTS
        + f"""
SELECT {_REQUEST_COLUMNS}, CASE WHEN currency IS NULL THEN 'missing_fields'
  WHEN amount <= 0 THEN 'non_positive_amount' ELSE 'ok' END AS reason FROM req""",
        "json_encode": _TX + f"SELECT {_json(_PAYLOAD_JSON)} AS value FROM tx",
        "publish_roundtrip": _REQUESTS
        + f"""
SELECT 'ok' AS reason, {_REQUEST_COLUMNS}, transaction_timestamp
FROM req WHERE currency IS NOT NULL AND amount > 0""",
        "sink_roundtrip": f"""
SELECT *, CAST(transaction_timestamp AS DATE) AS transaction_date FROM ({_INGESTED})""",
        "sink_roundtrip_anomalies": _INGESTED_ANOMALIES,
        "stream_ingest": f"""
SELECT *, CAST(transaction_timestamp AS DATE) AS transaction_date FROM ({_INGESTED})""",
        "stream_ingest_anomalies": _INGESTED_ANOMALIES,
        "table_recent_transactions": f"""
SELECT * FROM ({_INGESTED}) ORDER BY transaction_timestamp DESC, transaction_id LIMIT 50""",
        "table_zscore_outliers": _zscore(_TABLE, "7 DAY", ""),
        "tables_by_name": f"""
SELECT CAST(transaction_timestamp AS DATE) AS transaction_date, count(*) AS transactions,
  count(*) FILTER (WHERE is_anomaly) AS anomalies, max(amount) FILTER (WHERE is_anomaly) AS highest
FROM ({_INGESTED}) GROUP BY 1""",
        "table_recent_transactions_filtered": f"""
SELECT * FROM ({_INGESTED}) WHERE user_id = 'user_7' AND transaction_type = 'deposit'
ORDER BY transaction_timestamp DESC, transaction_id LIMIT 500""",
        "table_recent_anomalies": _TX
        + f"""
SELECT transaction_id, user_id, amount, 'Amount exceeds threshold of ' || threshold AS anomaly_reason,
  transaction_timestamp, {_RUN} + to_days(day) AS detected_at
FROM tx, (VALUES (0, 200.0, '200.0'), (1, {SECOND_THRESHOLD}, '{SECOND_THRESHOLD}')) AS b(day, least, threshold)
WHERE is_anomaly AND amount > least ORDER BY detected_at DESC, transaction_id LIMIT 500""",
        "rerun_roundtrip": f"""
SELECT *, CAST(transaction_timestamp AS DATE) AS transaction_date FROM ({_INGESTED})
WHERE transaction_timestamp >= '2024-01-15'""",
        "rerun_roundtrip_anomalies": f"""
SELECT * FROM ({_INGESTED_ANOMALIES}) WHERE transaction_timestamp >= '2024-01-15'""",
        **dict.fromkeys(
            ("stream_replayed", "merged_days"),
            f"SELECT *, CAST(transaction_timestamp AS DATE) AS transaction_date FROM ({_INGESTED})",
        ),
        "merged_days_anomalies": _INGESTED_ANOMALIES,
        "stream_ingest_old_files": f"""
SELECT *, CAST(transaction_timestamp AS DATE) AS transaction_date FROM ({_INGESTED})""",
        "publish_requests": _REQUESTS
        + f"""
SELECT 'ok' AS reason, true AS told, {_REQUEST_COLUMNS}, transaction_timestamp
FROM req WHERE currency IS NOT NULL AND amount > 0
  AND CAST(transaction_id AS BIGINT) % 50 NOT IN (0, 3)""",
        **{f"table_{name}": _TABLE + sql for name, sql in _REPORTS.items()},
        **{f"summary_{name}": _TABLE + sql for name, sql in _REPORTS.items() if name != "processing_lag"},
        "summary_zscore_outliers": _zscore(_TABLE, "7 DAY", ""),
        **{f"sql_{name}": _TABLE + sql for name, sql in _REPORTS.items()},
        "sql_zscore_outliers": _zscore(
            _TABLE, "24 HOUR", "ORDER BY abs(z_score) DESC, transaction_id LIMIT 50"
        ),
        "catalog_rerun": f"""
SELECT *, CAST(transaction_timestamp AS DATE) AS transaction_date, 'monday' AS source_batch
FROM ({_INGESTED}) WHERE transaction_timestamp >= '2024-01-15'""",
    }
