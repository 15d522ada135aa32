"""Command line: `python -m txnlake <command>`, or this file given to spark-submit."""

from __future__ import annotations

import argparse
import json
import logging

from datetime import date, timedelta

from pyspark.sql import functions as F

from txnlake import settings
from txnlake.functions.clock import utc_now
from txnlake.operators import compact as merging
from txnlake.operators.requests import publish_requests
from txnlake.plans import reports, serving, summaries
from txnlake.plans.batch import run_batch
from txnlake.plans.sql_functions import register_functions
from txnlake.session import build_session
from txnlake.sources.lines import read_lines, stream_files, stream_kafka
from txnlake.sources.tables import create_tables, register_views, scan_transactions
from txnlake.streaming.job import await_end, run_stream

REPORTS = {
    name: getattr(reports, name)
    for name in (
        "hourly_volume",
        "top_users",
        "type_status_breakdown",
        "zscore_outliers",
        "geo_distribution",
        "processing_lag",
    )
}

# Days before the present one that a report looks at.
REPORT_DAYS = {
    "hourly_volume": 1,
    "top_users": 7,
    "type_status_breakdown": 0,
    "zscore_outliers": 30,
    "geo_distribution": 7,
    "processing_lag": 1,
}


def parser() -> argparse.ArgumentParser:
    env = settings.Tables.from_env()
    top = argparse.ArgumentParser(prog="txnlake")
    top.add_argument("--dataset", default=env.dataset, help="folder that holds both tables")
    top.add_argument("--transactions_table", default=env.transactions)
    top.add_argument("--anomalies_table", default=env.anomalies)
    top.add_argument("--database", default=env.database, help="the tables' database in the catalog")
    commands = top.add_subparsers(dest="command", required=True)

    commands.add_parser("create-tables", help="make both tables, empty")

    ingest = argparse.ArgumentParser(add_help=False)
    ingest.add_argument(
        "--anomaly_amount_threshold", type=float, default=settings.threshold_from_env()
    )
    ingest.add_argument("--rejects_path", help="also keep refused lines, here")

    batch = commands.add_parser("batch", parents=[ingest], help="ingest files of JSON lines")
    path = settings.input_path_from_env()
    batch.add_argument("--input_path", default=path, required=path is None)
    batch.add_argument("--batch", help="name of the run; the same name replaces its rows")
    batch.add_argument("--archive_dir", help="move the files here once they are ingested")

    stream = commands.add_parser("stream", parents=[ingest], help="ingest a stream of messages")
    stream.add_argument("--source", choices=("kafka", "files"), default="kafka")
    stream.add_argument("--input", required=True, help="topic, or path of the files")
    stream.add_argument("--servers", help="Kafka bootstrap servers")
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--archive_dir", help="move files here once they are read")
    stream.add_argument("--max_per_trigger", type=int, help="messages, or files, per micro-batch")
    stream.add_argument("--interval", help="time between micro-batches, as in '1 minute'")
    stream.add_argument(
        "--available_now", action="store_true", help="stop once the present input is read"
    )

    compact = commands.add_parser("compact", help="merge the batches of closed days")
    compact.add_argument("--before", type=date.fromisoformat, help="first day left alone (today)")

    publish = commands.add_parser("publish", help="turn request lines into messages, print ids")
    publish.add_argument("--input_path", required=True)
    publish.add_argument("--sink", choices=("kafka", "text"), default="kafka")
    publish.add_argument("--output", required=True, help="topic, or folder of the messages")
    publish.add_argument("--servers", help="Kafka bootstrap servers")

    report = commands.add_parser("report", help="print a report as JSON lines")
    report.add_argument("name", choices=sorted(REPORTS))

    recent = commands.add_parser("transactions", help="print the newest transactions")
    recent.add_argument("--limit", type=int, default=serving.DEFAULT_LIMIT)
    recent.add_argument("--user_id")
    recent.add_argument("--transaction_type")

    found = commands.add_parser("anomalies", help="print the newest anomalies")
    found.add_argument("--limit", type=int, default=serving.DEFAULT_LIMIT)

    commands.add_parser("stats", help="print the overall figures")

    sql = commands.add_parser("sql", help="print the result of a query over both tables and the reports by name")
    sql.add_argument("query")
    sql.add_argument(
        "--arg", action="append", default=[], metavar="NAME=LITERAL", help="a parameter, as in as_of=\"TIMESTAMP '2024-01-30'\""
    )
    return top


def _given(options: dict) -> dict:
    return {name: value for name, value in options.items() if value is not None}


def main(argv: list[str] | None = None) -> None:
    known = parser()
    args = known.parse_args(argv)
    source = getattr(args, "source", None) or getattr(args, "sink", None)
    if source == "kafka" and not args.servers:
        known.error("Kafka needs --servers")
    logging.basicConfig(level=logging.INFO)
    logging.getLogger("py4j").setLevel(logging.WARNING)
    spark = build_session(f"txnlake-{args.command}")
    tables = settings.Tables(args.dataset, args.transactions_table, args.anomalies_table, args.database)

    if args.command == "create-tables":
        create_tables(spark, tables)
    elif args.command == "compact":
        print(json.dumps({"merges": merging.compact(spark, tables, args.before)}))
    elif args.command == "batch":
        counts = run_batch(
            spark,
            args.input_path,
            tables,
            threshold=args.anomaly_amount_threshold,
            rejects_path=args.rejects_path,
            batch=args.batch,
            archive_dir=args.archive_dir,
        )
        print(json.dumps(counts))
    elif args.command == "stream":
        if args.source == "kafka":
            options = {"max_offsets_per_trigger": args.max_per_trigger}
            lines = stream_kafka(spark, args.servers, args.input, **_given(options))
        else:
            options = {"max_files_per_trigger": args.max_per_trigger}
            lines = stream_files(spark, args.input, **_given(options))
        query = run_stream(
            lines,
            tables,
            args.checkpoint,
            threshold=args.anomaly_amount_threshold,
            rejects_path=args.rejects_path,
            available_now=args.available_now,
            interval=args.interval,
            archive_dir=args.archive_dir,
        )
        await_end(query)
    else:
        if args.command == "report":
            first_day = utc_now().date() - timedelta(days=REPORT_DAYS[args.name])
            result = REPORTS[args.name](scan_transactions(spark, tables, first_day))
        elif args.command == "transactions":
            result = serving.newest_transactions(
                spark, tables, args.limit, args.user_id, args.transaction_type
            )
        elif args.command == "anomalies":
            result = serving.newest_anomalies(spark, tables, args.limit)
        elif args.command == "publish":
            lines = read_lines(spark, args.input_path)
            if lines is None:
                return
            servers = {"kafka.bootstrap.servers": args.servers} if args.servers else {}
            result = publish_requests(lines, args.sink, args.output, **servers)
        elif args.command == "sql":
            register_views(spark, tables)
            register_functions(spark, tables)
            given = (x.partition("=") for x in args.arg)
            result = spark.sql(args.query, args={name: F.expr(literal) for name, _, literal in given})
        else:
            result = summaries.stats(spark, tables)
        # Reports are a handful of rows, reads are limited, other results come part by part.
        for row in serving.as_json(result).toLocalIterator():
            print(row.json)


if __name__ == "__main__":
    main()
