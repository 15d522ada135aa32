"""Reads behind the service: newest rows and overall figures."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.functions.text import json_row
from txnlake.schemas import ANOMALIES, TRANSACTIONS
from txnlake.settings import Tables
from txnlake.sources.tables import (
    anomalies_layout,
    days_of,
    scan_anomalies,
    scan_transactions,
    transactions_layout,
)

# The limits of the reads, and the result columns below.
DEFAULT_LIMIT = 50
MAX_LIMIT = 500


def _checked(limit: int) -> int:
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be between 1 and {MAX_LIMIT}")
    return limit


def _newest(rows: DataFrame, by: str, limit: int) -> DataFrame:
    """The `limit` newest rows by `by`, ties by id. Each task sends `limit` rows at most."""
    return rows.orderBy(F.desc(by), "transaction_id").limit(limit)


def _matching(rows: DataFrame, user_id: str | None, transaction_type: str | None) -> DataFrame:
    if user_id:
        rows = rows.filter(F.col("user_id") == user_id)
    if transaction_type:
        rows = rows.filter(F.col("transaction_type") == transaction_type)
    return rows


def recent_transactions(
    transactions: DataFrame,
    limit: int = DEFAULT_LIMIT,
    user_id: str | None = None,
    transaction_type: str | None = None,
) -> DataFrame:
    """Newest transactions, optionally of one user and/or type. Empty text is no filter.

    Looks at all rows given; `newest_transactions` opens only the newest days of a table.
    """
    rows = _matching(transactions, user_id, transaction_type)
    return _newest(rows, "transaction_timestamp", _checked(limit)).select(*TRANSACTIONS.names)


def recent_anomalies(anomalies: DataFrame, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """Newest anomalies by detection time, which is one value per ingest batch."""
    return _newest(anomalies, "detected_at", _checked(limit)).select(*ANOMALIES.names)


def _from_newest_days(
    days: list[date], scan: Callable[[date | None, date | None], DataFrame], limit: int
) -> DataFrame:
    """Rows of so many of the newest days that they hold `limit` rows, or of all days.

    Goes back 1, 2, 4, ... days at a time. Every row left out is older than `limit`
    others, so what is newest is not changed.
    """
    found, step, upto = 0, 1, len(days)
    while upto and found < limit:
        since = max(0, upto - step)
        found += scan(days[since], days[upto - 1]).limit(limit - found).count()
        upto, step = since, 2 * step
    return scan(days[upto], None) if days else scan(None, None)


def newest_transactions(
    spark: SparkSession,
    tables: Tables,
    limit: int = DEFAULT_LIMIT,
    user_id: str | None = None,
    transaction_type: str | None = None,
) -> DataFrame:
    """`recent_transactions` of the table, from as few of its days as hold enough rows.

    Looking for a user's rows, row groups without the user are skipped by their
    Bloom filters, so days on which there are none cost their files' footers.
    """
    _checked(limit)

    def scan(first: date | None, last: date | None) -> DataFrame:
        return _matching(scan_transactions(spark, tables, first, last), user_id, transaction_type)

    days = days_of(spark, transactions_layout(tables))
    return recent_transactions(_from_newest_days(days, scan, limit), limit)


def newest_anomalies(spark: SparkSession, tables: Tables, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """`recent_anomalies` of the table, from as few of its days as hold enough rows."""
    _checked(limit)
    days = days_of(spark, anomalies_layout(tables))
    rows = _from_newest_days(days, lambda a, b: scan_anomalies(spark, tables, a, b), limit)
    return recent_anomalies(rows, limit)


def stats(transactions: DataFrame) -> DataFrame:
    """Count, amount and share of anomalies of the whole table; one row even if empty."""
    total = F.count("*")
    flagged = F.count_if("is_anomaly")
    return transactions.agg(
        total.alias("total_transactions"),
        F.round(F.sum("amount"), 2).alias("total_amount"),
        flagged.alias("anomaly_count"),
        F.round(flagged / F.nullif(total, F.lit(0)) * 100, 2).alias("anomaly_rate_pct"),
    )


def as_json(result: DataFrame) -> DataFrame:
    """Any result as one JSON object per row, timestamps in ISO-8601."""
    return result.select(json_row(result).alias("json"))
