"""The reports and overall figures from the tables' summaries, without a read of the rows.

Results are those of `reports` and `serving.stats` over all rows, up to the order
in which numbers are added. Where a report's window begins within an hour, or
within a day for figures by user, the rows of that one hour or day are read and
summarised on the way.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.functions.clock import at, days_before, hours_before
from txnlake.operators.summarise import by_hour, by_user, joint_moments
from txnlake.plans.reports import HISTORY_DAYS, checked_span, extremes, score
from txnlake.schemas import DAY
from txnlake.settings import Tables
from txnlake.sources.tables import by_hour_layout, by_user_layout, scan, scan_transactions, since


def _next(unit: str, start: Column) -> Column:
    """The first full hour or day from `start` on."""
    whole = F.date_trunc(unit, start)
    length = F.make_dt_interval(hours=F.lit(1 if unit == "HOUR" else 24))
    return F.when(whole == start, whole).otherwise(whole + length)


def _first_part(spark: SparkSession, tables: Tables, unit: str, start: Column) -> DataFrame:
    """Rows of the hour or day within which the window begins; none if it begins with one."""
    rows = since(scan_transactions(spark, tables), start)
    full = _next(unit, start)
    return rows.filter((F.col("transaction_timestamp") < full) & (F.col(DAY) <= F.to_date(full)))


def _hours(spark: SparkSession, tables: Tables, start: Column) -> DataFrame:
    full = _next("HOUR", start)
    kept = scan(spark, by_hour_layout(tables)).filter((F.col("hour") >= full) & (F.col(DAY) >= F.to_date(full)))
    first = by_hour(_first_part(spark, tables, "HOUR", start))
    return kept.select(*first.columns).unionByName(first)


def _users(spark: SparkSession, tables: Tables, start: Column) -> DataFrame:
    kept = scan(spark, by_user_layout(tables)).filter(F.col(DAY) >= F.to_date(_next("DAY", start)))
    first = by_user(_first_part(spark, tables, "DAY", start))
    return kept.select(*first.columns).unionByName(first)


def _total() -> Column:
    return F.round(F.sum("total"), 2)


def _mean() -> Column:
    return F.round(F.sum("total") / F.sum("n"), 2)


# Fixed values below: the names of the result columns.
def stats(spark: SparkSession, tables: Tables) -> DataFrame:
    """Count, amount and share of anomalies of the whole table; one row even if empty."""
    n = F.coalesce(F.sum("n"), F.lit(0))
    flagged = F.coalesce(F.sum("n_anomalies"), F.lit(0))
    return scan(spark, by_hour_layout(tables)).agg(
        n.alias("total_transactions"),
        _total().alias("total_amount"),
        flagged.alias("anomaly_count"),
        F.round(flagged / F.nullif(n, F.lit(0)) * 100, 2).alias("anomaly_rate_pct"),
    )


def hourly_volume(spark: SparkSession, tables: Tables, as_of: datetime | None = None) -> DataFrame:
    failed = F.sum(F.when(F.col("status") == "failed", F.col("n")).otherwise(0))
    return (
        _hours(spark, tables, hours_before(at(as_of), 24))
        .groupBy("hour")
        .agg(
            F.sum("n").alias("total_transactions"),
            _total().alias("total_volume_usd"),
            _mean().alias("avg_amount"),
            failed.alias("failed_count"),
        )
        .orderBy(F.desc("hour"))
    )


def type_status_breakdown(spark: SparkSession, tables: Tables, as_of: datetime | None = None) -> DataFrame:
    return (
        scan(spark, by_hour_layout(tables))
        .filter(F.col(DAY) == F.to_date(at(as_of)))
        .groupBy("transaction_type", "status")
        .agg(F.sum("n").alias("count"), _total().alias("volume"), _mean().alias("avg_amount"))
        .orderBy("transaction_type", F.desc("count"), "status")
    )


def geo_distribution(spark: SparkSession, tables: Tables, as_of: datetime | None = None) -> DataFrame:
    return (
        _hours(spark, tables, days_before(at(as_of), 7))
        .groupBy("country")
        .agg(
            F.sum("n").alias("transaction_count"),
            _total().alias("total_volume"),
            F.sum("n_anomalies").alias("anomalies"),
        )
        .orderBy(F.desc("total_volume"), "country")
    )


def top_users(spark: SparkSession, tables: Tables, as_of: datetime | None = None, limit: int = 10) -> DataFrame:
    return (
        _users(spark, tables, days_before(at(as_of), 7))
        .groupBy("user_id")
        .agg(
            F.sum("n").alias("transaction_count"),
            _total().alias("total_spent"),
            _mean().alias("avg_transaction"),
            F.max("highest").alias("max_single_transaction"),
            F.sum("n_anomalies").alias("anomaly_count"),
        )
        .orderBy(F.desc("total_spent"), "user_id")
        .limit(limit)
    )


def zscore_outliers(
    spark: SparkSession,
    tables: Tables,
    as_of: datetime | None = None,
    scored_hours: int = 24,
    limit: int | None = 50,
) -> DataFrame:
    """The history as moments by user and day; rows are read of the scored span and one day only."""
    now = at(as_of)
    recent = since(scan_transactions(spark, tables), hours_before(now, checked_span(scored_hours)))
    history = joint_moments(_users(spark, tables, days_before(now, HISTORY_DAYS)))
    users = recent.groupBy("user_id").agg(*extremes(F.lit(True))).join(history, "user_id")
    return score(recent, users, limit)
