"""The six reports over `transactions`.

Each takes the table and `as_of`, the time the report is run for (default: now).
Windows have a lower bound only, so rows dated after `as_of` count. Amounts of
different currencies are added as they are.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlake.functions.clock import at, days_before, hours_before
from txnlake.sources.tables import on_day, since

HISTORY_DAYS = 30
MIN_HISTORY = 5
Z_LIMIT = 3
# Parts that each user's rows are spread over in the join.
SALTS = 32


def _total(column: str = "amount") -> Column:
    return F.round(F.sum(column), 2)


def _mean(column: str = "amount") -> Column:
    return F.round(F.avg(column), 2)


# Fixed values below: the names of the result columns.
def hourly_volume(transactions: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Volume per hour over the last 24 hours, newest first."""
    return (
        since(transactions, hours_before(at(as_of), 24))
        .groupBy(F.date_trunc("HOUR", "transaction_timestamp").alias("hour"))
        .agg(
            F.count("*").alias("total_transactions"),
            _total().alias("total_volume_usd"),
            _mean().alias("avg_amount"),
            F.count_if(F.col("status") == "failed").alias("failed_count"),
        )
        .orderBy(F.desc("hour"))
    )


def top_users(transactions: DataFrame, as_of: datetime | None = None, limit: int = 10) -> DataFrame:
    """Users by amount spent over the last 7 days."""
    return (
        since(transactions, days_before(at(as_of), 7))
        .groupBy("user_id")
        .agg(
            F.count("*").alias("transaction_count"),
            _total().alias("total_spent"),
            _mean().alias("avg_transaction"),
            F.max("amount").alias("max_single_transaction"),
            F.count_if("is_anomaly").alias("anomaly_count"),
        )
        .orderBy(F.desc("total_spent"), "user_id")
        .limit(limit)
    )


def type_status_breakdown(transactions: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Today's transactions by type and status."""
    return (
        on_day(transactions, at(as_of))
        .groupBy("transaction_type", "status")
        .agg(
            F.count("*").alias("count"),
            _total().alias("volume"),
            _mean().alias("avg_amount"),
        )
        .orderBy("transaction_type", F.desc("count"), "status")
    )


def geo_distribution(transactions: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Volume by country over the last 7 days; unknown country is a row of its own."""
    return (
        since(transactions, days_before(at(as_of), 7))
        .groupBy("country")
        .agg(
            F.count("*").alias("transaction_count"),
            _total().alias("total_volume"),
            F.count_if("is_anomaly").alias("anomalies"),
        )
        .orderBy(F.desc("total_volume"), "country")
    )


def processing_lag(transactions: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Whole seconds from event to processing over the last hour; always one row."""
    lag = F.timestamp_diff("SECOND", F.col("transaction_timestamp"), F.col("processed_at"))
    return (
        since(transactions, hours_before(at(as_of), 1))
        .filter(F.col("processed_at").isNotNull())
        .agg(
            F.min(lag).alias("min_lag_sec"),
            F.avg(lag).alias("avg_lag_sec"),
            F.max(lag).alias("max_lag_sec"),
            F.count("*").alias("total_processed"),
        )
    )


def _z_score(amount: Column) -> Column:
    """NULL for a user whose amounts are all equal."""
    spread = F.nullif(F.col("stddev_amount"), F.lit(0.0))
    return F.round((amount - F.col("avg_amount")) / spread, 2)


def extremes(recent: Column) -> list[Column]:
    """Each user's highest and lowest amount, of the rows to be scored."""
    amount = F.when(recent, F.col("amount"))
    return [F.max(amount).alias("highest"), F.min(amount).alias("lowest")]


def score(recent: DataFrame, users: DataFrame, limit: int | None) -> DataFrame:
    """Recent rows far from their user's mean, by rounded z-score.

    `users` has each user's tx_count, avg_amount and stddev_amount, and highest and
    lowest of the recent amounts. The extremes tell which users have an outlier at
    all, and only those take part in the join. With a `limit`, only users whose own
    extreme is among the `limit` largest of all users do: each of these has a row at
    least that far out, so a row of any other user cannot be among the first. Recent
    rows are joined on user and salt, so that one user's rows spread over many tasks;
    the few users left are repeated per salt. Both sides then arrive by a shuffle of
    their own, which also lets adaptive execution split what is still too large, or
    broadcast the users if their measured size allows.
    """
    # Rounding keeps order, so the extremes decide. Spark orders NaN above all numbers.
    has_outlier = (
        (F.col("tx_count") >= MIN_HISTORY)
        & ~F.isnan("stddev_amount")
        & ((_z_score(F.col("highest")) > Z_LIMIT) | (_z_score(F.col("lowest")) < -Z_LIMIT))
    )
    suspects = users.filter(has_outlier)
    if limit is not None:
        suspects = suspects.withColumn(
            "extreme", F.greatest(F.abs(_z_score(F.col("highest"))), F.abs(_z_score(F.col("lowest"))))
        )
        top = suspects.select("extreme").orderBy(F.desc("extreme")).limit(limit)
        suspects = suspects.filter(F.col("extreme") >= top.agg(F.min("extreme")).scalar())
    suspects = suspects.select(
        "user_id",
        "avg_amount",
        "stddev_amount",
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"),
    )
    scored = (
        recent.withColumn("salt", F.pmod(F.xxhash64("transaction_id"), F.lit(SALTS)).cast("int"))
        .join(suspects, ["user_id", "salt"])
        .withColumn("z_score", _z_score(F.col("amount")))
        .filter(F.abs("z_score") > Z_LIMIT)
        .select(
            "transaction_id", "user_id", "amount", "transaction_timestamp", "country", "z_score"
        )
        .orderBy(F.abs("z_score").desc(), "transaction_id")
    )
    return scored if limit is None else scored.limit(limit)


def checked_span(scored_hours: int) -> int:
    if not 0 < scored_hours <= 24 * HISTORY_DAYS:
        raise ValueError("the scored span must lie within the history")
    return scored_hours


def zscore_outliers(
    transactions: DataFrame,
    as_of: datetime | None = None,
    scored_hours: int = 24,
    limit: int | None = 50,
) -> DataFrame:
    """Recent transactions far from their user's 30-day mean: one aggregation over the history, then `score`."""
    now = at(as_of)
    span_start = hours_before(now, checked_span(scored_hours))
    users = (
        since(transactions, days_before(now, HISTORY_DAYS))
        .groupBy("user_id")
        .agg(
            F.avg("amount").alias("avg_amount"),
            F.stddev_samp("amount").alias("stddev_amount"),
            F.count("*").alias("tx_count"),
            *extremes(F.col("transaction_timestamp") >= span_start),
        )
    )
    return score(since(transactions, span_start), users, limit)
