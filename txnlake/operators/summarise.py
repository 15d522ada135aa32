"""What transactions add up to, by hour and group, and by user and day.

Each batch writes its own part of these figures. Parts are added when they are
read, so a batch that runs again replaces its part like its rows, and a report
reads a few figures in place of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlake.schemas import DAY


def by_hour(transactions: DataFrame) -> DataFrame:
    """Count, amount and anomalies by hour, country, type and status."""
    hour = F.date_trunc("HOUR", "transaction_timestamp").alias("hour")
    return (
        transactions.groupBy(hour, "country", "transaction_type", "status")
        .agg(
            F.count("*").alias("n"),
            F.sum("amount").alias("total"),
            F.count_if("is_anomaly").alias("n_anomalies"),
        )
        .withColumn(DAY, F.to_date("hour"))
    )


def by_user(transactions: DataFrame) -> DataFrame:
    """Moments of each user's amounts by day: count, mean and sum of squared distances from it."""
    return transactions.groupBy(F.to_date("transaction_timestamp").alias(DAY), "user_id").agg(
        F.count("*").alias("n"),
        F.avg("amount").alias("mean"),
        (F.var_pop("amount") * F.count("*")).alias("m2"),
        F.sum("amount").alias("total"),
        F.max("amount").alias("highest"),
        F.count_if("is_anomaly").alias("n_anomalies"),
    )


def joint_moments(moments: DataFrame) -> DataFrame:
    """user_id, tx_count, avg_amount and stddev_amount over all parts of a user.

    Parts are joined pair by pair: the squared distances of both, and what the
    distance of their means adds. No large numbers are subtracted, as they would
    be with sums of squares. A user has at most a part for each day and batch.
    """

    def joined(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        apart = b["mean"] - a["mean"]
        return F.struct(
            n.alias("n"),
            (a["mean"] + apart * b["n"] / n).alias("mean"),
            (a["m2"] + b["m2"] + apart * apart * a["n"] * b["n"] / n).alias("m2"),
        )

    parts = moments.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("n", "mean", "m2"))).alias("parts"))
    first = F.col("parts")[0]
    rest = F.slice("parts", 2, F.greatest(F.size("parts") - 1, F.lit(0)))
    whole = parts.select("user_id", F.aggregate(rest, first, joined).alias("whole"))
    return whole.select(
        "user_id",
        F.col("whole.n").alias("tx_count"),
        F.col("whole.mean").alias("avg_amount"),
        F.when(F.col("whole.n") > 1, F.sqrt(F.col("whole.m2") / (F.col("whole.n") - 1))).alias("stddev_amount"),
    )
