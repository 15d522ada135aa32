"""Table and message schemas.

`nullable=False` marks the columns a table requires. Spark reads every Parquet
column back as nullable, so the rule is enforced by `operators.ingest.classify`
before a row is written, not by these types.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Column names, order, types and required/optional modes of the
# two tables and of the ingest request.
TRANSACTIONS = T.StructType(
    [
        T.StructField("transaction_id", T.StringType(), False),
        T.StructField("user_id", T.StringType(), False),
        T.StructField("amount", T.DoubleType(), False),
        T.StructField("currency", T.StringType(), False),
        T.StructField("transaction_type", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("merchant_id", T.StringType(), True),
        T.StructField("merchant_category", T.StringType(), True),
        T.StructField("country", T.StringType(), True),
        T.StructField("is_anomaly", T.BooleanType(), True),
        T.StructField("transaction_timestamp", T.TimestampType(), False),
        T.StructField("processed_at", T.TimestampType(), True),
    ]
)

ANOMALIES = T.StructType(
    [
        T.StructField("transaction_id", T.StringType(), False),
        T.StructField("user_id", T.StringType(), False),
        T.StructField("amount", T.DoubleType(), False),
        T.StructField("anomaly_reason", T.StringType(), True),
        T.StructField("transaction_timestamp", T.TimestampType(), False),
        T.StructField("detected_at", T.TimestampType(), False),
    ]
)

REQUEST = T.StructType(
    [
        T.StructField("user_id", T.StringType(), False),
        T.StructField("amount", T.DoubleType(), False),
        T.StructField("currency", T.StringType(), False),
        T.StructField("transaction_type", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("merchant_id", T.StringType(), True),
        T.StructField("merchant_category", T.StringType(), True),
        T.StructField("country", T.StringType(), True),
    ]
)

# The two columns the pipeline sets itself; whatever a message says is ignored.
STAMPED = ("is_anomaly", "processed_at")

# What a transaction message carries.
PAYLOAD = T.StructType([f for f in TRANSACTIONS if f.name not in STAMPED])

# Storage columns, added on write and not part of the tables' own columns.
DAY = "transaction_date"
DETECTED_DAY = "detected_date"
BATCH = "ingest_batch"
SOURCE = "source_batch"  # the batch that wrote a row, also where batches are merged

# Summaries of transactions: what adds up by hour and group, and by user and day.
BY_HOUR = T.StructType(
    [
        T.StructField("hour", T.TimestampType()),
        T.StructField("country", T.StringType()),
        T.StructField("transaction_type", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("total", T.DoubleType()),
        T.StructField("n_anomalies", T.LongType()),
    ]
)
BY_USER = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("mean", T.DoubleType()),
        T.StructField("m2", T.DoubleType()),  # sum of squared distances from the mean
        T.StructField("total", T.DoubleType()),
        T.StructField("highest", T.DoubleType()),
        T.StructField("n_anomalies", T.LongType()),
    ]
)

REJECTS = T.StructType(
    [
        T.StructField("value", T.StringType(), True),
        T.StructField("reason", T.StringType(), False),
        T.StructField("detail", T.StringType(), True),
    ]
)


def required(schema: T.StructType) -> list[str]:
    return [f.name for f in schema if not f.nullable]
