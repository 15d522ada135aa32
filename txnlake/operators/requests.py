"""Ingest requests: read, check, give an id and a time, turn into messages."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlake.functions import text as X
from txnlake.functions.clock import at
from txnlake.operators import ingest as I
from txnlake.operators.append import publish
from txnlake.schemas import PAYLOAD, REQUEST, required
from txnlake.session import delete_at_exit, work_dir


def _reason() -> Column:
    absent = F.lit(False)
    for name in required(REQUEST):
        absent = absent | F.col(name).isNull()
    amount = F.col("amount")
    return (
        F.when(absent, I.MISSING_FIELDS)
        .when(F.isnan(amount) | (amount <= 0), I.NON_POSITIVE)
        .when(F.abs(amount) == F.lit(float("inf")), I.BAD_VALUE)
        .otherwise(I.OK)
    )


def read_requests(lines: DataFrame) -> DataFrame:
    """Requests in JSON text `value`, with the `reason` they are accepted or refused for.

    Lines are read as strictly as messages are: exactly one JSON object, with all
    required fields, of their types.
    """
    text = F.col("value").cast("string")
    rows = X.with_parsed(lines.select("value"), text, REQUEST)
    given = F.lit(True)
    for name in required(REQUEST):
        given = given & F.col(name).isNotNull()
    amount = F.col("amount")

    def judged(keys: Column) -> Column:
        absent = F.array_except(F.array(*[F.lit(n) for n in required(REQUEST)]), keys)
        return (
            F.when(keys.isNull(), I.PARSE_FAILED)
            .when(F.size(absent) > 0, I.MISSING_FIELDS)
            .when(amount <= 0, I.NON_POSITIVE)
            .when(given & (F.abs(amount) < F.lit(float("inf"))) & ~X.nested(text, REQUEST), I.OK)
            .otherwise(I.BAD_VALUE)
        )

    reason = X.once(F.when(F.is_valid_utf8(text), X.object_keys(text)), judged)
    return rows.select("value", reason.alias("reason"), *REQUEST.names)


def publish_requests(
    lines: DataFrame, kind: str, target: str, run_ts: datetime | None = None, **options: str
) -> DataFrame:
    """Publish the accepted requests among `lines` and return their ids, `transaction_id`.

    The messages are written to a work table first, so that the ids returned are
    those that were sent. The table is deleted when the driver ends.
    """
    spark = lines.sparkSession
    accepted = read_requests(lines).filter(F.col("reason") == I.OK)
    made = normalise_requests(accepted, run_ts)
    staging = work_dir(spark, "requests")
    made.write.parquet(staging)
    delete_at_exit(spark, staging)
    sent = spark.read.schema(made.schema).parquet(staging)
    publish(sent, kind, target, **options)
    return sent.select("transaction_id")


def check_requests(requests: DataFrame) -> DataFrame:
    """Requests with the `reason` they are accepted (`ok`) or refused for."""
    return requests.select(*REQUEST.names).withColumn("reason", _reason())


def normalise_requests(requests: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """Accepted requests as transactions, each with a new `transaction_id`.

    The ids are random. Write the result once (`operators.append.publish`) and
    read the ids from what was written; a second action may not see the same ids.
    """
    return (
        check_requests(requests)
        .filter(F.col("reason") == I.OK)
        .withColumn("transaction_id", F.uuid())
        .withColumn("transaction_timestamp", at(run_ts))
        .select(*PAYLOAD.names)
    )
