"""Row operators: parse, validate, enrich, flag. All narrow, all column expressions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlake.functions import text as X
from txnlake.functions.clock import at
from txnlake.schemas import ANOMALIES, PAYLOAD, TRANSACTIONS, required

OK = "ok"
PARSE_FAILED = "parse_failed"
MISSING_FIELDS = "missing_fields"
NON_POSITIVE = "non_positive_amount"
BAD_VALUE = "bad_value"

_REQUIRED = required(PAYLOAD)

# The timestamp is parsed from its text, see functions.text.instant.
_WIRE = T.StructType(
    [
        T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.TimestampType) else f.dataType)
        for f in PAYLOAD
    ]
)

# Fields that are text in a message and in the table.
TEXTS = T.StructType([f for f in PAYLOAD if isinstance(f.dataType, T.StringType)])


def _all(conditions: list[Column]) -> Column:
    whole = F.lit(True)
    for c in conditions:
        whole = whole & c
    return whole


def _absent(keys: Column) -> Column:
    return F.array_except(F.array(*[F.lit(name) for name in _REQUIRED]), keys)


def classify(lines: DataFrame, *keep: str) -> DataFrame:
    """Parse `value` (text or bytes) and say in `reason` what becomes of each line.

    A sound flat record costs one JSON parse; its keys and the kinds of its values
    are looked at only if something about the line is odd. Columns in `keep` stay.
    """
    text, amount = F.col("value").cast("string"), F.col("amount")
    df = X.with_parsed(lines.select("value", *keep), text, _WIRE)
    df = df.withColumn("transaction_timestamp", X.instant(F.col("transaction_timestamp")))

    complete = _all([F.col(name).isNotNull() for name in _REQUIRED]) & (
        F.abs(amount) < F.lit(float("inf"))
    )
    readable = F.is_valid_utf8(text)
    plain = complete & readable & X.is_flat(text)

    def odd(keys: Column) -> Column:
        return (
            F.when(keys.isNull(), PARSE_FAILED)
            .when(F.size(_absent(keys)) > 0, MISSING_FIELDS)
            .when(amount <= 0, NON_POSITIVE)
            .when(complete & ~X.nested(text, TEXTS), OK)
            .otherwise(BAD_VALUE)
        )

    reason = (
        F.when(plain & (amount > 0), OK)
        .when(plain, NON_POSITIVE)
        .otherwise(X.once(F.when(readable, X.object_keys(text)), odd))
    )
    # In a generator, or else every later filter on the reason would judge the line again.
    judged = df.select("*", F.inline(F.array(F.struct(reason.alias("reason")))))
    return judged.select("value", "reason", *PAYLOAD.names, *keep)


def flag(classified: DataFrame, threshold: float) -> DataFrame:
    """Set the anomaly flag."""
    # Spark orders NaN above every number; a NaN amount must not count as high.
    high = (F.col("amount") > F.lit(float(threshold))) & ~F.isnan("amount")
    return classified.withColumn("is_anomaly", high)


def stamp(flagged: DataFrame, run_ts: datetime) -> DataFrame:
    """Set the processing time, one instant for the whole run."""
    return flagged.withColumn("processed_at", at(run_ts))


def enrich(classified: DataFrame, threshold: float, run_ts: datetime) -> DataFrame:
    return stamp(flag(classified, threshold), run_ts)


def valid(enriched: DataFrame) -> DataFrame:
    return enriched.filter(F.col("reason") == OK).select(*TRANSACTIONS.names)


def rejects(classified: DataFrame) -> DataFrame:
    """Refused lines, whole, with the reason and the names of absent keys."""
    absent = _absent(X.object_keys(F.col("value").cast("string")))
    detail = F.when(F.col("reason") == MISSING_FIELDS, F.array_join(F.array_sort(absent), ", "))
    return classified.filter(F.col("reason") != OK).select(
        "value", "reason", detail.alias("detail")
    )


# Fixed value: the text of `anomaly_reason`.
def extract_anomalies(transactions: DataFrame, threshold: float, run_ts: datetime) -> DataFrame:
    reason = F.lit(f"Amount exceeds threshold of {float(threshold)}")
    return (
        transactions.filter(F.col("is_anomaly"))
        .withColumn("anomaly_reason", reason)
        .withColumn("detected_at", at(run_ts))
        .select(*ANOMALIES.names)
    )
