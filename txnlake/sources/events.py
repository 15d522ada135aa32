"""The `events` test table read as transactions, raw lines and requests.

Derived with integer arithmetic on the event's own columns, so that another
engine gets the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.functions.text import iso_utc
from txnlake.schemas import PAYLOAD, REQUEST, TRANSACTIONS

# Declared, so that `ts` (stored without zone) reads as a UTC instant and time
# filters reach the Parquet scan.
EVENTS = "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE"

# The vocabulary of transaction messages.
CURRENCIES = ("USD", "EUR", "GBP", "PLN", "CHF")
STATUSES = ("completed", "pending", "failed", "reversed")
CATEGORIES = ("grocery", "electronics", "restaurant", "travel", "fuel", "pharmacy")
COUNTRIES = ("US", "DE", "PL", "GB", "FR", "NL", "UA")
TYPE_OF_EVENT = {
    "click": "transfer",
    "view": "deposit",
    "error": "withdrawal",
    "signup": "refund",
    "purchase": "purchase",
}

THRESHOLD = 200.0


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def _pick(values: tuple[str, ...], number: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), number % len(values))


def _columns() -> dict[str, Column]:
    event, user, value = F.col("event_id"), F.col("user_id"), F.col("value")
    kinds = [F.lit(x) for pair in TYPE_OF_EVENT.items() for x in pair]
    late = (event * 37 % 120) * 125_000
    return {
        "transaction_id": event.cast("string"),
        "user_id": F.concat(F.lit("user_"), user),
        "amount": value,
        "currency": _pick(CURRENCIES, event),
        "transaction_type": F.create_map(*kinds)[F.col("event_type")],
        "status": _pick(STATUSES, event * 7 + user),
        "merchant_id": F.when(event % 10 != 0, F.concat(F.lit("merchant_"), 100 + event % 900)),
        "merchant_category": _pick(CATEGORIES, event),
        "country": F.when(user % 11 != 0, _pick(COUNTRIES, user)),
        "is_anomaly": F.when(event % 13 != 0, value > THRESHOLD),
        "transaction_timestamp": F.col("ts"),
        "processed_at": F.when(
            event % 17 != 0, F.timestamp_micros(F.unix_micros("ts") + late)
        ),
    }


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a positive value: the table holds no other amounts."""
    columns = _columns()
    return (
        read_events(spark, sf_dir)
        .filter(F.col("value") > 0)
        .select(*[columns[name].alias(name) for name in TRANSACTIONS.names])
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON messages in `value`, one in ten of them odd or damaged, by `event_id % 50`."""
    columns = _columns()
    columns["transaction_timestamp"] = iso_utc(F.col("ts"))
    kind = F.col("event_id") % 50
    columns["amount"] = (
        F.when(kind == 2, -F.col("value")).when(kind != 3, F.col("value"))
    )
    names = [n for n in PAYLOAD.names] + ["is_anomaly"]
    fields = [columns[n].alias(n) for n in names]
    keep_nulls = {"ignoreNullFields": "false"}
    whole = F.to_json(F.struct(*fields), keep_nulls)
    no_currency = F.to_json(
        F.struct(*[columns[n].alias(n) for n in names if n != "currency"]), keep_nulls
    )
    extra = F.to_json(F.struct(*fields, F.struct(kind.alias("n")).alias("note")), keep_nulls)
    value = (
        F.when(kind == 0, F.regexp_replace(whole, r"\}$", ""))
        .when(kind == 1, no_currency)
        .when(kind == 4, extra)
        .otherwise(whole)
    )
    return read_events(spark, sf_dir).select(value.alias("value"))


def request_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The requests as JSON text in `value`, some damaged or with a nested value, by `event_id % 50`."""
    kind = F.col("event_id") % 50
    columns = [c.alias(n) for n, c in _request_columns().items()]
    whole = F.to_json(F.struct(*columns))
    nested = F.regexp_replace(whole, '"status":"[a-z]*"', '"status":{"a":1}')
    value = F.when(kind == 0, F.regexp_replace(whole, r"\}$", "")).when(kind == 3, nested)
    return read_events(spark, sf_dir).select(value.otherwise(whole).alias("value"))


def _request_columns() -> dict[str, Column]:
    columns = _columns()
    event = F.col("event_id")
    columns["amount"] = F.when(event % 9 == 0, -F.col("value")).otherwise(F.col("value"))
    columns["currency"] = F.when(event % 14 != 0, columns["currency"])
    return {n: columns[n] for n in REQUEST.names}


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest requests; some lack a currency, some have an amount that is not positive."""
    return read_events(spark, sf_dir).select(*[c.alias(n) for n, c in _request_columns().items()])
