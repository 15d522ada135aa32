from __future__ import annotations

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from txnlake.schemas import TRANSACTIONS
from txnlake.session import build_session
from txnlake.settings import Tables
from txnlake.sources.tables import create_tables

UTC = timezone.utc
RUN_TS = datetime(2024, 1, 31, 12, tzinfo=UTC)


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "3g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.maxMetadataStringLength": "10000",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def tables(spark, tmp_path):
    made = Tables(str(tmp_path / "dataset"))
    create_tables(spark, made)
    return made


def message(**changes) -> dict:
    """A sound transaction message, with changes; a value of ... removes the key."""
    fields = {
        "transaction_id": "t1",
        "user_id": "u1",
        "amount": 25.5,
        "currency": "USD",
        "transaction_type": "purchase",
        "status": "completed",
        "merchant_id": "m1",
        "merchant_category": "fuel",
        "country": "PL",
        "is_anomaly": True,
        "transaction_timestamp": "2024-01-30T10:20:30.123456+02:00",
    }
    fields.update(changes)
    return {k: v for k, v in fields.items() if v is not ...}


def line(**changes) -> str:
    return json.dumps(message(**changes))


def lines_df(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def tx_df(spark, rows):
    """Transactions from dicts; fields not given get a plain value."""
    base = {
        "transaction_id": "t",
        "user_id": "u",
        "amount": 1.0,
        "currency": "USD",
        "transaction_type": "purchase",
        "status": "completed",
        "merchant_id": None,
        "merchant_category": None,
        "country": "PL",
        "is_anomaly": False,
        "transaction_timestamp": datetime(2024, 1, 30, 12, tzinfo=UTC),
        "processed_at": None,
    }
    full = [
        tuple({**base, "transaction_id": f"t{i}", **row}[n] for n in TRANSACTIONS.names)
        for i, row in enumerate(rows)
    ]
    return spark.createDataFrame(full, TRANSACTIONS)


def micros(df, *names):
    """Timestamps as microseconds, so that rows compare without a time zone."""
    for name in names:
        df = df.withColumn(name, F.unix_micros(name))
    return df
