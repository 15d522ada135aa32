"""Run counters over enriched rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from txnlake.operators import ingest as I

# The names of the counters.
NAMES = (
    "parsed",
    "parse_failed",
    "valid",
    "invalid_missing_fields",
    "invalid_non_positive_amount",
    "invalid_bad_value",
    "anomalies_flagged",
    "normal",
    "anomalies_extracted",
)


def expressions() -> list[Column]:
    reason = F.col("reason")
    flagged = (reason == I.OK) & F.col("is_anomaly")
    conditions = {
        "parsed": reason != I.PARSE_FAILED,
        "parse_failed": reason == I.PARSE_FAILED,
        "valid": reason == I.OK,
        "invalid_missing_fields": reason == I.MISSING_FIELDS,
        "invalid_non_positive_amount": reason == I.NON_POSITIVE,
        "invalid_bad_value": reason == I.BAD_VALUE,
        "anomalies_flagged": flagged,
        "normal": (reason == I.OK) & ~F.col("is_anomaly"),
        "anomalies_extracted": flagged,
    }
    return [F.count_if(conditions[name]).alias(name) for name in NAMES]


def count(enriched: DataFrame) -> DataFrame:
    """All counters as one row."""
    return enriched.agg(*expressions())


def observe(enriched: DataFrame) -> tuple[DataFrame, Observation]:
    """Count while the rows pass.

    Exact only if the action on the result has no shuffle above this point: a map
    task that runs again after an executor is lost would be counted twice.
    """
    observation = Observation()
    return enriched.observe(observation, *expressions()), observation
