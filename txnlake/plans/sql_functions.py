"""The six reports as table functions of SQL, with the time of the report as their parameter.

After `register_functions`, `SELECT * FROM top_users(:as_of)` reads the tables as
they are when the query runs; without a parameter, a report is for now. Spark
puts the function's query in place of the call, so filters on time and day reach
the scan as they do in `reports`, and a report can be joined and filtered further.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from txnlake.plans.reports import HISTORY_DAYS, MIN_HISTORY, Z_LIMIT
from txnlake.schemas import DAY
from txnlake.session import require_utc
from txnlake.settings import Tables
from txnlake.sources.tables import attach, transactions_layout


def _since(interval: str) -> str:
    return f"transaction_timestamp >= as_of - INTERVAL {interval} AND {DAY} >= to_date(as_of - INTERVAL {interval})"


# Names and order of the result columns.
_RETURNS = {
    "hourly_volume": "hour TIMESTAMP, total_transactions BIGINT, total_volume_usd DOUBLE, avg_amount DOUBLE, failed_count BIGINT",
    "top_users": """user_id STRING, transaction_count BIGINT, total_spent DOUBLE, avg_transaction DOUBLE,
        max_single_transaction DOUBLE, anomaly_count BIGINT""",
    "type_status_breakdown": "transaction_type STRING, status STRING, count BIGINT, volume DOUBLE, avg_amount DOUBLE",
    "zscore_outliers": """transaction_id STRING, user_id STRING, amount DOUBLE, transaction_timestamp TIMESTAMP,
        country STRING, z_score DOUBLE""",
    "geo_distribution": "country STRING, transaction_count BIGINT, total_volume DOUBLE, anomalies BIGINT",
    "processing_lag": "min_lag_sec BIGINT, avg_lag_sec DOUBLE, max_lag_sec BIGINT, total_processed BIGINT",
}


def _bodies(table: str) -> dict[str, str]:
    return {
        "hourly_volume": f"""
            SELECT date_trunc('HOUR', transaction_timestamp) AS h, count(*), round(sum(amount), 2), round(avg(amount), 2),
              count_if(status = 'failed')
            FROM {table} WHERE {_since("24 HOURS")} GROUP BY h ORDER BY h DESC""",
        "top_users": f"""
            SELECT user_id, count(*), round(sum(amount), 2) AS spent, round(avg(amount), 2), max(amount), count_if(is_anomaly)
            FROM {table} WHERE {_since("7 DAYS")} GROUP BY user_id ORDER BY spent DESC, user_id LIMIT 10""",
        "type_status_breakdown": f"""
            SELECT transaction_type, status, count(*) AS n, round(sum(amount), 2), round(avg(amount), 2)
            FROM {table} WHERE to_date(transaction_timestamp) = to_date(as_of) AND {DAY} = to_date(as_of)
            GROUP BY transaction_type, status ORDER BY transaction_type, n DESC, status""",
        "zscore_outliers": f"""
            WITH users AS (
              SELECT user_id, avg(amount) AS avg_amount, stddev_samp(amount) AS stddev_amount
              FROM {table} WHERE {_since(f"{HISTORY_DAYS} DAYS")} GROUP BY user_id HAVING count(*) >= {MIN_HISTORY}
            ), scored AS (
              SELECT transaction_id, user_id, amount, transaction_timestamp, country,
                round((amount - avg_amount) / nullif(stddev_amount, 0D), 2) AS z
              FROM {table} JOIN users USING (user_id) WHERE {_since("24 HOURS")}
            )
            SELECT * FROM scored WHERE abs(z) > {Z_LIMIT} ORDER BY abs(z) DESC, transaction_id LIMIT 50""",
        "geo_distribution": f"""
            SELECT country, count(*), round(sum(amount), 2) AS volume, count_if(is_anomaly)
            FROM {table} WHERE {_since("7 DAYS")} GROUP BY country ORDER BY volume DESC, country""",
        "processing_lag": f"""
            SELECT min(lag), avg(lag), max(lag), count(*) FROM (
              SELECT timestampdiff(SECOND, transaction_timestamp, processed_at) AS lag
              FROM {table} WHERE processed_at IS NOT NULL AND {_since("1 HOUR")})""",
    }


def register_functions(spark: SparkSession, tables: Tables) -> list[str]:
    """Make the reports over these tables known to SQL in this session; their names."""
    require_utc(spark)
    table = transactions_layout(tables)
    attach(spark, table)
    for name, body in _bodies(table.name).items():
        spark.sql(
            f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(as_of TIMESTAMP DEFAULT current_timestamp())
            RETURNS TABLE ({_RETURNS[name]}) RETURN {body}"""
        )
    return list(_RETURNS)
