"""Tables in the catalog: by name, found again from their folders, and skipping row groups by user."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tests.conftest import RUN_TS, line, tx_df
from tests.test_jobs import MESSAGES, ids, put, rows_of
from txnlake.operators import append
from txnlake.plans import reports, serving, sql_functions
from txnlake.plans.batch import run_batch
from txnlake.schemas import TRANSACTIONS
from txnlake.settings import Tables
from txnlake.sources import tables as S


def leaf(df):
    """The scan of an executed plan."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    while True:
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            plan = plan.executedPlan()
        elif kind.endswith("QueryStageExec"):
            plan = plan.plan()
        elif plan.children().isEmpty():
            return plan
        else:
            plan = plan.children().apply(0)


def test_written_rerun_and_read_by_name(spark, tmp_path):
    tables = Tables(str(tmp_path / "dataset"), database="bank")
    S.create_tables(spark, tables)
    try:
        put(tmp_path / "raw", "1.json", MESSAGES)
        for _ in range(2):
            run_batch(spark, str(tmp_path / "raw"), tables, batch="monday", run_ts=RUN_TS)
        assert ids(spark.table("bank.transactions")) == list("abcd")
        found = spark.sql("SELECT a.* FROM bank.anomalies a JOIN bank.transactions t USING (transaction_id)")
        assert ids(found) == ["b", "d"]
        assert {r.source_batch for r in spark.table("bank.transactions").collect()} == {"monday"}
        columns = {c.name for c in spark.catalog.listColumns("bank.transactions") if c.isPartition}
        assert columns == {"transaction_date", "ingest_batch"}
    finally:
        spark.sql("DROP DATABASE bank CASCADE")
    # The files stay, and a catalog that does not know them finds them again.
    assert ids(S.scan_transactions(spark, tables)) == list("abcd")
    run_batch(spark, str(tmp_path / "raw"), tables, batch="monday", run_ts=RUN_TS)
    assert ids(spark.table("bank.transactions")) == list("abcd")
    spark.sql("DROP DATABASE bank CASCADE")


def test_what_another_program_wrote_is_found(spark, tables, tmp_path):
    put(tmp_path / "raw", "1.json", MESSAGES)
    run_batch(spark, str(tmp_path / "raw"), tables, batch="a", run_ts=RUN_TS)
    name = S.transactions_layout(tables).name
    # As in a session that has not heard of some partitions.
    for day, batch in S.partitions(spark, S.transactions_layout(tables)):
        spark.sql(f"ALTER TABLE {name} DROP PARTITION (transaction_date='{day}', ingest_batch='{batch}')")
    assert S.scan_transactions(spark, tables).count() == 0
    S.refresh_tables(spark, tables)
    assert ids(S.scan_transactions(spark, tables)) == list("abcd")


def test_row_groups_without_a_user_are_skipped(spark, tables):
    rows = spark.range(60_000).select(
        *[
            F.concat(F.lit("user_"), F.xxhash64(F.col("id") % 20_000)).alias(f.name)
            if f.name == "user_id"
            else F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 3 * 86_400).alias(f.name)
            if f.dataType.typeName() == "timestamp"
            else F.lit("x").alias(f.name)
            if f.name in ("transaction_type", "status", "currency")
            else F.col("id").cast(f.dataType).alias(f.name)
            for f in TRANSACTIONS
        ]
    )
    # A user of one day only, whose name lies between others.
    single = tx_df(spark, [{"user_id": "user_5x", "transaction_timestamp": RUN_TS.replace(month=1, day=2)}])
    append.append_transactions(rows.unionByName(single), tables, "b")
    table = S.scan_transactions(spark, tables)
    assert leaf(table.select("user_id")).metrics().apply("numOutputRows").value() == 60_001

    def read(user):
        return leaf(table.filter(F.col("user_id") == user)).metrics().apply("numOutputRows").value()

    assert read("user_5z") == 0
    assert 1 <= read("user_5x") <= 20_001
    found = serving.newest_transactions(spark, tables, 5, user_id="user_5x")
    assert [r.user_id for r in found.collect()] == ["user_5x"]
    assert serving.newest_transactions(spark, tables, 5, user_id="user_5z").count() == 0


def test_days_are_pruned_by_the_catalog(spark, tables):
    put_rows = [{"transaction_timestamp": RUN_TS.replace(day=d)} for d in range(1, 10)]
    append.append_transactions(tx_df(spark, put_rows), tables, "b")
    some = S.scan_transactions(spark, tables).filter(F.col("transaction_date") == F.lit(date(2024, 1, 5)))
    assert leaf(some).metrics().apply("numPartitions").value() == 1


def test_a_batch_cannot_be_named_like_merged_days():
    with pytest.raises(ValueError):
        append.checked_batch(S.MERGED)


def test_old_and_new_rows_have_the_same_columns(spark, tables, tmp_path):
    put(tmp_path / "raw", "1.json", [line()])
    run_batch(spark, str(tmp_path / "raw"), tables, run_ts=RUN_TS)
    assert S.scan_transactions(spark, tables).columns == [*TRANSACTIONS.names, "transaction_date"]
    assert rows_of(S.scan_transactions(spark, tables)) == rows_of(
        S.scan_transactions(spark, tables, date(2024, 1, 30), date(2024, 1, 30))
    )


def test_reports_as_table_functions(spark, tables):
    """As of now by default, joined and filtered like tables, with days pruned."""
    now = datetime.now(timezone.utc)
    rows = [{"user_id": f"u{n % 3}", "amount": 1.0 + n, "transaction_timestamp": now - timedelta(days=n)} for n in range(12)]
    append.append_transactions(tx_df(spark, rows), tables, "b")
    names = sql_functions.register_functions(spark, tables)
    table = S.scan_transactions(spark, tables)
    for name in names:
        got = spark.sql(f"SELECT * FROM {name}(:as_of)", args={"as_of": F.lit(now)})
        want = getattr(reports, name)(table, now)
        assert got.columns == want.columns
        assert got.collect() == want.collect(), name
        partitions = leaf(got).metrics().apply("numPartitions").value()
        assert partitions <= {"geo_distribution": 8, "top_users": 8, "zscore_outliers": 12}.get(name, 2)
    assert spark.sql("SELECT sum(transaction_count) FROM geo_distribution()").first()[0] == 7
    joined = spark.sql("SELECT * FROM top_users() t JOIN (SELECT 'u1' AS user_id) USING (user_id)")
    assert [r.user_id for r in joined.collect()] == ["u1"]
