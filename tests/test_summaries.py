"""Reports from summaries: equal to those over all rows, also after repeats and merges, without reading the rows."""

from __future__ import annotations

import random
from datetime import timedelta

import pytest

from tests.conftest import RUN_TS, tx_df
from txnlake.operators import append, compact, summarise
from txnlake.plans import reports, serving, summaries
from txnlake.sources.tables import scan_transactions

PAIRS = ["hourly_volume", "top_users", "type_status_breakdown", "geo_distribution"]


def made(seed: int, n: int):
    rng = random.Random(seed)
    return [
        {
            "transaction_id": f"{seed}-{i}",
            "user_id": f"u{rng.randrange(8)}" if rng.random() < 0.6 else "hot",
            # Large amounts close together, which sums of squares would not survive.
            "amount": 1e9 + rng.random() if rng.random() < 0.98 else 1e9 + 40,
            "transaction_type": rng.choice(["a", "b"]),
            "status": rng.choice(["failed", "completed"]),
            "country": rng.choice([None, "PL", "DE"]),
            "is_anomaly": rng.random() < 0.1,
            "transaction_timestamp": RUN_TS - timedelta(minutes=rng.randrange(40 * 24 * 60), microseconds=rng.randrange(10**6)),
        }
        for i in range(n)
    ]


def write(spark, tables, batch, rows):
    df = tx_df(spark, rows)
    append.append_transactions(df, tables, batch)
    append.append_summaries(df, tables, batch)


def rounded(rows):
    return [tuple(round(x, 1) if isinstance(x, float) else x for x in r) for r in rows]


def same_reports(spark, tables, as_of):
    table = scan_transactions(spark, tables)
    assert rounded(summaries.stats(spark, tables).collect()) == rounded(serving.stats(table).collect())
    for name in PAIRS:
        got, want = getattr(summaries, name)(spark, tables, as_of), getattr(reports, name)(table, as_of)
        assert got.columns == want.columns
        assert sorted(map(repr, rounded(got.collect()))) == sorted(map(repr, rounded(want.collect()))), name
    for hours, limit in ((24, 50), (24 * 7, None), (24 * 30, 3)):
        got = summaries.zscore_outliers(spark, tables, as_of, hours, limit).collect()
        want = reports.zscore_outliers(table, as_of, hours, limit).collect()
        assert [r.transaction_id for r in got] == [r.transaction_id for r in want]
        assert [r.z_score for r in got] == pytest.approx([r.z_score for r in want], abs=0.011)
    return want


@pytest.mark.parametrize("as_of", [RUN_TS, RUN_TS.replace(hour=0), RUN_TS.replace(minute=17, second=3)])
def test_reports_equal_those_over_all_rows(spark, tables, as_of):
    write(spark, tables, "a", made(1, 1500))
    write(spark, tables, "b", made(2, 700))
    assert same_reports(spark, tables, as_of)


def test_after_repeats_and_merges(spark, tables):
    for batch, seed in (("a", 1), ("b", 2), ("a", 3)):
        write(spark, tables, batch, made(seed, 400))
    same_reports(spark, tables, RUN_TS)
    compact.compact(spark, tables)
    same_reports(spark, tables, RUN_TS)
    write(spark, tables, "b", made(4, 50))
    same_reports(spark, tables, RUN_TS)


def test_empty_tables(spark, tables):
    assert summaries.stats(spark, tables).first()[:] == (0, None, 0, None)
    assert summaries.hourly_volume(spark, tables, RUN_TS).count() == 0
    assert summaries.zscore_outliers(spark, tables, RUN_TS).count() == 0


def test_rows_are_hardly_read(spark, tables):
    """The figures come from the summaries; of the rows, the days of the scored span and one more are read."""
    write(spark, tables, "a", made(1, 500))
    assert {f.split("/")[-4] for f in summaries.stats(spark, tables).inputFiles()} == {tables.by_hour}
    start = reports.days_before(reports.at(RUN_TS), 30)
    for unit, length in (("HOUR", 1), ("DAY", 24)):
        times = [r.transaction_timestamp for r in summaries._first_part(spark, tables, unit, start).collect()]
        assert all(t - min(times) < timedelta(hours=length) for t in times)
    rows = summaries._users(spark, tables, start)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    days = [x for x in plan.split("\n") if "FileScan" in x and "transaction_timestamp" in x]
    assert len(days) == 1 and "transaction_date" in days[0].split("PartitionFilters: [")[1].split("PushedFilters")[0]


def test_moments_of_single_amounts(spark):
    rows = tx_df(spark, [{"user_id": "one", "amount": 3.0}, {"user_id": "two", "amount": 1.0}, {"user_id": "two", "amount": 3.0}])
    got = {r.user_id: r for r in summarise.joint_moments(summarise.by_user(rows)).collect()}
    assert got["one"].stddev_amount is None and got["one"].avg_amount == 3.0
    assert got["two"].stddev_amount == pytest.approx(2**0.5)
