from __future__ import annotations

import json
import os
import time
from datetime import timedelta
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.conftest import RUN_TS, line, micros
from txnlake.operators import append, counters
from txnlake.plans.batch import run_batch
from txnlake.schemas import ANOMALIES, BATCH, DAY, TRANSACTIONS
from txnlake.settings import Tables
from txnlake.sources.lines import read_lines, stream_files
from txnlake.sources.tables import (
    TableNotFound,
    create_tables,
    scan_anomalies,
    scan_transactions,
)
from txnlake.streaming.job import await_end, run_stream

MESSAGES = [
    line(transaction_id="a", amount=10, transaction_timestamp="2024-01-01T00:00:00Z"),
    line(transaction_id="b", amount=5000, transaction_timestamp="2024-01-01T23:59:59.9Z"),
    line(transaction_id="c", amount=20, transaction_timestamp="2024-01-02T00:00:00Z"),
    line(transaction_id="d", amount=9000, transaction_timestamp="2024-01-03T02:00:00+03:00"),
]
BROKEN = ["", "{bad", line(currency=...), line(amount=-1), line(amount=None)]


def put(folder: Path, name: str, lines: list[str]) -> None:
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(f"{text}\n" for text in lines))


def rows_of(df):
    times = [f.name for f in df.schema if f.dataType.typeName() == "timestamp"]
    return sorted(tuple(r) for r in micros(df, *times).select(sorted(df.columns)).collect())


def ids(df):
    return sorted(r.transaction_id for r in df.collect())


def stream(spark, raw, tables, checkpoint, **options):
    source = stream_files(
        spark,
        str(raw / "*.json"),
        **{k: options.pop(k) for k in ("max_files_per_trigger",) if k in options},
    )
    query = run_stream(
        source, tables, str(checkpoint), available_now=True, clock=lambda: RUN_TS, **options
    )
    await_end(query)
    return query


def test_batch_run(spark, tables, tmp_path):
    put(tmp_path / "raw", "1.json", MESSAGES[:2] + BROKEN)
    put(tmp_path / "raw", "2.json", MESSAGES[2:])
    rejected = str(tmp_path / "rejects")
    counts = run_batch(
        spark, str(tmp_path / "raw/*.json"), tables, rejects_path=rejected, run_ts=RUN_TS
    )
    assert counts == {
        "parsed": 7,
        "parse_failed": 2,
        "valid": 4,
        "invalid_missing_fields": 1,
        "invalid_non_positive_amount": 1,
        "invalid_bad_value": 1,
        "anomalies_flagged": 2,
        "normal": 2,
        "anomalies_extracted": 2,
    }
    table = scan_transactions(spark, tables)
    assert table.columns == [*TRANSACTIONS.names, DAY]
    assert {(r.transaction_id, str(r[DAY]), r.is_anomaly) for r in table.collect()} == {
        ("a", "2024-01-01", False),
        ("b", "2024-01-01", True),
        ("c", "2024-01-02", False),
        ("d", "2024-01-02", True),
    }
    anomalies = scan_anomalies(spark, tables)
    assert anomalies.columns == ANOMALIES.names
    assert ids(anomalies) == ["b", "d"] == ids(table.filter("is_anomaly"))
    # Both tables carry the one time of the run.
    times = table.select("processed_at").union(anomalies.select("detected_at")).distinct()
    assert times.count() == 1
    refused = spark.read.parquet(rejected)
    assert sorted(r.value for r in refused.collect()) == sorted(BROKEN)


def test_runs_append(spark, tables, tmp_path):
    put(tmp_path / "raw", "1.json", MESSAGES)
    for _ in range(2):
        run_batch(spark, str(tmp_path / "raw"), tables)
    assert ids(scan_transactions(spark, tables)) == sorted("abcd" * 2)
    assert ids(scan_anomalies(spark, tables)) == sorted("bd" * 2)


def test_running_again_under_the_same_name_replaces(spark, tables, tmp_path, monkeypatch):
    put(tmp_path / "raw", "1.json", MESSAGES)

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(append, "append_anomalies", fail)
        with pytest.raises(RuntimeError):
            run_batch(spark, str(tmp_path / "raw"), tables, batch="monday")
    assert ids(scan_transactions(spark, tables)) == list("abcd")
    run_batch(spark, str(tmp_path / "raw"), tables, batch="monday")
    assert ids(scan_transactions(spark, tables)) == list("abcd")
    assert ids(scan_anomalies(spark, tables)) == list("bd")


def test_running_again_with_a_higher_threshold_leaves_no_old_anomalies(spark, tables, tmp_path):
    put(tmp_path / "raw", "1.json", MESSAGES)
    for threshold, expected in ((1000.0, ["b", "d"]), (1e6, [])):
        run_batch(spark, str(tmp_path / "raw"), tables, batch="monday", threshold=threshold)
        assert ids(scan_anomalies(spark, tables)) == expected
    assert ids(scan_transactions(spark, tables)) == list("abcd")


def test_a_batch_name_must_not_be_a_path(spark, tables, tmp_path):
    put(tmp_path / "raw", "1.json", MESSAGES)
    with pytest.raises(ValueError):
        run_batch(spark, str(tmp_path / "raw"), tables, batch="../other")


def test_no_files_is_a_successful_empty_run(spark, tables, tmp_path):
    counts = run_batch(spark, str(tmp_path / "none/*.json"), tables)
    assert set(counts.values()) == {0}
    assert scan_transactions(spark, tables).count() == 0


def test_tables_are_never_created_by_a_run(spark, tmp_path):
    put(tmp_path / "raw", "1.json", MESSAGES)
    missing = Tables(str(tmp_path / "nowhere"))
    with pytest.raises(TableNotFound):
        run_batch(spark, str(tmp_path / "raw"), missing)
    with pytest.raises(TableNotFound):
        run_stream(stream_files(spark, str(tmp_path / "raw")), missing, str(tmp_path / "cp"))


def test_creating_twice_fails(spark, tables):
    with pytest.raises(FileExistsError):
        create_tables(spark, tables)
    half = Tables(tables.dataset, transactions="new")
    with pytest.raises(FileExistsError):
        create_tables(spark, half)
    assert not Path(half.transactions_path).exists()


def test_lines_end_at_line_feeds_only(spark, tmp_path):
    tmp_path.joinpath("x.json").write_bytes(b"a\r\n\nb\rc\n")
    assert [r.value for r in read_lines(spark, str(tmp_path)).collect()] == ["a\r", "", "b\rc"]


def test_files_of_a_day_are_sorted_by_type_and_status(spark, tables):
    rows = spark.range(4000).select(
        F.col("id").cast("string").alias("transaction_id"),
        F.lit("u").alias("user_id"),
        F.lit(1.0).alias("amount"),
        F.lit("USD").alias("currency"),
        F.concat(F.lit("type"), F.pmod(F.hash("id"), F.lit(5))).alias("transaction_type"),
        F.concat(F.lit("status"), F.pmod(F.hash("id"), F.lit(3))).alias("status"),
        *[F.lit(None).cast("string").alias(n) for n in ("merchant_id", "merchant_category")],
        F.lit("PL").alias("country"),
        F.lit(False).alias("is_anomaly"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 3 * 86400).alias(
            "transaction_timestamp"
        ),
        F.lit(RUN_TS).alias("processed_at"),
    )
    append.append_transactions(rows.repartition(8), tables, "b")
    files = list(Path(tables.transactions_path).rglob("*.parquet"))
    assert {f.parent.parent.name for f in files} == {
        f"{DAY}=2024-01-0{d}" for d in (1, 2, 3)
    }
    assert len(files) == 3
    for file in files:
        kinds = pq.read_table(file, columns=["transaction_type", "status"]).to_pylist()
        keys = [(k["transaction_type"], k["status"]) for k in kinds]
        assert keys == sorted(keys)


def test_a_heavy_day_is_split_over_tasks(spark, tables):
    rows = scan_transactions(spark, tables).drop(DAY)
    rows = spark.range(200_000).select(
        *[
            F.col("id").cast("string").alias(n) if n == "transaction_id"
            else F.lit("purchase").alias(n) if n in ("transaction_type", "status")
            else F.lit(RUN_TS).alias(n) if rows.schema[n].dataType.typeName() == "timestamp"
            else F.lit(None).cast(rows.schema[n].dataType).alias(n)
            for n in TRANSACTIONS.names
        ]
    )
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        append.append_transactions(rows.repartition(16), tables, "b")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len(list(Path(tables.transactions_path).rglob("*.parquet"))) > 3
    assert scan_transactions(spark, tables).count() == 200_000


def test_stream_equals_batch(spark, tables, tmp_path):
    raw = tmp_path / "raw"
    for i, value in enumerate(MESSAGES + BROKEN):
        put(raw, f"{i}.json", [value])
    rejected = str(tmp_path / "rejects")
    query = stream(
        spark, raw, tables, tmp_path / "cp", max_files_per_trigger=4, rejects_path=rejected
    )
    assert query.exception() is None
    assert query.lastProgress.batchId >= 2

    other = Tables(str(tmp_path / "batch"))
    create_tables(spark, other)
    run_batch(spark, str(raw), other, run_ts=RUN_TS)
    assert rows_of(scan_transactions(spark, tables)) == rows_of(scan_transactions(spark, other))
    assert rows_of(scan_anomalies(spark, tables)) == rows_of(scan_anomalies(spark, other))
    assert spark.read.parquet(rejected).count() == len(BROKEN)


def test_a_batch_that_fails_between_the_sinks_is_replayed_once(
    spark, tables, tmp_path, monkeypatch
):
    raw, checkpoint = tmp_path / "raw", tmp_path / "cp"
    put(raw, "1.json", MESSAGES[:2])
    stream(spark, raw, tables, checkpoint)
    put(raw, "2.json", MESSAGES[2:])

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(append, "append_anomalies", fail)
        with pytest.raises(Exception, match="lost"):
            stream(spark, raw, tables, checkpoint)
    assert ids(scan_transactions(spark, tables)) == list("abcd")
    assert ids(scan_anomalies(spark, tables)) == ["b"]

    stream(spark, raw, tables, checkpoint)
    stream(spark, raw, tables, checkpoint)
    assert ids(scan_transactions(spark, tables)) == list("abcd")
    assert ids(scan_anomalies(spark, tables)) == list("bd")


def test_a_second_query_does_not_replace_the_first_ones_batches(spark, tables, tmp_path):
    for name, lines in (("one", MESSAGES[:2]), ("two", MESSAGES[:2])):
        put(tmp_path / name, "1.json", lines)
        stream(spark, tmp_path / name, tables, tmp_path / f"cp-{name}")
    assert ids(scan_transactions(spark, tables)) == sorted("ab" * 2)
    batches = spark.read.parquet(tables.transactions_path).select(BATCH).distinct()
    ids_in_checkpoints = {
        json.loads((tmp_path / f"cp-{n}/metadata").read_text())["id"] + "-0" for n in ("one", "two")
    }
    assert {r[BATCH] for r in batches.collect()} == ids_in_checkpoints


def test_read_files_are_archived_by_the_run_that_read_them(spark, tables, tmp_path, monkeypatch):
    raw, done = tmp_path / "raw", tmp_path / "processed"
    for i, value in enumerate(MESSAGES[:3]):
        put(raw, f"a file {i}.json", [value])
        if i != 1:
            stream(spark, raw, tables, tmp_path / "cp", archive_dir=str(done), max_files_per_trigger=1)
            assert not list(raw.glob("*.json"))
    assert ids(scan_transactions(spark, tables)) == list("abc")
    assert {f.name for f in done.rglob("*.json")} == {f"a file {i}.json" for i in range(3)}

    # A micro-batch that fails leaves its files, and the run that repeats it archives them.
    put(raw, "a file 3.json", [MESSAGES[3]])

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(append, "append_anomalies", fail)
        with pytest.raises(Exception, match="lost"):
            stream(spark, raw, tables, tmp_path / "cp", archive_dir=str(done))
    assert len(list(raw.glob("*.json"))) == 1
    stream(spark, raw, tables, tmp_path / "cp", archive_dir=str(done))
    assert not list(raw.glob("*.json")) and len(list(done.rglob("*.json"))) == 4
    assert ids(scan_transactions(spark, tables)) == list("abcd")


def test_a_repeated_micro_batch_is_told_once(spark, tables, tmp_path, monkeypatch):
    raw, told = tmp_path / "raw", []
    put(raw, "1.json", MESSAGES + BROKEN)

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(append, "append_anomalies", fail)
        with pytest.raises(Exception, match="lost"):
            stream(spark, raw, tables, tmp_path / "cp", on_counters=lambda *x: told.append(x))
    assert told == []
    for _ in range(2):
        query = stream(spark, raw, tables, tmp_path / "cp", on_counters=lambda *x: told.append(x))
    ((name, totals),) = told
    assert name == f"{query.id}-0"
    assert (totals["valid"], totals["anomalies_flagged"], totals["parse_failed"]) == (4, 2, 2)


def test_a_micro_batch_has_no_job_for_its_counters(spark, tables, tmp_path):
    """One job reads the source; the sinks read what it staged."""
    raw, jobs = tmp_path / "raw", []
    put(raw, "1.json", MESSAGES)
    plain = counters.count
    counters.count, before = (lambda *_: jobs.append(1)), plain
    try:
        stream(spark, raw, tables, tmp_path / "cp", on_counters=lambda *_: None)
    finally:
        counters.count = before
    assert jobs == []


def test_files_of_any_age_are_read(spark, tables, tmp_path):
    raw = tmp_path / "raw"
    for i, days in enumerate((0, 8, 6, 9000)):
        put(raw, f"{i}.json", MESSAGES[i : i + 1])
        when = time.time() - days * 86_400
        os.utime(raw / f"{i}.json", (when, when))
        stream(spark, raw, tables, tmp_path / "cp")
    assert ids(scan_transactions(spark, tables)) == list("abcd")


def test_a_corrected_batch_replaces_all_its_days(spark, tables, tmp_path):
    raw, rejected = tmp_path / "raw", str(tmp_path / "rejects")

    def run(*lines, batch="monday"):
        put(raw, "1.json", list(lines))
        run_batch(spark, str(raw), tables, batch=batch, rejects_path=rejected)
        files = [str(f) for f in Path(rejected).rglob("*.parquet")]
        refused = spark.read.parquet(*files).count() if files else 0
        return (ids(scan_transactions(spark, tables)), ids(scan_anomalies(spark, tables)), refused)

    run(MESSAGES[0], batch="other")
    assert run(*MESSAGES, *BROKEN) == (["a", *"abcd"], ["b", "d"], len(BROKEN))
    other_day = line(transaction_id="e", amount=7000, transaction_timestamp="2024-01-05T00:00:00Z")
    assert run(other_day) == (["a", "e"], ["e"], 0)
    assert run(MESSAGES[0], MESSAGES[2]) == (["a", "a", "c"], [], 0)
    assert run(BROKEN[0]) == (["a"], [], 1)


def test_a_repeat_that_fails_takes_nothing_away(spark, tables, tmp_path):
    put(tmp_path / "raw", "1.json", MESSAGES)
    run_batch(spark, str(tmp_path / "raw"), tables, batch="monday")
    odd = spark.range(3).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in ANOMALIES if f.name != "amount"],
        F.raise_error(F.lit("lost")).cast("double").alias("amount"),
    )
    with pytest.raises(Exception, match="lost"):
        append.append_anomalies(odd, tables, "monday")
    assert ids(scan_anomalies(spark, tables)) == ["b", "d"]


def test_archived_files_are_not_read_again(spark, tables, tmp_path):
    done = tmp_path / "done"
    for folder in ("raw/x", "raw/y"):
        put(tmp_path / folder, "same name.json", MESSAGES[:1] if folder.endswith("x") else MESSAGES[1:2])
    source = str(tmp_path / "raw/*/*.json")
    run_batch(spark, source, tables, archive_dir=str(done))
    assert ids(scan_transactions(spark, tables)) == ["a", "b"]
    assert len(list(done.rglob("same name.json"))) == 2 and not list((tmp_path / "raw").rglob("*.json"))
    assert set(run_batch(spark, source, tables, archive_dir=str(done)).values()) == {0}
    # The same name again, in a later run.
    put(tmp_path / "raw/x", "same name.json", MESSAGES[2:3])
    run_batch(spark, source, tables, archive_dir=str(done))
    assert ids(scan_transactions(spark, tables)) == ["a", "b", "c"]
    assert len(list(done.rglob("same name.json"))) == 3


def test_files_that_arrive_during_a_run_stay(spark, tables, tmp_path, monkeypatch):
    raw = tmp_path / "raw"
    put(raw, "1.json", MESSAGES[:1])
    plain = append.append_anomalies

    def late(*args):
        put(raw, "2.json", MESSAGES[1:2])
        plain(*args)

    with monkeypatch.context() as slow:
        slow.setattr(append, "append_anomalies", late)
        run_batch(spark, str(raw / "*.json"), tables, archive_dir=str(tmp_path / "done"))
    assert ids(scan_transactions(spark, tables)) == ["a"]
    assert [f.name for f in raw.glob("*.json")] == ["2.json"]


def test_a_run_that_fails_leaves_its_files(spark, tables, tmp_path, monkeypatch):
    put(tmp_path / "raw", "1.json", MESSAGES)

    def fail(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(append, "append_anomalies", fail)
    with pytest.raises(RuntimeError):
        run_batch(spark, str(tmp_path / "raw"), tables, archive_dir=str(tmp_path / "done"))
    assert [f.name for f in (tmp_path / "raw").glob("*.json")] == ["1.json"]


def test_counters_of_the_stream_add_up_to_the_batch_jobs(spark, tables, tmp_path):
    raw, told = tmp_path / "raw", {}
    for i, value in enumerate(MESSAGES + BROKEN):
        put(raw, f"{i}.json", [value])
    stream(spark, raw, tables, tmp_path / "cp", max_files_per_trigger=4, on_counters=told.__setitem__)
    other = Tables(str(tmp_path / "batch"))
    create_tables(spark, other)
    whole = run_batch(spark, str(raw), other, run_ts=RUN_TS)
    assert len(told) == 3
    assert {n: sum(t[n] for t in told.values()) for n in whole} == whole


def test_times_of_other_sessions_can_be_skipped_by(spark, tables):
    key = "spark.sql.parquet.outputTimestampType"
    spark.conf.set(key, "INT96")
    try:
        rows = spark.range(400_000).select(
            *[
                F.timestamp_seconds(1704067200 + F.col("id") % 80_000).alias(f.name)
                if f.name == "transaction_timestamp"
                else F.lit("x").cast("string").alias(f.name)
                if f.dataType.typeName() == "string"
                else F.lit(None).cast(f.dataType).alias(f.name)
                for f in TRANSACTIONS
            ]
        )
        append.append_transactions(rows.repartition(4), tables, "b")
        assert spark.conf.get(key) == "INT96"
    finally:
        spark.conf.unset(key)

    def scanned(df):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan()
        while True:
            kind = plan.getClass().getSimpleName()
            if kind == "AdaptiveSparkPlanExec":
                plan = plan.executedPlan()
            elif kind.endswith("QueryStageExec"):
                plan = plan.plan()
            elif plan.children().isEmpty():
                return plan.metrics().apply("numOutputRows").value()
            else:
                plan = plan.children().apply(0)

    table = scan_transactions(spark, tables)
    assert scanned(table.select("transaction_timestamp")) == 400_000
    late = table.filter(F.col("transaction_timestamp") >= F.timestamp_seconds(F.lit(1704067200 + 79_990)))
    assert scanned(late.select("transaction_timestamp")) < 100_000


def test_later_runs_see_their_own_time(spark, tables, tmp_path):
    put(tmp_path / "raw", "1.json", MESSAGES[:1])
    for hours in (0, 1):
        run_batch(spark, str(tmp_path / "raw"), tables, run_ts=RUN_TS + timedelta(hours=hours))
    assert scan_transactions(spark, tables).select("processed_at").distinct().count() == 2
