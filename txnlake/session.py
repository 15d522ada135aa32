"""Session settings and the shared work folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Dates, hours and offset-free timestamps are all read in UTC.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Parquet cannot skip by timestamps of the older default type.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def build_session(app: str = "txnlake", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set what the operators rely on in a session made by somebody else."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def require_utc(spark: SparkSession) -> None:
    """Days and hours are those of UTC; another session time zone would shift them."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone.upper() not in ("UTC", "ETC/UTC", "Z", "+00:00"):
        raise ValueError(f"set spark.sql.session.timeZone to UTC, not {zone}")


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new, empty path for intermediate tables, in the cluster's shared folder.

    A folder on the driver's own disk is used only in local mode, and only if
    `spark.checkpoint.dir` is unset.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        base = tempfile.mkdtemp(prefix="txnlake-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
    return f"{base.rstrip('/')}/txnlake/{purpose}-{uuid.uuid4()}"


@contextmanager
def table_writes(spark: SparkSession) -> Iterator[None]:
    """What a write into the tables relies on, whoever made the session.

    Timestamps are of the type that Parquet can skip by, and an overwrite replaces
    the partitions that it has rows for, and no others.
    """
    wanted = {
        "spark.sql.parquet.outputTimestampType": SETTINGS["spark.sql.parquet.outputTimestampType"],
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def hadoop_path(spark: SparkSession, path: str):
    """The path and its file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Delete a folder when the driver's JVM ends, whether or not the session was stopped before."""
    target, fs = hadoop_path(spark, path)
    fs.deleteOnExit(target)


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder of this package's own making, if it is there."""
    target, fs = hadoop_path(spark, path)
    fs.delete(target, True)
