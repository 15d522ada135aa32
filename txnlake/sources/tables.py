"""The tables in Spark's catalog: declaring, finding and scanning them.

Each table is a Parquet table of the session catalog, partitioned by day and
batch, in a folder of the dataset. A catalog that is kept (a metastore) knows it
from then on, also for other programs. In a session whose catalog is not kept, the
first use declares the table again from its folder and recovers its partitions.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlake.schemas import ANOMALIES, BATCH, BY_HOUR, BY_USER, DAY, DETECTED_DAY, SOURCE, TRANSACTIONS
from txnlake.session import hadoop_path, require_utc
from txnlake.settings import Tables

# What files are clustered by besides time.
CLUSTER_BY = ("transaction_type", "status")
#: The partition of a day that holds its merged batches. No batch can have this name.
MERGED = "~merged"

# A Bloom filter per row group says which users are not in it. It has a place for so many users.
USERS_PER_ROW_GROUP = 100_000
USER_FILTER = {
    "parquet.bloom.filter.enabled#user_id": "true",
    "parquet.bloom.filter.expected.ndv#user_id": str(USERS_PER_ROW_GROUP),
}


@dataclass(frozen=True)
class Layout:
    """A table: its name in the catalog, its folder, its own columns, its day column, what it is sorted by."""

    name: str
    path: str
    columns: T.StructType
    day: str
    cluster_by: tuple[str, ...] = ()
    options: dict[str, str] = field(default_factory=dict)

    @property
    def stored(self) -> list[str]:
        """All columns in the order of the table."""
        return [*self.columns.names, SOURCE, self.day, BATCH]


def transactions_layout(tables: Tables) -> Layout:
    name = tables.transactions
    sort = (*CLUSTER_BY, "transaction_timestamp")
    return Layout(tables.name(name), tables.path(name), TRANSACTIONS, DAY, sort, USER_FILTER)


def anomalies_layout(tables: Tables) -> Layout:
    name = tables.anomalies
    sort = ("transaction_timestamp",)
    return Layout(tables.name(name), tables.path(name), ANOMALIES, DETECTED_DAY, sort, USER_FILTER)


def by_hour_layout(tables: Tables) -> Layout:
    name = tables.by_hour
    return Layout(tables.name(name), tables.path(name), BY_HOUR, DAY, ("hour",))


def by_user_layout(tables: Tables) -> Layout:
    name = tables.by_user
    return Layout(tables.name(name), tables.path(name), BY_USER, DAY, ("user_id",))


def layouts(tables: Tables) -> list[Layout]:
    return [make(tables) for make in (transactions_layout, anomalies_layout, by_hour_layout, by_user_layout)]


class TableNotFound(LookupError):
    pass


def _text(value: str) -> str:
    """A string in SQL."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _declare(spark: SparkSession, table: Layout) -> None:
    columns = [*table.columns, *[T.StructField(n, T.StringType()) for n in (SOURCE, BATCH)], T.StructField(table.day, T.DateType())]
    types = {f.name: f.dataType.simpleString() for f in columns}
    options = ", ".join(f"{_text(k)}={_text(v)}" for k, v in table.options.items())
    target, fs = hadoop_path(spark, table.path)
    database = table.name.partition(".")[0]
    # Its own folder, which goes when the database is dropped, holds none of the tables.
    own, _ = hadoop_path(spark, f"{target.getParent()}/_database")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION {_text(fs.makeQualified(own).toString())}")
    spark.sql(
        f"""CREATE TABLE {table.name} ({", ".join(f"{n} {types[n]}" for n in table.stored)}) USING parquet
        {f"OPTIONS ({options})" if options else ""} PARTITIONED BY ({table.day}, {BATCH})
        LOCATION {_text(fs.makeQualified(target).toString())}"""
    )


def attach(spark: SparkSession, table: Layout) -> None:
    """Make sure that the session's catalog knows a table that was created earlier."""
    if spark.catalog.tableExists(table.name):
        return
    target, fs = hadoop_path(spark, table.path)
    if not fs.exists(target):
        raise TableNotFound(f"no table at {table.path}; create it first")
    _declare(spark, table)
    spark.sql(f"ALTER TABLE {table.name} RECOVER PARTITIONS")


def create_tables(spark: SparkSession, tables: Tables) -> None:
    """Make the tables, empty. Fails, and makes none, if one is there already."""
    for table in layouts(tables):
        target, fs = hadoop_path(spark, table.path)
        if fs.exists(target) or spark.catalog.tableExists(table.name):
            raise FileExistsError(f"{table.path} already exists")
    for table in layouts(tables):
        target, fs = hadoop_path(spark, table.path)
        fs.mkdirs(target)
        _declare(spark, table)


def refresh_tables(spark: SparkSession, tables: Tables) -> None:
    """Learn what other programs wrote, in a session whose catalog they do not share."""
    for table in layouts(tables):
        attach(spark, table)
        spark.sql(f"MSCK REPAIR TABLE {table.name} SYNC PARTITIONS")


def require_tables(spark: SparkSession, tables: Tables) -> None:
    for table in layouts(tables):
        attach(spark, table)


def partitions(spark: SparkSession, table: Layout, batch: str | None = None) -> list[tuple[date, str]]:
    """Day and batch of each partition, or of those of one batch, as the catalog has them."""
    attach(spark, table)
    of = f" PARTITION ({BATCH}={_text(batch)})" if batch else ""
    found = []
    for row in spark.sql(f"SHOW PARTITIONS {table.name}{of}").collect():  # a row per folder
        day, _, name = row[0].partition("/")
        found.append((date.fromisoformat(day.partition("=")[2]), name.partition("=")[2]))
    return sorted(found)


def partition_path(table: Layout, day: date, batch: str) -> str:
    return f"{table.path}/{table.day}={day.isoformat()}/{BATCH}={batch}"


def days_of(spark: SparkSession, table: Layout) -> list[date]:
    return sorted({day for day, _ in partitions(spark, table)})


def scan(spark: SparkSession, table: Layout, first_day: date | None = None, last_day: date | None = None) -> DataFrame:
    """The table with all its stored columns, or some days of it; the folders of other days are not even listed."""
    require_utc(spark)
    attach(spark, table)
    # Another session of this application, such as a stream's, may have written since.
    spark.catalog.refreshTable(table.name)
    rows = spark.table(table.name)
    if first_day is not None:
        rows = rows.filter(F.col(table.day) >= F.lit(first_day))
    if last_day is not None:
        rows = rows.filter(F.col(table.day) <= F.lit(last_day))
    return rows


def scan_transactions(
    spark: SparkSession,
    tables: Tables,
    first_day: date | None = None,
    last_day: date | None = None,
) -> DataFrame:
    """The 12 table columns and the day partition, which `since` and `recent` prune by."""
    return scan(spark, transactions_layout(tables), first_day, last_day).drop(SOURCE, BATCH)


def scan_anomalies(
    spark: SparkSession,
    tables: Tables,
    first_day: date | None = None,
    last_day: date | None = None,
) -> DataFrame:
    found = scan(spark, anomalies_layout(tables), first_day, last_day)
    return found.drop(SOURCE, BATCH, DETECTED_DAY)


def register_views(spark: SparkSession, tables: Tables) -> None:
    """Make both tables known by their short names to SQL in this session, without the storage columns."""
    scan_transactions(spark, tables).createOrReplaceTempView(tables.transactions)
    scan_anomalies(spark, tables).createOrReplaceTempView(tables.anomalies)


def since(transactions: DataFrame, start: Column) -> DataFrame:
    """Rows from `start` on. The day predicate is what prunes partitions."""
    require_utc(transactions.sparkSession)
    rows = transactions.filter(F.col("transaction_timestamp") >= start)
    if DAY in transactions.columns:
        rows = rows.filter(F.col(DAY) >= F.to_date(start))
    return rows


def on_day(transactions: DataFrame, moment: Column) -> DataFrame:
    """Rows of the UTC day that holds `moment`."""
    require_utc(transactions.sparkSession)
    rows = transactions.filter(F.to_date("transaction_timestamp") == F.to_date(moment))
    if DAY in transactions.columns:
        rows = rows.filter(F.col(DAY) == F.to_date(moment))
    return rows
