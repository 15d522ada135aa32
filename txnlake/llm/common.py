"""What the operators share: reading, intermediate tables, Arrow batches."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import txnlake
from txnlake.session import delete_at_exit, work_dir

#: Texts of a batch are taken in portions of about so many characters, so that
#: the memory of a Python worker does not depend on the number of rows.
PORTION_CHARS = 4_000_000
BATCH_ROWS = 1_000

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def with_row(docs: DataFrame) -> DataFrame:
    """doc_id, text and the whole row as `doc`, so that no other column can clash with new ones."""
    return docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write `df` into the shared work folder and read it again.

    This cuts the lineage at a table that outlives any executor. The shuffle files
    that the table was made from go at once, the table when the driver ends.
    """
    spark = df.sparkSession
    path = work_dir(spark, purpose)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    delete_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def held(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later expressions reuse instead of computing them again.

    A generator of one row keeps the optimizer from copying the expressions
    into each place that refers to them.
    """
    made = F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))
    return df.select("*", made)


def portions(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about PORTION_CHARS bytes of text each, one row at least."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        lengths = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_numpy(zero_copy_only=False)
        start, size = 0, 0
        for i, n in enumerate(lengths):
            if size and size + n > PORTION_CHARS:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += int(n)
        if start < batch.num_rows:
            yield batch.slice(start)


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and text only: other columns are not looked at."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, once per Spark context."""
    context = spark.sparkContext
    name = f"txnlake-{context.applicationId}.zip"
    if any(name in x for x in context._python_includes):
        return
    folder, root = tempfile.mkdtemp(), Path(txnlake.__file__).parent.parent
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    with zipfile.ZipFile(Path(folder, name), "w") as out:
        for path in sorted(root.glob("txnlake/**/*.py")):
            out.write(path, path.relative_to(root))
    context.addPyFile(str(Path(folder, name)))  # Spark serves it to the executors


def map_arrow(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """mapInArrow with batches that stay small when texts are long."""
    ship(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(function, schema)
