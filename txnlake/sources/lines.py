"""Raw JSON text: files in batch, files or a message queue in streaming."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Spark leaves out files that are older than the newest one seen by more than this;
# a backfill or a copy that keeps times must not be lost that way.
MAX_FILE_AGE = "36500d"
SOURCE_FILE = "source_file"


def read_lines(spark: SparkSession, path: str) -> DataFrame | None:
    """Lines of all files that match `path`, blank ones included; None if none match.

    Only a line feed ends a line: a lone carriage return is white space inside JSON.
    """
    try:
        return spark.read.option("lineSep", "\n").text(path).select("value")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def stream_files(
    spark: SparkSession, path: str, *, max_files_per_trigger: int | None = 1000
) -> DataFrame:
    """Lines of new files matching `path`, each file read once per checkpoint, and the file they come from.

    Files of any age are read. The driver remembers each file seen, so let the job
    archive them (`run_stream(archive_dir=...)`).
    """
    reader = (
        spark.readStream.format("text").option("lineSep", "\n").option("maxFileAge", MAX_FILE_AGE)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).select("value", F.col("_metadata.file_path").alias(SOURCE_FILE))


def stream_kafka(
    spark: SparkSession,
    servers: str,
    topic: str,
    *,
    max_offsets_per_trigger: int | None = 10_000_000,
    **options: str,
) -> DataFrame:
    """Message bodies of a Kafka topic as bytes. Needs the spark-sql-kafka package.

    A new query starts with the oldest message that the topic still holds. The
    limit only sets how much one micro-batch takes on; nothing is left out.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**options)
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load().select("value")
