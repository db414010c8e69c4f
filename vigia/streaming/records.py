"""Message sources.  All give the same columns, so ingestion does not care
whether records come from Kafka or from files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..schema import TOPICS

RECORD_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)


def kafka_records(
    spark: SparkSession,
    servers: str,
    topics: Sequence[str] = tuple(TOPICS),
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> DataFrame:
    """All topics as one stream (needs the Kafka package on the cluster).

    ``min_partitions`` splits the offset ranges of few or uneven topic
    partitions over more tasks.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting_offsets)
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    if min_partitions:
        reader = reader.option("minPartitions", min_partitions)
    raw = reader.load()
    return raw.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in RECORD_SCHEMA))


def file_records(
    spark: SparkSession, path: str, fmt: str = "json", max_files_per_trigger: int | None = None
) -> DataFrame:
    """A stream of stored records: files whose rows have the record columns."""
    reader = spark.readStream.schema(RECORD_SCHEMA).option("recursiveFileLookup", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.format(fmt).load(path)


def text_records(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """A stream of raw message lines, one directory per topic below ``path``.

    The directory is ``<topic>`` or ``topic=<topic>``.  Lines have no
    partition or offset; the file's modification time stands in for the
    broker time.
    """
    reader = spark.readStream.format("text").option("recursiveFileLookup", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    directory = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return reader.load(path).select(
        F.lit(None).cast("string").alias("key"),
        F.col("value"),
        F.regexp_replace(directory, "^topic=", "").alias("topic"),
        F.lit(None).cast("int").alias("partition"),
        F.lit(None).cast("bigint").alias("offset"),
        F.col("_metadata.file_modification_time").alias("timestamp"),
    )
