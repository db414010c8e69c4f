"""Batch sinks: the event table, file copies, topic messages, result files."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.codec import encode_event, topic_of
from ..schema import EVENT_COLUMNS, META_SCHEMA, typed_columns

ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"

# Header per file, quotes doubled, nulls empty; blanks around a value are kept.
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "nullValue": "",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "timestampFormat": ISO_MILLIS,
}

JSON_OPTIONS = {"ignoreNullFields": False, "timestampFormat": ISO_MILLIS}

# A result up to this size is written by one task.


def write_events(df: DataFrame, path: str, mode: str = "append") -> None:
    """Write the Parquet event table, partitioned by event date.

    The rebalance hint lets AQE give each file a good size: small dates are
    merged into one file and a date with most of the rows is split over tasks.
    """
    dated = df.select(*EVENT_COLUMNS).withColumn("fecha", F.to_date("timestamp_evento"))
    dated.hint("rebalance", "fecha").write.mode(mode).partitionBy("fecha").parquet(path)


def with_all_columns(df: DataFrame) -> DataFrame:
    """The 37 event columns and the 5 bookkeeping columns; broker time in epoch ms."""
    stored = df.select(*EVENT_COLUMNS, *typed_columns(df, META_SCHEMA))
    return stored.withColumn("_kafka_timestamp", F.unix_millis("_kafka_timestamp"))


def write_csv(df: DataFrame, path: str, mode: str = "append") -> None:
    """CSV copy with bookkeeping columns."""
    with_all_columns(df).write.mode(mode).options(**CSV_OPTIONS).csv(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "append") -> None:
    """JSON-lines copy with bookkeeping columns and explicit nulls."""
    with_all_columns(df).write.mode(mode).options(**JSON_OPTIONS).json(path)


def publish_rows(df: DataFrame) -> DataFrame:
    """Events as messages: ``topic`` by event type, ``key`` = server, JSON ``value``."""
    return df.select(
        topic_of(F.col("tipo_evento")).alias("topic"),
        F.col("servidor").alias("key"),
        encode_event().alias("value"),
    )


def publish(df: DataFrame, servers: str, rejected: str) -> None:
    """Send events to Kafka and wait for all replicas (needs the Kafka package).

    Messages of an unknown event type have no topic; they are appended to the
    Parquet directory ``rejected``.
    """
    messages = publish_rows(df)
    messages.where(F.col("topic").isNull()).write.mode("append").parquet(rejected)
    messages.where(F.col("topic").isNotNull()).write.format("kafka").option(
        "kafka.bootstrap.servers", servers
    ).option("kafka.acks", "all").save()


def export_csv(df: DataFrame, path: str, single_file: bool = True) -> None:
    """An analysis result as CSV with a header, replacing the old one.

    One file by default, as analyses return few rows; ``single_file=False``
    keeps the partitions of a result that grows with the data.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def print_result(df: DataFrame, rows: int = 20, truncate: bool = True) -> None:
    df.show(rows, truncate)
