"""From message records to canonical events, for streams and batches alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.codec import CORRUPT, decode_event
from ..operators.windows import first_per_key
from ..schema import EVENT_COLUMNS, META_COLUMNS, REQUIRED_COLUMNS

REASON, RAW = "_reason", "_raw"
MALFORMED = "malformed"


def _reason(event: Column) -> Column:
    """Why a record is rejected; null for a good one."""
    missing = F.concat_ws(
        ",", *(F.when(event[c].isNull(), F.lit(c)) for c in REQUIRED_COLUMNS)
    )
    return (
        F.when(event.isNull() | event[CORRUPT].isNotNull(), F.lit(MALFORMED))
        .when(missing != "", F.concat(F.lit("missing:"), missing))
    )


def decode_records(records: DataFrame) -> DataFrame:
    """Decode, enrich and conform; empty messages are skipped.

    Adds the bookkeeping columns, the raw text and the reason of rejection.
    """
    parsed = records.where(F.col("value").isNotNull() & (F.col("value") != "")).withColumn(
        "__event", decode_event(F.col("value"))
    )
    event = F.col("__event")
    return parsed.select(
        *(event[c].alias(c) for c in EVENT_COLUMNS),
        F.col("topic").alias("_kafka_topic"),
        F.col("partition").alias("_kafka_partition"),
        F.col("offset").alias("_kafka_offset"),
        F.col("timestamp").alias("_kafka_timestamp"),
        F.current_timestamp().alias("_consumer_ts"),
        F.col("value").alias(RAW),
        _reason(event).alias(REASON),
    ).withColumn("timestamp_evento", F.date_trunc("second", "timestamp_evento"))


def valid_events(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col(REASON).isNull()).drop(RAW, REASON)


def decodable_events(decoded: DataFrame) -> DataFrame:
    """Everything that could be decoded, with or without its required fields."""
    return decoded.where(F.col(REASON).isNull() | (F.col(REASON) != MALFORMED)).drop(RAW, REASON)


def dead_letters(decoded: DataFrame) -> DataFrame:
    """Rejected records: bookkeeping columns, raw text and reason."""
    return decoded.where(F.col(REASON).isNotNull()).select(*META_COLUMNS, RAW, REASON)


# Content decides only between records that carry no position at all.
ARRIVAL = [
    *("_kafka_timestamp", "_kafka_topic", "_kafka_partition", "_kafka_offset"),
    *("timestamp_evento", "servidor", "mensaje"),
]


def first_arrivals(events: DataFrame) -> DataFrame:
    """One row per id, the earliest by broker time, topic, partition, offset."""
    return first_per_key(events, ["id_log"], [F.col(c).asc_nulls_last() for c in ARRIVAL])


def first_arrivals_in_stream(events: DataFrame, horizon: str, delay: str) -> DataFrame:
    """One row per id and event-time span of length ``horizon``: the earliest by broker order, whatever batch it came in.

    For streams that read brokers or partitions at different speeds, where the row
    that comes first need not be the first that was sent.  A row is given out when the
    watermark (latest event time less ``delay``) passes its span, and leaves the state
    then: the state holds the ids of one span and ``delay``.  Copies that come later are
    dropped.  Copies have to carry the event time of the original, as redelivered
    messages do; an id with events in two spans gives one row in each.

    Append mode.  Rows of one id are cut to one in each task before the shuffle.
    """
    order = F.struct(*(x for i, c in enumerate(ARRIVAL) for x in (F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"v{i}"))))
    row = F.struct(*events.columns)
    timed = events.withWatermark("timestamp_evento", delay)
    first = timed.groupBy("id_log", F.window("timestamp_evento", horizon)).agg(F.min_by(row, order).alias("row"))
    return first.select("row.*")


def distinct_events(events: DataFrame, horizon: str | None = None) -> DataFrame:
    """In-stream duplicate elimination on the id.

    Without ``horizon`` the state keeps every id ever seen, which needs the
    RocksDB state store on a long-running stream.  ``horizon`` (for instance
    "1 day") keeps ids of that event time only; Spark then drops events that
    arrive later than it, so choose it above the longest delay.
    """
    if horizon is None:
        return events.dropDuplicates(["id_log"])
    return events.withWatermark("timestamp_evento", horizon).dropDuplicatesWithinWatermark(["id_log"])
