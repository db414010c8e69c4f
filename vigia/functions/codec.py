"""JSON payloads: encode an event row, decode a message, choose its topic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from ..schema import EVENT_COLUMNS, EVENT_SCHEMA, TOPIC_OF_TYPE

CORRUPT = "_corrupt"

# Nullable twin of the table: from_json leaves absent keys null.
PAYLOAD_SCHEMA = T.StructType(
    [T.StructField(f.name, f.dataType, True) for f in EVENT_SCHEMA]
    + [T.StructField(CORRUPT, T.StringType(), True)]
)


def decode_event(value: Column) -> Column:
    """JSON text to the event struct plus ``_corrupt`` (null when well formed)."""
    return F.from_json(
        value.cast("string"),
        PAYLOAD_SCHEMA,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )


def encode_event() -> Column:
    """The event row as JSON text; nulls are written, times are ISO-8601 UTC."""
    return F.to_json(
        F.struct(*EVENT_COLUMNS),
        {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"},
    )


def topic_of(event_type: Column) -> Column:
    """Topic that carries an event type; null for an unknown type."""
    routed = None
    for kind, topic in TOPIC_OF_TYPE.items():
        hit = event_type == kind
        routed = F.when(hit, topic) if routed is None else routed.when(hit, topic)
    return routed
