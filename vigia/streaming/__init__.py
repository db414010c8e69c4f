from .index import IdIndex
from .ingest import dead_letters, decodable_events, decode_records, distinct_events, first_arrivals_in_stream, valid_events
from .queries import (
    ProgressLog,
    drain_and_stop,
    keep_batches,
    progress_of,
    start_copies,
    start_csv_copy,
    start_jdbc_ingest,
    start_jsonl_copy,
    start_stream,
    start_table_ingest,
)
from .records import RECORD_SCHEMA, file_records, kafka_records, text_records
from .windows import read_late, read_windows, start_windowed_counts, windowed_counts

__all__ = [
    "IdIndex",
    "ProgressLog",
    "RECORD_SCHEMA",
    "dead_letters",
    "decodable_events",
    "decode_records",
    "distinct_events",
    "drain_and_stop",
    "file_records",
    "first_arrivals_in_stream",
    "kafka_records",
    "keep_batches",
    "progress_of",
    "read_late",
    "read_windows",
    "start_copies",
    "start_csv_copy",
    "start_jdbc_ingest",
    "start_jsonl_copy",
    "start_stream",
    "start_table_ingest",
    "start_windowed_counts",
    "text_records",
    "valid_events",
    "windowed_counts",
]
