from .files import csv_headers, read_csv, read_csv_rejects, read_events, read_jsonl
from .jdbc import JdbcTable, append_jdbc, read_jdbc, read_jdbc_keys
from .sinks import export_csv, publish_rows, print_result, write_csv, write_events, write_jsonl
from .splits import read_split, write_splits
from .views import materialise, register

__all__ = [
    "JdbcTable",
    "append_jdbc",
    "csv_headers",
    "export_csv",
    "materialise",
    "print_result",
    "publish_rows",
    "read_csv",
    "read_csv_rejects",
    "read_events",
    "read_jdbc",
    "read_jdbc_keys",
    "read_jsonl",
    "read_split",
    "register",
    "write_csv",
    "write_events",
    "write_jsonl",
    "write_splits",
]
