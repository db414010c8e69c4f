from .analyses import BENCHMARK, CSV_SUITE, JSON_SUITE, SQL_SUITE
from .benchmark import Timing, run_workload, save_timing, speed_up
from .report import SUITES, Report, build, run_report
from .sql import SQL_CATALOG, SqlAnalysis, run_sql

__all__ = [
    "BENCHMARK",
    "CSV_SUITE",
    "JSON_SUITE",
    "Report",
    "SQL_CATALOG",
    "SQL_SUITE",
    "SUITES",
    "SqlAnalysis",
    "Timing",
    "build",
    "run_report",
    "run_sql",
    "run_workload",
    "save_timing",
    "speed_up",
]
