"""Run a suite of analyses from the command line.

    python -m vigia json --input data/eventos.jsonl --output out
    python -m vigia csv --input data/eventos.csv --output out
    python -m vigia sql --input warehouse/logs --output out
    python -m vigia comparacion --input warehouse/logs --output out --mode local_n
    python -m vigia copias --input warehouse/logs --output data

``sql`` and ``comparacion`` read the database named by MYSQL_* when there is
no ``--input``; with one they read the Parquet event table.  ``todos`` runs
the four in this order and stops at the first failure.  ``copias`` writes the
event table as JSON lines and CSV.
"""

from __future__ import annotations

import argparse
import os

from .plans import SUITES, run_report, run_workload, save_timing
from .session import build_session
from .sources import (
    JdbcTable,
    print_result,
    read_csv,
    read_events,
    read_jdbc,
    read_jsonl,
    write_csv,
    write_jsonl,
)


def _events(spark, path):
    return read_events(spark, path) if path else read_jdbc(spark, JdbcTable.from_env())


def run_job(spark, job: str, args) -> None:
    if job == "copias":
        events = _events(spark, args.input)
        write_jsonl(events, f"{args.output}/eventos.jsonl", "overwrite")
        write_csv(events, f"{args.output}/eventos.csv", "overwrite")
        print(f"copias: JSON lines and CSV in {args.output}")
        return
    if job == "comparacion":
        timing = run_workload(_events(spark, args.input), args.mode)
        print(f"{timing.modo}: {timing.tiempo_segundos} s, {timing.registros} rows")
        save_timing(spark, timing, f"{args.output}/resultado_comparacion/comparacion.csv")
        return
    show = print_result
    if job == "json":
        df = read_jsonl(spark, args.json or args.input)
    elif job == "csv":
        df = read_csv(spark, args.csv or args.input)
    else:
        df = _events(spark, args.input)
        show = lambda result: print_result(result, 50, truncate=False)
    # Parquet is scanned per analysis with its own columns; the rest is parsed once.
    parquet = job == "sql" and bool(args.input)
    staging = f"{args.staging}/{job}" if args.staging and not parquet else None
    report = run_report(df, SUITES[job], args.output, job, cache=not parquet, staging=staging, show=show)
    rows = "" if report.rows is None else f", {report.rows} rows"
    print(f"{job}: {report.seconds:.2f} s{rows}; saved {len(report.saved)} results")


def main(argv: list[str] | None = None) -> None:
    env = os.environ
    parser = argparse.ArgumentParser(prog="vigia")
    parser.add_argument("job", nargs="?", default="todos", choices=[*SUITES, "comparacion", "todos", "copias"])
    parser.add_argument("--input", default=env.get("DATA_PATH"))
    parser.add_argument("--json", default=env.get("DATA_JSON"), help="JSON-lines input")
    parser.add_argument("--csv", default=env.get("DATA_CSV"), help="CSV input")
    parser.add_argument("--output", default=env.get("OUTPUT_DIR", "output"))
    parser.add_argument("--master", default=env.get("SPARK_MASTER"))
    parser.add_argument("--staging", help="keep parsed sources as Parquet here instead of caching")
    parser.add_argument("--mode", default="spark", help="label of a comparacion run")
    args = parser.parse_args(argv)

    spark = build_session(f"vigia-{args.job}", args.master)
    try:
        for job in ["json", "csv", "sql", "comparacion"] if args.job == "todos" else [args.job]:
            run_job(spark, job, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
