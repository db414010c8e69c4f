"""Benchmark: prints one JSON line.

``value`` is the four-query workload (B1-B4, uncached) over an event table of
315,453 rows, the size of the published run it is compared with.  ``queries``
holds the median seconds of every analysis over the stored event table of
``$BENCH_SF_DIR`` and of the operators on its generic tables, and the seconds of one
run of those that write.

The event tables are written once, before anything is timed, as the published
run timed a loaded table.  The first run of each query is discarded.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from vigia.functions import round_half_up  # noqa: E402
from vigia.operators import run  # noqa: E402
from vigia.plans import BENCHMARK, CSV_SUITE, JSON_SUITE, SQL_SUITE, run_workload  # noqa: E402
from vigia.plans.fixture import grown_events, logs_from_events, read_table  # noqa: E402
from vigia.plans.registry import queries  # noqa: E402
from vigia.session import build_session, scratch_path  # noqa: E402
from vigia.sources import read_events, write_events  # noqa: E402

PUBLISHED_ROWS = 315_453
PUBLISHED_SECONDS = {"local_1": 12.24, "local_n": 2.44}
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

NATIVE = [
    "op_left_anti_ingest",
    "op_dim_join",
    "op_lookup_join",
    "op_topk",
    "op_top1_per_group",
    "op_rank",
    "op_conditional_rate",
    "op_having",
    "op_percentile_exact",
    "op_percentile_approx",
    "op_case_bucket",
    "op_group_expr_hour",
    "op_dedupe_first",
    "op_spec_groups",
    "op_json_decode",
    "op_quality_report",
    "op_quality_split",
    "op_quality_dependency",
    "op_rank_ties",
    "op_crc32_split",
    "op_server_dim",
    "op_json_encode_route",
]

# Streams and trips through stored files: they write, so one run each is timed, the first.
STORED = [
    "op_csv_roundtrip",
    "op_csv_reordered",
    "op_csv_rejects",
    "op_jsonl_roundtrip",
    "op_event_table_scan",
    "op_percentile_sketch",
    "op_suite_one_scan",
    "op_report_incremental",
    "op_report_saved",
    "op_split_reads",
    "op_stream_ingest",
    "op_ingest_indexed",
    "op_stream_dead_letters",
    "op_stream_copies",
    "op_copy_dead_letters",
    "op_stream_distinct",
    "op_stream_windowed",
]


def median_seconds(action) -> float:
    action()
    taken = []
    for _ in range(RUNS):
        started = time.monotonic()
        action()
        taken.append(time.monotonic() - started)
    return round(statistics.median(taken), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        shuffle_partitions=8,
        extra={"spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    def noop(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    events = read_table(spark, sf_dir, "events")
    published, stored = scratch_path(spark, "published"), scratch_path(spark, "stored")
    write_events(logs_from_events(grown_events(events, PUBLISHED_ROWS)), published)
    write_events(logs_from_events(events), stored)

    workload = median_seconds(lambda: run_workload(read_events(spark, published), f"local_{cpus}"))
    logs = read_events(spark, stored)
    times = {}
    for name, query in BENCHMARK.items():
        times[name] = median_seconds(lambda: query(logs).collect())
    for a in CSV_SUITE + JSON_SUITE:
        times[a.name] = median_seconds(lambda: run(logs, a, round_half_up).collect())
    for name, (query, _) in SQL_SUITE.items():
        times[name] = median_seconds(lambda: query(logs).collect())
    times["q7_response_percentiles_exact"] = median_seconds(
        lambda: SQL_SUITE["q7_response_percentiles"][0](logs, exact=True).collect()
    )
    registered = queries()
    for name in NATIVE:
        times[name] = median_seconds(lambda: noop(registered[name](spark, sf_dir)))
    for name in STORED:
        started = time.monotonic()
        noop(registered[name](spark, sf_dir))
        times[name] = round(time.monotonic() - started, 3)
    spark.stop()

    print(
        json.dumps(
            {
                "metric": f"workload B1-B4 over {PUBLISHED_ROWS} events",
                "value": workload,
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "rows_per_sec": round(PUBLISHED_ROWS / workload),
                "published_sec": PUBLISHED_SECONDS,
            }
        )
    )


if __name__ == "__main__":
    main()
