import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    from vigia.session import build_session

    session = build_session(
        "tests", "local[8]", shuffle_partitions=8, extra={"spark.ui.showConsoleProgress": "false"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="session")
def logs(spark, sf_dir):
    """The event table at the smallest scale, cached."""
    from vigia.plans.fixture import logs_view

    df = logs_view(spark, sf_dir).persist()
    df.count()
    return df


def numbered_events(numbers, step="INTERVAL 1 SECOND", with_meta=False):
    """Event rows for the column ``id`` of ``numbers``, through the test view; with the place in the stream on request."""
    from pyspark.sql import functions as F

    from vigia.functions import topic_of
    from vigia.plans.fixture import logs_from_events

    kinds = "array('view', 'error', 'click', 'signup', 'purchase')"
    events = numbers.selectExpr(
        "id AS event_id",
        f"TIMESTAMP '2026-01-01 00:00:00' + id * {step} AS ts",
        "id % 97 AS user_id",
        f"element_at({kinds}, cast(id % 5 + 1 AS int)) AS event_type",
        "concat('{\"k\": ', id * 31 % 1009, '}') AS props",
    )
    made = logs_from_events(events)
    if not with_meta:
        return made
    return made.withColumns(
        {
            "_kafka_topic": topic_of(F.col("tipo_evento")),
            "_kafka_partition": (F.crc32("servidor") % 3).cast("int"),
            "_kafka_offset": F.substring_index("id_log", "-", -1).cast("bigint"),
            "_kafka_timestamp": F.col("timestamp_evento"),
            "_consumer_ts": F.col("timestamp_evento") + F.expr("INTERVAL 1 SECOND"),
        }
    )


def rows(df, *order):
    """Rows as tuples, sorted unless an order is already part of the result."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=repr) if not order else out


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
