"""Every registered query against its reference SQL, at the smallest scale."""

import pytest
from conftest import TESTDATA
from oracle_check import compare, duck

import __spark_entry__ as entry
from vigia.plans import oracle, registry

SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return duck(f"{TESTDATA}/sf0.001")


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_reference_sql(spark, con, name):
    assert compare(QUERIES[name](spark, f"{TESTDATA}/sf0.001"), con, SQL[name]) is None


def test_every_exact_query_has_reference_sql():
    assert set(oracle.oracle_sql()) == set(registry.queries())


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["servicio", "total", "errores", "pct_error"]
    assert df.count() == 20


def test_event_view_matches_column_by_column(spark, sf_dir, con):
    """All 37 columns of the derived event table, as text."""
    from pyspark.sql import functions as F

    from vigia.plans.fixture import logs_view
    from vigia.plans.oracle import LOGS
    from vigia.schema import EVENT_COLUMNS

    def ours(c):
        if c == "timestamp_evento":
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
        return F.col(c).cast("string").alias(c)

    def theirs(c):
        if c == "timestamp_evento":
            return f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}"
        return f"CAST({c} AS VARCHAR) AS {c}"

    df = logs_view(spark, sf_dir).select(*map(ours, EVENT_COLUMNS))
    assert compare(df, con, f"WITH {LOGS} SELECT {', '.join(map(theirs, EVENT_COLUMNS))} FROM logs") is None
