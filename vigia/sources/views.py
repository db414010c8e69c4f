"""Registering and materialising an event DataFrame for reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, functions as F

VIEW = "logs"


def register(df: DataFrame, name: str = VIEW) -> DataFrame:
    """Make ``df`` queryable as a temporary view."""
    df.createOrReplaceTempView(name)
    return df


def materialise(
    df: DataFrame, columns: Sequence[str] | None = None, staging: str | None = None
) -> tuple[DataFrame, int]:
    """Keep the needed columns at hand and count the rows.

    Worth it for CSV, JSON and JDBC, which would be parsed or fetched again by
    each analysis.  With ``staging`` they are written there as Parquet, which
    outlives executors and prunes columns, and the rows are counted while they are
    written; without, they are cached, and counting fills the cache.
    """
    needed = df.select(*columns) if columns else df
    if staging:
        seen = Observation()
        needed.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(staging)
        return df.sparkSession.read.schema(needed.schema).parquet(staging), seen.get["rows"]
    kept = needed.persist(StorageLevel.MEMORY_AND_DISK)
    return kept, kept.count()
