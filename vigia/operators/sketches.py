"""Stored quantile sketches: one KLL sketch a day and group, merged for any range of days.

A sketch keeps a few hundred values of a group, whatever its size, with a bounded
error of rank.  Merging keeps the bound, so days are sketched once, when they are
loaded, and a report over months reads the sketches instead of the events.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

#: Size parameter of the sketches, and the rank error (share of the rows) that it
#: keeps: ``1.65 %`` at 200 by the published analysis, falling as 1 / k ** 0.9.
SKETCH_K, RANK_ERROR = 800, 0.005

DAY, SKETCH, ROWS, LEAST, MOST = "fecha", "__sketch", "filas", "minimo", "maximo"


def _kind(dtype: T.DataType) -> str:
    return "bigint" if isinstance(dtype, T.IntegralType) else "double"


def _call(name: str, kind: str):
    return getattr(F, f"kll_{name}_{kind}")


def daily_sketches(
    df: DataFrame, keys: Sequence[str], value: str, time: str | Column = "timestamp_evento", k: int = SKETCH_K
) -> DataFrame:
    """(fecha, keys, rows, least, most, sketch) of the non-null values of each day and group.

    Partial sketches are built in every task and merged after the shuffle: a hot
    group sends one sketch a task.  A ``time`` cut to months makes monthly ones.  Whole numbers are sketched as BIGINT, other
    numbers as DOUBLE.
    """
    kind = _kind(df.schema[value].dataType)
    number = F.col(value).cast(kind)
    days = df.where(F.col(value).isNotNull()).groupBy(F.to_date(time).alias(DAY), *keys)
    return days.agg(
        F.count(F.lit(1)).alias(ROWS),
        F.min(number).alias(LEAST),
        F.max(number).alias(MOST),
        _call("sketch_agg", kind)(number, F.lit(k)).alias(SKETCH),
    )


def write_sketches(sketches: DataFrame, path: str) -> None:
    """Store the days in ``sketches``, each replacing what was stored of that day."""
    sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)


def read_sketches(spark: SparkSession, path: str, since: str | date | None = None, until: str | date | None = None) -> DataFrame:
    """The sketches of the days from ``since`` (inclusive) to ``until`` (exclusive); only their directories are read."""
    df = spark.read.parquet(path)
    if since:
        df = df.where(F.col(DAY) >= F.lit(since).cast("date"))
    if until:
        df = df.where(F.col(DAY) < F.lit(until).cast("date"))
    return df


def sketch_percentiles(sketches: DataFrame, keys: Sequence[str], percentiles: dict[str, float]) -> DataFrame:
    """By ``keys`` over all days read: rows, least, most and the named percentiles.

    The rank of a percentile is off by at most ``RANK_ERROR`` of the rows, with a
    probability above 99 % for each; groups smaller than a sketch are exact.
    """
    kind = _kind(sketches.schema[LEAST].dataType)
    merged = sketches.groupBy(*keys).agg(
        F.sum(ROWS).alias(ROWS),
        F.min(LEAST).alias(LEAST),
        F.max(MOST).alias(MOST),
        _call("merge_agg", kind)(SKETCH).alias(SKETCH),
    )
    named: list[Column] = [_call("sketch_get_quantile", kind)(F.col(SKETCH), F.lit(float(p))).alias(name) for name, p in percentiles.items()]
    return merged.select(*keys, ROWS, LEAST, MOST, *named)


def rank_bounds(percentiles: dict[str, float], error: float = RANK_ERROR) -> dict[str, float]:
    """The exact percentiles between which each estimate has to lie: ``<name>_min`` and ``<name>_max``."""
    out = {}
    for name, p in percentiles.items():
        out[f"{name}_min"] = max(0.0, round(p - error, 9))
        out[f"{name}_max"] = min(1.0, round(p + error, 9))
    return out
