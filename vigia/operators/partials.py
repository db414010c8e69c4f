"""Daily partial aggregates that merge into the results of a full scan.

A state row holds, for one day and one group, what every measure can be merged
from: rows, and for each metric its non-null rows, exact sum, squares around the
group's own mean, least and greatest value.  Days are aggregated once, when they
are loaded; a report over any range of days merges state rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..functions.numeric import exact_sum, round_half_up
from .analysis import Analysis, Measure, Rounding, ordered

DAY, ROWS = "fecha", "__rows"
_PARTS = ("n", "sum", "m2", "min", "max")


def _part(metric: str, part: str) -> str:
    return f"{metric}__{part}"


def daily_state(
    df: DataFrame, keys: Sequence[str], metrics: Sequence[str], time: str = "timestamp_evento"
) -> DataFrame:
    """One row per day and group; combined in every task first, so a hot group sends one row a task."""
    parts = []
    for m in metrics:
        number = F.col(m).cast("double")
        parts += [
            F.count(m).alias(_part(m, "n")),
            exact_sum(m, df.schema[m].dataType).alias(_part(m, "sum")),
            (F.var_pop(number) * F.count(m)).alias(_part(m, "m2")),
            F.min(m).alias(_part(m, "min")),
            F.max(m).alias(_part(m, "max")),
        ]
    return df.groupBy(F.to_date(time).alias(DAY), *keys).agg(F.count(F.lit(1)).alias(ROWS), *parts)


def write_state(state: DataFrame, path: str) -> None:
    """Store the days in ``state``, each replacing what was stored of that day: a replay adds nothing."""
    state.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)


def read_state(
    spark: SparkSession, path: str, since: str | date | None = None, until: str | date | None = None
) -> DataFrame:
    """State rows of the days from ``since`` (inclusive) to ``until`` (exclusive)."""
    df = spark.read.parquet(path)
    if since:
        df = df.where(F.col(DAY) >= F.lit(since).cast("date"))
    if until:
        df = df.where(F.col(DAY) < F.lit(until).cast("date"))
    return df


def merge_state(state: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """State rows by ``keys`` alone, a part of the keys they were made with.

    Squares are moved to the common mean: those around each row's own mean, plus
    its rows times the square of the distance between the means.  No difference
    of large squares is taken, so nothing cancels.
    """
    group = Window.partitionBy(*keys)
    both = state
    for m in metrics:
        n, total = F.col(_part(m, "n")), F.col(_part(m, "sum")).cast("double")
        common = F.sum(total).over(group) / F.nullif(F.sum(n).over(group), F.lit(0))
        own = total / F.nullif(n, F.lit(0))
        both = both.withColumn(_part(m, "m2"), F.col(_part(m, "m2")) + n * (own - common) * (own - common))
    merged = [F.sum(ROWS).alias(ROWS)]
    for m in metrics:
        how = {"n": F.sum, "sum": F.sum, "m2": F.sum, "min": F.min, "max": F.max}
        merged += [how[p](_part(m, p)).alias(_part(m, p)) for p in _PARTS]
    return both.groupBy(*keys).agg(*merged)


def _finished(m: Measure, schema: T.StructType, rounding: Rounding) -> Column:
    """A measure from merged parts, typed and rounded as by a scan."""
    if m.column == "*":
        return F.col(ROWS).alias(m.alias)
    n, total = F.col(_part(m.column, "n")), F.col(_part(m.column, "sum"))
    dtype = schema[_part(m.column, "min")].dataType
    decimal = isinstance(dtype, T.DecimalType)
    if m.fn == "count":
        out = n
    elif m.fn == "sum":
        out = total.cast("double") if decimal else total
    elif m.fn == "avg":
        if decimal:
            unit = F.lit(10**dtype.scale)
            total, n = (total * unit).cast("bigint"), n * unit
        out = rounding(total.cast("double") / F.nullif(n, F.lit(0)).cast("double"))
    elif m.fn == "stddev":
        out = rounding(F.when(n > 1, F.sqrt(F.col(_part(m.column, "m2")) / (n - 1))))
    else:
        out = F.col(_part(m.column, m.fn))
        out = out.cast("double") if decimal else out
    return out.alias(m.alias)


def run_from_state(state: DataFrame, a: Analysis, rounding: Rounding = round_half_up) -> DataFrame:
    """What ``run`` returns for ``a`` over the events that ``state`` was made from.

    The filter and the keys of ``a`` may use the keys of the state only.
    """
    base = state.where(a.where) if a.where else state
    metrics = list(dict.fromkeys(m.column for m in a.aggs if m.column != "*"))
    merged = merge_state(base, a.group_by, metrics)
    counted = F.coalesce(F.col(ROWS), F.lit(0).cast("bigint"))
    zeros = {ROWS: counted, **{_part(m, "n"): F.coalesce(F.col(_part(m, "n")), F.lit(0).cast("bigint")) for m in metrics}}
    merged = merged.withColumns(zeros)
    return ordered(merged.select(*a.group_by, *(_finished(m, state.schema, rounding) for m in a.aggs)), a)
