"""Event-time windows with a watermark, and the rows that came too late for theirs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.labels import is_error
from .queries import FLUSH_INTERVAL, keep_batches, start_stream

WINDOW, DELAY = "5 minutes", "10 minutes"

_ROWS, _ERRORS = "eventos", "errores"


def _counts() -> list:
    # No filter on the level: Spark would move it below the watermark, which
    # then followed the error rows only.
    return [F.count(F.lit(1)).alias(_ROWS), F.count_if(is_error(F.col("nivel"))).alias(_ERRORS)]


def windowed_counts(
    events: DataFrame, keys: Sequence[str] = ("servicio",), window: str = WINDOW, delay: str = DELAY
) -> DataFrame:
    """Rows and error rows by key and event-time window: ``keys``, inicio, eventos, errores.

    State holds the windows that end after the watermark (the latest event time
    of earlier batches less ``delay``), one row a key and window: rows of a hot
    key are counted in each task first.  Rows of older windows are left out.
    """
    timed = events.withWatermark("timestamp_evento", delay)
    span = F.window("timestamp_evento", window)
    return timed.groupBy(*keys, span.alias("__w")).agg(*_counts()).select(*keys, F.col("__w.start").alias("inicio"), _ROWS, _ERRORS)


def start_windowed_counts(
    events: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str] = ("servicio",),
    window: str = WINDOW,
    delay: str = DELAY,
    interval: str | None = FLUSH_INTERVAL,
    name: str = "windowed_counts",
) -> tuple[StreamingQuery, StreamingQuery]:
    """Keep window counts below ``path``/ventanas and plain totals by key below ``path``/totales.

    Both streams write what changed in a batch to a directory of that batch, which
    a replay overwrites.  The totals have no watermark, one state row a key; what
    they count and no window does came too late (:func:`read_late`).
    """
    counted = windowed_counts(events, keys, window, delay)
    totals = events.groupBy(*keys).agg(*_counts())
    return tuple(
        start_stream(df, f"{name}_{part}", f"{checkpoint}/{part}", interval, lambda w, to=f"{path}/{part}": w.outputMode("update").foreachBatch(keep_batches(to)))
        for part, df in (("ventanas", counted), ("totales", totals))
    )


def _latest(spark: SparkSession, path: str) -> DataFrame:
    """The last count of each key: counts only grow, so the largest."""
    kept = spark.read.parquet(path)
    keys = [c for c in kept.columns if c not in (_ROWS, _ERRORS, "query", "batch")]
    return kept.groupBy(*keys).agg(F.max(_ROWS).alias(_ROWS), F.max(_ERRORS).alias(_ERRORS))


def read_windows(spark: SparkSession, path: str) -> DataFrame:
    """Windows as counted so far, open ones included."""
    return _latest(spark, f"{path}/ventanas")


def read_late(spark: SparkSession, path: str) -> DataFrame:
    """By key: rows and error rows that came after their window had been closed; only keys that have some."""
    totals, windows = _latest(spark, f"{path}/totales"), read_windows(spark, path)
    keys = [c for c in totals.columns if c not in (_ROWS, _ERRORS)]
    signed = totals.unionByName(windows.select(*keys, (-F.col(_ROWS)).alias(_ROWS), (-F.col(_ERRORS)).alias(_ERRORS)))
    late = signed.groupBy(*keys).agg(F.sum(_ROWS).alias(_ROWS), F.sum(_ERRORS).alias(_ERRORS))
    return late.where(F.col(_ROWS) > 0)
