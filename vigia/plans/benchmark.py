"""The same four-query workload timed at different parallelisms."""

from __future__ import annotations

import time
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from .analyses import BENCHMARK


@dataclass(frozen=True)
class Timing:
    modo: str
    tiempo_segundos: float
    registros: int


def run_workload(logs: DataFrame, mode: str) -> Timing:
    """Row count and three aggregations, uncached; results are a few rows."""
    started = time.monotonic()
    rows = 0
    for name, query in BENCHMARK.items():
        result = query(logs).collect()
        if name == "b1_row_count":
            rows = result[0]["total"]
    return Timing(mode, round(time.monotonic() - started, 2), rows)


def save_timing(spark: SparkSession, timing: Timing, path: str) -> None:
    """Append one line to the comparison; each mode is a run of its own."""
    spark.createDataFrame([asdict(timing)], "modo string, tiempo_segundos double, registros bigint").coalesce(
        1
    ).write.mode("append").option("header", True).csv(path)


def speed_up(spark: SparkSession, path: str, baseline: str) -> DataFrame:
    """Best time per mode and how many times faster it is than ``baseline``."""
    timings = spark.read.option("header", True).schema(
        "modo string, tiempo_segundos double, registros bigint"
    ).csv(path)
    best = timings.groupBy("modo").agg(
        F.min("tiempo_segundos").alias("tiempo_segundos"), F.max("registros").alias("registros")
    )
    base = best.where(F.col("modo") == baseline).select("tiempo_segundos").scalar()
    return best.withColumn("speed_up", F.round(base / F.col("tiempo_segundos"), 2)).orderBy("modo")
