"""The named analyses over the event table.

C and J analyses are declarative specifications; Q analyses need expressions,
windows or percentiles and are written as DataFrame functions.  B analyses are
the benchmark workload.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.labels import is_error, status_class
from ..functions.numeric import mean, round_half_up
from ..operators.analysis import Analysis, Rounding
from ..operators.distribution import exact_summary
from ..operators.windows import rank_groups, top_k, top_per_group

CSV_SUITE = [
    Analysis("c1_events_by_type", (("count", "*", "total"),), ("tipo_evento",), order=("total", "desc")),
    Analysis(
        "c2_response_by_service",
        (
            ("count", "*", "total_peticiones"),
            ("avg", "tiempo_respuesta_ms", "resp_avg_ms"),
            ("min", "tiempo_respuesta_ms", "resp_min_ms"),
            ("max", "tiempo_respuesta_ms", "resp_max_ms"),
            ("stddev", "tiempo_respuesta_ms", "resp_stddev_ms"),
            ("avg", "peticiones_por_minuto", "peticiones_min_avg"),
        ),
        ("servicio",),
        order=("resp_avg_ms", "desc"),
        save="respuesta_por_servicio",
    ),
    Analysis(
        "c3_latency_by_server",
        (("avg", "latencia_red_ms", "latencia_avg_ms"), ("max", "latencia_red_ms", "latencia_max_ms")),
        ("servidor",),
        order=("latencia_avg_ms", "desc"),
    ),
    Analysis(
        "c4_bytes_by_server",
        (("sum", "bytes_entrada", "total_bytes_entrada"), ("sum", "bytes_salida", "total_bytes_salida")),
        ("servidor",),
        order=("total_bytes_salida", "desc"),
    ),
    Analysis(
        "c5_errors_by_server",
        (("avg", "errores_minuto", "errores_min_avg"), ("sum", "errores_minuto", "errores_total")),
        ("servidor",),
        order=("errores_total", "desc"),
        save="errores_por_servidor",
    ),
]

JSON_SUITE = [
    Analysis("j1_events_by_level", (("count", "*", "total"),), ("nivel",), order=("total", "desc")),
    Analysis(
        "j2_cpu_ram_by_server",
        (
            ("count", "*", "total"),
            ("avg", "uso_cpu_porcentaje", "cpu_avg"),
            ("min", "uso_cpu_porcentaje", "cpu_min"),
            ("max", "uso_cpu_porcentaje", "cpu_max"),
            ("stddev", "uso_cpu_porcentaje", "cpu_stddev"),
            ("avg", "uso_ram_porcentaje", "ram_avg"),
        ),
        ("servidor",),
        order=("cpu_avg", "desc"),
        save="cpu_ram_por_servidor",
    ),
    Analysis(
        "j3_ram_by_service",
        (("avg", "uso_ram_porcentaje", "ram_avg"), ("count", "*", "total")),
        ("servicio",),
        order=("ram_avg", "desc"),
    ),
    Analysis(
        "j4_disk_by_server",
        (("max", "uso_disco_porcentaje", "disco_max"), ("avg", "uso_disco_porcentaje", "disco_avg")),
        ("servidor",),
        order=("disco_max", "desc"),
    ),
    Analysis("j5_events_by_zone", (("count", "*", "total"),), ("zona",), order=("total", "desc")),
    Analysis(
        "j6_critical_servers",
        (
            ("count", "*", "eventos_criticos"),
            ("avg", "uso_cpu_porcentaje", "cpu_avg"),
            ("avg", "temperatura_cpu", "temp_avg"),
        ),
        ("servidor",),
        where="nivel IN ('CRITICAL','ERROR')",
        order=("eventos_criticos", "desc"),
        save="servidores_criticos",
    ),
]


def _rows(alias: str) -> Column:
    return F.count(F.lit(1)).alias(alias)


def _avg(logs: DataFrame, column: str, alias: str, rounding: Rounding) -> Column:
    return rounding(mean(column, logs.schema[column].dataType)).alias(alias)


def _errors(alias: str) -> Column:
    return F.count_if(is_error(F.col("nivel"))).alias(alias)


def q1_global_stats(logs: DataFrame, rounding: Rounding = round_half_up) -> DataFrame:
    cpu = F.col("uso_cpu_porcentaje").cast("double")
    return logs.agg(
        _avg(logs, "uso_cpu_porcentaje", "cpu_avg", rounding),
        rounding(F.min(cpu)).alias("cpu_min"),
        rounding(F.max(cpu)).alias("cpu_max"),
        rounding(F.stddev_samp(cpu)).alias("cpu_stddev"),
        _avg(logs, "uso_ram_porcentaje", "ram_avg", rounding),
        _avg(logs, "uso_disco_porcentaje", "disco_avg", rounding),
        _avg(logs, "temperatura_cpu", "temp_avg", rounding),
        _avg(logs, "latencia_red_ms", "latencia_avg", rounding),
        _avg(logs, "tiempo_respuesta_ms", "respuesta_avg", rounding),
    )


def q2_by_environment(logs: DataFrame, rounding: Rounding = round_half_up) -> DataFrame:
    agg = logs.groupBy("ambiente").agg(
        _rows("total"),
        _avg(logs, "uso_cpu_porcentaje", "cpu_avg", rounding),
        _avg(logs, "uso_ram_porcentaje", "ram_avg", rounding),
        _avg(logs, "tiempo_respuesta_ms", "respuesta_avg_ms", rounding),
        _avg(logs, "errores_minuto", "errores_avg", rounding),
    )
    return agg.orderBy(F.desc_nulls_last("total"), F.asc_nulls_first("ambiente"))


def q3_top_servers_by_errors(
    logs: DataFrame, rounding: Rounding = round_half_up, k: int = 10
) -> DataFrame:
    agg = (
        logs.where(is_error(F.col("nivel")))
        .groupBy("servidor", "zona")
        .agg(_rows("total_errores"), _avg(logs, "uso_cpu_porcentaje", "cpu_avg", rounding))
    )
    return top_k(agg, "total_errores", k, ties=("servidor", "zona"))


def q4_by_service_and_level(logs: DataFrame) -> DataFrame:
    agg = logs.groupBy("servicio", "nivel").agg(_rows("total"))
    return agg.orderBy("servicio", F.desc_nulls_last("total"), "nivel")


def q5_critical_servers(
    logs: DataFrame,
    rounding: Rounding = round_half_up,
    cpu_above: float = 70,
    ram_above: float = 70,
    temp_above: float = 75,
) -> DataFrame:
    """Servers whose rounded averages exceed a threshold (strictly)."""
    agg = logs.groupBy("servidor").agg(
        _rows("eventos"),
        _avg(logs, "uso_cpu_porcentaje", "cpu_avg", rounding),
        _avg(logs, "uso_ram_porcentaje", "ram_avg", rounding),
        _avg(logs, "temperatura_cpu", "temp_avg", rounding),
    )
    over = (
        (F.col("cpu_avg") > cpu_above)
        | (F.col("ram_avg") > ram_above)
        | (F.col("temp_avg") > temp_above)
    )
    return agg.where(over).orderBy(F.desc_nulls_last("cpu_avg"), "servidor")


def q6_error_rate_by_service(logs: DataFrame, rounding: Rounding = round_half_up) -> DataFrame:
    agg = logs.groupBy("servicio").agg(_rows("total"), _errors("errores"))
    rate = F.lit(100.0) * F.col("errores") / F.col("total")
    return agg.withColumn("pct_error", rounding(rate)).orderBy(
        F.desc_nulls_last("pct_error"), "servicio"
    )


RESPONSE_PERCENTILES = {"p50_ms": 0.50, "p90_ms": 0.90, "p95_ms": 0.95, "p99_ms": 0.99}


def q7_response_percentiles(logs: DataFrame, exact: bool = False) -> DataFrame:
    """Response-time percentiles by service: one digest per service, or exact."""
    value = "tiempo_respuesta_ms"
    if exact:
        agg = exact_summary(logs, ["servicio"], value, RESPONSE_PERCENTILES, "total", "max_ms")
    else:
        agg = logs.groupBy("servicio").agg(
            _rows("total"),
            F.max(value).alias("max_ms"),
            F.percentile_approx(value, list(RESPONSE_PERCENTILES.values()), 10000).alias("p"),
        )
        agg = agg.withColumns({name: F.col("p")[i] for i, name in enumerate(RESPONSE_PERCENTILES)})
    return agg.select("servicio", "total", *RESPONSE_PERCENTILES, "max_ms").orderBy(
        F.desc_nulls_last("p99_ms"), "servicio"
    )


def q8_server_cpu_ranking(logs: DataFrame, rounding: Rounding = round_half_up) -> DataFrame:
    agg = logs.groupBy("servidor").agg(
        _rows("eventos"),
        _avg(logs, "uso_cpu_porcentaje", "cpu_avg", rounding),
        _avg(logs, "uso_ram_porcentaje", "ram_avg", rounding),
    )
    return rank_groups(agg, "cpu_avg", "ranking_cpu").orderBy("ranking_cpu", "servidor")


def q9_worst_service_by_zone(logs: DataFrame) -> DataFrame:
    agg = (
        logs.where(is_error(F.col("nivel"))).groupBy("zona", "servicio").agg(_rows("errores"))
    )
    worst = top_per_group(agg, ["zona"], "errores", ties=("servicio",))
    return worst.orderBy(F.desc_nulls_last("errores"), F.asc_nulls_first("zona"))


def q10_status_classes(logs: DataFrame) -> DataFrame:
    labelled = logs.select(status_class(F.col("codigo_estado")).alias("clase_estado"))
    agg = labelled.groupBy("clase_estado").agg(_rows("total"))
    return agg.orderBy(F.desc_nulls_last("total"), "clase_estado")


def q11_throughput_by_hour(logs: DataFrame, rounding: Rounding = round_half_up) -> DataFrame:
    agg = logs.groupBy(F.hour("timestamp_evento").alias("hora")).agg(
        _rows("eventos"),
        _avg(logs, "tiempo_respuesta_ms", "resp_avg_ms", rounding),
        _errors("errores"),
    )
    return agg.orderBy("hora")


def b1_row_count(logs: DataFrame) -> DataFrame:
    return logs.agg(_rows("total"))


def b2_by_level(logs: DataFrame) -> DataFrame:
    return logs.groupBy("nivel").agg(_rows("total"))


def b3_cpu_by_server(logs: DataFrame, rounding: Rounding = round_half_up) -> DataFrame:
    cpu = F.col("uso_cpu_porcentaje").cast("double")
    return logs.groupBy("servidor").agg(
        _avg(logs, "uso_cpu_porcentaje", "cpu_avg", rounding),
        rounding(F.stddev_samp(cpu)).alias("cpu_stddev"),
    )


def b4_by_zone_and_type(logs: DataFrame) -> DataFrame:
    agg = logs.groupBy("zona", "tipo_evento").agg(_rows("t"))
    return agg.orderBy(F.desc_nulls_last("t"), F.asc_nulls_first("zona"), "tipo_evento")


# name -> (function, name of the saved result or None)
SQL_SUITE: dict[str, tuple[Callable[[DataFrame], DataFrame], str | None]] = {
    "q1_global_stats": (q1_global_stats, "estadisticas_globales"),
    "q2_by_environment": (q2_by_environment, "por_ambiente"),
    "q3_top_servers_by_errors": (q3_top_servers_by_errors, "top_servidores_errores"),
    "q4_by_service_and_level": (q4_by_service_and_level, None),
    "q5_critical_servers": (q5_critical_servers, None),
    "q6_error_rate_by_service": (q6_error_rate_by_service, "tasa_error_por_servicio"),
    "q7_response_percentiles": (q7_response_percentiles, "percentiles_respuesta"),
    "q8_server_cpu_ranking": (q8_server_cpu_ranking, "ranking_servidores_cpu"),
    "q9_worst_service_by_zone": (q9_worst_service_by_zone, None),
    "q10_status_classes": (q10_status_classes, None),
    "q11_throughput_by_hour": (q11_throughput_by_hour, None),
}

BENCHMARK = {
    "b1_row_count": b1_row_count,
    "b2_by_level": b2_by_level,
    "b3_cpu_by_server": b3_cpu_by_server,
    "b4_by_zone_and_type": b4_by_zone_and_type,
}

