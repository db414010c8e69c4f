"""The SQL front-end: analyses as SQL text over the view ``logs``."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class SqlAnalysis:
    """One SQL analysis over the view ``logs``."""

    name: str
    sql: str
    save: str | None = None

    @classmethod
    def from_dict(cls, spec: Mapping) -> SqlAnalysis:
        """Read the dictionary form: nombre, sql, guardar."""
        return cls(spec["nombre"], spec["sql"], spec.get("guardar") or None)


def run_sql(spark: SparkSession, analysis: SqlAnalysis) -> DataFrame:
    return spark.sql(analysis.sql)


# The Q analyses in Spark's pipe syntax.
SQL_CATALOG = [
    SqlAnalysis(
        "q1_global_stats",
        """
        FROM logs
        |> AGGREGATE
             round(avg(uso_cpu_porcentaje::double), 2) AS cpu_avg,
             round(min(uso_cpu_porcentaje::double), 2) AS cpu_min,
             round(max(uso_cpu_porcentaje::double), 2) AS cpu_max,
             round(stddev_samp(uso_cpu_porcentaje::double), 2) AS cpu_stddev,
             round(avg(uso_ram_porcentaje::double), 2) AS ram_avg,
             round(avg(uso_disco_porcentaje::double), 2) AS disco_avg,
             round(avg(temperatura_cpu::double), 2) AS temp_avg,
             round(avg(latencia_red_ms), 2) AS latencia_avg,
             round(avg(tiempo_respuesta_ms), 2) AS respuesta_avg
        """,
        "estadisticas_globales",
    ),
    SqlAnalysis(
        "q2_by_environment",
        """
        FROM logs
        |> AGGREGATE
             count(*) AS total,
             round(avg(uso_cpu_porcentaje::double), 2) AS cpu_avg,
             round(avg(uso_ram_porcentaje::double), 2) AS ram_avg,
             round(avg(tiempo_respuesta_ms), 2) AS respuesta_avg_ms,
             round(avg(errores_minuto), 2) AS errores_avg
           GROUP BY ambiente
        |> ORDER BY total DESC, ambiente
        """,
        "por_ambiente",
    ),
    SqlAnalysis(
        "q3_top_servers_by_errors",
        """
        FROM logs
        |> WHERE nivel IN ('ERROR', 'CRITICAL')
        |> AGGREGATE
             count(*) AS total_errores,
             round(avg(uso_cpu_porcentaje::double), 2) AS cpu_avg
           GROUP BY servidor, zona
        |> ORDER BY total_errores DESC, servidor, zona
        |> LIMIT 10
        """,
        "top_servidores_errores",
    ),
    SqlAnalysis(
        "q4_by_service_and_level",
        """
        FROM logs
        |> AGGREGATE count(*) AS total GROUP BY servicio, nivel
        |> ORDER BY servicio, total DESC, nivel
        """,
    ),
    SqlAnalysis(
        "q5_critical_servers",
        """
        FROM logs
        |> AGGREGATE
             count(*) AS eventos,
             round(avg(uso_cpu_porcentaje::double), 2) AS cpu_avg,
             round(avg(uso_ram_porcentaje::double), 2) AS ram_avg,
             round(avg(temperatura_cpu::double), 2) AS temp_avg
           GROUP BY servidor
        |> WHERE cpu_avg > 70 OR ram_avg > 70 OR temp_avg > 75
        |> ORDER BY cpu_avg DESC, servidor
        """,
    ),
    SqlAnalysis(
        "q6_error_rate_by_service",
        """
        FROM logs
        |> AGGREGATE count(*) AS total, count_if(nivel IN ('ERROR', 'CRITICAL')) AS errores
           GROUP BY servicio
        |> EXTEND round(100.0D * errores / total, 2) AS pct_error
        |> ORDER BY pct_error DESC, servicio
        """,
        "tasa_error_por_servicio",
    ),
    SqlAnalysis(
        "q7_response_percentiles",
        """
        FROM logs
        |> AGGREGATE
             count(*) AS total,
             array(percentile_disc(0.5) WITHIN GROUP (ORDER BY tiempo_respuesta_ms), percentile_disc(0.9) WITHIN GROUP (ORDER BY tiempo_respuesta_ms),
                   percentile_disc(0.95) WITHIN GROUP (ORDER BY tiempo_respuesta_ms), percentile_disc(0.99) WITHIN GROUP (ORDER BY tiempo_respuesta_ms)) AS p,
             max(tiempo_respuesta_ms) AS max_ms
           GROUP BY servicio
        |> SELECT servicio, total, CAST(p[0] AS INT) AS p50_ms, CAST(p[1] AS INT) AS p90_ms,
                  CAST(p[2] AS INT) AS p95_ms, CAST(p[3] AS INT) AS p99_ms, max_ms
        |> ORDER BY p99_ms DESC, servicio
        """,
        "percentiles_respuesta",
    ),
    SqlAnalysis(
        "q8_server_cpu_ranking",
        """
        FROM logs
        |> AGGREGATE
             count(*) AS eventos,
             round(avg(uso_cpu_porcentaje::double), 2) AS cpu_avg,
             round(avg(uso_ram_porcentaje::double), 2) AS ram_avg
           GROUP BY servidor
        |> EXTEND rank() OVER (ORDER BY cpu_avg DESC NULLS LAST) AS ranking_cpu
        |> ORDER BY ranking_cpu, servidor
        """,
        "ranking_servidores_cpu",
    ),
    SqlAnalysis(
        "q9_worst_service_by_zone",
        """
        FROM logs
        |> WHERE nivel IN ('ERROR', 'CRITICAL')
        |> AGGREGATE count(*) AS errores GROUP BY zona, servicio
        |> EXTEND row_number() OVER (PARTITION BY zona ORDER BY errores DESC, servicio) AS rn
        |> WHERE rn = 1
        |> DROP rn
        |> ORDER BY errores DESC, zona
        """,
    ),
    SqlAnalysis(
        "q10_status_classes",
        """
        FROM logs
        |> SELECT CASE codigo_estado div 100
                    WHEN 2 THEN '2xx OK'
                    WHEN 3 THEN '3xx Redireccion'
                    WHEN 4 THEN '4xx Cliente'
                    WHEN 5 THEN '5xx Servidor'
                    ELSE 'Otro'
                  END AS clase_estado
        |> AGGREGATE count(*) AS total GROUP BY clase_estado
        |> ORDER BY total DESC, clase_estado
        """,
    ),
    SqlAnalysis(
        "q11_throughput_by_hour",
        """
        FROM logs
        |> EXTEND hour(timestamp_evento) AS hora
        |> AGGREGATE
             count(*) AS eventos,
             round(avg(tiempo_respuesta_ms), 2) AS resp_avg_ms,
             count_if(nivel IN ('ERROR', 'CRITICAL')) AS errores
           GROUP BY hora
        |> ORDER BY hora
        """,
    ),
]
