"""The event table as a view over a generic ``events`` table.

Used by tests, the benchmark and the registered queries, which only have
``events(event_id, ts, user_id, event_type, value, props)`` to read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schema import (
    CITIES,
    ENDPOINTS,
    EVENT_COLUMNS,
    HTTP_METHODS,
    LEVEL_WEIGHTS,
    LEVELS,
    LOGIN_RESULTS,
    METRICS,
    SERVER_SCHEMA,
    SERVERS,
    SERVICES,
    Metric,
)

# How the generic event types map to ours.
TYPE_OF_EVENT = {
    "view": "request",
    "error": "error",
    "click": "network",
    "signup": "security",
    "purchase": "resource",
}

# Hash multipliers of the metrics.
METRIC_SALT = {
    "tiempo_respuesta_ms": 31,
    "uso_cpu_porcentaje": 37,
    "uso_ram_porcentaje": 41,
    "uso_disco_porcentaje": 43,
    "errores_minuto": 47,
    "latencia_red_ms": 53,
    "temperatura_cpu": 59,
    "bytes_entrada": 61,
    "bytes_salida": 67,
    "peticiones_por_minuto": 71,
    "conexiones_activas": 73,
    "paquetes_perdidos": 79,
}

# Status codes by level; INFO has its own list for requests.
INFO_REQUEST_CODES = [200, 201, 202, 204]
WARNING_CODES = [300, 400, 401, 403, 404]
ERROR_CODES = [500, 502, 503, 504]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lit(value: str | int) -> str:
    return f"'{value}'" if isinstance(value, str) else str(value)


def _choice(options: Sequence, number: str) -> str:
    return f"element_at(array({', '.join(map(_lit, options))}), cast({number} % {len(options)} + 1 as int))"


def _case(column: str, values: Mapping[str, str]) -> str:
    arms = " ".join(f"WHEN {_lit(k)} THEN {v}" for k, v in values.items())
    return f"CASE {column} {arms} END"


def _metric(m: Metric) -> str:
    arms = {}
    for level in LEVELS:
        low, high = m.band(level)
        arms[level] = f"h * {METRIC_SALT[m.name]} % {high - low + 1} + {low}"
    value = _case("nivel", arms)
    if m.hundredths:
        return f"cast({value} / 100.0D as decimal(5,2))"
    return value if m.name.startswith("bytes") else f"cast({value} as int)"


def _event_columns() -> list[str]:
    columns = {
        "id_log": "concat('log-', event_id)",
        "timestamp_evento": "date_trunc('second', cast(ts as timestamp))",
        **{
            name: _choice([row[i] for row in SERVERS], "user_id")
            for i, name in enumerate(SERVER_SCHEMA.fieldNames())
        },
        "codigo_estado": "CASE WHEN nivel = 'INFO' AND tipo_evento = 'request' THEN "
        f"{_choice(INFO_REQUEST_CODES, 'h')} WHEN nivel = 'INFO' THEN 200 "
        f"WHEN nivel = 'WARNING' THEN {_choice(WARNING_CODES, 'h')} ELSE {_choice(ERROR_CODES, 'h')} END",
        "endpoint": _choice(ENDPOINTS, "h"),
        "metodo_http": f"if(tipo_evento = 'request', {_choice(HTTP_METHODS, 'h')}, null)",
        "usuario": "concat('user-', user_id)",
        "correo_usuario": "concat('user-', user_id, '@example.com')",
        "ciudad": _choice(CITIES, "user_id"),
        "ip_origen": "concat('10.0.', h % 256, '.', h * 7 % 256)",
        "user_agent": "if(tipo_evento = 'request', concat('Mozilla/5.0 (KHTML, like Gecko) v', h % 9), null)",
        "intento_login": f"if(tipo_evento = 'security', {_choice(LOGIN_RESULTS, 'h')}, null)",
        "ip_sospechosa": "tipo_evento = 'security' AND nivel <> 'INFO'",
        "pais_origen": "if(tipo_evento = 'security', concat('pais-', h % 20), null)",
        "trace_id": "concat('trace-', event_id * 31)",
        "session_id": "concat('sess-', user_id, '-', event_id % 50)",
        "proceso": "concat(servicio, '-', 1000 + h % 9000)",
        "mensaje": "concat(tipo_evento, ' ', nivel)",
        **{m.name: _metric(m) for m in METRICS},
    }
    return [f"{columns[c]} AS {c}" if c in columns else c for c in EVENT_COLUMNS]


def logs_from_events(events: DataFrame) -> DataFrame:
    """All 37 event columns as integer arithmetic over (event_id, user_id, props.k)."""
    kind = _case("event_type", {k: _lit(v) for k, v in TYPE_OF_EVENT.items()})
    number = "(event_id * 7919 + user_id * 104729 + get_json_object(props, '$.k')::bigint * 611953) % 1000003"
    level = _case("tipo_evento", {k: _choice(v, "h") for k, v in LEVEL_WEIGHTS.items()})
    service = _case("tipo_evento", {k: _choice(v, "event_id") for k, v in SERVICES.items()})
    return (
        events.selectExpr("event_id", "user_id", "ts", f"{kind} AS tipo_evento", f"{number} AS h")
        .selectExpr("*", f"{level} AS nivel", f"{service} AS servicio")
        .selectExpr(*_event_columns())
    )


def logs_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs_from_events(read_table(spark, sf_dir, "events"))


def grown_events(events: DataFrame, rows: int) -> DataFrame:
    """``events`` repeated with new numbers up to ``rows`` rows.

    Event numbers must run from 0 without gaps, as in the test tables.
    """
    have = events.count()
    copies = -(-rows // have)
    repeated = events.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    shifted = repeated.withColumn("event_id", F.col("event_id") + F.col("copy") * have)
    return shifted.where(F.col("event_id") < rows).drop("copy")
