"""Reference SQL of every registered query, for an independent SQL engine.

The texts run on DuckDB over the same Parquet tables.  They state the result,
not our plan: the event table is derived again from ``events`` and every
analysis is written as one SELECT.
"""

from __future__ import annotations

from ..schema import (
    CITIES,
    ENDPOINTS,
    EVENT_TYPES,
    HTTP_METHODS,
    LEVEL_WEIGHTS,
    LEVELS,
    LOGIN_RESULTS,
    METRICS,
    SERVER_SCHEMA,
    SERVERS,
    SERVICES,
    TEXT_WIDTHS,
    TOPIC_OF_TYPE,
)
from .fixture import ERROR_CODES, INFO_REQUEST_CODES, METRIC_SALT, TYPE_OF_EVENT, WARNING_CODES

def _lit(value) -> str:
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


def _pick(options, number: str) -> str:
    return f"([{', '.join(map(_lit, options))}])[1 + ({number}) % {len(options)}]"


def _case(column: str, values: dict[str, str]) -> str:
    arms = " ".join(f"WHEN {_lit(k)} THEN {v}" for k, v in values.items())
    return f"CASE {column} {arms} END"


def _r2(x: str) -> str:
    """Round to two places, halves up, in binary arithmetic."""
    return f"FLOOR(({x}) * 100 + CAST(0.5 AS DOUBLE)) / CAST(100 AS DOUBLE)"


def _avg(column: str) -> str:
    """AVG from an exact integer sum, rounded."""
    if any(m.name == column and m.hundredths for m in METRICS):
        total, count = f"SUM(CAST({column} * 100 AS BIGINT))", f"COUNT({column}) * 100"
    else:
        total, count = f"SUM({column})", f"COUNT({column})"
    return _r2(f"CAST({total} AS DOUBLE) / CAST({count} AS DOUBLE)")


def _std(column: str) -> str:
    return _r2(f"STDDEV_SAMP(CAST({column} AS DOUBLE))")


def _errors() -> str:
    return "CAST(COUNT(*) FILTER (WHERE nivel IN ('ERROR', 'CRITICAL')) AS BIGINT)"


def _metric_value(m) -> str:
    arms = {}
    for level in LEVELS:
        low, high = m.band(level)
        arms[level] = f"{low} + (h * {METRIC_SALT[m.name]}) % {high - low + 1}"
    value = _case("nivel", arms)
    if m.hundredths:
        return f"CAST({value} / CAST(100 AS DOUBLE) AS DECIMAL(5,2))"
    return f"CAST({value} AS {'BIGINT' if m.name.startswith('bytes') else 'INTEGER'})"


def _logs_ctes() -> str:
    """CTEs ending in ``logs``, the 37-column event table over ``events``."""
    kinds = _case("event_type", {k: _lit(v) for k, v in TYPE_OF_EVENT.items()})
    level = _case("tipo_evento", {k: _pick(v, "h") for k, v in LEVEL_WEIGHTS.items()})
    service = _case("tipo_evento", {k: _pick(v, "event_id") for k, v in SERVICES.items()})
    servers = ",\n  ".join(
        f"{_pick([row[i] for row in SERVERS], 'user_id')} AS {name}"
        for i, name in enumerate(SERVER_SCHEMA.fieldNames())
    )
    metrics = ",\n  ".join(f"{_metric_value(m)} AS {m.name}" for m in METRICS)
    return f"""
ev0 AS (
  SELECT event_id, user_id, ts, {kinds} AS tipo_evento,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events),
ev1 AS (
  SELECT *, (event_id * 7919 + user_id * 104729 + k * 611953) % 1000003 AS h FROM ev0),
ev2 AS (SELECT *, {level} AS nivel, {service} AS servicio FROM ev1),
logs AS (SELECT
  event_id,
  'log-' || event_id AS id_log,
  date_trunc('second', ts) AS timestamp_evento,
  {servers},
  servicio, tipo_evento, nivel,
  CASE WHEN nivel = 'INFO' AND tipo_evento = 'request' THEN {_pick(INFO_REQUEST_CODES, 'h')}
       WHEN nivel = 'INFO' THEN 200
       WHEN nivel = 'WARNING' THEN {_pick(WARNING_CODES, 'h')}
       ELSE {_pick(ERROR_CODES, 'h')} END AS codigo_estado,
  {_pick(ENDPOINTS, 'h')} AS endpoint,
  CASE WHEN tipo_evento = 'request' THEN {_pick(HTTP_METHODS, 'h')} END AS metodo_http,
  'user-' || user_id AS usuario,
  'user-' || user_id || '@example.com' AS correo_usuario,
  {_pick(CITIES, 'user_id')} AS ciudad,
  '10.0.' || (h % 256) || '.' || ((h * 7) % 256) AS ip_origen,
  CASE WHEN tipo_evento = 'request' THEN 'Mozilla/5.0 (KHTML, like Gecko) v' || (h % 9) END AS user_agent,
  {metrics},
  CASE WHEN tipo_evento = 'security' THEN {_pick(LOGIN_RESULTS, 'h')} END AS intento_login,
  (tipo_evento = 'security' AND nivel IN ('WARNING', 'ERROR', 'CRITICAL')) AS ip_sospechosa,
  CASE WHEN tipo_evento = 'security' THEN 'pais-' || (h % 20) END AS pais_origen,
  'trace-' || (event_id * 31) AS trace_id,
  'sess-' || user_id || '-' || (event_id % 50) AS session_id,
  servicio || '-' || (1000 + h % 9000) AS proceso,
  tipo_evento || ' ' || nivel AS mensaje
  FROM ev2)"""


LOGS = _logs_ctes()


def _over_logs(select: str, ctes: str = "") -> str:
    return f"WITH {LOGS}{ctes}\n{select}"


def _q_analyses() -> dict[str, str]:
    cpu, ram, disk, temp = (
        "uso_cpu_porcentaje",
        "uso_ram_porcentaje",
        "uso_disco_porcentaje",
        "temperatura_cpu",
    )
    resp, lat = "tiempo_respuesta_ms", "latencia_red_ms"
    quantiles = ", ".join(
        f"quantile_disc({resp}, {p}) AS p{p[2:].ljust(2, '0')}_ms" for p in ("0.5", "0.9", "0.95", "0.99")
    )
    return {
        "q1_global_stats": f"""SELECT {_avg(cpu)} AS cpu_avg,
  {_r2(f'CAST(MIN({cpu}) AS DOUBLE)')} AS cpu_min, {_r2(f'CAST(MAX({cpu}) AS DOUBLE)')} AS cpu_max,
  {_std(cpu)} AS cpu_stddev, {_avg(ram)} AS ram_avg, {_avg(disk)} AS disco_avg, {_avg(temp)} AS temp_avg,
  {_avg(lat)} AS latencia_avg, {_avg(resp)} AS respuesta_avg FROM logs""",
        "q2_by_environment": f"""SELECT ambiente, COUNT(*) AS total, {_avg(cpu)} AS cpu_avg, {_avg(ram)} AS ram_avg,
  {_avg(resp)} AS respuesta_avg_ms, {_avg('errores_minuto')} AS errores_avg FROM logs GROUP BY ambiente""",
        "q3_top_servers_by_errors": f"""SELECT servidor, zona, COUNT(*) AS total_errores, {_avg(cpu)} AS cpu_avg
FROM logs WHERE nivel IN ('ERROR', 'CRITICAL') GROUP BY servidor, zona
ORDER BY total_errores DESC, servidor, zona LIMIT 10""",
        "q4_by_service_and_level": "SELECT servicio, nivel, COUNT(*) AS total FROM logs GROUP BY servicio, nivel",
        "q5_critical_servers": f"""SELECT * FROM (SELECT servidor, COUNT(*) AS eventos, {_avg(cpu)} AS cpu_avg,
  {_avg(ram)} AS ram_avg, {_avg(temp)} AS temp_avg FROM logs GROUP BY servidor) a
WHERE cpu_avg > 54 OR ram_avg > 70 OR temp_avg > 75""",
        "q6_error_rate_by_service": f"""SELECT servicio, COUNT(*) AS total, {_errors()} AS errores,
  {_r2(f'CAST(100 AS DOUBLE) * {_errors()} / COUNT(*)')} AS pct_error FROM logs GROUP BY servicio""",
        "q7_response_percentiles": f"""SELECT servicio, COUNT(*) AS total, {quantiles}, MAX({resp}) AS max_ms
FROM logs GROUP BY servicio""",
        "q8_server_cpu_ranking": f"""WITH a AS (SELECT servidor, COUNT(*) AS eventos, {_avg(cpu)} AS cpu_avg,
  {_avg(ram)} AS ram_avg FROM logs GROUP BY servidor)
SELECT *, CAST(RANK() OVER (ORDER BY cpu_avg DESC) AS INTEGER) AS ranking_cpu FROM a""",
        "q9_worst_service_by_zone": """SELECT zona, servicio, errores FROM (
  SELECT zona, servicio, COUNT(*) AS errores,
    ROW_NUMBER() OVER (PARTITION BY zona ORDER BY COUNT(*) DESC, servicio) AS rn
  FROM logs WHERE nivel IN ('ERROR', 'CRITICAL') GROUP BY zona, servicio) a WHERE rn = 1""",
        "q10_status_classes": """SELECT clase_estado, COUNT(*) AS total FROM (
  SELECT CASE WHEN codigo_estado >= 200 AND codigo_estado < 300 THEN '2xx OK'
              WHEN codigo_estado >= 300 AND codigo_estado < 400 THEN '3xx Redireccion'
              WHEN codigo_estado >= 400 AND codigo_estado < 500 THEN '4xx Cliente'
              WHEN codigo_estado >= 500 AND codigo_estado < 600 THEN '5xx Servidor'
              ELSE 'Otro' END AS clase_estado FROM logs) a GROUP BY clase_estado""",
        "q11_throughput_by_hour": f"""SELECT CAST(EXTRACT(hour FROM timestamp_evento) AS INTEGER) AS hora,
  COUNT(*) AS eventos, {_avg(resp)} AS resp_avg_ms, {_errors()} AS errores FROM logs GROUP BY 1""",
    }


def _spec_analyses() -> dict[str, str]:
    resp = "tiempo_respuesta_ms"
    return {
        "c1_events_by_type": "SELECT tipo_evento, COUNT(*) AS total FROM logs GROUP BY tipo_evento",
        "c2_response_by_service": f"""SELECT servicio, COUNT(*) AS total_peticiones, {_avg(resp)} AS resp_avg_ms,
  MIN({resp}) AS resp_min_ms, MAX({resp}) AS resp_max_ms, {_std(resp)} AS resp_stddev_ms,
  {_avg('peticiones_por_minuto')} AS peticiones_min_avg FROM logs GROUP BY servicio""",
        "c3_latency_by_server": f"""SELECT servidor, {_avg('latencia_red_ms')} AS latencia_avg_ms,
  MAX(latencia_red_ms) AS latencia_max_ms FROM logs GROUP BY servidor""",
        "c4_bytes_by_server": """SELECT servidor, CAST(SUM(bytes_entrada) AS BIGINT) AS total_bytes_entrada,
  CAST(SUM(bytes_salida) AS BIGINT) AS total_bytes_salida FROM logs GROUP BY servidor""",
        "c5_errors_by_server": f"""SELECT servidor, {_avg('errores_minuto')} AS errores_min_avg,
  CAST(SUM(errores_minuto) AS BIGINT) AS errores_total FROM logs GROUP BY servidor""",
        "j1_events_by_level": "SELECT nivel, COUNT(*) AS total FROM logs GROUP BY nivel",
        "j2_cpu_ram_by_server": f"""SELECT servidor, COUNT(*) AS total, {_avg('uso_cpu_porcentaje')} AS cpu_avg,
  CAST(MIN(uso_cpu_porcentaje) AS DOUBLE) AS cpu_min, CAST(MAX(uso_cpu_porcentaje) AS DOUBLE) AS cpu_max,
  {_std('uso_cpu_porcentaje')} AS cpu_stddev, {_avg('uso_ram_porcentaje')} AS ram_avg
FROM logs GROUP BY servidor""",
        "j3_ram_by_service": f"""SELECT servicio, {_avg('uso_ram_porcentaje')} AS ram_avg, COUNT(*) AS total
FROM logs GROUP BY servicio""",
        "j4_disk_by_server": f"""SELECT servidor, CAST(MAX(uso_disco_porcentaje) AS DOUBLE) AS disco_max,
  {_avg('uso_disco_porcentaje')} AS disco_avg FROM logs GROUP BY servidor""",
        "j5_events_by_zone": "SELECT zona, COUNT(*) AS total FROM logs GROUP BY zona",
        "j6_critical_servers": f"""SELECT servidor, COUNT(*) AS eventos_criticos, {_avg('uso_cpu_porcentaje')} AS cpu_avg,
  {_avg('temperatura_cpu')} AS temp_avg FROM logs WHERE nivel IN ('CRITICAL', 'ERROR') GROUP BY servidor""",
        "b1_row_count": "SELECT COUNT(*) AS total FROM logs",
        "b2_by_level": "SELECT nivel, COUNT(*) AS total FROM logs GROUP BY nivel",
        "b3_cpu_by_server": f"""SELECT servidor, {_avg('uso_cpu_porcentaje')} AS cpu_avg,
  {_std('uso_cpu_porcentaje')} AS cpu_stddev FROM logs GROUP BY servidor""",
        "b4_by_zone_and_type": "SELECT zona, tipo_evento, COUNT(*) AS t FROM logs GROUP BY zona, tipo_evento",
    }


def _with_crc32(select: str) -> str:
    """``select`` over ``crc``: the event table and its CRC-32 ``c`` (reflected polynomial 0xEDB88320), bit by bit as SQL."""
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return f"""WITH RECURSIVE bits(n, c, i) AS (
  SELECT r, CAST(r AS BIGINT), 0 FROM range(256) t(r)
  UNION ALL SELECT n, {step}, i + 1 FROM bits WHERE i < 8),
tab AS (SELECT list(c ORDER BY n) AS t FROM bits WHERE i = 8),
{LOGS},
crc AS (
  SELECT logs.*, xor(list_reduce(
      list_concat([CAST(4294967295 AS BIGINT)],
        list_transform(range(1, length(id_log) + 1), lambda p: CAST(ascii(substr(id_log, CAST(p AS INTEGER), 1)) AS BIGINT))),
      lambda acc, b: xor(t[1 + (xor(acc, b) & 255)], acc >> 8)), 4294967295) AS c
  FROM logs, tab)
{select}"""


def _quality() -> str:
    """Violations per rule of the event table with planted faults."""
    pieces = []

    def rule(name: str, broken: str) -> None:
        pieces.append(f"SELECT {_lit(name)} AS rule, COUNT(*) FILTER (WHERE {broken}) AS violations FROM bad")

    required = ["id_log", "timestamp_evento", "servidor", "ip_servidor", "servicio", "tipo_evento", "nivel"]
    for c in required:
        rule(f"required:{c}", f"{c} IS NULL")
    for c, width in TEXT_WIDTHS.items():
        rule(f"width:{c}", f"length({c}) > {width}")
    for m in METRICS:
        cap = "" if m.cap is None else f" OR {m.name} > {m.cap // 100}"
        rule(f"range:{m.name}", f"{m.name} < 0{cap}")
    types = ", ".join(map(_lit, EVENT_TYPES))
    rule("domain:tipo_evento", f"tipo_evento NOT IN ({types})")
    rule("domain:nivel", "nivel NOT IN ('INFO', 'WARNING', 'ERROR', 'CRITICAL')")
    rule("only_request:metodo_http", "metodo_http IS NOT NULL AND tipo_evento <> 'request'")
    rule("only_security:intento_login", "intento_login IS NOT NULL AND tipo_evento <> 'security'")
    rule("only_security:pais_origen", "pais_origen IS NOT NULL AND tipo_evento <> 'security'")
    rule(
        "flag:ip_sospechosa",
        "ip_sospechosa IS NULL OR ip_sospechosa <> (tipo_evento = 'security' AND nivel <> 'INFO')",
    )
    pieces.append(
        "SELECT 'duplicate:id_log' AS rule, COUNT(id_log) - COUNT(DISTINCT id_log) AS violations FROM bad"
    )
    union = "\nUNION ALL ".join(pieces)
    return _over_logs(union, f",\nbad AS ({FAULTS})")


# The planted faults of the quality queries (see registry._faulty_logs).
FAULTS = """SELECT * REPLACE (
    CASE WHEN event_id % 97 = 3 THEN 'DEBUG' ELSE nivel END AS nivel,
    CASE WHEN event_id % 89 = 5 THEN CAST(150 AS DECIMAL(5,2)) ELSE uso_cpu_porcentaje END AS uso_cpu_porcentaje,
    CASE WHEN event_id % 83 = 7 THEN NULL ELSE servidor END AS servidor,
    CASE WHEN event_id % 79 = 11 THEN 'log-0' ELSE id_log END AS id_log,
    CASE WHEN event_id % 73 = 13 THEN repeat('x', 120) ELSE ciudad END AS ciudad,
    CASE WHEN event_id % 71 = 17 THEN NOT ip_sospechosa ELSE ip_sospechosa END AS ip_sospechosa)
  FROM logs"""


# Key and measures of every analysis of the suites C and J.
SUITE_MEASURES = {
    "c1_events_by_type": ("tipo_evento", "total"),
    "c2_response_by_service": (
        "servicio",
        "total_peticiones",
        "resp_avg_ms",
        "resp_min_ms",
        "resp_max_ms",
        "resp_stddev_ms",
        "peticiones_min_avg",
    ),
    "c3_latency_by_server": ("servidor", "latencia_avg_ms", "latencia_max_ms"),
    "c4_bytes_by_server": ("servidor", "total_bytes_entrada", "total_bytes_salida"),
    "c5_errors_by_server": ("servidor", "errores_min_avg", "errores_total"),
    "j1_events_by_level": ("nivel", "total"),
    "j2_cpu_ram_by_server": ("servidor", "total", "cpu_avg", "cpu_min", "cpu_max", "cpu_stddev", "ram_avg"),
    "j3_ram_by_service": ("servicio", "ram_avg", "total"),
    "j4_disk_by_server": ("servidor", "disco_max", "disco_avg"),
    "j5_events_by_zone": ("zona", "total"),
    "j6_critical_servers": ("servidor", "eventos_criticos", "cpu_avg", "temp_avg"),
}


def _suites(*names: str) -> str:
    """Analyses of the suites C and J (all, or those named), one row per group and measure."""
    texts = _spec_analyses()
    rows = [
        f"SELECT '{name}' AS analisis, {key} AS clave, '{m}' AS medida, CAST({m} AS DOUBLE) AS valor FROM ({texts[name]}) x"
        for name, (key, *measures) in SUITE_MEASURES.items()
        if not names or name in names
        for m in measures
    ]
    return _over_logs("\nUNION ALL ".join(rows))


def _dependencies() -> str:
    """Which columns fix others, over events of which some say otherwise."""
    fixed = [("servidor", c) for c in ("ip_servidor", "zona", "sistema_operativo", "ambiente")]
    lines = []
    for key, column in [*fixed, ("servicio", "tipo_evento"), ("servicio", "nivel")]:
        lines.append(f"""SELECT '{key} -> {column}' AS dependencia, COUNT(*) AS claves, COUNT(*) FILTER (WHERE a <> b) AS rotas,
  CAST(COALESCE(SUM(n) FILTER (WHERE a <> b), 0) AS BIGINT) AS filas, CAST(SUM(r - n) AS BIGINT) AS nulos,
  MIN(k) FILTER (WHERE a <> b) AS testigo, arg_min(a, k) FILTER (WHERE a <> b) AS valor_a, arg_min(b, k) FILTER (WHERE a <> b) AS valor_b
FROM (SELECT {key} AS k, MIN({column}) AS a, MAX({column}) AS b, COUNT({column}) AS n, COUNT(*) AS r
  FROM bad WHERE {key} IS NOT NULL GROUP BY {key}) x""")
    faults = """,
bad AS (SELECT * REPLACE (
    CASE WHEN event_id % 503 = 11 THEN 'rack-x' ELSE zona END AS zona,
    CASE WHEN event_id % 211 = 7 THEN NULL ELSE ambiente END AS ambiente,
    CASE WHEN servidor = 'server-03' AND event_id % 97 = 5 THEN '10.0.0.1' ELSE ip_servidor END AS ip_servidor,
    CASE WHEN event_id % 307 = 2 THEN NULL ELSE servidor END AS servidor) FROM logs)"""
    return _over_logs("\nUNION ALL ".join(lines), faults)


def _rank_bounds(points: dict[str, str], error: str) -> str:
    """The exact values ``error`` of the rows below and above each percentile, which an estimate must lie between."""
    column = "l_extendedprice"
    return ", ".join(
        f"quantile_disc({column}, {p} - {error}) AS {name}_min, quantile_disc({column}, {p} + {error}) AS {name}_max, TRUE AS {name}_ok"
        for name, p in points.items()
    )


def _operators() -> dict[str, str]:
    route = _case("tipo_evento", {k: _lit(v) for k, v in TOPIC_OF_TYPE.items()})
    decodable = "SELECT * FROM logs UNION ALL SELECT * REPLACE (NULL AS servidor) FROM logs WHERE event_id % 40 = 0"
    copies = "UNION ALL".join(f" SELECT '{c}' AS copia, * FROM ({decodable}) x " for c in ("csv", "jsonl"))
    return {
        "op_crc32_split": _with_crc32(
            """SELECT CAST((c * 8) >> 32 AS INTEGER) AS split, COUNT(*) AS filas, MIN(c) AS crc_min, MAX(c) AS crc_max
FROM crc GROUP BY 1"""
        ),
        "op_split_reads": _with_crc32(
            """SELECT CAST((c * 7) >> 32 AS INTEGER) AS split, COUNT(*) AS filas, MIN(c) AS crc_min,
  CAST(SUM(bytes_salida) AS BIGINT) AS bytes FROM crc GROUP BY 1"""
        ),
        "op_suite_one_scan": _suites(),
        "op_report_incremental": _suites(),
        "op_left_anti_ingest": """SELECT o_orderkey, o_custkey FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_orderkey IS NOT NULL)""",
        "op_dim_join": """SELECT s_suppkey, s_name, n_name FROM supplier
LEFT JOIN nation ON s_nationkey = n_nationkey""",
        "op_lookup_join": """SELECT n_name, COUNT(*) AS lineas, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS unidades
FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey
GROUP BY n_name""",
        "op_server_dim": _over_logs(
            "SELECT id_log, ip_servidor, zona, sistema_operativo, ambiente FROM logs"
        ),
        "op_topk": """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
        "op_top1_per_group": """SELECT l_suppkey, l_returnflag, filas FROM (
  SELECT l_suppkey, l_returnflag, COUNT(*) AS filas,
    ROW_NUMBER() OVER (PARTITION BY l_suppkey ORDER BY COUNT(*) DESC, l_returnflag) AS rn
  FROM lineitem GROUP BY l_suppkey, l_returnflag) a WHERE rn = 1""",
        "op_rank": """WITH a AS (SELECT o_custkey, COUNT(*) AS pedidos,
  CAST(SUM(CAST(ROUND(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS centavos FROM orders GROUP BY o_custkey)
SELECT *, CAST(RANK() OVER (ORDER BY centavos DESC) AS BIGINT) AS puesto FROM a""",
        "op_rank_ties": """WITH a AS (SELECT o_custkey, COUNT(*) AS pedidos FROM orders GROUP BY o_custkey)
SELECT *, CAST(RANK() OVER (ORDER BY pedidos DESC) AS BIGINT) AS puesto FROM a""",
        "op_conditional_rate": f"""SELECT l_suppkey, COUNT(*) AS total,
  COUNT(*) FILTER (WHERE l_returnflag = 'R') AS devueltas,
  {_r2("CAST(100 AS DOUBLE) * COUNT(*) FILTER (WHERE l_returnflag = 'R') / COUNT(*)")} AS pct_devueltas
FROM lineitem GROUP BY l_suppkey""",
        "op_having": """SELECT o_custkey, COUNT(*) AS pedidos, MAX(o_totalprice) AS mayor FROM orders
GROUP BY o_custkey HAVING COUNT(*) > 15 OR MAX(o_totalprice) > 480000""",
        "op_percentile_exact": """SELECT l_returnflag, quantile_disc(l_extendedprice, 0.5) AS p50,
  quantile_disc(l_extendedprice, 0.9) AS p90, quantile_disc(l_extendedprice, 0.95) AS p95,
  quantile_disc(l_extendedprice, 0.99) AS p99 FROM lineitem GROUP BY l_returnflag""",
        "op_percentile_approx": f"""SELECT l_returnflag, {_rank_bounds({"p50": "0.5", "p99": "0.99"}, "0.002")}
FROM lineitem GROUP BY l_returnflag""",
        "op_percentile_sketch": f"""SELECT l_returnflag, COUNT(*) AS filas, MIN(l_extendedprice) AS minimo,
  MAX(l_extendedprice) AS maximo, {_rank_bounds({"p1": "0.01", "p50": "0.5", "p90": "0.9", "p99": "0.99"}, "0.005")}
FROM lineitem WHERE l_shipdate >= DATE '1994-01-01' AND l_shipdate < DATE '1998-01-01' GROUP BY l_returnflag""",
        "op_case_bucket": """SELECT banda, COUNT(*) AS total FROM (
  SELECT CASE WHEN o_totalprice < 50000 THEN 'bajo' WHEN o_totalprice BETWEEN 50000 AND 250000 THEN 'medio'
    WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'alto urgente' ELSE 'alto' END AS banda
  FROM orders) a GROUP BY banda""",
        "op_group_expr_hour": """SELECT CAST(EXTRACT(hour FROM ts) AS INTEGER) AS hora, event_type, COUNT(*) AS total
FROM events GROUP BY 1, 2""",
        "op_dedupe_first": """SELECT o_custkey, o_orderkey, o_totalprice FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) a
WHERE rn = 1""",
        "op_spec_groups": """SELECT l_suppkey, l_linestatus, COUNT(*) AS n, COUNT(l_tax) AS con_tasa,
  MIN(l_quantity) AS q_min, MAX(l_quantity) AS q_max, CAST(SUM(l_linenumber) AS BIGINT) AS lineas
FROM lineitem WHERE l_discount > 0.05 GROUP BY l_suppkey, l_linestatus""",
        "op_json_decode": """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""",
        "op_json_encode_route": _over_logs(
            f"""SELECT id_log, {route} AS topic, servidor AS key, nivel,
  strftime(timestamp_evento, '%Y-%m-%dT%H:%M:%S.000Z') AS momento, ciudad,
  bytes_salida, metodo_http, CAST(ip_sospechosa AS INTEGER) AS ip_sospechosa,
  CAST(uso_cpu_porcentaje AS DOUBLE) AS cpu FROM logs"""
        ),
        "op_quality_report": _quality(),
        "op_quality_split": _over_logs(
            """SELECT reglas, COUNT(*) AS filas FROM (
  SELECT concat_ws(',',
    CASE WHEN servidor IS NULL THEN 'required:servidor' END,
    CASE WHEN length(ciudad) > 100 THEN 'width:ciudad' END,
    CASE WHEN uso_cpu_porcentaje > 100 THEN 'range:uso_cpu_porcentaje' END,
    CASE WHEN nivel = 'DEBUG' THEN 'domain:nivel' END,
    CASE WHEN ip_sospechosa <> (tipo_evento = 'security' AND nivel <> 'INFO') THEN 'flag:ip_sospechosa' END
  ) AS reglas FROM bad) a GROUP BY reglas""",
            f",\nbad AS ({FAULTS})",
        ),
        "op_csv_roundtrip": _over_logs(f"SELECT {ROUND_TRIP} FROM logs"),
        "op_csv_reordered": _over_logs(
            f"SELECT {ROUND_TRIP} FROM seen",
            """,
seen AS (SELECT * REPLACE (
    CASE WHEN event_id % 3 <> 1 THEN ciudad END AS ciudad, CASE WHEN event_id % 3 <> 1 THEN mensaje END AS mensaje,
    CASE WHEN event_id % 30 <> 2 THEN codigo_estado END AS codigo_estado,
    CASE WHEN event_id % 42 <> 2 THEN uso_cpu_porcentaje END AS uso_cpu_porcentaje) FROM logs)""",
        ),
        "op_csv_rejects": _over_logs(
            """SELECT id_log, concat_ws(',', CASE WHEN event_id % 30 = 2 THEN 'codigo_estado' END,
  CASE WHEN event_id % 42 = 2 THEN 'uso_cpu_porcentaje' END) AS celdas
FROM logs WHERE event_id % 30 = 2 OR event_id % 42 = 2"""
        ),
        "op_report_saved": _suites("c2_response_by_service", "c5_errors_by_server"),
        "op_quality_dependency": _dependencies(),
        "op_jsonl_roundtrip": _over_logs(f"SELECT {ROUND_TRIP} FROM logs"),
        "op_event_table_scan": _over_logs(
            f"""SELECT {ROUND_TRIP} FROM logs
WHERE timestamp_evento >= TIMESTAMP '2024-01-05' AND timestamp_evento < TIMESTAMP '2024-01-20'"""
        ),
        "op_stream_ingest": _over_logs(f"SELECT {ROUND_TRIP} FROM logs"),
        "op_ingest_indexed": _over_logs(f"SELECT {ROUND_TRIP} FROM logs"),
        "op_stream_distinct": _over_logs(f"SELECT {ROUND_TRIP} FROM logs"),
        "op_stream_dead_letters": """SELECT motivo, COUNT(*) AS mensajes FROM (
  SELECT 'malformed' AS motivo FROM events WHERE event_id % 50 = 0
  UNION ALL SELECT 'missing:servidor' FROM events WHERE event_id % 40 = 0) a GROUP BY motivo""",
        "op_stream_copies": _over_logs(
            f"""SELECT copia, {route} AS topic, COUNT(*) AS eventos, COUNT(metodo_http) AS con_metodo,
  COUNT(*) FILTER (WHERE servidor IS NULL) AS sin_servidor, CAST(SUM(bytes_entrada) AS BIGINT) AS bytes FROM ({copies}) a GROUP BY copia, 2"""
        ),
        "op_copy_dead_letters": _over_logs(
            f"""SELECT {route} AS topic, 'malformed' AS motivo, COUNT(*) AS mensajes, COUNT(*) AS con_texto
FROM logs WHERE event_id % 50 = 0 GROUP BY 1"""
        ),
        "op_stream_windowed": _over_logs(
            """SELECT servicio, CASE WHEN NOT late THEN strftime(w, '%Y-%m-%d %H:%M:%S') END AS inicio,
  COUNT(*) AS eventos, COUNT(*) FILTER (WHERE nivel IN ('ERROR', 'CRITICAL')) AS errores, CAST(late AS INTEGER) AS tarde
FROM timed GROUP BY servicio, 2, late""",
            """,
mark AS (SELECT MAX(timestamp_evento) - INTERVAL 10 MINUTES AS m FROM logs WHERE event_id % 3 <> 0),
timed AS (SELECT servicio, nivel, w, event_id % 3 = 0 AND w + INTERVAL 5 MINUTES <= m AS late
  FROM (SELECT *, time_bucket(INTERVAL 5 MINUTES, timestamp_evento) AS w FROM logs) x, mark)""",
        ),
    }


# Columns compared after a trip through a file format or a stream.
ROUND_TRIP = """id_log, strftime(timestamp_evento, '%Y-%m-%d %H:%M:%S') AS momento, servidor, nivel, ciudad,
  user_agent, metodo_http, mensaje, codigo_estado, tiempo_respuesta_ms, bytes_salida,
  CAST(uso_cpu_porcentaje AS DOUBLE) AS cpu, CAST(temperatura_cpu AS DOUBLE) AS temp,
  CAST(ip_sospechosa AS INTEGER) AS ip_sospechosa, pais_origen"""


def oracle_sql() -> dict[str, str]:
    analyses = {**_q_analyses(), **_spec_analyses()}
    over_logs = {}
    for name, sql in analyses.items():
        # q8 opens its own WITH: join the two lists of CTEs.
        over_logs[name] = f"WITH {LOGS},{sql[4:]}" if sql.startswith("WITH") else _over_logs(sql)
    sql_twins = {
        f"sql_{name}": text
        for name, text in over_logs.items()
        if name.startswith("q")
    }
    cpu, ram, temp = map(_avg, ("uso_cpu_porcentaje", "uso_ram_porcentaje", "temperatura_cpu"))
    sql_twins["sql_q5_critical_servers"] = _over_logs(
        f"""SELECT * FROM (SELECT servidor, COUNT(*) AS eventos, {cpu} AS cpu_avg, {ram} AS ram_avg, {temp} AS temp_avg
FROM logs WHERE nivel IN ('ERROR', 'CRITICAL') GROUP BY servidor) a WHERE cpu_avg > 70 OR ram_avg > 70 OR temp_avg > 75"""
    )
    return {**over_logs, **sql_twins, **_operators()}
