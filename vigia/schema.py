"""The canonical event table and the value domains that describe it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

_PCT = T.DecimalType(5, 2)


def _field(name: str, dtype: T.DataType, required: bool = False) -> T.StructField:
    return T.StructField(name, dtype, not required)


# The 37 columns of the event table, in table order.
EVENT_SCHEMA = T.StructType(
    [
        _field("id_log", T.StringType(), True),
        _field("timestamp_evento", T.TimestampType(), True),
        _field("servidor", T.StringType(), True),
        _field("ip_servidor", T.StringType(), True),
        _field("zona", T.StringType()),
        _field("sistema_operativo", T.StringType()),
        _field("ambiente", T.StringType()),
        _field("servicio", T.StringType(), True),
        _field("tipo_evento", T.StringType(), True),
        _field("nivel", T.StringType(), True),
        _field("codigo_estado", T.IntegerType()),
        _field("endpoint", T.StringType()),
        _field("metodo_http", T.StringType()),
        _field("usuario", T.StringType()),
        _field("correo_usuario", T.StringType()),
        _field("ciudad", T.StringType()),
        _field("ip_origen", T.StringType()),
        _field("user_agent", T.StringType()),
        _field("tiempo_respuesta_ms", T.IntegerType()),
        _field("uso_cpu_porcentaje", _PCT),
        _field("uso_ram_porcentaje", _PCT),
        _field("uso_disco_porcentaje", _PCT),
        _field("bytes_entrada", T.LongType()),
        _field("bytes_salida", T.LongType()),
        _field("peticiones_por_minuto", T.IntegerType()),
        _field("conexiones_activas", T.IntegerType()),
        _field("errores_minuto", T.IntegerType()),
        _field("latencia_red_ms", T.IntegerType()),
        _field("temperatura_cpu", _PCT),
        _field("paquetes_perdidos", T.IntegerType()),
        _field("intento_login", T.StringType()),
        _field("ip_sospechosa", T.BooleanType()),
        _field("pais_origen", T.StringType()),
        _field("trace_id", T.StringType()),
        _field("session_id", T.StringType()),
        _field("proceso", T.StringType()),
        _field("mensaje", T.StringType()),
    ]
)

EVENT_COLUMNS = EVENT_SCHEMA.fieldNames()
REQUIRED_COLUMNS = [f.name for f in EVENT_SCHEMA if not f.nullable]

# Bookkeeping columns carried by the file copies of the stream.
META_SCHEMA = T.StructType(
    [
        T.StructField("_kafka_topic", T.StringType()),
        T.StructField("_kafka_partition", T.IntegerType()),
        T.StructField("_kafka_offset", T.LongType()),
        T.StructField("_kafka_timestamp", T.TimestampType()),
        T.StructField("_consumer_ts", T.TimestampType()),
    ]
)
META_COLUMNS = META_SCHEMA.fieldNames()

# Declared widths of the bounded text columns.
TEXT_WIDTHS = {
    "id_log": 80,
    "servidor": 50,
    "ip_servidor": 45,
    "zona": 50,
    "sistema_operativo": 100,
    "ambiente": 50,
    "servicio": 100,
    "tipo_evento": 50,
    "nivel": 20,
    "endpoint": 150,
    "metodo_http": 10,
    "usuario": 100,
    "correo_usuario": 150,
    "ciudad": 100,
    "ip_origen": 45,
    "intento_login": 30,
    "pais_origen": 100,
    "trace_id": 100,
    "session_id": 100,
    "proceso": 100,
}

# Event types, levels and the topic that carries each type.
EVENT_TYPES = ["resource", "request", "error", "network", "security"]
LEVELS = ["INFO", "WARNING", "ERROR", "CRITICAL"]
ERROR_LEVELS = ["ERROR", "CRITICAL"]
TOPIC_OF_TYPE = {
    "resource": "metricas_recursos",
    "request": "logs_http",
    "error": "logs_errores",
    "network": "metricas_red",
    "security": "logs_seguridad",
}
TOPICS = list(TOPIC_OF_TYPE.values())

# The server dimension (servidor, ip, zona, sistema, ambiente).
SERVERS = [
    ("server-01", "192.168.1.65", "rack-a", "Ubuntu Server 24.04", "produccion"),
    ("server-02", "192.168.1.66", "rack-a", "Ubuntu Server 22.04", "produccion"),
    ("server-03", "192.168.1.67", "rack-b", "Debian 12", "produccion"),
    ("server-04", "192.168.1.68", "rack-b", "Rocky Linux 9", "pruebas"),
    ("server-05", "192.168.1.69", "rack-c", "Ubuntu Server 24.04", "desarrollo"),
]

# Service names by event type.
SERVICES = {
    "resource": ["system-monitor", "node-exporter", "resource-agent", "hardware-monitor"],
    "request": [
        "api-gateway",
        "web-server",
        "payment-service",
        "catalog-service",
        "notification-service",
    ],
    "error": [
        "database-service",
        "auth-service",
        "payment-service",
        "queue-service",
        "storage-service",
    ],
    "network": ["network-agent", "load-balancer", "proxy-service", "firewall-agent"],
    "security": ["auth-service", "access-control", "security-agent", "identity-service"],
}

# Level lists by event type; repetition is the weight.
LEVEL_WEIGHTS = {
    "error": ["ERROR", "ERROR", "ERROR", "WARNING", "CRITICAL"],
    "security": ["INFO", "INFO", "WARNING", "WARNING", "ERROR", "CRITICAL"],
    "network": ["INFO", "INFO", "INFO", "WARNING", "ERROR"],
    "resource": ["INFO", "INFO", "INFO", "WARNING", "WARNING", "ERROR", "CRITICAL"],
    "request": ["INFO", "INFO", "INFO", "INFO", "WARNING", "ERROR"],
}

# Text domains.
ENDPOINTS = [
    "/api/login",
    "/api/logout",
    "/api/usuarios",
    "/api/productos",
    "/api/pagos",
    "/api/reportes",
    "/api/notificaciones",
    "/api/ordenes",
    "/api/metricas",
    "/api/seguridad",
    "/api/carrito",
    "/api/inventario",
    "/api/facturas",
    "/api/clientes",
]
HTTP_METHODS = ["GET", "POST", "PUT", "PATCH", "DELETE"]
CITIES = [
    "Aguascalientes",
    "Guadalajara",
    "Ciudad de México",
    "Monterrey",
    "Zacatecas",
    "Querétaro",
    "León",
    "San Luis Potosí",
    "Puebla",
    "Toluca",
]
LOGIN_RESULTS = ["exitoso", "fallido", "bloqueado"]


@dataclass(frozen=True)
class Metric:
    """A metric column, its range per level and its upper cap.

    ``hundredths`` metrics are DECIMAL(5,2); their bounds are written x100 so
    that generators can stay in integer arithmetic.
    """

    name: str
    info: tuple[int, int]
    warning: tuple[int, int]
    error: tuple[int, int]
    critical: tuple[int, int]
    hundredths: bool = False
    cap: int | None = None

    def band(self, level: str) -> tuple[int, int]:
        return getattr(self, level.lower())


# Metric ranges per level.
METRICS = [
    Metric("tiempo_respuesta_ms", (20, 350), (300, 1200), (700, 3000), (1500, 6000)),
    Metric("uso_cpu_porcentaje", (300, 5500), (4000, 8200), (5500, 9200), (8200, 9950), True, 10000),
    Metric("uso_ram_porcentaje", (800, 6500), (3800, 8600), (5200, 9400), (8000, 9950), True, 10000),
    Metric("uso_disco_porcentaje", (1200, 7000), (3500, 8800), (4500, 9000), (7800, 9900), True, 10000),
    Metric("errores_minuto", (0, 3), (1, 12), (8, 50), (25, 120)),
    Metric("latencia_red_ms", (1, 90), (70, 300), (120, 700), (300, 1500)),
    Metric("temperatura_cpu", (3200, 6500), (5200, 8000), (6200, 9200), (8200, 10500), True, 11500),
    Metric("bytes_entrada", (500, 150000), (50000, 500000), (100000, 900000), (250000, 1500000)),
    Metric("bytes_salida", (500, 250000), (70000, 900000), (150000, 1500000), (400000, 2500000)),
    Metric("peticiones_por_minuto", (10, 900), (600, 2500), (1200, 4000), (2500, 7000)),
    Metric("conexiones_activas", (1, 350), (200, 1000), (400, 1600), (900, 3000)),
    Metric("paquetes_perdidos", (0, 5), (1, 40), (10, 150), (50, 500)),
]

SERVER_SCHEMA = T.StructType(
    [
        EVENT_SCHEMA[name]
        for name in ("servidor", "ip_servidor", "zona", "sistema_operativo", "ambiente")
    ]
)


def server_dimension(spark: SparkSession) -> DataFrame:
    """The five-row server dimension; small by construction."""
    return spark.createDataFrame(SERVERS, SERVER_SCHEMA)


def typed_columns(df: DataFrame, schema: T.StructType = EVENT_SCHEMA) -> list[Column]:
    """``schema`` as a select list over ``df``: missing columns become null."""
    present = {name.lower() for name in df.columns}
    return [
        (F.col(f.name) if f.name.lower() in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema
    ]


def conform(df: DataFrame, keep_meta: bool = False, extra: Sequence[str] = ()) -> DataFrame:
    """Project any event DataFrame onto the canonical columns and types.

    Unknown columns are dropped (but for those named in ``extra``), missing
    ones are null, and the event time is cut to the second.
    """
    out = df.select(
        *typed_columns(df),
        *(typed_columns(df, META_SCHEMA) if keep_meta else []),
        *extra,
    )
    return out.withColumn("timestamp_evento", F.date_trunc("second", "timestamp_evento"))


def create_event_table(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the event table as Parquet, partitioned by event date."""
    columns = ", ".join(
        f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
        for f in EVENT_SCHEMA
    )
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}, fecha DATE) "
        f"USING parquet PARTITIONED BY (fecha){where}"
    )
