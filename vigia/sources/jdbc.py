"""Partitioned scans of, and appends to, a relational copy of the event table."""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.split import CRC32_MAX
from ..schema import EVENT_COLUMNS, META_COLUMNS, conform

SPLIT = "pcol"


@dataclass(frozen=True)
class JdbcTable:
    """Where the table lives and how a scan is split.

    ``split`` is an SQL expression of the database with values spread over
    [``lower``, ``upper``]; the default hashes the key.  A database has no
    index on a hash, so each of the ``partitions`` queries scans the table:
    give an indexed numeric or time column where there is one.
    """

    url: str
    table: str = "logs_metricas_servidores"
    driver: str | None = None
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    split: str | None = "CRC32(id_log)"
    lower: str = "0"
    upper: str = str(CRC32_MAX)
    partitions: int = 8
    fetch_rows: int = 5000
    batch_rows: int = 500

    @classmethod
    def from_env(cls, **overrides) -> JdbcTable:
        """MySQL settings from MYSQL_* variables; credentials have no default."""
        env = os.environ
        host, port = env.get("MYSQL_HOST", "localhost"), env.get("MYSQL_PORT", "3306")
        database = env.get("MYSQL_DATABASE", "logs")
        settings = {
            "url": f"jdbc:mysql://{host}:{port}/{database}?serverTimezone=UTC",
            "driver": "com.mysql.cj.jdbc.Driver",
            "user": env.get("MYSQL_USER"),
            "password": env.get("MYSQL_PASSWORD"),
            "partitions": int(env.get("JDBC_NUM_PARTITIONS", "8")),
        }
        return cls(**{**settings, **overrides})

    def connection(self) -> dict[str, str]:
        optional = {"driver": self.driver, "user": self.user, "password": self.password}
        return {"url": self.url, **{k: v for k, v in optional.items() if v is not None}}

    def scan_options(self) -> dict[str, str]:
        options = {**self.connection(), "fetchsize": str(self.fetch_rows)}
        if self.split is None:
            return {**options, "dbtable": self.table}
        return {
            **options,
            "dbtable": f"(SELECT t.*, {self.split} AS {SPLIT} FROM {self.table} t) src",
            "partitionColumn": SPLIT,
            "lowerBound": self.lower,
            "upperBound": self.upper,
            "numPartitions": str(self.partitions),
        }

    def append_options(self) -> dict[str, str]:
        return {
            **self.connection(),
            "dbtable": self.table,
            "batchsize": str(self.batch_rows),
            "numPartitions": str(self.partitions),
        }


def read_jdbc(spark: SparkSession, source: JdbcTable) -> DataFrame:
    """The table in canonical form.  Filters and columns reach the database."""
    raw = spark.read.format("jdbc").options(**source.scan_options()).load()
    return conform(raw.drop(SPLIT, *META_COLUMNS))


def read_jdbc_keys(
    spark: SparkSession, source: JdbcTable, since: datetime | None = None, until: datetime | None = None
) -> DataFrame:
    """Stored ids, optionally only of event times in [since, until]."""
    raw = spark.read.format("jdbc").options(**source.scan_options()).load()
    if since is not None:
        raw = raw.where(F.col("timestamp_evento") >= F.lit(since))
    if until is not None:
        raw = raw.where(F.col("timestamp_evento") <= F.lit(until))
    return raw.select("id_log")


def for_database(df: DataFrame) -> DataFrame:
    """Canonical columns with booleans as 0/1."""
    return df.select(*EVENT_COLUMNS).withColumn("ip_sospechosa", F.col("ip_sospechosa").cast("int"))


def append_jdbc(df: DataFrame, target: JdbcTable) -> None:
    """Append in multi-row batches, one connection per partition."""
    for_database(df).write.format("jdbc").options(**target.append_options()).mode("append").save()
