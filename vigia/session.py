"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SQL_SETTINGS = {
    # Event times are UTC; results must not depend on the host's zone.
    "spark.sql.session.timeZone": "UTC",
    # The JVM does not compile methods above 8000 bytes; wide projections over
    # the event table run several times faster when they are split instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

_local_scratch: list[tempfile.TemporaryDirectory] = []


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings this package relies on."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    app: str = "vigia",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the package settings; ``master`` is left to spark-submit."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SQL_SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    It is the folder the cluster names in ``spark.checkpoint.dir``.  Only a
    local session without that setting falls back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if not _local_scratch:
        _local_scratch.append(tempfile.TemporaryDirectory(prefix="vigia-"))
    return _local_scratch[0].name


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the scratch folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
