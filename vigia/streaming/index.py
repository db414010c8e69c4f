"""The ids of a table, bucketed by hash, for looking up a batch without moving them."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

LOT = "lote"


@dataclass(frozen=True)
class IdIndex:
    """Stored ids in ``buckets`` files by hash of the id, below ``path``.

    A join on the id reads each bucket where the new ids of that bucket are sent:
    only the new side is shuffled.  Every batch adds one file a bucket at most;
    :meth:`compacted` writes them anew.  The number of buckets is part of the files
    and stays as it was first given.
    """

    path: str
    buckets: int = 64
    key: str = "id_log"

    @property
    def table(self) -> str:
        return f"ids_{hashlib.md5(self.path.encode()).hexdigest()}"

    def _declare(self, spark: SparkSession) -> None:
        """The bucketing is known by the session's catalog; a new session declares it again over the same files."""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} ({self.key} STRING, {LOT} STRING) USING parquet "
            f"CLUSTERED BY ({self.key}) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )

    def add(self, ids: DataFrame, lot: str) -> None:
        """Add the ids (column ``key``) of one batch, named ``lot``."""
        spark = ids.sparkSession
        self._declare(spark)
        rows = ids.select(F.col(self.key).cast("string").alias(self.key), F.lit(lot).alias(LOT))
        # One task a bucket, so one file a bucket.
        dealt = rows.repartition(self.buckets, self.key)
        dealt.write.mode("append").format("parquet").bucketBy(self.buckets, self.key).option("path", self.path).saveAsTable(self.table)

    def ids(self, spark: SparkSession) -> DataFrame:
        """(key, lote) of all stored ids."""
        self._declare(spark)
        return spark.table(self.table)

    def has(self, spark: SparkSession, lot: str) -> bool:
        """Whether a batch has been added, wholly or in part."""
        return not self.ids(spark).where(F.col(LOT) == lot).isEmpty()

    def absent(self, rows: DataFrame, lot: str | None = None) -> DataFrame:
        """``rows`` whose id is not stored; ids that batch ``lot`` itself has added do not count."""
        stored = self.ids(rows.sparkSession)
        if lot is not None:
            stored = stored.where(F.col(LOT) != lot)
        # The stored side must be the one that stays: no broadcast of the new ids.
        return rows.join(stored.select(self.key).hint("merge"), self.key, "left_anti")

    def compacted(self, spark: SparkSession, path: str) -> IdIndex:
        """The same ids, each once, in one file a bucket below ``path``."""
        out = IdIndex(path, self.buckets, self.key)
        out.add(self.ids(spark).groupBy(self.key).agg(F.lit(0)), "compacted")
        return out
