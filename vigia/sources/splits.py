"""A stored copy laid out by CRC32 of the key, read in any number of splits.

A database scan is split by ranges of a hash of the key; each split is a query of
its own.  Here the rows are stored in order of that hash, so a split reads the
files and row groups of its range and no others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.split import split_bounds

CRC = "__crc"
#: Bytes of a row group: the least that a split reads.
ROW_GROUP_BYTES = 8 << 20


def write_splits(df: DataFrame, path: str, key: str = "id_log", files: int | None = None, row_group: int = ROW_GROUP_BYTES) -> None:
    """Store ``df`` in order of the CRC32 of ``key``, in ``files`` files of even ranges (default: one per shuffle partition).

    The hash spreads different keys evenly; rows of one key share a hash and stay
    together.  Rows without a key come first, under hash -1.
    """
    hashed = df.withColumn(CRC, F.coalesce(F.crc32(F.col(key).cast("string")), F.lit(-1).cast("bigint")))
    files = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = hashed.repartitionByRange(files, CRC).sortWithinPartitions(CRC)
    dealt.write.mode("overwrite").option("parquet.block.size", row_group).parquet(path)


def read_split(spark: SparkSession, path: str, split: int, splits: int) -> DataFrame:
    """The rows whose hash falls in range ``split`` of ``splits`` equal ones; rows without a key are in the first.

    The range is a filter on the stored hash, which the Parquet reader holds against
    the least and greatest hash of each row group.
    """
    first, last = split_bounds(split, splits)
    if split == 0:
        first = -1
    return spark.read.parquet(path).where(F.col(CRC).between(first, last)).drop(CRC)
