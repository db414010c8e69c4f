"""The two joins of the domain: insert-if-absent and dimension lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..schema import server_dimension


def insert_if_absent(new: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` whose key is not in ``existing``.

    The stored keys are first cut to those of ``new``.  No broadcast hint: Spark
    broadcasts the keys of ``new`` when their measured size is below
    ``spark.sql.autoBroadcastJoinThreshold``, and the large table is then not
    shuffled; beyond it both sides are shuffled by key.
    """
    keys = existing.select(key).join(new.select(key).distinct(), key, "left_semi")
    return new.join(keys.distinct(), key, "left_anti")


def lookup(df: DataFrame, dimension: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Left join of ``columns`` from a dimension in which ``key`` is unique.

    A key that the dimension repeats multiplies the rows that have it.

    No broadcast hint: Spark broadcasts the dimension when its measured size
    is below ``spark.sql.autoBroadcastJoinThreshold``; above it the join
    shuffles and AQE splits partitions of hot keys.
    """
    return df.join(dimension.select(key, *columns), key, "left")


def with_server_attributes(df: DataFrame) -> DataFrame:
    """Replace address, zone, system and environment by the server's own."""
    dimension = server_dimension(df.sparkSession)
    attributes = [c for c in dimension.columns if c != "servidor"]
    order = df.columns + [c for c in attributes if c not in df.columns]
    # Five rows by construction.
    joined = df.drop(*attributes).join(F.broadcast(dimension), "servidor", "left")
    return joined.select(*order)
