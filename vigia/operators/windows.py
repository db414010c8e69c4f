"""Ranking operators over aggregates, top-k, and first-row-per-key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_RN = "__rn"


def rank_groups(agg: DataFrame, by: str, alias: str) -> DataFrame:
    """RANK() OVER (ORDER BY ``by`` DESC) of a small aggregate.

    All rows meet in one partition, so the input must be an aggregate over a
    dimension (servers, zones).  For inputs that grow with the data use
    :func:`vigia.operators.distribution.global_rank`.
    """
    return agg.withColumn(alias, F.rank().over(Window.orderBy(F.col(by).desc_nulls_last())))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in ``order``.

    Planned as a group limit before and after the shuffle: every task keeps
    one row per key first, so a hot key sends one row per task.
    """
    numbered = df.withColumn(_RN, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return numbered.where(F.col(_RN) == 1).drop(_RN)


def top_per_group(
    agg: DataFrame, group: Sequence[str], by: str, ties: Sequence[str] = ()
) -> DataFrame:
    """The row with the highest ``by`` per group; ``ties`` decide equal ones."""
    order = [F.col(by).desc_nulls_last(), *(F.col(t).asc_nulls_first() for t in ties)]
    return first_per_key(agg, group, order)


def top_k(df: DataFrame, by: str, k: int = 10, ties: Sequence[str] = ()) -> DataFrame:
    """ORDER BY ``by`` DESC LIMIT ``k``: each task keeps k rows, then they merge."""
    order = [F.col(by).desc_nulls_last(), *(F.col(t).asc_nulls_first() for t in ties)]
    return df.orderBy(*order).limit(k)
