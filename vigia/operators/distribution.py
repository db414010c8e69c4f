"""Running counts over an ordering that never put one group into one task.

Percentiles and ranks need to know how many rows lie below a value.  A window
over a whole group answers that in a single task, which fails when the group
holds a large share of the data.  Here the rows are first counted per distinct
value (a partial aggregate, so copies of a hot value collapse before the
shuffle), the values are cut into buckets at quantiles of the data itself, and
only bucket totals are summed along the group.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window, functions as F

_KEY, _VALUE, _N, _BUCKET = "__key", "__value", "__n", "__bucket"
_BELOW, _TOTAL, _SIZE, _EDGES = "__below", "__total", "__size", "__edges"


def _buckets_for(df: DataFrame, buckets: int | None) -> int:
    """A power of two near the number of shuffle partitions, at most 1024."""
    if buckets is None:
        buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return 1 << max(1, min(buckets - 1, 1023).bit_length())


def _key_struct(keys: Sequence[str]) -> Column:
    # Structs compare null fields as equal, so null groups join to themselves.
    return F.struct(*(F.col(k) for k in keys)) if keys else F.struct(F.lit(0).alias("all"))


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows per (group, value): ``__key``, ``__value``, ``__n``."""
    return df.groupBy(_key_struct(keys).alias(_KEY), F.col(value).alias(_VALUE)).agg(
        F.count(F.lit(1)).alias(_N)
    )


def _bucketed(counts: DataFrame, buckets: int) -> DataFrame:
    """Add an order-preserving bucket number; null values get bucket -1.

    The edges are quantiles over all distinct values, so any bucket of any
    group holds about ``1/buckets`` of the distinct (group, value) rows.  A
    bucket number is the count of edges below the value, found by binary
    search with one projected step per bit: array access is compiled, the
    higher-order functions are not.
    """
    cuts = [i / buckets for i in range(1, buckets)]
    # The filter is always true; it makes this branch need the counts, so Spark
    # reuses the exchange of the main branch instead of aggregating again.
    edges = counts.where(F.col(_N) > 0).agg(F.percentile_approx(_VALUE, cuts, 4 * buckets)).scalar()

    value, found, step = F.col(_VALUE), F.lit(0), buckets // 2
    out = counts.withColumn(_EDGES, edges)
    while step:
        beyond = F.get(_EDGES, found + F.lit(step - 1)) < value
        out = out.withColumn(_BUCKET, found + F.when(beyond, F.lit(step)).otherwise(F.lit(0)))
        found, step = F.col(_BUCKET), step // 2
    return out.withColumn(_BUCKET, F.when(value.isNull(), F.lit(-1)).otherwise(found)).drop(_EDGES)


def _bucket_offsets(bucketed: DataFrame, with_nulls: bool) -> DataFrame:
    """Per (group, bucket): its rows, the rows below it, the group's rows.

    Null values count as the lowest, or not at all.
    """
    n = F.col(_N) if with_nulls else F.when(F.col(_BUCKET) >= 0, F.col(_N)).otherwise(F.lit(0))
    sizes = bucketed.groupBy(_KEY, _BUCKET).agg(F.sum(n).alias(_SIZE))
    # At most `buckets` + 1 rows per group reach this window.
    along = Window.partitionBy(_KEY).orderBy(_BUCKET)
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(
        _KEY,
        _BUCKET,
        _SIZE,
        F.coalesce(F.sum(_SIZE).over(before), F.lit(0)).alias(_BELOW),
        F.sum(_SIZE).over(Window.partitionBy(_KEY)).alias(_TOTAL),
    )


def _rows_below(bucketed: DataFrame, offsets: DataFrame) -> DataFrame:
    """Per (group, value): ``__n``, rows strictly below, rows of the group."""
    inside = (
        Window.partitionBy(_KEY, _BUCKET)
        .orderBy(_VALUE)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return bucketed.join(offsets, [_KEY, _BUCKET]).select(
        _KEY,
        _VALUE,
        _N,
        (F.col(_BELOW) + F.coalesce(F.sum(_N).over(inside), F.lit(0))).alias(_BELOW),
        _TOTAL,
    )


def _target(probability: float | str) -> Column:
    """1-based position of a discrete percentile: ceil(p * rows), at least 1.

    Integer arithmetic on the decimal text of ``p``: no binary rounding.
    """
    p = Fraction(str(probability))
    up = p.denominator - 1
    return F.expr(f"greatest(1L, ({_TOTAL} * {p.numerator}L + {up}L) div {p.denominator}L)")


def _percentiles_of(counts: DataFrame, percentiles: dict[str, float], buckets: int) -> DataFrame:
    """Per ``__key``: the named percentiles of counted values."""
    bucketed = _bucketed(counts, buckets)
    targets = {name: _target(p) for name, p in percentiles.items()}

    def reached(target: Column, size: str) -> Column:
        return (F.col(_BELOW) < target) & (target <= F.col(_BELOW) + F.col(size))

    holds_answer = F.lit(False)
    for target in targets.values():
        holds_answer |= reached(target, _SIZE)
    # Only the buckets that hold an answer are shuffled and sorted.
    rows = _rows_below(bucketed, _bucket_offsets(bucketed, with_nulls=False).where(holds_answer))
    return rows.groupBy(_KEY).agg(
        *(F.max(F.when(reached(t, _N), F.col(_VALUE))).alias(name) for name, t in targets.items())
    )


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    percentiles: dict[str, float],
    buckets: int | None = None,
) -> DataFrame:
    """Discrete percentiles of ``value`` per group: the smallest value with at
    least ``p`` of the group's non-null rows at or below it.

    ``percentiles`` maps output names to probabilities.  Groups without any
    non-null value are absent.
    """
    counts = value_counts(df, keys, value)
    points = _percentiles_of(counts, percentiles, _buckets_for(df, buckets))
    return points.select(*(F.col(f"{_KEY}.{k}") for k in keys), *percentiles)


def exact_summary(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    percentiles: dict[str, float],
    rows_alias: str,
    max_alias: str,
    buckets: int | None = None,
) -> DataFrame:
    """Row count, exact percentiles and maximum per group, from one scan."""
    counts = value_counts(df, keys, value)
    totals = counts.groupBy(_KEY).agg(F.sum(_N).alias(rows_alias), F.max(_VALUE).alias(max_alias))
    points = _percentiles_of(counts, percentiles, _buckets_for(df, buckets))
    return totals.join(points, _KEY, "left").select(
        *(F.col(f"{_KEY}.{k}") for k in keys), rows_alias, *percentiles, max_alias
    )


def approx_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    percentiles: dict[str, float],
    accuracy: int = 10000,
) -> DataFrame:
    """Percentiles from one mergeable digest per group; rank error <= 1/accuracy."""
    digest = F.percentile_approx(value, list(percentiles.values()), accuracy)
    named = [F.col("__p")[i].alias(name) for i, name in enumerate(percentiles)]
    return df.groupBy(*keys).agg(digest.alias("__p")).select(*keys, *named)


def global_rank(
    df: DataFrame, value: str, alias: str, descending: bool = True, buckets: int | None = None
) -> DataFrame:
    """RANK() over the whole input without a single-partition window.

    Ties share a rank and leave a gap.  Nulls rank last when descending and
    first when ascending.
    """
    bucketed = _bucketed(value_counts(df, [], value), _buckets_for(df, buckets))
    rows = _rows_below(bucketed, _bucket_offsets(bucketed, with_nulls=True))
    rank = F.col(_BELOW) + 1
    if descending:
        rank = F.col(_TOTAL) - F.col(_BELOW) - F.col(_N) + 1
    ranks = rows.select(F.struct(_VALUE).alias(_VALUE), rank.cast("bigint").alias(alias))
    return df.withColumn(_VALUE, F.struct(F.col(value).alias(_VALUE))).join(ranks, _VALUE).drop(_VALUE)
