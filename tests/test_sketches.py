import bisect

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from vigia.operators import daily_sketches, read_sketches, sketch_percentiles, write_sketches
from vigia.operators.sketches import RANK_ERROR

POINTS = {"p1": 0.01, "p25": 0.25, "p50": 0.5, "p90": 0.9, "p99": 0.99}


def numbers(spark, n, kind="bigint"):
    """One group holds two thirds of the rows; every seventh value is null."""
    return spark.range(n).selectExpr(
        "if(id % 3 < 2, 'hot', 'cold') k",
        f"if(id % 7 = 0, null, cast(pmod(id * 48271, 1000003) as {kind})) v",
        "timestamp'2026-01-01' + (id % 11) * interval 1 day t",
    )


@pytest.mark.parametrize("kind", ["bigint", "int", "double", "decimal(12,2)"])
def test_merged_days_keep_the_rank_error(spark, kind):
    df = numbers(spark, 120_000, kind).persist()
    got = sketch_percentiles(daily_sketches(df, ["k"], "v", "t"), ["k"], POINTS).collect()
    for r in got:
        values = sorted(x.v for x in df.where((F.col("k") == r.k) & F.col("v").isNotNull()).collect())
        assert (r.filas, r.minimo, r.maximo) == (len(values), values[0], values[-1])
        for name, p in POINTS.items():
            low, high = bisect.bisect_left(values, r[name]), bisect.bisect_right(values, r[name])
            assert low / len(values) - RANK_ERROR <= p <= high / len(values) + RANK_ERROR, (r.k, name)
    df.unpersist()


def test_small_groups_are_exact(spark):
    df = numbers(spark, 150)
    got = {r.k: r for r in sketch_percentiles(daily_sketches(df, ["k"], "v", "t"), ["k"], {"p50": 0.5, "p100": 1.0}).collect()}
    for k in ("hot", "cold"):
        values = sorted(r.v for r in df.where(F.col("k") == k).collect() if r.v is not None)
        assert (got[k].p50, got[k].p100) == (values[(len(values) + 1) // 2 - 1], values[-1])


def test_a_day_stored_again_replaces_its_old_sketch_only(spark, tmp_path):
    path = f"{tmp_path}/s"
    write_sketches(daily_sketches(numbers(spark, 2200), ["k"], "v", "t"), path)
    again = numbers(spark, 2200).where("t = timestamp'2026-01-03'").withColumn("v", F.lit(5).cast("bigint"))
    write_sketches(daily_sketches(again, ["k"], "v", "t"), path)
    third = sketch_percentiles(read_sketches(spark, path, "2026-01-03", "2026-01-04"), [], {"p50": 0.5})
    assert rows(third) == [(200, 5, 5, 5)]
    everything = sketch_percentiles(read_sketches(spark, path), [], {"p50": 0.5}).first()
    assert everything.filas == 200 + sum(r.v is not None for r in numbers(spark, 2200).where("t <> timestamp'2026-01-03'").collect())


def test_only_the_days_asked_for_are_read(spark, tmp_path):
    path = f"{tmp_path}/s"
    write_sketches(daily_sketches(numbers(spark, 500), ["k"], "v", "t"), path)
    scan = read_sketches(spark, path, "2026-01-02", "2026-01-04")
    assert "PartitionFilters: [isnotnull(fecha" in plan(scan)
    assert {str(r.fecha) for r in scan.select("fecha").collect()} == {"2026-01-02", "2026-01-03"}


def test_no_rows_no_groups(spark):
    none = numbers(spark, 20).where("v IS NULL")
    assert sketch_percentiles(daily_sketches(none, ["k"], "v", "t"), ["k"], POINTS).count() == 0
