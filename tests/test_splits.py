import zlib

import pytest
from conftest import rows
from pyspark.sql import functions as F

from vigia.functions import split_bounds
from vigia.sources import read_split, write_splits


@pytest.mark.parametrize("splits", [1, 2, 7, 8, 1000])
def test_bounds_cover_every_value_once(splits):
    bounds = [split_bounds(k, splits) for k in range(splits)]
    assert bounds[0][0] == 0 and bounds[-1][1] == 2**32 - 1
    assert all(a[1] + 1 == b[0] for a, b in zip(bounds, bounds[1:]))
    for k, (first, last) in enumerate(bounds):
        assert first * splits >> 32 == last * splits >> 32 == k
    with pytest.raises(ValueError):
        split_bounds(splits, splits)


def rows_scanned(df):
    """Rows that the Parquet reader handed on, before the filter."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    seen = [0]

    def walk(n):
        if n.nodeName().startswith("Scan parquet"):
            seen[0] += n.metrics().apply("numOutputRows").value()
        children = n.children()
        for i in range(children.size()):
            walk(children.apply(i))
        if n.nodeName() == "AdaptiveSparkPlan":
            walk(n.executedPlan())

    walk(node)
    return seen[0]


def test_a_split_reads_its_own_row_groups(spark, tmp_path):
    path, n = f"{tmp_path}/t", 200_000
    df = spark.range(n).selectExpr("concat('log-', id) id_log", "id v")
    write_splits(df, path, files=4, row_group=64 << 10)
    parts = [read_split(spark, path, k, 16) for k in range(16)]
    for k in (0, 5, 15):
        got = parts[k].collect()
        assert all((zlib.crc32(r.id_log.encode()) * 16) >> 32 == k for r in got) and n / 32 < len(got) < n / 8
        assert rows_scanned(parts[k]) < n / 4
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionAll(p)
    assert whole.count() == n and whole.exceptAll(df).count() == 0


def test_rows_without_a_key_and_hot_keys(spark, tmp_path):
    path = f"{tmp_path}/t"
    df = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 100 <> 1 THEN concat('k', id) END id_log", "id")
    write_splits(df, path, files=4)
    parts = [read_split(spark, path, k, 5) for k in range(5)]
    assert sum(p.count() for p in parts) == 3000
    assert parts[0].where("id_log IS NULL").count() == df.where("id_log IS NULL").count() > 0
    assert sorted(p.where(F.col("id_log") == "hot").count() for p in parts) == [0, 0, 0, 0, 1000]


def test_an_empty_table(spark, tmp_path):
    write_splits(spark.createDataFrame([], "id_log string, v int"), f"{tmp_path}/t")
    assert rows(read_split(spark, f"{tmp_path}/t", 1, 3)) == []
