import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from vigia.operators import Analysis, daily_state, merge_state, read_state, run, run_from_state, run_fused, write_state
from vigia.plans import SUITES

ALL = tuple((fn, c, f"{fn}_{c}") for c in ("i", "d", "x") for fn in ("count", "avg", "min", "max", "sum", "stddev"))
ANALYSES = [
    Analysis("by g", (("count", "*", "n"), *ALL), ("g",)),
    Analysis("by h", (("avg", "d", "m"), ("count", "i", "n")), ("h",), order=("m", "desc")),
    Analysis("by both", ALL, ("h", "g")),
    Analysis("some", (("count", "*", "n"), ("sum", "i", "s"), ("max", "x", "m")), ("g",), where="h <> 'b'"),
    Analysis("none", (("count", "*", "n"), ("min", "d", "m")), ("h",), where="h = 'zz'"),
    Analysis("whole", (("count", "*", "n"), *ALL)),
    Analysis("whole, some", (("count", "*", "n"), ("stddev", "x", "s")), where="g = 'hot'"),
]
TYPES = "i int, d decimal(5,2), x double"


@pytest.fixture(scope="module")
def facts(spark):
    """A hot group, a null group, a group of nulls, a group of one row; x has a large mean and a small spread."""
    df = spark.range(3000).selectExpr(
        "CASE WHEN id = 77 THEN 'one' WHEN id % 3 < 2 THEN 'hot' WHEN id % 5 = 0 THEN null ELSE concat('g', id % 4) END g",
        "element_at(array('a', 'b', 'c'), cast(id % 7 % 3 + 1 as int)) h",
        "if(id % 11 = 0 OR id % 4 = 3, null, cast(id * 48271 % 1009 - 300 as int)) i",
        "if(id % 4 = 3, null, cast(id * 7919 % 9973 / 100.0 as decimal(5,2))) d",
        "if(id % 13 = 0, null, 1e9 + id % 17 / 8.0D) x",
        "timestamp'2026-03-01' + (id % 9) * interval 1 day t",
    ).persist()
    df.count()
    return df


def close(a, b):
    assert len(a) == len(b)
    for x, y in zip(a, b, strict=True):
        for p, q in zip(x, y, strict=True):
            assert p == (pytest.approx(q, rel=1e-12, abs=1e-9) if isinstance(q, float) else q), (x, y)


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: repr(r[:2]))


@pytest.mark.parametrize("a", ANALYSES, ids=lambda a: a.name)
def test_state_of_days_merges_to_the_full_scan(spark, facts, a, tmp_path):
    path = f"{tmp_path}/s"
    for days in ("t < '2026-03-04'", "t >= '2026-03-03'"):  # the third day twice
        write_state(daily_state(facts.where(days), ["g", "h"], ["i", "d", "x"], "t"), path)
    got, want = run_from_state(read_state(spark, path), a), run(facts, a)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want.schema]
    close(as_rows(got), as_rows(want))


def test_a_range_of_days_reads_its_own_partitions(spark, facts, tmp_path):
    path = f"{tmp_path}/s"
    write_state(daily_state(facts, ["g", "h"], ["i"], "t"), path)
    state = read_state(spark, path, "2026-03-02", "2026-03-05")
    a = Analysis("a", (("count", "*", "n"), ("avg", "i", "m"), ("stddev", "i", "s")), ("h",))
    close(as_rows(run_from_state(state, a)), as_rows(run(facts.where("t >= '2026-03-02' AND t < '2026-03-05'"), a)))
    assert "PartitionFilters: [isnotnull(fecha" in plan(state)


def test_state_can_be_merged_in_steps(facts):
    """Days into a table by one key, then that into another: as good as at once."""
    state = daily_state(facts, ["g", "h"], ["x"], "t")
    a = Analysis("a", (("stddev", "x", "s"), ("avg", "x", "m")), ("h",))
    close(as_rows(run_from_state(merge_state(state, ["h", "g"], ["x"]), a)), as_rows(run(facts, a)))


def test_state_of_no_rows(spark, tmp_path):
    none = spark.createDataFrame([], f"g string, h string, {TYPES}, t timestamp")
    state = daily_state(none, ["g", "h"], ["i", "d", "x"], "t")
    for a in ANALYSES:
        assert as_rows(run_from_state(state, a)) == as_rows(run(none, a)), a.name


@pytest.mark.parametrize("stage", [True, False])
def test_fused_analyses_equal_single_ones(facts, stage, tmp_path):
    results, fused = run_fused(facts, ANALYSES, staging=f"{tmp_path}/f" if stage else None)
    assert list(results) == [a.name for a in ANALYSES]
    for a in ANALYSES:
        want = run(facts, a)
        assert [(f.name, f.dataType) for f in results[a.name].schema] == [(f.name, f.dataType) for f in want.schema], a.name
        close(as_rows(results[a.name]), as_rows(want))
    assert [r.h for r in results["by h"].collect()] == [r.h for r in run(facts, ANALYSES[1]).collect()]
    fused.unpersist()


def test_fused_analyses_of_no_rows(spark):
    none = spark.createDataFrame([], f"g string, h string, {TYPES}")
    results, fused = run_fused(none, ANALYSES)
    for a in ANALYSES:
        assert as_rows(results[a.name]) == as_rows(run(none, a)), a.name
    fused.unpersist()


def test_a_suite_scans_its_source_once(spark, sf_dir):
    from vigia.plans.fixture import logs_view

    for suite in (SUITES["csv"], SUITES["json"], SUITES["csv"] + SUITES["json"]):
        _, fused = run_fused(logs_view(spark, sf_dir), suite)
        text = plan(fused.unpersist())
        assert text.count("FileScan") == 1 and text.count("Expand") == 1
        # Combined in the task before the only shuffle.
        assert "partial_" in text and text.count("Exchange") == 1


def test_keys_that_are_measured_too(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 2)], "k string, v int")
    analyses = [Analysis("k", (("max", "v", "m"), ("count", "k", "n")), ("k",)), Analysis("v", (("min", "k", "m"), ("sum", "v", "s")), ("v",))]
    results, fused = run_fused(df, analyses)
    assert rows(results["k"]) == [("a", 2, 2), ("b", 2, 1)] and rows(results["v"]) == [(1, "a", 1), (2, "a", 4)]
    fused.unpersist()
