from fractions import Fraction
from math import ceil

import pytest
from conftest import numbered_events, plan, rows
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from vigia.operators import (
    approx_percentiles,
    event_rules,
    exact_percentiles,
    first_per_key,
    global_rank,
    insert_if_absent,
    lookup,
    quality_report,
    split_by_rules,
    top_k,
    top_per_group,
    with_server_attributes,
)
from vigia.schema import EVENT_COLUMNS, SERVERS

POINTS = {"p1": 0.01, "p50": 0.5, "p90": 0.9, "p99": 0.99, "p100": 1}


def discrete(values, p):
    ordered = sorted(v for v in values if v is not None)
    return ordered[max(1, ceil(Fraction(str(p)) * len(ordered))) - 1]


@given(
    data=st.lists(
        st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-50, 50))), max_size=60
    ),
    buckets=st.integers(2, 6),
)
@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
def test_exact_percentiles_against_sorting(spark, data, buckets):
    df = spark.createDataFrame(data, "k string, v int")
    got = rows(exact_percentiles(df, ["k"], "v", POINTS, buckets))
    groups = {}
    for k, v in data:
        if v is not None:
            groups.setdefault(k, []).append(v)
    expected = [(k, *(discrete(vs, p) for p in POINTS.values())) for k, vs in groups.items()]
    assert got == sorted(expected, key=repr)


def test_exact_percentiles_of_a_hot_group(spark):
    df = spark.range(0, 30000).selectExpr("if(id % 3 < 2, 'hot', 'cold') k", "pmod(id * 7919, 10007) / 8.0D v")
    expected = [
        (k, *(discrete([r.v for r in df.where(F.col("k") == k).collect()], p) for p in POINTS.values()))
        for k in ("cold", "hot")
    ]
    assert rows(exact_percentiles(df, ["k"], "v", POINTS)) == expected


def test_exact_percentiles_without_keys(spark):
    df = spark.range(1, 1001)
    assert rows(exact_percentiles(df, [], "id", {"p50": 0.5, "p95": 0.95})) == [(500, 950)]


def test_percentiles_count_values_once(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    result = exact_percentiles(df, ["l_returnflag"], "l_extendedprice", {"p50": 0.5})
    result.collect()
    final = plan(result).split("\n+- == Initial Plan ==")[0]
    # Both the sampled edges and the bucket sums reuse the counted exchange.
    assert final.count("ReusedExchange") == 2


def test_approximate_percentiles_have_bounded_rank_error(spark):
    n, accuracy = 50000, 100
    df = spark.range(n).selectExpr("pmod(id * 48271, 1000003) v", "'a' k")
    ordered = sorted(r.v for r in df.collect())
    row = approx_percentiles(df, ["k"], "v", {"p50": 0.5, "p99": 0.99}, accuracy).first()
    for name, p in (("p50", 0.5), ("p99", 0.99)):
        assert abs(ordered.index(row[name]) - p * n) <= n / accuracy + 1


@given(data=st.lists(st.one_of(st.none(), st.integers(0, 12)), min_size=1, max_size=60), descending=st.booleans())
@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
def test_global_rank_equals_window_rank(spark, data, descending):
    df = spark.createDataFrame(list(enumerate(data)), "id int, v int")
    df.createOrReplaceTempView("ranked")
    order = "DESC NULLS LAST" if descending else "ASC NULLS FIRST"
    expected = spark.sql(f"SELECT id, v, rank() OVER (ORDER BY v {order}) r FROM ranked")
    assert rows(global_rank(df, "v", "r", descending, buckets=4)) == rows(expected)


def test_first_per_key_limits_groups_before_the_shuffle(spark):
    df = spark.range(0, 10000).selectExpr("if(id % 3 = 0, -1, id) k", "10000 - id t", "id v")
    first = first_per_key(df, ["k"], [F.asc("t")])
    assert plan(first).count("WindowGroupLimit") == 2
    got = dict((r.k, r.v) for r in first.collect())
    assert got[-1] == 9999 and len(got) == 1 + 10000 - 3334


def test_top_k_cuts_and_breaks_ties(spark):
    df = spark.range(0, 100).selectExpr("id", "id div 10 g")
    assert [r.id for r in top_k(df, "g", 12, ["id"]).collect()] == [*range(90, 100), 80, 81]
    assert "TakeOrderedAndProject" in plan(top_k(df, "g", 12, ["id"]))


def test_top_per_group(spark):
    df = spark.createDataFrame([("z", "b", 2), ("z", "a", 2), ("y", "c", None)], "g string, s string, n int")
    assert rows(top_per_group(df, ["g"], "n", ["s"])) == [("y", "c", None), ("z", "a", 2)]


def test_insert_if_absent(spark):
    new = spark.createDataFrame([(i, f"n{i}") for i in range(10)], "id int, v string")
    old = spark.createDataFrame([(i,) for i in [2, 3, 3, 3, 50]], "id int")
    out = insert_if_absent(new, old, "id")
    assert sorted(r.id for r in out.collect()) == [0, 1, 4, 5, 6, 7, 8, 9]


def test_lookup_keeps_unmatched_rows(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(1, "one")], "k int, name string")
    assert rows(lookup(df, dim, "k", ["name"])) == rows(
        spark.createDataFrame([(1, "one"), (2, None), (None, None)], "k int, name string")
    )


def test_lookup_above_the_broadcast_size_shuffles(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = lookup(spark.range(100).toDF("k"), spark.range(100).selectExpr("id k", "id v"), "k", ["v"])
        assert "SortMergeJoin" in plan(out) and out.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_server_attributes_replace_what_was_there(spark):
    df = spark.createDataFrame([("server-02", "?"), ("other", "?")], "servidor string, zona string")
    got = {r.servidor: r.asDict() for r in with_server_attributes(df).collect()}
    assert tuple(got["server-02"][c] for c in ("ip_servidor", "zona", "sistema_operativo", "ambiente")) == SERVERS[1][1:]
    assert got["other"]["zona"] is None


def test_quality_counts_each_broken_rule(spark):
    good = numbered_events(spark.range(50))
    faults = {
        "required:servicio": {"servicio": "null"},
        "width:metodo_http": {"tipo_evento": "'request'", "metodo_http": "repeat('G', 11)", "intento_login": "null",
                              "pais_origen": "null", "ip_sospechosa": "false"},
        "range:latencia_red_ms": {"latencia_red_ms": "-1"},
        "range:temperatura_cpu": {"temperatura_cpu": "cast(115.01 as decimal(5,2))"},
        "domain:tipo_evento": {"tipo_evento": "'otro'", "metodo_http": "null", "intento_login": "null",
                               "pais_origen": "null", "ip_sospechosa": "false"},
        "only_request:metodo_http": {"tipo_evento": "'resource'", "metodo_http": "'GET'", "intento_login": "null",
                                     "pais_origen": "null", "ip_sospechosa": "false"},
        "flag:ip_sospechosa": {"ip_sospechosa": "null"},
    }
    for rule, change in faults.items():
        one = good.limit(1).selectExpr(*(f"{change.get(c, c)} AS {c}" for c in EVENT_COLUMNS))
        assert rows(quality_report(one, event_rules()).where("violations > 0")) == [(rule, 1)], rule
        kept, rejected = split_by_rules(one, event_rules())
        assert kept.count() == 0 and rejected.first()["reglas"] == rule


def test_quality_duplicates_of_a_hot_key(spark):
    df = spark.range(0, 1000).selectExpr("if(id < 400, 'hot', cast(id as string)) id_log")
    out = quality_report(df, event_rules()[:1], "id_log")
    assert rows(out) == [("duplicate:id_log", 399), ("required:id_log", 0)]


def test_dimension_join_is_broadcast_and_pruned(spark, sf_dir):
    from vigia.plans.fixture import logs_view

    out = with_server_attributes(logs_view(spark, sf_dir)).groupBy("zona").count()
    assert "BroadcastHashJoin" in plan(out)
