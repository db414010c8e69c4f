from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from vigia.functions import clamp, crc32_split, round_half_up, round_ties_up, status_class
from vigia.operators import Analysis, Measure, run, run_shared
from vigia.plans import CSV_SUITE, JSON_SUITE, SQL_CATALOG, SQL_SUITE, SqlAnalysis, run_sql
from vigia.plans.analyses import q1_global_stats, q5_critical_servers, q10_status_classes
from vigia.plans.analyses import q8_server_cpu_ranking, q9_worst_service_by_zone
from vigia.sources import register

METRICS = "servidor string, zona string, nivel string, servicio string, uso_cpu_porcentaje decimal(5,2), " \
    "uso_ram_porcentaje decimal(5,2), uso_disco_porcentaje decimal(5,2), temperatura_cpu decimal(5,2), " \
    "latencia_red_ms int, tiempo_respuesta_ms int, codigo_estado int"


def make(spark, *records):
    """Event-like rows from keyword records; absent fields are null."""
    from pyspark.sql.types import _parse_datatype_string

    schema = _parse_datatype_string(METRICS)
    return spark.createDataFrame([tuple(r.get(c) for c in schema.names) for r in records], schema)


def test_unknown_function_is_named():
    with pytest.raises(ValueError, match="median"):
        Measure("median", "x", "m")
    with pytest.raises(ValueError, match="only count"):
        Analysis("a", (("sum", "*", "n"),))
    with pytest.raises(ValueError, match="no measures"):
        Analysis("a", ())


def test_dictionary_form(spark):
    a = Analysis.from_dict(
        {
            "nombre": "n",
            "filtro": "v > 1",
            "group_by": ["k"],
            "agg": [("count", "*", "n"), ("count", "v", "nn"), ("avg", "v", "media"), ("sum", "v", "suma")],
            "orden": ("n", "desc"),
            "guardar": "f",
        }
    )
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 4), ("b", 5), ("c", None)], "k string, v int")
    assert rows(run(df, a), "ordered") == [("a", 2, 2, 3.0, 6), ("b", 1, 1, 5.0, 5)]
    assert a.save == "f" and a.columns() == ["k", "v"]


def test_order_other_than_desc_is_ascending(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", 2)], "k string, v int")
    a = Analysis("n", (("count", "*", "n"),), ("k",), order=("n", "up"))
    assert rows(run(df, a), "ordered") == [("a", 1), ("b", 2)]


def test_ties_are_ordered_by_key_and_null_group_is_kept(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "k string")
    a = Analysis("n", (("count", "*", "n"),), ("k",), order=("n", "desc"))
    assert rows(run(df, a), "ordered") == [(None, 1), ("a", 1), ("b", 1)]


def test_single_row_group_has_null_deviation(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", 1.0), ("b", 2.0)], "k string, v double")
    a = Analysis("n", (("stddev", "v", "s"),), ("k",))
    assert rows(run(df, a)) == [("a", None), ("b", 0.71)]


def test_empty_input(spark):
    empty = make(spark)
    assert rows(q1_global_stats(empty)) == [(None,) * 9]
    assert rows(run(empty, Analysis("n", (("count", "*", "n"),), ("zona",)))) == []
    assert rows(run(empty, Analysis("n", (("count", "*", "n"), ("avg", "latencia_red_ms", "m"))))) == [(0, None)]


def test_average_skips_nulls_and_does_not_depend_on_partitions(spark):
    df = spark.range(0, 5000).selectExpr(
        "cast(id % 3 as string) k", "if(id % 7 = 0, null, cast(id % 9999 / 100.0 as decimal(5,2))) v"
    )
    a = Analysis("n", (("avg", "v", "m"), ("stddev", "v", "s"), ("sum", "v", "t")), ("k",))
    assert rows(run(df.repartition(1), a)) == rows(run(df.repartition(13), a))


def test_wide_sums_do_not_overflow(spark):
    """SUM(DECIMAL(5,2)) ends at 10^13; ours goes on."""
    big = spark.range(1).selectExpr("cast(id + 999.99BD as decimal(5,2)) v")
    a = Analysis("n", (("sum", "v", "t"), ("avg", "v", "m")))
    result = run(big, a)
    assert result.schema["t"].dataType.simpleString() == "double"
    assert "decimal(8,2)" in result._jdf.queryExecution().optimizedPlan().toString()
    assert rows(result) == [(999.99, 999.99)]


def test_skewed_group_gives_the_same_answer(spark):
    df = spark.range(0, 20000).selectExpr("if(id % 10 < 9, 'hot', cast(id % 50 as string)) k", "id % 101 v")
    a = Analysis("n", (("count", "*", "n"), ("avg", "v", "m"), ("max", "v", "x")), ("k",))
    assert rows(run(df.repartition(1), a)) == rows(run(df.repartition(16), a))


def test_having_is_strict(spark):
    df = make(
        spark,
        dict(servidor="s1", uso_cpu_porcentaje=Decimal("70.00")),
        dict(servidor="s2", uso_cpu_porcentaje=Decimal("70.01")),
    )
    assert [r["servidor"] for r in q5_critical_servers(df).collect()] == ["s2"]


def test_status_class_edges(spark):
    codes = [199, 200, 299, 300, 399, 400, 499, 500, 599, 600, None]
    df = spark.createDataFrame([(c,) for c in codes], "c int")
    labels = [r[0] for r in df.select(status_class(F.col("c"))).collect()]
    assert labels == ["Otro"] + ["2xx OK"] * 2 + ["3xx Redireccion"] * 2 + ["4xx Cliente"] * 2 + [
        "5xx Servidor"
    ] * 2 + ["Otro"] * 2
    assert rows(q10_status_classes(make(spark, dict(codigo_estado=None)))) == [("Otro", 1)]


def test_rank_keeps_ties(spark):

    df = make(
        spark,
        *(dict(servidor=s, uso_cpu_porcentaje=Decimal(v)) for s, v in (("a", "9"), ("b", "9"), ("c", "1"))),
    )
    assert [(r["servidor"], r["ranking_cpu"]) for r in q8_server_cpu_ranking(df).collect()] == [
        ("a", 1),
        ("b", 1),
        ("c", 3),
    ]


def test_worst_service_breaks_ties_by_name_and_keeps_null_zone(spark):
    df = make(
        spark,
        dict(zona="z", servicio="b", nivel="ERROR"),
        dict(zona="z", servicio="a", nivel="CRITICAL"),
        dict(zona=None, servicio="c", nivel="ERROR"),
        dict(zona="z", servicio="c", nivel="INFO"),
    )
    assert rows(q9_worst_service_by_zone(df)) == rows(
        spark.createDataFrame([("z", "a", 1), (None, "c", 1)], "zona string, servicio string, errores bigint")
    )


def test_rounding(spark):
    df = spark.createDataFrame([(1.005,), (574.425,), (2.0,), (None,)], "x double")
    assert [r[0] for r in df.select(round_half_up(F.col("x"))).collect()] == [1.01, 574.43, 2.0, None]
    assert [r[0] for r in df.select(round_ties_up(F.col("x"))).collect()] == [1.0, 574.42, 2.0, None]


def test_clamp(spark):
    df = spark.createDataFrame([(-5,), (50,), (500,)], "x int")
    assert [r[0] for r in df.select(clamp(F.col("x"), 100)).collect()] == [0, 50, 100]
    assert [r[0] for r in df.select(clamp(F.col("x"))).collect()] == [0, 50, 500]


def test_crc32_split_covers_the_range(spark):
    import zlib

    keys = [f"log-{i}" for i in range(2000)]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = [r[0] for r in df.select(crc32_split(F.col("k"), 8)).collect()]
    assert got == [zlib.crc32(k.encode()) * 8 >> 32 for k in keys]
    assert set(got) == set(range(8))


@pytest.mark.parametrize("a", CSV_SUITE + JSON_SUITE, ids=lambda a: a.name)
def test_spec_equals_its_sql(spark, logs, a):
    """A specification rendered as SQL text gives the same rows."""

    def text(m):
        if m.column == "*":
            return f"count(*) AS {m.alias}"
        cast = f"cast({m.column} AS double)" if m.column.startswith(("uso", "temp")) else m.column
        call = f"{m.fn}({cast})"
        return f"round({call}, 2) AS {m.alias}" if m.fn in ("avg", "stddev") else f"{call} AS {m.alias}"

    keys = ", ".join(a.group_by)
    where = f"WHERE {a.where}" if a.where else ""
    sql = f"SELECT {keys}, {', '.join(map(text, a.aggs))} FROM logs {where} GROUP BY {keys}"
    register(logs)
    expected = rows(run_sql(spark, SqlAnalysis(a.name, sql)))
    got = rows(run(logs, a))
    assert len(got) == len(expected) > 0
    for x, y in zip(got, expected):
        # An exact tie may round either way when the engine adds doubles.
        assert all(p == q or abs(p - q) <= 0.0101 for p, q in zip(x, y))


@pytest.mark.parametrize("a", SQL_CATALOG, ids=lambda a: a.name)
def test_sql_catalogue_equals_dataframe_twin(spark, logs, a):
    register(logs)
    query, save = SQL_SUITE[a.name]
    assert a.save == save
    assert rows(run_sql(spark, a), "ordered") == rows(query(logs), "ordered")


def test_shared_scan_equals_separate_runs(spark, logs):
    analyses = CSV_SUITE + JSON_SUITE
    results, shared = run_shared(logs, analyses)
    try:
        # By servidor and by servicio; the other keys occur once.
        assert len(shared) == 2
        for a in analyses:
            assert results[a.name].columns == run(logs, a).columns
            assert rows(results[a.name], "ordered") == rows(run(logs, a), "ordered")
    finally:
        for df in shared:
            df.unpersist()
