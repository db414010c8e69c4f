import datetime as dt
from decimal import Decimal

import pytest
from conftest import numbered_events, plan, rows
from pyspark.sql import functions as F

from vigia.schema import EVENT_COLUMNS, EVENT_SCHEMA, META_COLUMNS, conform, create_event_table
from vigia.sources import (
    JdbcTable,
    export_csv,
    materialise,
    publish_rows,
    read_csv,
    read_events,
    read_jsonl,
    write_csv,
    write_events,
    write_jsonl,
)
from vigia.sources.jdbc import for_database


@pytest.fixture(scope="module")
def events(spark):
    """Events with text that needs quoting."""
    made = numbered_events(spark.range(40), with_meta=True)
    hard = F.element_at(
        F.array(*map(F.lit, ['a,b', 'say "hi"', 'two\nlines', 'é ñ', ' pad '])), (F.col("_kafka_offset") % 5 + 1).cast("int")
    )
    return made.withColumn("mensaje", hard).persist()


def test_all_formats_give_the_same_table(spark, events, tmp_path):
    write_csv(events, f"{tmp_path}/csv")
    write_jsonl(events, f"{tmp_path}/jsonl")
    write_events(events, f"{tmp_path}/table")
    expected = rows(events.select(EVENT_COLUMNS))
    for df in (
        read_csv(spark, f"{tmp_path}/csv"),
        read_jsonl(spark, f"{tmp_path}/jsonl"),
        read_events(spark, f"{tmp_path}/table"),
    ):
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in EVENT_SCHEMA]
        assert rows(df) == expected


def test_bookkeeping_survives_and_is_dropped_by_default(spark, events, tmp_path):
    write_csv(events, f"{tmp_path}/csv")
    write_jsonl(events, f"{tmp_path}/jsonl")
    expected = rows(events.select("id_log", *META_COLUMNS))
    for read, name in ((read_csv, "csv"), (read_jsonl, "jsonl")):
        assert read(spark, f"{tmp_path}/{name}").columns == EVENT_COLUMNS
        assert rows(read(spark, f"{tmp_path}/{name}", keep_meta=True).select("id_log", *META_COLUMNS)) == expected


HEADER = ",".join(EVENT_COLUMNS + META_COLUMNS)


def csv_line(**values):
    return ",".join(str(values.get(c, "")) for c in EVENT_COLUMNS + META_COLUMNS)


def test_csv_quoting_and_empty_cells(spark, tmp_path):
    line = csv_line(id_log="x", timestamp_evento="2026-06-17T10:11:12.345Z", user_agent='"M, ""v"""', mensaje='"a\nb"')
    (tmp_path / "e.csv").write_text(f"{HEADER}\n{line}\n", newline="")
    row = read_csv(spark, f"{tmp_path}/e.csv").first()
    assert (row.user_agent, row.mensaje, row.ciudad, row.codigo_estado) == ('M, "v"', "a\nb", None, None)
    assert row.timestamp_evento == dt.datetime(2026, 6, 17, 10, 11, 12)


def test_csv_without_bookkeeping_columns(spark, tmp_path):
    cells = ["x", "2026-06-17T10:11:12Z"] + [""] * (len(EVENT_COLUMNS) - 3) + ["fin"]
    (tmp_path / "e.csv").write_text(",".join(EVENT_COLUMNS) + "\n" + ",".join(cells) + "\n")
    row = read_csv(spark, f"{tmp_path}/e.csv", keep_meta=True).first()
    assert (row.id_log, row.mensaje, row._kafka_offset) == ("x", "fin", None)


def test_jsonl_bookkeeping_as_text_or_number(spark, tmp_path):
    lines = [
        '{"id_log":"a","_kafka_offset":"7","_kafka_timestamp":"1750155072345","_kafka_partition":1}',
        '{"id_log":"b","_kafka_offset":8,"_kafka_timestamp":1750155072345,"_kafka_partition":2,"extra":[1]}',
    ]
    (tmp_path / "e.jsonl").write_text("\n".join(lines))
    got = read_jsonl(spark, f"{tmp_path}/e.jsonl", keep_meta=True)
    assert rows(got.select("id_log", "_kafka_offset", "_kafka_partition")) == [("a", 7, 1), ("b", 8, 2)]
    assert got.select("_kafka_timestamp").distinct().count() == 1


def test_jsonl_bad_lines_do_not_take_neighbours(spark, tmp_path):
    (tmp_path / "e.jsonl").write_text('{"id_log":"a"}\nnot json\n{"id_log":"b","codigo_estado":"x"}\n{"id_log":"c"}\n')
    assert sorted(r.id_log for r in read_jsonl(spark, f"{tmp_path}/e.jsonl").collect()) == ["a", "c"]
    whole = read_jsonl(spark, f"{tmp_path}/e.jsonl", keep_corrupt=True)
    assert sorted(r._corrupt for r in whole.where("_corrupt IS NOT NULL").collect()) == [
        "not json",
        '{"id_log":"b","codigo_estado":"x"}',
    ]


def test_jsonl_bad_lines_count_the_same_whatever_is_selected(spark, tmp_path):
    (tmp_path / "e.jsonl").write_text('{"id_log":"a"}\n\nnot json\n{"id_log":"b","codigo_estado":"x"}\n{}\n')
    df = read_jsonl(spark, f"{tmp_path}/e.jsonl")
    assert df.count() == len(df.select("id_log").collect()) == len(df.collect()) == 2


def test_inferred_reads_drop_bookkeeping(spark, events, tmp_path):
    write_csv(events, f"{tmp_path}/csv")
    write_jsonl(events, f"{tmp_path}/jsonl")
    assert set(read_csv(spark, f"{tmp_path}/csv", infer=True).columns) == set(EVENT_COLUMNS)
    inferred = read_jsonl(spark, f"{tmp_path}/jsonl", infer=True)
    assert set(inferred.columns) == set(EVENT_COLUMNS)
    # Inferred types differ; conforming them gives the canonical table back.
    assert rows(conform(inferred)) == rows(events.select(EVENT_COLUMNS))


def test_date_bounds_and_filters_reach_the_scan(spark, tmp_path):
    write_events(numbered_events(spark.range(500), "INTERVAL 1 HOUR"), f"{tmp_path}/t")
    df = read_events(spark, f"{tmp_path}/t", "2026-01-03", "2026-01-05")
    assert df.count() == 48
    text = plan(df.where("nivel = 'ERROR'").groupBy("servidor").count())
    scan = [line for line in text.splitlines() if "FileScan" in line][0]
    assert "fecha" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "EqualTo(nivel,ERROR)" in scan
    assert "ReadSchema: struct<servidor:string,nivel:string>" in text


def test_table_definition(spark, tmp_path):
    create_event_table(spark, "eventos_prueba", f"{tmp_path}/tabla")
    try:
        table = spark.table("eventos_prueba")
        assert table.columns == EVENT_COLUMNS + ["fecha"]
        write_events(numbered_events(spark.range(10)), f"{tmp_path}/tabla")
        spark.sql("MSCK REPAIR TABLE eventos_prueba")
        assert spark.table("eventos_prueba").count() == 10
    finally:
        spark.sql("DROP TABLE eventos_prueba")


def test_conform_fills_missing_and_drops_unknown(spark):
    df = spark.sql("SELECT 'x' id_log, timestamp'2026-01-01 00:00:00.9' timestamp_evento, 12.345D uso_cpu_porcentaje, 1 extra")
    row = conform(df).first()
    assert row.asDict().keys() == set(EVENT_COLUMNS)
    assert row.uso_cpu_porcentaje == Decimal("12.35") and row.timestamp_evento.microsecond == 0
    assert row.zona is None


def test_messages_are_routed_and_keyed(spark, events):
    sent = publish_rows(events)
    assert sent.columns == ["topic", "key", "value"]
    pairs = {(r.topic, r.tipo_evento) for r in sent.selectExpr("topic", "get_json_object(value, '$.tipo_evento') tipo_evento").collect()}
    assert pairs == {
        ("metricas_recursos", "resource"),
        ("logs_http", "request"),
        ("logs_errores", "error"),
        ("metricas_red", "network"),
        ("logs_seguridad", "security"),
    }
    # Explicit nulls, all 37 keys.
    keys = sent.selectExpr("json_object_keys(value) k").first().k
    assert keys == EVENT_COLUMNS


def test_database_options_split_the_scan_and_hide_the_password():
    source = JdbcTable("jdbc:mysql://h/d", driver="d", user="u", password="secret", partitions=4)
    options = source.scan_options()
    assert options["partitionColumn"] == "pcol" and options["numPartitions"] == "4"
    assert (options["lowerBound"], options["upperBound"]) == ("0", "4294967295")
    assert options["fetchsize"] == "5000" and "CRC32(id_log) AS pcol" in options["dbtable"]
    assert source.append_options()["batchsize"] == "500"
    assert "secret" not in repr(source)
    whole = JdbcTable("jdbc:x", table="t", split=None).scan_options()
    assert whole["dbtable"] == "t" and "partitionColumn" not in whole


def test_database_settings_have_no_default_credentials(monkeypatch):
    for name in ("MYSQL_USER", "MYSQL_PASSWORD"):
        monkeypatch.delenv(name, raising=False)
    monkeypatch.setenv("MYSQL_HOST", "db")
    source = JdbcTable.from_env(table="t")
    assert source.user is None and source.password is None
    assert source.url.startswith("jdbc:mysql://db:3306/") and source.table == "t"


def test_booleans_become_numbers_for_the_database(spark, events):
    assert dict(for_database(events).dtypes)["ip_sospechosa"] == "int"
    assert for_database(events).columns == EVENT_COLUMNS


def test_materialise_and_export(spark, events, tmp_path):
    cached, count = materialise(events, ["nivel"])
    assert count == 40 and cached.columns == ["nivel"] and cached.is_cached
    cached.unpersist()
    for _ in range(2):
        export_csv(events.groupBy("tipo_evento").count(), f"{tmp_path}/deep/out.csv")
    files = list((tmp_path / "deep/out.csv").glob("*.csv"))
    assert len(files) == 1 and files[0].read_text().splitlines()[0] == "tipo_evento,count"
