import datetime as dt

import pytest
from conftest import numbered_events, rows

from vigia.operators import dependency_report
from vigia.schema import EVENT_COLUMNS, EVENT_SCHEMA
from vigia.sources import csv_headers, materialise, read_csv, read_csv_rejects, write_csv


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, newline="")


def test_columns_are_found_by_name(spark, tmp_path):
    put(tmp_path / "a.csv", "nivel,servidor,id_log,timestamp_evento\nERROR,server-01,x,2026-06-17T10:11:12.345Z\n")
    put(tmp_path / "b.csv", 'servidor,extra,nivel,"id_log",mensaje\r\nserver-02,?,INFO,y,"a, ""b""\nc"\r\n')
    df = read_csv(spark, str(tmp_path))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in EVENT_SCHEMA]
    assert rows(df.select("id_log", "servidor", "nivel", "mensaje", "timestamp_evento")) == [
        ("x", "server-01", "ERROR", None, dt.datetime(2026, 6, 17, 10, 11, 12)),
        ("y", "server-02", "INFO", 'a, "b"\nc', None),
    ]
    assert read_csv_rejects(spark, str(tmp_path)).count() == 0
    assert csv_headers(spark, str(tmp_path)).count() == 2


def test_swapped_headers_give_the_same_table(spark, tmp_path):
    events = numbered_events(spark.range(30), with_meta=True).persist()
    write_csv(events, f"{tmp_path}/same")
    from vigia.sources.sinks import CSV_OPTIONS, with_all_columns

    stored = with_all_columns(events)
    stored.select(*reversed(stored.columns)).write.options(**CSV_OPTIONS).csv(f"{tmp_path}/other")
    one, other = (read_csv(spark, f"{tmp_path}/{p}", keep_meta=True) for p in ("same", "other"))
    assert one.columns == other.columns and rows(one) == rows(other) and rows(one.select(EVENT_COLUMNS)) == rows(events.select(EVENT_COLUMNS))
    events.unpersist()


@pytest.mark.parametrize("multi_line", [True, False])
def test_cells_and_rows_that_do_not_fit_are_rejects(spark, tmp_path, multi_line):
    put(tmp_path / "x y.csv", "id_log,servidor,codigo_estado,bytes_entrada\na,s,200,5\nb,s,abc,5\nc,s,1,1.x\nd,s,7\ne,s,7,8,9\nf,s,,\n")
    got = {r.id_log: (r.codigo_estado, r.bytes_entrada) for r in read_csv(spark, str(tmp_path), multi_line=multi_line).collect()}
    assert got == {"a": (200, 5), "b": (None, 5), "c": (1, None), "d": (7, None), "e": (7, 8), "f": (None, None)}
    rejects = {r._celdas or ("width" if r._ancho else ""): r._fila for r in read_csv_rejects(spark, str(tmp_path), multi_line).collect()}
    assert set(rejects) == {"codigo_estado", "bytes_entrada", "width"} and '"b"' in rejects["codigo_estado"]
    assert read_csv_rejects(spark, str(tmp_path), multi_line).where("_ancho").count() == 2


def test_files_without_a_header_or_rows(spark, tmp_path):
    put(tmp_path / "bare.csv", "x,server-01,INFO\ny,server-02,INFO\n")
    put(tmp_path / "empty.csv", "")
    put(tmp_path / "head.csv", "id_log,servidor,nivel\n")
    assert read_csv(spark, str(tmp_path)).count() == 0
    rejects = read_csv_rejects(spark, str(tmp_path)).collect()
    assert [r._archivo.rsplit("/")[-1] for r in rejects] == ["bare.csv"] and rejects[0]._fila is None


def test_a_name_that_comes_twice_is_read_once(spark, tmp_path):
    put(tmp_path / "a.csv", "id_log,nivel,servidor,nivel\nx,INFO,s,ERROR\n")
    assert rows(read_csv(spark, str(tmp_path)).select("id_log", "nivel")) == [("x", "INFO")]


def test_staging_counts_while_it_writes(spark, logs, tmp_path):
    kept, n = materialise(logs, ["zona", "nivel"], f"{tmp_path}/s")
    assert n == 1000 == kept.count() and kept.columns == ["zona", "nivel"]
    assert materialise(logs.where("false"), ["zona"], f"{tmp_path}/none")[1] == 0


def test_dependencies_name_a_witness(spark):
    data = [("a", "1", 5), ("a", "1", None), ("b", "2", 5), ("b", "3", 5), ("b", None, 6), ("c", None, None), (None, "9", 1)]
    df = spark.createDataFrame([r for r in data for _ in range(50)], "k string, v string, w int")
    assert rows(dependency_report(df, [("k", "v"), ("k", "w"), ("v", "k")])) == [
        ("k -> v", 3, 1, 100, 100, "b", "2", "3"),
        ("k -> w", 3, 1, 150, 100, "b", "5", "6"),
        ("v -> k", 4, 0, 0, 50, None, None, None),
    ]
    assert rows(dependency_report(df.where("false"), [("k", "v")])) == [("k -> v", 0, 0, 0, 0, None, None, None)]
