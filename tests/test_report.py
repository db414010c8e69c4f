import csv

from conftest import rows

from vigia import __main__ as cli
from vigia.operators import Analysis
from vigia.plans import BENCHMARK, SUITES, SqlAnalysis, Timing, run_report, run_workload, save_timing, speed_up
from vigia.plans.report import columns_used
from vigia.sources import materialise, read_csv, read_jsonl, sinks, write_events


def saved_rows(path):
    (file,) = path.glob("*.csv")
    with file.open(newline="") as f:
        return list(csv.reader(f))


def test_suites_cover_the_named_analyses():
    assert {name: len(s) for name, s in SUITES.items()} == {"json": 6, "csv": 5, "sql": 11}
    assert len(BENCHMARK) == 4


def test_report_shows_and_saves_each_result_once(spark, logs, tmp_path):
    shown = []
    report = run_report(logs, SUITES["csv"], str(tmp_path), "csv", cache=True, show=shown.append)
    assert report.rows == 1000 and report.seconds > 0 and len(shown) == 5
    assert sorted(p.name for p in (tmp_path / "resultado_csv").iterdir()) == [
        "errores_por_servidor.csv",
        "respuesta_por_servicio.csv",
    ]
    lines = saved_rows(tmp_path / "resultado_csv/errores_por_servidor.csv")
    assert lines[0] == ["servidor", "errores_min_avg", "errores_total"] and len(lines) == 6


def test_report_runs_user_sql(spark, logs, tmp_path):
    mine = SqlAnalysis.from_dict({"nombre": "n", "sql": "SELECT count(*) AS n FROM logs", "guardar": "cuenta"})
    report = run_report(logs, [mine], str(tmp_path), "sql", show=None)
    assert report.rows is None
    assert saved_rows(tmp_path / "resultado_sql/cuenta.csv") == [["n"], ["1000"]]


def test_benchmark_table_and_speed_up(spark, logs, tmp_path):
    timing = run_workload(logs, "local_n")
    assert timing.registros == 1000 and timing.tiempo_segundos > 0
    for t in (Timing("local_1", 8.0, 10), Timing("local_1", 6.0, 10), Timing("local_n", 2.0, 10)):
        save_timing(spark, t, f"{tmp_path}/comparacion.csv")
    assert rows(speed_up(spark, f"{tmp_path}/comparacion.csv", "local_1"), "ordered") == [
        ("local_1", 6.0, 10, 1.0),
        ("local_n", 2.0, 10, 3.0),
    ]


class Args:
    def __init__(self, **values):
        self.input = self.json = self.csv = None
        self.mode, self.staging = "local_n", None
        self.__dict__.update(values)


def test_jobs_by_name(spark, logs, tmp_path, capsys):
    write_events(logs, f"{tmp_path}/eventos")
    cli.run_job(spark, "copias", Args(input=f"{tmp_path}/eventos", output=str(tmp_path)))
    for read, name in ((read_jsonl, "jsonl"), (read_csv, "csv")):
        assert read(spark, f"{tmp_path}/eventos.{name}").count() == 1000
    args = Args(
        json=f"{tmp_path}/eventos.jsonl",
        csv=f"{tmp_path}/eventos.csv",
        input=f"{tmp_path}/eventos",
        output=f"{tmp_path}/out",
    )
    for job in ("json", "csv", "sql", "comparacion"):
        cli.run_job(spark, job, args)
    out = tmp_path / "out"
    assert len(list((out / "resultado_json").iterdir())) == 2
    assert len(list((out / "resultado_csv").iterdir())) == 2
    assert len(list((out / "resultado_sql").iterdir())) == 6
    assert saved_rows(out / "resultado_comparacion/comparacion.csv")[0] == ["modo", "tiempo_segundos", "registros"]
    assert "json: " in capsys.readouterr().out


def test_staged_source_gives_the_same_report(spark, logs, tmp_path):
    plain = run_report(logs, SUITES["json"], f"{tmp_path}/a", "json", show=None)
    staged = run_report(
        logs, SUITES["json"], f"{tmp_path}/b", "json", staging=f"{tmp_path}/staging", show=None
    )
    assert staged.rows == 1000
    for name, path in plain.saved.items():
        assert saved_rows(tmp_path / "b/resultado_json" / path.rsplit("/")[-1]) == saved_rows(
            tmp_path / "a/resultado_json" / path.rsplit("/")[-1]
        ), name


def test_only_used_columns_are_kept(spark, logs):
    spec = Analysis("a", (("avg", "uso_cpu_porcentaje", "m"),), ("zona",), where="NIVEL = 'ERROR'")
    assert columns_used(logs, [spec]) == ["zona", "nivel", "uso_cpu_porcentaje"]
    sql = SqlAnalysis("s", "SELECT count(*) n, 100.0 * max(latencia_red_ms) x FROM logs")
    assert columns_used(logs, [sql]) == ["latencia_red_ms"]
    for star in (
        "SELECT * FROM logs",
        "SELECT DISTINCT * FROM logs",
        "SELECT l.* FROM logs l",
        "SELECT zona, to_json(struct(*)) j FROM logs",
        "FROM logs |> WHERE nivel = 'ERROR'",
    ):
        assert columns_used(logs, [SqlAnalysis("s", star)]) == logs.columns, star
    kept, count = materialise(logs, ["zona"])
    assert (kept.columns, count) == (["zona"], 1000)
    kept.unpersist()


def test_large_results_keep_their_partitions(spark, tmp_path, monkeypatch):
    sinks.export_csv(spark.range(0, 20, 1, 4), f"{tmp_path}/big.csv", single_file=False)
    sinks.export_csv(spark.range(0, 5, 1, 4), f"{tmp_path}/small.csv")
    assert len(list((tmp_path / "big.csv").glob("*.csv"))) == 4
    assert len(list((tmp_path / "small.csv").glob("*.csv"))) == 1
