import json
import uuid

import pytest
from conftest import numbered_events, plan, rows
from pyspark.sql import functions as F

from vigia.schema import EVENT_COLUMNS, META_COLUMNS
from vigia.sources import publish_rows, read_csv, read_events, read_jsonl, write_events
from vigia.streaming import queries as streams
from vigia.streaming import (
    IdIndex,
    RECORD_SCHEMA,
    ProgressLog,
    dead_letters,
    decode_records,
    distinct_events,
    drain_and_stop,
    file_records,
    first_arrivals_in_stream,
    keep_batches,
    progress_of,
    read_late,
    read_windows,
    start_copies,
    start_csv_copy,
    start_jsonl_copy,
    start_stream,
    start_table_ingest,
    start_windowed_counts,
    text_records,
    valid_events,
)

GOOD = {
    "id_log": "g",
    "timestamp_evento": "2026-06-17T10:11:12.345Z",
    "servidor": "server-01",
    "ip_servidor": "192.168.1.65",
    "servicio": "api-gateway",
    "tipo_evento": "request",
    "nivel": "INFO",
    "uso_cpu_porcentaje": 12.345,
    "ip_sospechosa": False,
}


def message(**changes):
    event = {**GOOD, **changes}
    return json.dumps({k: v for k, v in event.items() if v is not ...})


def records(spark, values, topic="logs_http"):
    data = [("server-01", v, topic, 0, i, None) for i, v in enumerate(values)]
    return spark.createDataFrame(data, RECORD_SCHEMA)


def put(spark, values, path, start=0, hour=10):
    """Append records as one file of the inbox."""
    df = records(spark, values).withColumns(
        {"offset": F.col("offset") + start, "timestamp": F.lit(f"2026-06-17 {hour}:00:00").cast("timestamp")}
    )
    df.coalesce(1).write.mode("append").json(path)


def drain(spark, base, **options):
    source = file_records(spark, f"{base}/inbox", max_files_per_trigger=options.pop("files", None))
    query = start_table_ingest(
        source, f"{base}/table", f"{base}/dead", options.pop("checkpoint", f"{base}/checkpoint"), None, **options
    )
    query.awaitTermination()
    return query


@pytest.mark.parametrize(
    "value, reason",
    [
        (message(), None),
        (message(extra=1), None),
        (message(zona=None), None),
        ("not json", "malformed"),
        ("5", "malformed"),
        ("null", "malformed"),
        ("[1]", "malformed"),
        (" ", "malformed"),
        ('{"id_log": "x"', "malformed"),
        (message(codigo_estado="abc"), "malformed"),
        (message(uso_cpu_porcentaje=12345.6), "malformed"),
        (message(nivel=...), "missing:nivel"),
        (message(timestamp_evento=None, id_log=...), "missing:id_log,timestamp_evento"),
        ("{}", "missing:id_log,timestamp_evento,servidor,ip_servidor,servicio,tipo_evento,nivel"),
    ],
)
def test_payloads(spark, value, reason):
    decoded = decode_records(records(spark, [value]))
    row = decoded.first()
    assert row._reason == reason and row._raw == value
    assert valid_events(decoded).count() == (reason is None)
    assert dead_letters(decoded).count() == (reason is not None)


def test_empty_payloads_are_skipped(spark):
    assert decode_records(records(spark, ["", None, message()])).count() == 1


def test_decoded_values(spark):
    row = valid_events(decode_records(records(spark, [message()]))).first()
    assert str(row.timestamp_evento) == "2026-06-17 10:11:12" and str(row.uso_cpu_porcentaje) == "12.35"
    assert (row._kafka_topic, row._kafka_partition, row._kafka_offset) == ("logs_http", 0, 0)
    assert row._consumer_ts is not None and row.zona is None


def test_published_messages_decode_to_the_same_events(spark):
    made = numbered_events(spark.range(200)).persist()
    sent = publish_rows(made).selectExpr(
        "key", "value", "topic", "0 partition", "0L offset", "current_timestamp() timestamp"
    )
    assert rows(valid_events(decode_records(sent)).select(EVENT_COLUMNS)) == rows(made)


def test_first_arrival_wins_within_and_across_batches(spark, tmp_path):
    base, inbox = str(tmp_path), f"{tmp_path}/inbox"
    put(spark, [message(id_log="a", mensaje="late")], inbox, start=9, hour=12)
    put(spark, [message(id_log="a", mensaje="first"), message(id_log="b"), "bad", ""], inbox, hour=10)
    drain(spark, base)
    put(spark, [message(id_log="b", mensaje="copy"), message(id_log="c"), "bad again"], inbox, start=20, hour=9)
    drain(spark, base)
    got = {r.id_log: r.mensaje for r in read_events(spark, f"{base}/table").collect()}
    assert got == {"a": "first", "b": None, "c": None}
    dead = spark.read.parquet(f"{base}/dead")
    assert sorted(r._raw for r in dead.collect()) == ["bad", "bad again"]
    assert set(META_COLUMNS) <= set(dead.columns)
    # One directory per query id and batch.
    (query_id,) = {r.query for r in dead.select("query").distinct().collect()}
    assert query_id == drain(spark, base).id


def test_restart_reads_nothing_and_lost_checkpoint_adds_nothing(spark, tmp_path):
    base, inbox = str(tmp_path), f"{tmp_path}/inbox"
    put(spark, [message(id_log=f"e{i}") for i in range(11)], inbox)
    drain(spark, base)
    assert sum(p["numInputRows"] for p in drain(spark, base).recentProgress) == 0
    again = drain(spark, base, checkpoint=f"{base}/new-checkpoint")
    assert sum(p["numInputRows"] for p in again.recentProgress) == 11
    assert read_events(spark, f"{base}/table").count() == 11


@pytest.mark.parametrize("same_date", [False, True])
def test_stream_equals_batch_over_several_batches(spark, tmp_path, same_date):
    """Batches of one file each, with copies, against one batch over everything."""
    base = str(tmp_path)
    made = numbered_events(spark.range(300), "INTERVAL 1 HOUR").persist()
    sent = publish_rows(made).select(
        "key", "value", "topic", F.lit(0).alias("partition"), F.lit(1).cast("bigint").alias("offset"),
        F.lit("2026-06-17 10:00:00").cast("timestamp").alias("timestamp"),
    )
    sent.unionAll(sent.where("value LIKE '%server-02%'")).repartition(4).write.json(f"{base}/inbox")
    query = drain(spark, base, files=1, same_date=same_date)
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 4
    assert rows(read_events(spark, f"{base}/table")) == rows(made)


def test_progress_totals(spark, tmp_path):
    progress, name = ProgressLog(), f"q{uuid.uuid4().hex}"
    spark.streams.addListener(progress)
    try:
        put(spark, [message(id_log=f"e{i}") for i in range(5)], f"{tmp_path}/inbox")
        drain(spark, str(tmp_path), name=name)
        for _ in range(50):
            if progress.totals.get(name):
                break
            import time

            time.sleep(0.1)
        assert progress.totals[name] == 5
    finally:
        spark.streams.removeListener(progress)


def test_file_copies_of_raw_lines_by_topic(spark, tmp_path):
    for topic, ids in (("logs_http", "ab"), ("topic=logs_errores", "c")):
        (tmp_path / "inbox" / topic).mkdir(parents=True)
        lines = [message(id_log=i, mensaje='x, "y"') for i in ids] + ["bad", ""]
        (tmp_path / "inbox" / topic / "f.txt").write_text("\n".join(lines))
    for start, name in ((start_csv_copy, "csv"), (start_jsonl_copy, "jsonl")):
        start(text_records(spark, f"{tmp_path}/inbox"), f"{tmp_path}/{name}", f"{tmp_path}/cp-{name}", None).awaitTermination()
    for read, name in ((read_csv, "csv"), (read_jsonl, "jsonl")):
        got = read(spark, f"{tmp_path}/{name}", keep_meta=True)
        assert rows(got.select("_kafka_topic", "id_log", "mensaje")) == [
            ("logs_errores", "c", 'x, "y"'),
            ("logs_http", "a", 'x, "y"'),
            ("logs_http", "b", 'x, "y"'),
        ]
        assert got.where("_consumer_ts IS NULL OR _kafka_timestamp IS NULL").count() == 0
    # Explicit nulls in the JSON copy.
    line = json.loads(spark.read.text(f"{tmp_path}/jsonl").first().value)
    assert len(line) == 42 and line["zona"] is None


def test_drain_and_stop_reports_rows(spark, tmp_path):
    put(spark, [message(id_log=f"e{i}") for i in range(5)], f"{tmp_path}/inbox")
    query = start_jsonl_copy(
        file_records(spark, f"{tmp_path}/inbox"), f"{tmp_path}/out", f"{tmp_path}/cp", "1 second", name="copia"
    )
    assert drain_and_stop(query) == {"copia": 5}
    assert not query.isActive and read_jsonl(spark, f"{tmp_path}/out").count() == 5


@pytest.mark.parametrize("horizon", [None, "1 day"])
def test_duplicates_dropped_inside_the_stream(spark, tmp_path, horizon):
    put(spark, [message(id_log=i) for i in "abab"], f"{tmp_path}/inbox")
    put(spark, [message(id_log=i) for i in "bc"], f"{tmp_path}/inbox", start=10)
    events = valid_events(decode_records(file_records(spark, f"{tmp_path}/inbox", max_files_per_trigger=1)))
    query = (
        distinct_events(events, horizon)
        .writeStream.format("parquet")
        .option("path", f"{tmp_path}/out")
        .option("checkpointLocation", f"{tmp_path}/cp")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert rows(spark.read.parquet(f"{tmp_path}/out").select("id_log")) == [("a",), ("b",), ("c",)]


def test_totals_count_batches_whose_progress_is_gone(spark, tmp_path):
    """Ten batches, of which the session keeps three."""
    for i in range(10):
        put(spark, [message(id_log=f"e{i}-{j}") for j in range(i + 1)], f"{tmp_path}/inbox")
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        records = file_records(spark, f"{tmp_path}/inbox", max_files_per_trigger=1)
        query = start_copies(records, f"{tmp_path}/cp", jsonl=f"{tmp_path}/out", interval="0 seconds", name=f"q{uuid.uuid4().hex}")
        assert drain_and_stop(query) == {query.name: 55}
        assert sum(p["numInputRows"] for p in query.recentProgress) < 55
        assert progress_of(spark).observed[query.name] == {"copiados": 55, "muertos": 0}
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)


def test_copies_keep_incomplete_events_and_dead_letters_the_rest(spark, tmp_path):
    values = [message(id_log="a"), message(id_log="b", servidor=...), "not json", "", message(id_log="c", nivel=None), "[1]"]
    put(spark, values, f"{tmp_path}/inbox")
    name = f"q{uuid.uuid4().hex}"
    paths = {k: f"{tmp_path}/{k}" for k in ("csv", "jsonl", "dead")}
    query = start_copies(file_records(spark, f"{tmp_path}/inbox"), f"{tmp_path}/cp", interval=None, name=name, **paths)
    query.awaitTermination()
    for read, kind in ((read_csv, "csv"), (read_jsonl, "jsonl")):
        assert rows(read(spark, paths[kind]).select("id_log", "servidor", "nivel")) == [
            ("a", "server-01", "INFO"),
            ("b", None, "INFO"),
            ("c", "server-01", None),
        ]
    assert rows(spark.read.parquet(paths["dead"]).select("_raw", "_reason")) == [("[1]", "malformed"), ("not json", "malformed")]
    progress = progress_of(spark)
    progress.wait_for(query)
    assert progress.observed[name] == {"copiados": 3, "muertos": 2}


def test_packed_copies_hold_the_same_rows_in_bounded_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(streams, "PACKED_ROWS", 2)
    put(spark, [message(id_log=i) for i in "abcde"] + ["bad"], f"{tmp_path}/inbox")
    paths = {k: f"{tmp_path}/{k}" for k in ("csv", "jsonl", "dead")}
    start_copies(file_records(spark, f"{tmp_path}/inbox"), f"{tmp_path}/cp", interval=None, compression="gzip", **paths).awaitTermination()
    for read, kind, end in ((read_csv, "csv", "csv.gz"), (read_jsonl, "jsonl", "json.gz")):
        assert [r[0] for r in rows(read(spark, paths[kind]).select("id_log"))] == list("abcde")
        files = [f for f in (tmp_path / kind).rglob("part-*")]
        assert len(files) >= 3 and all(f.name.endswith(end) for f in files)
    assert spark.read.parquet(paths["dead"]).count() == 1


@pytest.fixture
def held(spark, monkeypatch):
    """The tables cached beyond those before, at the times the copies' dead letters are taken."""
    seen, cached = [], spark.sparkContext._jsc.getPersistentRDDs
    before = cached().size()

    def letters(decoded):
        seen.append(cached().size() - before)
        return dead_letters(decoded)

    monkeypatch.setattr(streams, "dead_letters", letters)
    return seen


def test_three_sinks_hold_no_batch_and_copy_what_each_does_alone(spark, tmp_path, held):
    odd = [message(id_log="a", timestamp_evento="1500-02-28T01:02:03Z"), message(id_log="b", servidor=..., mensaje='x, "y"\nz'), "bad"]
    put(spark, odd, f"{tmp_path}/inbox")
    put(spark, [message(id_log="c", uso_cpu_porcentaje=None), ""], f"{tmp_path}/inbox", start=10)
    inbox = file_records(spark, f"{tmp_path}/inbox", max_files_per_trigger=1)
    paths = {k: f"{tmp_path}/{k}" for k in ("csv", "jsonl", "dead")}
    start_copies(inbox, f"{tmp_path}/cp", interval=None, **paths).awaitTermination()
    assert held == [0, 0]
    for start, read, kind in ((start_csv_copy, read_csv, "csv"), (start_jsonl_copy, read_jsonl, "jsonl")):
        start(inbox, f"{tmp_path}/alone-{kind}", f"{tmp_path}/cp-{kind}", None).awaitTermination()
        together, alone = (rows(read(spark, p, keep_meta=True).drop("_consumer_ts")) for p in (paths[kind], f"{tmp_path}/alone-{kind}"))
        assert together == alone and len(alone) == 3
    # Nothing stays of the staged batches.
    assert spark.read.parquet(f"{tmp_path}/cp/staged").count() == 0


def test_dead_letters_beside_one_copy_are_kept_whole_without_holding_the_batch(spark, tmp_path, held):
    bad = ['"' + "ñ," * 50_000, "[1]", '{"id_log": "x"', message(codigo_estado="abc")]
    put(spark, [message(id_log="a"), *bad, message(id_log="b", nivel=...), ""], f"{tmp_path}/inbox")
    inbox = file_records(spark, f"{tmp_path}/inbox")
    start_csv_copy(inbox, f"{tmp_path}/csv", f"{tmp_path}/cp", None, dead=f"{tmp_path}/dead").awaitTermination()
    assert held == [0]
    letters = spark.read.parquet(f"{tmp_path}/dead")
    assert letters.drop("query", "batch").columns == [*META_COLUMNS, "_raw", "_reason"]
    assert rows(letters.select("_raw", "_kafka_topic", "_kafka_offset", "_reason")) == sorted(
        ((text, "logs_http", i + 1, "malformed") for i, text in enumerate(bad)), key=repr
    )
    assert rows(read_csv(spark, f"{tmp_path}/csv").select("id_log")) == [("a",), ("b",)]


def test_a_replayed_batch_copies_nothing_twice(spark, tmp_path):
    """The commit of the batch is lost, as if the driver had died after writing: it runs again."""
    put(spark, [message(id_log=i) for i in "abc"] + ["bad"], f"{tmp_path}/inbox")

    def drain_copies():
        start_copies(
            file_records(spark, f"{tmp_path}/inbox"), f"{tmp_path}/cp", f"{tmp_path}/csv", f"{tmp_path}/jsonl", f"{tmp_path}/dead", None
        ).awaitTermination()

    drain_copies()
    for commit in (tmp_path / "cp" / "commits").iterdir():
        commit.unlink()
    drain_copies()
    assert read_csv(spark, f"{tmp_path}/csv").count() == read_jsonl(spark, f"{tmp_path}/jsonl").count() == 3
    assert spark.read.parquet(f"{tmp_path}/dead").count() == 1


def windowed(spark, base):
    events = valid_events(decode_records(file_records(spark, f"{base}/inbox")))
    queries = start_windowed_counts(events, f"{base}/out", f"{base}/cp", interval=None, name=f"w{uuid.uuid4().hex}")
    for query in queries:
        query.awaitTermination()
    return queries


def test_windows_close_after_the_delay_and_late_rows_are_counted_apart(spark, tmp_path):
    def at(minute, **changes):
        return message(id_log=uuid.uuid4().hex, timestamp_evento=f"2026-06-17T10:{minute:02}:30Z", **changes)

    put(spark, [at(1), at(1, nivel="ERROR"), at(30), at(21, servicio="db")], f"{tmp_path}/inbox")
    windowed(spark, tmp_path)
    # The mark is now 10:20:30: windows that end at 10:20 or before are closed.
    put(spark, [at(2, nivel="CRITICAL"), at(19), at(20), at(31), at(14, servicio="db")], f"{tmp_path}/inbox", start=9)
    counted, _ = windowed(spark, tmp_path)
    windows = [(r.servicio, f"{r.inicio:%H:%M}", r.eventos, r.errores) for r in read_windows(spark, f"{tmp_path}/out").collect()]
    assert sorted(windows) == [
        ("api-gateway", "10:00", 2, 1),
        ("api-gateway", "10:20", 1, 0),
        ("api-gateway", "10:30", 2, 0),
        ("db", "10:20", 1, 0),
    ]
    assert rows(read_late(spark, f"{tmp_path}/out")) == [("api-gateway", 2, 1), ("db", 1, 0)]
    # Closed windows leave the state: the mark is 10:21:30, and three windows end later.
    states = [p["stateOperators"][0]["numRowsTotal"] for p in counted.recentProgress if p["stateOperators"]]
    assert states[-1] == 3


def test_windows_survive_a_replay_and_an_empty_stream(spark, tmp_path):
    (tmp_path / "inbox").mkdir()
    put(spark, [message(id_log="a"), message(id_log="b", nivel="ERROR"), "bad"], f"{tmp_path}/inbox")
    windowed(spark, tmp_path)
    before = rows(read_windows(spark, f"{tmp_path}/out"))
    for part in ("ventanas", "totales"):
        for commit in (tmp_path / "cp" / part / "commits").iterdir():
            commit.unlink()
    windowed(spark, tmp_path)
    assert rows(read_windows(spark, f"{tmp_path}/out")) == before and len(before) == 1 and before[0][2:] == (2, 1)
    assert rows(read_late(spark, f"{tmp_path}/out")) == []


def ids(spark, names):
    return spark.createDataFrame([(n,) for n in names], "id_log string")


def test_only_the_new_side_of_an_indexed_lookup_is_shuffled(spark, tmp_path):
    index = IdIndex(f"{tmp_path}/ids", buckets=16)
    index.add(ids(spark, [f"e{i}" for i in range(3000)]), "a")
    index.add(ids(spark, [f"f{i}" for i in range(3000)]), "b")
    absent = index.absent(ids(spark, ["e1", "f2", "g3", None]))
    assert rows(absent) == [("g3",), (None,)]
    text = plan(absent).split("== Initial Plan ==")[-1]
    assert text.count("Exchange hashpartitioning(id_log") == 1 and "SelectedBucketsCount: 16 out of 16" in text
    stored = text[text.index("FileScan") - 400 :]
    assert "Exchange" not in stored
    # One file a bucket and batch, then one a bucket.
    assert len(list((tmp_path / "ids").glob("*.parquet"))) == 32
    small = index.compacted(spark, f"{tmp_path}/small")
    assert len(list((tmp_path / "small").glob("*.parquet"))) == 16 and small.ids(spark).count() == 6000


def test_another_session_reads_the_same_buckets(spark, tmp_path):
    index = IdIndex(f"{tmp_path}/ids", buckets=4)
    index.add(ids(spark, ["a", "b"]), "x")
    spark.sql(f"DROP TABLE {index.table}")  # the catalog of a new session knows nothing of it
    assert rows(index.absent(ids(spark, ["a", "c"]))) == [("c",)]
    assert index.has(spark, "x") and not index.has(spark, "y")


@pytest.mark.parametrize("lost", ["index", "table", "both"])
def test_indexed_ingest_ends_right_wherever_a_batch_was_cut(spark, tmp_path, lost):
    """The second batch is run again with its index entries, its rows, or both already there."""
    base, index = str(tmp_path), IdIndex(f"{tmp_path}/ids", buckets=4)
    put(spark, [message(id_log=i) for i in "abc"], f"{base}/inbox")
    drain(spark, base, index=index)
    put(spark, [message(id_log=i) for i in "cde"], f"{base}/inbox", start=9)
    if lost != "both":
        drain(spark, base, index=index)
        commits = tmp_path / "checkpoint" / "commits"
        last = max(int(p.name) for p in commits.glob("[0-9]*"))
        for name in (f"{last}", f".{last}.crc"):
            (commits / name).unlink()
        if lost == "table":  # only the ids had been added
            kept = spark.createDataFrame(read_events(spark, f"{base}/table").where("id_log IN ('a', 'b', 'c')").collect(), read_events(spark, f"{base}/table").schema)
            write_events(kept, f"{base}/table", "overwrite")
    drain(spark, base, index=index)
    assert rows(read_events(spark, f"{base}/table").select("id_log")) == [(i,) for i in "abcde"]
    put(spark, [message(id_log=i, timestamp_evento="2020-01-01T00:00:00Z") for i in "aef"], f"{base}/inbox", start=20)
    drain(spark, base, index=index)
    assert rows(read_events(spark, f"{base}/table").select("id_log")) == [(i,) for i in "abcdef"]


def test_first_arrival_by_broker_order_whatever_comes_first(spark, tmp_path):
    base = str(tmp_path)

    def drain_first():
        events = valid_events(decode_records(file_records(spark, f"{base}/inbox", max_files_per_trigger=1)))
        first = first_arrivals_in_stream(events, "1 hour", "30 minutes")
        query = start_stream(first, f"d{uuid.uuid4().hex}", f"{base}/cp", None, lambda w: w.foreachBatch(keep_batches(f"{base}/out")))
        query.awaitTermination()
        rows_held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
        return rows_held[-1]

    def at(time, **changes):
        return message(timestamp_evento=f"2026-06-17T{time}:00Z", **changes)

    put(spark, [at("10:10", id_log="a", mensaje="copy"), at("10:20", id_log="b", mensaje="first")], f"{base}/inbox", hour=14)
    assert drain_first() == 2
    # The original was sent before, and is read later; the span is still open.
    put(spark, [at("10:10", id_log="a", mensaje="first"), at("10:40", id_log="c", mensaje="first")], f"{base}/inbox", hour=12)
    put(spark, [at("10:20", id_log="b", mensaje="copy")], f"{base}/inbox", start=50, hour=15)
    assert drain_first() == 3
    assert [p for p in (tmp_path / "out").rglob("*.parquet") if spark.read.parquet(str(p)).count()] == []
    # An event of the afternoon closes the morning: its rows come out and leave the state.
    put(spark, [at("16:00", id_log="z", mensaje="first")], f"{base}/inbox", hour=16)
    assert drain_first() == 1
    # Copies of a closed span are dropped.
    put(spark, [at("10:10", id_log="a", mensaje="late"), at("10:50", id_log="new", mensaje="late")], f"{base}/inbox", start=9, hour=9)
    assert drain_first() == 1
    got = spark.read.parquet(f"{base}/out").drop("query", "batch")
    assert rows(got.select("id_log", "mensaje")) == [("a", "first"), ("b", "first"), ("c", "first")]
    assert set(EVENT_COLUMNS + META_COLUMNS) == set(got.columns)
