"""The running streams: file copies, the event table, the database."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from weakref import WeakKeyDictionary

from pyspark import SparkContext, StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from ..operators.joins import insert_if_absent
from ..sources.files import TABLE_SCHEMA
from ..sources.jdbc import JdbcTable, append_jdbc, read_jdbc_keys
from ..sources.sinks import CSV_OPTIONS, JSON_OPTIONS, with_all_columns, write_events
from .index import IdIndex
from .ingest import MALFORMED, RAW, REASON, dead_letters, decodable_events, decode_records, first_arrivals, valid_events

log = logging.getLogger(__name__)

FLUSH_INTERVAL = "2 seconds"
# Most rows of a compressed file, which cannot be split.
PACKED_ROWS = 250_000
# Bytes that a task gathers before it writes them to a staged file.
STAGED_ROW_GROUP = 32 << 20


class ProgressLog(StreamingQueryListener):
    """Logs rows per micro-batch and keeps running totals, by query name and by run.

    Totals grow with every batch that is reported, whatever the session keeps of
    its progress.  ``observed`` adds up the metrics that a stream observes.
    """

    def __init__(self) -> None:
        self.totals: dict[str, int] = {}
        self.by_run: dict[str, int] = {}
        self.observed: dict[str, dict[str, int]] = {}
        self.last_batch: dict[str, int] = {}
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        log.info("started %s", event.name or event.id)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        name, run = p.name or str(p.id), str(p.runId)
        self.totals[name] = self.totals.get(name, 0) + p.numInputRows
        self.by_run[run] = self.by_run.get(run, 0) + p.numInputRows
        for row in (p.observedMetrics or {}).values():
            own = self.observed.setdefault(name, {})
            for metric, value in row.asDict().items():
                own[metric] = own.get(metric, 0) + (value or 0)
        self.last_batch[run] = p.batchId
        log.info("%s: batch %d, %d rows, %d in total", name, p.batchId, p.numInputRows, self.totals[name])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        log.info("stopped %s", event.id)
        self.ended.add(str(event.runId))

    def wait_for(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until all batches of a stopped query have been reported; events of a run arrive in order."""
        until = time.monotonic() + seconds
        while str(query.runId) not in self.ended:
            if time.monotonic() > until:
                raise TimeoutError(f"no end of {query.name or query.id} reported")
            time.sleep(0.02)


_progress: WeakKeyDictionary[SparkContext, ProgressLog] = WeakKeyDictionary()


def progress_of(spark: SparkSession) -> ProgressLog:
    """The log of all streams that this package starts in the session."""
    context = spark.sparkContext
    if context not in _progress:
        _progress[context] = ProgressLog()
        spark.streams.addListener(_progress[context])
    return _progress[context]


def drain_and_stop(*queries: StreamingQuery) -> dict[str, int]:
    """Process what has arrived, stop, and report the rows each query read since it was started.

    For streams that this package started: the numbers come from its listener.
    """
    read = {}
    for query in queries:
        query.processAllAvailable()
        query.stop()
        progress = _progress[SparkSession.active().sparkContext]
        progress.wait_for(query)
        read[query.name or query.id] = progress.by_run.get(str(query.runId), 0)
    return read


def _triggered(writer: DataStreamWriter, interval: str | None) -> DataStreamWriter:
    """``interval`` None drains what is there and stops."""
    return writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)


def start_stream(df: DataFrame, name: str, checkpoint: str, interval: str | None, configure) -> StreamingQuery:
    """Start ``df`` as a named stream whose totals the session's progress log keeps."""
    progress_of(df.sparkSession)
    writer = df.writeStream.queryName(name).option("checkpointLocation", checkpoint)
    return _triggered(configure(writer), interval).start()


def batch_directory(batch: DataFrame, path: str, batch_id: int) -> str:
    """Where a batch keeps its rows, the same for a replay.

    The query id changes only with a new checkpoint, whose batch numbers start again.
    """
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{path}/query={query}/batch={batch_id}"


def keep_batches(path: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch body that keeps each batch as Parquet in its own directory."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(batch_directory(batch, path, batch_id))

    return handle


def _staged(decoded: DataFrame, path: str) -> DataFrame:
    """``decoded`` by way of Parquet at ``path``, overwritten by the next batch; the raw text of malformed messages only.

    Caching it runs small executors out of heap while the column batches of a large batch
    are built and serialised; a task that writes Parquet holds one row group.
    """
    lean = decoded.withColumn(RAW, F.when(F.col(REASON) == MALFORMED, F.col(RAW)))
    lean.write.mode("overwrite").option("parquet.block.size", STAGED_ROW_GROUP).parquet(path)
    return decoded.sparkSession.read.schema(lean.schema).parquet(path)


def start_copies(
    records: DataFrame,
    checkpoint: str,
    csv: str | None = None,
    jsonl: str | None = None,
    dead: str | None = None,
    interval: str | None = FLUSH_INTERVAL,
    name: str = "copias",
    compression: str | None = None,
) -> StreamingQuery:
    """Decode once; copy every decodable event, with bookkeeping, to CSV and JSON-lines files.

    Events that lack required fields are decodable: they are copied as they came.
    Messages that are not go to ``dead`` as Parquet.  Each sink has a directory per
    batch, which a replay overwrites, so a batch that failed half-way leaves no copies
    twice.  The stream observes ``copiados`` and ``muertos``.

    With several sinks the decoded batch is staged as Parquet below ``checkpoint`` while
    they are written, so executors hold no batch, whatever its size.

    ``compression`` ("gzip") packs the CSV and JSON-lines files.  A packed file is read by
    one task, so files then end after ``PACKED_ROWS`` rows.
    """
    packed = {"compression": compression, "maxRecordsPerFile": PACKED_ROWS} if compression else {}
    decoded = decode_records(records)
    broken = F.col(REASON) == MALFORMED
    decoded = decoded.observe(
        name, F.count_if(~F.coalesce(broken, F.lit(False))).alias("copiados"), F.count_if(broken).alias("muertos")
    )
    sinks = {"csv": (csv, CSV_OPTIONS), "json": (jsonl, JSON_OPTIONS)}
    wanted = {fmt: sink for fmt, sink in sinks.items() if sink[0]}
    staging = f"{checkpoint}/staged"

    def handle(batch: DataFrame, batch_id: int) -> None:
        shared = len(wanted) + bool(dead) > 1
        kept = _staged(batch, staging) if shared else batch
        try:
            rows = with_all_columns(decodable_events(kept))
            for fmt, (path, options) in wanted.items():
                writer = rows.write.mode("overwrite").format(fmt).options(**options, **packed)
                writer.save(batch_directory(batch, path, batch_id))
            if dead:
                letters = dead_letters(kept).where(F.col(REASON) == MALFORMED)
                letters.write.mode("overwrite").parquet(batch_directory(batch, dead, batch_id))
        finally:
            if shared:
                # Leaves an empty table, on any file system.
                batch.sparkSession.range(0).write.mode("overwrite").parquet(staging)

    return start_stream(decoded, name, checkpoint, interval, lambda w: w.foreachBatch(handle))


def start_csv_copy(
    records: DataFrame, path: str, checkpoint: str, interval: str | None = FLUSH_INTERVAL, name: str = "csv_copy",
    dead: str | None = None,
) -> StreamingQuery:
    """Append every decodable event, with bookkeeping, to CSV files; the rest to ``dead`` (see :func:`start_copies`)."""
    return start_copies(records, checkpoint, csv=path, dead=dead, interval=interval, name=name)


def start_jsonl_copy(
    records: DataFrame, path: str, checkpoint: str, interval: str | None = FLUSH_INTERVAL, name: str = "jsonl_copy",
    dead: str | None = None,
) -> StreamingQuery:
    """Append every decodable event, with bookkeeping, to JSON-lines files; the rest to ``dead`` (see :func:`start_copies`)."""
    return start_copies(records, checkpoint, jsonl=path, dead=dead, interval=interval, name=name)


@dataclass(frozen=True)
class BatchSummary:
    """What one pass over a micro-batch tells: sizes and event-time span."""

    rows: int
    dead: int
    first_time: datetime | None
    last_time: datetime | None

    @property
    def good(self) -> int:
        return self.rows - self.dead


def _summarise(batch: DataFrame) -> BatchSummary:
    good = F.col(REASON).isNull()
    time = F.when(good, F.col("timestamp_evento"))
    row = batch.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~good).alias("dead"),
        F.min(time).alias("first_time"),
        F.max(time).alias("last_time"),
    ).first()
    return BatchSummary(**row.asDict())


def _ingest_batches(
    stored_keys: Callable[[SparkSession, BatchSummary], DataFrame],
    append: Callable[[DataFrame, BatchSummary], None],
    dead_path: str,
) -> Callable[[DataFrame, int], None]:
    """A foreachBatch body: dedupe, skip stored ids, append, keep dead letters.

    A replayed batch finds its own ids stored and adds nothing; dead letters
    go to a directory of their batch and are overwritten by a replay.
    """

    def handle(decoded: DataFrame, batch_id: int) -> None:
        spark = decoded.sparkSession
        batch = decoded.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            summary = _summarise(batch)
            if summary.dead:
                dead_letters(batch).write.mode("overwrite").parquet(batch_directory(batch, dead_path, batch_id))
            if summary.good:
                events = valid_events(batch)
                fresh = first_arrivals(events)
                append(insert_if_absent(fresh, stored_keys(spark, summary), "id_log"), summary)
        finally:
            batch.unpersist()

    return handle


def _indexed_batches(index: IdIndex, table: str, dead_path: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch body that asks the index for stored ids, not the table.

    A batch adds its ids to the index before its rows to the table.  If the run
    ended between the two, the index knows the batch: it is then held against the
    table itself, and what is missing there is added.
    """
    started: set[str] = set()

    def handle(decoded: DataFrame, batch_id: int) -> None:
        spark = decoded.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        lot = f"{query}-{batch_id}"
        batch = decoded.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            dead_letters(batch).write.mode("overwrite").parquet(batch_directory(batch, dead_path, batch_id))
            fresh = index.absent(first_arrivals(valid_events(batch)), lot)
            # Only the first batch of a run can be one that was begun before.
            if query not in started and index.has(spark, lot):
                fresh = insert_if_absent(fresh, _stored_ids(spark, table), "id_log")
            started.add(query)
            fresh = fresh.persist(StorageLevel.MEMORY_AND_DISK)
            index.add(fresh, lot)
            write_events(fresh, table)
            fresh.unpersist()
        finally:
            batch.unpersist()

    return handle


def _stored_ids(spark: SparkSession, table: str) -> DataFrame:
    """The ids of the event table; of none if it is not there yet."""
    try:
        # The schema is given, so no footer is read to plan the lookup.
        return spark.read.schema(TABLE_SCHEMA).parquet(table).select("id_log", "fecha")
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return spark.createDataFrame([], "id_log string, fecha date")
        raise


def start_table_ingest(
    records: DataFrame,
    table: str,
    dead: str,
    checkpoint: str,
    interval: str | None = FLUSH_INTERVAL,
    same_date: bool = False,
    name: str = "table_ingest",
    index: IdIndex | None = None,
) -> StreamingQuery:
    """Insert-if-absent into the Parquet event table; one writer per table.

    With ``index`` the stored ids are looked up there, bucket by bucket: exact
    whatever the event times are, and the stored ids are not shuffled.  The index
    must have been kept from the table's first row on.

    The stored ids are looked up in the whole table.  ``same_date=True`` looks
    only in the dates present in the batch, which is exact when copies of an
    event carry the event time of the original, as redelivered messages do.
    """

    def stored_keys(spark: SparkSession, summary: BatchSummary) -> DataFrame:
        stored = _stored_ids(spark, table)
        if same_date:
            # Literal bounds: only the batch's date partitions are read.
            dates = (F.lit(t).cast("timestamp").cast("date") for t in (summary.first_time, summary.last_time))
            stored = stored.where(F.col("fecha").between(*dates))
        return stored.select("id_log")

    def append(fresh: DataFrame, summary: BatchSummary) -> None:
        write_events(fresh, table)

    handle = _indexed_batches(index, table, dead) if index else _ingest_batches(stored_keys, append, dead)
    return start_stream(
        decode_records(records), name, checkpoint, interval, lambda w: w.foreachBatch(handle)
    )


def start_jdbc_ingest(
    records: DataFrame,
    target: JdbcTable,
    dead: str,
    checkpoint: str,
    interval: str | None = FLUSH_INTERVAL,
    same_time: bool = False,
    name: str = "jdbc_ingest",
) -> StreamingQuery:
    """Insert-if-absent into a database table; one writer per table.

    ``same_time=True`` asks the database only for ids whose event time lies
    between the first and last of the batch (see ``start_table_ingest``).
    """

    def stored_keys(spark: SparkSession, summary: BatchSummary) -> DataFrame:
        if same_time:
            return read_jdbc_keys(spark, target, summary.first_time, summary.last_time)
        return read_jdbc_keys(spark, target)

    def append(fresh: DataFrame, summary: BatchSummary) -> None:
        append_jdbc(fresh, target)

    handle = _ingest_batches(stored_keys, append, dead)
    return start_stream(
        decode_records(records), name, checkpoint, interval, lambda w: w.foreachBatch(handle)
    )
