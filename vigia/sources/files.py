"""Batch scans of stored event copies: CSV, JSON lines and Parquet."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..schema import EVENT_COLUMNS, EVENT_SCHEMA, META_COLUMNS, conform

CORRUPT = "_corrupt"

TABLE_SCHEMA = T.StructType([*EVENT_SCHEMA, T.StructField("fecha", T.DateType(), True)])

# Copies written by different tools hold the bookkeeping columns as text or as
# numbers, so they are read as text and cast.
_FILE_SCHEMA = T.StructType(
    [T.StructField(f.name, f.dataType, True) for f in EVENT_SCHEMA]
    + [T.StructField(name, T.StringType(), True) for name in META_COLUMNS]
)


def _broker_time(column: str) -> Column:
    """Epoch milliseconds, or an ISO time, as text."""
    text = F.col(column)
    return F.coalesce(
        F.timestamp_millis(text.try_cast("bigint")), text.try_cast("timestamp")
    )


def _typed_meta(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "_kafka_partition": F.col("_kafka_partition").try_cast("int"),
            "_kafka_offset": F.col("_kafka_offset").try_cast("bigint"),
            "_kafka_timestamp": _broker_time("_kafka_timestamp"),
            "_consumer_ts": F.col("_consumer_ts").try_cast("timestamp"),
        }
    )


def read_csv(
    spark: SparkSession,
    path: str,
    keep_meta: bool = False,
    infer: bool = False,
    multi_line: bool = True,
) -> DataFrame:
    """CSV copies with a header; quotes inside quoted fields are doubled.

    Columns are found by the name in the header of their file: files may have
    them in any order, lack some (null) or have more (left out).  A cell that is
    not of its column's type is null; :func:`read_csv_rejects` returns its row.

    Fields may hold line breaks, so a file is read by one task.  For large
    single files without line breaks in fields, ``multi_line=False`` lets Spark
    split them.  ``infer=True`` guesses the types (one more pass).
    """
    if infer:
        reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
        return _without_meta(reader.option("inferSchema", True).csv(path), keep_meta)
    parts = [conform(_typed_meta(_typed_cells(raw)), keep_meta) for raw in _by_header(spark, path, multi_line)]
    if not parts:
        return conform(spark.createDataFrame([], _FILE_SCHEMA), keep_meta)
    return reduce(DataFrame.unionByName, parts)


ROW, FILE, CELLS, WIDTH = "_fila", "_archivo", "_celdas", "_ancho"


def read_csv_rejects(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """What ``read_csv`` could not take as it is: the row as it stands, its file, and why.

    ``_celdas`` names the columns whose cell is not of their type, comma separated;
    ``_ancho`` is true for a row with more or fewer cells than its header.  Files
    without a header give one row each, without ``_fila``.
    """
    parts = []
    for raw in _by_header(spark, path, multi_line):
        cells = [c for c in _FILE_SCHEMA.names[: len(EVENT_COLUMNS)] if c in raw.columns]
        kinds = {c: _FILE_SCHEMA[c].dataType for c in cells}
        wrong = F.concat_ws(",", *(F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.lit(c)) for c, t in kinds.items()))
        whole = F.to_json(F.struct(*(F.col(f"`{c}`") for c in raw.columns if c != CORRUPT)))
        row = F.coalesce(F.col(CORRUPT), whole)
        # Spark does not answer from the corrupt column alone, whatever is selected here.
        width = F.col(CORRUPT).isNotNull() & (F.length(row) >= 0)
        marked = raw.select(F.col("_metadata.file_path").alias(FILE), row.alias(ROW), wrong.alias(CELLS), width.alias(WIDTH))
        parts.append(marked.where((F.col(CELLS) != "") | F.col(WIDTH)))
    headed = csv_headers(spark, path).select("file")
    files = spark.read.text(path).select(F.col("_metadata.file_path").alias("file")).distinct()
    bare = files.join(headed, "file", "left_anti").select(
        F.col("file").alias(FILE), F.lit(None).cast("string").alias(ROW), F.lit("").alias(CELLS), F.lit(False).alias(WIDTH)
    )
    return reduce(DataFrame.unionByName, parts, bare)


def csv_headers(spark: SparkSession, path: str) -> DataFrame:
    """(file, header) of the CSV files below ``path``: the line whose cells are all names, three of them ours.

    One pass over the lines, without parsing them.  A file has one header; of
    several different ones the least is taken, and the others are rows of data.
    """
    line = F.regexp_replace("value", "[\ufeff\r]", "")
    names = F.transform(F.split(line, ","), lambda x: F.trim(F.regexp_replace(x, '^\\s*"|"\\s*$', "")))
    known = F.array(*map(F.lit, _FILE_SCHEMA.names))
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), names.alias("header"))
    ours = F.size(F.array_intersect("header", known)) >= 3
    found = lines.where(ours).where(F.forall("header", lambda n: n.rlike("^[A-Za-z_][A-Za-z0-9_ .-]*$")))
    return found.groupBy("file").agg(F.min("header").alias("header"))


def _by_header(spark: SparkSession, path: str, multi_line: bool) -> list[DataFrame]:
    """One DataFrame of text cells, and ``_corrupt`` for rows of another width, per different header.

    The driver sees one row per header and the names of the files, which it lists anyway.
    """
    grouped = csv_headers(spark, path).groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files"))
    # Whole rows are parsed whatever is selected, else a row's width would depend on it.
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line).option("columnPruning", False)
    out = []
    for r in sorted(grouped.collect(), key=lambda r: r.files):
        # A name that comes twice is read where it comes first.
        names = [n if n not in r.header[:i] else f"__otra_{i}" for i, n in enumerate(r.header)]
        schema = T.StructType([*(T.StructField(n, T.StringType()) for n in names), T.StructField(CORRUPT, T.StringType())])
        files = [unquote(f) for f in r.files]
        out.append(reader.schema(schema).option("columnNameOfCorruptRecord", CORRUPT).csv(files))
    return out


def _typed_cells(raw: DataFrame) -> DataFrame:
    """The file schema from text cells, by name; what does not fit its type is null."""
    present = set(raw.columns)
    return raw.select(
        *((F.col(f.name).try_cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name) for f in _FILE_SCHEMA)
    )


def read_jsonl(
    spark: SparkSession,
    path: str,
    keep_meta: bool = False,
    keep_corrupt: bool = False,
    infer: bool = False,
) -> DataFrame:
    """JSON-lines copies.  Lines that do not parse are dropped, or kept whole in
    ``_corrupt`` (every other column as far as it parsed) on request.

    Whole lines are parsed whatever columns are selected: the JSON reader
    would check only the selected ones, so a bad line could count in one
    analysis and not in another.
    """
    if infer:
        return _without_meta(spark.read.json(path), keep_meta)
    schema = T.StructType(_FILE_SCHEMA.fields + [T.StructField(CORRUPT, T.StringType(), True)])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    lines = spark.read.text(path).where(F.trim("value") != "")
    parsed = lines.select("value", F.from_json("value", schema, options).alias("e"))
    bad = F.when(F.col("e").isNull(), F.col("value")).otherwise(F.col(f"e.{CORRUPT}"))
    typed = _typed_meta(parsed.select(*(f"e.{c}" for c in _FILE_SCHEMA.names), bad.alias(CORRUPT)))
    if keep_corrupt:
        return conform(typed, keep_meta, extra=[CORRUPT])
    return conform(typed.where(F.col(CORRUPT).isNull()), keep_meta)


def read_jsonl_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The lines that ``read_jsonl`` leaves out, whole, in ``_corrupt``."""
    return read_jsonl(spark, path, keep_corrupt=True).where(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def _without_meta(df: DataFrame, keep_meta: bool) -> DataFrame:
    return df if keep_meta else df.drop(*META_COLUMNS)


def read_events(
    spark: SparkSession, path: str, since: str | None = None, until: str | None = None
) -> DataFrame:
    """The Parquet event table; ``since`` (inclusive) and ``until`` (exclusive)
    select event dates, so only those partitions are read.  The schema is
    given, so no file footer is read to plan."""
    df = spark.read.schema(TABLE_SCHEMA).parquet(path)
    if since:
        df = df.where(F.col("fecha") >= F.lit(since).cast("date"))
    if until:
        df = df.where(F.col("fecha") < F.lit(until).cast("date"))
    return df.select(*EVENT_COLUMNS)
