"""Helpers shared by the text operators: tables, chunks, word hashes, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigia.session import scratch_path

#: What a word is: white space is space and the control characters 9 to 13.
SPACES = r"[\x20\x09-\x0D]+"
#: Bytes of text that one numpy step works on, so that its arrays stay small.
CHUNK_BYTES = 1 << 20
#: Bits of the bitmap of :func:`sifted`.
SIFT = 1 << 24


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, lineage cut."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def digest(text: str = "text"):
    """128 bits that stand for a whole text; null for null."""
    return F.unhex(F.md5(F.col(text).cast("string")))


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = CHUNK_BYTES):
    """Record batches cut so that ``column`` holds about ``most`` bytes in each; a longer text stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(batch.column(column).is_valid(), dtype=np.int64)
        sizes *= np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0), dtype=np.int64)
        start, held = 0, 0
        for row, size in enumerate(sizes.tolist()):
            if row > start and held + size > most:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        yield batch.slice(start)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all rows in a line, and where each row starts; null is empty."""
    column = pa.compute.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_POWERS: dict[str, np.ndarray] = {}


def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS["up"]) < length:
        n = max(length, 2 * CHUNK_BYTES)
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            x = np.full(n, base, dtype=np.uint64)
            x[0] = 1
            _POWERS[name] = np.multiply.accumulate(x)
    return _POWERS["up"], _POWERS["down"]


class Words:
    """All words of some texts: 64-bit hash, byte span and row of each, in order of text.

    Words lie between white space; with ``letters`` they are runs of letters and
    digits (and all that is not ASCII), A-Z as a-z.
    """

    def __init__(self, column: pa.Array, letters: bool = False):
        self.data, self.offsets = text_bytes(column)
        self.rows = len(column)
        data, n = self.data, len(self.data)
        if letters:
            data = data + np.uint8(32) * ((data >= 65) & (data <= 90))
            space = ~((data >= 128) | ((data >= 48) & (data <= 57)) | ((data >= 97) & (data <= 122)))
        else:
            space = (data == 32) | ((data >= 9) & (data <= 13))
        begins = np.zeros(n + 1, dtype=bool)
        begins[self.offsets[:-1]] = True  # a text never continues the one before
        fresh = begins[:n].copy()
        fresh[1:] |= space[:-1]
        self.starts = np.flatnonzero(fresh & ~space)
        last = np.ones(n, dtype=bool)
        if n:
            last[:-1] = space[1:] | begins[1:n]
        self.ends = np.flatnonzero(last & ~space) + 1
        up, down = _powers(n + 1)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE[data] * up[:n], out=sums[1:])
        own = (sums[self.ends] - sums[self.starts]) * down[self.starts]
        self.hashes = mix(own + (self.ends - self.starts).astype(np.uint64))
        self.row = np.searchsorted(self.offsets, self.starts, side="right") - 1
        self.first = np.searchsorted(self.row, np.arange(self.rows + 1))

    def windows(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every run of ``length`` words inside one text, and the number of its first word."""
        n = len(self.hashes) - length + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        total = np.zeros(n, dtype=np.uint64)
        for k in range(length):
            total = total * np.uint64(_BASE) + self.hashes[k : k + n]
        at = np.flatnonzero(self.row[:n] == self.row[length - 1 :])
        return mix(total[at]), at


def sifted(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The ``rows`` whose id is among the distinct ``ids``; few others are shuffled for that while ids are far fewer than SIFT.

    What is broadcast is a bitmap of SIFT bits in words of 64, so its size is bounded
    whatever the ids are.  The exact join is an inner one: Spark moves a semi join
    below the bitmap, where it would shuffle all rows.
    """
    place = F.pmod(F.xxhash64("id"), F.lit(SIFT))
    word, bit = F.shiftright(place, 6).alias("__word"), place.bitwiseAND(F.lit(63)).cast("int")
    words = ids.select(word, bit.alias("bit")).groupBy("__word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("__bits"))
    met = rows.select("*", word).join(F.broadcast(words), "__word").where(F.getbit("__bits", bit) == 1)
    return met.join(ids, "id").select(*rows.columns)


def components(links: DataFrame, label: str) -> DataFrame:
    """Connected components of ``links`` (a, b): columns (id, root), root the least id of the component.

    Rounds of a large-star and a small-star step, until a round moves no link.  Two
    rounds at a time are written to the shared folder, so nothing is collected and no
    lineage grows.
    """
    links = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), label)
    moved = True
    while moved:
        links = stored(_round(_round(links)), label)
        moved = links.agg(F.max("moved")).first()[0]
    roots = links.select(F.col("b").alias("id")).distinct()
    return links.select(F.col("a").alias("id"), F.col("b").alias("root")).unionAll(roots.select("id", F.col("id").alias("root")))


def _round(links: DataFrame) -> DataFrame:
    """Large-star, then small-star, each one shuffle and one sort of the links (a > b), with whether a link ``moved``.

    Stars come out as they went in, each link once.
    """
    both = links.selectExpr("inline(array(struct(a, b), struct(b AS a, a AS b)))")
    least = F.least("a", F.min("b").over(Window.partitionBy("a")))
    large = both.withColumn("m", least).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"), (F.col("m") < F.col("a")).alias("moved"))
    # Of equal links the first, which has moved if one has.
    up = Window.partitionBy("a").orderBy("b", F.desc("moved"))
    least = F.min("b").over(up.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    once = large.withColumns({"m": least, "before": F.lag("b").over(up)}).where("before IS NULL OR before <> b")
    only = F.col("b") == F.col("m")
    return once.select(F.when(only, F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"), (F.col("moved") | ~only).alias("moved"))


def merged(groups: DataFrame, links: DataFrame, label: str) -> DataFrame:
    """``groups`` (id, root) of :func:`components` with more ``links`` (a, b); works on links between roots only."""
    a = groups.select(F.col("id").alias("a"), F.col("root").alias("ra"))
    b = groups.select(F.col("id").alias("b"), F.col("root").alias("rb"))
    between = links.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    joined = components(between, label)
    moved = groups.join(joined.select(F.col("id").alias("root"), F.col("root").alias("now")), "root", "left")
    return stored(moved.select("id", F.coalesce("now", "root").alias("root")).unionAll(joined.join(groups, "id", "left_anti").select("id", "root")), label)
