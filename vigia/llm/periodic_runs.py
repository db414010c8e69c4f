"""Periodic runs of words: stretches that repeat one period four times or more.

A *run* is a stretch of consecutive words with smallest period q (words q apart are
identical) and ``max(6, 4 q)`` words or more that no neighbouring word extends.

**Method (scale tiles).**  Periods are taken by octave, ``P <= q < 2 P`` for
``P = 1, 2, 4 ...``.

1. *Tiles.*  A text is cut into tiles for each octave: ``CORE`` words or eight times P,
   with ``2 P`` words before and ``4 P`` after from the neighbours.  Every run of the
   octave holds two neighbouring multiples of P at which the P words ahead equal
   those q further on.  Hashes of all P-word windows (each octave doubles those of
   the one before) find these places; only tiles near one leave the task, so most
   texts end here.
2. *Solve.*  Tiles are dealt over the cluster one by one, so a long text is not one
   task's work.  At every second multiple of P near such a place two Z-functions,
   ahead and back, give for each q of the octave how far the period reaches.  This
   is linear in the words of the tile and compares words, not hashes of windows.
3. *Stitch.*  The intervals, cut at tile borders, are shuffled by text and period and
   joined where they overlap by a period or more.  A tile hands on one interval a
   run, so a long run is a few rows.

The overlaps are such that every border of a run lies inside some tile that meets
it (see :func:`intervals`).  Of equal stretches the least period is the run's.

**Bounds.**  A task holds one text and a few arrays of its length.  Intervals of one
text and period, and runs of one text, come together; both grow with that text only.

**Defined cases.**  Null and empty texts have no words and no runs.  A null ``doc_id``
leaves the text as it is (there is no checksum).  Rows that repeat ``doc_id`` and
text get one result row each.  Runs with equal exponents: the least start, then
the least period is reported.  Words are told apart by 64-bit hashes within one
text.  Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Words, chunks, digest, mix, stored

#: A run has so many periods, and so many words, at least.
LEAST_TIMES, LEAST_WORDS = 4, 6
#: Words of a tile without its borders, at least; a tile of octave P has 8 P.
CORE = 4096

_NOTHING = hashlib.sha256(b"").hexdigest()


def planted(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """(a, p) if every word i >= a of the text is to become word a + (i - a) % p."""
    if doc_id is None or not n:
        return None
    h = crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def _index(doc_id: int | None, n: int) -> np.ndarray:
    """Which original word stands at each place."""
    at = np.arange(n)
    rule = planted(doc_id, n)
    if rule:
        a, p = rule
        at[a:] = a + (at[a:] - a) % p
    return at


def octaves(n: int) -> Iterator[int]:
    octave = 1
    while LEAST_TIMES * octave <= n:
        yield octave
        octave *= 2


def candidates(hashes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(P, places) by octave: multiples j of P where some q has P equal words at j and at j + P.

    A run has words q apart equal from its start on for three periods, so over
    ``2 P + 1`` places at which whole windows of P words are equal.
    """
    window, n = hashes, len(hashes)
    for octave in octaves(n):
        if octave > 1:  # windows of P words from those of P / 2
            half = octave // 2
            window = mix(window[:-half] * np.uint64(3) + mix(window[half:]))
        blocks = len(window) // octave - 1  # places with all periods of the octave
        rest = len(window) - octave - blocks * octave
        first = window[: (blocks + 1) * octave : octave]
        equal = np.zeros((blocks + 1, octave), dtype=bool)
        if blocks > 0:
            equal[:blocks] = window[octave : octave + blocks * octave].reshape(blocks, octave) == first[:blocks, None]
        if rest > 0:
            equal[blocks, :rest] = window[octave + blocks * octave :] == first[blocks]
        found = np.flatnonzero((equal[:-1] & equal[1:]).any(axis=1))
        if len(found):
            yield octave, found * octave


def tiles(hashes: np.ndarray) -> Iterator[tuple[int, int, int, list[int], bytes]]:
    """The tiles of one text that may meet a run: octave, number of the first word, words of the text, places to solve, words."""
    codes = None
    n = len(hashes)
    for octave, places in candidates(hashes):
        if codes is None:
            codes = np.unique(hashes, return_inverse=True)[1].astype(np.int32)
        # All multiples of 2 P from P before to 3 P after a candidate: a run reaches no further.
        step = 2 * octave
        solve = np.unique((places // step)[:, None] + np.arange(3)) * step
        solve = solve[solve < n]
        for core in np.unique(solve // max(CORE, 8 * octave)) * max(CORE, 8 * octave):
            own = solve[(solve >= core) & (solve < core + max(CORE, 8 * octave))]
            begin, end = max(0, int(own[0]) - 2 * octave), min(n, int(own[-1]) + 4 * octave)
            yield octave, begin, n, own.tolist(), codes[begin:end].tobytes()


def z_function(s: list[int]) -> list[int]:
    """How many items from each place on agree with the items from the start on."""
    n = len(s)
    z = [0] * n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        if i + k > right:
            left, right = i, i + k
        z[i] = k
    return z


def _prime_divisors(n: int) -> list[int]:
    found, p = [], 2
    while p * p <= n:
        if n % p == 0:
            found.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return [*found, n] if n > 1 else found


def intervals(octave: int, first: int, of: int, solve: list[int], words: list[int]) -> list[tuple[int, int, int]]:
    """(period, start, end) of the stretches that meet the places ``solve`` of a tile.

    At place b the words from ``b - 2 P`` to ``b + 4 P`` are looked at.  A run [s, e)
    with period q of the octave has a multiple of 2 P in its first 2 P places, whose
    look back passes s, and one in the 2 P places up to e - q, whose look ahead passes
    e; the looks of neighbours overlap by q or more.  So what is cut off at neither
    end and shorter than a run is none, and the rest is handed on.  A stretch with a
    smaller period that divides q is left to that period.
    """
    held: dict[int, list[tuple[int, int]]] = {}
    for b in solve:
        low, high = max(0, b - 2 * octave), min(of, b + 4 * octave)
        ahead = words[b - first : high - first]
        if len(ahead) <= octave:
            continue
        z = [*z_function(ahead), 0]
        reach = min(2 * octave, of - b)  # words after b that may end a period
        back = words[low - first : b - first][::-1]
        zb = z_function([*back, -1, *words[low - first : b + reach - first][::-1]])
        behind = len(back) + 1 + reach  # zb[behind - q]: words before b equal to those q later
        for q in range(octave, min(2 * octave, reach + 1)):
            forth, past = z[q], zb[behind - q]
            if forth < octave and past < octave:
                continue
            start, end = b - past, b + q + forth
            cut = (start == low and low > 0) or (end == high and high < of)
            if end - start < (2 * q if cut else max(LEAST_WORDS, LEAST_TIMES * q)):
                continue
            if any(z[d] >= end - b - d and zb[behind - d] >= past for d in (q // p for p in _prime_divisors(q))):
                continue
            own = held.setdefault(q, [])
            if own and start <= own[-1][1] - q:
                own[-1] = (min(start, own[-1][0]), max(end, own[-1][1]))
            else:
                own.append((start, end))
    return [(q, s, e) for q, own in held.items() for s, e in own]


_CUT = (
    "doc_id bigint, id binary, n_words bigint, collapsed_sha256 string, text string, "
    "octave bigint, first bigint, of bigint, solve array<bigint>, words binary"
)
_CUT_TYPES = {
    "doc_id": pa.int64(),
    "id": pa.binary(),
    "n_words": pa.int64(),
    "collapsed_sha256": pa.string(),
    "text": pa.string(),
    "octave": pa.int64(),
    "first": pa.int64(),
    "of": pa.int64(),
    "solve": pa.list_(pa.int64()),
    "words": pa.binary(),
}
#: Bytes of tiles in one record batch, about.
_HELD_BYTES = 1 << 22


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per text and one per tile; texts without a tile end here with their digest, the others are kept."""

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, _CUT_TYPES.values(), strict=True)], list(_CUT_TYPES))

    for batch in chunks(batches):
        words, texts = Words(batch.column("text")), batch.column("text")
        rows, held = [], 0
        for row, (doc_id, key) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("id").to_pylist(), strict=True)):
            a, b = words.first[row], words.first[row + 1]
            n = int(b - a)
            some = False
            for tile in tiles(words.hashes[a:b][_index(doc_id, n)]) if n >= LEAST_WORDS else ():
                some = True
                rows.append((doc_id, key, None, None, None, *tile))
                held += len(tile[-1])
                if held > _HELD_BYTES:
                    yield batch_of(rows)
                    rows, held = [], 0
            text = texts[row].as_py()
            sha = None if some else hashlib.sha256(b" ".join(_words(doc_id, text))).hexdigest()
            rows.append((doc_id, key, n, sha, text if some else None, *[None] * 5))
        yield batch_of(rows)


def _words(doc_id: int | None, text: str | None) -> list[bytes]:
    """The words after the rule of :func:`planted`; bytes split at the six ASCII white spaces."""
    words = (text or "").encode().split()
    rule = planted(doc_id, len(words))
    return [words[i] for i in _index(doc_id, len(words))] if rule else words


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.to_pylist()
        found = [
            (r["doc_id"], r["id"], q, s, e)
            for r in rows
            for q, s, e in intervals(r["octave"], r["first"], r["of"], r["solve"], np.frombuffer(r["words"], np.int32).tolist())
        ]
        columns = zip(*found, strict=True) if found else ((),) * 5
        types = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "id", "period", "start", "end"])


def stitched(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, period, start, end): intervals of one period joined where they overlap by it or more."""
    along = Window.partitionBy(*keys, "period").orderBy("start", "end")
    before = F.max("end").over(along.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(F.col("start") <= before - F.col("period"), 0).otherwise(1)
    numbered = pieces.withColumn("__fresh", fresh).withColumn("__part", F.sum("__fresh").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "period", "__part").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("__part")


def _collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of the runs and of the words that stay, and the run of greatest exponent."""
    for batch in chunks(batches):
        out = []
        for r in batch.to_pylist():
            runs = [(x["start"], x["length"], x["period"]) for x in r["runs"] or ()]
            words = _words(r["doc_id"], r["text"])
            gone = np.zeros(len(words) + 1, dtype=np.int64)
            for start, length, period in runs:
                gone[start + period] += 1
                gone[start + length] -= 1
            kept = np.flatnonzero(np.cumsum(gone[:-1]) == 0) if words else ()
            best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None, None, None))
            milli = 1000 * best[1] // best[2] if runs else None
            lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
            out.append((r["doc_id"], len(runs), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join([words[i] for i in kept])).hexdigest()))
        columns = list(zip(*out, strict=True))
        types = [pa.int64()] * 6 + [pa.string()] * 2
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], _RESULT)


_RESULT = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def cut_texts(docs: DataFrame) -> DataFrame:
    """One row per text (number of words, and the digest of all words or, if it has tiles, the text) and one per tile."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.withColumn("id", digest()).mapInArrow(_cut, _CUT)


def runs_of(cut: DataFrame) -> DataFrame:
    """(doc_id, id, start, length, period) of the runs of :func:`cut_texts`; rows that repeat a text share theirs."""
    spread = cut.where("octave IS NOT NULL").select("doc_id", "id", "octave", "first", "of", "solve", "words")
    # Dealt by tile: neither a long text nor a text with many copies is one task's work.
    dealt = spread.repartition(F.col("doc_id"), F.col("id"), F.col("octave"), F.col("first"))
    pieces = dealt.mapInArrow(_solve, "doc_id bigint, id binary, period bigint, start bigint, end bigint")
    whole = stitched(pieces, ["doc_id", "id"]).withColumn("length", F.col("end") - F.col("start"))
    enough = F.col("length") >= F.greatest(F.lit(LEAST_WORDS), LEAST_TIMES * F.col("period"))
    return whole.where(enough).groupBy("doc_id", "id", "start", "length").agg(F.min("period").alias("period"))


def op12_periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, the run of greatest length / period, and digests of runs and kept words."""
    cut = stored(cut_texts(docs), "tiles")
    runs = runs_of(cut).groupBy("doc_id", "id").agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    own = [F.col("doc_id").eqNullSafe(F.col("r_doc")), F.col("id") == F.col("r_id")]
    named = runs.select(F.col("doc_id").alias("r_doc"), F.col("id").alias("r_id"), "runs")
    texts = cut.where("octave IS NULL")
    some = texts.where("collapsed_sha256 IS NULL").select("doc_id", "id", "text").join(named, own, "left").select("doc_id", "text", "runs")
    schema = "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"
    none = texts.where("collapsed_sha256 IS NOT NULL")
    empty = [F.lit(None).cast("bigint").alias(c) for c in ("start", "length", "period", "exponent_milli")]
    clean = none.select("doc_id", F.lit(0).cast("bigint").alias("n_runs"), *empty, F.lit(_NOTHING).alias("runs_sha256"), "collapsed_sha256")
    return clean.unionByName(some.mapInArrow(_collapsed, schema))
