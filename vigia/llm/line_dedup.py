"""Line dedup by pairwise alignment.

Documents that share a rare line are aligned with patience diff, and lines of the
later document that lie in an aligned common block are deleted.

* Documents are ordered by doc_id (null last), then by digest.  Of equal texts the
  first stays and the others lose all lines.
* A line is a seed when it has ``SEED_CHARS`` characters or more.  A short line
  belongs to the seed line before it (at the top, to the one after): it is common
  only where its neighbourhood is, so short lines that occur everywhere stay.
* A run of short lines one after another is a seed as well: from each of them to
  the first with which they have ``SEED_CHARS`` characters together.  So verse,
  lists, code and Chinese text are aligned whatever stands above them.  Runs are
  counted, paired and aligned like lines, and an aligned run takes all its lines.
* A line is rare when at most ``RARE_LEAST`` documents and ``RARE_SHARE`` of all hold
  it.  The share is high on purpose: linking costs one row per line however many
  documents hold it, and a lower one would lose the lines of large families.
* A document is paired, for each of its shared rare lines, with the earliest
  document that holds it: pairs grow with lines, not with the square of a family.
* Each pair's common lines are aligned by patience diff: equal ends, then lines
  that occur once on both sides in their longest common order, then the stretches
  between those; a stretch without such a line matches the k-th copy of a line
  with its k-th copy.  Aligned lines go from the later document.

Null text: stays null with no lines.  Empty lines are kept unless their block goes.
Rows that repeat both doc_id and text are one document and get one result.
Texts of fewer than ``SEED_CHARS`` characters are only compared whole.  Other columns stay as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigia.llm.common import _powers, digest, mix, stored

SEED_CHARS = 25
RARE_LEAST, RARE_SHARE = 10, 0.5


def _increasing(b: list[int]) -> list[int]:
    """Places of a longest strictly increasing subsequence."""
    from bisect import bisect_left

    tails, at, before = [], [], [0] * len(b)
    for k, x in enumerate(b):
        p = bisect_left(tails, x)
        before[k] = at[p - 1] if p else -1
        if p == len(tails):
            tails.append(x)
            at.append(k)
        else:
            tails[p], at[p] = x, k
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(k)
        k = before[k]
    return out[::-1]


def patience(left: list, right: list) -> list[tuple[int, int]]:
    """Aligned places of two sequences, in order."""
    from collections import Counter

    out, work = [], [(0, len(left), 0, len(right))]
    while work:
        a, b, c, d = work.pop()
        while a < b and c < d and left[a] == right[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and left[b - 1] == right[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a == b or c == d:
            continue
        mine, theirs = Counter(left[a:b]), Counter(right[c:d])
        place = {x: k for k, x in enumerate(right[c:d], c) if theirs[x] == 1 and mine[x] == 1}
        once = [(k, place[x]) for k, x in enumerate(left[a:b], a) if x in place]
        if not once:  # number the copies of each line, so that every one occurs once
            seen: dict = {}
            copies = {}
            for k in range(c, d):
                n = seen[right[k]] = seen.get(right[k], 0) + 1
                copies[right[k], n] = k
            seen = {}
            for k in range(a, b):
                n = seen[left[k]] = seen.get(left[k], 0) + 1
                if (left[k], n) in copies:
                    once.append((k, copies[left[k], n]))
            out += [once[k] for k in _increasing([y for _, y in once])]
            continue
        chosen = [once[k] for k in _increasing([y for _, y in once])]
        out += chosen
        edges = [(a - 1, c - 1), *chosen, (b, d)]
        work += [(x + 1, y, u + 1, v) for (x, u), (y, v) in zip(edges, edges[1:]) if y > x + 1 and v > u + 1]
    return sorted(out)


ID = "id struct<absent: boolean, doc_id: long, digest: binary>"


def _id():
    return F.struct(F.col("doc_id").isNull().alias("absent"), F.col("doc_id").cast("long").alias("doc_id"), digest().alias("digest")).alias("id")


def _keys(batches):
    """A row for each distinct key of a line or run of a document, with its number of lines and its places."""
    for batch in batches:
        x = batch.column("x")
        sizes = np.asarray(pa.compute.list_value_length(x), dtype=np.int64)
        flat = x.flatten()
        h, size = np.asarray(flat.field("h")), np.asarray(flat.field("size"), dtype=np.int64)
        seed, n = size >= SEED_CHARS, len(h)
        first = np.repeat(np.cumsum(sizes) - sizes, sizes)
        row = np.repeat(np.arange(len(sizes)), sizes)
        before = np.maximum.accumulate(np.where(seed, np.arange(n), -1))
        after = np.minimum.accumulate(np.where(seed, np.arange(n), n)[::-1])[::-1]
        below = before >= first
        holder = np.where(below, before, np.where(after < first + np.repeat(sizes, sizes), after, -1))
        with np.errstate(over="ignore"):
            near = h * np.int64(31) + h[np.maximum(holder, 0)] * np.int64(1000003) + np.where(below, 1, 2)
        at = np.flatnonzero(holder >= 0)
        begin, end = _runs(size, np.minimum(after, first + np.repeat(sizes, sizes)))
        up, down = _powers(n + 1)
        sums = np.append(np.uint64(0), np.cumsum(mix(h.view(np.uint64)) * up[:n], dtype=np.uint64))
        run = mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64)).view(np.int64)
        key, span = np.append(np.where(seed, h, near)[at], run), np.append(np.ones(len(at), np.int64), end - begin)
        at = np.append(at, begin)
        row, place = row[at], (np.arange(n) - first)[at]
        order = np.lexsort((place, key, row))
        key, span, row, place = key[order], span[order], row[order], place[order]
        new = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (row[1:] != row[:-1]))) if len(key) else np.zeros(0, np.int64)
        ends = pa.array(np.append(new, len(key)).astype(np.int32))
        places = pa.ListArray.from_arrays(ends, pa.array(place.astype(np.int32)))
        names = ["id", "key", "span", "places"]
        yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(row[new])), pa.array(key[new]), pa.array(span[new].astype(np.int32)), places], names=names)


def _runs(size: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From each line the fewest lines that have ``SEED_CHARS`` characters and end before ``stop``, the next seed or text."""
    upto = np.append(0, np.cumsum(size))
    end = np.searchsorted(upto, upto[:-1] + SEED_CHARS)
    begin = np.flatnonzero((size < SEED_CHARS) & (end <= stop))
    return begin, end[begin]


def _align(batches):
    """For each document, which of its lines are aligned with an earlier one."""
    for batch in batches:
        masks = []
        for common in batch.column("common").to_pylist():
            partners: dict = {}
            for line in common:
                first = line["first"]
                mine, theirs = partners.setdefault((first["doc_id"], first["digest"]), (set(), set()))
                mine.update((p, line["key"]) for p in line["places"])
                theirs.update((p, line["key"]) for p in line["there"])
            lost, span = set(), {line["key"]: line["span"] for line in common}
            for mine, theirs in partners.values():
                mine, theirs = sorted(mine), sorted(theirs)
                for k, _ in patience([x for _, x in mine], [x for _, x in theirs]):
                    lost.update(range(mine[k][0], mine[k][0] + span[mine[k][1]]))
            mask = np.zeros(max(lost) + 1 if lost else 0, dtype=bool)
            mask[list(lost)] = True
            masks.append(mask)
        ends = pa.array(np.append(0, np.cumsum([len(m) for m in masks])).astype(np.int32))
        lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(masks) if masks else np.zeros(0, bool)))
        yield pa.RecordBatch.from_arrays([batch.column("id"), lists], names=["id", "lost"])


def aligned_lines(docs: DataFrame) -> DataFrame:
    """id and ``lost`` (array of boolean, one for each line up to the last lost one) of documents that lose lines."""
    lines = docs.where("text IS NOT NULL").select(
        _id(), F.transform(F.split(F.col("text").cast("string"), "\n"), lambda s: F.struct(F.xxhash64(s).alias("h"), F.length(s).alias("size"))).alias("x")
    )
    each = stored(lines.mapInArrow(_keys, f"{ID}, key long, span int, places array<int>"), "lines")
    rare = RARE_LEAST + RARE_SHARE * docs.count()
    held = each.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "places")).alias("f"))
    shared = stored(held.where((F.col("n") > 1) & (F.col("n") <= rare)).select("key", F.col("f.id").alias("first"), F.col("f.places").alias("there")), "shared-lines")
    pairs = each.join(shared, "key").where("id > first")
    common = pairs.groupBy("id").agg(F.collect_list(F.struct("first", "key", "span", "places", "there")).alias("common"))
    return common.mapInArrow(_align, f"{ID}, lost array<boolean>")


def deduped_rows(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` as one column ``row``, the text that is left, and how many lines there were and went.

    The row travels in one column, so ``docs`` may have columns of any name.
    """
    ids = docs.where("text IS NOT NULL").select(_id()).distinct()
    firsts = ids.groupBy("id.digest").agg(F.min("id").alias("first"))
    copies = ids.join(firsts, F.col("id.digest") == F.col("digest")).where("id > first").select("id")
    lost = aligned_lines(docs)
    marks = copies.withColumn("copy", F.lit(True)).join(lost, "id", "full")
    marks = marks.select(F.col("id").alias("marked"), F.coalesce("copy", F.lit(False)).alias("copy"), F.col("lost").alias("mask"))
    every = F.split(F.col("text").cast("string"), "\n").alias("every")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), _id(), every)
    same = F.col("id.doc_id").eqNullSafe(F.col("marked.doc_id")) & (F.col("id.digest") == F.col("marked.digest"))
    kept = rows.join(marks, same, "left")
    goes = lambda i: F.col("copy") | F.coalesce(F.get("mask", i), F.lit(False))
    left = F.when(F.col("marked").isNull(), F.col("every")).otherwise(F.filter("every", lambda x, i: ~goes(i)))
    counted = kept.withColumn("left", left)
    lines, gone = F.size("every"), F.size("every") - F.size("left")
    return counted.select(
        "row", F.array_join("left", "\n").alias("text"), F.coalesce(lines, F.lit(0)).alias("lines"), F.coalesce(gone, F.lit(0)).alias("lost")
    )


def line_dedup(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` with the text that is left, then __lines and __lost: how many there were and went.

    For ``docs`` that have columns __lines or __lost themselves take :func:`deduped_rows`.
    """
    columns = [F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns]
    return deduped_rows(docs).select(*columns, F.col("lines").alias("__lines"), F.col("lost").alias("__lost"))


def op1_line_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, the text that is left, n_lines and n_removed of every document."""
    out = line_dedup(docs.select("doc_id", "text"))
    return out.select("doc_id", "text", F.col("__lines").cast("long").alias("n_lines"), F.col("__lost").cast("long").alias("n_removed"))
