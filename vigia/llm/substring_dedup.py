"""Substring dedup by level-wise doubling.

A word run (window) that several documents hold is looked for level by level.
Level 7 is a sieve: only the 7-word windows that are the least of the seven in
some 13-word window are compared, and a 13-word window can only be repeated where
its least one is.  Level 13 (twice 7, one word shared) decides what is removed.
From there each level is twice the one before: a window of 26 words is a candidate
only where both its halves are repeated, and so on until no candidate survives.

Removed is every word covered by a 13-word window that also starts in a document
with a smaller doc_id, judged on the input.  ``longest`` is the greatest level at
which the document still has a repeated window (0: none).

Each level sends its candidates, packed by hash into byte arrays, through one
shuffle.  Every task first keeps only the least document of a window among its own
and answers for the others itself, so a window that a third of all documents hold
arrives once from each task.  The number of packs is
``spark.sql.shuffle.partitions``: size it to the data as for any job.  Windows are
compared by a 64-bit hash (the sieve by 32 bits and the pack, which only lets more
candidates through).

Of exact copies only the one with the least doc_id takes part; every word of the
others goes, where there are 13 or more.  Null text: no words.  Null doc_id: kept
whole, and a source for nobody.  Rows that share a doc_id are parts of one
document: none is earlier than another.  Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigia.llm.common import Words, chunks, digest, mix, stored

WINDOW = 13
SIEVE = 7
#: Bytes of text whose candidates are packed together.
BLOCK_BYTES = 8 << 20

PACK = "part int, docs binary, keys binary, owners binary, places binary"


def _least(hashes: np.ndarray, at: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Indexes into the SIEVE-word windows that are least in some WINDOW-word window; of equals the first."""
    reach = WINDOW - SIEVE + 1
    n = len(hashes) - reach + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, where = hashes[:n].copy(), np.arange(n)
    for k in range(1, reach):
        less = hashes[k : k + n] < best
        best[less], where[less] = hashes[k : k + n][less], np.flatnonzero(less) + k
    whole = rows[:n] == rows[reach - 1 :]
    return np.unique(where[whole])


def _packs(docs: np.ndarray, owners: np.ndarray, keys: np.ndarray, places: np.ndarray, parts: int):
    """Record batches of PACK rows, one for each part that has keys."""
    part = (keys % np.uint64(parts)).astype(np.int64)
    order = np.lexsort((owners, keys, part))
    part, owners, keys, places = part[order], owners[order], keys[order], places[order]
    cut = np.searchsorted(part, np.arange(parts + 1))
    some = np.flatnonzero(np.diff(cut))
    rows = [[], [], [], [], []]
    for p in some.tolist():
        a, b = cut[p], cut[p + 1]
        who, local = np.unique(owners[a:b], return_inverse=True)
        values = (p, docs[who].tobytes(), keys[a:b].tobytes(), local.astype(np.int32).tobytes(), places[a:b].astype(np.int32).tobytes())
        for row, value in zip(rows, values):
            row.append(value)
    if len(some):
        yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), *(pa.array(r, pa.binary()) for r in rows[1:])], names=["part", "docs", "keys", "owners", "places"])


def _unpacked(group: pa.Table, key_type) -> tuple[np.ndarray, ...]:
    """All (doc, key, place) of one part."""
    doc, key, place = [], [], []
    for docs, keys, owners, places in zip(*(group.column(c).to_pylist() for c in ("docs", "keys", "owners", "places"))):
        doc.append(np.frombuffer(docs, np.int64)[np.frombuffer(owners, np.int32)])
        key.append(np.frombuffer(keys, key_type))
        place.append(np.frombuffer(places, np.int32))
    return np.concatenate(doc), np.concatenate(key), np.concatenate(place)


def _runs(key: np.ndarray) -> np.ndarray:
    """Where runs of equal sorted keys begin, and the end."""
    return np.append(np.flatnonzero(np.append(True, key[1:] != key[:-1])), len(key)) if len(key) else np.zeros(1, np.int64)


def _shared(doc: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order by key and doc; in that order, whether a key has several docs, and the least doc of each key."""
    order = np.lexsort((doc, key))
    runs = _runs(key[order])
    size = np.diff(runs)
    low, high = doc[order][runs[:-1]], doc[order][runs[1:] - 1]
    return order, np.repeat(low != high, size), np.repeat(low, size)


def _by_group(doc, place, key, later, level, groups):
    """One row for each group of documents: docs, places, keys and whether an earlier document has the window."""
    group = _group(doc, groups)
    order = np.argsort(group, kind="stable")
    group, doc, place, key, later = group[order], doc[order], place[order], key[order], later[order]
    runs = _runs(group)
    cut = list(zip(runs[:-1].tolist(), runs[1:].tolist()))
    return {
        "group": pa.array(group[runs[:-1]], pa.int32()),
        "level": pa.array([level] * len(cut), pa.int32()),
        "docs": pa.array([doc[a:b].tobytes() for a, b in cut], pa.binary()),
        "places": pa.array([place[a:b].astype(np.int32).tobytes() for a, b in cut], pa.binary()),
        "keys": pa.array([key[a:b].tobytes() for a, b in cut], pa.binary()),
        "later": pa.array([later[a:b].astype(np.uint8).tobytes() for a, b in cut], pa.binary()),
    }


FOUND = "group int, level int, docs binary, places binary, keys binary, later binary"


def _combined(docs, owners, keys, places, parts, level):
    """Packs of the least document of each window, and FOUND rows of windows that several of these hold."""
    order, several, low = _shared(docs[owners], keys)
    mine = docs[owners][order] == low
    own, k, at = owners[order], keys[order], places[order]
    yield from (("pack", b) for b in _packs(docs, own[mine], k[mine], at[mine], parts))
    if several.any():
        rows = _by_group(docs[own[several]], at[several], k[several], ~mine[several], level, parts)
        rows["part"] = pa.array(np.arange(len(rows["group"])) % parts, pa.int32())
        yield "found", rows


def _answers(level: int, groups: int):
    """FOUND rows for every window of a part that several documents hold, ``later`` where an earlier one does."""

    def run(group: pa.Table) -> pa.Table:
        own = group.column("group").is_valid()
        passed = group.filter(own).select(["group", "level", "docs", "places", "keys", "later"])
        packs = group.filter(pa.compute.invert(own))
        if not packs.num_rows:
            return passed
        doc, key, place = _unpacked(packs, np.uint64)
        order, several, low = _shared(doc, key)
        doc, key, place = doc[order][several], key[order][several], place[order][several]
        return pa.concat_tables([passed, pa.table(_by_group(doc, place, key, doc > low[several], level, groups))])

    return run


def _both(batches, kind):
    """One schema for packs and FOUND rows, so that a task can give either."""
    for name, batch in batches:
        got = {c: batch.column(c) for c in batch.schema.names} if isinstance(batch, pa.RecordBatch) else batch
        n = len(next(iter(got.values())))
        yield pa.RecordBatch.from_arrays([got.get(f.name, pa.nulls(n, f.type)) for f in kind], names=kind.names)


_MIXED = pa.schema([("part", pa.int32()), ("docs", pa.binary()), ("keys", pa.binary()), ("owners", pa.binary()), ("places", pa.binary()), ("group", pa.int32()), ("level", pa.int32()), ("later", pa.binary())])
MIXED = f"{PACK}, group int, level int, later binary"


def _sieve(parts: int):
    """Packs of the sieve windows; the key is the upper half of the hash, no places are sent."""

    def run(batches):
        for batch in chunks(batches, most=BLOCK_BYTES):
            docs = batch.column("doc_id").to_numpy()
            who, keys = [], []
            start = 0
            for piece in chunks([batch]):
                w = Words(piece.column("text"))
                hashes, at = w.windows(SIEVE)
                least = _least(hashes, at, w.row[at])
                who.append(w.row[at[least]] + start)
                keys.append(hashes[least])
                start += piece.num_rows
            owners, key = np.concatenate(who), np.concatenate(keys)
            part = (key % np.uint64(parts)).astype(np.int64)
            order = np.lexsort((key, owners, part))
            part, owners, key = part[order], owners[order], (key[order] >> np.uint64(32)).astype(np.uint32)
            cut = np.searchsorted(part, np.arange(parts + 1))
            rows = [[], [], [], []]
            for p in np.flatnonzero(np.diff(cut)).tolist():
                a, b = cut[p], cut[p + 1]
                ids, local = np.unique(owners[a:b], return_inverse=True)
                for row, value in zip(rows, (p, docs[ids].tobytes(), key[a:b].tobytes(), local.astype(np.int32).tobytes())):
                    row.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), *(pa.array(r, pa.binary()) for r in rows[1:])], names=["part", "docs", "keys", "owners"])

    return run


def _group(doc: np.ndarray, groups: int) -> np.ndarray:
    """Which of ``groups`` a document belongs to; as :func:`_group_of`."""
    x = doc.astype(np.int64).view(np.uint64)
    for by in (7, 15, 31):
        x = x ^ (x >> np.uint64(by))
    return ((x >> np.uint64(1)) % np.uint64(groups)).astype(np.int64)


def _group_of(doc: str, groups: int):
    x = F.col(doc)
    for by in (7, 15, 31):
        x = x.bitwiseXOR(F.shiftrightunsigned(x, by))
    return (F.shiftrightunsigned(x, 1) % groups).cast("int")


def _sieved(groups: int):
    """For each group of documents, the sieve keys of a part that several documents have: one row a group and part."""

    def run(packs: pa.Table) -> pa.Table:
        doc, key = [], []
        for docs, keys, owners in zip(*(packs.column(c).to_pylist() for c in ("docs", "keys", "owners"))):
            doc.append(np.frombuffer(docs, np.int64)[np.frombuffer(owners, np.int32)])
            key.append(np.frombuffer(keys, np.uint32))
        doc, key = np.concatenate(doc), np.concatenate(key)
        order, several, _ = _shared(doc, key)
        doc, key = doc[order][several], key[order][several]
        group = _group(doc, groups)
        order = np.lexsort((key, doc, group))
        group, doc, key = group[order], doc[order], key[order]
        runs = _runs(group)
        cut = list(zip(runs[:-1].tolist(), runs[1:].tolist()))
        part = packs.column("part")[0].as_py()
        return pa.table({
            "group": pa.array(group[runs[:-1]], pa.int32()),
            "part": pa.array([part] * len(cut), pa.int32()),
            "docs": pa.array([doc[a:b].tobytes() for a, b in cut], pa.binary()),
            "keys": pa.array([key[a:b].tobytes() for a, b in cut], pa.binary()),
        })

    return run


class _Known:
    """What a group's documents have: repeated sieve keys, and texts that are exact copies of an earlier document's."""

    def __init__(self, rows: list[pa.RecordBatch]):
        doc, name, self.copies = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], {}
        for batch in rows:
            for r in batch.select(["part", "docs", "keys", "doc_id", "copies"]).to_pylist():
                if r["part"] is None:
                    self.copies[r["doc_id"]] = set(r["copies"])
                else:
                    doc.append(np.frombuffer(r["docs"], np.int64))
                    name.append(np.frombuffer(r["keys"], np.uint32).astype(np.uint64) | np.uint64(r["part"]) << np.uint64(32))
        doc, name = np.concatenate(doc), np.concatenate(name)
        order = np.lexsort((name, doc))
        doc, self.names = doc[order], name[order]
        self.runs = _runs(doc)
        self.docs = doc[self.runs[:-1]]

    def texts(self, rows: pa.RecordBatch) -> tuple[pa.RecordBatch, list[np.ndarray]]:
        """The rows that have repeated keys and are no copies, and their keys, sorted."""
        docs = rows.column("doc_id").to_numpy()
        at = np.minimum(np.searchsorted(self.docs, docs), max(len(self.docs) - 1, 0))
        some = self.docs[at] == docs if len(self.docs) else np.zeros(len(docs), dtype=bool)
        if self.copies:
            some &= [d not in self.copies or i not in self.copies[d] for d, i in zip(docs.tolist(), rows.column("id").to_pylist())]
        return rows.filter(pa.array(some)), [self.names[self.runs[k] : self.runs[k + 1]] for k in at[some].tolist()]


def _first_level(parts: int):
    """Candidates of level WINDOW; the rows of a group come together, what is known of its documents before their texts."""

    def run(batches):
        current, told, known = None, [], None
        for group, is_told, rows in _streams(batches, lambda b: pa.compute.or_(b.column("part").is_valid(), b.column("copies").is_valid())):
            if group != current:
                current, told, known = group, [], None
            if is_told:
                told.append(rows)
                continue
            if known is None:
                known, told = _Known(told), []
            for block in chunks([rows], most=BLOCK_BYTES):
                yield from found(*known.texts(block))

    def found(batch: pa.RecordBatch, known: list[np.ndarray]):
        if batch.num_rows:
            docs = batch.column("doc_id").to_numpy()
            who, keys, places, start = [], [], [], 0
            for piece in chunks([batch]):
                w = Words(piece.column("text"))
                hashes, at = w.windows(SIEVE)
                row = w.row[at]
                least = _least(hashes, at, row)
                name = (hashes[least] >> np.uint64(32)) | (hashes[least] % np.uint64(parts)) << np.uint64(32)
                hit = np.zeros(len(w.hashes) + 1, dtype=np.int64)
                cut = np.searchsorted(row[least], np.arange(piece.num_rows + 1))
                for k in range(piece.num_rows):
                    a, b = cut[k], cut[k + 1]
                    if b > a:
                        mine = known[start + k]
                        spot = np.minimum(np.searchsorted(mine, name[a:b]), len(mine) - 1)
                        hit[at[least[a:b]][mine[spot] == name[a:b]]] = 1
                # A 13-word window is a candidate when a repeated sieve window starts in its first seven words.
                before = np.append(0, np.cumsum(hit))
                long, first = w.windows(WINDOW)
                some = before[first + WINDOW - SIEVE + 1] > before[first]
                who.append(w.row[first[some]] + start)
                keys.append(long[some])
                places.append(first[some] - w.first[w.row[first[some]]])
                start += piece.num_rows
            yield from _both(_combined(docs, np.concatenate(who), np.concatenate(keys), np.concatenate(places), parts, WINDOW), _MIXED)

    return run


def _streams(batches, told):
    """Slices of one group and kind, in order: (group, whether ``told`` holds for its rows, rows)."""
    for batch in batches:
        if batch.num_rows:
            group, is_told = batch.column("group").to_numpy(), np.asarray(told(batch))
            cuts = np.flatnonzero((group[1:] != group[:-1]) | (is_told[1:] != is_told[:-1])) + 1
            for a, b in zip(np.append(0, cuts).tolist(), np.append(cuts, len(group)).tolist()):
                yield int(group[a]), bool(is_told[a]), batch.slice(a, b - a)


def _entries(rows: list[pa.RecordBatch], names: dict[str, type]) -> list[np.ndarray]:
    """The arrays packed in binary columns, over all rows."""
    return [np.concatenate([np.zeros(0, kind), *(np.frombuffer(x, kind) for r in rows for x in r.column(name).to_pylist())]) for name, kind in names.items()]


def _next_level(parts: int, length: int):
    """Candidates of twice ``length`` from the repeated windows of each document; the rows of a group come together."""

    def found(rows):
        doc, place, key = _entries(rows, {"docs": np.int64, "places": np.int32, "keys": np.uint64})
        docs, owner = np.unique(doc, return_inverse=True)
        spot, index = np.unique(owner.astype(np.int64) << np.int64(32) | place.astype(np.int64), return_index=True)
        key = key[index]
        after = np.minimum(np.searchsorted(spot, spot + length), max(len(spot) - 1, 0))
        pair = np.flatnonzero(spot[after] == spot + length)
        if len(pair):
            keys = mix(key[pair] * np.uint64(0x9E3779B97F4A7C15) + key[after[pair]])
            yield from _both(_combined(docs, spot[pair] >> np.int64(32), keys, spot[pair] & np.int64(0xFFFFFFFF), parts, 2 * length), _MIXED)

    def run(batches):
        current, held = None, []
        for group, _, rows in _streams(batches, lambda b: b.column("group").is_valid()):
            if group != current:
                yield from found(held)
                current, held = group, []
            held.append(rows)
        yield from found(held)

    return run


def _level(mixed: DataFrame, level: int, groups: int) -> DataFrame:
    """FOUND rows of a level, in the shared folder; what a task has answered itself passes through."""
    return stored(mixed.groupBy("part").applyInArrow(_answers(level, groups), FOUND), f"found-{level}")


def repeated_windows(docs: DataFrame, copies: DataFrame) -> list[DataFrame]:
    """For each level from WINDOW on, FOUND rows of its repeated windows: one for each group of documents and part.

    ``docs``: doc_id (long) and text (string), neither null.  ``copies`` names by doc_id the
    digests of texts that are exact copies; they pass the sieve but are no candidates.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packs = docs.mapInArrow(_sieve(parts), "part int, docs binary, keys binary, owners binary")
    sieved = packs.groupBy("part").applyInArrow(_sieved(parts), "group int, part int, docs binary, keys binary")
    found, length = [], WINDOW
    # Texts and what is known of them are dealt by group; nothing has a row per document and part.
    columns = {"group": "int", "part": "int", "docs": "binary", "keys": "binary", "copies": "array<binary>", "doc_id": "bigint", "id": "binary", "text": "string"}
    texts = docs.withColumns({"group": _group_of("doc_id", parts), "id": digest()})
    copied = copies.withColumn("group", _group_of("doc_id", parts))
    mixed = _dealt([sieved, copied], texts, columns).mapInArrow(_first_level(parts), MIXED)
    while True:
        level = _level(mixed, length, parts)
        found.append(level)
        if level.isEmpty():
            return found
        dealt = level.select("group", "docs", "places", "keys").repartition("group").sortWithinPartitions("group")
        mixed = dealt.mapInArrow(_next_level(parts, length), MIXED)
        length *= 2


def _dealt(told: list[DataFrame], texts: DataFrame, columns: dict[str, str]) -> DataFrame:
    """All rows dealt by group, those that tell of a group's documents before its texts."""
    sides = [
        df.select(*(F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in columns.items()), F.lit(df is texts).alias("is_text"))
        for df in (*told, texts)
    ]
    return reduce(DataFrame.unionAll, sides).repartition("group").sortWithinPartitions("group", "is_text")


class _Marks:
    """What a group's documents lose: places of later windows, whole copies, and the greatest repeated level."""

    def __init__(self, rows: list[pa.RecordBatch]):
        self.copies, doc, place, self.longest = {}, [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], {}
        for batch in rows:
            for r in batch.select(["level", "docs", "places", "later", "doc_id", "copies"]).to_pylist():
                if r["level"] is None:
                    self.copies[r["doc_id"]] = set(r["copies"])
                    continue
                docs = np.frombuffer(r["docs"], np.int64)
                for d in np.unique(docs).tolist():
                    self.longest[d] = max(self.longest.get(d, 0), r["level"])
                if r["level"] == WINDOW:
                    gone = np.frombuffer(r["later"], np.uint8) == 1
                    doc.append(docs[gone])
                    place.append(np.frombuffer(r["places"], np.int32)[gone].astype(np.int64))
        doc, place = np.concatenate(doc), np.concatenate(place)
        order = np.argsort(doc, kind="stable")
        self.docs, self.places = doc[order], place[order]

    def lost(self, doc_id, digest, n: int) -> np.ndarray:
        """Which of the n words go."""
        gone = np.zeros(n, dtype=bool)
        if doc_id is None:
            return gone
        if digest in self.copies.get(doc_id, ()):
            gone[:] = n >= WINDOW
            return gone
        a, b = np.searchsorted(self.docs, doc_id, "left"), np.searchsorted(self.docs, doc_id, "right")
        if b > a:
            # Another text of the same doc_id may be longer.
            edge = np.bincount(self.places[a:b], minlength=n + 1)[: n + 1] - np.bincount(self.places[a:b] + WINDOW, minlength=n + 1)[: n + 1]
            gone = np.cumsum(edge[:n]) > 0
        return gone


def _removal(batches):
    """What is left of every document, and the digest columns; what is lost is told before the texts of a group."""
    current, told, marks = None, [], None
    for group, is_text, rows in _streams(batches, lambda b: b.column("is_text")):
        if group != current:
            current, told, marks = group, [], None
        if not is_text:
            told.append(rows)
            continue
        if marks is None:
            marks, told = _Marks(told), []
        for batch in chunks([rows]):
            yield _left(batch, marks)


def _left(batch: pa.RecordBatch, marks: _Marks) -> pa.RecordBatch:
    w = Words(batch.column("text"))
    docs, ids = batch.column("doc_id").to_pylist(), batch.column("id").to_pylist()
    words, gone, digests, texts = [], [], [], []
    for k in range(batch.num_rows):
        a, b = int(w.first[k]), int(w.first[k + 1])
        lost = marks.lost(docs[k], ids[k], b - a)
        raw = w.data[w.offsets[k] : w.offsets[k + 1]].tobytes()
        base = w.offsets[k]
        left = np.flatnonzero(~lost) + a
        kept = b" ".join(raw[x - base : y - base] for x, y in zip(w.starts[left].tolist(), w.ends[left].tolist()))
        words.append(b - a)
        gone.append(int(lost.sum()))
        digests.append(hashlib.sha256(kept).hexdigest())
        texts.append(kept)
    longest = [marks.longest.get(d, 0) for d in docs]
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), pa.array(words, pa.int64()), pa.array(gone, pa.int64()), pa.array(digests), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(longest, pa.int32())],
        names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text", "longest"],
    )


def substring_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept_text and longest of every document."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sure = rows.where("doc_id IS NOT NULL AND text IS NOT NULL")
    ids = sure.select("doc_id", digest().alias("digest"))
    least = ids.groupBy("digest").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most")
    copies = stored(ids.join(least, "digest").where("doc_id > least").groupBy("doc_id").agg(F.collect_set("digest").alias("copies")), "copies")
    levels = repeated_windows(sure, copies)
    # The texts move once more; rows without a doc_id lose nothing and are dealt by text.
    columns = {"group": "int", "level": "int", "docs": "binary", "places": "binary", "later": "binary", "copies": "array<binary>", "doc_id": "bigint", "id": "binary", "text": "string"}
    found = reduce(DataFrame.unionAll, [x.drop("keys") for x in levels])
    copied = copies.withColumn("group", _group_of("doc_id", parts))
    dealt_by = F.coalesce(_group_of("doc_id", parts), F.pmod(F.xxhash64("text"), F.lit(parts)).cast("int"))
    texts = rows.withColumns({"group": dealt_by, "id": digest()})
    out = _dealt([found, copied], texts, columns)
    return out.mapInArrow(_removal, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string, longest int")


def op5_substring_dedup(docs: DataFrame) -> DataFrame:
    """The digest of substring dedup for every document."""
    return substring_dedup(docs).select("doc_id", "n_words", "n_removed", "kept_sha256", "longest")
