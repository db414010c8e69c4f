"""Near-duplicate detection with ProbMinHash.

A text is its 5-word shingles, weighted by how often each occurs (a shorter text
is one shingle).  Every shingle sends a Poisson process of arrivals, as fast as
its weight, to ``COMPONENTS`` components; a component keeps the first arrival.
Two texts agree in a component with the probability Jaccard similarity of their
weights.  Arrivals that come after every component has an earlier one are never
drawn.

Candidates share one of ``BANDS`` bands of ``ROWS`` components (a pair at similarity
0.8 is missed with a probability of 3e-6).  A pair is a link when its exact probability
Jaccard similarity is at least ``SIMILAR``.  First one member of every bucket, chosen by
a hash that differs from bucket to bucket, leads, and each text is compared with the
leader that shares most bands with it, which joins most copies in one linear pass.
Then every bucket that still holds several components is finished exactly: its
largest component and the rest are dealt into blocks of about ``BLOCK`` members, the
rest meets itself and the largest component block by block, and a pair in different
components goes on when the bucket is the first that both share and its sketches
allow the similarity.  The largest component never meets itself, so a bucket of
copies costs nothing, however large.  A sketch holds the parity of a text's distinct
shingles in ``BITS`` bits, which bounds from below in how many shingles two texts
differ, and its ``HEAVY`` most repeated shingles.  Together they bound the similarity
from above (:func:`may_be_similar`), so no link is dropped.  What passes is verified
where it meets, on the shingles themselves, and only links that join components of
the block leave the task: fewer than it has members.  Texts of more than ``SENT``
shingles are not sent along; pairs with one are verified on the texts afterwards.

Exact copies are one text from the start.  Result: a row for each document with
``class_id``, the least doc_id of its component (null only if it has none), and
``copy_id``, the least doc_id with the same text.  Null texts, and texts without a
word, are like their exact copies only.  Words lie between white space, unchanged.
Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigia.llm.common import Words, chunks, components, digest, merged, mix, sifted, stored

SHINGLE = 5
SIMILAR = 0.8
BANDS, ROWS = 24, 4
COMPONENTS = BANDS * ROWS
#: Members of a block of an open bucket, and bits of a sketch.
BLOCK, BITS = 256, 1024
#: Repeated shingles that a sketch names.
HEAVY = 8
#: Most shingles of a text that travel with its sketch.
SENT = 4096


def shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, weight) of every distinct shingle of every row, in order of row and hash."""
    w = Words(column)
    hashes, at = w.windows(SHINGLE)
    row = w.row[at]
    sizes = np.diff(w.first)
    short = np.flatnonzero((sizes > 0) & (sizes < SHINGLE))
    if len(short):
        whole = np.zeros(len(short), dtype=np.uint64)
        for k in range(SHINGLE - 1):
            has = sizes[short] > k
            whole[has] = mix(whole[has] * np.uint64(31) + w.hashes[w.first[short[has]] + k])
        hashes, row = np.concatenate([hashes, whole]), np.concatenate([row, short])
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    new = np.flatnonzero(np.append(True, (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1]))) if len(row) else np.zeros(0, np.int64)
    return row[new], hashes[new], np.diff(np.append(new, len(row))).astype(np.float64)


def signatures(row: np.ndarray, hashes: np.ndarray, weights: np.ndarray, rows: int) -> np.ndarray:
    """ProbMinHash signature (rows x COMPONENTS) of weighted shingles; 0 for rows without any."""
    first = np.full(rows * COMPONENTS, np.inf)
    winner = np.zeros(rows * COMPONENTS, dtype=np.uint64)
    time = np.zeros(len(row))
    draw = 0
    while len(row):
        draw += 1
        bits = mix(hashes + np.uint64(draw * 0x9E3779B97F4A7C15 & (2**64 - 1)))
        time = time - np.log((bits >> np.uint64(11)).astype(np.float64) * 2.0**-53 + 2.0**-54) / weights
        slot = row * COMPONENTS + (mix(bits ^ np.uint64(0xD6E8FEB86659FD93)) % np.uint64(COMPONENTS)).astype(np.int64)
        np.minimum.at(first, slot, time)
        won = first[slot] == time
        winner[slot[won]] = hashes[won]
        # A shingle whose arrival is later than all components' first has nothing more to give.
        latest = first.reshape(rows, COMPONENTS).max(axis=1)
        live = time <= latest[row]
        row, hashes, weights, time = row[live], hashes[live], weights[live], time[live]
    return winner.reshape(rows, COMPONENTS)


def sketches(row: np.ndarray, hashes: np.ndarray, weights: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row, parity sketch (rows x BITS / 64) and (rows x 3 + 2 HEAVY) what :func:`may_be_similar` asks.

    The latter: distinct shingles, their total weight, the most that a shingle not
    named can weigh, then the most repeated shingles and then their weights (0: none).
    """
    bit = mix(hashes ^ np.uint64(0xA24BAED4963EE407)) % np.uint64(BITS)
    sketch = np.zeros(rows * BITS // 64, dtype=np.uint64)
    np.bitwise_xor.at(sketch, row * (BITS // 64) + (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
    facts = np.zeros((rows, 3 + 2 * HEAVY), dtype=np.int64)
    facts[:, 0] = np.bincount(row, minlength=rows)
    facts[:, 1] = np.bincount(row, weights, minlength=rows)
    facts[:, 2] = 1
    often = np.flatnonzero(weights > 1)
    often = often[np.lexsort((hashes[often], -weights[often], row[often]))]
    own = row[often]
    first = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else np.zeros(0, np.int64)
    rank = np.arange(len(own)) - np.repeat(first, np.diff(np.append(first, len(own))))
    named, next_one = rank < HEAVY, rank == HEAVY
    facts[own[named], 3 + rank[named]] = hashes[often[named]].view(np.int64)
    facts[own[named], 3 + HEAVY + rank[named]] = weights[often[named]].astype(np.int64)
    facts[own[next_one], 2] = weights[often[next_one]].astype(np.int64)
    return sketch.reshape(rows, -1), facts


def may_be_similar(x: np.ndarray, y: np.ndarray, facts_x: np.ndarray, facts_y: np.ndarray) -> np.ndarray:
    """False only for pairs of sketches whose texts are surely less similar than SIMILAR.

    Two bounds from above hold for the probability Jaccard similarity of weights x, y:

    * the part of sum(max(x, y)) that common shingles have.  At least as many
      shingles as the parities differ in are not common, each with weight 1 or more,
      and sum(max) is at most the shingles of both plus all repeats, those that
      both name counted once;
    * one minus the distance in variation of x / sum(x) and y / sum(y), as for any
      two draws that agree: what the named shingles show of it.
    """
    differ = np.maximum(np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64), np.abs(facts_x[:, 0] - facts_y[:, 0]))
    shingles_of_both = facts_x[:, 0] + facts_y[:, 0]
    most = (shingles_of_both + differ) / 2 + (facts_x[:, 1] + facts_y[:, 1] - shingles_of_both)
    enough, slack = np.ones(len(x), dtype=bool), 1e-9
    repeat = np.flatnonzero((facts_x[:, 1] > facts_x[:, 0]) | (facts_y[:, 1] > facts_y[:, 0]))
    for start in range(0, len(repeat), 1 << 15):
        at = repeat[start : start + (1 << 15)]
        p, q = facts_x[at], facts_y[at]
        names_p, names_q, heavy_p, heavy_q = p[:, 3 : 3 + HEAVY], q[:, 3 : 3 + HEAVY], p[:, 3 + HEAVY :], q[:, 3 + HEAVY :]
        same = (names_p[:, :, None] == names_q[:, None, :]) & (heavy_p[:, :, None] > 0) & (heavy_q[:, None, :] > 0)
        # Weight of each named shingle in the other text: as named there, or at most the rest.
        in_q = np.where(same.any(axis=2), (same * heavy_q[:, None, :]).sum(axis=2), q[:, 2:3])
        in_p = np.where(same.any(axis=1), (same * heavy_p[:, :, None]).sum(axis=1), p[:, 2:3])
        most[at] -= np.where(same.any(axis=2), np.minimum(heavy_p, in_q) - 1, 0).sum(axis=1)
        apart_p = np.where(heavy_p > 0, heavy_p / p[:, 1:2] - in_q / q[:, 1:2], 0).clip(min=0).sum(axis=1)
        apart_q = np.where(heavy_q > 0, heavy_q / q[:, 1:2] - in_p / p[:, 1:2], 0).clip(min=0).sum(axis=1)
        enough[at] = 1 - np.maximum(apart_p, apart_q) >= SIMILAR - slack
    return enough & (most - differ >= (SIMILAR - slack) * most)


def _lists(rows: np.ndarray) -> pa.ListArray:
    ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1])
    return pa.ListArray.from_arrays(ends, pa.array(rows.reshape(-1).view(np.int64)))


def _bands(batches):
    for batch in chunks(batches):
        row, hashes, weights = shingles(batch.column("text"))
        some = np.bincount(row, minlength=batch.num_rows) > 0
        sign = signatures(row, hashes, weights, batch.num_rows)[some].reshape(-1, BANDS, ROWS)
        sketch, facts = sketches(row, hashes, weights, batch.num_rows)
        key = np.zeros(sign.shape[:2], dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)
        for k in range(ROWS):
            key = mix(key * np.uint64(31) + sign[:, :, k])
        yield pa.RecordBatch.from_arrays([batch.column("id").filter(pa.array(some)), _lists(key), _lists(sketch[some]), _lists(facts[some])], names=["id", "bands", "sketch", "facts"])


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact probability Jaccard similarity of two sets of (sorted hashes, weights)."""
    common, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    wa, wb = a[1][i], b[1][j]
    only_a, only_b = a[1].sum() - wa.sum(), b[1].sum() - wb.sum()
    total = 0.0
    for ratio in np.unique(wb / wa):
        same = wb / wa == ratio
        total += wa[same].sum() / (np.maximum(wa, wb / ratio).sum() + only_a + only_b / ratio)
    return float(total)


def _verify(batches):
    for batch in chunks(batches, "text_a"):
        sides = []
        for name in ("text_a", "text_b"):
            row, hashes, weights = shingles(batch.column(name))
            cut = np.searchsorted(row, np.arange(batch.num_rows + 1))
            sides.append([(hashes[x:y], weights[x:y]) for x, y in zip(cut[:-1], cut[1:])])
        like = pa.array(np.array([similarity(x, y) for x, y in zip(*sides)]) >= SIMILAR)
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(like), batch.column("b").filter(like)], names=["a", "b"])


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of text digests whose exact similarity is enough."""
    left = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    both = left.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(_verify, "a binary, b binary")


def links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Components of near-duplicate texts (id, root) by digest, and the distinct texts (id, doc_id)."""
    rows = docs.where("text IS NOT NULL").select(digest().alias("id"), "doc_id", F.col("text").cast("string").alias("text"))
    owners = stored(rows.groupBy("id").agg(F.min("doc_id").alias("doc_id")), "texts")
    # One row for each distinct text; equal rows of one doc_id are the same text twice.
    texts = rows.select("id", "text")
    bands = texts.mapInArrow(_bands, "id binary, bands array<long>, sketch array<long>, facts array<long>").dropDuplicates(["id"])
    bands = stored(bands, "bands")
    each = bands.select("id", F.explode("bands").alias("band"))
    led = each.groupBy("band").agg(F.min(F.struct(F.xxhash64("id", "band").alias("h"), "id")).alias("l"), F.count(F.lit(1)).alias("n"))
    leaders = stored(led.where("n > 1").select("band", F.col("l.id").alias("b")), "leaders")
    pairs = stored(each.join(leaders, "band").where("id <> b").groupBy(F.col("id").alias("a"), "b").agg(F.count(F.lit(1)).alias("n")), "led-pairs")
    involved = stored(pairs.select(F.col("a").alias("id")).unionAll(pairs.select(F.col("b").alias("id"))).distinct(), "involved")
    some = stored(sifted(texts, involved).dropDuplicates(["id"]), "candidate-texts")
    # Most texts of a family are joined by the leader that shares most bands with them.
    best = pairs.groupBy("a").agg(F.max(F.struct("n", "b")).alias("x")).select("a", F.col("x.b").alias("b"))
    groups = stored(components(verified(best, some), "components"), "groups")
    met = stored(_across(sifted(bands, involved), groups, some), "open-links")
    rest = met.where("NOT sure").select("a", "b").distinct()
    sure = met.where("sure").select("a", "b")
    return merged(groups, sure.unionAll(verified(rest, some)), "groups"), owners


def _sets(batches):
    """The shingles of every text and, where one repeats, their weights; null for a text of more than SENT."""
    for batch in chunks(batches):
        row, hashes, weights = shingles(batch.column("text"))
        cut = np.searchsorted(row, np.arange(batch.num_rows + 1)).tolist()
        spans = list(zip(cut[:-1], cut[1:]))
        names = [hashes[a:b].tobytes() if b - a <= SENT else None for a, b in spans]
        often = [weights[a:b].astype(np.int32).tobytes() if b - a <= SENT and (weights[a:b] > 1).any() else None for a, b in spans]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(names, pa.binary()), pa.array(often, pa.binary())], names=["id", "shingles", "weights"])


def _across(bands: DataFrame, groups: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a > b) of one bucket that join its components, and pairs still to be verified (``sure`` false)."""
    rooted = stored(bands.join(groups, "id", "left").withColumn("root", F.coalesce("root", "id")), "open-bands")
    each = rooted.select("id", "root", F.posexplode("bands").alias("k", "band"))
    # For every bucket its largest component, and how many blocks that and the rest fill.
    parts = each.groupBy("band", "root").agg(F.count(F.lit(1)).alias("n"))
    whole = parts.groupBy("band").agg(F.max(F.struct("n", "root")).alias("main"), F.sum("n").alias("n"))
    whole = whole.where("n > main.n").select(
        "band", F.col("main.root").alias("main"),
        F.ceil((F.col("n") - F.col("main.n")) / BLOCK).alias("others"), F.ceil(F.col("main.n") / BLOCK).alias("mains"),
    )
    within = stored(each.join(whole, "band"), "open-members")
    # What a member brings along meets it once, not in each of its buckets.
    open_ids = within.select("id").distinct()
    wanted = texts.join(open_ids, "id", "left_semi").select("id", "text").mapInArrow(_sets, "id binary, shingles binary, weights binary")
    within = within.join(wanted.join(rooted.select("id", "bands", "sketch", "facts"), "id"), "id")
    dice = F.xxhash64("id", "band")
    slot = F.when(F.col("root") == F.col("main"), F.col("others") + F.pmod(dice, F.col("mains"))).otherwise(F.pmod(dice, F.col("others")))
    within = within.withColumn("slot", slot)
    last = F.when(F.col("slot") < F.col("others"), F.col("others") + F.col("mains")).otherwise(F.col("others")) - 1
    dealt = within.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    dealt = dealt.select("band", "k", F.least("slot", "other").alias("i"), F.greatest("slot", "other").alias("j"), "slot", "id", "root", "facts", "bands", "sketch", "shingles", "weights")
    dealt = dealt.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")
    return dealt.mapInArrow(_met, "a binary, b binary, sure boolean")


def _met(batches):
    """Links and open pairs of every block pair; the rows come in order of (band, i, j)."""
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows]).combine_chunks()
        if rows.num_rows:
            cut = _blocks(rows)
            yield _pairs(rows, cut[:-1])
            held = rows.slice(cut[-2])
    if held is not None:
        yield _pairs(held, _blocks(held))


def _blocks(rows: pa.Table) -> np.ndarray:
    """Where runs of equal (band, i, j) begin, and the end."""
    new = np.zeros(rows.num_rows, dtype=bool)
    new[0] = True
    for name in ("band", "i", "j"):
        x = rows.column(name).to_numpy()
        new[1:] |= x[1:] != x[:-1]
    return np.append(np.flatnonzero(new), rows.num_rows)


def _matrix(column: pa.ChunkedArray, n: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy().reshape(n, -1)


def _pairs(rows: pa.Table, cut: np.ndarray) -> pa.RecordBatch:
    a, b, sure = [], [], []
    if len(cut) > 1:
        rows = rows.slice(0, cut[-1])
        n = rows.num_rows
        ids, roots = rows.column("id").to_pylist(), rows.column("root").to_pylist()
        name = np.frombuffer(b"".join(roots), dtype=np.int64).reshape(n, 2)
        bands, sketch = _matrix(rows.column("bands"), n), _matrix(rows.column("sketch"), n).view(np.uint64)
        facts = _matrix(rows.column("facts"), n)
        slot, k = (rows.column(c).to_numpy() for c in ("slot", "k"))
        names, often = rows.column("shingles").to_pylist(), rows.column("weights").to_pylist()
        own: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def weighted(u: int) -> tuple[np.ndarray, np.ndarray]:
            if u not in own:
                hashes = np.frombuffer(names[u], np.uint64)
                own[u] = hashes, np.ones(len(hashes)) if often[u] is None else np.frombuffer(often[u], np.int32).astype(np.float64)
            return own[u]

        i, j = rows.column("i").to_numpy(), rows.column("j").to_numpy()
        for start, end in zip(cut[:-1].tolist(), cut[1:].tolist()):
            x, y = np.triu_indices(end - start, 1)
            x, y = x + start, y + start
            ok = (name[x] != name[y]).any(axis=1)
            if i[start] != j[start]:
                ok &= slot[x] != slot[y]
            x, y = x[ok], y[ok]
            # Texts that share several buckets meet in the first.
            ok = (bands[x] == bands[y]).argmax(axis=1) == k[start]
            x, y = x[ok], y[ok]
            ok = may_be_similar(sketch[x], sketch[y], facts[x], facts[y])
            x, y = x[ok], y[ok]
            # The most alike first: they join components, and pairs within one need no look.
            order = np.argsort(np.bitwise_count(sketch[x] ^ sketch[y]).sum(axis=1, dtype=np.int64), kind="stable")
            parent: dict[bytes, bytes] = {}

            def root(r: bytes) -> bytes:
                while parent.get(r, r) != r:
                    parent[r] = r = parent.get(parent[r], parent[r])
                return r

            for u, v in zip(x[order].tolist(), y[order].tolist()):
                p, q = root(roots[u]), root(roots[v])
                if p == q:
                    continue
                whole = names[u] is not None and names[v] is not None
                if whole:
                    if similarity(weighted(u), weighted(v)) < SIMILAR:
                        continue
                    parent[p] = q
                a.append(max(ids[u], ids[v]))
                b.append(min(ids[u], ids[v]))
                sure.append(whole)
            own.clear()
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(sure, pa.bool_())], names=["a", "b", "sure"])


def _rooted(docs: DataFrame) -> DataFrame:
    """id (digest), least doc_id and component root of every text."""
    groups, owners = links(docs)
    return owners.join(groups, "id", "left").select("id", "doc_id", F.coalesce("root", "id").alias("root"))


def classes(docs: DataFrame) -> DataFrame:
    """id (digest of a text), class_id and copy_id: least doc_id of its component, and of its exact copies."""
    named = _rooted(docs)
    least = named.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    return named.join(least, "root").select("id", "class_id", F.col("doc_id").alias("copy_id"))


def op3_near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, class_id and copy_id of every document; a null text is a class of its own."""
    rows = docs.select("doc_id", digest().alias("id"))
    return rows.join(classes(docs), "id", "left").select(
        "doc_id", F.when(F.col("id").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(F.col("id").isNull(), F.col("doc_id")).otherwise(F.col("copy_id")).alias("copy_id"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each class, with all columns: the first by doc_id (null last), then by digest; all of null text.

    Of rows that repeat that document (equal doc_id and text) the one of least hash
    stays.  Columns may have any names: the row travels in one column.
    """
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    told_apart = [F.col(f"`{f.name}`") for f in docs.schema if f.dataType.typeName() not in ("map", "variant")]
    rows = docs.select(whole.alias("row"), digest().alias("id"), F.col("doc_id").alias("number"), F.xxhash64(*told_apart).alias("hash"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "id")).alias("f")
    kept = _rooted(docs).groupBy("root").agg(first).select(F.col("f.id").alias("id"))
    # A text's own least row first: copies collapse before the rows are shuffled, once.
    order = F.struct(F.col("number").isNull().alias("absent"), "number", "hash")
    one = rows.where("id IS NOT NULL").groupBy("id").agg(F.min_by("row", order).alias("row")).join(kept, "id", "left_semi")
    return one.select("row.*").unionAll(rows.where("id IS NULL").select("row.*"))
