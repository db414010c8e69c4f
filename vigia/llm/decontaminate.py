"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Seeds are the 3-word grams of the test items, all of them: a copy that is edited or
partial may keep any of an item's grams, also only common ones.  A document that
holds a seed is aligned with the item, the whole of one with the whole of the other:
Smith-Waterman over words (match 2, mismatch and gap -1).  A pair is contaminated
when the best local score is at least ``LEAST_SHARE`` of what the whole item would
score, or when the aligned part scores like ``LEAST_RUN`` words copied without a
change.  A copy without three words in a row of the item has no seed.

Common grams cost little, since a stretch of a document is aligned only when the
words that it shares with the item could score enough, a bound that loses no pair.
No alignment is longer than three items (each word of a gap has to be paid by a
match), so documents are cut into stretches of five items that overlap by three.

Items are taken in blocks of at most ``BLOCK_WORDS`` words, each broadcast and
held against all documents in one pass without a shuffle, so a benchmark of any
size is only more passes.  Items longer than a block stand alone in one.

Words are runs of letters and digits, A-Z as a-z.  Items and documents of fewer
than three words have no seeds.  Null texts are empty.  Repeated documents give
repeated pairs; repeated items are separate.  Only ids and texts are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigia.llm.common import Words, chunks, digest

SEED = 3
MATCH, MISMATCH, GAP = 2, -1, -1
LEAST_SHARE = 0.5
LEAST_RUN = 13
BLOCK_WORDS = 200_000
#: Words of document stretches, and cells of an alignment's row, that are worked on at a time.
CELLS = 1 << 18


class Items:
    """Word hashes of some items, which items hold each gram, and how often each holds each word."""

    def __init__(self, ids: list, words: list[np.ndarray]):
        self.ids = ids
        self.size = np.array([len(w) for w in words], dtype=np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.words = np.concatenate(words) if words else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(words)), self.size)
        self.least = np.minimum(np.ceil(LEAST_SHARE * MATCH * self.size), MATCH * LEAST_RUN).astype(np.int64)
        grams, at = _grams(self.words, item)
        self.grams, place = np.unique(grams, return_inverse=True)
        held = np.unique(place * np.int64(len(ids)) + item[at])
        self.holder = held % len(ids)
        self.holders = np.searchsorted(held, np.arange(len(self.grams) + 1) * np.int64(len(ids)))
        self.vocabulary, code = np.unique(self.words, return_inverse=True)
        self.code = code
        self.entries, self.times = np.unique(item * np.int64(len(self.vocabulary)) + code, return_counts=True)


def blocks(benchmark: DataFrame):
    """The items with a word, in blocks whose words fit in ``BLOCK_WORDS``."""

    def run(batches):
        for batch in chunks(batches):
            w = Words(batch.column("text"), letters=True)
            ends = pa.array(w.first.astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.ListArray.from_arrays(ends, pa.array(w.hashes.view(np.int64)))], names=["item_id", "words"])

    kind = benchmark.schema["item_id"].dataType.simpleString()
    rows = benchmark.select("item_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    hashed = rows.mapInArrow(run, f"item_id {kind}, words array<long>").where(F.size("words") >= SEED)
    ids, words, held = [], [], 0
    for row in hashed.toLocalIterator():  # one partition of the benchmark at a time
        if ids and held + len(row.words) > BLOCK_WORDS:
            yield Items(ids, words)
            ids, words, held = [], [], 0
        ids.append(row.item_id)
        words.append(np.array(row.words, dtype=np.int64).view(np.uint64))
        held += len(row.words)
    if ids:
        yield Items(ids, words)


def _grams(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    from vigia.llm.common import mix

    n = max(len(hashes) - SEED + 1, 0)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(SEED):
        total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n]
    at = np.flatnonzero(owner[:n] == owner[SEED - 1 :][:n])
    return mix(total[at]), at


def _find(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Place of each value, -1 where it is not held."""
    place = np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)
    return np.where(sorted_values[place] == values, place, -1)


def _ranges(first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of some ranges in a line, and the range of each."""
    owner = np.repeat(np.arange(len(size)), size)
    return np.arange(int(size.sum())) + np.repeat(first - (np.cumsum(size) - size), size), owner


def _cuts(cost: np.ndarray, most: int):
    """Slices of consecutive rows that cost at most ``most`` together; a dearer row stands alone."""
    total, start = np.append(0, np.cumsum(cost)), 0
    while start < len(cost):
        end = max(int(np.searchsorted(total, total[start] + most, "right")) - 1, start + 1)
        yield slice(start, end)
        start = end


def smith_waterman(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best local score of every row of ``a`` with the same row of ``b``, and where it ends in ``b``.

    Rows are padded with 0 in ``a`` and 1 in ``b``, which match nothing.
    """
    kind = np.int16 if MATCH * a.shape[1] + b.shape[1] < 1 << 15 else np.int32
    step = -kind(GAP) * np.arange(b.shape[1] + 1, dtype=kind)
    above = np.zeros((len(a), b.shape[1] + 1), dtype=kind)
    best, end = np.zeros(len(a), np.int32), np.zeros(len(a), np.int64)
    for i in range(a.shape[1]):
        here = np.zeros_like(above)
        here[:, 1:] = above[:, :-1] + np.where(a[:, i : i + 1] == b, kind(MATCH), kind(MISMATCH))
        np.maximum(here, above + kind(GAP), out=here)
        np.maximum(here, 0, out=here)
        # A gap along the row: the best of all earlier cells less the way from there.
        above = np.maximum.accumulate(here + step, axis=1) - step
        top = above.max(axis=1)
        better = top > best
        best[better], end[better] = top[better], above[better].argmax(axis=1)
    return best, end


def _pairs(it: Items, w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Row and item of every text and item that share a gram."""
    grams, at = _grams(w.hashes, w.row)
    place = _find(it.grams, grams)
    hit = place >= 0
    found = np.unique(w.row[at[hit]] * np.int64(len(it.grams)) + place[hit])
    gram = found % len(it.grams)
    at, owner = _ranges(it.holders[gram], it.holders[gram + 1] - it.holders[gram])
    found = np.unique((found // len(it.grams))[owner] * np.int64(len(it.ids)) + it.holder[at])
    return found // len(it.ids), found % len(it.ids)


def _best_run(both: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Best score of a run of words in each range, if all words that both sides hold were matched; others cost a gap."""
    x = np.where(both, MATCH, GAP)
    apart = owner * np.int64(2 * MATCH * len(x) + 1)
    upto = np.cumsum(x) - apart
    return np.maximum.reduceat(upto - np.minimum.accumulate(upto - x), np.flatnonzero(np.diff(owner, prepend=-1)))


def _could(it: Items, w: Words, code: np.ndarray, row: np.ndarray, item: np.ndarray) -> np.ndarray:
    """The pairs whose item could score enough by the words that the whole text holds."""
    at = np.flatnonzero(code >= 0)
    held = np.unique(w.row[at] * np.int64(len(it.vocabulary)) + code[at])
    out = [np.zeros(0, np.int64)]
    for cut in _cuts(it.size[item], CELLS):
        place, owner = _ranges(it.first[item[cut]], it.size[item[cut]])
        both = _find(held, row[cut][owner] * np.int64(len(it.vocabulary)) + it.code[place]) >= 0
        out.append(cut.start + np.flatnonzero(_best_run(both, owner) >= it.least[item[cut]]))
    return np.concatenate(out)


def _most(it: Items, code: np.ndarray, item: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """What a stretch could score by the words that its item holds, none of them used more often than the item has it."""
    spot, owner = _ranges(begin, end - begin)
    entry = np.where(code[spot] >= 0, _find(it.entries, item[owner] * np.int64(len(it.vocabulary)) + code[spot]), -1)
    run = _best_run(entry >= 0, owner)
    shared = np.flatnonzero((entry >= 0) & (run >= it.least[item])[owner])
    each, count = np.unique(owner[shared] * np.int64(len(it.entries)) + entry[shared], return_counts=True)
    every = np.bincount(each // len(it.entries), np.minimum(count, it.times[each % len(it.entries)]), len(item))
    return np.minimum(run, MATCH * every.astype(np.int64))


def _scores(it: Items, w: Words, row: np.ndarray, item: np.ndarray) -> np.ndarray:
    """Smith-Waterman score of every row with its item, 0 where it cannot reach the item's least."""
    best = np.zeros(len(row), np.int64)
    code = _find(it.vocabulary, w.hashes)
    could = _could(it, w, code, row, item)
    size, length = it.size[item], w.first[row + 1] - w.first[row]
    for part in _cuts(np.maximum(length // (2 * size), 1)[could], CELLS):
        some = could[part]
        number, pair = _ranges(np.zeros(len(some), np.int64), np.maximum(-((3 * size[some] - length[some]) // (2 * size[some])), 1))
        pair = some[pair]
        begin = w.first[row[pair]] + 2 * size[pair] * number
        end = np.minimum(begin + 5 * size[pair], w.first[row[pair] + 1])
        good = [np.zeros(0, np.int64)]
        for cut in _cuts(end - begin, CELLS):
            most = _most(it, code, item[pair[cut]], begin[cut], end[cut])
            good.append(cut.start + np.flatnonzero(most >= it.least[item[pair[cut]]]))
        good = np.concatenate(good)
        good = good[np.argsort(size[pair[good]], kind="stable")]
        for cut in _cuts(5 * size[pair[good]], CELLS):
            at = good[cut]
            own, first = size[pair[at]], it.first[item[pair[at]]]
            left = np.zeros((len(at), int(own.max())), np.uint64)
            spot, owner = _ranges(first, own)
            left[owner, spot - first[owner]] = it.words[spot]
            right = np.ones((len(at), int((end - begin)[at].max())), np.uint64)
            spot, owner = _ranges(begin[at], (end - begin)[at])
            right[owner, spot - begin[at][owner]] = w.hashes[spot]
            np.maximum.at(best, pair[at], smith_waterman(left, right)[0])
    return best


def aligned(docs: DataFrame, items: Items) -> DataFrame:
    """doc_id, item_id, score, share of every contaminated document and item of the block."""
    shipped = docs.sparkSession.sparkContext.broadcast(items)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        it = shipped.value
        for batch in chunks(batches):
            w = Words(batch.column("text"), letters=True)
            row, item = _pairs(it, w)
            best = _scores(it, w, row, item)
            good = best >= it.least[item]
            row, item, best = row[good], item[good], best[good]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row)), pa.array([it.ids[k] for k in item.tolist()], pa.int64()), pa.array(best, pa.int64()), pa.array(best / (MATCH * it.size[item]))],
                names=["doc_id", "item_id", "score", "share"],
            )

    narrow = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, f"doc_id {kind}, item_id long, score long, share double")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Every contaminated pair: doc_id, item_id, score, share of the item's own score."""
    out = None
    for items in blocks(benchmark):
        pairs = aligned(docs, items)
        out = pairs if out is None else out.unionByName(pairs)
    if out is None:
        out = docs.where("1 = 0").select("doc_id", F.lit(0).cast("long").alias("item_id"), F.lit(0).cast("long").alias("score"), F.lit(0.0).alias("share"))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a contaminated pair, with all their columns; those of one id, or of none, each by its own text."""
    named = docs.select(F.struct("doc_id", digest().alias("digest")).alias("doc_id"), "text")
    bad = contaminated(named, benchmark).select(F.col("doc_id.doc_id").alias("__bad"), F.col("doc_id.digest").alias("__digest")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["__bad"]) & (digest() == bad["__digest"]), "left_anti")
