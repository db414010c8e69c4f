"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary.
A text's likelihood sums over all its segmentations into pieces (the forward
algorithm); the language with the greatest likelihood wins and ``score`` is its
posterior under equal priors.

Training gathers, over all labelled texts, the expected count of each piece when
all segmentations of a word weigh by the same starting probabilities (forward
and backward over each distinct word once per task); counts are then summed by
language and piece.  Their number is bounded by languages times pieces.

No piece crosses a word's blank, so a text's likelihood is the product over its
segments, and each distinct segment is scored once per task.  Runs of more than
``STRETCH`` bytes that no piece boundary cuts are summed whole as well, in logarithms
(a window of the longest piece is kept, whatever the run's length).  Training takes
runs beyond ``TRAINING_STRETCH`` bytes in parts of that length.

Null text, or text without a letter: ``und`` with score 0.  Nothing to learn
from: ``und`` for all.  Equal likelihoods: the language first in order.
Repeated rows are scored one by one; only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigia.llm import pieces
from vigia.llm.common import chunks

BLOCK_BYTES = 8 << 20
CACHE_SEGMENTS = 1_000_000
STRETCH, TRAINING_STRETCH = 40, 1 << 14
#: Probabilities are carried times e^SCALE per byte, which keeps 40 bytes inside a double.
SCALE = 2.5
SMOOTHING = 0.5
UNKNOWN = 1e-4
#: Expected counts are summed as whole thousandths, so the order of sums is of no account.
UNITS = 1000

_held: dict[int, pieces.Automaton] = {}


def _automaton(vocabulary: list[bytes]) -> pieces.Automaton:
    key = hash(tuple(vocabulary))
    if key not in _held:
        _held.clear()
        _held[key] = pieces.Automaton(vocabulary)
    return _held[key]


def _edges(automaton, data, starts, sizes):
    """For each end position, (segments, piece numbers, lengths); a character in no piece is piece ``n``."""
    none = len(automaton.length)
    char = np.zeros(len(starts), dtype=np.int64)
    for end, active, matches in automaton.walk(data, starts, sizes):
        own = starts[:active] + end
        whole = (end == sizes[:active]) | ((data[np.minimum(own, len(data) - 1)] & 0xC0) != 0x80)
        single = np.zeros(active, dtype=bool)
        out = []
        for at, piece in matches:
            length = automaton.length[piece]
            single[at] |= length == end - char[at]
            out.append((at, piece, length))
        at = np.flatnonzero(whole & ~single)
        out.append((at, np.full(len(at), none), end - char[at]))
        char[:active][whole] = end
        yield end, out


def _log_sums(parts: list[tuple[np.ndarray, np.ndarray]], rows: int, width: int) -> np.ndarray:
    """Log of the sum of exponentials by row; ``parts``: (different rows, values) each."""
    most = np.full((rows, width), -np.inf)
    for at, value in parts:
        most[at] = np.maximum(most[at], value)
    shift = np.where(np.isfinite(most), most, 0.0)
    total = np.zeros((rows, width))
    for at, value in parts:
        total[at] += np.exp(value - shift[at])
    with np.errstate(divide="ignore"):
        return np.log(total) + shift


def long_likelihoods(automaton, logs: np.ndarray, data, starts, sizes) -> np.ndarray:
    """:func:`likelihoods` of runs of any length, in logarithms, with a window of the longest piece."""
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    window = int(max(automaton.length.max(initial=1), 4)) + 1
    held = np.full((len(sizes), window, logs.shape[1]), -np.inf)
    held[:, 0] = 0.0
    out = np.empty((len(sizes), logs.shape[1]))
    for end, found in _edges(automaton, data, starts, sizes):
        active = int(np.searchsorted(-sizes, -end, side="right"))
        parts = [(at, held[at, (end - length) % window] + logs[piece]) for at, piece, length in found if len(at)]
        held[:active, end % window] = _log_sums(parts, active, logs.shape[1])
        done = np.flatnonzero(sizes[:active] == end)
        out[order[done]] = held[done, end % window]
    return out


def likelihoods(automaton, logs: np.ndarray, data, starts, sizes) -> np.ndarray:
    """Log of the summed probability of all segmentations: a row per segment, a column per language."""
    long = sizes > STRETCH
    if long.any():
        out = np.empty((len(sizes), logs.shape[1]))
        out[long] = long_likelihoods(automaton, logs, data, starts[long], sizes[long])
        if not long.all():
            out[~long] = likelihoods(automaton, logs, data, starts[~long], sizes[~long])
        return out
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    base = np.cumsum(sizes + 1) - (sizes + 1)
    alpha = np.zeros((int((sizes + 1).sum()), logs.shape[1]))
    alpha[base] = 1.0
    lengths = np.append(automaton.length, 1)
    scaled = np.exp(logs + SCALE * lengths[:, None])
    for end, found in _edges(automaton, data, starts, sizes):
        for at, piece, length in found:
            step = scaled[piece]
            if len(piece) and piece[0] == len(automaton.length):
                step = step * np.exp(SCALE * (length - 1))[:, None]
            alpha[base[at] + end] += alpha[base[at] + end - length] * step
    out = np.empty((len(sizes), logs.shape[1]))
    with np.errstate(divide="ignore"):
        out[order] = np.maximum(np.log(alpha[base + sizes]), -745.0) - SCALE * sizes[:, None]
    return out


def expected(automaton, data, starts, sizes, weights: np.ndarray) -> np.ndarray:
    """Expected piece counts (piece, language) when every piece is as likely; ``weights``: copies by language."""
    count = len(automaton.length) + 1
    total = np.zeros((count, weights.shape[1]))
    flat = np.full(count, 1.0 / count)
    flat[-1] *= UNKNOWN
    long = sizes > STRETCH
    for k in np.flatnonzero(long).tolist():
        total += _long_expected(automaton, np.log(flat), data, starts[k : k + 1], sizes[k : k + 1])[:, None] * weights[k]
    starts, sizes, weights = starts[~long], sizes[~long], weights[~long]
    for a in range(0, len(starts), 50_000):
        order = a + np.argsort(-sizes[a : a + 50_000], kind="stable")
        s, z, w = starts[order], sizes[order], weights[order]
        base = np.cumsum(z + 1) - (z + 1)
        alpha, beta = np.zeros(int((z + 1).sum())), np.zeros(int((z + 1).sum()))
        alpha[base], beta[base + z] = 1.0, 1.0
        kept = []
        for end, found in _edges(automaton, data, s, z):
            for at, piece, length in found:
                step = flat[piece] * np.exp(SCALE * length)
                alpha[base[at] + end] += alpha[base[at] + end - length] * step
                kept.append((end, at, piece, length, step))
        whole = alpha[base + z]
        for end, at, piece, length, step in reversed(kept):
            to, of = base[at] + end, base[at] + end - length
            share = alpha[of] * step * beta[to] / whole[at]
            beta[of] += step * beta[to]
            for k in range(w.shape[1]):
                total[:, k] += np.bincount(piece, weights=share * w[at, k], minlength=count)
    return total


def _long_expected(automaton, logs: np.ndarray, data, start, size) -> np.ndarray:
    """Expected piece counts of one run of any length, in logarithms."""
    n = int(size[0])
    ahead, behind = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
    ahead[0] = behind[n] = 0.0
    kept = []
    for end, found in _edges(automaton, data, start, size):
        piece = np.concatenate([p for at, p, _ in found if len(at)] or [np.zeros(0, np.int64)])
        length = np.concatenate([z for at, _, z in found if len(at)] or [np.zeros(0, np.int64)])
        if len(piece):
            ahead[end] = np.logaddexp.reduce(ahead[end - length] + logs[piece])
        kept.append((end, piece, length))
    total = np.zeros(len(logs))
    for end, piece, length in reversed(kept):
        if len(piece) and np.isfinite(behind[end]):
            of = end - length  # pieces that end here have different lengths
            np.add.at(total, piece, np.exp(ahead[of] + logs[piece] + behind[end] - ahead[n]))
            behind[of] = np.logaddexp(behind[of], logs[piece] + behind[end])
    return total


class Model:
    """Languages in order, and log probabilities (piece, language), the last row for characters in no piece."""

    def __init__(self, vocabulary: list[bytes], languages: list[str], logs: np.ndarray):
        self.vocabulary, self.languages, self.logs = vocabulary, languages, logs


def train(labelled: DataFrame, model_file: str = pieces.MODEL_FILE) -> Model:
    """Learn from all rows of ``labelled`` (text, lang) in which neither is null."""
    vocabulary = [p for p, _, _ in pieces.load(model_file)]
    shipped = labelled.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches):
        automaton = _automaton(shipped.value)
        names: dict[str, int] = {}
        sums: dict[str, np.ndarray] = {}

        def empty():
            return pieces.Cache(CACHE_SEGMENTS), [], [], []

        cache, texts, sizes, copies = empty()

        def settle():
            if not texts:
                return
            size = np.concatenate(sizes)
            weights = np.zeros((cache.count, len(names)))
            for rows, lang, n in copies:
                np.add.at(weights, (rows, lang), n)
            found = expected(automaton, np.concatenate(texts), np.cumsum(size) - size, size, weights)
            for name, k in names.items():
                sums[name] = sums.get(name, 0) + found[:, k]

        for batch in chunks(batches, most=BLOCK_BYTES):
            seg = pieces.Segments(batch.column("text"), automaton.inside, TRAINING_STRETCH)
            lang = np.array([names.setdefault(x, len(names)) for x in batch.column("lang").to_pylist()], dtype=np.int64)
            keys, where, which = np.unique(seg.hashes, return_index=True, return_inverse=True)
            rows = cache.find(keys)
            fresh = np.flatnonzero(rows < 0)
            if len(fresh):
                rows[fresh] = cache.add(keys[fresh])
                z = seg.sizes[where[fresh]]
                texts.append(seg.data[pieces.spread(seg.starts[where[fresh]], z)])
                sizes.append(z)
            of = np.repeat(lang, np.diff(seg.first))
            pair, n = np.unique(rows[which] * len(names) + of, return_counts=True)
            copies.append((pair // len(names), pair % len(names), n))
            if cache.count > cache.most:
                settle()
                cache, texts, sizes, copies = empty()
        settle()
        for name, total in sums.items():
            units = np.rint(total * UNITS).astype(np.int64)
            at = np.flatnonzero(units)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(units[at], pa.int64())], names=["lang", "piece", "units"]
            )

    rows = (
        labelled.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
        .where("text IS NOT NULL AND lang IS NOT NULL")
        .mapInArrow(count, "lang string, piece long, units long")
        .groupBy("lang", "piece")
        .agg(F.sum("units").alias("units"))
        .toArrow()  # at most languages times pieces rows
    )
    languages = sorted(set(rows.column("lang").to_pylist()))
    counts = np.zeros((len(vocabulary) + 1, len(languages)))
    at = np.array([languages.index(x) for x in rows.column("lang").to_pylist()], dtype=np.int64)
    if len(at):
        counts[rows.column("piece").to_numpy(), at] = rows.column("units").to_numpy() / UNITS
    smooth = counts + SMOOTHING
    smooth[-1] *= UNKNOWN
    return Model(vocabulary, languages, np.log(smooth / smooth.sum(axis=0)))


def has_letter(texts: pa.Array) -> np.ndarray:
    ascii_letter = np.asarray(pa.compute.fill_null(pa.compute.match_substring_regex(texts, "[A-Za-z]"), False))
    for k in np.flatnonzero(~ascii_letter).tolist():
        ascii_letter[k] = any(c.isalpha() for c in texts[k].as_py() or "")
    return ascii_letter


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score of every whole text."""
    kind = docs.select("doc_id").schema["doc_id"].dataType.simpleString()
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shipped.value
        automaton = _automaton(m.vocabulary)
        width = len(m.languages)
        names = np.array([*m.languages, "und"], dtype=object)
        cache, held = pieces.Cache(CACHE_SEGMENTS), np.zeros((0, width))
        for batch in chunks(batches, most=BLOCK_BYTES):
            column = batch.column("text")
            known = has_letter(column) & (width > 0)
            sums = np.zeros((batch.num_rows, max(width, 1)))
            if width:
                seg = pieces.Segments(column, automaton.inside)
                keys, where, which = np.unique(seg.hashes, return_index=True, return_inverse=True)
                if cache.count > cache.most:
                    cache, held = pieces.Cache(CACHE_SEGMENTS), np.zeros((0, width))
                rows = cache.find(keys)
                fresh = np.flatnonzero(rows < 0)
                if len(fresh):
                    rows[fresh] = cache.add(keys[fresh])
                    new = [likelihoods(automaton, m.logs, seg.data, seg.starts[where[f]], seg.sizes[where[f]]) for f in np.array_split(fresh, 1 + len(fresh) // 100_000)]
                    held = np.concatenate([held, *new])
                of, each = np.repeat(np.arange(batch.num_rows), np.diff(seg.first)), held[rows[which]]
                for k in range(width):
                    sums[:, k] = np.bincount(of, weights=each[:, k], minlength=batch.num_rows)
            best = np.where(known, sums.argmax(axis=1), -1)
            share = 1.0 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names[best], pa.string()), pa.array(np.where(known, share, 0.0))], names=["doc_id", "lang_pred", "score"]
            )

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def held_out(doc_id="doc_id"):
    """The third of the documents that is never learned from; false for a null id, which is not learned from either."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def op7_language_id(docs: DataFrame, model_file: str = pieces.MODEL_FILE) -> DataFrame:
    """Learn from two thirds of the documents and predict all."""
    model = train(docs.where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1), model_file)
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
