"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; every other document of the
training folds, labelled or not, is unlabelled.  A logistic model over the words
present is fitted in numpy to the class-prior-corrected risk
``prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives))``.

The classifier is fitted on at most ``MAX_POSITIVE`` positives and
``MAX_UNLABELLED`` unlabelled documents, those with the least hash of doc_id; each
comes to the driver as the hashed words of its text, once each.  The class prior
is the share of toxic labels among all labelled rows of the training folds.
Scoring reads every whole text in one pass without a shuffle.

Words are runs of letters and digits, A-Z as a-z.  Null and empty texts get the
model's bias.  No positive to learn from: score 0 for all.  A document labelled
twice is toxic if one label says so; repeated rows are scored one by one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigia.llm.common import Words, chunks

MAX_POSITIVE = 4000
MAX_UNLABELLED = 12000
#: Words are features when their log odds between positives and unlabelled texts are this many standard errors from 0.
LEAST_Z = 4.0
STEPS, RATE, DECAY = 400, 0.05, 3e-4


def held_out(doc_id: str = "doc_id"):
    """The fifth of the documents whose labels are never learned; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word hashes of every row in a line, and how many each row has."""
    words = Words(column, letters=True)
    hashes, row = words.hashes, words.row
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    return hashes[new], np.bincount(row[new], minlength=len(column))


@dataclass
class Model:
    """Sorted word hashes with a weight each, and the bias; no words and no bias: nothing was learned."""

    words: np.ndarray
    weights: np.ndarray
    bias: float | None


def sample(docs: DataFrame, ids: DataFrame, most: int) -> list[np.ndarray]:
    """Distinct word hashes of at most ``most`` of the documents named by ``ids``, those with the least hash of doc_id."""

    def run(batches):
        for batch in chunks(batches):
            hashes, counts = word_hashes(batch.column("text"))
            ends = pa.array(np.append(0, np.cumsum(counts)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(ends, pa.array(hashes.view(np.int64)))], names=["words"])

    # The chosen ids are at most ``most``, so they may be broadcast; no text is shuffled.
    chosen = ids.distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = docs.join(F.broadcast(chosen), "doc_id", "left_semi").select("text").mapInArrow(run, "words array<long>").toArrow()
    return [np.asarray(x.values, dtype=np.int64).view(np.uint64) for x in rows.column("words").combine_chunks()] if rows.num_rows else []


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> Model:
    """The numpy classifier: full-batch Adam on the non-negative risk."""
    if not positive or not unlabelled:
        return Model(np.zeros(0, np.uint64), np.zeros(0), None)
    words, which = np.unique(np.concatenate([*positive, *unlabelled]), return_inverse=True)
    size = np.array([len(x) for x in (*positive, *unlabelled)])
    row = np.repeat(np.arange(len(size)), size)
    n_pos, n_unl = len(positive), len(unlabelled)
    in_pos = np.bincount(which[row < n_pos], minlength=len(words))
    in_unl = np.bincount(which[row >= n_pos], minlength=len(words))
    odds = np.log((in_pos + 0.5) / (n_pos + 1)) - np.log((in_unl + 0.5) / (n_unl + 1))
    kept = np.abs(odds) >= LEAST_Z * np.sqrt(1 / (in_pos + 0.5) + 1 / (in_unl + 0.5))
    number = np.cumsum(kept) - 1
    use = kept[which]
    column, row = number[which[use]], row[use]
    words, width = words[kept], int(kept.sum())
    weights, bias = np.zeros(width), np.log(prior / (1 - prior))
    moments = [np.zeros(width + 1), np.zeros(width + 1)]
    is_pos = np.arange(len(size)) < n_pos
    for step in range(1, STEPS + 1):
        margin = np.bincount(row, weights=weights[column], minlength=len(size)) + bias
        p = 1 / (1 + np.exp(-np.clip(margin, -50, 50)))
        loss = np.logaddexp(0, margin)  # of calling a text clean
        negative = loss[~is_pos].mean() - prior * loss[is_pos].mean()
        pull = np.zeros(len(size))
        if negative >= 0:
            pull[is_pos] = (-prior * (1 - p[is_pos]) - prior * p[is_pos]) / n_pos
            pull[~is_pos] = p[~is_pos] / n_unl
        else:  # the corrected risk fell below zero: climb back
            pull[is_pos] = prior * p[is_pos] / n_pos
            pull[~is_pos] = -p[~is_pos] / n_unl
        slope = np.append(np.bincount(column, weights=pull[row], minlength=width) + DECAY * weights, pull.sum())
        moments[0] = 0.9 * moments[0] + 0.1 * slope
        moments[1] = 0.999 * moments[1] + 0.001 * slope**2
        move = RATE * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.999**step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    return Model(words, weights, float(bias))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on the training folds of ``docs`` with the labels of ``labels`` (doc_id, toxic)."""
    marks = labels.where(~held_out()).where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    prior = marks.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    if not prior:
        return Model(np.zeros(0, np.uint64), np.zeros(0), None)
    toxic = marks.where("toxic = 1").select("doc_id").distinct()
    fold = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("text IS NOT NULL AND doc_id IS NOT NULL").where(~held_out())
    ids = fold.select("doc_id")
    positive = sample(fold, ids.join(toxic, "doc_id", "left_semi"), MAX_POSITIVE)
    unlabelled = sample(fold, ids.join(toxic, "doc_id", "left_anti"), MAX_UNLABELLED)
    return fit(positive, unlabelled, min(max(prior, 1e-3), 0.5))


def score(docs: DataFrame, model: Model, name: str = "__score") -> DataFrame:
    """All columns of ``docs`` and the score as column ``name``, which ``docs`` must not have."""
    from pyspark.sql.types import DoubleType, StructField, StructType

    shipped = docs.sparkSession.sparkContext.broadcast(model)
    schema = StructType([*docs.schema.fields, StructField(name, DoubleType())])

    def run(batches):
        m = shipped.value
        for batch in chunks(batches):
            if m.bias is None:
                scores = np.zeros(batch.num_rows)
            else:
                hashes, counts = word_hashes(batch.column("text"))
                each = np.zeros(len(hashes))
                if len(m.words):
                    at = np.minimum(np.searchsorted(m.words, hashes), len(m.words) - 1)
                    each = np.where(m.words[at] == hashes, m.weights[at], 0.0)
                margin = np.bincount(np.repeat(np.arange(batch.num_rows), counts), weights=each, minlength=batch.num_rows) + m.bias
                scores = 1 / (1 + np.exp(-np.clip(margin, -50, 50)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, schema)


def op10_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    narrow = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    out = score(narrow, train(docs, labels))
    return out.select("doc_id", held_out().alias("held_out"), F.col("__score").alias("score"), (F.col("__score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents not predicted toxic, with all their columns.

    Documents are scored with the text as it is stored, so ``text`` must be a string.
    """
    name = "__score"
    while name in docs.columns:
        name += "_"
    kept = score(docs, train(docs, labels), name).where(F.col(f"`{name}`") < 0.5)
    return kept.select(*(F.col(f"`{c}`") for c in docs.columns))
