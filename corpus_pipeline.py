"""A training-text pipeline: five stages over the ``documents`` table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes
as Parquet in the shared folder and reads again as the next stage's ``docs``.  All
but the last return the columns of ``documents``.

What each stage does with the cases below is stated in its operator's module; here:

* an empty table goes through all stages and gives an empty result;
* a null or empty text is kept by all stages (it is like no other text, and no
  line, benchmark item or toxic word is in it) and has null or no piece ids;
* documents are told apart by doc_id and text, so a null or repeated doc_id costs
  no other document its place; of rows that repeat both, near-dedup keeps one;
* texts are read whole, whatever their length;
* columns beside doc_id and text may have any names and come out as they went in
  (``n_chars`` follows a text that loses lines).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigia.llm import decontaminate, line_dedup, prob_minhash, sentencepiece_codec, toxicity
from vigia.llm.common import read, stored


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go."""
    return toxicity.without_toxic(docs, read(spark, sf_dir, "labels"))


def without_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines aligned with an earlier document go, and documents that lose all lines; n_chars follows the text."""
    kept = line_dedup.deduped_rows(docs).where("NOT (lost > 0 AND lost = lines)")
    columns = {c: F.col(f"row.`{c}`") for c in docs.columns} | {"text": F.col("text")}
    if "n_chars" in docs.columns:
        left = F.length("text").cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(F.col("lost") > 0, left).otherwise(columns["n_chars"])
    return kept.select(*(column.alias(c) for c, column in columns.items()))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each group of near-duplicates stays."""
    return prob_minhash.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, as it is or edited, go."""
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, piece ids, their number and whether they decode to the text."""
    return sentencepiece_codec.encode(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_common_lines),
    ("minhash_near_dedup", without_near_duplicates),
    ("benchmark_decontamination", without_benchmark),
    ("sentencepiece", tokens),
]

#: SQL cannot express the stages; the tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
