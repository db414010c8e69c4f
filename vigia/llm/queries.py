"""The registered queries over whole tables, and their reference SQL."""

from __future__ import annotations

import corpus_pipeline
from vigia.llm import (
    decontaminate,
    language_id,
    line_dedup,
    periodic_runs,
    pivotal_grams,
    prob_minhash,
    quality_rules,
    rp_forest,
    secret_scan,
    sentencepiece_codec,
    substring_dedup,
    toxicity,
    url_filter,
)
from vigia.llm.common import read


def op1_line_dedup(spark, sf_dir):
    return line_dedup.op1_line_dedup(read(spark, sf_dir, "documents"))


def op2_url_filter(spark, sf_dir):
    return url_filter.op2_url_filter(read(spark, sf_dir, "pages"))


def op3_prob_minhash(spark, sf_dir):
    return prob_minhash.op3_near_duplicates(read(spark, sf_dir, "documents"))


def op4_sentencepiece(spark, sf_dir):
    return sentencepiece_codec.encode(read(spark, sf_dir, "documents"))


def op5_substring_dedup(spark, sf_dir):
    return substring_dedup.op5_substring_dedup(read(spark, sf_dir, "documents"))


def op6_decontaminate(spark, sf_dir):
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op7_language_id(spark, sf_dir):
    return language_id.op7_language_id(read(spark, sf_dir, "documents"))


def op8_secret_scan(spark, sf_dir):
    return secret_scan.op8_secret_scan(read(spark, sf_dir, "documents"))


def op9_quality_rules(spark, sf_dir):
    return quality_rules.op9_quality_ledger(read(spark, sf_dir, "documents"))


def op10_toxicity(spark, sf_dir):
    return toxicity.op10_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_spelling_groups(spark, sf_dir):
    return pivotal_grams.op11_spelling_groups(read(spark, sf_dir, "documents"))


def op12_periodic_runs(spark, sf_dir):
    return periodic_runs.op12_periodic_runs(read(spark, sf_dir, "documents"))


def op13_nearest_vectors(spark, sf_dir):
    return rp_forest.op13_nearest_vectors(read(spark, sf_dir, "embeddings"))


def queries():
    own = {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}
    return {**own, "pipeline": corpus_pipeline.run}


def oracle_sql():
    sql = {"op9_quality_rules": quality_rules.SQL, "op11_spelling_groups": pivotal_grams.SQL}
    return sql if corpus_pipeline.ORACLE_SQL is None else {**sql, "pipeline": corpus_pipeline.ORACLE_SQL}
