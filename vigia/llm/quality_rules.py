"""Quality rules as a bitmask ledger.

``ledger`` evaluates every rule once for each document and stores the
measurements and one failure bit per rule.  Policies are versioned bit masks;
applying one, or comparing two, or asking what each rule alone costs
(``ablation``) is bitwise work on the ledger and never reads a text again.

Built-in functions only, no shuffle: a document's 3-word windows are hashed
(64 bits), sorted inside its row, and equal neighbours are repeats.

Null text: no words, fails ``few_words``.  An empty table gives an empty ledger.
Repeated rows are measured one by one.  Other columns of the table are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigia.llm.common import SPACES

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

#: Rule name and failing condition over the measurements; the bit is the place in this list.
RULES = (
    ("few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("duplicate_lines", "100 * n_dup_lines > 30 * n_lines"),
    ("word_length", "word_chars < 2 * n_words OR word_chars > 12 * n_words"),
)

#: Policy version to the rules that reject under it.
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols"),
    # A stricter candidate, there to be compared: its last two rules also reject prose labelled good.
    "v2": ("few_words", "repeated_words", "symbols", "duplicate_lines", "word_length"),
}


def mask(rules) -> int:
    """The bits of some rules."""
    names = [name for name, _ in RULES]
    return sum(1 << names.index(rule) for rule in set(rules))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements of every whole text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    split = docs.select(
        F.col("doc_id"),
        text.alias("text"),
        F.filter(F.split(text, SPACES), lambda w: w != "").alias("words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    hashed = split.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.size(F.split("text", r"[#*$%&|<>]")) - 1).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(
            "CASE WHEN size(words) < 3 THEN array() ELSE "
            "transform(sequence(0, size(words) - 3), i -> xxhash64(words[i], words[i + 1], words[i + 2])) END"
        ).alias("windows"),
    )
    # Sorting plain numbers is cheap: 33 bits of the hash above the place find every
    # window that may have an equal one, and only those are sorted by the whole hash.
    packed = hashed.withColumn(
        "packed",
        F.expr(
            "CASE WHEN size(array_distinct(windows)) = size(windows) THEN NULL "
            "ELSE sort_array(transform(windows, (h, i) -> (h & -2147483648L) | i)) END"
        ),
    )
    maybe = packed.withColumn(
        "maybe",
        F.expr(
            "filter(packed, (w, k) -> (k > 0 AND (packed[k - 1] ^ w) BETWEEN 0 AND 2147483647L) "
            "OR (k + 1 < size(packed) AND (packed[k + 1] ^ w) BETWEEN 0 AND 2147483647L))"
        ),
    )
    ordered = maybe.withColumn(
        "equal",
        F.expr(
            "sort_array(transform(transform(maybe, w -> int(w & 2147483647L)), i -> struct(windows[i] AS h, i AS i)))"
        ),
    )
    repeats = ordered.withColumn(
        "places",
        F.expr(
            "sort_array(transform(filter(equal, (w, k) -> (k > 0 AND equal[k - 1].h = w.h) "
            "OR (k + 1 < size(equal) AND equal[k + 1].h = w.h)), w -> w.i))"
        ),
    )
    covered = F.expr(
        "coalesce(aggregate(places, named_struct('n', 0L, 'last', -3), (a, i) -> "
        "named_struct('n', a.n + least(3, i - a.last), 'last', i), a -> a.n), 0L)"
    )
    return repeats.withColumn("n_repeat_words", covered).select("doc_id", *MEASURES)


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements and ``failed_bits`` (long): every rule evaluated once."""
    bits = F.lit(0).cast("long")
    for bit, (_, condition) in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(F.expr(condition), F.lit(1 << bit)).otherwise(F.lit(0)).cast("long"))
    return measured(docs).withColumn("failed_bits", bits)


def fails(policy: str) -> Column:
    """Whether a ledger row is rejected under a policy version."""
    return F.col("failed_bits").bitwiseAND(F.lit(mask(POLICIES[policy])).cast("long")) != 0


def ablation(rows: DataFrame, policy: str) -> DataFrame:
    """For each rule of a policy: documents failing it, and documents only it rejects.

    Documents are first counted by bit pattern (at most two to the number of
    rules rows), so the ablation is over counts.
    """
    own = mask(POLICIES[policy])
    names = [name for name, _ in RULES]
    patterns = rows.groupBy(F.col("failed_bits").bitwiseAND(F.lit(own).cast("long")).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    rules = F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(1 << names.index(r)).cast("long").alias("bit")) for r in POLICIES[policy]))
    return (
        patterns.select("bits", "n", F.explode(rules).alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(F.expr("bits & r.bit <> 0"), F.col("n")).otherwise(0)).alias("failing"),
            F.sum(F.when(F.expr("bits = r.bit"), F.col("n")).otherwise(0)).alias("only_this"),
        )
    )


def op9_quality_ledger(docs: DataFrame, policy: str = "v1") -> DataFrame:
    """The ledger's digest: base measurements, base verdict and the policy's verdict."""
    base_failed, failed = fails("base"), fails(policy)
    return ledger(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), (~base_failed & ~failed).alias("kept"), "n_lines", "failed_bits",
    )


SQL = """
WITH w AS (SELECT rowid_ AS r, doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS words,
                  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
           FROM (SELECT row_number() OVER () AS rowid_, doc_id, coalesce(text, '') AS t FROM documents)),
win AS (SELECT r, unnest(range(1, len(words) - 1)) AS i, words FROM w),
tri AS (SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g FROM win),
dup AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM tri) WHERE n > 1),
cover AS (SELECT r, count(*) AS n FROM (SELECT DISTINCT r, i + k AS p FROM dup, (VALUES (0), (1), (2)) AS o(k)) GROUP BY r),
m AS (SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN cover c USING (r)),
b AS (SELECT *, ((n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT + 4 * (10 * n_symbols > n_words)::BIGINT
              + 8 * (100 * n_dup_lines > 30 * n_lines)::BIGINT + 16 * (word_chars < 2 * n_words OR word_chars > 12 * n_words)::BIGINT) AS failed_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed, failed_bits & 7 = 0 AS kept, n_lines, failed_bits FROM b
"""
