"""Spelling variants: words one edit apart, found through pivotal bigrams.

**Words.**  Runs of letters of every whole text, A-Z lower-cased, some of them with
one letter taken out by a rule (:func:`vocabulary`), kept with 7 code points or more
that occur twice or more.

**Method.**  The bigrams of a word are ordered by how rare they are.  Its *prefix*
holds every bigram up to the rank of the third rarest one; its two *pivots* are the
two disjoint bigrams of the prefix that the fewest words have, chosen by dynamic
programming.  One edit touches one of two disjoint bigrams at most, so of two words
one edit apart, the one whose prefix ends at the rarer rank has a pivot that is
also in the prefix of the other, shifted by one place at most.

An edit lies wholly after the first pivot or wholly before the second.  So up to the
first, or from the second on, the words are equal, and of the edited side either
the first half or the last half is.  The join key holds the equal side, the place of
the bigram (the position limit) and that half; there is no list of all words with a
bigram, so no group grows with the vocabulary.  The
edit distance is checked inside the join, and only near pairs become rows.

**Defined cases.**  A null text holds no words; a null ``doc_id`` counts as empty
text in the rule that takes letters out.  Empty texts and tables give no words.  A
text is read whole, whatever its length.  Rows that repeat a ``doc_id`` or a text
each count.  Of near words with equal counts the least in code-point order is the
form.  Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, stored

LEAST_LETTERS, LEAST_COUNT = 7, 2
#: One letter is taken out of an occurrence whose checksum this number divides.
CUT_EVERY = 31
#: A near word is a word's form if it is this many times as frequent.
FORM_TIMES = 10
#: Different words that a task counts before it hands its counts on.
HELD_WORDS = 200_000

_RUNS = re.compile(rf"[a-zÀ-ÿ]{{{LEAST_LETTERS},}}")


def cut(doc: bytes, run: str) -> str:
    """``run`` without one letter if the checksum of ``<doc>:<run>`` says so."""
    h = crc32(run.encode(), crc32(doc + b":"))
    if h % CUT_EVERY:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()
    for batch in chunks(batches):
        # ASCII only: other capitals stay as they are.
        texts = pc.ascii_lower(batch.column("text")).to_pylist()
        for doc, text in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
            key = b"" if doc is None else str(doc).encode()
            for run, n in Counter(_RUNS.findall(text or "")).items():
                word = cut(key, run)
                if len(word) >= LEAST_LETTERS:
                    held[word] += n
        if len(held) > HELD_WORDS:
            yield pa.record_batch([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
            held.clear()
    yield pa.record_batch([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n): words of 7 code points or more that occur twice or more.

    A run loses one code point where the CRC-32 of ``<doc_id>:<run>`` is divisible by
    31: the one at the checksum modulo the length.
    """
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    counted = texts.mapInArrow(_counted, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def cheapest_disjoint(grams: list[tuple[int, int]], many: int = 2) -> list[int]:
    """Places of the ``many`` disjoint bigrams of least total cost; ``grams`` = (place, cost) by place.

    ``best[k][i]`` is the cheapest choice of k among the first i; bigram i is left
    out, or taken with the best k-1 of those that end before it.
    """
    best: list[list[tuple[float, tuple[int, ...]]]] = [[(0, ())] * (len(grams) + 1)]
    for k in range(1, many + 1):
        row: list[tuple[float, tuple[int, ...]]] = [(float("inf"), ())]
        before = 0
        for place, cost in grams:
            while grams[before][0] <= place - 2:
                before += 1
            total, chosen = best[k - 1][before]
            row.append(min(row[-1], (total + cost, (*chosen, place))))
        best.append(row)
    return list(best[many][-1][1])


def prefix(word: str, rank: dict[str, int]) -> tuple[int, list[int]]:
    """The rank that ends the prefix, and the places of its bigrams: three, or more where ranks are equal."""
    ranks = [rank[word[i : i + 2]] for i in range(len(word) - 1)]
    last = sorted(ranks)[2]
    return last, [i for i, r in enumerate(ranks) if r <= last]


def keys(word: str, at: int, sides: str = "<>") -> Iterator[str]:
    """What a word one edit away shares if the bigram at ``at`` survives the edit.

    ``<``: the words are equal up to the bigram and edited after it; ``>``: equal from the bigram on.  Of the other side, ``longest``
    code points in the longer word, all but one agree from its two ends, so its
    first or its last half does.
    """
    for side in sides:
        equal, rest = (word[: at + 2], word[at + 2 :]) if side == "<" else (word[at:], word[:at])
        for longest in (len(rest), len(rest) + 1):
            first = longest // 2
            last = longest - first
            if longest:
                yield f"{side}{longest} {equal} {rest[:first]}."
            if longest and last <= len(rest):
                yield f"{side}{longest} {equal} .{rest[len(rest) - last :]}"


_SIGNED = "key string, word string, n bigint, last int"


def _signatures(cost: dict[str, int], pivots: bool):
    """Keys of the pivots, or of all bigrams of the prefix."""
    rank = {gram: i for i, gram in enumerate(sorted(cost, key=lambda g: (cost[g], g)))}

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                rows = []
                for word, n in zip(part.column("word").to_pylist(), part.column("n").to_pylist(), strict=True):
                    last, places = prefix(word, rank)
                    where = zip(places, ["<>"] * len(places), strict=True)
                    if pivots:
                        where = zip(cheapest_disjoint([(i, cost[word[i : i + 2]]) for i in places]), "<>", strict=True)
                    rows += [(key, word, n, last) for at, sides in where for key in keys(word, at, sides)]
                columns = zip(*rows, strict=True) if rows else ((),) * 4
                types = (pa.string(), pa.string(), pa.int64(), pa.int32())
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["key", "word", "n", "last"])

    return signed


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, na, b, nb): every pair a < b of ``words`` (word, n; four code points or more) one edit apart, once.

    The table of bigrams goes through the driver: 90 letters make 8,100 at most.
    """
    gram = F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.col("word").substr(i, F.lit(2))))
    cost = {r["gram"]: r["n"] for r in words.select(gram.alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n")).toLocalIterator()}
    # Keys travel as hashes: words that meet by chance fail the check of their distance.
    signed = [words.select("word", "n").mapInArrow(_signatures(cost, own), _SIGNED).withColumn("key", F.xxhash64("key")) for own in (True, False)]
    p, x = signed[0], signed[1].select("key", *(F.col(c).alias(f"x_{c}") for c in ("word", "n", "last")))
    near = (F.col("last") <= F.col("x_last")) & (F.levenshtein("word", "x_word", 1) == 1)
    met = p.join(x, "key").where(near)
    least, most = F.least("word", "x_word"), F.greatest("word", "x_word")
    first = F.col("word") < F.col("x_word")
    return met.select(
        least.alias("a"),
        F.when(first, F.col("n")).otherwise(F.col("x_n")).alias("na"),
        most.alias("b"),
        F.when(first, F.col("x_n")).otherwise(F.col("n")).alias("nb"),
    ).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms`` (word, form): where the links end.

    Each round doubles how far every word looks.  A form is ten times as frequent
    as its word, so the links hold no circle and end after a few steps.
    """
    up = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = stored(up.join(further, "root", "left").select("word", "root", "next"), "roots")
        if joined.where("next IS NOT NULL").isEmpty():
            return up
        up = joined.select("word", F.coalesce("next", "root").alias("root"))


def spelling_groups(words: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for ``words`` (word, n), each word once.

    ``form``: the near word of largest n (ties: the least) if that n is ten times the
    word's; ``root``: where following forms ends.
    """
    pairs = stored(near_pairs(words), "near")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("nb").alias("other_n")).unionAll(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("na").alias("other_n"))
    )
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct(-F.col("other_n"), F.col("other"))).alias("best"))
    joined = words.join(best.select("word", "n_near", (-F.col("best.col1")).alias("best_n"), F.col("best.other").alias("best")), "word", "left")
    formed = F.col("best_n") >= FORM_TIMES * F.col("n")
    groups = stored(
        joined.select(
            "word",
            F.when(formed, F.col("best")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(formed, F.col("best_n")).alias("form_n"),
        ),
        "spelling",
    )
    ends = roots(groups.where("form IS NOT NULL").select("word", "form"))
    return groups.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_groups(docs: DataFrame) -> DataFrame:
    return spelling_groups(stored(vocabulary(docs), "vocabulary"))


#: Reference SQL.  CRC-32 (reflected polynomial 0xEDB88320) goes byte by byte over a
#: table; pairs one edit apart share a word with one place masked or left out.
SQL = f"""WITH RECURSIVE bits(r, c, i) AS (
  SELECT x, CAST(x AS BIGINT), 0 FROM range(256) t(x)
  UNION ALL SELECT r, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i + 1 FROM bits WHERE i < 8),
tab AS (SELECT list(c ORDER BY r) AS t FROM bits WHERE i = 8),
runs AS (SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
counted AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS k, run, count(*) AS n
  FROM runs WHERE length(run) >= {LEAST_LETTERS} GROUP BY 1, 2),
hashed AS (SELECT run, n, xor(list_reduce(
    list_concat([CAST(4294967295 AS BIGINT)], list_transform(range(0, octet_length(encode(k))),
      lambda p: CAST(('0x' || substr(hex(encode(k)), CAST(2 * p + 1 AS INTEGER), 2)) AS BIGINT))),
    lambda acc, b: xor(t[1 + (xor(acc, b) & 255)], acc >> 8)), 4294967295) AS h FROM counted, tab),
seen AS (SELECT CASE WHEN h % {CUT_EVERY} = 0
    THEN substr(run, 1, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) + 2 AS INTEGER)) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM seen
  WHERE length(word) >= {LEAST_LETTERS} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}),
places AS (SELECT word, n, CAST(unnest(range(1, length(word) + 1)) AS INTEGER) AS p FROM words),
shapes AS (SELECT word, n, p, substr(word, 1, p - 1) AS l, substr(word, p + 1) AS r FROM places),
near AS (
  SELECT x.word, y.word AS other, y.n AS other_n FROM shapes x JOIN shapes y ON x.p = y.p AND x.l = y.l AND x.r = y.r AND x.word <> y.word
  UNION SELECT x.word, y.word, y.n FROM shapes x JOIN words y ON y.word = x.l || x.r
  UNION SELECT y.word, x.word, x.n FROM shapes x JOIN words y ON y.word = x.l || x.r),
best AS (SELECT word, count(*) AS n_near, max(other_n) AS best_n, arg_min(other, struct_pack(a := -other_n, b := other)) AS best
  FROM near GROUP BY word),
formed AS (SELECT w.word, w.n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near,
    CASE WHEN best_n >= {FORM_TIMES} * w.n THEN best END AS form, CASE WHEN best_n >= {FORM_TIMES} * w.n THEN best_n END AS form_n
  FROM words w LEFT JOIN best USING (word)),
up(word, root, k) AS (SELECT word, word, 0 FROM formed
  UNION ALL SELECT up.word, f.form, k + 1 FROM up JOIN formed f ON f.word = up.root WHERE f.form IS NOT NULL),
ends AS (SELECT word, arg_max(root, k) AS root FROM up GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)"""
