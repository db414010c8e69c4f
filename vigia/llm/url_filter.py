"""URL filter: host and path rules, then a ratio of two character language models.

Rules decide what they fit.  All other URLs are judged by two smoothed
variable-order character models, one of accepted and one of rejected URLs:
Witten-Bell smoothing carries each context of three characters towards shorter
ones, and a context never seen falls back to the next shorter.  A URL's score is
the mean over its characters of log P(accepted) - log P(rejected); it is blocked at or
below the level that best tells held-out rejected from held-out accepted URLs (the
lowest of equally good levels; 0 where a side has none held out).

The models read the whole URL after ``://`` but for the fragment: host, path and
query, A-Z as a-z, digits as 0 and any other character than a letter, ``.``, ``/``,
``_`` and ``-`` as ``*``.  Accepted are the URLs that a rule allows, rejected those
whose host has one of ``REJECTED_TERMS``.  What a rule blocks is blocked for its
domain, not its looks, and teaches neither model, whatever its host is called.

Counts are summed over all URLs by 4-character grams of a 34-letter alphabet (at
most 34^4, 1.3 million rows), so the gram table may be broadcast.

Null URL, or one without ``://``: empty host and path, judged by the model's
score of an empty string.  Without accepted or rejected URLs to learn from, what
no rule fits is allowed.  Repeated rows each give a row.  Other columns are not
read.  Scores are whole millionths, so sums do not depend on order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigia.llm.common import stored

#: Verdict, host and path of every rule.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
REJECTED_TERMS = ("casino", "pills", "bets", "adult", "spam", "ads-")
ALPHABET = 34



def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, query, rule and the rule's verdict: of the rules that fit, the longest."""
    rest = F.expr("CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END")
    parts = pages.select("page_id", rest.alias("rest")).select(
        "page_id",
        F.translate(F.regexp_extract("rest", "^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("host"),
        F.regexp_extract("rest", "^[^/?#]*([^?#]*)", 1).alias("path"),
        F.regexp_extract("rest", r"^[^?#]*(\?[^#]*)", 1).alias("query"),
    )
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, F.lit(host + path)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return parts.select("page_id", "host", "path", "query", rule.alias("rule"), verdict.alias("rule_verdict"))


def modelled():
    """The string the models read: three start marks, host, path and query, end mark."""
    text = F.translate(F.concat("host", "path", "query"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    text = F.regexp_replace(F.regexp_replace(text, "[0-9]", "0"), "[^a-z0./_-]", "*")
    return F.concat(F.lit("^^^"), text, F.lit("$"))


def grams(rows: DataFrame) -> DataFrame:
    """One row for every character of ``s``, with the three before it."""
    each = F.transform(F.sequence(F.lit(1), F.length("s") - 3), lambda i: F.substring(F.col("s"), i, F.lit(4)))
    return rows.withColumn("gram", F.explode(each))


def gram_ratios(counts: DataFrame) -> DataFrame:
    """gram and ``units``: log P(accepted) - log P(rejected) of its last character, in millionths.

    ``counts``: gram, accepted, rejected; grams with no counts are scored too.
    """
    model = counts
    for k in (1, 2, 3, 4):
        model = model.withColumn(f"g{k}", F.expr(f"right(gram, {k})")).withColumn(f"c{k}", F.expr(f"left(right(gram, {k}), {k - 1})"))
    for side in ("accepted", "rejected"):
        p = F.lit(1.0 / ALPHABET)
        for k in (1, 2, 3, 4):
            level = counts.groupBy(F.expr(f"right(gram, {k})").alias(f"g{k}")).agg(F.sum(side).alias("n"))
            context = level.groupBy(F.expr(f"left(g{k}, {k - 1})").alias(f"c{k}")).agg(
                F.sum("n").cast("double").alias("total"), F.count_if(F.col("n") > 0).cast("double").alias("kinds")
            )
            model = model.join(level.withColumnRenamed("n", f"n_{side}{k}"), f"g{k}").join(
                context.withColumnsRenamed({"total": f"t_{side}{k}", "kinds": f"k_{side}{k}"}), f"c{k}"
            )
            n, total, kinds = (F.col(f"{x}_{side}{k}") for x in "ntk")
            p = F.when(total > 0, (n + kinds * p) / (total + kinds)).otherwise(p)
        model = model.withColumn(f"p_{side}", p)
    units = F.round((F.ln("p_accepted") - F.ln("p_rejected")) * 1_000_000).cast("long")
    return model.select("gram", units.alias("units"))


def op2_url_filter(pages: DataFrame, rules=RULES, terms=REJECTED_TERMS) -> DataFrame:
    """page_id, host, path, rule, verdict and the model's score of every URL."""
    rows = judged(pages, rules).withColumn("s", modelled())
    named = F.lit(False)
    for term in terms:
        named = named | F.col("host").contains(term)
    accepted = ((F.col("rule_verdict") == "allow") & ~named).cast("long")
    rejected = (named & ~F.col("rule_verdict").eqNullSafe("block")).cast("long")
    held = F.coalesce(F.crc32(F.col("page_id").cast("string")) % 5 == 0, F.lit(False))
    rows = rows.select("*", F.coalesce(accepted, F.lit(0)).alias("accepted"), F.coalesce(rejected, F.lit(0)).alias("rejected"), held.alias("held"))
    learn = lambda c: F.sum(F.when(~F.col("held"), F.col(c)).otherwise(F.lit(0))).alias(c)
    counts = stored(grams(rows).groupBy("gram").agg(learn("accepted"), learn("rejected")), "url-grams")
    ratios = stored(gram_ratios(counts), "url-ratios")

    def scored(some):
        # The row number only tells rows apart inside this one query.
        each = grams(some.withColumn("row", F.monotonically_increasing_id())).join(F.broadcast(ratios), "gram")
        keys = ["row", "page_id", "host", "path", "rule", "rule_verdict", "accepted", "rejected"]
        return each.groupBy(*keys).agg(F.sum("units").alias("units"), F.count(F.lit(1)).alias("n")).withColumn("milli", F.floor(F.col("units") / F.col("n") / 1000))

    seen = counts.agg(F.sum("accepted"), F.sum("rejected")).first()
    level = None
    if seen[0] and seen[1]:
        level = _level(scored(rows.where("held AND accepted + rejected > 0")))
    blocked = F.lit(False) if level is None else F.col("milli") <= level
    verdict = F.coalesce(F.col("rule_verdict"), F.when(blocked, "block").otherwise("allow"))
    return scored(rows).select("page_id", "host", "path", "rule", verdict.alias("verdict"), (F.col("milli") / 1000.0).alias("score"))


def _level(scores: DataFrame) -> int:
    """The level in thousandths at or under which rejected URLs outweigh accepted ones most.

    Summed first by thousandth of a nat, a bounded range, and only then ordered.
    """
    upto = Window.orderBy("milli")
    whole = upto.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = scores.groupBy("milli").agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))
    share = lambda c: F.sum(c).over(upto) / F.sum(c).over(whole)
    best = levels.select("milli", F.round(share("rejected") - share("accepted"), 9).alias("gain")).where("gain IS NOT NULL")
    row = best.orderBy(F.desc("gain"), "milli").first()
    return row["milli"] if row and row["gain"] > 0 else 0
