"""Data-quality rules of the event table, as a report and as a split."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..schema import EVENT_TYPES, LEVELS, METRICS, REQUIRED_COLUMNS, TEXT_WIDTHS


@dataclass(frozen=True)
class Rule:
    """``broken`` is true for a violating row; null counts as not violating."""

    name: str
    broken: Column


def event_rules() -> list[Rule]:
    """The declared constraints and the invariants every event must keep."""
    rules = [Rule(f"required:{c}", F.col(c).isNull()) for c in REQUIRED_COLUMNS]
    rules += [Rule(f"width:{c}", F.length(c) > width) for c, width in TEXT_WIDTHS.items()]
    for m in METRICS:
        value = F.col(m.name)
        broken = value < 0
        if m.cap is not None:
            broken = broken | (value > m.cap // 100)
        rules.append(Rule(f"range:{m.name}", broken))
    suspicious = (F.col("tipo_evento") == "security") & (F.col("nivel") != "INFO")
    rules += [
        Rule("domain:tipo_evento", ~F.col("tipo_evento").isin(*EVENT_TYPES)),
        Rule("domain:nivel", ~F.col("nivel").isin(*LEVELS)),
        Rule("only_request:metodo_http", F.col("metodo_http").isNotNull() & (F.col("tipo_evento") != "request")),
        Rule("only_security:intento_login", F.col("intento_login").isNotNull() & (F.col("tipo_evento") != "security")),
        Rule("only_security:pais_origen", F.col("pais_origen").isNotNull() & (F.col("tipo_evento") != "security")),
        Rule("flag:ip_sospechosa", F.col("ip_sospechosa").isNull() | (F.col("ip_sospechosa") != suspicious)),
    ]
    return rules


def quality_report(df: DataFrame, rules: Sequence[Rule], key: str | None = None) -> DataFrame:
    """(rule, violations): all row rules in one pass without a shuffle of rows.

    With ``key``, a line ``duplicate:<key>`` counts rows beyond the first of
    each key.  It reads the key column only, and copies of a hot key collapse
    in the partial aggregate.
    """
    counts = df.agg(*(F.count_if(r.broken).alias(r.name) for r in rules))
    report = counts.unpivot([], [f"`{r.name}`" for r in rules], "rule", "violations")
    if key is None:
        return report
    per_key = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    extra = per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations"))
    return report.unionByName(extra.select(F.lit(f"duplicate:{key}").alias("rule"), "violations"))


def mark_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``reglas``: the rules a row breaks, comma separated, '' for none."""
    return df.withColumn("reglas", F.concat_ws(",", *(F.when(r.broken, F.lit(r.name)) for r in rules)))


def split_by_rules(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected); rejected rows carry ``reglas``."""
    marked = mark_rules(df, rules)
    return marked.where("reglas = ''").drop("reglas"), marked.where("reglas <> ''")


def dependency_report(df: DataFrame, dependencies: Sequence[tuple[str, str]]) -> DataFrame:
    """Does one column fix another?  A line per (determinant, dependent).

    ``claves``: different determinants; ``rotas``: those with two or more different
    values; ``filas``: their rows with a value; ``nulos``: rows without one, which
    contradict nothing; ``testigo``: the least broken determinant with its least
    and greatest value (``valor_a``, ``valor_b``), as text.  Rows without a
    determinant are left out.

    One aggregate per determinant over all its dependents: least, greatest and
    number of the values, so a hot key sends one row per task and no list of
    values is ever held.
    """
    by_key: dict[str, list[str]] = {}
    for key, dependent in dependencies:
        by_key.setdefault(key, []).append(dependent)
    out = None
    for key, dependents in by_key.items():
        found = []
        for i, c in enumerate(dependents):
            found += [F.min(c).alias(f"a{i}"), F.max(c).alias(f"b{i}"), F.count(c).alias(f"n{i}")]
        groups = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("rows"), *found)
        lines = []
        for i, c in enumerate(dependents):
            broken = F.col(f"a{i}") != F.col(f"b{i}")
            text = [F.col(x).cast("string") for x in ("key", f"a{i}", f"b{i}")]
            lines.append(
                F.struct(
                    F.lit(f"{key} -> {c}").alias("dependencia"),
                    F.count(F.lit(1)).alias("claves"),
                    F.count_if(broken).alias("rotas"),
                    F.coalesce(F.sum(F.when(broken, F.col(f"n{i}"))), F.lit(0)).alias("filas"),
                    F.coalesce(F.sum(F.col("rows") - F.col(f"n{i}")), F.lit(0)).alias("nulos"),
                    F.min(F.when(broken, F.struct(*(t.alias(n) for t, n in zip(text, ("testigo", "valor_a", "valor_b")))))).alias("w"),
                ).alias(f"l{i}")
            )
        told = groups.agg(*lines).select(F.inline(F.array(*(F.col(f"l{i}") for i in range(len(dependents))))))
        told = told.select("dependencia", "claves", "rotas", "filas", "nulos", "w.testigo", "w.valor_a", "w.valor_b")
        out = told if out is None else out.unionAll(told)
    return out
