"""Running a suite of analyses: source in, printed and saved results out."""

from __future__ import annotations

import logging
import re
import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..functions.numeric import round_half_up
from ..operators.analysis import Analysis, Rounding, run, run_fused
from ..sources.sinks import export_csv, print_result
from ..sources.views import materialise, register
from .analyses import CSV_SUITE, JSON_SUITE
from .sql import SQL_CATALOG, SqlAnalysis, run_sql

log = logging.getLogger(__name__)

AnyAnalysis = Analysis | SqlAnalysis

# Suites by the name used to select them.
SUITES: dict[str, list[AnyAnalysis]] = {"json": JSON_SUITE, "csv": CSV_SUITE, "sql": SQL_CATALOG}


@dataclass(frozen=True)
class Report:
    """What a run produced."""

    suite: str
    seconds: float
    rows: int | None
    saved: dict[str, str]


def columns_used(df: DataFrame, analyses: Iterable[AnyAnalysis]) -> list[str]:
    """Columns of ``df`` the analyses need, or a few more.

    A specification names its columns; filters and SQL are searched for
    column names, and SQL also needs whatever it returns.  A star other than
    count(*) needs them all.
    """
    named: set[str] = set()
    text = ""
    for a in analyses:
        if isinstance(a, SqlAnalysis):
            text += f" {a.sql}"
            named.update(run_sql(register(df).sparkSession, a).columns)
        else:
            text += f" {a.where or ''}"
            named.update(a.columns())
    rest = re.sub(r"(?i)count\s*\(\s*\*\s*\)", "", text)
    if re.search(r"(?i)(\b(select|distinct|all)\s+|[(,.]\s*)\*", rest):
        return df.columns
    words = {w.lower() for w in re.findall(r"\w+", text)} | {c.lower() for c in named}
    return [c for c in df.columns if c.lower() in words] or df.columns[:1]


def build(
    df: DataFrame, analyses: Iterable[AnyAnalysis], rounding: Rounding = round_half_up
) -> tuple[dict[str, DataFrame], list[DataFrame]]:
    """Result DataFrames by name, in order, and the aggregates they share."""
    analyses = list(analyses)
    specs = [a for a in analyses if isinstance(a, Analysis)]
    results, shared = {}, []
    if len(specs) > 1:  # one scan for all
        results, fused = run_fused(df, specs, rounding)
        shared = [fused]
    elif specs:
        results[specs[0].name] = run(df, specs[0], rounding)
    register(df)
    for a in analyses:
        if isinstance(a, SqlAnalysis):
            results[a.name] = run_sql(df.sparkSession, a)
    return {a.name: results[a.name] for a in analyses}, shared


def run_report(
    df: DataFrame,
    analyses: Iterable[AnyAnalysis],
    out_dir: str | None = None,
    suite: str = "report",
    cache: bool = False,
    staging: str | None = None,
    show: Callable[[DataFrame], None] | None = print_result,
    rounding: Rounding = round_half_up,
) -> Report:
    """Run analyses over ``df``; each result is computed once.

    ``cache=True`` keeps the columns the analyses use and reports the row
    count: use it for CSV, JSON and database sources.  ``staging`` does the
    same as a Parquet table at that path, for sources beyond memory.  Results named by ``save`` go to
    ``<out_dir>/resultado_<suite>/<save>.csv``.
    """
    analyses = list(analyses)
    started = time.monotonic()
    source, rows = df, None
    if cache or staging:
        source, rows = materialise(df, columns_used(df, analyses), staging)
    saved: dict[str, str] = {}
    shared: list[DataFrame] = []
    try:
        results, shared = build(source, analyses, rounding)
        for a in analyses:
            log.info("analysis %s", a.name)
            result = results[a.name].persist()
            if show:
                print(f"\n--- {a.name} ---")
                show(result)
            if a.save and out_dir:
                saved[a.name] = f"{out_dir}/resultado_{suite}/{a.save}.csv"
                export_csv(result, saved[a.name])
            result.unpersist()
    finally:
        for aggregate in shared:
            aggregate.unpersist()
        if cache and not staging:
            source.unpersist()
    return Report(suite, time.monotonic() - started, rows, saved)
