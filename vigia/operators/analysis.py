"""Group-and-aggregate analyses described as data.

An :class:`Analysis` is what a user edits: a filter, keys, measures, an order
and a name to save under.  :func:`run` turns it into one DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.numeric import exact_sum, mean, round_half_up

Rounding = Callable[[Column], Column]

FUNCTIONS = ("count", "avg", "min", "max", "sum", "stddev")


@dataclass(frozen=True)
class Measure:
    """``fn`` over ``column`` under the name ``alias``; ``*`` counts rows."""

    fn: str
    column: str
    alias: str

    def __post_init__(self) -> None:
        if self.fn not in FUNCTIONS:
            raise ValueError(
                f"unknown function {self.fn!r} for {self.alias!r}; use one of {', '.join(FUNCTIONS)}"
            )
        if self.column == "*" and self.fn != "count":
            raise ValueError(f"{self.fn}(*) is not defined; only count takes '*'")


@dataclass(frozen=True)
class Analysis:
    """One declarative analysis."""

    name: str
    aggs: tuple[Measure, ...]
    group_by: tuple[str, ...] = ()
    where: str | None = None
    order: tuple[str, str] | None = None
    save: str | None = None

    def __post_init__(self) -> None:
        measures = tuple(m if isinstance(m, Measure) else Measure(*m) for m in self.aggs)
        if not measures:
            raise ValueError(f"analysis {self.name!r} has no measures")
        object.__setattr__(self, "aggs", measures)
        object.__setattr__(self, "group_by", tuple(self.group_by))
        if self.order is not None:
            object.__setattr__(self, "order", tuple(self.order))

    @classmethod
    def from_dict(cls, spec: Mapping) -> Analysis:
        """Read the dictionary form: nombre, filtro, group_by, agg, orden, guardar."""
        return cls(
            name=spec["nombre"],
            aggs=tuple(spec["agg"]),
            group_by=tuple(spec.get("group_by") or ()),
            where=spec.get("filtro") or None,
            order=spec.get("orden") or None,
            save=spec.get("guardar") or None,
        )

    def columns(self) -> list[str]:
        """Grouping and measured columns, without those of the filter text."""
        measured = [m.column for m in self.aggs if m.column != "*"]
        return list(dict.fromkeys([*self.group_by, *measured]))


def measure_column(m: Measure, schema: T.StructType, rounding: Rounding = round_half_up) -> Column:
    """The aggregate expression of a measure, typed INT/BIGINT/DOUBLE/STRING.

    Averages and deviations are rounded to two places, the rest is not.
    """
    if m.column == "*":
        return F.count(F.lit(1)).alias(m.alias)
    dtype = schema[m.column].dataType
    exact_number = isinstance(dtype, T.DecimalType)
    col = F.col(m.column)
    if m.fn == "count":
        out = F.count(col)
    elif m.fn == "avg":
        out = rounding(mean(m.column, dtype))
    elif m.fn == "stddev":
        out = rounding(F.stddev_samp(col.cast("double")))
    elif m.fn == "sum":
        out = exact_sum(m.column, dtype)
        out = out.cast("double") if exact_number else out
    else:
        out = (F.min if m.fn == "min" else F.max)(col)
        out = out.cast("double") if exact_number else out
    return out.alias(m.alias)


def ordered(df: DataFrame, a: Analysis) -> DataFrame:
    if not a.order:
        return df
    column, direction = a.order
    first = F.col(column).desc_nulls_last() if direction == "desc" else F.col(column).asc_nulls_first()
    ties = [F.col(k).asc_nulls_first() for k in a.group_by if k != column]
    return df.orderBy(first, *ties)


def run(df: DataFrame, a: Analysis, rounding: Rounding = round_half_up) -> DataFrame:
    """Filter, group, aggregate and order as ``a`` says.  No keys: one row."""
    base = df.where(a.where) if a.where else df
    measures = [measure_column(m, df.schema, rounding) for m in a.aggs]
    return ordered(base.groupBy(*a.group_by).agg(*measures), a)


def run_shared(
    df: DataFrame, analyses: Iterable[Analysis], rounding: Rounding = round_half_up
) -> tuple[dict[str, DataFrame], list[DataFrame]]:
    """Run analyses so that those with equal filter and keys share one scan.

    Each set becomes a single ``groupBy().agg()`` holding every distinct
    measure once, and each analysis is a projection of it.  Returns the
    results by name, and the shared aggregates (one row per group, persisted)
    for the caller to unpersist when it is done with them.
    """
    sets: dict[tuple, list[Analysis]] = {}
    for a in analyses:
        sets.setdefault((a.where, a.group_by), []).append(a)

    results: dict[str, DataFrame] = {}
    shared: list[DataFrame] = []
    for (where, keys), members in sets.items():
        if len(members) == 1:
            results[members[0].name] = run(df, members[0], rounding)
            continue
        slots: dict[tuple[str, str], str] = {}
        for m in (m for a in members for m in a.aggs):
            slots.setdefault((m.fn, m.column), f"m{len(slots)}")
        merged = run(
            df,
            Analysis(
                name="shared",
                aggs=tuple(Measure(fn, col, slot) for (fn, col), slot in slots.items()),
                group_by=keys,
                where=where,
            ),
            rounding,
        ).persist()
        shared.append(merged)
        for a in members:
            picked = [F.col(slots[m.fn, m.column]).alias(m.alias) for m in a.aggs]
            results[a.name] = ordered(merged.select(*keys, *picked), a)
    return results, shared


def run_fused(
    df: DataFrame, analyses: Iterable[Analysis], rounding: Rounding = round_half_up, staging: str | None = None
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Run analyses with any keys and filters from one scan of ``df``.

    One aggregate holds a grouping set for each different list of keys, and each
    measure once; a measure under a filter takes the rows that pass it.  Returns
    the results by name and that aggregate (one row per group and set): stored in
    ``staging``, or persisted for the caller to unpersist.
    """
    analyses = list(analyses)
    keys = list(dict.fromkeys(k for a in analyses for k in a.group_by))
    sets = list(dict.fromkeys(tuple(sorted(a.group_by, key=keys.index)) for a in analyses))
    filters = list(dict.fromkeys(a.where for a in analyses if a.where))
    passes = {w: f"__f{i}" for i, w in enumerate(filters)}
    slots: dict[tuple[str, str, str | None], str] = {}
    for a in analyses:
        for m in a.aggs:
            slots.setdefault((m.fn, m.column, a.where), f"__m{len(slots)}")

    flagged = df.withColumns({name: F.coalesce(F.expr(w), F.lit(False)) for w, name in passes.items()})
    taken = {name: F.col(column) if where is None else F.when(F.col(passes[where]), F.col(column))
             for (_, column, where), name in slots.items() if column != "*"}
    # Keys under names of their own: a grouping set sets the keys it lacks to
    # null, and a key may be measured too.
    named = {k: f"__k{i}" for i, k in enumerate(keys)}
    base = flagged.select(
        *(F.col(k).alias(named[k]) for k in keys),
        *passes.values(),
        *(c.alias(name) for name, c in taken.items()),
    )
    measures = []
    for (fn, column, where), name in slots.items():
        if column != "*":
            measures.append(measure_column(Measure(fn, name, name), base.schema, rounding))
        else:
            measures.append((F.count_if(passes[where]) if where else F.count(F.lit(1))).alias(name))
    present = [F.count_if(flag).alias(f"{flag}_n") for flag in passes.values()]
    grouped = base.groupingSets([[F.col(named[k]) for k in s] for s in sets], *(F.col(n) for n in named.values())) if keys else base.groupBy()
    which = F.grouping_id() if keys else F.lit(0).cast("bigint")
    fused = grouped.agg(which.alias("__set"), *present, *measures)
    if staging:
        fused.write.mode("overwrite").parquet(staging)
        fused = df.sparkSession.read.schema(fused.schema).parquet(staging)
    else:
        fused = fused.persist()

    results = {}
    for a in analyses:
        own = fused.where(F.col("__set") == sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in a.group_by))
        if a.where and a.group_by:
            own = own.where(F.col(f"{passes[a.where]}_n") > 0)
        picked = own.select(
            *(F.col(named[k]).alias(k) for k in a.group_by),
            *(F.col(slots[m.fn, m.column, a.where]).alias(m.alias) for m in a.aggs),
        )
        if not a.group_by:
            # A grouping set without keys has no row over empty input.
            empty = run(df.where(F.lit(False)), Analysis(a.name, a.aggs), rounding)
            picked = picked.withColumn("__o", F.lit(0)).unionAll(empty.withColumn("__o", F.lit(1))).orderBy("__o").limit(1).drop("__o")
        results[a.name] = ordered(picked, a)
    return results, fused
