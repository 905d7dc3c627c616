"""Time intelligence over any metric.

Every calculation works on *base aggregates* per (group, period), never on
fact rows twice:

* PY copies each period's bases to the period one year later and brings both
  together per cell, so a ratio's PY is the ratio of PY bases.
* To-date (YTD / QTD / MTD) is a running sum of per-period bases inside the
  reset period. Distinct counts are made additive first: each counted value
  contributes once, at the first period it appears in the reset period
  (min per (group, reset, value)), so a running sum of first occurrences is
  the exact distinct count to date - no per-window re-scan of the facts.
* Rolling windows over months use a (month -> window end) bridge joined on
  equality (never a range join), bounded by months x window length.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.numeric import divide, round6
from strata.plans import metrics as M
from strata.plans.star import PERIODS, Star, Where

# Calculation items in their display order.
TIME_ITEMS = ["Current", "PY", "YoY", "YoY %", "YTD", "MTD", "QTD"]


def _nsjoin(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Null-safe equi-join on ``keys`` (right keys dropped)."""
    r = right.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys])
    return left.join(r, cond, how).drop(*[f"__k_{k}" for k in keys])


def _finals(df: DataFrame, metrics: list[str], suffix: str = "") -> list[Column]:
    return [M.METRICS[m].final(*[F.col(f"{i}{suffix}") for i in M.METRICS[m].inputs]).alias(f"{m}{suffix}")
            for m in metrics]


def _exact(metric: str, suffix: str = "") -> Column:
    m = M.METRICS[metric]
    return m.exact(*[F.col(f"{i}{suffix}") for i in m.inputs])


def _next_year(grain: str, col: Column) -> Column:
    """Array of the periods whose prior period is ``col``. Each period has one
    prior period (2025-02-28 -> 2024-02-28, 2024-02-29 -> 2023-02-28), so a day
    has none, one or two such periods."""
    if grain == "year":
        return F.array(col + F.lit(1))
    later = F.add_months(col, 12)
    if grain == "month":
        return F.array(later)
    return F.filter(F.array(later, F.date_add(later, 1)), lambda d: F.add_months(d, -12) == col)


def with_prior_year(star: Star, metrics: list[str], by: list[str], grain: str = "year",
                    where: Column | Where | list | None = None, shown: Column | None = None,
                    changes: dict[str, tuple[str, Callable]] | None = None) -> DataFrame:
    """Metrics and their prior-year values per (by, grain).

    Output columns: by, grain, <m>, <m>_py for each metric, then ``changes``
    (name -> (metric, function of its current and prior value), for instance
    ``yoy_pct``), computed from unrounded values and rounded once. A cell with a prior
    year only is kept when the calendar has its period. A filter on dates
    belongs in ``shown``, a condition over the output's keys: it chooses the
    cells reported and does not reach the prior year.

    Each per-period aggregate goes to its own period and to the one a year
    later, and one more aggregate over (by, grain) brings both together, so
    the facts are read once.
    """
    keys = list(by) + [grain]
    bases = M.bases_of(metrics)
    cur = M.aggregate_bases(star, bases, keys, where)
    at = F.filter(_next_year(grain, F.col(grain)), lambda p: p.isNotNull())
    places = F.concat(F.array(F.struct(F.col(grain).alias("__p"), F.lit(False).alias("__prior"))),
                      F.transform(at, lambda p: F.struct(p.alias("__p"), F.lit(True).alias("__prior"))))
    prior = F.col("__prior")
    cells = (cur.select(*by, *bases, F.inline(places))
             .groupBy(*by, F.col("__p").alias(grain))
             .agg(*[F.max(F.when(~prior, F.col(b))).alias(b) for b in bases],
                  *[F.max(F.when(prior, F.col(b))).alias(f"{b}_py") for b in bases],
                  F.bool_or(~prior).alias("__now")))
    periods = star.calendar().select(PERIODS[grain](F.col("date")).alias(grain)).distinct()
    cells = (cells.join(periods.withColumn("__known", F.lit(True)), grain, "left")
             .where(F.col("__now") | F.col("__known")))
    if shown is not None:
        cells = cells.where(shown)
    return cells.select(*keys, *_finals(cells, metrics), *_finals(cells, metrics, "_py"),
                        *[change(_exact(m), _exact(m, "_py")).alias(n) for n, (m, change) in (changes or {}).items()])


def yoy(cur: Column, py: Column) -> Column:
    """Current minus PY, a blank one counting as 0; blank when both are."""
    return round6(F.when(cur.isNotNull() | py.isNotNull(), F.coalesce(cur, F.lit(0)) - F.coalesce(py, F.lit(0))))


def yoy_pct(cur: Column, py: Column) -> Column:
    """(current - PY) / PY; blank when PY is blank or 0, a blank current counting as 0."""
    return round6(divide(F.coalesce(cur, F.lit(0)) - py, py))


def delta_points(cur: Column, py: Column) -> Column:
    """Percentage-point change x100, blank without PY."""
    return F.when(py.isNotNull(), round6((F.coalesce(cur, F.lit(0)) - py) * F.lit(100)))


RESETS = {
    "year": lambda p: F.year(p),
    "quarter": lambda p: F.year(p) * 10 + F.quarter(p),
    "month": lambda p: F.year(p) * 100 + F.month(p),
}


def to_date(star: Star, metrics: list[str], by: list[str], reset: str = "year", grain: str = "month",
            where: Column | Where | list | None = None, shown: Column | None = None) -> DataFrame:
    """Metrics accumulated from the start of the reset period.

    ``grain`` is ``month`` or ``date``; ``reset`` is ``year``, ``quarter`` or
    ``month``. Output: by, grain, <m> (to-date value) per metric, for every
    period of the calendar from a group's first one in the reset period on: a
    period without rows carries the value before it. Rows without a date belong
    to no period. ``shown`` is a condition over the output's keys, applied last.
    """
    bases = M.bases_of(metrics)
    keys = list(by) + [grain]
    per_fact: dict[str, list[str]] = {}
    for b in bases:
        per_fact.setdefault(M.BASES[b].fact, []).append(b)
    series = []
    for fact, names in per_fact.items():
        needs = [n for b in names for n in M.BASES[b].needs]
        fr = star.frame(fact, keys + needs, where).where(F.col(grain).isNotNull())
        # additive bases, including distinct counts of a unique column (each
        # value occurs once, so it is first seen in its own period)
        add = [b for b in names if M.BASES[b].distinct is None or M.is_plain_count(star, b)]
        if add:
            series.append(fr.groupBy(*keys).agg(*[M.base_agg(star, b).alias(b) for b in add]))
        for b in names:
            if b in add:
                continue
            # a group's first period has a row here even if it counts nothing
            first = (fr.select(*by, F.col(grain), RESETS[reset](F.col(grain)).alias("__r"),
                               M.BASES[b].distinct().alias("__v"))
                     .groupBy(*by, "__r", "__v").agg(F.min(grain).alias(grain)))
            series.append(first.groupBy(*keys).agg(F.count("__v").alias(b)))
    cells = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), series)
    cells = cells.groupBy(*keys).agg(*[F.sum(b).alias(b) for b in bases])
    w = Window.partitionBy(*by, RESETS[reset](F.col(grain))).orderBy(grain)
    total = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.last_day(F.add_months(F.trunc(F.col(grain), reset), {"year": 11, "quarter": 2, "month": 0}[reset]))
    upto = F.coalesce(F.date_sub(F.lead(grain).over(w), 1), end)
    step = F.expr("INTERVAL 1 MONTH" if grain == "month" else "INTERVAL 1 DAY")
    run = cells.select(*keys, *[F.sum(b).over(total).alias(b) for b in bases], upto.alias("__upto"))
    run = run.select(*by, F.explode(F.sequence(F.col(grain), F.col("__upto"), step)).alias(grain), *bases)
    run = run.join(star.calendar().select(PERIODS[grain](F.col("date")).alias(grain)), grain, "left_semi")
    if shown is not None:
        run = run.where(shown)
    return run.select(*keys, *_finals(run, metrics))


def month_bridge(months: DataFrame, width: int) -> DataFrame:
    """(month, window_end) pairs for trailing windows of ``width`` months.

    Built from the distinct months present, so its size is bounded by
    months x width and it is safe to broadcast.
    """
    return months.select("month", F.explode(F.sequence(F.lit(0), F.lit(width - 1))).alias("__k")).select(
        "month", F.add_months("month", F.col("__k")).alias("window_end"))


def rolling(star: Star, metric: str, by: list[str], months: int = 3, where: Column | None = None) -> DataFrame:
    """An additive metric over the trailing ``months`` calendar months
    ending at each month of the group (the window's months are whole months).
    """
    bases = M.METRICS[metric].inputs
    for b in bases:
        if M.BASES[b].distinct is not None:
            raise ValueError("rolling() needs additive bases")
    keys = list(by) + ["month"]
    per = M.aggregate_bases(star, list(bases), keys, where)
    bridge = F.broadcast(month_bridge(per.select("month").distinct(), months))
    win = (per.join(bridge, "month").groupBy(*by, "window_end")
           .agg(*[F.sum(b).alias(b) for b in bases]).withColumnRenamed("window_end", "month"))
    # report the windows ending on months where the group has data
    out = _nsjoin(per.select(*keys), win, keys, "left")
    return out.select(*keys, *_finals(out, [metric]))


def time_items(star: Star, metric: str, by: list[str], where: Column | None = None) -> DataFrame:
    """Every calculation item of one metric as rows at month grain:
    (by, month, time_calc, ordinal, value). MTD at month grain is the month."""
    py = with_prior_year(star, [metric], by, "month", where,
                         changes={"__yoy": (metric, yoy), "__yoy_pct": (metric, yoy_pct)})
    ytd = to_date(star, [metric], by, "year", "month", where).withColumnRenamed(metric, "__ytd")
    qtd = to_date(star, [metric], by, "quarter", "month", where).withColumnRenamed(metric, "__qtd")
    keys = list(by) + ["month"]
    j = reduce(lambda a, b: M._drill_across(a, b, keys), [py, ytd, qtd])
    cur, p = F.col(metric).cast("double"), F.col(f"{metric}_py").cast("double")
    vals = [cur, p, F.col("__yoy"), F.col("__yoy_pct"), F.col("__ytd").cast("double"), cur, F.col("__qtd").cast("double")]
    arr = F.array(*[F.struct(F.lit(n).alias("time_calc"), F.lit(i).alias("ordinal"), v.alias("value"))
                    for i, (n, v) in enumerate(zip(TIME_ITEMS, vals))])
    return j.select(*keys, F.inline(arr))


__all__ = ["with_prior_year", "to_date", "rolling", "time_items", "yoy", "yoy_pct", "delta_points",
           "month_bridge"]
