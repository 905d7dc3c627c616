"""Measures whose value depends on the period context: stock at the last
snapshot (M31 with G08, T02, T05-T07) and rolling distinct counts (M41, E14 over
M13, M25).

Both start from one aggregate of the fact per (keys, date or period); windows run
over these aggregates or over the calendar, never over fact rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.numeric import cents, money_sum
from strata.plans import metrics as M
from strata.plans.star import PERIODS, Star
from strata.plans.timecalc import _nsjoin


def _stock_per_date(star: Star, by: list[str], where=None) -> DataFrame:
    return (star.frame(M.INV, by, where).groupBy(*by, "snapshot_date")
            .agg(money_sum("inventory_value_cad").alias("v")))


def stock_rollup(star: Star, by: list[str], where=None, cube: bool = False) -> DataFrame:
    """M31 with totals (G08): every grouping set takes its own last snapshot date,
    so a total is the stock on the last date of all, not the sum of the rows."""
    per = _stock_per_date(star, by, where)
    n = len(by)
    sets = [by[:k] for k in range(n, -1, -1)] if not cube else \
        [[c for i, c in enumerate(by) if not m >> (n - 1 - i) & 1] for m in range(2 ** n)]
    # The date stands in every set; the grouping id is that of ``by`` alone.
    cells = (per.groupingSets([[*s, "snapshot_date"] for s in sets], *by, "snapshot_date")
             .agg(F.sum("v").alias("v"), F.shiftright(F.grouping_id(), 1).alias("grouping_id")))
    return cells.groupBy(*by, "grouping_id").agg(cents(F.max_by("v", "snapshot_date")).alias("inventory_value"))


def _month_grid(star: Star, groups: DataFrame | None) -> DataFrame:
    """A row per month of the calendar, for each row of ``groups``. The calendar's
    ends are two scalars, so the months are an exploded sequence and no join."""
    first, last = star.calendar().agg(F.min("date"), F.max("date")).first()
    if first is None:
        return (star.calendar() if groups is None else groups.withColumn("date", F.lit(None).cast("date"))).select(
            *(groups.columns if groups is not None else []), F.col("date").alias("month")).limit(0)
    month = lambda d: F.trunc(F.lit(d), "month")
    months = F.explode(F.sequence(month(first), month(last), F.expr("INTERVAL 1 MONTH"))).alias("month")
    groups = star.calendar().sparkSession.range(1).select() if groups is None else groups
    return groups.select("*", months)


def over_months(star: Star, metrics: list[str], by: list[str], grain: str = "month", where=None) -> DataFrame:
    """Metrics per (by, grain), ``grain`` being ``month`` or ``year``, in which
    measures of a dimension (M16, M20-M22) stand as in the model: no relationship
    leads from the calendar to them, so each period of the calendar shows the same
    value. The dimension is aggregated once over ``by`` and its few rows are spread
    over the periods; the facts' measures join them.
    """
    free = [m for m in metrics if not any(star.fact_keys.get(M.BASES[b].fact) for b in M.METRICS[m].inputs)]
    dated = [m for m in metrics if m not in free]
    undated = Star(star.tables, {f: c for f, c in star.fact_dates.items() if star.fact_keys.get(f)}, star.fact_keys,
                   star.attrs, star.hops, star.unique)
    keys = [*by, grain]
    parts = []
    if free:
        spread = _month_grid(star, M.evaluate(undated, free, by, where))
        if grain == "year":
            spread = spread.select(*by, F.year("month").cast("bigint").alias("year"), *free).distinct()
        parts.append(spread.select(*keys, *free))
    if dated:
        parts.append(M.evaluate(star, dated, keys, where))
    out = parts[0] if len(parts) == 1 else M._drill_across(*parts, keys)
    return out.select(*keys, *metrics)


def _last_in(star: Star, by: list[str], grain: str, where=None) -> DataFrame:
    """(by, grain, d, v): the last snapshot date of a period and the stock on it."""
    per = _stock_per_date(star, by, where).withColumn(grain, PERIODS[grain](F.col("snapshot_date")))
    last = per.groupBy(*by, grain).agg(F.max(F.struct(F.col("snapshot_date").alias("d"), "v")).alias("last"))
    return last.select(*by, grain, "last.*")


def stock_with_prior_year(star: Star, by: list[str], where=None) -> DataFrame:
    """M31 and its prior year (T02) per (by, year): each year takes its own last
    snapshot. A cell with a prior year only is kept while the calendar has its year."""
    cur = _last_in(star, by, "year", where)
    places = F.array(F.struct(F.col("year").alias("y"), F.lit(False).alias("prior")),
                     F.struct((F.col("year") + 1).alias("y"), F.lit(True).alias("prior")))
    cells = (cur.select(*by, "v", F.inline(places)).groupBy(*by, F.col("y").alias("year"))
             .agg(F.max(F.when(~F.col("prior"), F.col("v"))).alias("now"),
                  F.max(F.when(F.col("prior"), F.col("v"))).alias("before")))
    years = star.calendar().select(F.year("date").alias("year")).distinct()
    return cells.join(years, "year", "left_semi").select(
        *by, "year", cents("now").alias("inventory_value"), cents("before").alias("inventory_value_py"))


def stock_to_date(star: Star, by: list[str], grain: str = "year", where=None) -> DataFrame:
    """M31 to date (T05-T07) per (by, month): the stock at the last snapshot since
    the start of the month's ``grain``, for all months of the calendar in which
    there has been one; a month without a snapshot shows the last before it."""
    cur = _last_in(star, by, "month", where)
    grid = _month_grid(star, cur.select(*by).distinct() if by else None)
    both = _nsjoin(grid, cur, [*by, "month"])
    w = (Window.partitionBy(*by, PERIODS[grain](F.col("month"))).orderBy("month")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = both.withColumn("x", F.last("v", ignorenulls=True).over(w)).where(F.col("x").isNotNull())
    return out.select(*by, "month", cents("x").alias("inventory_value_to_date"))


def rolling_distinct(star: Star, fact: str, member: str | Column, by: list[str], months: int, name: str,
                     where=None) -> DataFrame:
    """Exact distinct count of ``member`` (blank ones not) over the last ``months``
    months, per (by, month), for every month of the calendar.

    Distinct (by, member, month) rows are cut into spans in which the member
    counts: a month's span ends where the member's next one begins, so spans of a
    member never overlap. Each gives +1 at its start and -1 at its end; these are
    summed per month, and a running sum over the months is the count. Nothing is
    scanned twice, and the window per member holds its months at most.
    """
    m = F.col(member) if isinstance(member, str) else member
    seen = (star.frame(fact, [*by, "month"], where).select(*by, m.alias("__m"), "month")
            .where(F.col("__m").isNotNull()).distinct())
    nxt = F.lead("month").over(Window.partitionBy(*by, "__m").orderBy("month"))
    end = F.add_months("month", months)
    spans = seen.withColumn("__next", nxt).withColumn("__end", F.least(end, F.coalesce("__next", end)))
    events = F.array(F.struct(F.col("month").alias("at"), F.lit(1).alias("n")),
                     F.struct(F.col("__end").alias("at"), F.lit(-1).alias("n")))
    change = spans.select(*by, F.inline(events)).groupBy(*by, F.col("at").alias("month")).agg(F.sum("n").alias("n"))
    grid = _month_grid(star, change.select(*by).distinct() if by else None)
    both = _nsjoin(grid, change, [*by, "month"])
    w = Window.partitionBy(*by).orderBy("month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return both.select(*by, "month", F.coalesce(F.sum("n").over(w), F.lit(0)).cast("bigint").alias(name))
