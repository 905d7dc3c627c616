"""Calendar dimension (A13) generated from a date range.

The range comes from the data (first and last fact date), so the calendar
has one row per day in between: its size is bounded by the span of days,
not by the volume of facts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed-date Canadian holidays (month, day, name), the
# weekday-anchored ones (month, ISO weekday, first and last day-of-month of
# the window, name), and the first month of the fiscal year.
FIXED_HOLIDAYS = [
    (1, 1, "New Year's Day"),
    (7, 1, "Canada Day"),
    (11, 11, "Remembrance Day"),
    (12, 25, "Christmas Day"),
    (12, 26, "Boxing Day"),
]
FLOATING_HOLIDAYS = [
    (2, 1, 15, 21, "Family Day"),
    (5, 1, 18, 24, "Victoria Day"),
    (8, 1, 1, 7, "Civic Holiday"),
    (9, 1, 1, 7, "Labour Day"),
    (10, 1, 8, 14, "Thanksgiving"),
]
FISCAL_START_MONTH = 4


def iso_dow(d: Column) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return (F.dayofweek(d) + 5) % 7 + 1


def holiday_name(d: Column) -> Column:
    m, dom, dow = F.month(d), F.dayofmonth(d), iso_dow(d)
    e = None
    for mm, dd, name in FIXED_HOLIDAYS:
        cond = (m == mm) & (dom == dd)
        e = F.when(cond, F.lit(name)) if e is None else e.when(cond, F.lit(name))
    for mm, wd, lo, hi, name in FLOATING_HOLIDAYS:
        e = e.when((m == mm) & (dow == wd) & dom.between(lo, hi), F.lit(name))
    return e


def calendar(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """One row per day between the ``start`` and ``end`` DATE columns of a
    one-row DataFrame."""
    days = bounds.select(F.explode(F.sequence(F.col(start), F.col(end), F.expr("INTERVAL 1 DAY"))).alias("date"))
    d = F.col("date")
    m, dow = F.month(d), iso_dow(d)
    fy = F.year(d) + F.when(m >= FISCAL_START_MONTH, 1).otherwise(0)
    fq = F.floor(((m - FISCAL_START_MONTH + 12) % 12) / 3) + 1
    hol = holiday_name(d)
    return days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_id"),
        d,
        dow.cast("bigint").alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_of_week_name"),
        F.dayofmonth(d).cast("bigint").alias("day_of_month"),
        F.weekofyear(d).cast("bigint").alias("week_of_year"),
        m.cast("bigint").alias("month_of_year"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).cast("bigint").alias("quarter"),
        F.year(d).cast("bigint").alias("calendar_year"),
        fy.cast("bigint").alias("fiscal_year"),
        F.concat(F.lit("FQ"), fq.cast("string")).alias("fiscal_quarter"),
        F.when(dow >= 6, 1).otherwise(0).alias("is_weekend"),
        F.when(hol.isNotNull(), 1).otherwise(0).alias("is_canadian_holiday"),
        hol.alias("holiday_name"),
        F.when((dow == 5) & (F.dayofmonth(d).between(1, 7) | F.dayofmonth(d).between(15, 21)), 1)
        .otherwise(0).alias("is_payday_friday"),
    )


def calendar_for(facts: DataFrame, date_col: str) -> DataFrame:
    """Calendar spanning the dates of a fact table."""
    b = facts.agg(F.min(date_col).cast("date").alias("start"), F.max(date_col).cast("date").alias("end"))
    return calendar(b)


def calendar_of(dates) -> DataFrame:
    """Calendar from the first to the last ``date`` of several DataFrames."""
    ends = [d.agg(F.min("date").cast("date").alias("start"), F.max("date").cast("date").alias("end")) for d in dates]
    return calendar(reduce(DataFrame.unionByName, ends).agg(F.min("start").alias("start"), F.max("end").alias("end")))
