"""KPI card text and monthly series.

Cards and series are built from metric values per period; the series of a
card is one ordered string per card, made from at most one entry per month
of the calendar (a bounded collection, never a collection of fact rows).
Numbers are rounded half away from zero at scale 0 before formatting, so
the text does not depend on a formatter's tie rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.plans import metrics as M
from strata.plans import timecalc as T
from strata.plans.star import Star

# The cards (title, metric, value format, change kind), the
# base year of the month index, and the drawing boxes of the series.
CARDS = [
    ("NET SALES", "net_sales", "money_short", "pct"),
    ("TRANSACTIONS", "transactions", "short", "pct"),
    ("AVG BASKET", "avg_txn_value", "money2", "pct"),
    ("GROSS MARGIN %", "gross_margin_pct", "pct1", "pts"),
    ("LOYALTY PENETRATION", "loyalty_txn_pct", "pct1", "pts"),
    ("UNITS / TRANSACTION", "units_per_txn", "num2", "pct"),
]
BASE_YEAR = 2024
CARD_BOX = {"x0": 188.0, "x_mid": 48.0, "x_span": 96.0, "y0": 84.0, "y_span": 50.0}
SPARK_BOX = {"x_mid": 50.0, "x_span": 100.0, "y0": 28.0, "y_span": 26.0}


def rnd(x: Column, digits: int) -> Column:
    k = float(10 ** digits)
    return F.round(x * F.lit(k)) / F.lit(k)


def fmt(x: Column, digits: int) -> Column:
    return F.format_string(f"%.{digits}f", rnd(x, digits))


def general(x: Column) -> Column:
    """Number as text without a trailing '.0' for whole values."""
    return F.when(x == F.floor(x), F.floor(x).cast("bigint").cast("string")).otherwise(x.cast("string"))


def _short(v: Column) -> Column:
    a = F.abs(v)
    return (F.when(a >= 1e9, F.concat(fmt(v / F.lit(1e9), 1), F.lit("B")))
            .when(a >= 1e6, F.concat(fmt(v / F.lit(1e6), 1), F.lit("M")))
            .when(a >= 1e3, F.concat(fmt(v / F.lit(1e3), 1), F.lit("K")))
            .otherwise(fmt(v, 0)))


def value_text(v: Column, kind: str) -> Column:
    v = v.cast("double")
    if kind == "money_short":
        return F.concat(F.lit("$"), _short(v))
    if kind == "short":
        return _short(v)
    if kind == "money2":
        return F.concat(F.lit("$"), F.format_number(rnd(v, 2), 2))
    if kind == "pct1":
        return F.concat(fmt(v * F.lit(100.0), 1), F.lit("%"))
    return fmt(v, 2)


def chip_text(d: Column, kind: str) -> Column:
    sign = F.when(d < 0, F.lit("-")).otherwise(F.lit("+"))
    if kind == "pct":
        body = F.concat(sign, fmt(F.abs(d) * F.lit(100.0), 1), F.lit("% vs PY"))
    else:
        body = F.concat(sign, fmt(F.abs(d), 1), F.lit(" pts vs PY"))
    return F.when(d.isNull(), F.lit("no PY data")).otherwise(body)


def kpi_cards(star: Star, by: list[str] | None = None, grain: str = "year") -> DataFrame:
    """Value text and vs-PY chip of every card per period."""
    by = list(by or [])
    metrics = [m for _, m, _, _ in CARDS]
    d = T.with_prior_year(star, metrics, by, grain)
    rows = []
    for title, m, vkind, ckind in CARDS:
        cur, py = F.col(m), F.col(f"{m}_py")
        delta = T.yoy_pct(cur, py) if ckind == "pct" else T.delta_points(cur, py)
        rows.append(F.struct(F.lit(title).alias("card"), F.when(cur.isNotNull(), value_text(cur, vkind)).alias("value_text"),
                             chip_text(delta, ckind).alias("chip_text"),
                             F.when(delta.isNotNull(), delta >= 0).alias("is_up")))
    return d.select(*by, grain, F.inline(F.array(*rows)))


def _monthly(star: Star, where: Column | None) -> DataFrame:
    metrics = [m for _, m, _, _ in CARDS]
    wide = M.evaluate(star, metrics, ["month"], where)
    arr = F.array(*[F.struct(F.lit(t).alias("card"), F.col(m).cast("double").alias("v")) for t, m, _, _ in CARDS])
    idx = (F.year("month") - F.lit(BASE_YEAR)) * 12 + F.month("month")
    return wide.select(idx.alias("idx"), F.inline(arr))


def _ordered_join(txt: Column, idx: Column) -> Column:
    entries = F.array_sort(F.collect_list(F.struct(idx.alias("i"), txt.alias("t"))))
    return F.array_join(F.transform(entries, lambda e: e["t"]), " ")


def kpi_points(star: Star, where: Column | None = None) -> DataFrame:
    """Per card, the month series normalised to the card's box as an
    ordered 'x,y' point string, plus the last point's y."""
    s = _monthly(star, where).where(F.col("v").isNotNull())
    w = Window.partitionBy("card")
    s = s.select("card", "idx", "v", F.min("idx").over(w).alias("mn_i"), F.max("idx").over(w).alias("mx_i"),
                 F.min("v").over(w).alias("mn_v"), F.max("v").over(w).alias("mx_v"))
    span, rng = F.col("mx_i") - F.col("mn_i"), F.col("mx_v") - F.col("mn_v")
    x = F.lit(CARD_BOX["x0"]) + F.when(span == 0, F.lit(CARD_BOX["x_mid"])).otherwise(
        (F.col("idx") - F.col("mn_i")) / span * F.lit(CARD_BOX["x_span"]))
    y = F.lit(CARD_BOX["y0"]) - F.when(rng == 0, F.lit(0.5)).otherwise((F.col("v") - F.col("mn_v")) / rng) \
        * F.lit(CARD_BOX["y_span"])
    s = s.withColumn("txt", F.concat(fmt(x, 1), F.lit(","), fmt(y, 1))).withColumn("y", y)
    return s.groupBy("card").agg(_ordered_join(F.col("txt"), F.col("idx")).alias("points"),
                                 F.count(F.lit(1)).alias("n_points"),
                                 fmt(F.max_by("y", "idx"), 1).alias("last_y"))


def kpi_spark(star: Star, where: Column | None = None) -> DataFrame:
    """Per card, the sparkline points scaled by the series maximum;
    NULL with fewer than two points or a zero maximum."""
    s = _monthly(star, where)
    w = Window.partitionBy("card")
    s = s.select("card", "idx", "v", F.min("idx").over(w).alias("mn_i"), F.max("idx").over(w).alias("mx_i"),
                 F.max("v").over(w).alias("mx_v"))
    span = F.col("mx_i") - F.col("mn_i")
    x = rnd(F.when(span == 0, F.lit(SPARK_BOX["x_mid"])).otherwise(
        (F.col("idx") - F.col("mn_i")) / span * F.lit(SPARK_BOX["x_span"])), 1)
    y = rnd(F.lit(SPARK_BOX["y0"]) - F.col("v") / F.col("mx_v") * F.lit(SPARK_BOX["y_span"]), 1)
    s = s.where(F.col("v").isNotNull()).withColumn("txt", F.concat(general(x), F.lit(","), general(y)))
    g = s.groupBy("card").agg(_ordered_join(F.col("txt"), F.col("idx")).alias("pts"),
                              F.count(F.lit(1)).alias("n_points"), F.max("mx_v").alias("mx_v"))
    ok = (F.col("n_points") >= 2) & (F.col("mx_v") != 0)
    return g.select("card", F.when(ok, F.col("pts")).alias("points"), "n_points")
