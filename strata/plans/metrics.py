"""Governed metric layer: named measures evaluated over a ``Star``.

A metric is a final expression over *base aggregates*; each base aggregate
belongs to one fact (or to the customer dimension). ``evaluate`` aggregates
every fact involved once, on the requested grouping (plain, ROLLUP, CUBE or
explicit grouping sets), and joins the per-fact results on the grouping keys
(drill-across: facts are never joined to each other row by row). Distinct
counts and ratios are computed per grouping set from base aggregates, so
totals are re-aggregated, never summed from children.

Blank semantics follow the model: a sum over no rows is NULL, a division by
0 or NULL is NULL, a ``= 0`` test also matches NULL where the model does.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.numeric import MONEY_SCALE, cents, divide, money_avg, money_sum, ratio, round6
from strata.plans.star import Star, Where

LINE = "fact_sales_line_item"
TXN = "fact_sales_transaction"
INV = "fact_inventory_snapshot"
LOY = "fact_loyalty_event"
CUST = "dim_customer"


@dataclass(frozen=True)
class Base:
    fact: str
    agg: Callable[[], Column]
    needs: tuple[str, ...] = ()
    # for distinct counts: the counted expression (enables to-date running
    # counts by first occurrence instead of re-scanning every window) and the
    # column it counts (a declared unique column turns it into a plain count)
    distinct: Callable[[], Column] | None = None
    distinct_col: str | None = None


def is_plain_count(star: Star, name: str) -> bool:
    """True when a distinct-count base counts a column unique in its table."""
    b = BASES[name]
    return b.distinct is not None and b.distinct_col in star.unique.get(b.fact, ())


def base_agg(star: Star, name: str) -> Column:
    b = BASES[name]
    if is_plain_count(star, name):
        return F.count(b.distinct())
    return b.agg()


def _c(n):
    return F.col(n)


BASES: dict[str, Base] = {
    # sales lines
    "s_net": Base(LINE, lambda: money_sum("line_subtotal_cad")),
    "s_cost": Base(LINE, lambda: money_sum("line_cost_cad")),
    "n_units": Base(LINE, lambda: F.sum("quantity")),
    "n_skus": Base(LINE, lambda: F.count_distinct("product_id"), distinct=lambda: _c("product_id")),
    "s_disc": Base(LINE, lambda: money_sum(_c("quantity") * _c("unit_discount_cad"))),
    "s_list": Base(LINE, lambda: money_sum(_c("quantity") * _c("unit_list_price_cad"))),
    "s_promo": Base(LINE, lambda: money_sum(F.when(_c("promotion_id").isNotNull(), _c("line_subtotal_cad")))),
    "s_own": Base(LINE, lambda: money_sum(F.when(_c("is_own_brand") == 1, _c("line_subtotal_cad"))),
                  ("is_own_brand",)),
    # transactions
    "s_rev": Base(TXN, lambda: money_sum("total_amount_cad")),
    "n_txn": Base(TXN, lambda: F.count_distinct("transaction_id"), distinct=lambda: _c("transaction_id"),
                  distinct_col="transaction_id"),
    "n_active": Base(TXN, lambda: F.count_distinct("customer_id"), distinct=lambda: _c("customer_id")),
    "n_loyal": Base(TXN, lambda: F.count_distinct(
        F.when(_c("is_loyalty_transaction") == 1, _c("transaction_id"))),
        distinct=lambda: F.when(_c("is_loyalty_transaction") == 1, _c("transaction_id")),
        distinct_col="transaction_id"),
    # inventory
    "n_onhand": Base(INV, lambda: F.sum("on_hand_units")),
    "n_oos": Base(INV, lambda: F.count_if(_c("is_out_of_stock") == 1)),
    "n_inv_rows": Base(INV, lambda: F.count(F.lit(1))),
    "n_dos_sum": Base(INV, lambda: F.sum("days_of_supply")),
    "n_dos_cnt": Base(INV, lambda: F.count("days_of_supply")),
    # loyalty events
    "n_earn": Base(LOY, lambda: F.sum(F.when(_c("points_delta") > 0, _c("points_delta")))),
    "n_burn": Base(LOY, lambda: -F.sum(F.when(_c("points_delta") < 0, _c("points_delta")))),
    # customer dimension
    "n_members": Base(CUST, lambda: F.count_distinct("customer_business_key")),
    "n_x_members": Base(CUST, lambda: F.count_distinct(
        F.when(_c("is_cross_category") == 1, _c("customer_business_key")))),
    "s_spend": Base(CUST, lambda: money_sum("lifetime_spend_cad")),
    "n_spend": Base(CUST, lambda: F.count("lifetime_spend_cad")),
    "s_spend_x1": Base(CUST, lambda: money_sum(F.when(_c("is_cross_category") == 1, _c("lifetime_spend_cad")))),
    "n_spend_x1": Base(CUST, lambda: F.count(F.when(_c("is_cross_category") == 1, _c("lifetime_spend_cad")))),
    "s_spend_x0": Base(CUST, lambda: money_sum(
        F.when(F.coalesce(_c("is_cross_category"), F.lit(0)) == 0, _c("lifetime_spend_cad")))),
    "n_spend_x0": Base(CUST, lambda: F.count(
        F.when(F.coalesce(_c("is_cross_category"), F.lit(0)) == 0, _c("lifetime_spend_cad")))),
}


@dataclass(frozen=True)
class Metric:
    """``final`` is the value shown, rounded; ``exact`` the same unrounded, for
    measures computed from this one, which round once at their own end."""

    name: str
    inputs: tuple[str, ...]
    final: Callable[..., Column]
    label: str
    exact: Callable[..., Column]


def _m(name, inputs, final, label="", exact=None):
    return Metric(name, tuple(inputs), final, label, exact or final)


def _money(name, inputs, total, label):
    return _m(name, inputs, lambda *b: cents(total(*b)), label, lambda *b: total(*b) / F.lit(MONEY_SCALE))


def _average(name, inputs, label):
    return _m(name, inputs, money_avg, label, lambda s, n: F.try_divide(s, n * F.lit(MONEY_SCALE)))


def _ratio(name, inputs, parts, label):
    return _m(name, inputs, lambda *b: ratio(*parts(*b)), label, lambda *b: divide(*parts(*b)))


def _multiple(s1, n1, s0, n0):
    return divide(divide(s1, n1), divide(s0, n0))


METRICS: dict[str, Metric] = {m.name: m for m in [
    _money("net_sales", ["s_net"], lambda s: s, "Net Sales"),
    _money("total_cost", ["s_cost"], lambda s: s, "Total Cost"),
    _money("gross_margin", ["s_net", "s_cost"], lambda n, c: n - c, "Gross Margin"),
    _ratio("gross_margin_pct", ["s_net", "s_cost"], lambda n, c: (n - c, n), "Gross Margin %"),
    _money("revenue_incl_tax", ["s_rev"], lambda s: s, "Total Revenue (incl tax)"),
    _m("transactions", ["n_txn"], lambda n: n, "Total Transactions"),
    _m("units", ["n_units"], lambda n: n, "Total Units"),
    _average("avg_txn_value", ["s_rev", "n_txn"], "Avg Transaction Value"),
    _ratio("units_per_txn", ["n_units", "n_txn"], lambda u, n: (u, n), "Units per Transaction"),
    _m("active_customers", ["n_active"], lambda n: n, "Active Customers"),
    _m("loyalty_txns", ["n_loyal"], lambda n: n, "Loyalty Transactions"),
    _ratio("loyalty_txn_pct", ["n_loyal", "n_txn"], lambda a, b: (a, b), "Loyalty Transaction %"),
    _m("loyalty_members", ["n_members"], lambda n: n, "Loyalty Members"),
    _m("points_earned", ["n_earn"], lambda n: n, "Points Earned"),
    _m("points_redeemed", ["n_burn"], lambda n: n, "Points Redeemed"),
    _ratio("redemption_rate", ["n_burn", "n_earn"], lambda a, b: (a, b), "Redemption Rate"),
    _average("avg_lifetime_spend", ["s_spend", "n_spend"], "Avg Customer Lifetime Spend"),
    _ratio("cross_shop_pct", ["n_x_members", "n_members"], lambda a, b: (a, b), "Cross-Shop %"),
    _m("cross_shop_multiple", ["s_spend_x1", "n_spend_x1", "s_spend_x0", "n_spend_x0"],
       lambda *b: round6(_multiple(*b)), "Cross-Shop Spend Multiple", _multiple),
    _money("own_brand_sales", ["s_own"], lambda s: s, "Own-Brand Sales"),
    _ratio("own_brand_mix", ["s_own", "s_net"], lambda a, b: (a, b), "Own-Brand Mix %"),
    _m("distinct_skus", ["n_skus"], lambda n: n, "Distinct SKUs Sold"),
    _money("discount_amount", ["s_disc"], lambda s: s, "Discount Amount"),
    _money("promo_sales", ["s_promo"], lambda s: s, "Promo Sales"),
    _ratio("markdown_rate", ["s_disc", "s_net"], lambda d, n: (d, n + d), "Markdown Rate"),
    _money("list_amount", ["s_list"], lambda s: s, "List Amount"),
    _m("on_hand_units", ["n_onhand"], lambda n: n, "On-Hand Units"),
    _ratio("out_of_stock_rate", ["n_oos", "n_inv_rows"], lambda a, b: (a, b), "Out-of-Stock Rate"),
    _ratio("avg_days_supply", ["n_dos_sum", "n_dos_cnt"], lambda a, b: (a, b), "Avg Days of Supply"),
]}


def bases_of(metrics) -> list[str]:
    out: dict[str, None] = {}
    for m in metrics:
        for b in METRICS[m].inputs:
            out[b] = None
    return list(out)


def aggregate_bases(star: Star, bases: list[str], by: list[str], where: Column | Where | list | None = None,
                    grouping: str = "plain", sets: list[list[str]] | None = None,
                    fact_where: dict[str, Column] | None = None) -> DataFrame:
    """One aggregate per fact over ``by``; per-fact results joined on the keys.

    ``grouping`` is ``plain``, ``rollup`` or ``cube``; ``sets`` gives explicit
    grouping sets. Non-plain groupings add a ``grouping_id`` column that is
    part of the drill-across join key, so a total row never meets a detail
    row whose key happens to be NULL.
    """
    per_fact: dict[str, list[str]] = {}
    for b in bases:
        per_fact.setdefault(BASES[b].fact, []).append(b)
    parts = []
    keys = list(by)
    for fact, names in per_fact.items():
        needs = [n for b in names for n in BASES[b].needs]
        w = list(where) if isinstance(where, list) else [] if where is None else [where]
        if fact_where and fact in fact_where:
            w.append(fact_where[fact])
        df = star.frame(fact, list(by) + needs, where=w)
        aggs = [base_agg(star, b).alias(b) for b in names]
        if sets is not None:
            df = df.groupingSets(sets, *by).agg(*aggs, F.grouping_id().alias("grouping_id"))
        elif grouping == "rollup":
            df = df.rollup(*by).agg(*aggs, F.grouping_id().alias("grouping_id"))
        elif grouping == "cube":
            df = df.cube(*by).agg(*aggs, F.grouping_id().alias("grouping_id"))
        else:
            df = df.groupBy(*by).agg(*aggs)
        parts.append(df)
    if grouping != "plain" or sets is not None:
        keys = keys + ["grouping_id"]
    return reduce(lambda a, b: _drill_across(a, b, keys), parts)


def _drill_across(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    if not keys:
        # Both sides are single-row global aggregates.
        return _join_global(a, b)
    # Rename the right side's keys: both sides may descend from the same
    # dimension scan, and a null-safe full join on renamed keys is unambiguous.
    rb = b.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in b.columns if c not in keys])
    cond = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    j = a.join(rb, cond, "full")
    cols = [F.coalesce(F.col(k), F.col(f"__r_{k}")).alias(k) for k in keys]
    rest = [c for c in a.columns if c not in keys] + [c for c in b.columns if c not in keys]
    return j.select(*cols, *rest)


def _join_global(a: DataFrame, b: DataFrame) -> DataFrame:
    # Two one-row aggregates: attach a constant key and equi-join on it.
    k = "__one"
    return a.withColumn(k, F.lit(1)).join(b.withColumn(k, F.lit(1)), k, "full").drop(k)


def evaluate(star: Star, metrics: list[str], by: list[str] | tuple = (),
             where: Column | Where | list | None = None,
             grouping: str = "plain", sets: list[list[str]] | None = None,
             fact_where: dict[str, Column] | None = None) -> DataFrame:
    """``metric(names).by(attrs).where(p)`` as a DataFrame (one row per group)."""
    by = list(by)
    base = aggregate_bases(star, bases_of(metrics), by, where, grouping, sets, fact_where)
    outs = [METRICS[m].final(*[F.col(i) for i in METRICS[m].inputs]).alias(m) for m in metrics]
    extra = ["grouping_id"] if (grouping != "plain" or sets is not None) else []
    return base.select(*by, *extra, *outs)
