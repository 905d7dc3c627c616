"""Numeric helpers shared by every metric.

Money is aggregated exactly: each row is scaled to an integer number of
1/10,000 units and summed as BIGINT, so a total does not depend on the order
in which partitions are combined (a DOUBLE sum does) and the same figure comes
out on every engine and every re-run. Outputs are rounded with a scale-0
``round`` on a DOUBLE that already sits on a whole number of cents, which is
exact and engine-independent.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fractional digits kept by the exact money sum, and the digits
# metric outputs are rounded to.
MONEY_SCALE = 10000.0
RATIO_DIGITS = 1000000.0


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def scaled(x) -> Column:
    """Row value as a BIGINT count of 1/10,000 units."""
    return F.round(_c(x) * F.lit(MONEY_SCALE)).cast("bigint")


def money_sum(x) -> Column:
    """Exact sum of a money column, in 1/10,000 units (BIGINT)."""
    return F.sum(scaled(x))


def cents(scaled_total) -> Column:
    """Scaled BIGINT total -> DOUBLE money rounded to the cent."""
    return F.round(_c(scaled_total) / F.lit(100.0)) / F.lit(100.0)


def money_avg(scaled_total, n) -> Column:
    """Scaled total divided by a count, rounded to the cent; NULL on 0 / NULL."""
    return F.round(F.try_divide(_c(scaled_total), _c(n) * F.lit(100.0))) / F.lit(100.0)


def round6(x) -> Column:
    return F.round(_c(x) * F.lit(RATIO_DIGITS)) / F.lit(RATIO_DIGITS)


def divide(num, den) -> Column:
    """Model-style DIVIDE: NULL when the denominator is 0 or NULL (DOUBLE result)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def ratio(num, den) -> Column:
    """Rounded ``divide``; the metric layer's ratio output."""
    return round6(divide(num, den))
