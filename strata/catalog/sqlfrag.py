"""SQL text fragments for the DuckDB oracle queries.

They spell, in plain SQL, the same arithmetic as ``strata.functions.numeric``
so both engines produce bit-identical doubles.
"""

D = "::DOUBLE"


def scaled(x: str) -> str:
    return f"CAST(round(({x}) * 10000.0{D}) AS BIGINT)"


def msum(x: str) -> str:
    return f"sum({scaled(x)})"


def cents(s: str) -> str:
    return f"(round(CAST({s} AS DOUBLE) / 100.0{D}) / 100.0{D})"


def money_avg(s: str, n: str) -> str:
    return f"(round(CAST({s} AS DOUBLE) / (NULLIF({n}, 0) * 100.0{D})) / 100.0{D})"


def money(s: str) -> str:
    """Unrounded money."""
    return f"(CAST({s} AS DOUBLE) / 10000.0{D})"


def money_mean(s: str, n: str) -> str:
    """Unrounded money per count."""
    return f"(CAST({s} AS DOUBLE) / NULLIF({n} * 10000.0{D}, 0))"


def round6(x: str) -> str:
    return f"(round(({x}) * 1000000.0{D}) / 1000000.0{D})"


def divide(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def ratio(a: str, b: str) -> str:
    return round6(divide(a, b))
