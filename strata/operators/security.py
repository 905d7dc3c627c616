"""Row- and column-level security over a ``Star``.

A row filter on a dimension reaches every fact related to it through a
``left_semi`` join on the relationship key: facts whose key is NULL or has
no allowed dimension row disappear, as under the model's role filters. The
allowed-key side is a projection of one dimension (small next to the facts),
so the semi-join can be broadcast when its size allows.
"""

from __future__ import annotations

from collections import ChainMap

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.plans.star import LazyTables, Star

# Personal-data columns hidden by the analyst role.
PII_COLUMNS = ["email_hash", "phone_hash", "first_name", "last_name", "birth_year", "home_postal_code"]


def restrict(star: Star, dim: str, predicate: Column) -> Star:
    """Filter ``dim`` and every table related to it (directly or through a
    snowflake hop) to the rows the predicate allows."""
    allowed = star.tables[dim].where(predicate)
    t = {dim: allowed}
    # a snowflaked dimension restricts its child dimension first
    for child, (parent, pkey) in star.hops.items():
        if child == dim:
            t[parent] = star.tables[parent].join(allowed.select(pkey), pkey, "left_semi")
            dim, allowed = parent, t[parent]
    facts = {fact: keys[dim] for fact, keys in star.fact_keys.items() if dim in keys and fact in star.tables}
    kept = LazyTables({fact: lambda fact=fact, key=key: star.tables[fact].join(allowed.select(key), key, "left_semi")
                       for fact, key in facts.items()})
    return Star(ChainMap(kept, t, star.tables), star.fact_dates, star.fact_keys, star.attrs, star.hops, star.unique)


def rls_region(star: Star, province: str) -> Star:
    """Only stores of one province code."""
    return restrict(star, "dim_store", F.col("province_code") == province)


def rls_banner(star: Star, category: str) -> Star:
    """Only banners of one category (banner -> store -> facts)."""
    return restrict(star, "dim_banner", F.col("banner_category") == category)


def rls_dynamic(star: Star, mapping: DataFrame, user: str) -> Star:
    """Banners mapped to ``user`` in a (user_email, banner_id) table."""
    allowed = mapping.where(F.col("user_email") == user).select("banner_id").distinct()
    stores = star.tables["dim_store"].join(allowed, "banner_id", "left_semi")
    return restrict(star.with_table("dim_store", stores), "dim_store", F.lit(True))


def user_banner_map(spark: SparkSession, rows: list[tuple[str, int]]) -> DataFrame:
    return spark.createDataFrame(rows, "user_email string, banner_id int")


def ols_drop(df: DataFrame, hidden: list[str] | None = None) -> DataFrame:
    """Hand out the table without the hidden columns."""
    hidden = PII_COLUMNS if hidden is None else hidden
    return df.drop(*[c for c in hidden if c in df.columns])
