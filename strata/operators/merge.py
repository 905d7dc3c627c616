"""Keyed upsert, in-batch de-duplication and change capture.

All three are single plans over DataFrames, so they work on Parquet tables
without a transaction log: the caller publishes the returned DataFrame as a
new table version (see ``strata.sources.landing.publish``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import column_list

CHANGE_TYPES = ("insert", "update_preimage", "update_postimage", "delete")


def dedup_latest(df: DataFrame, keys, order_by: list[str] | str) -> DataFrame:
    """One row per key, the greatest by ``order_by``; ties broken by the
    whole row, so the pick is total and repeatable.

    Written as ``max`` of a struct rather than ``row_number`` over a window:
    the aggregate combines map-side, so a key holding a third of the batch is
    reduced inside each input task before it is shuffled, where a window
    would sort that key's rows in one task.
    """
    keys = column_list(keys)
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    tie = [c for c in rest if c not in order]
    pick = F.max(F.struct(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)],
                          *[F.col(c) for c in tie])).alias("__pick")
    out = df.groupBy(*keys).agg(pick)
    return out.select(*keys, *[F.col(f"__pick.__o{i}").alias(c) for i, c in enumerate(order)],
                      *[F.col(f"__pick.{c}") for c in tie]).select(*df.columns)


# Fixed value: how many ways the rows with a NULL key are spread.
NULL_KEY_SPREAD = 4096


def _any_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def _salt(keys: list[str], cols: list[str]) -> Column:
    """0 for rows with a full key; for rows with a NULL key (which can never
    match) a hash of the row, so a mass of NULL keys is spread over many join
    partitions instead of landing in one - AQE does not split skew in a full
    outer join. One scan, no extra branch."""
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(NULL_KEY_SPREAD))
    return F.when(_any_null(keys), spread).otherwise(F.lit(0)).cast("int")


def _evolve(df: DataFrame, columns: list[str], types: dict) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    for c in missing:
        df = df.withColumn(c, F.lit(None).cast(types[c]))
    return df


def merge_upsert(target: DataFrame | None, source: DataFrame, keys, update_cols: list[str] | None = None,
                 order_by: list[str] | str | None = None, assume_unique: bool = False) -> DataFrame:
    """Upsert ``source`` into ``target`` on business keys.

    Matched rows take the source value of every column (or only of
    ``update_cols``), even a NULL; unmatched source rows are inserted; other
    target rows are kept. The source is reduced to one row per key first
    (``order_by`` decides which, without it the greatest row), so a repeated
    key cannot make the match ambiguous; ``assume_unique`` skips that. Columns new in the source are added (schema evolution).
    ``target=None`` is the first load.
    """
    keys = column_list(keys)
    if not assume_unique:
        source = dedup_latest(source, keys, order_by or [])
    if target is None:
        return source
    types = {f.name: f.dataType for f in target.schema.fields}
    types.update({f.name: f.dataType for f in source.schema.fields if f.name not in types})
    cols = list(target.columns) + [c for c in source.columns if c not in target.columns]
    t = _evolve(target, cols, types).withColumn("__t", F.lit(True)).withColumn("__salt", _salt(keys, cols))
    s = _evolve(source, cols, types)
    s = s.select(*[F.col(c).alias(f"__s_{c}") for c in cols], _salt(keys, cols).alias("__s_salt")) \
        .withColumn("__s", F.lit(True))
    cond = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__s_{k}") for k in keys]) \
        & (F.col("__salt") == F.col("__s_salt"))
    j = t.join(s, cond, "full")
    upd = set(update_cols) if update_cols is not None else set(cols)
    out = []
    for c in cols:
        if c in keys:
            e = F.coalesce(F.col(c), F.col(f"__s_{c}"))
        elif c in upd:
            e = F.when(F.col("__s").isNotNull(), F.col(f"__s_{c}")).otherwise(F.col(c))
        else:
            e = F.when(F.col("__t").isNotNull(), F.col(c)).otherwise(F.col(f"__s_{c}"))
        out.append(e.cast(types[c]).alias(c))
    return j.select(*out)


def merge_metrics(target: DataFrame | None, source: DataFrame, keys) -> DataFrame:
    """Rows the upsert inserts and updates, from one join pass."""
    keys = column_list(keys)
    sk = source.select(*keys).distinct()
    if target is None:
        return sk.agg(F.count(F.lit(1)).alias("inserted")).withColumn("updated", F.lit(0).cast("bigint"))
    tk = target.select(*keys).distinct().withColumn("__t", F.lit(True))
    j = sk.join(tk, keys, "left")
    return j.agg(F.count_if(F.col("__t").isNull()).alias("inserted"),
                 F.count_if(F.col("__t").isNotNull()).alias("updated"))


def change_feed(old: DataFrame | None, new: DataFrame, keys, version: int | None = None) -> DataFrame:
    """Row changes between two versions of a table.

    One full outer join of (keys, image) pairs; unchanged rows (null-safe
    equal images) drop out, the rest emit ``insert`` / ``delete`` or an
    ``update_preimage`` + ``update_postimage`` pair.
    """
    keys = column_list(keys)
    rest = [c for c in new.columns if c not in keys]
    # NULL keys cannot be paired (they become inserts / deletes); their salt
    # spreads them over the join's partitions.
    n = new.select(*keys, F.struct(*rest).alias("__n"), _salt(keys, new.columns).alias("__salt"))
    if old is None:
        j = n.select(*keys, F.lit(None).cast(n.schema["__n"].dataType).alias("__o"), "__n")
    else:
        old = _evolve(old, new.columns, {f.name: f.dataType for f in new.schema.fields})
        o = old.select(*[F.col(k).alias(f"__ok_{k}") for k in keys], F.struct(*rest).alias("__o"),
                       _salt(keys, old.columns).alias("__osalt"))
        cond = reduce(lambda a, b: a & b, [F.col(f"__ok_{k}") == F.col(k) for k in keys]) \
            & (F.col("__osalt") == F.col("__salt"))
        j = o.join(n, cond, "full").select(
            *[F.coalesce(F.col(f"__ok_{k}"), F.col(k)).alias(k) for k in keys], "__o", "__n")
    j = j.where(~F.col("__o").eqNullSafe(F.col("__n")))
    ev = F.when(F.col("__o").isNull(), F.array(F.struct(F.lit("insert").alias("t"), F.col("__n").alias("img"))))
    ev = ev.when(F.col("__n").isNull(), F.array(F.struct(F.lit("delete").alias("t"), F.col("__o").alias("img"))))
    ev = ev.otherwise(F.array(F.struct(F.lit("update_preimage").alias("t"), F.col("__o").alias("img")),
                              F.struct(F.lit("update_postimage").alias("t"), F.col("__n").alias("img"))))
    out = j.select(*keys, F.inline(ev)).select(*keys, "img.*", F.col("t").alias("_change_type"))
    if version is not None:
        out = out.withColumn("_commit_version", F.lit(version).cast("bigint"))
    return out


def read_changes(changes: DataFrame, starting_version: int | None = None, starting_timestamp: str | None = None,
                 version_col: str = "_commit_version", time_col: str = "_commit_timestamp") -> DataFrame:
    """Inserts and post-images only, optionally from a version (or a
    commit time) on."""
    out = changes.where(F.col("_change_type").isin("insert", "update_postimage"))
    if starting_version is not None:
        out = out.where(F.col(version_col) >= starting_version)
    elif starting_timestamp is not None:
        out = out.where(F.col(time_col) >= F.lit(starting_timestamp).cast("timestamp"))
    return out


def union_evolving(a: DataFrame, b: DataFrame) -> DataFrame:
    """Append with schema evolution (columns missing on a side are NULL)."""
    return a.unionByName(b, allowMissingColumns=True)

