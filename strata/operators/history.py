"""Versioned dimensions (SCD2), surrogate keys and the effective-date join
(C07-C17, E01, E06, E07).

A version is a half-open DATE interval ``[effective_from, effective_to)``;
the open end is 9999-12-31.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import column_list

# Hash separator, the stand-in for NULL attributes, and the
# open end of the current version.
HASH_SEP = "||"
NULL_TOKEN = "∅"
OPEN_END = "9999-12-31"


def scd_hash(attrs: list[str]) -> Column:
    """Sha-256 over the tracked attributes, NULL spelled as a token."""
    parts = [F.coalesce(F.col(a).cast("string"), F.lit(NULL_TOKEN)) for a in attrs]
    return F.sha2(F.concat_ws(HASH_SEP, *parts), 256)


def tracked(df: DataFrame, keys, attrs: list[str] | None) -> list[str]:
    """Tracked attributes default to every non-key column."""
    if attrs:
        return list(attrs)
    return df.drop(*column_list(keys)).columns


def surrogate_key(*cols: str) -> Column:
    """Per-version key, xxhash64 of the business key and version start."""
    return F.xxhash64(F.concat_ws(HASH_SEP, *[F.col(c).cast("string") for c in cols]))


def _by_key(df: DataFrame) -> DataFrame:
    """The side of a key-to-key join that grows with the dimension: sort-merged.
    Versions repeat few dates and hashes, so their files are a small part of their
    rows in memory and the planner, which goes by the files, would broadcast them
    through the driver."""
    return df.hint("merge")


def _stamp(src: DataFrame, date: Column) -> DataFrame:
    return (src.withColumn("effective_from", date)
            .withColumn("effective_to", F.lit(OPEN_END).cast("date"))
            .withColumn("is_current", F.lit(True)))


def scd2_initial(image: DataFrame, keys, attrs: list[str] | None, date: str) -> DataFrame:
    """First load, every row a current version from ``date``."""
    attrs = tracked(image, keys, attrs)
    return _stamp(image.withColumn("scd_hash", scd_hash(attrs)), F.lit(date).cast("date"))


def scd2_changed(image: DataFrame, current: DataFrame, keys, attrs: list[str] | None) -> DataFrame:
    """Image rows whose key has a current version with another hash."""
    keys = column_list(keys)
    attrs = tracked(image, keys, attrs)
    src = image.withColumn("scd_hash", scd_hash(attrs))
    cur = current.where("is_current").select(*keys, F.col("scd_hash").alias("__h"))
    return src.join(_by_key(cur), keys, "inner").where(F.col("scd_hash") != F.col("__h")).drop("__h")


def apply_scd2(table: DataFrame | None, image: DataFrame, keys, attrs: list[str] | None, date: str) -> DataFrame:
    """Next full version table after applying one dimension image.

    Current versions whose hash changed are closed at ``date``; new keys and
    new versions are inserted as current from ``date``. A version opened on
    the same date is replaced instead of being closed with zero length. Keys
    absent from the image are left as they are. One plan; the caller
    publishes it as the next table version.
    """
    keys = column_list(keys)
    if table is None:
        return scd2_initial(image, keys, attrs, date)
    attrs = tracked(image, keys, attrs)
    d = F.lit(date).cast("date")
    src = image.withColumn("scd_hash", scd_hash(attrs))
    probe = src.select(*keys, F.col("scd_hash").alias("__nh"))
    t = table.join(_by_key(probe), keys, "left")
    changed = F.col("is_current") & F.col("__nh").isNotNull() & (F.col("__nh") != F.col("scd_hash"))
    # C11: close superseded versions (drop one opened today: it is replaced)
    kept = t.where(~(changed & (F.col("effective_from") == d)))
    closed = (kept.withColumn("effective_to", F.when(changed, d).otherwise(F.col("effective_to")))
              .withColumn("is_current", F.when(changed, F.lit(False)).otherwise(F.col("is_current")))
              .drop("__nh"))
    # Insert image rows without a current version of the same hash
    same = table.where("is_current").select(*keys, "scd_hash")
    new_rows = _stamp(src.join(_by_key(same), keys + ["scd_hash"], "left_anti"), d)
    return closed.unionByName(new_rows.select(*closed.columns))


def scd2_from_history(history: DataFrame, keys, attrs: list[str], date_col: str) -> DataFrame:
    """The version table implied by a series of dimension images.

    Equal to applying ``apply_scd2`` image by image in date order, in one
    pass: a version starts where the hash differs from the key's previous
    image (``lag``) and ends where the next version starts (``lead``). The
    window is per key, and a key holds at most one row per image date.
    """
    keys = column_list(keys)
    h = history.withColumn("scd_hash", scd_hash(attrs))
    w = Window.partitionBy(*keys).orderBy(date_col)
    starts = (h.withColumn("__prev", F.lag("scd_hash").over(w))
              .where(F.col("__prev").isNull() | (F.col("__prev") != F.col("scd_hash"))).drop("__prev"))
    nxt = F.lead(F.col(date_col)).over(w)
    return (starts.withColumn("effective_from", F.col(date_col).cast("date"))
            .withColumn("effective_to", F.coalesce(nxt.cast("date"), F.lit(OPEN_END).cast("date")))
            .withColumn("is_current", F.col("effective_to") == F.lit(OPEN_END).cast("date"))
            .drop(date_col))


def apply_image(table: DataFrame | None, images: DataFrame | None, image: DataFrame, keys, attrs: list[str] | None,
                date: str, date_col: str) -> DataFrame:
    """C11/C12 for images in any order: the next version table after the image of
    ``date``, equal to ``scd2_from_history`` over all images so far.

    ``images`` holds the earlier images with their ``date_col`` (the landed
    dimension, partitioned by it), an image of the same date being replaced. Keys
    whose image says what the version in force on ``date`` says are left alone. Of
    the others, those without a later image take the ordinary step; the rest came
    late, and only their versions are built anew from their own images. The later
    images are found by a partition filter. Columns that are not tracked keep the
    values of the image that opened the version.
    """
    keys = column_list(keys)
    attrs = tracked(image, keys, attrs)
    if table is None or images is None:
        return apply_scd2(table, image, keys, attrs, date)
    d = F.lit(date).cast("date")
    src = image.withColumn("scd_hash", scd_hash(attrs))
    in_force = dim_as_of(table, date).select(*keys, F.col("scd_hash").alias("__in_force"))
    changed = src.join(_by_key(in_force), keys, "left").where(~F.col("scd_hash").eqNullSafe(F.col("__in_force"))).select(*keys)
    at = F.col(date_col).cast("date")
    # An image of this date opened a version that the new one replaces: rebuilt as well.
    opened = table.where(F.col("effective_from") == d).select(*keys)
    since = _by_key(images.where(at > d).select(*keys).unionByName(opened).distinct())
    late = _by_key(changed.join(since, keys, "left_semi"))
    own = images.where(at != d).join(late, keys, "left_semi").unionByName(
        image.join(late, keys, "left_semi").withColumn(date_col, d.cast(images.schema[date_col].dataType)))
    rebuilt = scd2_from_history(own, keys, attrs, date_col)
    on_time = _by_key(changed.join(since, keys, "left_anti"))
    rest = table.join(late, keys, "left_anti")
    step = apply_scd2(rest, image.join(on_time, keys, "left_semi"), keys, attrs, date)
    return step.unionByName(rebuilt.select(*step.columns))


def restate_keys(fact: DataFrame, old: DataFrame, new: DataFrame, fact_key: str, date_col: str, short: str,
                 dim_key: str | None = None) -> DataFrame:
    """E01 after versions changed: the fact rows that lie in a version interval
    that is new or has moved, with the surrogate keys of the new versions; all
    other rows keep theirs and are not read beyond the key and the date.

    An interval is the same when key, start, end and surrogate key agree, so the
    rows of keys with unchanged versions never enter the join.
    """
    dim_key, sk = dim_key or fact_key, f"{short}_sk"
    cols = [dim_key, "effective_from", "effective_to", sk]
    moved = new.select(*cols).exceptAll(old.select(*cols))
    gone = old.select(*cols).exceptAll(new.select(*cols))
    # A row needs a new key when it lies in an interval that is gone or in one that is new.
    spans = (moved.unionByName(gone).groupBy(F.col(dim_key).alias("__id"))
             .agg(F.min("effective_from").alias("__a"), F.max("effective_to").alias("__z")))
    d = F.col(date_col)
    hit = fact.join(_by_key(spans), (F.col(fact_key) == F.col("__id")) & (d >= F.col("__a")) & (d < F.col("__z")), "left_semi")
    now = effective_join(hit.withColumnRenamed(sk, "__old_sk"), _by_key(new), fact_key, date_col, short, dim_key)
    return now.where(~F.col(sk).eqNullSafe(F.col("__old_sk"))).select(*fact.columns)


def dim_as_of(versions: DataFrame, date: str) -> DataFrame:
    """The dimension image in force on ``date``."""
    d = F.lit(date).cast("date")
    return versions.where((F.col("effective_from") <= d) & (d < F.col("effective_to")))


def dim_current(versions: DataFrame) -> DataFrame:
    """C17: the current image."""
    return versions.where(F.col("is_current"))


def gold_dim_scd2(versions: DataFrame, short: str, business_key: str,
                  month_of: str | None = None) -> DataFrame:
    """One row per version with ``<short>_sk``; optional month axis."""
    out = versions.withColumn(f"{short}_sk", surrogate_key(business_key, "effective_from"))
    if month_of is not None:
        out = out.withColumn("enrollment_month", F.trunc(F.col(month_of), "month").cast("date"))
    return out


def gold_dim_simple(dim: DataFrame, short: str, key: str) -> DataFrame:
    """A non-historized dimension, surrogate key = natural key."""
    return dim.withColumn(f"{short}_sk", F.col(key))


def effective_join(fact: DataFrame, versions: DataFrame, fact_key: str, date_col: str,
                   short: str, dim_key: str | None = None, carry: list[str] | None = None) -> DataFrame:
    """Attach the version of a dimension in force on the fact date.

    Left equi-join on the natural id with the interval as a residual
    condition: the id makes it a hash/sort-merge join (never a nested loop),
    the half-open interval matches at most one version, so fact rows are
    neither lost nor repeated. Only the id, interval and carried columns of
    the dimension enter the join.
    """
    dim_key = dim_key or fact_key
    carry = carry if carry is not None else [f"{short}_sk"]
    v = versions.select(F.col(dim_key).alias("__id"), F.col("effective_from").alias("__ef"),
                        F.col("effective_to").alias("__et"), *carry)
    d = F.col(date_col)
    cond = (F.col(fact_key) == F.col("__id")) & (d >= F.col("__ef")) & (d < F.col("__et"))
    return fact.join(v, cond, "left").drop("__id", "__ef", "__et")


def one_at_a_time(versions: DataFrame, key: str) -> bool:
    """True when no two versions of a ``key`` are in force on one day, so that
    ``effective_join`` repeats no fact row."""
    after = F.lead("effective_from").over(Window.partitionBy(key).orderBy("effective_from", "effective_to"))
    spans = versions.where(F.col(key).isNotNull()).select("effective_to", after.alias("__next"))
    return spans.where(F.col("__next") < F.col("effective_to")).isEmpty()


def intervals_ok(versions: DataFrame, keys) -> DataFrame:
    """Property check: per key, versions neither overlap nor leave gaps, and
    exactly one is current. Returns offending keys (empty when sound)."""
    keys = column_list(keys)
    w = Window.partitionBy(*keys).orderBy("effective_from")
    chk = versions.withColumn("__next", F.lead("effective_from").over(w))
    bad_link = chk.where(F.col("__next").isNotNull() & (F.col("__next") != F.col("effective_to")))
    cur = versions.groupBy(*keys).agg(F.count_if(F.col("is_current")).alias("__n")).where("__n <> 1")
    return bad_link.select(*keys).unionByName(cur.select(*keys)).distinct()

