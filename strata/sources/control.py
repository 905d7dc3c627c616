"""Control tables: registry, watermark, audit.

They are small DataFrames (one row per table or per run). Reading a
watermark yields one scalar on the driver, on purpose: it becomes a literal
partition filter on the landing scan, which Spark prunes at planning time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.merge import merge_upsert

# The table registry (name, type, business keys, SCD2 flag,
# tracked attributes, load order) and the default low watermark.
REGISTRY = [
    ("dim_banner", "dim", ["banner_id"], False, [], 1),
    ("dim_category", "dim", ["category_id"], False, [], 2),
    ("dim_date", "dim", ["date_id"], False, [], 3),
    ("dim_employee", "dim", ["employee_business_key"], False, [], 4),
    ("dim_promotion", "dim", ["promotion_id"], False, [], 5),
    ("dim_store", "dim", ["store_number"], True,
     ["store_name", "square_footage", "store_type", "manager_employee_id", "district", "region", "close_date"], 6),
    ("dim_product", "dim", ["sku"], True,
     ["product_name", "list_price_cad", "cost_price_cad", "price_tier", "discontinue_date", "applicable_banner_ids"], 7),
    ("dim_customer", "dim", ["customer_business_key"], True,
     ["loyalty_tier", "loyalty_points_balance", "home_postal_code", "home_city", "marketing_consent", "is_active"], 8),
    ("fact_sales_transaction", "fact", ["transaction_business_key"], False, [], 20),
    ("fact_sales_line_item", "fact", ["line_item_id"], False, [], 21),
    ("fact_inventory_snapshot", "fact", ["snapshot_id"], False, [], 22),
    ("fact_loyalty_event", "fact", ["loyalty_event_id"], False, [], 23),
]
LOW_WATERMARK = "1900-01-01"
REGISTRY_SCHEMA = ("table_name string, table_type string, business_keys array<string>, is_scd2 boolean, "
                   "track_attrs array<string>, load_order int")
WATERMARK_SCHEMA = "table_name string, last_processing_date string, last_run_timestamp timestamp, last_rows_affected long"
AUDIT_SCHEMA = ("run_ts timestamp, notebook string, layer string, table_name string, rows_affected long, "
                "status string, message string")


def registry(spark: SparkSession, only_type: str | None = None) -> DataFrame:
    """The registry in load order, optionally one table type."""
    df = spark.createDataFrame(REGISTRY, REGISTRY_SCHEMA)
    if only_type:
        df = df.where(F.col("table_type") == only_type)
    return df.orderBy("load_order")


def read_watermark(wm: DataFrame | None, table: str, default: str = LOW_WATERMARK) -> str:
    """Last processed date of ``table`` (one scalar), default when unknown."""
    if wm is None:
        return default
    row = wm.where(F.col("table_name") == table).agg(
        F.coalesce(F.max("last_processing_date"), F.lit(default)).alias("wm")).head()
    return row["wm"] if row else default


def watermarks(wm: DataFrame, reg: DataFrame, default: str = LOW_WATERMARK) -> DataFrame:
    """B01 for every registered table at once (no driver round trip)."""
    last = wm.groupBy("table_name").agg(F.max("last_processing_date").alias("m"))
    return reg.select("table_name").join(last, "table_name", "left").select(
        "table_name", F.coalesce("m", F.lit(default)).alias("watermark"))


def advance_watermark(wm: DataFrame | None, spark: SparkSession, table: str, batch: DataFrame,
                      rows: Column | None = None, run_ts: Column | None = None) -> DataFrame:
    """Upsert the table's row with the batch high-water mark.

    The new row is an aggregate of the batch (max Processing_Date, row count),
    built without a driver round trip.
    """
    run_ts = run_ts if run_ts is not None else F.current_timestamp()
    new = batch.agg(F.max("Processing_Date").cast("string").alias("last_processing_date"),
                    (rows if rows is not None else F.count(F.lit(1))).cast("long").alias("last_rows_affected"))
    new = new.select(F.lit(table).alias("table_name"), "last_processing_date",
                     run_ts.cast("timestamp").alias("last_run_timestamp"), "last_rows_affected")
    return merge_upsert(wm, new, "table_name")


def seed_watermarks(existing: DataFrame | None, reg: DataFrame, low: str = LOW_WATERMARK) -> DataFrame:
    """A low-watermark row for each registered table not yet present;
    existing rows are never overwritten (anti-join, then append)."""
    seed = reg.select("table_name", F.lit(low).alias("last_processing_date"),
                      F.lit(None).cast("timestamp").alias("last_run_timestamp"),
                      F.lit(0).cast("long").alias("last_rows_affected"))
    if existing is None:
        return seed
    return existing.unionByName(seed.join(existing.select("table_name"), "table_name", "left_anti"))


def audit_rows(batches: DataFrame, notebook: str, layer: str, table: str, status: str = "OK",
               run_ts: Column | None = None) -> DataFrame:
    """One audit row per landed batch (rows per Processing_Date)."""
    ts = run_ts if run_ts is not None else F.current_timestamp()
    per = batches.groupBy("Processing_Date").agg(F.count(F.lit(1)).alias("rows_affected"))
    return per.select(ts.alias("run_ts"), F.lit(notebook).alias("notebook"),
                      F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "rows_affected",
                      F.lit(status).alias("status"),
                      F.concat(F.lit("pd="), F.col("Processing_Date").cast("string")).alias("message"))


def load_summary(audit: DataFrame, n: int = 25) -> DataFrame:
    """The latest ``n`` audit rows (a top-n sort, not a full sort)."""
    return audit.orderBy(F.col("run_ts").desc(), F.col("table_name"), F.col("message")).limit(n)


def next_day(window: DataFrame, watermark: Column) -> DataFrame:
    """Earliest day of [start, end] after the watermark; NULL when done.

    ``window`` has one row with ``start`` and ``end`` DATE columns.
    """
    days = window.select(F.explode(F.sequence("start", "end", F.expr("INTERVAL 1 DAY"))).alias("day"),
                         watermark.alias("__wm"))
    return days.where(F.col("day") > F.col("__wm")).agg(F.min("day").alias("next_day"))


def last_refreshed(audit: DataFrame) -> DataFrame:
    """A14/M55: "Last refreshed: <date time>" from the newest audit row."""
    return audit.agg(F.concat(F.lit("Last refreshed: "),
                              F.date_format(F.max("run_ts"), "MMM d, yyyy h:mm a")).alias("label"))
