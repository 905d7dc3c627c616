"""Table scans over a directory of Parquet files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def table_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(base, name))


def read_source(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Read a source data set, Parquet first, else CSV with a header row.

    A schema should be given for CSV at scale; inference costs a full extra
    pass over the files.
    """
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:  # only a missing path has a CSV twin; other failures are told
        if (exc.getCondition() or "") != "PATH_NOT_FOUND":
            raise
        csv_path = path if path.endswith(".csv") else path + ".csv"
        reader = spark.read.option("header", True)
        reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
        try:
            return reader.csv(csv_path)
        except AnalysisException:
            raise exc from None


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None when it does not exist yet (works
    on any file system Spark reads, not only local paths)."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if (exc.getCondition() or "") != "PATH_NOT_FOUND":
            raise
        return None
