"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import checkpoint_dir

# Fixed values of the operator contracts: the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def work_path(spark: SparkSession, name: str) -> str:
    """A new folder on the cluster's shared storage (``spark.checkpoint.dir``)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, so
    that a lost executor costs the unfinished step only, and gives later joins
    their true input sizes."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str | Column = "text") -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def n_words(column: str | Column = "text") -> Column:
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("long")


def read_documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    return df.select(*columns) if columns else df
