"""Corpus pipeline: documents to packed training sequences in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it
as Parquet on the shared folder and reads it again as the next stage's input, so
a lost executor costs one stage at most. All stages but the last return the
columns of ``documents`` (a document that the mix takes twice stands there
twice); the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import line_dedup, minhash_dedup, mixing, packing, quality_classifier
from strata.llm.common import materialise, read_documents


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that the classifier rejects go."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return quality_classifier.keep_good(docs, labels)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: lines that stand in many documents stay in one."""
    out = line_dedup.dedup_lines(docs.select(F.struct("*").alias("_row"), "doc_id", "text"))
    put = {"text": F.col("text"), "n_chars": F.char_length("text").cast("long")}
    return out.select(*[put.get(c, F.col("_row")[c]).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: one document of each group of near duplicates stays."""
    return minhash_dedup.keep_one_of_each(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: pieces of documents in sequences of the permitted lengths."""
    return packing.pack_documents(docs)


STAGES = [("quality classifier", quality), ("line dedup", lines), ("near duplicates", near_duplicates),
          ("mixing", mixture), ("best-fit packing", packed)]

# No stage but the line dedup can be written in SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
