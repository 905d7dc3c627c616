"""Operator 2: token counts through a digest cache.

The cache is a Parquet table (tokenizer, content, n_tokens): digest of the
tokenizer file and library version, digest of the normalised content (null read
as empty; any further change of the text could change its count), and the count.
A run digests all texts, finds the distinct digests that the cache lacks, encodes
one text for each and appends the counts, then joins all documents with the
cache. Equal texts are told by their digests before any text is shuffled: the
text that stands for a digest is that of its smallest doc_id, so a text in a
third of all rows is encoded once and meets in no single task.

Defined results: null texts count as empty, with 0 tokens; every row gets its
result, with repeated or null doc_ids too. Further columns do not matter.
"""

from __future__ import annotations

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import materialise, text_of, work_path
from strata.llm.tokenizers_ import in_slices, load, version_digest

LIMIT = 4096
CACHE = "tokenizer string, content binary, n_tokens long"


def content_digest():
    return F.unhex(F.sha2(text_of(), 256))


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The cache so far; a folder that does not exist yet is an empty cache."""
    try:
        return spark.read.schema(CACHE).parquet(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in (exc.getCondition() or ""):
            raise
        return spark.createDataFrame([], CACHE)


def _counter(tokenizer: str):
    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        t = load(tokenizer)
        return pd.Series([n for part in in_slices(texts) for n in t.count(part)], dtype="int64")

    return count


def encode_misses(docs: DataFrame, tokenizer: str, cache_path: str) -> None:
    """Append the counts of all contents of ``docs`` that the cache lacks."""
    version = version_digest(tokenizer)
    cached = read_cache(docs.sparkSession, cache_path).filter(F.col("tokenizer") == version).select("content")
    key = F.col("doc_id").cast("long")
    stand_in = materialise(
        docs.select(key.alias("doc_id"), content_digest().alias("content")).groupBy("content")
        .agg(F.min("doc_id").alias("doc_id")).join(cached, "content", "left_anti"), "misses")
    texts = docs.select(key.alias("doc_id"), text_of().alias("text"))
    # One plan at every size: the texts are the large side, the misses grow with them.
    counted = (texts.filter("doc_id is not null").join(stand_in.select("doc_id").hint("merge"), "doc_id", "left_semi")
               .select(F.unhex(F.sha2("text", 256)).alias("content"), _counter(tokenizer)("text").alias("n_tokens")))
    # Contents found only in rows without a doc_id.
    bare = (texts.filter("doc_id is null").select("text", F.unhex(F.sha2("text", 256)).alias("content"))
            .join(stand_in.filter("doc_id is null").select("content"), "content", "left_semi")
            .select("content", _counter(tokenizer)("text").alias("n_tokens")))
    rows = counted.unionByName(bare) if not stand_in.filter("doc_id is null").isEmpty() else counted
    (rows.groupBy("content").agg(F.max("n_tokens").alias("n_tokens")).join(cached, "content", "left_anti")
     .select(F.lit(version).alias("tokenizer"), "content", "n_tokens").write.mode("append").parquet(cache_path))


def token_counts(docs: DataFrame, tokenizer: str = "piece_bpe_32k.model", cache_path: str | None = None,
                 limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs``. Without
    ``cache_path`` the cache is new and used for this call only."""
    spark = docs.sparkSession
    path = cache_path or work_path(spark, "token-cache")
    encode_misses(docs, tokenizer, path)
    cache = read_cache(spark, path).filter(F.col("tokenizer") == version_digest(tokenizer)).select("content", "n_tokens")
    rows = docs.select("doc_id", F.octet_length(text_of()).cast("long").alias("n_bytes"),
                       content_digest().alias("content"))
    return (rows.join(cache, "content")
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
