"""Operator 7: token ids as Simple-8b files.

Documents are dealt out by ranges of doc_id and sorted within, so file f holds
the documents before those of file f + 1; each task encodes whole texts, appends
the end id, and writes blocks of whole documents (format: ``simple8b``). Blocks
are the rows of Parquet files on shared storage, written by Spark's committer, so
a lost executor leaves no half file. Reading decodes block by block; where a
document starts among all ids follows from the blocks' id counts by prefix sums
over files (as many as tasks), blocks of a file and documents of a block.

Defined results: null texts are empty (the end id alone); rows with a repeated
doc_id follow each other, in the order of a hash of the text; null doc_ids come
last. Further columns do not matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import text_of
from strata.llm.simple8b import Block, encode_block
from strata.llm.tokenizers_ import in_slices, load

END_ID, BLOCK_IDS = 1, 1 << 16
SCHEMA = "file_no int, block_no int, n_docs long, n_ids long, payload binary"


def _encoder(tokenizer: str, end_id: int, block_ids: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t, file_no, block_no = load(tokenizer), TaskContext.get().partitionId(), 0
        end = np.array([end_id], np.uint32)
        docs: list[int | None] = []
        ids: list[np.ndarray] = []
        n = 0

        def block() -> pd.DataFrame:
            return pd.DataFrame({"file_no": [file_no], "block_no": [block_no], "n_docs": [len(docs)], "n_ids": [n],
                                 "payload": [encode_block(docs, ids)]})

        for pdf in batches:
            keys = iter(pdf["doc_id"].tolist())
            for part in in_slices(pdf["text"]):
                for made in t.encode(part):
                    key = next(keys)
                    docs.append(None if pd.isna(key) else int(key))
                    ids.append(np.concatenate([made, end]))
                    n += len(made) + 1
                    if n >= block_ids:
                        yield block()
                        docs, ids, n, block_no = [], [], 0, block_no + 1
        if docs:
            yield block()

    return run


def write_token_files(docs: DataFrame, path: str, tokenizer: str = "word_bpe_49k.json", end_id: int = END_ID,
                      block_ids: int = BLOCK_IDS) -> None:
    """Write the ids of all ``docs`` in ascending doc_id."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    tie = F.xxhash64("text")
    # doc_id travels as a string: pandas has no nullable integers in a plain batch.
    (rows.repartitionByRange(F.col("doc_id").asc_nulls_last(), tie)
     .sortWithinPartitions(F.col("doc_id").asc_nulls_last(), tie)
     .select(F.col("doc_id").cast("string").alias("doc_id"), "text")
     .mapInPandas(_encoder(tokenizer, end_id, block_ids), SCHEMA).write.parquet(path))


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def _decode(batches):
    for pdf in batches:
        for f, b, payload in zip(pdf["file_no"], pdf["block_no"], pdf["payload"], strict=True):
            block = Block(payload)
            ids = block.read().astype("<u4")
            ends = np.cumsum(block.counts.astype(np.int64))
            starts = ends - block.counts
            crc = [zlib.crc32(ids[a:z].tobytes()) for a, z in zip(starts.tolist(), ends.tolist(), strict=True)]
            yield pd.DataFrame({"file_no": f, "block_no": b, "doc_id": pd.array(block.doc_ids, dtype="Int64"),
                                "at": starts, "n_tokens": block.counts.astype(np.int64), "ids_crc32": crc})


def _decode_ids(batches):
    for pdf in batches:
        for f, b, payload in zip(pdf["file_no"], pdf["block_no"], pdf["payload"], strict=True):
            block = Block(payload)
            ids = block.read().astype(np.int64)
            ends = np.cumsum(block.counts.astype(np.int64))
            yield pd.DataFrame({"file_no": f, "block_no": b, "doc_id": pd.array(block.doc_ids, dtype="Int64"),
                                "at": ends - block.counts, "ids": np.split(ids, ends[:-1])})


def _starts(blocks: DataFrame) -> DataFrame:
    """(file_no, block_no, first): ids before each block. The order over files
    has a row per file, that within a file a row per block of one task."""
    sizes = blocks.select("file_no", "block_no", "n_ids")
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    files = sizes.groupBy("file_no").agg(F.sum("n_ids").alias("n")).select(
        "file_no", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("file_first"))
    within = Window.partitionBy("file_no").orderBy("block_no").rowsBetween(Window.unboundedPreceding, -1)
    return (sizes.withColumn("ahead", F.coalesce(F.sum("n_ids").over(within), F.lit(0))).join(files, "file_no")
            .select("file_no", "block_no", (F.col("file_first") + F.col("ahead")).alias("first")))


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    blocks = read_blocks(spark, path)
    rows = blocks.select("file_no", "block_no", "payload").mapInPandas(
        _decode, "file_no int, block_no int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return rows.join(_starts(blocks), ["file_no", "block_no"]).select(
        "doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, ids of every document, from the files."""
    blocks = read_blocks(spark, path)
    rows = blocks.select("file_no", "block_no", "payload").mapInPandas(
        _decode_ids, "file_no int, block_no int, doc_id long, at long, ids array<long>")
    return rows.join(_starts(blocks), ["file_no", "block_no"]).select(
        "doc_id", (F.col("first") + F.col("at")).alias("start"), "ids")
