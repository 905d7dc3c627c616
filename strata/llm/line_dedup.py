"""Operator 1: reversible line dedup. Sharded cuckoo filters in front of exact
reference-count tables.

State (all on shared storage, see ``LineIndex``):

* references: an append-only table of signed references (shard, line digest,
  doc_id, +1 or -1). Inserting documents appends +1 rows, deleting them -1 rows;
* counts: for every line its number of documents and its largest doc_id, exact,
  derived from the references still in force;
* filters: one cuckoo filter per shard of the digest space over the lines in
  ``min_docs`` documents or more. An insertion or deletion of documents adds and
  removes only the lines that cross that limit; a filter that overflows is built
  anew from the exact table of its shard.

``apply`` sends the line references of the documents past the filters (a shard's
references are salted, so a line in a third of all documents is spread), joins
the few survivors with the exact counts, which drops the filters' false
positives, and rewrites the texts. Deleting what was inserted gives back the
earlier state exactly.

Defined results: a null or empty text is one empty line; a line's key is the
line without ASCII white space at its ends, A-Z lower-cased, compared by a
128-bit digest; keys under ``min_chars`` code points always stay. Rows with the
same doc_id count as one document. Rows with a null doc_id are not counted and
keep all lines. Further columns are passed through; an input column with the
name of an output column is replaced.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from strata.llm.common import materialise, text_of, work_path
from strata.llm.cuckoo import CuckooFilter, built

MIN_CHARS, MIN_DOCS = 40, 5
KEYS_PER_SHARD = 100_000
SALTS = 16
# Fixed value: the white space that a line's key loses at both ends.
WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"


def _digest(line: bytes, min_chars: int) -> bytes | None:
    key = line.strip(WHITE).lower()  # bytes.lower() touches A-Z only
    if len(key) < min_chars or (not key.isascii() and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return xxh3_128_digest(key)


def _line_digests(min_chars: int):
    @F.pandas_udf("array<binary>")
    def digests(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            seen = {_digest(line, min_chars) for line in text.encode("utf-8", "surrogatepass").split(b"\n")}
            seen.discard(None)
            out.append(sorted(seen))
        return pd.Series(out, dtype=object)

    return digests


def _rewrite(min_chars: int):
    @F.pandas_udf("text string, n_lines long, n_dropped long, kept_sha256 string")
    def rewrite(texts: pd.Series, drops: pd.Series) -> pd.DataFrame:
        out = []
        for text, drop in zip(texts, drops, strict=True):
            if drop is None or not len(drop):
                raw = text.encode("utf-8", "surrogatepass")
                out.append((text, text.count("\n") + 1, 0, hashlib.sha256(raw).hexdigest()))
                continue
            gone = set(drop)
            lines = text.encode("utf-8", "surrogatepass").split(b"\n")
            stay = [x for x in lines if _digest(x, min_chars) not in gone]
            raw = b"\n".join(stay)
            out.append((raw.decode("utf-8", "surrogatepass"), len(lines), len(lines) - len(stay),
                        hashlib.sha256(raw).hexdigest()))
        return pd.DataFrame(out, columns=["text", "n_lines", "n_dropped", "kept_sha256"])

    return rewrite


def _build_filters(pdf: pd.DataFrame) -> pd.DataFrame:
    """One shard: bring the stored filter up to date, or build it anew."""
    shard = int(pdf["shard"].iloc[0])
    blobs = pdf["blob"].dropna()
    keys = pdf[pdf["digest"].notna()]
    added, removed = keys.loc[keys["change"] > 0, "digest"], keys.loc[keys["change"] < 0, "digest"]
    done = False
    if len(blobs):
        now = CuckooFilter.from_bytes(blobs.iloc[0])
        now.delete(sorted(removed))
        done = now.insert(sorted(added))
    if not done:
        now = built(sorted(keys.loc[keys["change"] >= 0, "digest"]))
    return pd.DataFrame({"shard": [shard], "blob": [now.to_bytes()]})


def _pass_filters(batches):
    """Rows of a partition come sorted by shard and salt, the filter first; the
    references that its filter may hold go on. One filter is held at a time."""
    at, held = None, None
    for pdf in batches:
        out = []
        for (shard, salt), part in pdf.groupby(["shard", "salt"], sort=False):
            if (shard, salt) != at:
                at, held = (shard, salt), None
            blob = part["blob"].dropna()
            if len(blob):
                held = CuckooFilter.from_bytes(blob.iloc[0])
            refs = part[part["kind"] == 1]
            if held is not None and len(refs):
                out.append(refs.loc[held.may_hold(refs["digest"].tolist()), ["digest", "doc_id"]])
        if out:
            yield pd.concat(out)


class LineIndex:
    """Reference counts and filters of the lines of a corpus."""

    def __init__(self, spark: SparkSession, n_shards: int, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
                 path: str | None = None):
        self.spark, self.n_shards, self.min_docs, self.min_chars = spark, n_shards, min_docs, min_chars
        self.refs_path = f"{path or work_path(spark, 'lines')}/references"
        self.counts: DataFrame | None = None
        self.filters: DataFrame | None = None

    def references(self, docs: DataFrame) -> DataFrame:
        """(shard, digest, doc_id), a row for each distinct long line of a row."""
        d = docs.filter("doc_id is not null").select(
            F.col("doc_id").cast("long").alias("doc_id"), F.explode(_line_digests(self.min_chars)(text_of())).alias("digest"))
        return d.select(F.expr(f"cast(pmod(xxhash64(digest), {self.n_shards}) as int)").alias("shard"), "digest", "doc_id")

    def insert(self, docs: DataFrame) -> LineIndex:
        return self._change(docs, 1)

    def delete(self, docs: DataFrame) -> LineIndex:
        """Undo ``insert`` of these documents (the rows as they were inserted)."""
        return self._change(docs, -1)

    def _change(self, docs: DataFrame, sign: int) -> LineIndex:
        (self.references(docs).withColumn("delta", F.lit(sign))
         .write.mode("append").parquet(self.refs_path))
        refs = self.spark.read.schema("shard int, digest binary, doc_id long, delta int").parquet(self.refs_path)
        before = self.frequent() if self.counts is not None else None
        # Both sums combine map-side: a line of a third of all documents is no hot task.
        self.counts = materialise(
            refs.groupBy("shard", "digest", "doc_id").agg(F.sum("delta").alias("n")).filter("n > 0")
            .groupBy("shard", "digest").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keep_doc"))
            .filter(f"n_docs >= {self.min_docs}"), "line-counts")
        after = self.frequent()
        if before is None:
            keys = after.select("shard", "digest", F.lit(1).alias("change"))
        else:
            a, b = after.withColumn("a", F.lit(1)), before.withColumn("b", F.lit(1))
            keys = a.join(b, ["shard", "digest"], "full").select(
                "shard", "digest", (F.coalesce("a", F.lit(0)) - F.coalesce("b", F.lit(0))).alias("change"))
        rows = keys.withColumn("blob", F.lit(None).cast("binary"))
        if self.filters is not None:
            rows = rows.unionByName(self.filters.select(
                "shard", F.lit(None).cast("binary").alias("digest"), F.lit(0).alias("change"), "blob"))
        # A group is a shard of the frequent lines: about KEYS_PER_SHARD digests.
        self.filters = materialise(rows.groupBy("shard").applyInPandas(_build_filters, "shard int, blob binary"),
                                   "line-filters")
        return self

    def frequent(self) -> DataFrame:
        return self.counts.select("shard", "digest")

    def may_drop(self, docs: DataFrame) -> DataFrame:
        """(digest, doc_id) of the references that the filters let through."""
        refs = self.references(docs).select(
            "shard", F.expr(f"cast(pmod(doc_id, {SALTS}) as int)").alias("salt"), F.lit(1).alias("kind"), "digest",
            "doc_id", F.lit(None).cast("binary").alias("blob"))
        # doc_id is never null here: pandas would turn a batch's ids into doubles.
        filters = self.filters.select(
            "shard", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.lit(0).alias("kind"),
            F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("doc_id"), "blob")
        return (refs.unionByName(filters).repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind")
                .mapInPandas(_pass_filters, "digest binary, doc_id long"))

    def apply(self, docs: DataFrame) -> DataFrame:
        """``docs`` with the new ``text``, ``n_lines``, ``n_dropped`` and
        ``kept_sha256``."""
        drops = (self.may_drop(docs).join(self.counts.select("digest", "keep_doc"), "digest")
                 .filter("doc_id <> keep_doc").groupBy(F.col("doc_id").alias("doc"))
                 .agg(F.collect_set("digest").alias("drops")))
        # The row is packed, so that no column of the input can clash with those here.
        row = F.col("row")
        both = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc")).join(
            drops.hint("merge"), "doc", "left")
        made = both.select("row", _rewrite(self.min_chars)(text_of(row["text"]), F.col("drops")).alias("made"))
        names = ("text", "n_lines", "n_dropped", "kept_sha256")
        kept = [(F.col("made")[c] if c in names else row[c]).alias(c) for c in docs.columns]
        return made.select(*kept, *[F.col("made")[c].alias(c) for c in names if c not in docs.columns])


def shards_for(docs: DataFrame) -> int:
    """Shards so that the frequent lines of one fit a task: a document row
    brings a few dozen long lines, of which one in ``MIN_DOCS`` at most can be
    a frequent one."""
    return max(8, -(-docs.count() * 10 // KEYS_PER_SHARD))


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """Insert all of ``docs`` into a new index and apply it to them."""
    index = LineIndex(docs.sparkSession, shards_for(docs), min_docs, min_chars)
    return index.insert(docs).apply(docs)
