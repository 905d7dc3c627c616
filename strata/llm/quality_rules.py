"""Operator 6: quality rules with host-level verdicts, DataFrame functions only.

Statistics of a text are array expressions over its own words and lines, so no
text and no word is shuffled: word hashes, hashes of five-word windows, and a
sort of (window, position) only for texts in which a window is repeated. Rule
failures are summed by host (combined before the shuffle), a host's failure rate
is shrunk towards the corpus by a beta prior fitted to all hosts (method of
moments), and the verdict on the host is joined back to its documents over
salted keys, so a host with a third of all rows is spread.

Defined results: null texts have no words (base_failed, not kept). A null host
is one host. Rows with a repeated or null doc_id each get their own result. With
one host, or hosts that do not differ, the prior is worth ``PRIOR`` documents at
the corpus's rate. Further columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import WORD, materialise, text_of

MIN_WORDS, REPEAT_PERCENT, WINDOW_WORDS = 10, 20, 5
HOST_LIMIT, PRIOR, SALTS = 0.5, 100.0, 16
SYMBOLS = r"[#*$%&|<>]"


def _let(value: Column, body) -> Column:
    """``body`` over ``value``, which is computed once per row."""
    return F.transform(F.array(value), body)[0]


def _covered(ends: Column) -> Column:
    """Words in the windows that start at the ascending positions ``ends``."""
    nxt = F.slice(ends, F.lit(2), F.size(ends))
    gaps = F.zip_with(ends, nxt, lambda a, b: F.coalesce(F.least(b - a, F.lit(WINDOW_WORDS)), F.lit(WINDOW_WORDS)))
    return F.aggregate(gaps, F.lit(0), lambda s, x: s + x)


def _repeated_positions(windows: Column) -> Column:
    """Ascending positions of the windows that occur twice or more."""
    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def marked(s: Column) -> Column:
        hit = F.filter(s, lambda x, i: ((i > 0) & (F.get(s, i - 1)["h"] == x["h"]))
                       | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)))
        return F.sort_array(F.transform(hit, lambda x: x["i"]))

    return _let(pairs, marked)


def repeat_words(words: Column) -> Column:
    """Words in five-word windows found twice or more (the first included)."""
    def of_hashes(h: Column) -> Column:
        n = F.size(h) - WINDOW_WORDS + 1
        starts = F.sequence(F.lit(0), n - 1)
        windows = F.transform(starts, lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(WINDOW_WORDS)]))
        return F.when(n < 2, F.lit(0)).otherwise(_let(windows, lambda w: F.when(
            F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(_let(_repeated_positions(w), _covered))))

    return _let(F.transform(words, lambda w: F.xxhash64(w)), of_hashes)


def statistics(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host and the base statistics and rules of every row."""
    text = text_of()
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.regexp_like(x, F.lit(WORD)))
    base = docs.select(
        "doc_id", F.col(host).alias("host"), F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))
    out = base.select(
        "doc_id", "host", F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"), "n_symbols", "n_dup_lines",
        repeat_words(F.col("words")).cast("long").alias("n_repeat_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def host_verdicts(rows: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """host, documents, failures, shrunk rate and whether the host is accepted."""
    hosts = rows.groupBy("host").agg(F.count(F.lit(1)).alias("docs"), F.sum(F.col("base_failed").cast("long")).alias("failed"))
    rate = F.col("failed") / F.col("docs")
    # One row: the size of the broadcast side is fixed.
    prior = hosts.agg((F.sum("failed") / F.sum("docs")).alias("mean"), F.var_pop(rate).alias("spread")).select(
        F.lit(0).alias("one"), "mean", F.when(
            (F.col("spread") > 0) & (F.col("spread") < F.col("mean") * (1 - F.col("mean"))),
            F.col("mean") * (1 - F.col("mean")) / F.col("spread") - 1).otherwise(PRIOR).alias("worth"))
    both = hosts.withColumn("one", F.lit(0)).join(F.broadcast(prior), "one")
    shrunk = (F.col("failed") + F.col("mean") * F.col("worth")) / (F.col("docs") + F.col("worth"))
    return both.select("host", "docs", "failed", shrunk.alias("host_rate"), (shrunk <= limit).alias("host_kept"))


def apply_rules(docs: DataFrame, host: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """doc_id, the statistics, base_failed, host_rate and kept of every row."""
    rows = materialise(statistics(docs, host), "rules")
    verdicts = (host_verdicts(rows, limit).select(F.col("host").alias("_host"), "host_rate", "host_kept")
                .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    salted = rows.withColumn("_salt", F.expr(f"cast(pmod(xxhash64(doc_id, n_words, word_chars), {SALTS}) as int)"))
    both = salted.join(verdicts, (F.col("host").eqNullSafe(F.col("_host"))) & (salted["_salt"] == verdicts["_salt"]))
    return both.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                       (~F.col("base_failed") & F.col("host_kept")).alias("kept"), "host_rate")
