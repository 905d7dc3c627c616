"""Operator 9: quality classifier, histogram gradient-boosted trees over
document statistics.

The fit takes a bounded sample of labelled rows (``max_train_rows``, chosen by
a hash of doc_id, so reruns agree); statistics and scores cover every document
and its whole text. Each tree is a complete binary tree kept in flat arrays
(feature, threshold, leaf), and a batch of documents walks all trees at once by
numpy indexing.

Defined results: a null text is an empty text; every row gets a score, rows with
a repeated or null doc_id each by their own text; several labels of one doc_id
count by their mean (0.5 and more is 1), null labels not at all; without labels,
or with one class only, every score is (positives + 1) / (labels + 1). Columns of
the input other than doc_id and text are passed through untouched; an input
column with the name of an output column is replaced.
"""

from __future__ import annotations

from collections import Counter
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from strata.llm.common import text_of

MAX_TRAIN_ROWS = 20_000
THRESHOLD = 0.7
# Fixed groups of ASCII characters whose shares are statistics.
GROUPS = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" ", b"\n", b"\t", b".", b",",
          b"!", b"?", b"|", b"#*$%&", b"<>", b"{}[]()=;/\\", b"-_~^+", b"@:", b"'\""]
_CLASS = np.full(256, len(GROUPS))
for _i, _g in enumerate(GROUPS):
    _CLASS[list(_g)] = _i
_CLASS[128:] = len(GROUPS) + 1


def statistics(text: str | None) -> np.ndarray:
    """The feature vector of one whole text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    size = max(len(raw), 1)
    by_byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    shares = np.bincount(_CLASS, weights=by_byte, minlength=len(GROUPS) + 2) / size
    words = raw.split()
    n = max(len(words), 1)
    lens = np.fromiter(map(len, words), np.int32, len(words)) if words else np.zeros(1, np.int32)
    seen = Counter(words)
    top = max(seen.values(), default=0)
    pairs = len(set(zip(words, words[1:], strict=False)))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    n_lines = max(len(lines), 1)
    alphabetic = sum(1 for w in words if w.isalpha())
    caps = sum(1 for w in words if w.isupper() and len(w) > 1)
    rest = [
        np.log1p(len(raw)), np.log1p(len(words)), lens.mean(), lens.std(), float(lens.max()),
        len(seen) / n, len(seen) / np.sqrt(n), top / n, pairs / n,
        sum(map(eq, words, words[1:])) / n, alphabetic / n, caps / n,
        sum(1 for w in words if len(w) == 1) / n,
        np.log1p(len(raw) / n_lines), 1 - len(set(lines)) / n_lines,
        sum(1 for x in lines if x.rstrip()[-1:] in (b".", b"!", b"?", b'"')) / n_lines,
    ]
    return np.concatenate([shares, np.array(rest, float)])


N_FEATURES = len(statistics("a"))


def _column_of_statistics(texts: pd.Series) -> np.ndarray:
    return np.vstack([statistics(t) for t in texts]) if len(texts) else np.zeros((0, N_FEATURES))


@F.pandas_udf(ArrayType(DoubleType()))
def statistics_of(texts: pd.Series) -> pd.Series:
    return pd.Series(list(_column_of_statistics(texts)))


def fit(x: np.ndarray, y: np.ndarray, n_trees: int = 80, depth: int = 4, rate: float = 0.2, n_bins: int = 64,
        l2: float = 1.0, least: float = 5.0) -> dict:
    """Boost ``n_trees`` trees of ``depth`` levels on the logistic loss; splits
    come from histograms of gradient and curvature over quantile bins."""
    n, positives = len(y), float(np.sum(y))
    if n == 0 or positives in (0.0, float(n)):
        p = (positives + 1) / (n + 1)
        return {"constant": p}
    n_f, nodes, leaves = x.shape[1], 2 ** depth - 1, 2 ** depth
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, n_bins + 1)[1:-1])) for j in range(n_f)]
    binned = np.stack([np.searchsorted(e, x[:, j]) for j, e in enumerate(edges)], 1)
    offsets = np.arange(n_f) * n_bins
    base = np.log(positives / (n - positives))
    margin = np.full(n, base)
    feature = np.zeros((n_trees, nodes), np.int32)
    threshold = np.full((n_trees, nodes), np.inf)
    leaf = np.zeros((n_trees, leaves))
    usable = np.zeros((n_f, n_bins), bool)
    for j, e in enumerate(edges):
        usable[j, :len(e)] = True
    for t in range(n_trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            at = (node - first)[:, None] * (n_f * n_bins) + offsets + binned
            cells = width * n_f * n_bins
            sum_g = np.bincount(at.ravel(), np.repeat(g, n_f), cells).reshape(width, n_f, n_bins)
            sum_h = np.bincount(at.ravel(), np.repeat(h, n_f), cells).reshape(width, n_f, n_bins)
            gl, hl = sum_g.cumsum(2), sum_h.cumsum(2)
            ga, ha = gl[:, :, -1:], hl[:, :, -1:]
            gain = gl ** 2 / (hl + l2) + (ga - gl) ** 2 / (ha - hl + l2) - ga ** 2 / (ha + l2)
            gain = np.where(usable & (hl >= least / 4) & (ha - hl >= least / 4), gain, 0)
            best = gain.reshape(width, -1).argmax(1)
            won = gain.reshape(width, -1)[np.arange(width), best] > 1e-6
            f_of, cut = best // n_bins, best % n_bins
            for k in np.flatnonzero(won):
                feature[t, first + k] = f_of[k]
                threshold[t, first + k] = edges[f_of[k]][cut[k]]
            local = node - first
            right = won[local] & (binned[np.arange(n), f_of[local]] > cut[local])
            node = 2 * node + 1 + right
        local = node - nodes
        value = rate * np.bincount(local, g, leaves) / (np.bincount(local, h, leaves) + l2)
        leaf[t] = value
        margin += value[local]
    return {"base": base, "depth": depth, "feature": feature, "threshold": threshold, "leaf": leaf}


def score(model: dict, x: np.ndarray) -> np.ndarray:
    """Probability of label 1 for every row of ``x``: all trees at once."""
    if "constant" in model:
        return np.full(len(x), model["constant"])
    trees = np.arange(model["feature"].shape[0])
    node = np.zeros((len(x), len(trees)), np.int64)
    rows = np.arange(len(x))[:, None]
    for _ in range(model["depth"]):
        node = 2 * node + 1 + (x[rows, model["feature"][trees, node]] > model["threshold"][trees, node])
    margin = model["base"] + model["leaf"][trees, node - model["feature"].shape[1]].sum(1)
    return 1 / (1 + np.exp(-margin))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_train_rows: int = MAX_TRAIN_ROWS) -> dict:
    """Fit on at most ``max_train_rows`` labelled documents outside the held-out
    part. The sample's ids are bounded by that parameter, which is the proven
    size behind the broadcast; only its statistics reach the driver."""
    known = (labels.filter("quality is not null and doc_id is not null").groupBy("doc_id")
             .agg((F.avg("quality") >= 0.5).cast("double").alias("y")).filter(~held_out()))
    chosen = (known.join(docs.select("doc_id"), "doc_id", "left_semi")
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train_rows))
    rows = (docs.select("doc_id", text_of().alias("text")).join(F.broadcast(chosen), "doc_id")
            .select("doc_id", "y", statistics_of("text").alias("x"))
            .groupBy("doc_id").agg(F.min("x").alias("x"), F.min("y").alias("y")).orderBy("doc_id").toPandas())
    x = np.vstack(rows["x"].to_list()) if len(rows) else np.zeros((0, N_FEATURES))
    return fit(x, rows["y"].to_numpy(float))


def with_scores(docs: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with columns ``score`` and ``predicted``; one pass over the texts."""

    @F.pandas_udf("double")
    def score_of(texts: pd.Series) -> pd.Series:
        return pd.Series(score(model, _column_of_statistics(texts)))

    return (docs.withColumn("score", score_of(text_of()))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def classify(docs: DataFrame, labels: DataFrame, max_train_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    return with_scores(docs, train(docs, labels, max_train_rows))


def keep_good(docs: DataFrame, labels: DataFrame, max_train_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """The documents that the classifier accepts, with the input's columns."""
    marked = with_scores(docs.select(F.struct("*").alias("_row"), "text"), train(docs, labels, max_train_rows))
    return marked.filter("predicted = 1").select("_row.*")
