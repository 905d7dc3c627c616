"""Operator 12: toxicity by FTRL-proximal logistic regression over hashed word
n-grams and skip-grams.

A text's features are its distinct words, word stems (the first ``STEM`` letters
of longer words, for inflected languages), pairs of neighbours and pairs with a
word between them, hashed to ``DIMS`` coordinates; a feature is there or not, so
long texts weigh no more than short ones. Each coordinate has its own
learning rate, and L1 keeps most weights at zero: the fitted weights are the few
(coordinate, value) pairs that remain, kilobytes in all.

The fit takes a bounded sample of labelled rows (``max_train_rows``, chosen by a
hash of doc_id, so reruns agree), in shards of ``SHARD_ROWS``: in each epoch every
shard goes on from the common state, and a coordinate's new state is the mean over
the shards that touched it. Only these states (at most ``DIMS`` coordinates of few
shards) reach the driver. Features and scores cover whole texts of all documents.

Defined results: a null text is an empty text; every row gets a score, rows with a
repeated or null doc_id each by their own text; several labels of one doc_id count
by their mean (0.5 and more is 1), null labels not at all; without labels, or with
one class only, every score is (positives + 1) / (labels + 1). Columns of the input
other than doc_id and text are passed through untouched; an input column with the
name of an output column is replaced.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pandas.util import hash_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from strata.llm.common import materialise, text_of
from strata.llm.tokenizers_ import in_slices

MAX_TRAIN_ROWS, SHARD_ROWS, EPOCHS = 20_000, 5_000, 4
THRESHOLD = 0.7
DIM_BITS, STEM, GAPS = 19, 4, (1, 2)
DIMS = 1 << DIM_BITS
ALPHA, BETA, L1, L2 = 2.0, 1.0, 4.0, 0.1
EDGE = string.punctuation + "«»“”‘’„…¡¿–—·"  # not part of a word at its ends
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_STEMS = np.uint64(0xD6E8FEB86659FD93)
_APART = np.arange(max(GAPS) + 1, dtype=np.uint64) * _B  # tells pairs of different gaps apart


def _mixed(h: np.ndarray) -> np.ndarray:
    """The coordinates of hashes."""
    h = (h ^ (h >> np.uint64(32))) * _B
    return ((h ^ (h >> np.uint64(29))) * _A) >> np.uint64(64 - DIM_BITS)


def _hashes(words: pa.Array) -> np.ndarray:
    """Hash of each word, 0 for an empty one."""
    out = hash_array(words.to_numpy(zero_copy_only=False).astype(object), categorize=False) | np.uint64(1)
    out[pc.equal(words, "").to_numpy(zero_copy_only=False)] = 0
    return out


def occurrences(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text's number, coordinate) of all features of whole texts, repeats too.
    Each different word of the texts is hashed once."""
    cut = pc.utf8_split_whitespace(pc.utf8_lower(pa.array(texts, pa.large_string())))
    coded = pc.utf8_trim(cut.flatten(), EDGE).dictionary_encode()
    words, which = coded.dictionary, coded.indices.to_numpy()
    stems = pc.if_else(pc.greater(pc.utf8_length(words), STEM), pc.utf8_slice_codeunits(words, 0, STEM), "")
    doc = np.repeat(np.arange(len(texts)), np.diff(cut.offsets.to_numpy()))
    h, s = _hashes(words)[which], (_hashes(stems) * _STEMS)[which]
    docs, hashes = [doc[s > 0], doc[h > 0]], [s[s > 0], h[h > 0]]
    doc, h = docs[1], hashes[1]
    for gap in GAPS:
        at = np.flatnonzero(doc[:-gap] == doc[gap:])
        docs.append(doc[at])
        hashes.append((h[at] * _A) ^ (h[at + gap] + _APART[gap]))
    return np.concatenate(docs), _mixed(np.concatenate(hashes)).astype(np.int64)


def features(texts: list[str]) -> list[np.ndarray]:
    """Sorted distinct coordinates of each whole text."""
    doc, at = occurrences(texts)
    both = np.unique(doc << DIM_BITS | at)
    return np.split((both & (DIMS - 1)).astype(np.int32), np.searchsorted(both >> DIM_BITS, np.arange(1, len(texts))))


def margins(texts: list[str], weights: np.ndarray) -> np.ndarray:
    """Sum of the weights of each text's distinct features; few have a weight."""
    doc, at = occurrences(texts)
    heavy = np.flatnonzero(weights[at])
    both = np.unique(doc[heavy] << DIM_BITS | at[heavy])
    return np.bincount(both >> DIM_BITS, weights[both & (DIMS - 1)], len(texts))


@F.pandas_udf(BinaryType())
def features_of(texts: pd.Series) -> pd.Series:
    return pd.Series([x.tobytes() for part in in_slices(texts, 2_000_000) for x in features(part)], dtype=object)


class Ftrl:
    """State of FTRL-proximal: ``z`` and ``n`` per coordinate, the last being the
    constant, which is not shrunk."""

    def __init__(self):
        self.z, self.n = np.zeros(DIMS + 1), np.zeros(DIMS + 1)

    def weights(self, at) -> np.ndarray:
        z, shrink = self.z[at], np.where(np.equal(at, DIMS), 0, L1)
        return -np.sign(z) * np.maximum(np.abs(z) - shrink, 0) / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2)

    def learn(self, at: np.ndarray, y: float) -> None:
        """One example with the features ``at`` (the constant among them)."""
        w, n = self.weights(at), self.n[at]
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] += g * g


def _epoch(z: np.ndarray, n: np.ndarray):
    """One pass over each shard; a shard's rows stand together."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, mine, touched = None, None, None

        def out() -> pd.DataFrame:
            at = np.flatnonzero(touched)
            return pd.DataFrame({"shard": [now], "at": [at.astype(np.int32).tobytes()],
                                 "z": [mine.z[at].astype(np.float32).tobytes()],
                                 "n": [mine.n[at].astype(np.float32).tobytes()]})

        for pdf in batches:
            for shard, y, packed in zip(pdf["shard"], pdf["y"], pdf["features"], strict=True):
                if shard != now:
                    if now is not None:
                        yield out()
                    now, mine, touched = shard, Ftrl(), np.zeros(DIMS + 1, bool)
                    mine.z[:], mine.n[:] = z, n
                at = np.append(np.frombuffer(packed, np.int32), np.int32(DIMS))
                mine.learn(at, y)
                touched[at] = True
        if now is not None:
            yield out()

    return run


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_train_rows: int = MAX_TRAIN_ROWS) -> dict:
    """Weights from at most ``max_train_rows`` labelled documents outside the
    held-out part. The sample's ids are bounded by that parameter, which is the
    proven size behind the broadcast."""
    known = (labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id")
             .agg((F.avg(label) >= 0.5).cast("double").alias("y")).filter(~held_out()))
    chosen = (known.join(docs.select("doc_id"), "doc_id", "left_semi")
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train_rows))
    rows = (docs.select("doc_id", text_of().alias("text")).join(F.broadcast(chosen), "doc_id")
            .select("doc_id", "y", features_of("text").alias("features"))
            .groupBy("doc_id").agg(F.min("features").alias("features"), F.min("y").alias("y")))
    n, positives = chosen.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0.0))).first()
    if positives in (0.0, float(n)):
        return {"constant": (positives + 1) / (n + 1)}
    shards = -(-n // SHARD_ROWS)
    # A shard is a written file, so epochs shuffle nothing; a file that is read in pieces is as many shards.
    dealt = materialise(
        rows.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int")).repartition(shards, "shard")
        .sortWithinPartitions("shard", F.xxhash64("doc_id", F.lit("order")), "doc_id").select("shard", "y", "features"),
        "toxic-sample")
    state = Ftrl()
    for _ in range(EPOCHS):
        epoch = _epoch(state.z.astype(np.float32), state.n.astype(np.float32))
        made = dealt.mapInPandas(epoch, "shard int, at binary, z binary, n binary").collect()
        sum_z, sum_n, times = np.zeros(DIMS + 1), np.zeros(DIMS + 1), np.zeros(DIMS + 1)
        for r in sorted(made, key=lambda r: (r["shard"], len(r["at"]), r["z"])):
            at = np.frombuffer(r["at"], np.int32)
            sum_z[at] += np.frombuffer(r["z"], np.float32)
            sum_n[at] += np.frombuffer(r["n"], np.float32)
            times[at] += 1
        del made
        seen = times > 0
        state.z[seen], state.n[seen] = sum_z[seen] / times[seen], sum_n[seen] / times[seen]
    weights = state.weights(np.arange(DIMS + 1))
    at = np.flatnonzero(weights[:DIMS])
    return {"at": at.astype(np.int32), "weight": weights[at], "base": float(weights[DIMS])}


def with_scores(docs: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with columns ``score`` and ``predicted``; one pass over the texts."""

    @F.pandas_udf("double")
    def score_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights = np.zeros(DIMS)
        if "constant" not in model:
            weights[model["at"]] = model["weight"]
        for texts in batches:
            if "constant" in model:
                yield pd.Series(np.full(len(texts), model["constant"]))
            else:
                made = [margins(part, weights) for part in in_slices(texts, 2_000_000)]
                yield pd.Series(1 / (1 + np.exp(-np.concatenate([*made, np.zeros(0)]) - model["base"])))

    return (docs.withColumn("score", score_of(text_of()))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def classify(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_train_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    return with_scores(docs, train(docs, labels, label, max_train_rows))
