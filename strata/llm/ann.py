"""Operator 3: nearest neighbours by a block matrix join.

Vectors are packed into blocks, one row per block, with an int8 code for each
vector (its own scale) and the exact norms of the code and of what the code
leaves out. Query blocks meet candidate blocks by an equi-join on the candidate
block, every row of the join a tile. In a tile the product of the codes gives all
inner products at once, each with a proven error bound (Cauchy-Schwarz on the
left-out parts). A pair whose upper bound lies under the query's k-th best lower
bound cannot be among the k nearest; the survivors are computed again from the
original vectors in double precision, component by component in order, and each
tile hands on its k best per query. These are merged by heaps, in two steps, so
what one task holds does not grow with the number of tiles.

Exact: recall is 1 by the bounds. Work is queries x candidates / tiles, the
contract's stated query set against all rows, in blocks.

Defined results: vectors that are null, empty, all zero, hold a null or
non-finite component, or differ in length from the most frequent length (ties:
the longer) take no part; rows with equal ids count once (the smallest vector in
array order). Ties go to the smaller id. Fewer candidates than k: all of them.
Further columns do not matter.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialise

K = 20
BLOCK_BYTES, QUERY_BLOCK_BYTES = 4_000_000, 1_000_000
FAN_IN = 64
_PACKED = "block long, ids binary, codes binary, scale binary, code_norm binary, rest_norm binary, vectors binary"
_FOUND = "query_id long, tile long, vec_id long, score double"


def valid_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, v) of the rows that take part, once per id."""
    v = F.col(vec_col).cast("array<double>")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = (df.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
            .filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).filter(~bad)
            .filter(F.exists("v", lambda x: x != 0)))
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d"))
    d = sizes.first()
    return rows.filter(F.size("v") == (d["d"] if d else 0)).groupBy("vec_id").agg(F.min("v").alias("v"))


def quantise(x: np.ndarray):
    """int8 codes, scales, norms of scale * code, and norms of what is left."""
    scale = np.abs(x).max(1) / 127
    scale[scale == 0] = 1.0
    codes = np.clip(np.rint(x / scale[:, None]), -127, 127).astype(np.int8)
    approx = codes * scale[:, None]
    return codes, scale, np.linalg.norm(approx, axis=1), np.linalg.norm(x - approx, axis=1)


def _pack(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("vec_id")
    x = np.array(pdf["v"].to_list(), np.float64)
    codes, scale, code_norm, rest = quantise(x)
    return pd.DataFrame([(int(pdf["block"].iloc[0]), pdf["vec_id"].to_numpy(np.int64).tobytes(), codes.tobytes(),
                          scale.tobytes(), code_norm.tobytes(), rest.tobytes(), x.tobytes())],
                        columns=[c.split()[0] for c in _PACKED.split(", ")])


def blocks(vectors: DataFrame, dims: int, size: int) -> DataFrame:
    """Blocks of about ``size`` bytes: what a group or a row holds does not grow
    with the number of vectors or of their dimensions."""
    n = max(1, -(-vectors.count() * 9 * max(dims, 1) // size))
    return (vectors.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(n)))
            .groupBy("block").applyInPandas(_pack, _PACKED))


def tile_survivors(q, c, k: int) -> np.ndarray:
    """Mask (queries x candidates) of the pairs that may be among the k nearest.
    q, c: ids, codes, scale, code_norm, rest_norm. float32 holds every integer
    product sum up to 1,040 dimensions exactly; beyond that double is used."""
    kind = np.float32 if q[1].shape[1] <= 1040 else np.float64
    approx = (q[1].astype(kind) @ c[1].astype(kind).T).astype(np.float64) * q[2][:, None] * c[2][None, :]
    bound = (q[4][:, None] * (c[3] + c[4])[None, :] + q[3][:, None] * c[4][None, :]) * (1 + 1e-9) + 1e-12 * np.abs(approx)
    low = approx - bound
    own = q[0][:, None] == c[0][None, :]
    low[own] = -np.inf
    others = c[0].shape[0]
    if others > k:
        at = np.partition(low, others - k, axis=1)[:, others - k][:, None]
    else:
        at = np.full((len(q[0]), 1), -np.inf)
    return (approx + bound >= at) & ~own


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products in double, summed component by component."""
    out = np.zeros(len(a))
    for d in range(a.shape[1]):
        out += a[:, d] * b[:, d]
    return out


def _unpack(row, side: str):
    ids = np.frombuffer(row[f"{side}ids"], np.int64)
    f = lambda c: np.frombuffer(row[f"{side}{c}"], np.float64)
    n = len(ids)
    return (ids, np.frombuffer(row[f"{side}codes"], np.int8).reshape(n, -1), f("scale"), f("code_norm"),
            f("rest_norm"), f("vectors").reshape(n, -1))


def _top(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best of each query: score descending, then id."""
    order = np.lexsort((ids, -scores, query))
    q = query[order]
    first = np.flatnonzero(np.diff(q, prepend=q[0] - 1 if len(q) else 0))
    rank = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
    return order[rank < k]


def _tiles(k: int):
    def run(batches):
        for pdf in batches:
            for row in pdf.to_dict("records"):
                q, c = _unpack(row, "q_"), _unpack(row, "")
                for at in range(0, len(q[0]), 256):
                    part = tuple(x[at:at + 256] for x in q)
                    i, j = np.nonzero(tile_survivors(part, c, k))
                    scores = exact_scores(part[5][i], c[5][j])
                    best = _top(part[0][i], c[0][j], scores, k)
                    yield pd.DataFrame({"query_id": part[0][i[best]], "tile": row["block"], "vec_id": c[0][j[best]],
                                        "score": scores[best]})

    return run


def _merge(k: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        best = heapq.nsmallest(k, zip(-pdf["score"], pdf["vec_id"], strict=True))
        return pd.DataFrame({"query_id": pdf["query_id"].iloc[0], "rank": np.arange(1, len(best) + 1, dtype=np.int32),
                             "vec_id": [v for _, v in best], "score": [-s for s, _ in best]})

    return run


def _merge_some(k: int):
    """Heaps over rows sorted by query: the first merge, of ``FAN_IN`` tiles."""

    def run(batches):
        at, heap = None, []

        def out():
            return pd.DataFrame([(at[0], at[1], -v, s) for s, v in heap], columns=["query_id", "tile", "vec_id", "score"])

        for pdf in batches:
            done = []
            for q, g, v, s in zip(pdf["query_id"], pdf["tile"], pdf["vec_id"], pdf["score"], strict=True):
                if (q, g) != at:
                    if heap:
                        done.append(out())
                    at, heap = (q, g), []
                if len(heap) < k:
                    heapq.heappush(heap, (s, -v))
                else:
                    heapq.heappushpop(heap, (s, -v))
            if done:
                yield pd.concat(done)
        if heap:
            yield out()

    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` largest inner products
    of each query (rows where ``is_query`` holds over vec_id) among all others."""
    valid = materialise(valid_vectors(vectors, id_col, vec_col), "vectors")
    dims = valid.select(F.max(F.size("v"))).first()[0] or 0
    candidates = materialise(blocks(valid, dims, BLOCK_BYTES), "candidate-blocks")
    queries = blocks(valid.filter(is_query), dims, QUERY_BLOCK_BYTES)
    renamed = queries.select(*[F.col(c).alias(f"q_{c}") for c in queries.columns])
    # Every query block goes to every candidate block, by number; tiles are the join's rows.
    n = candidates.count()
    if n == 0:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    last = candidates.select("block").agg(F.max("block")).first()[0]
    dealt = renamed.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(last)).cast("array<long>")))
    found = dealt.join(candidates, "block").mapInPandas(_tiles(k), _FOUND)
    while n > FAN_IN:
        n = -(-n // FAN_IN)
        found = (found.withColumn("tile", F.floor(F.col("tile") / FAN_IN)).repartition("query_id", "tile")
                 .sortWithinPartitions("query_id", "tile").mapInPandas(_merge_some(k), _FOUND))
    return found.groupBy("query_id").applyInPandas(_merge(k), "query_id long, rank int, vec_id long, score double")
