"""Operator 13: hard negatives through a multiway hyperplane tree (after GNAT).

Scores are integer inner products. One further coordinate brings all vectors to
the same length, so that a score is a distance and a window of scores an annulus
around the anchor. The tree cuts space by nearest split points, ``DEGREE`` in a
node, fitted on a bounded sample; every row is then indexed: it walks to its leaf,
and each split point gets the exact range of its distances to the rows under each
of its sibling subtrees. An anchor's annuli are met with these ranges on the way
down, and a subtree that no annulus reaches is left out with all its leaves. Rows
of the leaves that stay are scored exactly, so nothing is approximate.

Two searches, each first in the anchor's own leaf, whose best scores narrow the
annuli for the other leaves: positives (the best of the same label, no window),
then, with a window per positive, negatives (the best of other labels within it).

Leaves are cut into blocks of about ``BLOCK_BYTES`` by a hash of the id, so a leaf
with very many rows is many blocks. Blocks, in the order of their leaves, form
about ``SLABS`` slabs. Anchors travel in packs, once to each slab that has a leaf
they need: an anchor is copied ``SLABS`` times at most, however many blocks there
are. A task holds the blocks of its slab and lets the packs pass, and only the
best of a slab come back. Blocks and packs meet in one shuffle, not in a join, so
neither is ever broadcast, and the driver holds the sample and the tree alone.

Defined results: rows with a null id, label or vector, with a null or non-finite
component, of another length than the most frequent one (ties: the longer), or of
a squared length of 2^62 or more (whose scores may not fit a long) take no part;
rows with equal ids count once (the smallest label and vector). Ties go to the
smaller id; fewer rows than asked for: all of them. Other columns do not matter.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.ann import _top
from strata.llm.common import materialise

N_POSITIVES, N_NEGATIVES, LOW, HIGH = 5, 3, 50, 95
DEGREE, MAX_DEPTH, LEAF_ROWS = 8, 3, 2048
FIT_ROWS, FIT_BYTES = 4096, 16_000_000
BLOCK_BYTES, PACK = 250_000, 512
#: Slabs, and the bytes of one from which there are more of them.
SLABS, SLAB_BYTES = 48, 16_000_000
FAR = 1 << 62
#: A block (with its leaf) or a pack (leaf -1, windows, bits of the leaves needed).
_SHIPPED = "slab int, leaf int, ids binary, labels binary, vectors binary, windows binary, leaves binary"
_FOUND = "anchor_id long, w int, vec_id long, score long"


def valid_rows(df: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, v) of the rows that take part, once per id; v: array<long>."""
    x = F.col("x")
    bad = F.exists("x", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) >= F.lit(2.0 ** 31)))
    rows = (df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
                      F.col(vec_col).cast("array<double>").alias("x"))
            .filter("vec_id is not null and label is not null and x is not null").filter(~bad)
            .filter(F.aggregate("x", F.lit(0.0), lambda a, e: a + e * e) < F.lit(float(FAR))))
    d = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    same = rows.filter(F.size("x") == (d["d"] if d else 0)).groupBy("vec_id")
    return same.agg(F.min(F.struct("label", x.cast("array<long>").alias("v"))).alias("r")).select("vec_id", "r.*")


class Tree:
    """Split points, children and distance ranges of the nodes; ``longest`` is the
    squared length that the further coordinate fills up to."""

    def __init__(self, sample: np.ndarray, longest: float, depth: int):
        self.longest, self.points, self.children, self.paths = longest, [], [], []
        if not len(sample):
            sample = np.zeros((1, 1))
        self._split(self.lifted(sample), depth, [])
        self.low = self.high = None
        #: How components are stored and multiplied: no sum of products of parts
        #: exceeds ``longest`` (Cauchy-Schwarz), so floats are exact where it fits them.
        self.stored = np.dtype("<i2" if self.longest < 2.0 ** 30 else "<i4")
        self.number = np.float32 if self.longest < 2.0 ** 24 else np.float64 if self.longest < 2.0 ** 52 else np.int64

    def lifted(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.longest - (x * x).sum(1), 0))
        return np.hstack([x, rest[:, None]])

    def _split(self, rows: np.ndarray, depth: int, path: list[tuple[int, int]]) -> int:
        """Number of the node over the sample's ``rows``; a leaf is -1 - its number."""
        if not depth or len(rows) < 2 * DEGREE and path:
            self.paths.append(path)
            return -len(self.paths)
        # Split points far from each other: the next is the farthest from those chosen.
        chosen = [int(((rows - rows.mean(0)) ** 2).sum(1).argmin())]
        gap = ((rows - rows[chosen[0]]) ** 2).sum(1)
        while len(chosen) < min(DEGREE, len(rows)) and gap.max() > 0:
            chosen.append(int(gap.argmax()))
            gap = np.minimum(gap, ((rows - rows[chosen[-1]]) ** 2).sum(1))
        node, points = len(self.points), rows[chosen]
        self.points.append(points)
        self.children.append([])
        to = distances(rows, points).argmin(1)
        self.children[node] = [self._split(rows[to == j], depth - 1, [*path, (node, j)]) for j in range(len(points))]
        return node

    def leaves_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row of (not lifted) vectors."""
        lifted, at = self.lifted(x), np.zeros(len(x), np.int64)
        while (at >= 0).any():
            for node in np.unique(at[at >= 0]):
                rows = np.flatnonzero(at == node)
                at[rows] = np.array(self.children[node])[distances(lifted[rows], self.points[node]).argmin(1)]
        return -1 - at

    def path_ranges(self, leaf: int, x: np.ndarray) -> tuple[list[float], list[float]]:
        """Least and largest distance of rows of a leaf to the split points on its path."""
        lifted = self.lifted(x)
        d = np.hstack([distances(lifted, self.points[node]) for node, _ in self.paths[leaf]])
        return d.min(0).tolist(), d.max(0).tolist()

    def take_ranges(self, by_leaf: dict[int, tuple[list[float], list[float]]]) -> None:
        """Ranges of every split point to every sibling subtree, from those of the leaves."""
        self.low = [np.full((len(p), len(p)), np.inf) for p in self.points]
        self.high = [np.full((len(p), len(p)), -np.inf) for p in self.points]
        for leaf, (low, high) in by_leaf.items():
            at = 0
            for node, j in self.paths[leaf]:
                n = len(self.points[node])
                self.low[node][:, j] = np.minimum(self.low[node][:, j], low[at:at + n])
                self.high[node][:, j] = np.maximum(self.high[node][:, j], high[at:at + n])
                at += n

    def reached(self, x: np.ndarray, inner: np.ndarray, outer: np.ndarray) -> np.ndarray:
        """Mask (queries x leaves) of the leaves that some annulus (queries x
        windows, inner and outer radius) reaches."""
        lifted = np.hstack([x, np.zeros((len(x), 1))])
        out = np.zeros((len(x), len(self.paths)), bool)
        slack = 1e-7 * (1 + np.sqrt(self.longest) + np.linalg.norm(x, axis=1))[:, None]

        def visit(node: int, rows: np.ndarray) -> None:
            d = distances(lifted[rows], self.points[node])
            for j, child in enumerate(self.children[node]):
                low, high = self.low[node][:, j], self.high[node][:, j]
                nearest = np.maximum(d - high, low - d).max(1)[:, None] - slack[rows]
                farthest = (d + high).min(1)[:, None] + slack[rows]
                stay = rows[((nearest <= outer[rows]) & (farthest >= inner[rows])).any(1)]
                if child < 0:
                    out[stay, -1 - child] = True
                elif len(stay):
                    visit(child, stay)

        visit(0, np.arange(len(x)))
        return out


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows of ``a`` to those of ``b``."""
    return np.stack([np.sqrt(((a - y) ** 2).sum(1)) for y in b], 1)


def fit(rows: DataFrame, n: int) -> Tree:
    """A tree on at most ``FIT_ROWS`` rows (and ``FIT_BYTES``), chosen by a hash."""
    longest, dims = rows.select(F.max(F.aggregate("v", F.lit(0.0), lambda a, e: a + e * e)), F.max(F.size("v"))).first()
    limit = max(1, min(FIT_ROWS, FIT_BYTES // (8 * max(dims or 1, 1))))
    # Each task hands the driver its first ``limit`` rows; below this hash there are
    # about twice as many as needed in all, in whatever number of tasks.
    h, below = F.xxhash64("vec_id"), ((2 * limit + 100 << 64) // max(n, 1)) - (1 << 63)
    first = lambda d: d.orderBy(h, "vec_id").limit(limit).select("v").toPandas()["v"]
    sample = first(rows.filter(h <= F.lit(below)) if below < 1 << 63 else rows)
    if len(sample) < min(limit, n):
        sample = first(rows)
    depth = 1
    while depth < MAX_DEPTH and DEGREE ** depth * LEAF_ROWS < n:
        depth += 1
    return Tree(np.array(sample.to_list(), float).reshape(len(sample), dims or 1), longest or 0.0, depth)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.to_list(), np.int64).reshape(len(column), -1)


def _leaf_of(tree: Tree):
    @F.pandas_udf("int")
    def leaf(v: pd.Series) -> pd.Series:
        return pd.Series(tree.leaves_of(_matrix(v).astype(float)), dtype="int32") if len(v) else pd.Series([], dtype="int32")

    return leaf


class Slabs:
    """Which slab holds each block: the blocks, in the order of leaf and part, in runs."""

    def __init__(self, parts: dict[int, int], n_leaves: int):
        per_leaf = np.array([parts.get(leaf, 0) for leaf in range(n_leaves)], np.int64)
        self.before, self.total = np.append(0, np.cumsum(per_leaf)).tolist(), int(per_leaf.sum())
        self.n = max(1, min(SLABS, self.total), -(-self.total * BLOCK_BYTES // SLAB_BYTES))

    def of(self, leaf: int, part: int) -> int:
        return (self.before[leaf] + part) * self.n // self.total

    def leaves(self) -> list[np.ndarray]:
        """The leaves that each slab has blocks of."""
        out = [[] for _ in range(self.n)]
        for leaf, (a, b) in enumerate(zip(self.before, self.before[1:], strict=False)):
            if a < b:
                for slab in range(self.of(leaf, 0), self.of(leaf, b - a - 1) + 1):
                    out[slab].append(leaf)
        return [np.array(x, np.int64) for x in out]


def _pack(tree: Tree, slabs: Slabs):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id")
        x, leaf = _matrix(pdf["v"]), int(pdf["leaf"].iloc[0])
        low, high = tree.path_ranges(leaf, x.astype(float))
        return pd.DataFrame([(slabs.of(leaf, int(pdf["part"].iloc[0])), leaf, pdf["vec_id"].to_numpy(np.int64).tobytes(),
                              pdf["label"].to_numpy(np.int64).tobytes(), x.astype(tree.stored).tobytes(), low, high)],
                            columns=["slab", "leaf", "ids", "labels", "vectors", "low", "high"])

    return run


def index(rows: DataFrame) -> tuple[Tree, DataFrame, DataFrame, Slabs]:
    """(tree with ranges, rows with ``leaf``, leaf blocks, their slabs)."""
    tree = fit(rows, rows.count())
    placed = materialise(rows.withColumn("leaf", _leaf_of(tree)("v")), "gnat-rows")
    # One row per leaf, of which there are DEGREE ** MAX_DEPTH at most.
    sizes = placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d")).collect()
    parts = {r["leaf"]: -(-r["n"] * (tree.stored.itemsize * r["d"] + 16) // BLOCK_BYTES) for r in sizes}
    slabs = Slabs(parts, len(tree.paths))
    count = F.element_at(F.create_map(*[F.lit(x) for kv in parts.items() for x in kv]), F.col("leaf")) if parts else F.lit(1)
    blocks = materialise(
        placed.withColumn("part", F.pmod(F.xxhash64("vec_id"), count).cast("int")).groupBy("leaf", "part").applyInPandas(
            _pack(tree, slabs), "slab int, leaf int, ids binary, labels binary, vectors binary, low array<double>, "
            "high array<double>"), "gnat-blocks")
    ranges = (blocks.select("leaf", F.posexplode(F.arrays_zip("low", "high")).alias("at", "r"))
              .groupBy("leaf", "at").agg(F.min("r.low").alias("low"), F.max("r.high").alias("high"))
              .groupBy("leaf").agg(F.sort_array(F.collect_list(F.struct("at", "low", "high"))).alias("r")).collect())
    tree.take_ranges({r["leaf"]: ([x["low"] for x in r["r"]], [x["high"] for x in r["r"]]) for r in ranges})
    return tree, placed, blocks, slabs


def _visits(tree: Tree, slabs: Slabs, home: bool):
    """Packs of anchors for the slabs they need: those with their own leaf, or with
    any other leaf that an annulus reaches."""

    def run(batches):
        leaves = slabs.leaves()
        for pdf in batches:
            pdf = pdf.sort_values("leaf")
            for at in range(0, len(pdf), PACK):
                part = pdf.iloc[at:at + PACK]
                x = _matrix(part["v"])
                n_windows = max(map(len, part["windows"]))
                windows = np.full((len(part), n_windows, 2), FAR, np.int64)  # low over high: no window
                windows[:, :, 1] = -FAR
                for i, w in enumerate(part["windows"]):
                    windows[i, :len(w)] = [(r["low"], r["high"]) for r in w]
                own = np.zeros((len(part), len(tree.paths)), bool)
                own[np.arange(len(part)), part["leaf"]] = True
                if home:
                    need = own
                else:
                    xf = x.astype(float)
                    square = ((xf * xf).sum(1) + tree.longest)[:, None]
                    radius = lambda s: np.sqrt(np.maximum(square - 2 * s.astype(float), 0))
                    outer = np.where(windows[:, :, 0] <= windows[:, :, 1], radius(windows[:, :, 0]), -1)
                    inner = np.where(outer >= 0, radius(windows[:, :, 1]), np.inf)
                    need = tree.reached(xf, inner, outer) & ~own
                ids, labels = (part[c].to_numpy(np.int64) for c in ("anchor_id", "label"))
                stored, bits = x.astype(tree.stored), np.packbits(need, axis=1)
                packs = []
                for slab, held in enumerate(leaves):
                    m = need[:, held].any(1)
                    if m.any():
                        packs.append((slab, -1, *(y[m].tobytes() for y in (ids, labels, stored, windows, bits))))
                yield pd.DataFrame(packs, columns=[c.split()[0] for c in _SHIPPED.split(", ")])

    return run


def best_in_windows(scores, may, low, high, k):
    """(query, window, position) of the ``k`` best of each query and window (``low``
    and ``high``: queries x windows) among the pairs in the mask ``may``, and of
    other pairs with the score of the last; of equal scores the first ``k``."""
    out, n = [], scores.shape[1]
    for w in range(low.shape[1]):
        fits = may & (scores >= low[:, w, None]) & (scores <= high[:, w, None])
        if n > k:
            held = np.where(fits, scores, -FAR)
            last = np.partition(held, n - k, axis=1)[:, n - k][:, None]
            ties = fits & (held == last)
            fits &= held > last
            fits |= ties & (ties.cumsum(1) <= k)
        i, j = np.nonzero(fits)
        out.append((i, np.full(len(i), w, np.int32), j))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


class Best:
    """The ``k`` best of each query and window, of the blocks seen so far."""

    def __init__(self, ids: np.ndarray, windows: np.ndarray, k: int):
        self.ids, self.k, self.low, self.high = ids, k, windows[:, :, 0].copy(), windows[:, :, 1]
        self.held, self.new = [np.zeros(0, np.int64)] * 3, []  # query and window, id, score

    def see(self, rows, scores, alike, same: bool, c_ids) -> None:
        """``scores`` (queries x rows of a block) of the queries at ``rows``;
        ``alike``: which labels agree, of positions of both. A block has its ids in order."""
        low, high = self.low[rows].astype(scores.dtype), self.high[rows].astype(scores.dtype)
        near = (scores >= low.min(1)[:, None]) & (scores <= high.max(1)[:, None])
        if 20 * np.count_nonzero(near) > near.size:
            i, j = np.indices(scores.shape, sparse=True)
            may = alike(i, j) & (self.ids[rows][i] != c_ids[j]) if same else ~alike(i, j)
            i, w, j = best_in_windows(scores, near & may, low, high, self.k)
        else:
            i, j = np.nonzero(near)
            may = alike(i, j) & (self.ids[rows][i] != c_ids[j]) if same else ~alike(i, j)
            i, j = i[may], j[may]
            at, w = np.nonzero((scores[i, j][:, None] >= low[i]) & (scores[i, j][:, None] <= high[i]))
            i, j = i[at], j[at]
        if len(i):
            self.new.append((rows[i] * self.low.shape[1] + w, c_ids[j], scores[i, j].astype(np.int64)))
            if sum(len(x[0]) for x in self.new) > self.low.size * self.k:
                self.settle()

    def settle(self) -> tuple[np.ndarray, ...]:
        """(query, window, id, score) of the best; their last is the least that still counts."""
        at, ids, scores = (np.concatenate(x) for x in zip(self.held, *self.new, strict=True))
        best = _top(at, ids, scores, self.k)
        at, ids, scores = self.held = [at[best], ids[best], scores[best]]
        self.new = []
        ends = np.flatnonzero(np.append(at[1:] != at[:-1], True)) if len(at) else at
        full = ends[np.bincount(at, minlength=1)[at[ends]] == self.k]
        i, w = np.divmod(at[full], self.low.shape[1])
        self.low[i, w] = np.maximum(self.low[i, w], scores[full])
        i, w = np.divmod(at, self.low.shape[1])
        return i, w, ids, scores


def _score(tree: Tree, same: bool, k: int):
    """Over the rows of one slab after another, blocks before packs."""

    def run(batches):
        slab, held = None, []
        for pdf in batches:
            for r in pdf.to_dict("records"):
                if r["slab"] != slab:
                    slab, held = r["slab"], []
                ids, labels = (np.frombuffer(r[c], np.int64) for c in ("ids", "labels"))
                x = np.frombuffer(r["vectors"], tree.stored).reshape(len(ids), -1).astype(tree.number)
                if r["leaf"] >= 0:
                    held.append((r["leaf"], ids, labels, x))
                    continue
                need = np.unpackbits(np.frombuffer(r["leaves"], np.uint8).reshape(len(ids), -1), axis=1).astype(bool)
                best = Best(ids, np.frombuffer(r["windows"], np.int64).reshape(len(ids), -1, 2), k)
                for leaf, c_ids, c_labels, c in held:
                    rows = np.flatnonzero(need[:, leaf])
                    if len(rows):
                        mine_ = labels[rows]
                        best.see(rows, x[rows] @ c.T, lambda i, j: mine_[i] == c_labels[j], same, c_ids)  # noqa: B023
                i, w, vec_id, score = best.settle()
                yield pd.DataFrame({"anchor_id": ids[i], "w": w.astype(np.int32), "vec_id": vec_id, "score": score})

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("anchor_id", "w").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def search(queries: DataFrame, tree: Tree, blocks: DataFrame, slabs: Slabs, same: bool, k: int) -> DataFrame:
    """(anchor_id, w, vec_id, score, rank): the ``k`` best rows in each window of
    ``queries`` (anchor_id, label, v, leaf, windows), of the same or of other labels."""
    def pass_(q: DataFrame, home: bool, name: str) -> DataFrame:
        packs = q.select("anchor_id", "label", "v", "leaf", "windows").mapInPandas(_visits(tree, slabs, home), _SHIPPED)
        shipped = packs.unionByName(blocks.drop("low", "high"), allowMissingColumns=True)
        found = (shipped.repartition("slab").sortWithinPartitions("slab", F.desc("leaf"))
                 .mapInPandas(_score(tree, same, k), _FOUND))
        return materialise(found, name)

    at_home = _ranked(pass_(queries, True, "gnat-home"), k)
    # The k-th best score found so far is the least that still counts.
    reached = (at_home.filter(F.col("rank") == k).groupBy("anchor_id")
               .agg(F.map_from_entries(F.collect_list(F.struct("w", "score"))).alias("reached")))
    narrowed = queries.hint("merge").join(reached, "anchor_id", "left").withColumn("windows", F.transform(
        "windows", lambda x, w: F.struct(
            F.greatest(x["low"], F.coalesce(F.try_element_at("reached", w), x["low"])).alias("low"),
            x["high"].alias("high"))))
    away = pass_(narrowed, False, "gnat-away")
    return _ranked(at_home.drop("rank").unionByName(away), k)


def mine(vectors: DataFrame, is_anchor: Column, n_positives: int = N_POSITIVES, n_negatives: int = N_NEGATIVES,
         low: int = LOW, high: int = HIGH, id_col: str = "vec_id", vec_col: str = "embedding",
         label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score:
    for each anchor (rows where ``is_anchor`` holds over vec_id) and each of its
    best rows of the same label the best rows of other labels that score ``low`` to
    ``high`` per cent of the positive. Vectors hold whole numbers."""
    rows = materialise(valid_rows(vectors, id_col, vec_col, label_col), "gnat-valid")
    tree, placed, blocks, slabs = index(rows)
    anchors = materialise(placed.filter(is_anchor).withColumnRenamed("vec_id", "anchor_id"), "gnat-anchors")
    open_ = F.array(F.struct(F.lit(-FAR).alias("low"), F.lit(FAR).alias("high")))
    positives = materialise(
        search(anchors.withColumn("windows", open_), tree, blocks, slabs, True, n_positives)
        .select("anchor_id", (F.col("rank") - 1).alias("w"), F.col("vec_id").alias("positive_id"),
                F.col("score").alias("positive_score")), "gnat-positives")
    share = lambda p: F.col("positive_score").cast("decimal(20,0)") * F.lit(p) / F.lit(100)
    windows = positives.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct(
        "w", F.ceil(share(low)).cast("long").alias("low"), F.floor(share(high)).cast("long").alias("high")))).alias("x"))
    asked = anchors.hint("merge").join(windows, "anchor_id").withColumn("windows", F.transform(
        "x", lambda e: F.struct(e["low"].alias("low"), e["high"].alias("high"))))
    found = search(asked, tree, blocks, slabs, False, n_negatives)
    return found.hint("merge").join(positives, ["anchor_id", "w"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
