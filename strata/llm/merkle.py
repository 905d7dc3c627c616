"""Operator 11: Merkle manifest of a dataset as a postorder append log.

Every row is a leaf; the leaves of a group, by key, carry an 8-ary hash tree, and
the groups' roots, by group, another one, whose root stands for the table.

*Log.* A tree's nodes are numbered in the order in which they are completed
(postorder). A node's number follows in closed form from the sizes of the
subtrees to its left (``position``), so the log is written by many tasks at once:
an aligned builder takes the nodes below one node three levels up (512 leaves, or
512 nodes of a higher level) and appends the nodes that it completes, in
completion order, at their positions. Rounds go three levels up each, over 1/512
of the rows of the round before. A row of the log holds consecutive nodes.

*Proofs.* The siblings on the way to the root are addressed by the same closed
form. They are handed down from the root in the builders' blocks: a block gets
the proof of its top node and gives each node at its bottom that proof with the
siblings inside the block. So no node is fetched by more than the rows of a
block, and no task holds more than one block.

*Order.* Leaves are dealt out by ranges of (group, key, digest), so a group that
holds most rows is spread; a row's index in its group is its place in its range
plus the counts of the ranges before (one row per range and group). Rows equal in
all fields are interchangeable and are split too.

Defined results: a null field is ``-``, an empty one ``0:``. A null group is a
group of its own, the first; null keys come first in their group; rows with the
same key follow each other in the order of their digests and are a leaf each. An
empty table has no root and gives no rows. Columns that are no fields do not
matter.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import materialise

# Fixed values of the operator's contract: nodes of a run, and the fields of a leaf.
WIDTH = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEP = 3  # levels of a builder: 512 nodes at its bottom
SIZE = 32  # bytes of a digest
LOG = "tree long, n long, base int, block long, level int, index long, position long, nodes binary"


def leaf_digest(fields: list[Column]) -> Column:
    """sha256 over the fields, each as ``byte count:value`` or ``-``."""
    def written(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*[written(c) for c in fields]), 256))


def indexed(rows: DataFrame, group: str, order: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` with ``at``: the index (from 0) of a row in its group in the
    given order, and (group, n). Nulls come first."""
    by = [F.col(c).asc_nulls_first() for c in (group, *order, "_any")]
    placed = materialise(rows.withColumn("_any", F.monotonically_increasing_id()).repartitionByRange(*by)
                         .sortWithinPartitions(*by).drop("_any").withColumn("_seq", F.monotonically_increasing_id()),
                         name)
    part = F.shiftright("_seq", 33)
    ranges = materialise(placed.groupBy(F.col(group).alias("_group"), part.alias("_part"))
                         .agg(F.count(F.lit(1)).alias("_n"), F.min("_seq").alias("_first")), f"{name}-ranges")
    before = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first"))
    out = (placed.join(starts, F.col(group).eqNullSafe(F.col("_group")) & (part == F.col("_part")))
           .withColumn("at", F.col("_seq") + F.col("_start")).drop("_group", "_part", "_n", "_first", "_start", "_seq"))
    return out, ranges.groupBy(F.col("_group").alias(group)).agg(F.sum("_n").alias("n"))


def height(n: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    h = 0
    while WIDTH ** h < n:
        h += 1
    return h


def width_at(n: int, level: int) -> int:
    """Nodes at a level."""
    return -(-n // WIDTH ** level)


def position(n: int, level: int, index: int) -> int:
    """Number of a node in the postorder of a tree of ``n`` leaves: the nodes
    completed no later, less one. Up to its own level these are the nodes under
    its right end; above, the ancestors of what lies to its left."""
    done = sum(min((index + 1) * WIDTH ** (level - j), width_at(n, j)) for j in range(level + 1))
    return done + sum(index // WIDTH ** (j - level) for j in range(level + 1, height(n) + 1)) - 1


def _hash(children: list[bytes]) -> bytes:
    return sha256(b"".join(children).hex().encode()).digest()


def build_block(n: int, base: int, block: int, digests: list[bytes]) -> list[tuple[int, int, int, bytes]]:
    """(level, index, position, nodes) of the runs that the builder of a block
    appends, ``level`` and ``index`` being those of a run's last node. Its input
    are the block's nodes at level ``base``, left to right; leaves (level 0) are
    appended too, higher ones stand in the log already."""
    first, last, top = block * WIDTH ** STEP, width_at(n, base) - 1, min(base + STEP, height(n))
    open_: list[list[bytes]] = [[] for _ in range(STEP + 1)]
    out, run, start = [], [], None
    for index, digest in enumerate(digests, first):
        at, level, done = index, base, digest
        if base == 0:
            run.append(digest)
            start = position(n, 0, index) if start is None else start
        while level < top:
            open_[level - base].append(done)
            if (at + 1) % WIDTH and index != last:
                break
            done = _hash(open_[level - base])
            open_[level - base] = []
            at, level = at // WIDTH, level + 1
            if start is None:
                start = position(n, level, at)
            run.append(done)
        # Under a leaf block all is one run; above, other builders' nodes stand between.
        if run and (base or index == first + len(digests) - 1):
            out.append((level, at, start, b"".join(run)))
            run, start = [], None
    return out


def _builder(base: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("index")
        tree, n, block = (int(pdf[c].iloc[0]) for c in ("tree", "n", "block"))
        return pd.DataFrame([(tree, n, base, block, *x) for x in build_block(n, base, block, pdf["digest"].tolist())],
                            columns=[c.split()[0] for c in LOG.split(", ")])

    return run


def append_log(leaves: DataFrame, path: str, largest: int) -> DataFrame:
    """Write the log of all trees of ``leaves`` (tree, n, index, digest), the
    largest of ``largest`` leaves; one folder per round."""
    spark, base, rounds = leaves.sparkSession, 0, []
    while base == 0 or base < height(largest):
        (leaves.withColumn("block", F.floor(F.col("index") / WIDTH ** STEP)).groupBy("tree", "block")
         .applyInPandas(_builder(base), LOG).write.parquet(f"{path}/base{base}"))
        rounds.append(spark.read.schema(LOG).parquet(f"{path}/base{base}"))
        base += STEP
        leaves = (rounds[-1].filter((F.col("level") == base) & (F.col("n") > WIDTH ** base))
                  .select("tree", "n", "index", F.substring("nodes", -SIZE, SIZE).alias("digest")))
    out = rounds[0]
    for more in rounds[1:]:
        out = out.unionByName(more)
    return out


# A proof: for each level the digests left of the node and right of it, after their numbers in a byte each.
def pack_proof(runs: list[tuple[list[bytes], list[bytes]]]) -> bytes:
    return b"".join(bytes([len(a), len(b)]) + b"".join(a) + b"".join(b) for a, b in runs)


def unpack_proof(proof: bytes) -> list[tuple[bytes, bytes]]:
    """(digests to the left, digests to the right) of each level."""
    out, at = [], 0
    while at < len(proof):
        a, b = proof[at] * SIZE, proof[at + 1] * SIZE
        out.append((proof[at + 2:at + 2 + a], proof[at + 2 + a:at + 2 + a + b]))
        at += 2 + a + b
    return out


def fold(digest: bytes, proof: bytes) -> bytes:
    """The root that follows from a leaf and its proof."""
    for left, right in unpack_proof(proof):
        digest = sha256((left + digest + right).hex().encode()).digest()
    return digest


def proof_digest(proof: bytes) -> str:
    return sha256(b"".join(a + b for a, b in unpack_proof(proof)).hex().encode()).hexdigest()


class _Block:
    """The logged nodes of a builder's block, by position."""

    def __init__(self, right: pd.DataFrame, base: int):
        head = right[right["upper"].notna()].iloc[0]
        self.n, self.base, self.upper, self.subroot = int(head["n"]), base, head["upper"], head["subroot"]
        rows = right[right["nodes"].notna()]
        at = [int(p) + k for p, x in zip(rows["position"], rows["nodes"], strict=True) for k in range(len(x) // SIZE)]
        nodes = b"".join(rows["nodes"])
        self.nodes = {p: nodes[k * SIZE:(k + 1) * SIZE] for k, p in enumerate(at)}
        self.top, self.runs = min(base + STEP, height(self.n)), {}

    def node(self, level: int, index: int) -> bytes:
        return self.nodes[position(self.n, level, index)]

    def run(self, level: int, number: int) -> list[bytes]:
        """The nodes of a run of siblings, kept for its members."""
        if (level, number) not in self.runs:
            stop = min((number + 1) * WIDTH, width_at(self.n, level))
            self.runs[level, number] = [self.node(level, i) for i in range(number * WIDTH, stop)]
        return self.runs[level, number]

    def proof(self, index: int) -> bytes:
        """Proof of the node at the block's bottom, up to the root of all."""
        out = []
        for level in range(self.base, self.top):
            run, k = self.run(level, index // WIDTH), index % WIDTH
            out.append((run[:k], run[k + 1:]))
            index //= WIDTH
        return pack_proof(out) + self.upper


def _hand_down(base: int):
    """Proofs of the nodes at the bottom of a block: those that blocks below need."""

    def run(members: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(members):
            return pd.DataFrame({"tree": [], "n": [], "block": [], "upper": [], "subroot": []})
        b = _Block(right, base)
        return pd.DataFrame({"tree": members["tree"], "n": members["n"], "block": members["index"],
                             "upper": [b.proof(int(i)) for i in members["index"]], "subroot": b.subroot})

    return run


_UPPER = "tree long, n long, block long, upper binary, subroot binary"
_LEAF = "key string, leaf binary, subroot binary, proof binary, seen binary"


def _leaf_proofs(members: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    if not len(members):
        return pd.DataFrame({"key": [], "leaf": [], "subroot": [], "proof": [], "seen": []})
    b = _Block(right, 0)
    index = members["index"].tolist()
    return pd.DataFrame({"key": members["key"], "leaf": [b.node(0, i) for i in index], "subroot": b.subroot,
                         "proof": [b.proof(i) for i in index], "seen": members["seen"]})


def _leaf_audits(members: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    out = _leaf_proofs(members, right)
    now = [x if s is None else s for x, s in zip(out["leaf"], out["seen"], strict=True)]
    return pd.DataFrame({"key": out["key"], "leaf": out["leaf"], "subroot": out["subroot"],
                         "proof_sha256": [proof_digest(p) for p in out["proof"]],
                         "folded_root": [fold(x, p) for x, p in zip(now, out["proof"], strict=True)]})


def _for_leaves(leaves: DataFrame, log: DataFrame, roots: DataFrame, largest: int, make, schema: str) -> DataFrame:
    """``make(members, nodes of the block)`` over the leaf blocks; ``roots``
    (tree, n, upper, subroot) gives the proofs of the trees' roots."""
    tops = roots.withColumn("block", F.lit(0).cast("long"))
    under = lambda base: (F.col("n") > WIDTH ** base) if base else F.lit(True)
    base = max(0, (height(largest) - 1) // STEP * STEP)
    handed = None
    while True:
        # Trees whose top block lies in this round get their root's proof, the others what was handed down.
        upper = tops.filter(under(base) & (F.col("n") <= WIDTH ** (base + STEP)))
        upper = upper.select("tree", "n", "block", "upper", "subroot")
        if handed is not None:
            upper = upper.unionByName(handed)
        blank = [F.lit(None).cast("long").alias("position"), F.lit(None).cast("binary").alias("nodes")]
        inside = log.filter(F.col("base") == base).select("tree", "n", "block", "position", "nodes")
        if base:
            lower = log.filter((F.col("base") == base - STEP) & (F.col("level") == base) & under(base))
            block = F.floor(F.col("index") / WIDTH ** STEP).alias("block")
            inside = inside.unionByName(lower.select(
                "tree", "n", block, (F.col("position") + F.octet_length("nodes") / SIZE - 1).cast("long").alias("position"),
                F.substring("nodes", -SIZE, SIZE).alias("nodes")))
            members = lower.select("tree", "n", block, "index")
        else:
            members = leaves.withColumn("block", F.floor(F.col("index") / WIDTH ** STEP))
        right = inside.withColumns({"upper": F.lit(None).cast("binary"), "subroot": F.lit(None).cast("binary")}).unionByName(
            upper.select("*", *blank))
        pairs = members.groupBy("tree", "block").cogroup(right.groupBy("tree", "block"))
        if not base:
            return pairs.applyInPandas(make, schema)
        handed = materialise(pairs.applyInPandas(_hand_down(base), _UPPER), "merkle-proofs")
        base -= STEP


class Manifest:
    """Log, leaf index and tree list under a folder (all Parquet): ``leaves``
    (tree, n, index, key, seen), ``trees`` (tree, n, group), ``log``, ``top``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.leaves = spark.read.parquet(f"{path}/leaves")
        self.trees = spark.read.parquet(f"{path}/trees")
        self.largest, self.n_trees = self.trees.agg(F.max("n"), F.count(F.lit(1))).first()
        self.largest = self.largest or 0
        self.log, self.top = self._log("log", self.largest), self._log("top", self.n_trees)

    def _log(self, name: str, largest: int) -> DataFrame:
        rounds = range(0, max(1, height(largest)), STEP)
        return self.spark.read.schema(LOG).parquet(*[f"{self.path}/{name}/base{b}" for b in rounds])

    def root(self) -> bytes | None:
        """The digest of the whole table: the last node of the top log."""
        last = self.top.orderBy(F.desc("position")).select(F.substring("nodes", -SIZE, SIZE)).first()
        return bytes(last[0]) if last else None

    def _roots(self) -> DataFrame:
        """(tree, n, upper, subroot) of every tree, from the top log."""
        none = F.lit(b"").alias("upper")
        top = self.trees.select(F.lit(0).cast("long").alias("tree"), F.lit(self.n_trees).cast("long").alias("n"),
                                F.col("tree").alias("index"), F.col("tree").cast("string").alias("key"),
                                F.lit(None).cast("binary").alias("seen"))
        one = self.spark.range(1).select(F.col("id").alias("tree"), F.lit(self.n_trees).cast("long").alias("n"), none,
                                         F.lit(b"").alias("subroot"))
        made = _for_leaves(top, self.top, one, self.n_trees, _leaf_proofs, _LEAF)
        return materialise(made.select(F.col("key").cast("long").alias("tree"), F.col("proof").alias("upper"),
                                       F.col("leaf").alias("subroot")).join(self.trees.select("tree", "n"), "tree"),
                           "merkle-roots").select("tree", "n", "upper", "subroot")

    def proofs(self) -> DataFrame:
        """key, leaf, subroot, proof (see ``unpack_proof``) and seen of every leaf."""
        return _for_leaves(self.leaves, self.log, self._roots(), self.largest, _leaf_proofs, _LEAF)

    def audit(self) -> DataFrame:
        """key, leaf, subroot, root, proof_sha256, folded_root, verified (hex) of
        every leaf; folded from ``seen`` where the row was seen changed."""
        root = self.root()
        made = _for_leaves(self.leaves, self.log, self._roots(), self.largest, _leaf_audits,
                           "key string, leaf binary, subroot binary, proof_sha256 string, folded_root binary")
        hexed = {c: F.lower(F.hex(c)) for c in ("leaf", "subroot", "folded_root")}
        return (made.withColumns(hexed).withColumn("root", F.lit(root.hex() if root else None).cast("string"))
                .withColumn("verified", F.col("folded_root") == F.col("root")))


def write_manifest(docs: DataFrame, path: str, group: str = "lang", key: str = "doc_id",
                   fields: tuple[str, ...] = FIELDS, seen: dict[str, Column] | None = None,
                   where: Column | None = None) -> Manifest:
    """Write the manifest of ``docs``. For an audit, ``seen`` gives other values
    of some fields as a later reader sees them, in the rows where ``where`` holds;
    their digests are kept beside the leaves and do not enter the trees."""
    now = [F.col(c) for c in fields]
    later = leaf_digest([(seen or {}).get(c, F.col(c)) for c in fields])
    rows = docs.select(F.col(group).alias("group"), F.col(key).alias("key"), leaf_digest(now).alias("digest"),
                       (F.when(where, later) if seen else F.lit(None).cast("binary")).alias("seen"))
    leaves, groups = indexed(rows, "group", ["key", "digest"], "merkle-leaves")
    numbered, _ = indexed(groups.withColumn("one", F.lit(0)), "one", ["group"], "merkle-groups")
    trees = materialise(numbered.select(F.col("at").alias("tree"), "n", "group"), "merkle-trees")
    (leaves.join(trees.withColumnRenamed("group", "_group"), F.col("group").eqNullSafe(F.col("_group")))
     .select("tree", "n", F.col("at").alias("index"), F.col("key").cast("string").alias("key"), "digest", "seen")
     .write.parquet(f"{path}/leaves"))
    trees.write.parquet(f"{path}/trees")
    spark = docs.sparkSession
    largest, n_trees = trees.agg(F.max("n"), F.count(F.lit(1))).first()
    log = append_log(spark.read.parquet(f"{path}/leaves").select("tree", "n", "index", "digest"), f"{path}/log",
                     largest or 0)
    # A tree's root is the last node of its log.
    last = log.groupBy("tree").agg(F.max_by(F.substring("nodes", -SIZE, SIZE), "position").alias("digest"))
    append_log(last.select(F.lit(0).cast("long").alias("tree"), F.lit(n_trees).cast("long").alias("n"),
                           F.col("tree").alias("index"), "digest"), f"{path}/top", n_trees)
    return Manifest(spark, path)
