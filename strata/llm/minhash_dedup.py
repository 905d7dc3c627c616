"""Operator 10: near-duplicate documents by one-permutation MinHash.

A document's set is its distinct word shingles (64-bit hashes). One permutation
splits the hash range into ``BANDS * ROWS`` bins; a bin's minimum is a signature
value, and empty bins copy a value by optimal densification (each empty bin
draws donor bins from its own pseudo-random sequence until it meets a full one).
Bands of ``ROWS`` values make buckets. Documents with equal sets are collapsed
first, so a bucket holds different sets only.

Pairs are bounded by stars: each bucket member is compared with the bucket's
smallest document only, on the full sets. Links between two members that are
not the centre could be lost that way, so the members of buckets that still hold
several components are gone through again. Two sets at or above the limit share
one of their rarest shingles: with all shingles in one order by how many of these
documents have them, the rarest ``n - ceil(limit * n) + 1`` of a set of n are
enough to find it (prefix filter). Shingles that stand in one document only drop
out there, so documents on a common template, whose own words are the rare ones,
do not meet at all. Documents that share such a shingle are candidates if their
components differ, their sizes allow the limit, and their sketches agree as far as
the limit asks for, less ``SIGMAS`` standard errors. Groups of up to ``SMALL``
documents are joined, and signatures are compared. In larger ones heads are, the
``HEAD`` smallest hashes of a set, in blocks of ``BLOCK``: they hold all of a shorter
document, so that almost no pair comes out that is not a link. In large groups every
document first offers its few best ones, twice, and components are joined; only
what is then still apart is compared in full. Candidates are made distinct before
any set is fetched for the exact comparison. No join emits the pairs of a large
group, and no row holds more than a block of heads (half a megabyte).

Defined results: null or empty texts have n_shingles 0 and are their own
component. Rows with a repeated doc_id are one document with several sets: each
set is compared, the sets of a document are linked with each other, and all its
rows share one component (each row reports its own n_shingles). Rows with a null
doc_id are linked with nothing: component null, kept true. Further columns of
the input do not matter.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from strata.llm.common import materialise, text_of
from strata.llm.components import connected_components

BANDS, ROWS = 36, 7
BINS = BANDS * ROWS
BLOCK, SMALL, SIGMAS, HEAD = 256, 32, 6, 512
BEST, GROUPS, FIRSTS = 4, 2, 8
_MIX = np.uint64(0x9E3779B97F4A7C15)
_DRAWS = np.random.default_rng(7).integers(0, BINS, (4096, BINS), dtype=np.int16)
_SEEDS = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)


class _Words(dict):
    """64-bit hash of a word, remembered within a task (bounded)."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        out = self[word] = xxh3_64_intdigest(word)
        return out


def _scramble(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_set(text: str, k: int, known: dict) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles of a whole text; a shorter
    word sequence is one shingle; no words, no shingles."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # ASCII only, both
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < k:
        return np.array([xxh3_64_intdigest(b" ".join(words), seed=1)], np.uint64)
    ids = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = len(ids) - k + 1
    h = ids[:n].copy()
    for i in range(1, k):
        h = h * _MIX + ids[i:i + n]
    return np.unique(_scramble(h))


def signature(hashes: np.ndarray) -> np.ndarray:
    """One-permutation signature of a non-empty sorted set, densified."""
    bins = (((hashes >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(bins, prepend=-1))
    full = np.zeros(BINS, bool)
    full[bins[first]] = True
    out = np.zeros(BINS, np.uint64)
    out[bins[first]] = hashes[first]
    empty = np.flatnonzero(~full)
    start = 0
    for stop in (8, 64, 512, len(_DRAWS)):
        if not len(empty):
            break
        drawn = _DRAWS[start:stop, empty]
        hit = full[drawn]
        found = hit.any(0)
        donor = drawn[hit.argmax(0), np.arange(len(empty))]
        out[empty[found]] = out[donor[found]]
        empty, start = empty[~found], stop
    out[empty] = hashes[0]
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    acc = _SEEDS.copy()
    for column in sig.reshape(BANDS, ROWS).T:
        acc = _scramble(acc ^ column) + _MIX
    return acc.view(np.int64)


def _sketches(k: int):
    @F.pandas_udf("n_shingles long, digest binary, bands array<long>")
    def sketch(texts: pd.Series) -> pd.DataFrame:
        known, out = _Words(), []
        for text in texts:
            s = shingle_set(text, k, known)
            out.append((len(s), xxh3_128_digest(s.tobytes()), band_keys(signature(s))) if len(s) else (0, None, None))
        return pd.DataFrame(out, columns=["n_shingles", "digest", "bands"])

    return sketch


def _sets(k: int):
    @F.pandas_udf("digest binary, shingles array<long>, marks binary")
    def sets(texts: pd.Series) -> pd.DataFrame:
        known = _Words()
        made = [shingle_set(t, k, known) for t in texts]
        return pd.DataFrame({"digest": [xxh3_128_digest(s.tobytes()) for s in made],
                             "shingles": [s.view(np.int64) for s in made],
                             "marks": [signature(s).astype(np.uint8).tobytes() if len(s) else None for s in made]})

    return sets


def _overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (u, v) with ``inter`` and ``whole``: sizes of intersection and
    union of the full sets. The set travels with the pair only where needed. Sets
    of similar documents take far less room in a file than in memory, so their file
    size does not prove that they may be broadcast: they are always sorted."""
    sets = sets.hint("merge")
    a = sets.select(F.col("node").alias("v"), F.col("shingles").alias("sv"))
    b = sets.select(F.col("node").alias("u"), F.col("shingles").alias("su"))
    inter = F.size(F.array_intersect("su", "sv"))
    return (pairs.join(a, "v").join(b, "u").withColumn("inter", inter)
            .select("u", "v", "inter", (F.size("su") + F.size("sv") - F.col("inter")).alias("whole")))


def agreement(size_a, marks_a, size_b, marks_b, percent: int) -> np.ndarray:
    """Share of equal places in the signatures of pairs (row by row), -1 where sizes
    or signatures rule a link out. Marks are the lowest bytes of the signature
    values (chance agreement only adds pairs)."""
    small, large = np.minimum(size_a, size_b), np.maximum(size_a, size_b)
    share = percent / 100
    error = np.sqrt(share * (1 - share) / np.minimum(large, BINS))
    agree = np.count_nonzero(marks_a == marks_b, axis=-1) / BINS
    return np.where((100 * small >= percent * large) & (agree >= share - SIGMAS * error), agree, -1)


def _marks(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(len(column), BINS)


def _possible(percent: int):
    @F.pandas_udf("boolean")
    def possible(n: pd.Series, marks: pd.Series, n2: pd.Series, marks2: pd.Series) -> pd.Series:
        return pd.Series(agreement(n.to_numpy(), _marks(marks), n2.to_numpy(), _marks(marks2), percent) >= 0)

    return possible


def _heads():
    """The smallest hashes of a set, their upper halves: all of a set of up to ``HEAD``."""
    @F.pandas_udf("binary")
    def head(smallest: pd.Series) -> pd.Series:
        return pd.Series([np.unique(x.view(np.uint64) >> np.uint64(32)).astype(np.uint32).tobytes() for x in smallest])

    return head


def _shared(a: list[np.ndarray], b: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """How many values each sorted array of ``a`` has in common with each of ``b``."""
    values, place = np.unique(np.concatenate(a + b), return_inverse=True)
    row = np.repeat(np.arange(len(a) + len(b)), [len(x) for x in a + b])
    left = row < len(a)
    both = np.zeros((2, len(values)), bool)
    both[0, place[left]] = both[1, place[~left]] = True
    both = both.all(0)
    keep = both[place]
    row, column = row[keep], (np.cumsum(both) - 1)[place[keep]]
    out = np.zeros((len(a), len(b)), np.float32)
    for start in range(0, int(both.sum()), width):
        at = (column >= start) & (column < start + width)
        held = np.zeros((len(a) + len(b), width), np.float32)
        held[row[at], column[at] - start] = 1
        out += held[:len(a)] @ held[len(a):].T
    return out


def likeness(a: list[np.ndarray], size_a: np.ndarray, b: list[np.ndarray], size_b: np.ndarray,
             percent: int) -> np.ndarray:
    """Similarity of each head of ``a`` with each of ``b``, -1 where sizes or heads rule
    a link out. Up to the smaller last value of two heads both sets are known: a
    sample without replacement of their union, the whole of it for small sets, where
    the limit decides alone. Elements of a set with equal halves, which its head holds
    as one, are allowed for."""
    share, most = percent / 100, np.uint32(2**32 - 1)
    top_a = np.array([x[-1] if n > HEAD else most for x, n in zip(a, size_a)], np.uint32)
    top_b = np.array([x[-1] if n > HEAD else most for x, n in zip(b, size_b)], np.uint32)
    known_a = np.array([np.searchsorted(x, top_b, side="right") for x in a])
    known_b = np.array([np.searchsorted(x, top_a, side="right") for x in b]).T
    shared = _shared(a, b)
    seen = known_a + known_b - shared
    union = (size_a[:, None] + size_b) / (1 + share)  # the union at the limit
    error = np.sqrt(share * (1 - share) / seen * np.clip(1 - seen / union, 0, 1))
    alike = shared / seen
    lost_a, lost_b = (np.minimum(n, HEAD) - [len(x) for x in h] for h, n in ((a, size_a), (b, size_b)))
    slack = np.minimum(lost_a[:, None], lost_b) / seen + 1e-9
    small, large = np.minimum(size_a[:, None], size_b), np.maximum(size_a[:, None], size_b)
    return np.where((100 * small >= percent * large) & (alike >= share - SIGMAS * error - slack), alike, -1)


_PACKED = "s long, block int, nodes binary, components binary, sizes binary, firsts binary, lengths binary, heads binary"


def _pack(pdf: pd.DataFrame) -> pd.DataFrame:
    """One block of a large group in a row: heads, no sets."""
    pdf = pdf.sort_values("u")
    numbers = [pdf[c].to_numpy(np.int64).tobytes() for c in ("u", "component", "n")]
    firsts = np.zeros((len(pdf), FIRSTS), np.int64)
    for i, x in enumerate(pdf["firsts"]):
        firsts[i, :len(x)] = x
        firsts[i, len(x):] = x[0]  # repeated, no further group
    lengths = np.array([len(x) // 4 for x in pdf["head"]], np.int64)
    return pd.DataFrame([(*pdf[["s", "block"]].iloc[0], *numbers, firsts.tobytes(), lengths.tobytes(),
                          b"".join(pdf["head"]))], columns=[c.split()[0] for c in _PACKED.split(", ")])


def _unpack(row: dict, side: str):
    nodes, components, sizes, firsts, lengths = (
        np.frombuffer(row[c + side], np.int64) for c in ("nodes", "components", "sizes", "firsts", "lengths"))
    heads = np.split(np.frombuffer(row["heads" + side], np.uint32), np.cumsum(lengths)[:-1])
    return nodes, components, sizes, firsts.reshape(-1, FIRSTS), heads


def _apart(a, b, s: int, same: bool) -> np.ndarray:
    """Which members of two blocks of group ``s`` are to be compared: of different
    components, and without an earlier group in common, where they have met."""
    todo = a[1][:, None] != b[1]
    if same:
        todo &= np.arange(len(a[0]))[:, None] < np.arange(len(b[0]))
    here = a[3] == s
    before = np.where(here.any(1), here.argmax(1), FIRSTS)
    for p in range(int(before.max())):
        own = np.flatnonzero(before > p)
        for q in range(FIRSTS):
            todo[own] &= a[3][own, p, None] != b[3][:, q]
    return todo


def _tile_pairs(percent: int, best: int | None):
    def run(batches):
        for pdf in batches:
            for row in pdf.to_dict("records"):
                a, b = _unpack(row, ""), _unpack(row, "2")
                todo = _apart(a, b, row["s"], row["block"] == row["block2"])
                left, right = np.flatnonzero(todo.any(1)), np.flatnonzero(todo.any(0))
                if not len(left):
                    continue
                alike = likeness([a[4][i] for i in left], a[2][left], [b[4][i] for i in right], b[2][right], percent)
                alike = np.where(todo[np.ix_(left, right)], alike, -1)
                if best is not None and best < len(right):  # each member's best ones only
                    order = np.argsort(-alike, axis=1, kind="stable")
                    np.put_along_axis(alike, order[:, best:], -1, axis=1)
                i, j = np.nonzero(alike >= 0)
                if len(i):
                    u, v = a[0][left[i]], b[0][right[j]]
                    yield pd.DataFrame({"u": np.minimum(u, v), "v": np.maximum(u, v)})

    return run


def rare_shingles(members: DataFrame, percent: int) -> DataFrame:
    """(u, s, df): the shingles in which a set must meet another one that reaches
    the limit, ``df`` being the number of ``members`` (u, n, shingles) with it."""
    # Exploded sets are far larger than their files say: never broadcast.
    each = members.select("u", "n", F.explode("shingles").alias("s")).hint("merge")
    df = each.groupBy("s").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    # A shingle of one member only comes first in the order and meets nobody: counted, not kept.
    shared = each.join(df, "s")
    place = F.row_number().over(Window.partitionBy("u").orderBy("df", "s"))
    held = shared.groupBy("u").agg(F.count(F.lit(1)).alias("held"))
    alone = F.col("n") - F.col("held")
    needed = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    return (shared.withColumn("place", place).hint("merge").join(held, "u").filter(F.col("place") + alone <= needed)
            .select("u", "s", "df"))


def small_group_links(members: DataFrame, rare: DataFrame, percent: int) -> DataFrame:
    """(u, v): pairs of ``members`` (u, component, n, marks) in different components
    that share a rare shingle of ``SMALL`` members at most and that sizes and
    signatures leave possible, each once."""
    who = members.select("u", "component", F.col("n").cast("long").alias("n"))
    small = rare.filter(F.col("df") <= SMALL).select("u", "s").join(who, "u")
    other = small.select("s", *[F.col(c).alias(f"{c}2") for c in ("u", "component", "n")])
    met = (small.join(other, "s").filter("u < u2 and component <> component2")
           .filter(f"100 * least(n, n2) >= {percent} * greatest(n, n2)").select("u", "n", "u2", "n2").distinct())
    marks = members.select("u", "marks")
    return (met.join(marks, "u").join(marks.select(F.col("u").alias("u2"), F.col("marks").alias("marks2")), "u2")
            .filter(_possible(percent)("n", "marks", "n2", "marks2")).select("u", F.col("u2").alias("v")))


def large_group_links(members: DataFrame, rare: DataFrame, percent: int, best: int | None) -> DataFrame:
    """The same for larger groups, ``members`` being (u, component, n, head). With
    ``best`` a member meets the others in its ``GROUPS`` rarest groups only, and only
    its best ones per block come out."""
    large = rare.filter(F.col("df") > SMALL).join(
        members.select("u", "component", F.col("n").cast("long").alias("n"), "head"), "u")
    if best is not None:
        place = F.row_number().over(Window.partitionBy("u").orderBy("df", "s"))
        large = large.withColumn("place", place).filter(F.col("place") <= GROUPS).drop("place")
    # The first groups of each member, in the order that all members share.
    firsts = large.groupBy("u").agg(F.slice(F.sort_array(F.collect_list(F.struct("df", "s"))), 1, FIRSTS).alias("x"))
    large = large.join(firsts.select("u", F.col("x.s").alias("firsts")), "u")
    several = large.groupBy("s").agg(F.min("component").alias("a"), F.max("component").alias("z")).filter("a <> z")
    large = large.join(several.select("s"), "s", "left_semi").withColumn(
        "block", F.expr(f"cast(pmod(xxhash64(u), ceil(df / {BLOCK})) as int)"))
    packed = materialise(large.groupBy("s", "block").applyInPandas(_pack, _PACKED), "open-blocks")
    right = packed.select("s", *[F.col(c).alias(f"{c}2") for c in packed.columns if c != "s"])
    return (packed.join(right, "s").filter("block <= block2")
            .mapInPandas(_tile_pairs(percent, best), "u long, v long").distinct())


def join_open(open_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(u, component): ``open_`` (u, n, component, shingles, marks) with the
    components joined that links between them join.

    Small groups are gone through once. In large groups a member first offers its
    best agreements only, twice, which joins what belongs together with few pairs;
    then all pairs between components that are still apart are compared."""
    rare = materialise(rare_shingles(open_, percent), "rare-shingles")
    now = open_.select("u", "component")
    in_large = rare.filter(F.col("df") > SMALL).select("u").distinct()
    heads = materialise(open_.join(in_large, "u", "left_semi").select(
        "u", "n", _heads()(F.slice("shingles", 1, HEAD)).alias("head")), "heads")
    pairs = materialise(small_group_links(open_, rare, percent), "open-links")
    now = _joined(now, pairs, sets, percent)
    for best in (BEST, BEST, None):
        pairs = materialise(large_group_links(heads.join(now, "u"), rare, percent, best), "open-links")
        if not pairs.isEmpty():
            now = _joined(now, pairs, sets, percent)
    return now


def _joined(now: DataFrame, pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``now`` (u, component) after the links among ``pairs``, confirmed on the sets."""
    linked = _overlaps(pairs, sets).filter(f"100 * inter >= {percent} * whole")
    late = (linked.join(now, "u").join(now.select(F.col("u").alias("v"), F.col("component").alias("component2")), "v")
            .select(F.col("component").alias("u"), F.col("component2").alias("v")).distinct())
    joined = connected_components(late).select(F.col("node").alias("component"), F.col("component").alias("end"))
    return materialise(now.join(joined, "component", "left").select("u", F.coalesce("end", "component").alias("component")),
                       "open-components")


def near_duplicates(docs: DataFrame, k: int = 4, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``; links
    are pairs with 100 * intersection >= percent * union."""
    rows = materialise(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), _sketches(k)(text_of()).alias("s"))
        .select("doc_id", "s.*"), "sketches")
    repeated = _repeated(rows)
    members = rows.filter("doc_id is not null and n_shingles > 0").select("doc_id", "digest")
    # A set's node is its smallest doc_id; where that may have several sets, a number.
    by_set = materialise(members.groupBy("digest").agg(F.min("doc_id").alias("least")).withColumn(
        "node", F.monotonically_increasing_id() if repeated else F.col("least")), "sets")
    of_least = by_set.withColumnRenamed("least", "doc_id")

    # Buckets with more than one set: (bucket, u, c), c the smallest member.
    wide = (rows.join(of_least, ["doc_id", "digest"])
            .select("node", F.col("n_shingles").cast("int").alias("n"), "bands"))
    if repeated:
        wide = wide.dropDuplicates(["node"])
    banded = wide.select(F.col("node").alias("u"), "n", F.explode("bands").alias("bucket"))
    centres = (banded.groupBy("bucket").agg(F.min(F.struct("u", "n")).alias("c"), F.max("u").alias("z"))
               .filter("c.u < z").select("bucket", F.col("c.u").alias("c"), F.col("c.n").alias("nc")))
    buckets = materialise(banded.join(centres, "bucket"), "buckets")

    asked = buckets.select(F.col("u").alias("node")).distinct()
    if repeated:
        asked = asked.join(of_least, "node").select("doc_id").distinct()
    else:
        asked = asked.withColumnRenamed("node", "doc_id")
    sets = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
            .join(asked, "doc_id", "left_semi").select("doc_id", _sets(k)("text").alias("s"))
            .select("doc_id", "s.*"))
    if repeated:  # each node's own set, once
        sets = (sets.join(of_least, ["doc_id", "digest"])
                .groupBy("node").agg(F.min("shingles").alias("shingles"), F.min("marks").alias("marks")))
    else:
        sets = sets.withColumnRenamed("doc_id", "node")
    sets = materialise(sets.select("node", "shingles", "marks"), "shingles")
    stars = (buckets.filter("u <> c").filter(f"100 * least(n, nc) >= {percent} * greatest(n, nc)")
             .select("u", F.col("c").alias("v")).distinct())
    starred = _overlaps(stars, sets).filter(f"100 * inter >= {percent} * whole")
    first = connected_components(starred.select("u", "v"))

    # What the stars leave open: members of one bucket in different components.
    comp = first.select(F.col("node").alias("u"), "component")
    at = (buckets.join(comp, "u", "left").withColumn("component", F.coalesce("component", "u"))
          .select("bucket", "u", "n", "component"))
    several = (at.groupBy("bucket").agg(F.min("component").alias("a"), F.max("component").alias("z"))
               .filter("a <> z").select("bucket"))
    open_ = materialise(at.join(several, "bucket", "left_semi").select("u", "n", "component").distinct()
                        .join(sets.withColumnRenamed("node", "u").hint("merge"), "u"), "open")
    ends = join_open(open_, sets, percent)
    # (old component, new component) of the components that stood in an open bucket.
    second = materialise(open_.select("u", F.col("component").alias("node")).join(ends, "u").filter("node <> component")
                         .select("node", "component").distinct(), "joined")

    whole = (first.withColumnRenamed("component", "mid")
             .join(second.select(F.col("node").alias("mid"), F.col("component").alias("end")), "mid", "left")
             .select("node", F.coalesce("end", "mid").alias("component")))
    # Sets that no star linked may still have been linked by the second pass.
    alone = second.select("node", "component").join(first.select("node"), "node", "left_anti")
    final = by_set.join(whole.unionByName(alone), "node", "left").select(
        "digest", F.coalesce("component", "node").alias("component_id"))
    placed = members.join(final, "digest").select("doc_id", "component_id")
    if repeated:
        placed = _one_per_document(placed)
    return (rows.select("doc_id", "n_shingles").join(placed, "doc_id", "left")
            .withColumn("component_id", F.coalesce("component_id", "doc_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def _one_per_document(placed: DataFrame) -> DataFrame:
    """(doc_id, component_id) with the components that a document's sets lie in
    joined, named by their smallest doc_id."""
    placed = materialise(placed.distinct(), "placed")
    least = placed.groupBy("doc_id").agg(F.min("component_id").alias("v"))
    links = (placed.join(least, "doc_id").filter("component_id <> v")
             .select(F.col("component_id").alias("u"), "v").distinct())
    joined = connected_components(links).select(F.col("node").alias("v"), "component")
    of_doc = materialise(least.join(joined, "v", "left").select("doc_id", F.coalesce("component", "v").alias("c")),
                         "documents")
    return of_doc.join(of_doc.groupBy("c").agg(F.min("doc_id").alias("component_id")), "c").select(
        "doc_id", "component_id")


def _repeated(rows: DataFrame) -> bool:
    """Whether any doc_id has several rows; only then must rows be told apart by
    their sets."""
    n, ids = rows.filter("doc_id is not null").agg(F.count("doc_id"), F.countDistinct("doc_id")).first()
    return n != ids


def keep_one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The documents that stay, with the input's columns; of rows equal in doc_id
    and text one stays."""
    stay = materialise(near_duplicates(docs, k, percent).filter("kept and doc_id is not null")
                       .groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")), "stay")
    # The row is packed, so that no column of the input can clash with those here.
    packed = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"))
    out = packed.join(stay, "doc_id", "left").filter("rows is not null or doc_id is null")
    if not stay.filter("rows > 1").isEmpty():
        several = F.coalesce(F.col("rows") > 1, F.lit(False))
        once = (out.filter(several).withColumn("digest", F.unhex(F.sha2(text_of(F.col("row")["text"]), 256)))
                .dropDuplicates(["doc_id", "digest"]).drop("digest"))
        out = out.filter(~several).unionByName(once)
    return out.select("row.*")
