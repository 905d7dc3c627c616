"""Merkle manifest, toxicity and hard negatives against brute force and on held-out rows."""

import zlib
from hashlib import sha256

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strata.llm import hard_negatives, merkle, queries, toxicity
from strata.llm.common import work_path
from tests.conftest import SF001

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree int, key string"


def digest(parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return digest("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5])


def lowered(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def merkle_by_hand(rows):
    """The contract, row by row: (doc_id, leaf, subroot, root, proof, folded root, verified)."""

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([digest(out[-1][i:i + 8]) for i in range(0, len(out[-1]), 8)])
        return out

    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    placed = {g: sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for g in order}
    trees = {g: levels([leaf(r) for r in placed[g]]) for g in order}
    top = levels([trees[g][-1][0] for g in order])
    out = []
    for t, g in enumerate(order):
        for i, r in enumerate(placed[g]):
            now = leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                now = leaf((*r[:4], lowered(r[4])))
            siblings = []
            for tree, k in ((trees[g], i), (top, t)):
                for nodes in tree[:-1]:
                    run = nodes[k // 8 * 8:k // 8 * 8 + 8]
                    a, b = run[:k % 8], run[k % 8 + 1:]
                    siblings += a + b
                    now, k = digest(a + [now] + b), k // 8
            out.append((r[0], leaf(r), trees[g][-1][0], top[-1][0], digest(siblings), now, now == top[-1][0]))
    return sorted(out, key=repr)


def manifest(spark, rows, parts=5):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return merkle.write_manifest(docs, work_path(spark, "manifest-test"), seen={"text": low},
                                 where=F.crc32(F.col("doc_id").cast("string")) % 3 == 0)


def audited(m):
    columns = ("leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted(((None if r.key is None else int(r.key), *(r[c] for c in columns)) for r in m.audit().collect()), key=repr)


def merkle_rows(n, langs, start=0):
    return [(start + i, None if i % 5 == 0 else "s", langs[i % len(langs)], i, None if i % 11 == 0 else "Text É %d" % i, 1, "x")
            for i in range(n)]


def test_merkle_nulls_ties_repeats_and_long_texts(spark):
    rows = merkle_rows(700, ["en", "en", "en", "de", None, "fr", "en", "é"])
    rows += [(None, None, None, None, None, 1, "x")] * 3 + [(7, "s", "en", 1, "", 1, "x"), (7, "s", "en", 1, "A" * 2_000_000, 1, "x")]
    rows += [rows[3]] * 20 + [(5000, "s", "lone", 1, "t", 1, "x")]
    m = manifest(spark, rows)
    assert audited(m) == merkle_by_hand(rows)
    proofs = m.proofs().collect()
    assert len(proofs) == len(rows)
    assert all(merkle.fold(bytes(r.leaf), bytes(r.proof)) == m.root() for r in proofs)


@pytest.mark.parametrize("sizes", [(1,), (8, 1), (9,), (513,), (4097, 2)])
def test_merkle_sizes_around_powers(spark, sizes):
    rows = [r for k, n in enumerate(sizes) for r in merkle_rows(n, ["l%d" % k], 10_000 * k)]
    assert audited(manifest(spark, rows)) == merkle_by_hand(rows)


def test_merkle_many_groups_and_empty_table(spark):
    rows = merkle_rows(1400, ["g%d" % k for k in range(600)])
    assert audited(manifest(spark, rows)) == merkle_by_hand(rows)
    m = manifest(spark, [])
    assert m.root() is None and m.audit().count() == 0 and m.proofs().count() == 0


@pytest.mark.parametrize("n", [1, 2, 8, 9, 63, 64, 65, 513, 600])
def test_postorder_positions(n):
    """The closed form against a tree that is walked."""
    seen = []

    def walk(level, index):
        if level:
            for child in range(index * 8, min(index * 8 + 8, merkle.width_at(n, level - 1))):
                walk(level - 1, child)
        seen.append((level, index))

    walk(merkle.height(n), 0)
    assert [merkle.position(n, *x) for x in seen] == list(range(len(seen)))


def test_merkle_log_is_gapless(spark):
    m = manifest(spark, merkle_rows(5000, ["en"]))
    at = sorted((r.position, len(r.nodes) // merkle.SIZE) for r in m.log.collect())
    assert at[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(at, at[1:], strict=False))
    assert sum(n for _, n in at) == sum(merkle.width_at(5000, k) for k in range(merkle.height(5000) + 1))


def negatives_by_hand(rows, anchors):
    ok = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or len(v) != 6 or any(x is None or not np.isfinite(x) for x in v):
            continue
        ok[i] = min(ok.get(i, (label, v)), (label, v))
    dot = lambda a, b: sum(int(x) * int(y) for x, y in zip(a, b, strict=True))
    out = []
    for a in sorted(ok):
        if not anchors(a):
            continue
        scored = sorted((-dot(ok[a][1], ok[i][1]), i) for i in ok if i != a)
        for ps, p in [x for x in scored if ok[x[1]][0] == ok[a][0]][:5]:
            fit = [x for x in scored if ok[x[1]][0] != ok[a][0] and 50 * -ps <= 100 * -x[0] <= 95 * -ps][:3]
            out += [(a, p, k + 1, i, -ps, -s) for k, (s, i) in enumerate(fit)]
    return sorted(out)


NEGATIVES = "vec_id long, embedding array<double>, label int, leaf int, v string"


@pytest.mark.parametrize("leaf_rows", [20, 5000])
def test_hard_negatives(spark, monkeypatch, leaf_rows):
    r = np.random.default_rng(5)
    centres = r.integers(-60, 60, (6, 6))
    rows = [(i, [float(x) for x in centres[i % 6] + r.integers(-25, 25, 6)], int(r.integers(0, 4))) for i in range(900)]
    rows += [(900 + i, rows[10][1], i % 3) for i in range(60)]  # copies: ties
    rows += [(2000, None, 1), (2010, [1.0] * 6, None), (None, [1.0] * 6, 1), (2020, [None] + [1.0] * 5, 1),
             (2030, [float("nan")] * 6, 1), (2040, [1.0] * 3, 1), (2050, [0.0] * 6, 1), (2060, [-5.0] * 6, 77),
             (0, rows[0][1], 3), (0, [9.0] * 6, 3)]
    monkeypatch.setattr(hard_negatives, "LEAF_ROWS", leaf_rows)
    monkeypatch.setattr(hard_negatives, "BLOCK_BYTES", 800)
    df = spark.createDataFrame([(*x, 1, "x") for x in rows], NEGATIVES).repartition(4)
    got = hard_negatives.mine(df, F.col("vec_id") % 10 == 0).collect()
    assert sorted(map(tuple, got)) == negatives_by_hand(rows, lambda i: i % 10 == 0)


def test_hard_negatives_far_values_and_empty_table(spark):
    big = 2.0 ** 27
    rows = [(i, [big + i, -big, 1.0 * i, 3.0, 0.0, 5.0], i % 2) for i in range(40)]
    got = hard_negatives.mine(spark.createDataFrame([(*x, 1, "x") for x in rows], NEGATIVES), F.col("vec_id") % 10 == 0,
                              low=0, high=100).collect()
    want = []
    dot = lambda a, b: sum(int(x) * int(y) for x, y in zip(rows[a][1], rows[b][1], strict=True))
    for a in range(0, 40, 10):
        scored = sorted((-dot(a, i), i) for i in range(40) if i != a)
        for ps, p in [x for x in scored if (x[1] - a) % 2 == 0][:5]:
            fit = [x for x in scored if (x[1] - a) % 2 and x[0] >= ps][:3]
            want += [(a, p, k + 1, i, -ps, -s) for k, (s, i) in enumerate(fit)]
    assert sorted(map(tuple, got)) == sorted(want)
    assert hard_negatives.mine(spark.createDataFrame([], NEGATIVES), F.col("vec_id") % 10 == 0).count() == 0


def test_far_subtrees_are_left_out():
    """The ranges do eliminate: tight clusters far apart, a narrow annulus."""
    r = np.random.default_rng(1)
    x = (r.integers(-1000, 1000, (8, 5))[np.arange(800) % 8] + r.integers(-3, 3, (800, 5))).astype(float)
    tree = hard_negatives.Tree(x[:200], float((x * x).sum(1).max()), 2)
    leaf = tree.leaves_of(x)
    tree.take_ranges({k: tree.path_ranges(k, x[leaf == k]) for k in np.unique(leaf)})
    q = x[:10]
    square = ((q * q).sum(1) + tree.longest)[:, None]
    best = (q @ x.T).max(1)[:, None]
    outer = np.sqrt(square - 2 * best)
    need = tree.reached(q, np.zeros_like(outer), outer)
    assert need[np.arange(10), leaf[(q @ x.T).argmax(1)]].all() and need.mean() < 0.5


def test_hard_negatives_ships_blocks_and_packs_without_broadcast(spark, monkeypatch):
    """Neither packs of anchors nor blocks pass through the driver, however small they seem."""
    plans, write = {}, hard_negatives.materialise

    def noted(df, name):
        plans.setdefault(name, []).append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(hard_negatives, "materialise", noted)
    r = np.random.default_rng(2)
    rows = [(i, [float(x) for x in r.integers(-40, 40, 6)], i % 3, 1, "x") for i in range(300)]
    hard_negatives.mine(spark.createDataFrame(rows, NEGATIVES), F.col("vec_id") % 10 == 0).collect()
    assert len(plans["gnat-home"]) == len(plans["gnat-away"]) == 2
    assert not [name for name, found in plans.items() if "Broadcast" in "".join(found)]


def test_hard_negatives_anchors_are_shipped_once_to_a_slab(monkeypatch):
    """Copies of an anchor do not grow with the number of blocks."""
    monkeypatch.setattr(hard_negatives, "BLOCK_BYTES", 100)
    monkeypatch.setattr(hard_negatives, "SLABS", 5)
    x = np.random.default_rng(3).integers(-50, 50, (600, 4)).astype(float)
    tree = hard_negatives.Tree(x, float((x * x).sum(1).max()), 2)
    leaf = tree.leaves_of(x)
    tree.take_ranges({k: tree.path_ranges(k, x[leaf == k]) for k in np.unique(leaf)})
    parts = {int(k): -(-int(n) * 24 // 100) for k, n in zip(*np.unique(leaf, return_counts=True), strict=True)}
    slabs = hard_negatives.Slabs(parts, len(tree.paths))
    at = [slabs.of(k, p) for k, n in sorted(parts.items()) for p in range(n)]
    assert at == sorted(at) and set(at) == set(range(5)) and max(np.bincount(at)) - min(np.bincount(at)) <= 1
    assert all(set(held) == {k for k, n in parts.items() if s in {slabs.of(k, p) for p in range(n)}}
               for s, held in enumerate(slabs.leaves()))
    far = {"low": -hard_negatives.FAR, "high": hard_negatives.FAR}
    anchors = pd.DataFrame({"anchor_id": range(60), "label": 0, "v": list(x[:60].astype(int)), "leaf": leaf[:60],
                            "windows": [[far]] * 60})
    sent = {home: pd.concat(hard_negatives._visits(tree, slabs, home)([anchors])) for home in (True, False)}
    copies = np.bincount(np.concatenate([np.frombuffer(b, np.int64) for b in sent[False]["ids"]]))
    assert len(at) > 100 and set(copies.tolist()) <= {4, 5}  # 4: its own leaf fills a slab
    need = {home: sorted((i, k) for r in f.to_dict("records") for i, bits in zip(
        np.frombuffer(r["ids"], np.int64).tolist(),
        np.unpackbits(np.frombuffer(r["leaves"], np.uint8).reshape(len(r["ids"]) // 8, -1), axis=1), strict=True)
        for k in np.flatnonzero(bits).tolist() if k in slabs.leaves()[r["slab"]]) for home, f in sent.items()}
    assert {i: k for i, k in need[True]} == dict(enumerate(leaf[:60].tolist()))
    assert set(need[False]) == {(i, k) for i in range(60) for k in parts if k != leaf[i]}


@pytest.mark.parametrize("number", [np.float32, np.float64, np.int64])
@pytest.mark.parametrize("spread", [30, 60_000])
@pytest.mark.parametrize("same", [True, False])
def test_hard_negatives_best_over_blocks(number, spread, same):
    """Ties, windows that many or few scores fit, and blocks of fewer rows than asked for."""
    r = np.random.default_rng(spread)
    ids, labels = np.arange(9) * 7, np.arange(9) % 2
    low = r.integers(-spread, spread, (9, 3))
    windows = np.stack([low, low + r.integers(-5, spread, (9, 3))], 2)
    windows[0], windows[1] = (-hard_negatives.FAR, hard_negatives.FAR), (hard_negatives.FAR, -hard_negatives.FAR)
    best, pairs = hard_negatives.Best(ids, windows, 3), {(i, w): [] for i in range(9) for w in range(3)}
    c_all = r.permutation(1500)
    for size in (2, 400, 3, 700, 395):
        c_ids, c_all = np.sort(c_all[:size]), c_all[size:]
        rows = np.flatnonzero(r.random(9) < 0.8)
        scores = r.integers(-spread, spread, (len(rows), size))
        best.see(rows, scores.astype(number), lambda i, j: labels[rows][i] == c_ids[j] % 2, same, c_ids)  # noqa: B023
        for a, i in enumerate(rows.tolist()):
            for b, c in enumerate(c_ids.tolist()):
                if (labels[i] == c % 2) == same and c != ids[i]:
                    for w in range(3):
                        if windows[i, w, 0] <= scores[a, b] <= windows[i, w, 1]:
                            pairs[i, w].append((-int(scores[a, b]), c))
    want = [(i, w, c, -s) for (i, w), found in sorted(pairs.items()) for s, c in sorted(found)[:3]]
    assert list(zip(*(x.tolist() for x in best.settle()), strict=True)) == want


def test_hard_negatives_sample_is_the_least_hashes(spark, monkeypatch):
    """What the tasks send for the tree follows from its size; the sample is the same."""
    df = spark.range(3000).select(F.col("id").alias("vec_id"), F.array("id", F.lit(1).cast("long")).alias("v")).repartition(8)
    want = [r.vec_id for r in df.orderBy(F.xxhash64("vec_id"), "vec_id").limit(64).collect()]
    taken = []
    monkeypatch.setattr(hard_negatives, "FIT_ROWS", 64)
    monkeypatch.setattr(hard_negatives, "Tree", lambda sample, longest, depth: taken.append(sample[:, 0].astype(int).tolist()))
    hard_negatives.fit(df, 3000)
    hard_negatives.fit(df.filter("vec_id < 50"), 50)
    hard_negatives.fit(df, 3_000_000)  # a count that is too high: the hash leaves too few
    assert taken[0] == taken[2] == want and sorted(taken[1]) == list(range(50))


DOCS = "doc_id long, text string, score string, y int"


def toxic_rows(n, seed=0):
    r = np.random.default_rng(seed)
    vocab = ["w%d" % i for i in range(400)]
    out = []
    for i in range(n):
        words = list(r.choice(vocab, r.integers(5, 120)))
        bad = i % 6 == 0
        if bad:
            words[::7] = ["foul%d" % r.integers(0, 9)] * len(words[::7])
        out.append((i, " ".join(words), "s", 1, int(bad)))
    return out


def test_toxicity_on_held_out_rows(spark):
    rows = toxic_rows(1500)
    docs = spark.createDataFrame([x[:4] for x in rows], DOCS).repartition(4)
    labels = spark.createDataFrame([(x[0], x[4]) for x in rows], "doc_id long, toxic int")
    runs = [toxicity.classify(docs, labels).select("doc_id", toxicity.held_out().alias("h"), "score", "predicted", "y")
            .orderBy("doc_id").collect() for _ in range(2)]
    assert runs[0] == runs[1]
    held = [x for x in runs[0] if x.h]
    assert all(x.h == (zlib.crc32(str(x.doc_id).encode()) % 3 == 1) and 0 <= x.score <= 1 and x.y == 1 for x in runs[0])
    assert np.mean([x.predicted == (x.doc_id % 6 == 0) for x in held]) > 0.98
    model = toxicity.train(docs, labels)
    assert 0 < len(model["at"]) < 2000


def test_toxicity_held_out_labels_do_not_matter(spark):
    rows = toxic_rows(300)
    docs = spark.createDataFrame([x[:4] for x in rows], DOCS)
    flip = [(x[0], 1 - x[4] if zlib.crc32(str(x[0]).encode()) % 3 == 1 else x[4]) for x in rows]
    models = [toxicity.train(docs, spark.createDataFrame(y, "doc_id long, toxic int"))
              for y in ([(x[0], x[4]) for x in rows], flip)]
    assert models[0]["base"] == models[1]["base"] and (models[0]["weight"] == models[1]["weight"]).all()


def test_toxicity_odd_rows(spark):
    texts = [None, "", " \n ", "word " * 400_000, "w1 foul1", "... !!!", "é" * 3]
    docs = spark.createDataFrame([(None if i == 4 else i % 3, t, "s", 1) for i, t in enumerate(texts)], DOCS)
    schema = "doc_id long, toxic int"
    one = toxicity.classify(docs, spark.createDataFrame([(0, 1), (0, 1), (2, None), (None, 0)], schema)).collect()
    assert len(one) == len(texts) and {x.score for x in one} == {1.0}
    assert {x.score for x in toxicity.classify(docs, spark.createDataFrame([], schema)).collect()} == {1.0}
    rows = toxic_rows(200)
    trained = toxicity.train(spark.createDataFrame([x[:4] for x in rows], DOCS),
                             spark.createDataFrame([(x[0], x[4]) for x in rows], schema))
    assert all(0 <= x.score <= 1 for x in toxicity.with_scores(docs, trained).collect())
    none = spark.createDataFrame([], DOCS)
    assert toxicity.classify(none, spark.createDataFrame([(0, 1)], schema)).count() == 0


def test_toxicity_query_accepts_the_test_tables(spark):
    got = queries.op12_toxicity(spark, SF001)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == 200
