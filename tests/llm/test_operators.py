"""The training-data operators against brute force on small tables with nulls,
empty and long texts, ties, repeated rows and clashing column names."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import (ann, line_dedup, minhash_dedup, mixing, packing, quality_classifier, quality_rules, sharding,
                        simple8b, token_counts, token_files)
from strata.llm.common import work_path
from strata.llm.components import connected_components
from strata.llm.cuckoo import CuckooFilter, built
from strata.llm.tokenizers_ import load

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string, size long, shard int, score string, _row int"


def corpus(n=120, seed=3):
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(300)]
    shared = ["  The very same licence LINE number %d that stands in many documents " % k for k in range(4)]
    rows = []
    for d in range(n):
        lines = [" ".join(r.choices(vocab, k=r.randint(8, 30))) for _ in range(r.randint(1, 6))]
        lines += r.sample(shared, r.randint(0, 2))
        if d % 10 == 3 and rows:
            words = rows[-1][1].split(" ")  # a near copy of the document before
            words[len(words) // 2] = "changed"
            lines = " ".join(words).split("\n")
        if d % 11 == 5 and rows:
            lines = rows[0][1].split("\n")
        rows.append((d, "\n".join(lines), "s%d" % (d % 5) if d % 7 else None, 1, 2, "x", 3))
    rows += [(n, None, "s1", 0, 0, None, 0), (n + 1, "", "s1", 0, 0, None, 0), (n + 2, " \t\n\n ", None, 0, 0, None, 0),
             (n + 3, "one two", "s9", 0, 0, None, 0), (n + 4, "One  TWO", "s9", 0, 0, None, 0),
             (n + 5, "é" * 45 + "\nword " * 3000, "s2", 0, 0, None, 0), (n + 6, "a b c d e " * 40, "s2", 0, 0, None, 0)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})


def kept_lines(rows, min_docs=5):
    where = defaultdict(set)
    for d, t, *_ in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 40:
                where[key(x)].add(d)
    out = {}
    for d, t, *_ in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if len(where[key(x)]) < min_docs or max(where[key(x)]) == d]
        out[d] = (len(lines), len(lines) - len(stay), "\n".join(stay))
    return out


def test_line_dedup(docs):
    got = line_dedup.dedup_lines(docs).collect()
    want = kept_lines(corpus())
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in got} == want
    assert all(r.kept_sha256 == hashlib.sha256(r.text.encode()).hexdigest() for r in got)
    assert any(v[1] for v in want.values())


def test_columns_named_like_those_inside(spark):
    line = "a line of more than forty characters, for certain"
    names = ["_doc", "_drops", "_made", "row", "drops", "made", "_stay", "_rows", "rows", "digest", "n_lines"]
    docs = spark.createDataFrame([(i, line + "\nown %d" % i, *names) for i in range(6)] * 2,
                                 "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    got = line_dedup.dedup_lines(docs).collect()
    assert {(r.doc_id, r.n_dropped, r._doc, r._made, r.row, r.made) for r in got} == {
        (i, int(i < 5), "_doc", "_made", "row", "made") for i in range(6)}
    stay = minhash_dedup.keep_one_of_each(docs)
    assert stay.columns == docs.columns
    assert sorted((r.doc_id, *(r[n] for n in names)) for r in stay.collect()) == [(i, *names) for i in range(6)]


def test_near_dup_of_documents_on_a_template(spark):
    """Many documents that share most buckets and are not linked, a few that are."""
    r = random.Random(8)
    base = ["w%d" % r.randint(0, 5000) for _ in range(300)]
    rows = []
    for i in range(400):
        words = list(base)
        for p in r.sample(range(300), 22):
            words[p] = "e%d_%d" % (i, p)
        if i % 50 == 7:  # a near copy of the document before
            words = rows[-1][1].split(" ")
            words[5] = "other"
        rows.append((i, " ".join(words)))
    sets = {i: {tuple(t.split()[k:k + 4]) for k in range(len(t.split()) - 3)} for i, t in rows}
    want = {i: i for i in sets}
    for i in sets:
        for j in range(i):
            x = len(sets[i] & sets[j])
            if 100 * x >= 80 * (len(sets[i]) + len(sets[j]) - x):
                want[i] = min(want[i], want[j])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(docs, 4).collect()} == want
    assert len(set(want.values())) == 392


def test_heads_rule_out_no_link():
    """Heads of sets of up to HEAD hashes tell links exactly; larger ones rule no
    pair at the limit out."""
    rng = np.random.default_rng(5)
    sets = []
    for n in (1, 40, 150, 500, 3000):
        base = rng.integers(0, 2**64, n, dtype=np.uint64)
        for other in (0, 0, n // 20, n // 10, n // 8, n // 3, n):
            sets.append(np.unique(np.concatenate([base[other:], rng.integers(0, 2**64, other, dtype=np.uint64)])))
    heads = [np.unique(s[:minhash_dedup.HEAD] >> np.uint64(32)).astype(np.uint32) for s in sets]
    sizes = np.array([len(s) for s in sets])
    true = np.array([[len(np.intersect1d(x, y)) / len(np.union1d(x, y)) for y in sets] for x in sets])
    got = minhash_dedup.likeness(heads, sizes, heads, sizes, 80)
    assert (got[true >= 0.8] >= 0).all()
    small = sizes <= minhash_dedup.HEAD
    both = small[:, None] & small
    assert (got[both & (true < 0.8)] < 0).all()
    assert np.allclose(got[both & (got >= 0)], true[both & (got >= 0)])
    assert (got[true < 0.65] < 0).all()
    # Two elements of both sets with equal halves leave the heads one short.
    three, four = [np.arange(3, dtype=np.uint32)], [np.arange(4, dtype=np.uint32)]
    assert minhash_dedup.likeness(three, np.array([3]), four, np.array([4]), 80) < 0
    assert minhash_dedup.likeness(three, np.array([4]), four, np.array([5]), 80) >= 0


def test_members_meet_in_their_first_common_group():
    width = minhash_dedup.FIRSTS

    def block(ids, groups):
        firsts = np.array([g + [g[0]] * (width - len(g)) for g in groups], np.int64)
        return np.array(ids), np.array(ids), np.ones(len(ids), int), firsts, None

    a, b = block([1, 2], [[4, 7, 9], [7, 9]]), block([3, 4, 5], [[4, 9], [7, 9], [9]])
    at = {s: minhash_dedup._apart(a, b, s, False).tolist() for s in (4, 7, 9)}
    # In group 4 every pair of its blocks may meet; its blocks hold members of group 4 only.
    assert at[7] == [[False, True, True], [True, True, True]]
    assert at[9] == [[False, False, True], [True, False, True]]
    # A group beyond the first ones of a member: pairs that share one of those have met.
    assert minhash_dedup._apart(a, b, 11, False).tolist() == [[False, False, False], [False, False, False]]
    same = minhash_dedup._apart(a, a, 7, True)
    assert same.tolist() == [[False, True], [False, False]]


def test_line_dedup_is_reversible(spark, docs):
    first, rest = docs.filter("doc_id < 70"), docs.filter("doc_id >= 70")
    index = line_dedup.LineIndex(spark, 4).insert(first)
    before = sorted(map(tuple, index.counts.collect()))
    alone = {r.doc_id: r.text for r in index.apply(first).collect()}
    index.insert(rest)
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in index.apply(docs).collect()} == kept_lines(corpus())
    index.delete(rest)
    assert sorted(map(tuple, index.counts.collect())) == before
    assert {r.doc_id: r.text for r in index.apply(first).collect()} == alone


def test_line_dedup_empty_and_null_ids(spark, empty):
    assert line_dedup.dedup_lines(empty).count() == 0
    line = "a line of more than forty characters, for certain"
    same = spark.createDataFrame([(None, line)] * 6 + [(1, line)] * 6, "doc_id long, text string")
    assert {(r.doc_id, r.n_dropped) for r in line_dedup.dedup_lines(same).collect()} == {(None, 0), (1, 0)}


def test_line_dedup_ids_above_double_precision(spark):
    ids = [2**53 + 1 + 2 * i for i in range(40)] + [2**63 - 1, -2**63 + 1]
    rows = [(d, "a line of more than forty characters, for certain\nown line of %d" % d) for d in ids]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)).collect()
    assert {(r.doc_id, r.n_dropped) for r in got} == {(d, int(d != 2**63 - 1)) for d in ids}


def test_cuckoo_filter_insert_delete():
    keys = [hashlib.md5(b"%d" % i).digest() for i in range(5000)]
    f = built(keys)
    assert f.may_hold(keys).all()
    others = [hashlib.md5(b"x%d" % i).digest() for i in range(5000)]
    assert f.may_hold(others).mean() < 0.01
    f.delete(keys[:2500])
    assert f.may_hold(keys[2500:]).all() and f.may_hold(keys[:2500]).mean() < 0.01
    assert CuckooFilter.from_bytes(f.to_bytes()).may_hold(keys[2500:]).all()
    assert not CuckooFilter(np.zeros((4, 4), np.uint16)).insert(keys[:64])


def test_token_counts_and_cache(spark, docs, empty, monkeypatch):
    t = load("piece_bpe_32k.model").library
    path = work_path(spark, "cache-test")
    want = {d: len(t.encode(x or "")) for d, x, *_ in corpus()}
    for _ in range(2):
        got = token_counts.token_counts(docs, cache_path=path, limit=500).collect()
        assert {r.doc_id: r.n_tokens for r in got} == want
        assert all(r.over_limit == (r.n_tokens > 500) for r in got)
        cache = token_counts.read_cache(spark, path)
        assert cache.count() == cache.select("content").distinct().count() == len({x or "" for _, x, *_ in corpus()})
    assert token_counts.token_counts(empty).count() == 0
    bare = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, "c")], "doc_id long, text string")
    assert sorted((r.n_tokens for r in token_counts.token_counts(bare).collect())) == sorted(
        [len(t.encode("a b"))] * 2 + [len(t.encode("c"))])


def odd_texts(n=1500):
    r = random.Random(1)
    alphabet = "abcXYZ'' sd ÀéßÿİσΣς€́ｆ½²ªº▁ \x1c\x85\x0b\x00!<|>?.,-0129٣漢字\n\t\r   "
    out = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 30))) for _ in range(n)]
    return [x + "<|endoftext|>" + x[:3] if i % 9 == 0 else x for i, x in enumerate(out)]


def test_chunked_tokenizers_equal_the_library():
    texts = odd_texts()
    word, piece = load("word_bpe_49k.json"), load("piece_bpe_32k.model")
    want = [e.ids for e in word.library.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):
        assert [x.tolist() for x in word.encode(texts)] == want
        assert piece.count(texts) == [len(x) for x in piece.library.encode(texts, num_threads=1)]


def test_megabyte_texts_equal_the_library(monkeypatch):
    word = load("word_bpe_49k.json")
    texts = ["Some words, é 12 and <|x\t" * 60_000, "x" * 1_200_000 + " y", ("Über's alles. \n" * 90_000)]
    want = [e.ids for e in word.library.encode_batch(texts, add_special_tokens=False)]
    for piece in (1 << 20, 1000):
        monkeypatch.setattr(type(word), "PIECE", piece)
        assert [x.tolist() for x in word.encode(texts)] == want


def test_simple8b_round_trip():
    r = np.random.default_rng(2)
    for n in (0, 1, 7, 500, 5000):
        ids = np.where(r.random(n) < 0.02, r.integers(0, 1 << 62, n), r.integers(0, 1 << r.integers(1, 20), n)).astype(np.uint64)
        if n == 5000:
            ids[100:900] = 0
        cuts = [ids[:n // 3], ids[n // 3:]]
        block = simple8b.Block(simple8b.encode_block([5, None], cuts))
        assert block.doc_ids == [5, None] and block.counts.tolist() == [len(x) for x in cuts]
        assert (block.read() == ids).all()
        for a, z in ((0, 1), (n // 2, n // 2 + 30), (n - 1, n), (n // 4, n)):
            a = max(a, 0)
            assert (block.read(a, z) == ids[a:z]).all()


def test_token_files(spark, docs, empty):
    path = work_path(spark, "files-test")
    token_files.write_token_files(docs, path, block_ids=300)
    t, start = load("word_bpe_49k.json").library, 0
    got = {r.doc_id: r for r in token_files.read_digests(spark, path).collect()}
    tokens = {r.doc_id: r for r in token_files.read_tokens(spark, path).collect()}
    for d, text, *_ in sorted(corpus()):
        ids = t.encode(text or "", add_special_tokens=False).ids + [1]
        assert (got[d].start, got[d].n_tokens) == (start, len(ids)) and tokens[d].ids == ids
        assert got[d].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    none = work_path(spark, "files-test")
    token_files.write_token_files(empty, none)
    assert token_files.read_digests(spark, none).count() == 0


def test_nearest(spark):
    r = np.random.default_rng(4)
    x = r.normal(size=(300, 16)).astype(np.float32)
    x[10:20] = x[9]
    rows = [(i, [float(v) for v in x[i]], 1) for i in range(300)]
    bad = [(300, None, 1), (301, [0.0] * 16, 1), (302, [float("nan")] * 16, 1), (303, [1.0] * 3, 1),
           (304, [None] + [1.0] * 15, 1), (0, rows[0][1], 2)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, rank int")
    for size in (1000, 4_000_000):
        old, ann.BLOCK_BYTES = ann.BLOCK_BYTES, size
        fan, ann.FAN_IN = ann.FAN_IN, 4
        got = ann.nearest(df, F.col("vec_id") % 20 == 0, k=7).collect()
        ann.BLOCK_BYTES, ann.FAN_IN = old, fan
        by = defaultdict(list)
        for g in sorted(got, key=lambda g: (g.query_id, g["rank"])):
            by[g.query_id].append((g.vec_id, g.score))
        assert set(by) == set(range(0, 300, 20))
        d = x.astype(np.float64)
        for q, found in by.items():
            scores = ann.exact_scores(np.repeat(d[q:q + 1], 300, 0), d)
            want = sorted((-s, i) for i, s in enumerate(scores) if i != q)[:7]
            assert [(i, -s) for s, i in want] == found
    few = ann.nearest(df.filter("vec_id < 4"), F.col("vec_id") == 0).collect()
    assert [g["rank"] for g in sorted(few, key=lambda g: g["rank"])] == [1, 2, 3]
    assert ann.nearest(df.filter("vec_id > 299"), F.col("vec_id") == 0).count() == 0


def test_sharding(spark, docs, empty):
    a, b = (sharding.assign(docs, n).collect() for n in (8, 9))
    grown = {r.doc_id: r.shard for r in b}
    slots = defaultdict(list)
    for r in a:
        assert r.grown_shard == grown[r.doc_id] and r.grown_shard in (r.shard, 8)
        text = dict((d, t) for d, t, *_ in corpus())[r.doc_id] or ""
        assert (r["size"], r.text_crc32) == (len(text.encode()) + 16, zlib.crc32(text.encode()))
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    many = sharding.assign(spark.range(20000).selectExpr("id as doc_id", "'' as text"), 3, [1.0, 2.0, 1.0])
    share = {r.shard: r["count"] / 20000 for r in many.groupBy("shard").count().collect()}
    assert abs(share[1] - 0.5) < 0.02 and abs(share[0] - 0.25) < 0.02
    assert sharding.assign(empty).count() == 0
    path = work_path(spark, "shards-test")
    sharding.write_shards(docs, path, 4)
    assert spark.read.parquet(path).count() == docs.count()


def test_quality_rules(docs, empty):
    got = {r.doc_id: r for r in quality_rules.apply_rules(docs).collect()}
    failed = defaultdict(list)
    for d, t, source, *_ in corpus():
        w, lines, windows = WORDS.findall(t or ""), [x for x in (t or "").split("\n") if WORDS.search(x)], Counter()
        for i in range(len(w) - 4):
            windows[tuple(w[i:i + 5])] += 1
        hit = {j for i in range(len(w) - 4) if windows[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
        bad = len(w) < 10 or 100 * len(hit) > 20 * len(w)
        r = got[d]
        assert (r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (
            len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(hit), bad)
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", t or ""))
        failed[source].append(bad)
    rates = {s: sum(f) / len(f) for s, f in failed.items()}
    mean = sum(map(sum, failed.values())) / sum(map(len, failed.values()))
    worth = mean * (1 - mean) / np.var(list(rates.values())) - 1
    for d, _, source, *_ in corpus():
        rate = (sum(failed[source]) + mean * worth) / (len(failed[source]) + worth)
        assert got[d].host_rate == pytest.approx(rate) and got[d].kept == (not got[d].base_failed and rate <= 0.5)
    assert quality_rules.apply_rules(empty).count() == 0


def fill(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    open_, left, out = set(names), share * sum(sizes.values()), {}
    while True:
        level = left / sum(w[s] for s in open_) if open_ else 0
        over = {s for s in open_ if w[s] * level >= cap * sizes[s]}
        if not over:
            return out | {s: w[s] * level for s in open_}
        for s in over:
            out[s] = cap * sizes[s]
            left -= out[s]
        open_ -= over


def test_mixing(docs, empty):
    got = mixing.mix(docs).collect()
    sizes, taken, largest = Counter(), Counter(), Counter()
    words = {d: len(WORDS.findall(t or "")) for d, t, *_ in corpus()}
    for d, _, s, *_ in corpus():
        sizes[s] += words[d]
    want = fill(sizes)
    for r in got:
        assert r["size"] == words[r.doc_id] and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source]) and 0 <= r.copies <= 2 and r.taken == r.copies * r["size"]
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in want)
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mixing.mix(docs.repartition(7)).collect()), key=repr)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns and out.count() == sum(r.copies for r in got)
    twice = docs.unionByName(docs)
    assert mixing.mixed_documents(twice).count() == sum(r.copies for r in mixing.mix(twice).collect())
    assert mixing.mix(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0


def test_packing(spark, docs, empty):
    got = packing.pack_documents(docs, capacities=(64, 128, 256), lot_rows=50).collect()
    words, bins, pieces = {d: len(WORDS.findall(t or "")) for d, t, *_ in corpus()}, defaultdict(list), Counter()
    for r in got:
        pieces[r.doc_id] += r.length
        assert r.start == 256 * r.piece
        if r.length:
            bins[r.bin_id].append(r)
        else:
            assert r.bin_id is None and r.bin_capacity is None
    assert pieces == Counter(words) | Counter({d: 0 for d in words})
    for rows in bins.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.bin_offset):
            assert r.bin_offset == at
            at += r.length
        assert rows[0].bin_capacity == min(c for c in (64, 128, 256) if c >= at)
    assert packing.pack_documents(empty).count() == 0
    lengths = np.random.default_rng(1).integers(1, 4096, 3000)
    _, _, capacity = packing.pack(lengths)
    number = packing.pack(lengths)[0]
    total = sum({n: c for n, c in zip(number, capacity, strict=True)}.values())
    assert lengths.sum() / total > 0.97


def test_packing_foresees_the_whole_filling():
    def greedy(lengths, capacity):
        room = capacity
        for x in sorted(lengths, reverse=True):
            room -= x if x <= room else 0
        return capacity - room

    r = np.random.default_rng(5)
    tables = [[600] * 3 + [10] * 500] + [r.integers(1, high, n).tolist() for high, n in
                                         ((5, 900), (40, 400), (700, 60), (4097, 30), (2, 300)) for _ in range(6)]
    for price in (packing.cost, lambda c: 1.0, lambda c: float(c)):
        for lengths in tables:
            lengths = sorted(lengths, reverse=True)
            each = [(price(c) / greedy(lengths, c), c) for c in packing.CAPACITIES if c >= lengths[0]]
            want = next(c for x, c in each if x < min(each)[0] + 1e-12)
            _, _, capacity = packing.pack(np.array(lengths), packing.CAPACITIES, price)
            waiting, ahead = [-x for x in lengths], np.cumsum([0, *lengths]).tolist()
            assert packing._least_cost(lengths[0], waiting, ahead, 1, packing.CAPACITIES, price) == want
            assert capacity[0] <= want
    assert packing.pack(np.array(tables[0]))[2][0] == 1024


def test_packing_ids_above_double_precision(spark):
    ids = [2**53 + 1 + 2 * i for i in range(40)] + [2**63 - 1, -2**63 + 1, None, None, 0]
    rows = spark.createDataFrame([(d, "a b c") for d in ids], "doc_id long, text string").coalesce(1)
    got = packing.pack_documents(rows).collect()
    assert Counter(r.doc_id for r in got) == Counter(ids) and all(r.length == 3 for r in got)


def test_classifier_learns_and_walks_flat_trees(spark):
    r = np.random.default_rng(0)
    x = r.normal(size=(3000, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] < -0.2)).astype(float)
    model = quality_classifier.fit(x[:2000], y[:2000], n_trees=40)
    assert ((quality_classifier.score(model, x[2000:]) > 0.5) == y[2000:]).mean() > 0.97
    one = [quality_classifier.score(model, x[i:i + 1])[0] for i in range(50)]
    assert np.allclose(one, quality_classifier.score(model, x[:50]))


def test_classifier_on_documents(spark, empty):
    r = random.Random(2)
    rows, labels = [], []
    for d in range(400):
        good = d % 3 > 0
        words = ["".join(r.choice("abcdef") for _ in range(r.randint(2, 8))) for _ in range(60)]
        rows.append((d, " ".join(words) + "." if good else "!! ".join(w.upper() for w in words), "old"))
        if d % 2:
            labels.append((d, int(good)))
    rows += [(1000, None, "x"), (None, "", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    table = spark.createDataFrame(labels + [(1, None), (9999, 1)], "doc_id long, quality int")
    got = quality_classifier.classify(docs, table).collect()
    assert len(got) == 402 and all(0 <= g.score <= 1 and g.predicted == int(g.score >= 0.7) for g in got)
    held = [g for g in got if g.doc_id is not None and g.doc_id < 400 and zlib.crc32(str(g.doc_id).encode()) % 4 == 2]
    assert sum(g.predicted == (g.doc_id % 3 > 0) for g in held) / len(held) > 0.95
    none = quality_classifier.classify(docs, table.limit(0)).collect()
    assert {g.score for g in none} == {1.0}
    assert quality_classifier.classify(empty, table).count() == 0
    assert quality_classifier.keep_good(docs, table).columns == docs.columns


def shingles(text, k):
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in WORDS.findall(text or "")]
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


@pytest.mark.parametrize("k", [4, 5])
def test_near_duplicates(docs, empty, k):
    sets = {d: shingles(t, k) for d, t, *_ in corpus()}
    comp = {d: d for d in sets}
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            x = len(sets[a] & sets[b])
            if x and 100 * x >= 80 * (len(sets[a]) + len(sets[b]) - x):
                lo, hi = sorted((comp[a], comp[b]))
                comp = {d: lo if c == hi else c for d, c in comp.items()}
    got = minhash_dedup.near_duplicates(docs, k).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {
        d: (len(sets[d]), comp[d], comp[d] == d) for d in ids}
    assert len(set(comp.values())) < len(ids) - 10
    assert minhash_dedup.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("block", [512, 5])
def test_near_duplicates_large_group_and_repeats(spark, monkeypatch, block):
    monkeypatch.setattr(minhash_dedup, "BLOCK", block)
    r = random.Random(8)
    base = ["w%d" % i for i in range(60)]
    rows = []
    for d in range(150):  # chains: each a few edits off a random earlier one
        words = list(base if d < 5 else rows[r.randrange(len(rows))][1].split())
        for _ in range(2):
            words[r.randrange(len(words))] = "e%d" % r.randrange(10**6)
        rows.append((d, " ".join(words)))
    rows += [(3, rows[3][1]), (None, rows[0][1]), (None, None), (500, rows[1][1]), (7, "another text for seven")]
    got = minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()
    assert len(got) == len(rows)
    nodes = {}
    for d, t in rows[:150]:
        if d != 7:
            nodes[d] = shingles(t, 4)
    comp = {r.doc_id: r.component_id for r in got}
    for a in nodes:
        for b in nodes:
            x = len(nodes[a] & nodes[b])
            if a < b and 100 * x >= 80 * (len(nodes[a]) + len(nodes[b]) - x):
                assert comp[a] == comp[b]
    assert comp[500] == comp[1] and comp[None] is None
    assert all(r.kept for r in got if r.doc_id is None)
    stay = minhash_dedup.keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()
    assert {r.doc_id for r in stay} == {r.doc_id for r in got if r.kept}


def test_near_duplicates_of_every_text_of_a_document(spark):
    texts = [" ".join("%s%d" % (c, i) for i in range(40)) for c in "abcdef"]
    rows = [(7, t) for t in texts[:3]] + [(20 + i, t + " end") for i, t in enumerate(texts[:3])]
    rows += [(5, texts[3]), (5, texts[4]), (5, texts[4]), (5, None), (5, ""), (6, texts[4]), (9, texts[5]),
             (9, texts[5]), (3, texts[5] + " end"), (3, texts[5] + " end"), (None, texts[0]), (None, texts[0])]
    docs = spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, n int").repartition(3)
    got = minhash_dedup.near_duplicates(docs, 4).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.component_id) for r in got} == {(7, 7), (20, 7), (21, 7), (22, 7), (5, 5), (6, 5), (9, 3),
                                                         (3, 3), (None, None)}
    stay = minhash_dedup.keep_one_of_each(docs, 4).collect()
    assert Counter(r.doc_id for r in stay) == {7: 3, 5: 3, 3: 1, None: 2}


def test_components(spark):
    r = random.Random(3)
    edges = [(r.randrange(400), r.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1100)]
    comp = {}
    for u, v in edges:
        a, b = comp.setdefault(u, u), comp.setdefault(v, v)
        comp = {n: min(a, b) if c in (a, b) else c for n, c in comp.items()}
    got = {x.node: x.component for x in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {n: c for n, c in comp.items() if n in got} and all(c == n for n, c in comp.items() if n not in got)


def test_pipeline_stages(spark):
    import corpus_pipeline as p
    from tests.conftest import SF001

    docs = p.read_documents(spark, SF001)
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    counts = []
    for name, stage in p.STAGES[:-1]:
        out = p.materialise(stage(spark, docs, SF001), "stage")
        assert out.columns == columns
        now = [r.doc_id for r in out.select("doc_id").collect()]
        assert set(now) <= ids
        counts.append(len(now))
        if name == "line dedup":
            assert set(now) == ids and out.filter("n_chars <> char_length(text)").count() == 0
        if name == "near duplicates":
            assert len(now) == len(set(now)) < counts[-2]
        docs, ids = out, set(now)
    packed = p.STAGES[-1][1](spark, docs, SF001)
    n_words = sum(len(WORDS.findall(r.text or "")) for r in docs.collect())
    assert packed.agg({"length": "sum"}).first()[0] == n_words
