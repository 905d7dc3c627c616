"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

import string

from pyspark.sql import functions as F

from strata.llm import (ann, hard_negatives, line_dedup, merkle, minhash_dedup, mixing, packing, quality_classifier,
                        quality_rules, sharding, token_counts, token_files, toxicity)
from strata.llm.common import read_documents, work_path


def op1_line_dedup(spark, sf_dir):
    out = line_dedup.dedup_lines(read_documents(spark, sf_dir, "doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", "kept_sha256")


def op2_token_counts(spark, sf_dir):
    return token_counts.token_counts(read_documents(spark, sf_dir, "doc_id", "text"))


def op3_nearest_neighbours(spark, sf_dir):
    return ann.nearest(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


def op4_sharding(spark, sf_dir):
    return sharding.assign(read_documents(spark, sf_dir, "doc_id", "text"))


def op5_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(read_documents(spark, sf_dir, "doc_id", "text"))


def op6_quality_rules(spark, sf_dir):
    return quality_rules.apply_rules(read_documents(spark, sf_dir, "doc_id", "text", "source"))


def op7_token_files(spark, sf_dir):
    path = work_path(spark, "token-files")
    token_files.write_token_files(read_documents(spark, sf_dir, "doc_id", "text"), path)
    return token_files.read_digests(spark, path)


def op8_mixing(spark, sf_dir):
    out = mixing.mix(read_documents(spark, sf_dir, "doc_id", "text", "source"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op9_quality_classifier(spark, sf_dir):
    docs = read_documents(spark, sf_dir, "doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return quality_classifier.classify(docs, labels).select(
        "doc_id", quality_classifier.held_out().alias("held_out"), "score", "predicted")


def op10_minhash_dedup(spark, sf_dir):
    return minhash_dedup.near_duplicates(read_documents(spark, sf_dir, "doc_id", "text"), k=4)


def op11_merkle_manifest(spark, sf_dir):
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    manifest = merkle.write_manifest(read_documents(spark, sf_dir, *merkle.FIELDS), work_path(spark, "manifest"),
                                     seen={"text": lowered}, where=tampered)
    return manifest.audit().select(F.col("key").cast("long").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256",
                                   "folded_root", "verified")


def op12_toxicity(spark, sf_dir):
    docs = read_documents(spark, sf_dir, "doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return toxicity.classify(docs, labels).select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op13_hard_negatives(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet")
    finite = ~F.exists("embedding", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    whole = F.transform(F.col("embedding").cast("array<double>"), lambda e: F.floor(e * 256).cast("double"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.filter(finite).select("vec_id", whole.alias("embedding"), moved.alias("label")),
                               F.col("vec_id") % 50 == 0)


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


Q = {f.__name__: f for f in (
    op1_line_dedup, op2_token_counts, op3_nearest_neighbours, op4_sharding, op5_best_fit_packing, op6_quality_rules,
    op7_token_files, op8_mixing, op9_quality_classifier, op10_minhash_dedup, op11_merkle_manifest,
    op12_toxicity, op13_hard_negatives, pipeline)}

_WHITE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}) || ':' || {0} END"
_FIELDS = " || ".join(_FIELD.format(c) for c in ("d", "s", "lang", "n")) + " || " + _FIELD.format("{text}")
_LEFT, _RIGHT = "array_to_string(ds[1:i % 8], '')", "array_to_string(ds[i % 8 + 2:], '')"

SQL = {
    "op1_line_dedup": f"""
WITH cut AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM cut),
keyed AS (SELECT *, {_LOWER.format(f"trim(line, {_WHITE})")} AS k FROM lines),
often AS (SELECT k, max(doc_id) AS keep_doc FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT keyed.*, coalesce(keep_doc <> doc_id, false) AS gone FROM keyed LEFT JOIN often USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op3_nearest_neighbours": """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings),
ok AS (SELECT * FROM v WHERE x IS NOT NULL AND len(list_filter(x, lambda e: e IS NULL OR NOT isfinite(e))) = 0
       AND len(list_filter(x, lambda e: e <> 0)) > 0),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x) AS score
          FROM ok q JOIN ok c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20""",
    "op6_quality_rules": rf"""
WITH base AS (SELECT doc_id, source, coalesce(text, '') AS t, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
pos AS (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM base WHERE len(w) >= 5),
win AS (SELECT doc_id, i, w[i:i + 4] AS g FROM pos),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
cov AS (SELECT doc_id, sum(least(5, coalesce(nxt - i, 5)))::BIGINT AS n_repeat_words
        FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM rep) GROUP BY doc_id),
dup AS (SELECT doc_id, (count(*) - count(DISTINCT line))::BIGINT AS n_dup_lines
        FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM base)
        WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
stat AS (SELECT base.doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
                len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
                coalesce(n_repeat_words, 0) AS n_repeat_words
         FROM base LEFT JOIN dup USING (doc_id) LEFT JOIN cov USING (doc_id)),
rule AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM stat),
host AS (SELECT source, count(*) AS docs, count(*) FILTER (base_failed) AS failed FROM rule GROUP BY source),
fit AS (SELECT sum(failed) / sum(docs) AS mean, var_pop(failed / docs) AS spread FROM host),
prior AS (SELECT mean, CASE WHEN spread > 0 AND spread < mean * (1 - mean) THEN mean * (1 - mean) / spread - 1
                            ELSE 100 END AS worth FROM fit),
verdict AS (SELECT source, (failed + mean * worth) / (docs + worth) AS host_rate FROM host, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND host_rate <= 0.5 AS kept, host_rate
FROM rule JOIN verdict ON rule.source IS NOT DISTINCT FROM verdict.source""",
    "op10_minhash_dedup": rf"""
WITH RECURSIVE base AS (SELECT doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents),
long AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM base WHERE len(w) > 0),
sh AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s FROM long),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS x FROM sh a JOIN sh b USING (s) WHERE a.doc_id < b.doc_id GROUP BY ALL),
link AS MATERIALIZED (SELECT u, v FROM pairs JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v
                      WHERE 100 * x >= 80 * (a.n + b.n - x)),
edge AS (SELECT u, v FROM link UNION ALL SELECT v, u FROM link),
reach(d, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.d, edge.v FROM reach JOIN edge ON edge.u = reach.r)
SELECT d AS doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r) AS component_id, min(r) = d AS kept
FROM reach LEFT JOIN n ON n.doc_id = d GROUP BY d""",
    "op11_merkle_manifest": rf"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x:
                         CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
typed AS (SELECT doc_id, lang, CAST(doc_id AS VARCHAR) AS d, source AS s, CAST(n_chars AS VARCHAR) AS n, text AS x,
                 {_LOWER.format("text")} AS y FROM documents),
hashed AS (SELECT doc_id, lang, d, sha256({_FIELDS.format(text="x")}) AS leaf, sha256({_FIELDS.format(text="y")}) AS low,
                  coalesce(xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(d, ''),
                    lambda c: ascii(c)::BIGINT)), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c // 256))) % 3 = 0, false) AS hit
           FROM typed, crc),
placed AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, leaf, CASE WHEN hit THEN low ELSE leaf END AS seen,
                  dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY lang) AS n,
                  row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM hashed),
node(tree, level, i, n, d) AS (SELECT tree, 0, i, n, leaf FROM placed UNION ALL
  SELECT tree, level + 1, i // 8, (n + 7) // 8, sha256(string_agg(d, '' ORDER BY i)) FROM node WHERE n > 1
  GROUP BY tree, level, i // 8, n),
sub AS MATERIALIZED (SELECT tree, d, count(*) OVER () AS n FROM node WHERE n = 1),
top(level, i, n, d) AS (SELECT 0, tree, n, d FROM sub UNION ALL
  SELECT level + 1, i // 8, (n + 7) // 8, sha256(string_agg(d, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY level, i // 8, n),
run AS MATERIALIZED (SELECT tree, level, i // 8 AS k, list(d ORDER BY i) AS ds FROM node GROUP BY ALL),
top_run AS MATERIALIZED (SELECT level, i // 8 AS k, list(d ORDER BY i) AS ds FROM top GROUP BY ALL),
fold(rid, tree, level, i, n, cur, sib) AS (SELECT rid, tree, 0, i, n, seen, '' FROM placed UNION ALL
  SELECT rid, f.tree, f.level + 1, i // 8, (n + 7) // 8, sha256({_LEFT} || cur || {_RIGHT}), sib || {_LEFT} || {_RIGHT}
  FROM fold f JOIN run r ON r.tree = f.tree AND r.level = f.level AND r.k = i // 8 WHERE n > 1),
up(rid, level, i, n, cur, sib) AS (SELECT rid, 0, fold.tree, sub.n, cur, sib FROM fold JOIN sub ON sub.tree = fold.tree
  WHERE fold.n = 1 UNION ALL
  SELECT rid, u.level + 1, i // 8, (n + 7) // 8, sha256({_LEFT} || cur || {_RIGHT}), sib || {_LEFT} || {_RIGHT}
  FROM up u JOIN top_run r ON r.level = u.level AND r.k = i // 8 WHERE n > 1)
SELECT doc_id, leaf, sub.d AS subroot, top.d AS root, sha256(sib) AS proof_sha256, cur AS folded_root, cur = top.d AS verified
FROM placed JOIN up USING (rid) JOIN sub ON sub.tree = placed.tree, top WHERE up.n = 1 AND top.n = 1""",
    "op13_hard_negatives": """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding::DOUBLE[] AS x
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
ok AS (SELECT vec_id, label, list_transform(x, lambda e: floor(256 * e)) AS x FROM v
       WHERE len(list_filter(x, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
pairs AS MATERIALIZED (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS alike,
                              list_inner_product(a.x, c.x)::BIGINT AS score
                       FROM ok a JOIN ok c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
pos AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE alike
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank
FROM pos JOIN pairs USING (anchor_id)
WHERE NOT alike AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3""",
}
