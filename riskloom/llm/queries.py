"""One registered query per operator, over whole tables, with its SQL where SQL can express it."""

from __future__ import annotations

import os
from functools import wraps
from pathlib import Path

import public_tokenizers
from pyspark.sql import functions as F

from ..sources.tables import read_table
from . import (alignment, exact_dedup, filter_audit, minhash_dedup, ngram_join, packing, quality, sentencepiece_codec, sharding, token_counts,
               token_files, topk, warc)

ROOT = str(Path(__file__).resolve().parents[2])
BYTE_BPE, WORD_BPE, PIECES = "byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"


def importable(spark):
    """Python workers started from now on find this package where the driver
    found it (on a cluster: where it is installed or shipped)."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])


def _registered(query):
    @wraps(query)
    def run(spark, sf_dir):
        importable(spark)
        return query(spark, sf_dir)
    return run


def op1_top_k(spark, sf_dir):
    vectors = read_table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


def op2_token_counts(spark, sf_dir):
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op3_token_files(spark, sf_dir):
    return token_files.write_and_read(read_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op4_packing(spark, sf_dir):
    return packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op5_warc(spark, sf_dir):
    # The pages carry no capture time: one second per page id from 2024-01-01 on, for at most 30 years.
    captured = F.lit(1_704_067_200) + F.pmod(F.coalesce(F.col("page_id"), F.lit(0)), F.lit(10**9))
    return warc.write_and_read(read_table(spark, sf_dir, "pages"), captured)


def op6_quality(spark, sf_dir):
    return quality.quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_shards(spark, sf_dir):
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents"))


def op9_ngram_join(spark, sf_dir):
    return ngram_join.similarity_join(read_table(spark, sf_dir, "documents"))


def op10_sentencepiece(spark, sf_dir):
    return sentencepiece_codec.encode_and_decode(read_table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op11_alignment(spark, sf_dir):
    return alignment.alignment_report(read_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE),
                                      public_tokenizers.path(PIECES))


def op12_minhash(spark, sf_dir):
    return minhash_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op13_filter_audit(spark, sf_dir):
    return filter_audit.filter_audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def _components_sql(words: int, percent: int, columns: str) -> str:
    """Links of all pairs of documents that share a shingle, and what they reach."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
places AS (SELECT doc_id, words, unnest(range(1, greatest(len(words) - {words - 2}, 2))) AS i FROM w WHERE len(words) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + {words - 1}], ' ') AS shingle FROM places),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
           GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= {percent} * (x.n + y.n - k)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
found AS (SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(least.b, d.doc_id)) AS component_id,
                 (SELECT count(*) FROM links WHERE links.a = d.doc_id) AS n_links
          FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least ON least.a = d.doc_id)
SELECT doc_id, n_shingles, component_id, {columns} FROM found"""


QUERIES = {f.__name__: _registered(f) for f in (
    op1_top_k, op2_token_counts, op3_token_files, op4_packing, op5_warc, op6_quality, op7_shards, op8_exact_dedup,
    op9_ngram_join, op10_sentencepiece, op11_alignment, op12_minhash, op13_filter_audit)}

ORACLES = {
    "op1_top_k": """
WITH whole AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, r.vec_id AS vec_id, CAST(list_dot_product(q.v, r.v) AS BIGINT) AS score
  FROM whole q JOIN whole r ON q.vec_id <> r.vec_id AND len(q.v) = len(r.v)
  WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score FROM scored)
SELECT * FROM ranked WHERE rank <= 5""",
    "op8_exact_dedup": r"""
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS content FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept,
       sha256(content) AS text_sha256
FROM texts WINDOW w AS (PARTITION BY content)""",
    "op13_filter_audit": r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
least_id AS (SELECT text, min(doc_id) AS least FROM texts GROUP BY text),
marks AS (
  SELECT doc_id, coalesce(max(CAST(quality = 1 AS INTEGER)), 0) AS good, coalesce(max(CAST(toxic = 1 AS INTEGER)), 0) AS toxic
  FROM labels GROUP BY doc_id),
failed AS (
  SELECT t.part, coalesce(m.good, 0) AS good, coalesce(m.toxic, 0) AS toxic,
         (CASE WHEN len(words) < 50 THEN 1 ELSE 0 END)
         + (CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END)
         + (CASE WHEN 100 * len(regexp_replace(t.text, '[^A-Z]', '', 'g')) > 5 * length(t.text) THEN 4 ELSE 0 END)
         + (CASE WHEN regexp_matches(t.text, '[#$%&*|]') THEN 8 ELSE 0 END)
         + (CASE WHEN t.doc_id > l.least THEN 16 ELSE 0 END) AS mask
  FROM texts t LEFT JOIN least_id l ON l.text = t.text LEFT JOIN marks m ON m.doc_id = t.doc_id),
counts AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY part, mask),
f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(letter, bit)),
orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
  FROM f a JOIN f b ON b.bit <> a.bit JOIN f c ON c.bit NOT IN (a.bit, b.bit)
  JOIN f d ON d.bit NOT IN (a.bit, b.bit, c.bit) JOIN f e ON e.bit NOT IN (a.bit, b.bit, c.bit, d.bit)),
steps AS (
  SELECT o.filter_order, s.step, f.letter, f.bit,
         (SELECT coalesce(sum(g.bit), 0) FROM f g WHERE instr(substr(o.filter_order, 1, s.step - 1), g.letter) > 0) AS earlier
  FROM orders o CROSS JOIN range(1, 6) AS s(step) JOIN f ON f.letter = substr(o.filter_order, s.step, 1)),
report AS (
  SELECT c.part, s.filter_order, s.step, s.letter,
         sum(CASE WHEN (c.mask & (s.earlier | s.bit)) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN (c.mask & s.bit) <> 0 AND (c.mask & s.earlier) = 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN (c.mask & s.bit) <> 0 AND (c.mask & s.earlier) <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN c.mask = s.bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN (c.mask & s.bit) <> 0 AND (c.mask & s.earlier) = 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN (c.mask & s.bit) <> 0 AND (c.mask & s.earlier) = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM counts c CROSS JOIN steps s GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM report""",
    "op5_warc": r"""
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS html, lower(coalesce(url, '')) AS u FROM pages),
k AS (
  SELECT *, strlen(html) AS payload_bytes, sha256(html) AS payload_digest,
         1704067200 + ((page_id % 1000000000) + 1000000000) % 1000000000 AS ts,
         regexp_extract(u, '^[a-z][a-z0-9+.\-]*://([^/:?#]+)', 1) AS host,
         regexp_extract(u, '^[a-z][a-z0-9+.\-]*://[^/?#]*(.*)$', 1) AS rest FROM p),
m AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first,
             CASE WHEN host = '' THEN u ELSE array_to_string(list_reverse(string_split(host, '.')), ',') || ')' || rest END AS url_key
      FROM k)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to, url, CAST(ts AS BIGINT) AS ts, url_key,
       row_number() OVER (ORDER BY url_key, ts, CAST(page_id AS VARCHAR)) - 1 AS ordinal
FROM m""",
    "op9_ngram_join": _components_sql(3, 90, "n_links"),
    "op12_minhash": _components_sql(4, 80, "doc_id = component_id AS kept"),
}
