"""One query per operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from cityviews.llm.common import table
from cityviews.llm.conversation_repair import repair_damaged
from cityviews.llm.fingerprints import fingerprint_edits
from cityviews.llm.hard_negatives import mine
from cityviews.llm.html_text import extract_pages
from cityviews.llm.line_dedup import drop_lines, line_index
from cityviews.llm.mixing import mix, plan
from cityviews.llm.ngram_join import jaccard_components
from cityviews.llm.packing import pack
from cityviews.llm.shards import shard_documents
from cityviews.llm.token_rollup import rollup_documents
from cityviews.llm.topk import top_k
from cityviews.llm.toxicity import toxicity
from cityviews.llm.warc import read_archives, write_archives
from cityviews.sinks.workdir import work_folder


def op1_ngram_join(spark, sf_dir):
    return jaccard_components(table(spark, sf_dir, "documents"), words=3, per_cent=90)


def op2_html_extraction(spark, sf_dir):
    return extract_pages(table(spark, sf_dir, "pages"))


def op3_sharding(spark, sf_dir):
    return shard_documents(table(spark, sf_dir, "documents"), shards=24)


def op4_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return mix(docs, plan(docs))


def op5_topk(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings"), k=5, scale=256.0, every=50)


def op6_fingerprints(spark, sf_dir):
    return fingerprint_edits(table(spark, sf_dir, "documents"))


def op7_toxicity(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_warc(spark, sf_dir):
    folder = work_folder(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), folder)
    return read_archives(spark, folder)


def op9_token_counts(spark, sf_dir):
    return rollup_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
        work_folder(spark, "rollup"))


def op10_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_conversation_repair(spark, sf_dir):
    return repair_damaged(table(spark, sf_dir, "conversations"))


def op12_hard_negatives(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors.withColumn("label", moved), every=50)


def op13_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return drop_lines(docs, line_index(docs, least=10), least=10).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_ngram_join, op2_html_extraction, op3_sharding, op4_mixing, op5_topk, op6_fingerprints,
    op7_toxicity, op8_warc, op9_token_counts, op10_packing, op11_conversation_repair,
    op12_hard_negatives, op13_line_dedup,
)}

ORACLES: dict[str, str] = {}

ORACLES["op8_warc"] = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages
), h AS (SELECT d, min(page_id) AS head FROM p WHERE n >= 100 GROUP BY d)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
  CASE WHEN n >= 100 AND page_id IS DISTINCT FROM head THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id IS DISTINCT FROM head THEN head END AS refers_to
FROM p LEFT JOIN h USING (d)"""

ORACLES["op5_topk"] = """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS f FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x::DOUBLE)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.f, v.f)::BIGINT AS score, q.f
  FROM (SELECT DISTINCT vec_id, f FROM v) AS q JOIN v
    ON q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id AND len(q.f) = len(v.f)
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id, f ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""

ORACLES["op4_mixing"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n
  FROM documents
), s AS (
  SELECT source, sum(n)::BIGINT AS t, count(*) AS docs, max(sum(n)) OVER ()::DOUBLE AS top FROM d GROUP BY source
), bisect AS (
  SELECT 0 AS i, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi,
    (SELECT max(1.0 / t) / min(1.0 / t) <= 4 FROM s WHERE t > 0) AS flat
  UNION ALL
  SELECT i + 1, CASE WHEN ok THEN lo ELSE mid END, CASE WHEN ok THEN mid ELSE hi END, flat FROM (
    SELECT i, lo, hi, flat, (lo + hi) / 2 AS mid,
      (SELECT max(pow(t / top, (lo + hi) / 2) / t) / min(pow(t / top, (lo + hi) / 2) / t) <= 4
       FROM s WHERE t > 0) AS ok
    FROM bisect WHERE i < 48) AS b
), e AS (
  SELECT CASE WHEN flat THEN 0.0 ELSE hi END AS exponent FROM bisect WHERE i = 48
), p AS (
  SELECT s.*, exponent, CASE WHEN t > 0 THEN pow(t / top, exponent) ELSE 0 END AS p FROM s, e
), w AS (
  SELECT source, t, docs, exponent, p / sum(p) OVER () AS weight,
    round(p / (SELECT min(p / t) FROM p WHERE t > 0))::BIGINT AS quota
  FROM p
), z AS (
  SELECT *, CASE WHEN t > 0 THEN quota // greatest(t, 1) ELSE 1 END AS passes,
    (SELECT greatest(1, ceil(sum(quota) / 1048576))::BIGINT FROM w) AS blocks
  FROM w
), last AS (
  SELECT d.doc_id, d.source, coalesce(sum(n) OVER (
      PARTITION BY d.source ORDER BY substr(md5(concat_ws(':', coalesce(doc_id::VARCHAR, 'null'), passes)), 1, 8), doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < quota - passes * t AS more
  FROM d JOIN z ON d.source IS NOT DISTINCT FROM z.source WHERE t > 0
), c AS (
  SELECT d.*, z.* EXCLUDE (source), unnest(range(passes + coalesce(more, false)::BIGINT)) AS pass
  FROM d JOIN z ON d.source IS NOT DISTINCT FROM z.source
  LEFT JOIN last ON d.doc_id = last.doc_id AND d.source IS NOT DISTINCT FROM last.source
), f AS (
  SELECT *, coalesce(sum(n) OVER (
      PARTITION BY source, pass
      ORDER BY substr(md5(concat_ws(':', coalesce(doc_id::VARCHAR, 'null'), pass)), 1, 8), doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM c
), g AS (
  SELECT *, least(floor((before + pass * t) / greatest(quota, 1) * blocks), blocks - 1)::BIGINT AS block FROM f
)
SELECT doc_id, source, n AS tokens, pass::INTEGER AS pass, block,
  row_number() OVER (PARTITION BY block ORDER BY md5(
    concat_ws(':', block, coalesce(doc_id::VARCHAR, 'null'), pass)), n)::INTEGER AS slot,
  round(exponent, 6) AS exponent, round(weight, 6) AS weight
FROM g"""

ORACLES["op12_hard_negatives"] = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * x::DOUBLE) FOR x IN embedding] AS f FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x::DOUBLE)]) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, a.label AS a_label, a.f, v.vec_id, v.label,
    list_inner_product(a.f, v.f)::BIGINT AS score
  FROM v AS a JOIN v ON a.vec_id % 50 = 0 AND a.vec_id <> v.vec_id AND len(a.f) = len(v.f)
), p AS (
  SELECT anchor_id, a_label, f, vec_id AS positive_id, score AS positive_score FROM s WHERE label = a_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id, a_label, f ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER (
    PARTITION BY anchor_id, a_label, f, positive_id, positive_score ORDER BY score DESC, vec_id)::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id, a_label, f)
WHERE label <> a_label AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3"""

ORACLES["op13_line_dedup"] = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), l AS (
  SELECT r, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d
), k AS (
  SELECT r, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), c AS (
  SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10
), kept AS (
  SELECT r, string_agg(line, chr(10) ORDER BY i) AS kept, count(*) AS n
  FROM k LEFT JOIN c USING (key) WHERE c.key IS NULL GROUP BY r
)
SELECT doc_id, len(lines)::BIGINT AS n_lines, (len(lines) - coalesce(n, 0))::BIGINT AS n_dropped,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)"""
