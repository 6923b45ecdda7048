"""Shared common table expressions of the oracle SQL (long form, no list arithmetic)."""

from __future__ import annotations

# ql: one row per vector element; doc: the index columns of each vector.
VECTORS = """
ql AS (
  SELECT vec_id AS doc_id, generate_subscripts(embedding, 1) - 1 AS i,
         CAST(floor(CAST(unnest(embedding) AS DOUBLE) * 10000 + 0.5) AS BIGINT) AS v
  FROM embeddings),
doc AS (
  SELECT vec_id AS doc_id, CASE WHEN label % 2 = 1 THEN 'a' ELSE 'b' END AS idx,
         't' || CAST(label % 2 AS VARCHAR) AS type, vec_id % 5 AS shard
  FROM embeddings)"""

DOCS = VECTORS + """,
full_doc AS (
  SELECT doc.*, d.source AS name, d.lang, d.n_chars FROM doc LEFT JOIN documents d ON d.doc_id = doc.doc_id)"""

SIGNATURES = VECTORS + """,
planes AS (
  SELECT bundle, bit, i, ((a * a + a * 7) % 2147483647) % 2001 - 1000 AS coef FROM (
    SELECT b.range AS bundle, t.range AS bit, e.range AS i,
           (((b.range * 12 + t.range) * 64 + e.range) * 48271 + 11) % 2147483647 AS a
    FROM range(50) b, range(12) t, range(64) e)),
sig AS (
  SELECT doc_id, bundle, CAST(sum(CASE WHEN dot >= 0 THEN (1 << bit) ELSE 0 END) AS BIGINT) AS h FROM (
    SELECT q.doc_id, p.bundle, CAST(p.bit AS INTEGER) AS bit, sum(q.v * p.coef) AS dot
    FROM ql q JOIN planes p ON p.i = q.i GROUP BY 1, 2, 3) GROUP BY 1, 2)"""

LSH = VECTORS + """,
lsh_rows AS (
  SELECT b.range AS bundle, (1000 + b.range) * 768 AS base FROM range(50) b),
lsh AS (
  SELECT doc_id, bundle, CAST(floor((dot + bias) / CAST(4000000 AS DOUBLE)) AS BIGINT) AS h FROM (
    SELECT q.doc_id, r.bundle, ((r.base * 48271 + 11) % 2147483647) % 4000000 AS bias,
           CAST(sum(q.v * (((c.a * c.a + c.a * 7) % 2147483647) % 2001 - 1000)) AS BIGINT) AS dot
    FROM ql q JOIN lsh_rows r ON true
    JOIN (SELECT bundle, e.range AS i, ((base + e.range) * 48271 + 11) % 2147483647 AS a
          FROM lsh_rows, range(64) e) c ON c.bundle = r.bundle AND c.i = q.i
    GROUP BY 1, 2, 3))"""


def pairs(query_filter: str = "q.doc_id = 0") -> str:
    """Per (query, document): distances as exact sums."""
    return f"""
pair AS (
  SELECT q.doc_id AS query_id, d.doc_id, CAST(sum(d.v * q.v) AS BIGINT) AS ab, CAST(sum(d.v * d.v) AS BIGINT) AS aa,
         CAST(sum(q.v * q.v) AS BIGINT) AS bb, CAST(sum(abs(d.v - q.v)) AS BIGINT) AS l1,
         CAST(sum((d.v - q.v) * (d.v - q.v)) AS BIGINT) AS sq
  FROM ql d JOIN ql q ON q.i = d.i AND {query_filter} GROUP BY 1, 2),
dist AS (
  SELECT query_id, doc_id, l1, 1.0::DOUBLE - ab::DOUBLE / sqrt(aa::DOUBLE * bb::DOUBLE) AS cosine,
         sqrt(sq::DOUBLE) / 10000.0::DOUBLE AS l2,
         100.0::DOUBLE * (1.0::DOUBLE - ab::DOUBLE / (aa + bb - ab)::DOUBLE) AS tanimoto FROM pair)"""


def score(distance: str, boost: float = 1.0) -> str:
    return f"(CASE WHEN {distance} <= 1 THEN 2.0::DOUBLE - {distance} ELSE 1.0::DOUBLE / {distance} END * {float(boost)}::DOUBLE)"


# Distinct overlap: query hashes keep their repeats, document hashes do not.
OVERLAP = """
ov AS (
  SELECT d.doc_id, count(*) AS overlap
  FROM (SELECT h FROM sig WHERE doc_id = 0) q
  JOIN (SELECT DISTINCT doc_id, h FROM sig) d ON d.h = q.h GROUP BY 1)"""
