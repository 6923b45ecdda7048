"""Registered queries of this subpackage: each applies one operator to its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumisift.llm import decontamination, language, lexical, toxicity
from lumisift.llm.byte_bpe import digests
from lumisift.llm.html_text import main_text
from lumisift.llm.line_dedup import without_repeats
from lumisift.llm.near_dedup import near_duplicates
from lumisift.llm.phrases import collocations
from lumisift.llm.pii import pseudonymised
from lumisift.llm.quality import quality
from lumisift.llm.suffix_dedup import removed
from lumisift.llm.token_counts import token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


@query
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = toxicity.scored(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return found.select(
        "doc_id", (toxicity.remainder("doc_id") == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


NEAR_DUPLICATES = r"""
WITH RECURSIVE word AS (SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
held AS (SELECT doc_id, CASE WHEN len(ws) < 2 THEN ws ELSE
    list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) END AS shingles FROM word),
member AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM held),
link AS (SELECT x.doc_id AS a, y.doc_id AS b FROM member x JOIN member y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
  GROUP BY 1, 2 HAVING 100 * count(*) >= 80 * (any_value(x.n) + any_value(y.n) - count(*))),
reach AS (SELECT doc_id, doc_id AS root FROM documents UNION SELECT link.b, reach.root FROM reach JOIN link ON link.a = reach.doc_id)
SELECT h.doc_id, len(h.shingles) AS n_shingles, r.root AS component_id, h.doc_id = r.root AS kept
FROM held h JOIN (SELECT doc_id, min(root) AS root FROM reach GROUP BY 1) r ON r.doc_id = h.doc_id"""
ORACLES["op5_near_duplicates"] = NEAR_DUPLICATES


@query
def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=2)


@query
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed(table(spark, sf_dir, "documents")).drop("kept")


LINE_DEDUP = r"""
WITH whole AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
line AS (SELECT doc_id, generate_subscripts(ls, 1) AS pos, unnest(ls) AS line FROM whole),
used AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS w
  FROM line WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
total AS (SELECT *, sum(w) OVER (PARTITION BY doc_id ORDER BY i) AS t FROM used),
reach AS (SELECT a.doc_id, a.i, b.i AS j FROM total a JOIN total b ON b.doc_id = a.doc_id AND b.i BETWEEN a.i AND a.i + 9
  WHERE b.t - a.t + a.w >= 10),
span AS (SELECT doc_id, i, min(j) AS j FROM reach GROUP BY 1, 2 UNION SELECT doc_id, max(i), j FROM reach GROUP BY doc_id, j),
body AS (SELECT s.doc_id, s.i, s.j, string_agg(c.line, chr(10) ORDER BY c.i) AS body
  FROM span s JOIN total c ON c.doc_id = s.doc_id AND c.i BETWEEN s.i AND s.j GROUP BY 1, 2, 3),
later AS (SELECT doc_id, i, j FROM (SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, i) AS place FROM body) WHERE place > 1),
gone AS (SELECT DISTINCT l.doc_id, c.pos FROM later l JOIN total c ON c.doc_id = l.doc_id AND c.i BETWEEN l.i AND l.j),
kept AS (SELECT line.doc_id, count(gone.pos) AS n_removed, string_agg(line, chr(10) ORDER BY line.pos) FILTER (gone.pos IS NULL) AS rest
  FROM line LEFT JOIN gone ON gone.doc_id = line.doc_id AND gone.pos = line.pos GROUP BY 1)
SELECT w.doc_id, len(w.ls) AS n_lines, k.n_removed, sha256(coalesce(k.rest, '')) AS kept_sha256 FROM whole w JOIN kept k ON k.doc_id = w.doc_id"""
ORACLES["op6_line_dedup"] = LINE_DEDUP


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query
def op7_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymised(table(spark, sf_dir, "documents"), key="a key for tests")


@query
def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


PHRASES = r"""
WITH piece AS (SELECT doc_id, coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
word AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM piece),
gram AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
  FROM word, (SELECT unnest([1, 2, 3]) AS k) WHERE len(ws) >= k),
total AS (SELECT lang, count(*) AS n FROM gram WHERE k = 1 GROUP BY 1),
f AS (SELECT lang, k, phrase, count(*) AS f FROM gram GROUP BY 1, 2, 3 HAVING count(*) >= 10),
long AS (SELECT lang, f, string_split(phrase, ' ') AS ws FROM f WHERE k = 3),
inner_two AS (SELECT lang, phrase, max(f) AS f FROM (
  SELECT lang, f, ws[1] || ' ' || ws[2] AS phrase FROM long UNION ALL SELECT lang, f, ws[2] || ' ' || ws[3] FROM long) GROUP BY 1, 2),
kept AS (SELECT f.lang, f.k, f.phrase, f.f AS a, string_split(f.phrase, ' ') AS ws FROM f LEFT JOIN inner_two i USING (lang, phrase)
  WHERE f.k > 1 AND (f.k = 3 OR i.f IS NULL OR 100 * i.f < 50 * f.f)),
cut AS (SELECT lang, phrase, a, c, array_to_string(ws[1:c], ' ') AS x, array_to_string(ws[c + 1:], ' ') AS y
  FROM kept, (SELECT unnest([1, 2]) AS c) WHERE c < k),
scored AS (SELECT cut.*, l.f AS l, r.f AS r, (1000000 * a::HUGEINT * a) // (l.f::HUGEINT * r.f) AS score
  FROM cut JOIN f l ON l.lang = cut.lang AND l.phrase = x JOIN f r ON r.lang = cut.lang AND r.phrase = y),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN total USING (lang) WHERE rank <= 2000"""
ORACLES["op12_phrase_collocations"] = PHRASES


@query
def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"), least=10, longest=3, top=2000)


@query
def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identified(docs, language.fit(docs))
    return found.select("doc_id", (language.remainder("doc_id") == 0).alias("held_out"), "lang_pred", "score")


LEXICAL_SEARCH = r"""
WITH held AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
total AS (SELECT count(*)::BIGINT AS docs, sum(len(ts))::BIGINT AS terms FROM held WHERE len(ts) > 0),
asked AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY 1, 2),
word AS (SELECT doc_id, len(ts) AS n, unnest(ts) AS term FROM held),
tf AS (SELECT doc_id, n, term, count(*) AS tf FROM word SEMI JOIN asked USING (term) GROUP BY 1, 2, 3),
weight AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, total GROUP BY term),
part AS (SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms))) AS s FROM tf JOIN weight USING (term), total),
score AS (SELECT item_id, doc_id, sum(times * s)::BIGINT AS score FROM asked JOIN part USING (term) GROUP BY 1, 2 HAVING sum(times * s) > 0),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM score)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10"""
ORACLES["op13_lexical_search"] = LEXICAL_SEARCH


@query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=10)
