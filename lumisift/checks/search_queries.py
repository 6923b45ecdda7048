"""Scan, hash, limit, lookup and composed searches over the given vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lumisift.checks import oracle_views as v
from lumisift.checks.fixtures import FEATURE, FIELD, documents_index, signed, vectors
from lumisift.checks.registry import query
from lumisift.functions import hashing
from lumisift.functions.scoring import explanation, score_of
from lumisift.functions.sql import register_search, register_sql_functions
from lumisift.functions.vectors import bytes_to_vector, distance, int_literal, vector_to_bytes
from lumisift.plans import search
from lumisift.plans.request import ImageQuery

QUERY_DOC = 0
LIMIT = 20


def request(table: DataFrame, doc_id: int = QUERY_DOC, **params) -> ImageQuery:
    """A request for documents like a stored one; its type is read from the index."""
    row = table.filter(F.col("doc_id") == doc_id).select("type").limit(1).head()
    return ImageQuery(field=FIELD, feature=FEATURE, type=row.type, id=doc_id, path=FIELD, **params)


def query_vec(index: DataFrame, doc_id: int = QUERY_DOC) -> list[int]:
    return search.query_vector(index, request(index, doc_id))


def result(hits: DataFrame, *columns: str) -> DataFrame:
    return hits.select("doc_id", *columns, "distance", "score")


SCAN = f"WITH {v.VECTORS}, {v.pairs()}"


@query("q1_scan_cosine_topk", f"""{SCAN}
SELECT doc_id, cosine AS distance, {v.score('cosine')} AS score FROM dist
ORDER BY score DESC, doc_id LIMIT 10""")
def scan_topk(spark: SparkSession, sf: str) -> DataFrame:
    index = vectors(spark, sf)
    return result(search.top_hits(search.image_search(index, request(index)), 10))


@query("q1_scan_l2_all", f"""{SCAN} SELECT doc_id, l2 AS distance, {v.score('l2')} AS score FROM dist""")
def scan_l2(spark: SparkSession, sf: str) -> DataFrame:
    index = vectors(spark, sf)
    return result(search.image_search(index, request(index), metric="l2"))


@query("f2_score_branches", f"""{SCAN}
SELECT cosine <= 1 AS near, count(*) AS docs, min({v.score('cosine')}) AS low, max({v.score('cosine')}) AS high
FROM dist GROUP BY 1""")
def score_branches(spark: SparkSession, sf: str) -> DataFrame:
    index = vectors(spark, sf)
    hits = search.image_search(index, request(index))
    return hits.groupBy((F.col("distance") <= 1).alias("near")).agg(
        F.count(F.lit(1)).alias("docs"), F.min("score").alias("low"), F.max("score").alias("high")
    )


@query("f3_boost", f"""{SCAN}
SELECT doc_id, cosine AS distance, {v.score('cosine', 2.1)} AS score FROM dist ORDER BY score DESC, doc_id LIMIT 50""")
def boosted(spark: SparkSession, sf: str) -> DataFrame:
    index = vectors(spark, sf)
    return result(search.top_hits(search.image_search(index, request(index, boost=2.1)), 50))


@query("f4_missing_distance", f"""{SCAN}, zeroed AS (
  SELECT doc_id, CASE WHEN doc_id % 7 = 3 THEN NULL WHEN doc_id % 7 = 4 THEN 'NaN'::DOUBLE
    WHEN doc_id % 7 = 5 THEN 'Infinity'::DOUBLE ELSE cosine END AS distance FROM dist)
SELECT doc_id, isnan(s) AS not_a_number, CASE WHEN isnan(s) THEN NULL ELSE s END AS score
FROM (SELECT doc_id, CASE WHEN distance IS NULL THEN NULL ELSE {v.score('distance')} END AS s FROM zeroed)
WHERE s IS NOT NULL""")
def missing_distance(spark: SparkSession, sf: str) -> DataFrame:
    index = vectors(spark, sf)
    kind = F.pmod("doc_id", F.lit(7))
    d = (
        F.when(kind == 3, F.lit(None).cast("double"))
        .when(kind == 4, F.lit(float("nan")))
        .when(kind == 5, F.lit(float("inf")))
        .otherwise(distance("cosine", F.col("vec"), int_literal(query_vec(index))))
    )
    scores = index.select("doc_id", score_of(d).alias("s")).filter(F.col("s").isNotNull())
    return scores.select(
        "doc_id", F.isnan("s").alias("not_a_number"), F.when(~F.isnan("s"), F.col("s")).alias("score")
    )


@query("f6_scored_once", f"""WITH {v.SIGNATURES}, {v.pairs()}, {v.OVERLAP}
SELECT doc_id, {v.score('cosine')} AS score, 1 AS times FROM dist WHERE doc_id IN (SELECT doc_id FROM ov)""")
def scored_once(spark: SparkSession, sf: str) -> DataFrame:
    index = signed(spark, sf)
    hits = search.image_search(index, request(index, hash="BIT_SAMPLING"))
    return hits.groupBy("doc_id").agg(F.sum("score").alias("score"), F.count(F.lit(1)).cast("int").alias("times"))


@query("f7_explain", f"""WITH {v.SIGNATURES}, {v.pairs()}, {v.OVERLAP}
SELECT d.doc_id, true AS matched, {v.score('d.cosine', 2.0)} AS value, 2.0::DOUBLE AS boost,
  {v.score('d.cosine', 2.0)} / 2.0::DOUBLE AS image_score, 'score of the image times the boost' AS description
FROM dist d JOIN ov o ON o.doc_id = d.doc_id""")
def explain(spark: SparkSession, sf: str) -> DataFrame:
    index = signed(spark, sf)
    hits = search.image_search(index, request(index, hash="BIT_SAMPLING", boost=2.0), explain=True)
    return hits.select("doc_id", "explanation.*")


@query("f8_scores_comparable", f"""WITH {v.VECTORS}, {v.pairs('q.doc_id IN (0, 1)')}
SELECT query_id, count(*) AS docs, max({v.score('cosine')}) AS max_score, sum(CASE WHEN cosine <= 1 THEN 1 ELSE 0 END)::BIGINT AS near
FROM dist GROUP BY 1""")
def comparable(spark: SparkSession, sf: str) -> DataFrame:
    index = vectors(spark, sf)
    out = None
    for doc_id in (0, 1):
        hits = search.image_search(index, request(index, doc_id)).agg(
            F.count(F.lit(1)).alias("docs"),
            F.max("score").alias("max_score"),
            F.sum(F.when(F.col("distance") <= 1, 1).otherwise(0)).alias("near"),
        ).select(F.lit(doc_id).cast("bigint").alias("query_id"), "*")
        out = hits if out is None else out.unionByName(hits)
    return out


@query("q20_hits_summary", f"""{SCAN} SELECT count(*) AS total_hits, max({v.score('cosine', 2.0)}) AS max_score FROM dist""")
def summary(spark: SparkSession, sf: str) -> DataFrame:
    index = vectors(spark, sf)
    return search.hits_summary(search.image_search(index, request(index, boost=2.0)))


def _metric_query(metric: str) -> None:
    sql = {"l1": "l1::DOUBLE"}.get(metric, metric)

    @query(f"f1_{metric}", f"{SCAN} SELECT doc_id, {sql} AS distance FROM dist")
    def run(spark: SparkSession, sf: str) -> DataFrame:
        index = vectors(spark, sf)
        return index.select("doc_id", distance(metric, F.col("vec"), int_literal(query_vec(index))).alias("distance"))


for _metric in ("l1", "l2", "cosine", "tanimoto"):
    _metric_query(_metric)


@query("f1_jsd", f"""WITH {v.VECTORS}, shifted AS (SELECT doc_id, i, v + 10000 AS v FROM ql),
  sums AS (SELECT doc_id, sum(v)::DOUBLE AS s FROM shifted GROUP BY 1),
  prob AS (SELECT s.doc_id, i, v::DOUBLE / t.s AS p FROM shifted s JOIN sums t ON t.doc_id = s.doc_id)
SELECT a.doc_id, round(sum(CASE WHEN a.p > 0 THEN a.p * ln(2.0 * a.p / (a.p + b.p)) ELSE 0 END
  + CASE WHEN b.p > 0 THEN b.p * ln(2.0 * b.p / (a.p + b.p)) ELSE 0 END) / 2.0, 6) AS distance
FROM prob a JOIN prob b ON a.i = b.i AND b.doc_id = 0 GROUP BY 1""")
def metric_jsd(spark: SparkSession, sf: str) -> DataFrame:
    """Histograms are non-negative, so the vectors are shifted up first."""
    index = vectors(spark, sf).withColumn("vec", F.transform("vec", lambda x: x + 10000))
    return index.select("doc_id", distance("jsd", F.col("vec"), int_literal(query_vec(index))).alias("distance"))


@query("d20_codec_roundtrip", f"""WITH {v.VECTORS}
SELECT doc_id, count(*) * 8 AS n_bytes, true AS same, sum(v)::BIGINT AS total FROM ql GROUP BY 1""")
def codec(spark: SparkSession, sf: str) -> DataFrame:
    packed = vectors(spark, sf).select("doc_id", "vec", vector_to_bytes(F.col("vec")).alias("payload"))
    back = bytes_to_vector(F.col("payload"))
    return packed.select(
        "doc_id",
        F.length("payload").cast("bigint").alias("n_bytes"),
        (back == F.col("vec")).alias("same"),
        F.aggregate(back, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"),
    )


# --- hashing -------------------------------------------------------------------------------------


@query("h1_bit_sampling", f"WITH {v.SIGNATURES} SELECT doc_id, bundle, h FROM sig")
def bit_sampling(spark: SparkSession, sf: str) -> DataFrame:
    return hashing.postings(signed(spark, sf), "BIT_SAMPLING", ["doc_id"]).select("doc_id", "bundle", "h")


@query("h2_lsh", f"WITH {v.LSH} SELECT doc_id, bundle, h FROM lsh")
def lsh(spark: SparkSession, sf: str) -> DataFrame:
    return hashing.postings(signed(spark, sf, "LSH"), "LSH", ["doc_id"]).select("doc_id", "bundle", "h")


@query("h4_terms_roundtrip", f"""WITH {v.LSH}
SELECT doc_id, string_agg(CAST(h AS VARCHAR), ' ' ORDER BY bundle) AS terms, true AS same FROM lsh GROUP BY 1""")
def terms(spark: SparkSession, sf: str) -> DataFrame:
    index = signed(spark, sf, "LSH").select("doc_id", "sig_lsh", hashing.terms(F.col("sig_lsh")).alias("terms"))
    return index.select("doc_id", "terms", (hashing.parse_terms(F.col("terms")) == F.col("sig_lsh")).alias("same"))


@query("h5_position_free", f"""WITH {v.SIGNATURES}
SELECT d.doc_id, count(*) AS matches, count(*) FILTER (d.bundle = q.bundle) AS same_bundle
FROM sig q JOIN sig d ON d.h = q.h WHERE q.doc_id = 0 GROUP BY 1""")
def position_free(spark: SparkSession, sf: str) -> DataFrame:
    """Posting matches of one query with and without regard to the bundle."""
    index = signed(spark, sf)
    hashes = search.query_signature("BIT_SAMPLING", query_vec(index))
    rows = hashing.postings(index, "BIT_SAMPLING", ["doc_id"]).filter(F.col("h").isin(sorted(set(hashes))))
    times = F.size(F.filter(int_literal(hashes), lambda x: x == F.col("h"))).cast("bigint")
    same = F.when(F.get(int_literal(hashes), F.col("bundle").cast("int")) == F.col("h"), 1).otherwise(0)
    return rows.groupBy("doc_id").agg(F.sum(times).alias("matches"), F.sum(same).alias("same_bundle"))


@query("h6_two_hash_modes", f"""WITH {v.SIGNATURES}, {v.LSH.removeprefix(v.VECTORS).lstrip(', ').lstrip(',')}
SELECT mode AS hash_mode, count(*) AS n, count(DISTINCT h) AS distinct_h, min(h) AS low, max(h) AS high FROM (
  SELECT 'BIT_SAMPLING' AS mode, h FROM sig UNION ALL SELECT 'LSH', h FROM lsh) GROUP BY 1""")
def two_modes(spark: SparkSession, sf: str) -> DataFrame:
    both = hashing.with_signature(signed(spark, sf), "LSH")
    rows = both.select(
        F.explode(
            F.array(*[
                F.struct(F.lit(m).alias("hash_mode"), F.col(hashing.signature_column(m)).alias("sig")) for m in hashing.MODES
            ])
        ).alias("m")
    ).select("m.hash_mode", F.explode("m.sig").alias("h"))
    return rows.groupBy("hash_mode").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("h").alias("distinct_h"), F.min("h").alias("low"), F.max("h").alias("high")
    )


# --- hash search ---------------------------------------------------------------------------------

HASHED = f"WITH {v.SIGNATURES}, {v.pairs()}, {v.OVERLAP}"
HIT = f"d.doc_id, d.cosine AS distance, {v.score('d.cosine')} AS score"


@query("q2_hash_search", f"{HASHED} SELECT {HIT} FROM dist d JOIN ov ON ov.doc_id = d.doc_id")
def hash_search(spark: SparkSession, sf: str) -> DataFrame:
    index = signed(spark, sf)
    return result(search.image_search(index, request(index, hash="BIT_SAMPLING")))


def posting_table(index: DataFrame, mode: str = "BIT_SAMPLING") -> DataFrame:
    return hashing.postings(index, mode, ["doc_id", "shard", "field", "feature"])


@query("q2_hash_search_postings", f"{HASHED} SELECT {HIT} FROM dist d JOIN ov ON ov.doc_id = d.doc_id")
def hash_search_postings(spark: SparkSession, sf: str) -> DataFrame:
    index = vectors(spark, sf)
    found = search.image_search(index, request(index, hash="BIT_SAMPLING"), postings=posting_table(signed(spark, sf)))
    return result(found)


@query("q2_bundle_aware", f"""{HASHED} SELECT {HIT} FROM dist d WHERE d.doc_id IN (
  SELECT s.doc_id FROM sig s JOIN sig q ON q.doc_id = 0 AND q.bundle = s.bundle AND q.h = s.h)""")
def bundle_aware(spark: SparkSession, sf: str) -> DataFrame:
    index = signed(spark, sf)
    return result(search.image_search(index, request(index, hash="BIT_SAMPLING"), bundle_aware=True))


@query("q2_hash_search_lsh", f"""WITH {v.LSH}, {v.pairs()}
SELECT {HIT} FROM dist d WHERE d.doc_id IN (
  SELECT s.doc_id FROM lsh s JOIN lsh q ON q.doc_id = 0 AND q.bundle = s.bundle AND q.h = s.h)""")
def hash_search_lsh(spark: SparkSession, sf: str) -> DataFrame:
    index = signed(spark, sf, "LSH")
    return result(search.image_search(index, request(index, hash="LSH"), bundle_aware=True))


@query("q3_hash_limit", f"""{HASHED}, best AS (SELECT doc_id FROM ov ORDER BY overlap DESC, doc_id LIMIT {LIMIT})
SELECT {HIT} FROM dist d JOIN best ON best.doc_id = d.doc_id""")
def hash_limit(spark: SparkSession, sf: str) -> DataFrame:
    index = signed(spark, sf)
    return result(search.image_search(index, request(index, hash="BIT_SAMPLING", limit=LIMIT), per_shard=False))


@query("q3_hash_limit_postings", f"""{HASHED}, best AS (SELECT doc_id FROM ov ORDER BY overlap DESC, doc_id LIMIT {LIMIT})
SELECT {HIT} FROM dist d JOIN best ON best.doc_id = d.doc_id""")
def hash_limit_postings(spark: SparkSession, sf: str) -> DataFrame:
    index = vectors(spark, sf)
    asked = request(index, hash="BIT_SAMPLING", limit=LIMIT)
    return result(search.image_search(index, asked, postings=posting_table(signed(spark, sf)), per_shard=False))


@query("q4_overlap", f"""WITH {v.SIGNATURES}, asked AS (
  SELECT h FROM sig WHERE doc_id = 0 UNION ALL SELECT h FROM sig WHERE doc_id = 0 AND bundle < 10)
SELECT d.doc_id, count(*) AS overlap FROM asked q JOIN (SELECT DISTINCT doc_id, h FROM sig) d ON d.h = q.h GROUP BY 1""")
def overlap(spark: SparkSession, sf: str) -> DataFrame:
    """Repeated query hashes count again, repeated document hashes do not."""
    index = signed(spark, sf)
    hashes = search.query_signature("BIT_SAMPLING", query_vec(index))
    counted = index.select("doc_id", search.overlap(F.col("sig_bit_sampling"), hashes + hashes[:10]).alias("overlap"))
    return counted.filter(F.col("overlap") > 0)


PER_SHARD = f"""best AS (SELECT o.doc_id, shard, row_number() OVER (PARTITION BY shard ORDER BY overlap DESC, o.doc_id) AS r
  FROM ov o JOIN doc ON doc.doc_id = o.doc_id)"""


@query("q5_per_shard_limit", f"""{HASHED}, {PER_SHARD}
SELECT d.doc_id, best.shard, d.cosine AS distance, {v.score('d.cosine')} AS score
FROM dist d JOIN best ON best.doc_id = d.doc_id AND r <= {LIMIT}""")
def per_shard(spark: SparkSession, sf: str) -> DataFrame:
    index = signed(spark, sf)
    return result(search.image_search(index, request(index, hash="BIT_SAMPLING", limit=LIMIT)), "shard")


LIMIT_THEN = f"""{HASHED}, best AS (SELECT doc_id FROM ov ORDER BY overlap DESC, doc_id LIMIT {LIMIT})
SELECT {HIT} FROM dist d JOIN best ON best.doc_id = d.doc_id JOIN doc ON doc.doc_id = d.doc_id AND doc.type = 't1'"""
FILTER_THEN = f"""{HASHED}, best AS (SELECT ov.doc_id FROM ov JOIN doc ON doc.doc_id = ov.doc_id AND doc.type = 't1'
  ORDER BY overlap DESC, ov.doc_id LIMIT {LIMIT})
SELECT {HIT} FROM dist d JOIN best ON best.doc_id = d.doc_id"""


@query("q6_limit_then_filter", LIMIT_THEN)
def limit_then_filter(spark: SparkSession, sf: str) -> DataFrame:
    index = signed(spark, sf)
    asked = request(index, hash="BIT_SAMPLING", limit=LIMIT)
    return result(search.image_search(index, asked, per_shard=False, where=F.col("type") == "t1"))


@query("q6_filter_then_limit", FILTER_THEN)
def filter_then_limit(spark: SparkSession, sf: str) -> DataFrame:
    index = signed(spark, sf)
    asked = request(index, hash="BIT_SAMPLING", limit=LIMIT)
    return result(search.image_search(index, asked, per_shard=False, pre_filter=F.col("type") == "t1"))


@query("q7_no_candidates", f"{HASHED} SELECT {HIT} FROM dist d JOIN ov ON ov.doc_id = d.doc_id WHERE false")
def no_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Hashes outside the range of the family match nothing and keep the schema."""
    index = signed(spark, sf)
    rows = search.hash_candidates(search.clause_rows(index, FIELD, FEATURE), "BIT_SAMPLING", [-1, 1 << 20], limit=LIMIT)
    return result(search.scored(rows, query_vec(index), "cosine"))


@query("q8_limit_not_positive", f"{HASHED} SELECT {HIT} FROM dist d JOIN ov ON ov.doc_id = d.doc_id")
def limit_not_positive(spark: SparkSession, sf: str) -> DataFrame:
    index = signed(spark, sf)
    return result(search.image_search(index, request(index, hash="bit_sampling", limit=0)))


@query("q8_limit_without_hash", f"{SCAN} SELECT d.doc_id, d.cosine AS distance, {v.score('d.cosine')} AS score FROM dist d")
def limit_without_hash(spark: SparkSession, sf: str) -> DataFrame:
    index = vectors(spark, sf)
    return result(search.image_search(index, request(index, limit=5)))


@query("q26_unmapped_hash", f"{SCAN} SELECT doc_id, cosine AS distance, {v.score('cosine')} AS score FROM dist WHERE false")
def unmapped_hash(spark: SparkSession, sf: str) -> DataFrame:
    index = vectors(spark, sf)
    return result(search.image_search(index, request(index, hash="LSH"), missing="empty"))


# --- lookup and composition ----------------------------------------------------------------------


@query("q10_by_doc", f"""WITH {v.VECTORS}, {v.pairs('q.doc_id = 7')}
SELECT doc_id, cosine AS distance, {v.score('cosine')} AS score FROM dist""")
def by_doc(spark: SparkSession, sf: str) -> DataFrame:
    index = vectors(spark, sf)
    return result(search.image_search(index, request(index, 7)))


@query("q11_cross_index", f"""WITH {v.VECTORS}, first_a AS (SELECT min(doc_id) AS id FROM doc WHERE idx = 'a'),
  {v.pairs('q.doc_id = (SELECT id FROM first_a)')}
SELECT d.doc_id, d.cosine AS distance, {v.score('d.cosine')} AS score FROM dist d JOIN doc ON doc.doc_id = d.doc_id AND doc.idx = 'b'""")
def cross_index(spark: SparkSession, sf: str) -> DataFrame:
    """The query document lives in index ``a``, the search runs over index ``b``."""
    index = vectors(spark, sf)
    stored = index.filter(F.col("index") == "a")
    first = stored.agg(F.min("doc_id").alias("id")).head().id
    asked = request(stored, first, index="a")
    return result(search.image_search(index.filter(F.col("index") == "b"), asked, lookup=stored))


NAMED = f"WITH {v.DOCS}, {v.pairs()}"


@query("q15_must_term", f"""{NAMED} SELECT d.doc_id, f.name, d.cosine AS distance, {v.score('d.cosine')} AS score
FROM dist d JOIN full_doc f ON f.doc_id = d.doc_id WHERE f.name = (SELECT name FROM full_doc WHERE doc_id = 0)""")
def must_term(spark: SparkSession, sf: str) -> DataFrame:
    index = documents_index(spark, sf)
    name = index.filter(F.col("doc_id") == 0).select("name").head().name
    return result(search.image_search(index, request(index), pre_filter=F.col("name") == name), "name")


@query("q16_metadata_term", f"""{NAMED} SELECT d.doc_id, f.lang, d.cosine AS distance, {v.score('d.cosine')} AS score
FROM dist d JOIN full_doc f ON f.doc_id = d.doc_id WHERE f.lang = 'en'""")
def metadata_term(spark: SparkSession, sf: str) -> DataFrame:
    index = documents_index(spark, sf)
    hits = search.image_search(index, request(index), where=F.element_at("meta", "document.lang") == "en")
    return result(hits.withColumn("lang", F.element_at("meta", "document.lang")), "lang")


@query("q17_should_sum", f"""WITH {v.SIGNATURES}, {v.pairs('q.doc_id IN (0, 1)')}
SELECT doc_id, sum(score) AS score, count(*) AS clauses FROM (
  SELECT d.doc_id, {v.score('d.cosine')} AS score FROM dist d WHERE EXISTS (
    SELECT 1 FROM sig a JOIN sig b ON a.h = b.h WHERE a.doc_id = d.query_id AND b.doc_id = d.doc_id)) GROUP BY 1""")
def should_sum(spark: SparkSession, sf: str) -> DataFrame:
    index = signed(spark, sf)
    clauses = [search.image_search(index, request(index, i, hash="BIT_SAMPLING")) for i in (0, 1)]
    return search.should(*clauses)


@query("q19_type_filter", f"""WITH {v.VECTORS}, {v.pairs()} SELECT d.doc_id, doc.type, d.cosine AS distance, {v.score('d.cosine')} AS score
FROM dist d JOIN doc ON doc.doc_id = d.doc_id WHERE doc.type = 't0'""")
def type_filter(spark: SparkSession, sf: str) -> DataFrame:
    index = vectors(spark, sf)
    return result(search.image_search(index, request(index), pre_filter=F.col("type") == "t0"), "type")


@query("q21_projection", f"""{NAMED} SELECT d.doc_id, f.name, f.n_chars, {v.score('d.cosine')} AS score
FROM dist d JOIN full_doc f ON f.doc_id = d.doc_id ORDER BY score DESC, d.doc_id LIMIT 25""")
def projection(spark: SparkSession, sf: str) -> DataFrame:
    index = documents_index(spark, sf)
    return search.top_hits(search.image_search(index, request(index)), 25).select("doc_id", "name", "n_chars", "score")


@query("u2_sql_functions", f"""{SCAN} SELECT doc_id, l2 AS distance, {v.score('l2', 1.5)} AS score FROM dist""")
def sql_functions(spark: SparkSession, sf: str) -> DataFrame:
    register_sql_functions(spark)
    index = vectors(spark, sf)
    rows = index.select("doc_id", F.call_function("img_distance", F.lit("l2"), "vec", int_literal(query_vec(index))).alias("distance"))
    return rows.withColumn("score", F.call_function("img_score", "distance", F.lit(1.5)))


@query("u2_sql_search", f"""{HASHED}, best AS (SELECT doc_id, overlap FROM ov ORDER BY overlap DESC, doc_id LIMIT {LIMIT})
SELECT {HIT}, best.overlap, {v.score('d.cosine', 2.0)} AS boosted FROM dist d JOIN best ON best.doc_id = d.doc_id""")
def sql_search(spark: SparkSession, sf: str) -> DataFrame:
    """A hash search with a candidate limit, written in SQL."""
    index = signed(spark, sf)
    register_search(spark, index, hash="BIT_SAMPLING")
    vec = query_vec(index)
    hashes = search.query_signature("BIT_SAMPLING", vec)
    text = lambda numbers: f"array({', '.join(f'{x}L' for x in numbers)})"
    return spark.sql(f"""SELECT doc_id, distance, explanation.image_score AS score, overlap, score AS boosted
        FROM img_search('{FIELD}', '{FEATURE}', {text(vec)}, {text(hashes)}, q_limit => {LIMIT}, q_boost => 2D)""")


ALL_METRICS = f"""WITH {v.VECTORS}, {v.pairs()}, shifted AS (SELECT doc_id, i, v + 10000 AS v FROM ql),
  sums AS (SELECT doc_id, sum(v)::DOUBLE AS s FROM shifted GROUP BY 1),
  prob AS (SELECT s.doc_id, i, v::DOUBLE / t.s AS p FROM shifted s JOIN sums t ON t.doc_id = s.doc_id),
  div AS (SELECT a.doc_id, round(sum(CASE WHEN a.p > 0 THEN a.p * ln(2.0 * a.p / (a.p + b.p)) ELSE 0 END
    + CASE WHEN b.p > 0 THEN b.p * ln(2.0 * b.p / (a.p + b.p)) ELSE 0 END) / 2.0, 6) AS jsd
    FROM prob a JOIN prob b ON a.i = b.i AND b.doc_id = 0 GROUP BY 1)"""


@query("u2_sql_all_metrics", f"""{ALL_METRICS}
SELECT dist.doc_id, l1::DOUBLE AS l1, l2, cosine, tanimoto, jsd FROM dist JOIN div ON div.doc_id = dist.doc_id""")
def sql_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Every metric of general vectors by its SQL name; the divergence takes the vectors shifted to histograms."""
    register_sql_functions(spark)
    index = vectors(spark, sf)
    vec = query_vec(index)
    by_name = {m: F.call_function("img_distance", F.lit(m), "vec", int_literal(vec)) for m in ("l1", "l2", "cosine", "tanimoto")}
    up = F.transform("vec", lambda x: x + 10000)
    by_name["jsd"] = F.call_function("img_distance", F.lit("jsd"), up, int_literal([x + 10000 for x in vec]))
    return index.select("doc_id", *(d.alias(m) for m, d in by_name.items()))
