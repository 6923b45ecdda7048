"""Ingest, storage, metadata and visibility over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lumisift.checks import oracle_views as v
from lumisift.checks.descriptor_queries import ORACLES as DESCRIPTOR_SQL, px
from lumisift.checks.fixtures import documents_index, page_tags, signed, table, tiles8, tiles32, vectors, with_png
from lumisift.checks.registry import query
from lumisift.checks.search_queries import posting_table, query_vec, request, result
from lumisift.operators import features, live, metadata
from lumisift.plans import search
from lumisift.plans.request import ImageQuery
from lumisift.session import shared_folder
from lumisift.sources import documents, images, sinks

# --- content -------------------------------------------------------------------------------------


def submitted(spark: SparkSession, sf: str) -> DataFrame:
    """Documents carrying their text as base64 content, some without content or with broken content."""
    text = F.base64(F.encode("text", "utf-8"))
    kind = F.col("doc_id") % 10
    content = F.when(kind == 3, F.lit("!!not base64!!")).when(kind == 4, F.lit(None).cast("string")).otherwise(text)
    return table(spark, sf, "documents").select("doc_id", content.alias("img"))


@query("s1_base64_content", """SELECT doc_id, CASE WHEN doc_id % 10 IN (3, 4) THEN NULL ELSE octet_length(encode(text))::BIGINT END AS n_bytes,
  CASE WHEN doc_id % 10 IN (3, 4) THEN NULL ELSE md5(text) END AS digest FROM documents""")
def base64_content(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents.with_content(submitted(spark, sf), "img")
    return docs.select("doc_id", F.length("content").cast("bigint").alias("n_bytes"), F.md5("content").alias("digest"))


@query("s2_quarantine", """SELECT CASE WHEN doc_id % 10 = 4 THEN 'the document carries no image' WHEN doc_id % 10 = 3
  THEN 'the image is not base64' ELSE 'accepted' END AS outcome, count(*) AS docs FROM documents GROUP BY 1""")
def quarantine(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents.with_content(submitted(spark, sf), "img")
    return docs.groupBy(F.coalesce("error", F.lit("accepted")).alias("outcome")).agg(F.count(F.lit(1)).alias("docs"))


@query("s3_decoded_images", f"""WITH {px(8)} SELECT image_id, CAST(max(w) AS INTEGER) AS w, CAST(max(h) AS INTEGER) AS h,
  CAST(sum(r * (1 + y * 8 + x)) AS BIGINT) AS r, CAST(sum(g * (1 + y * 8 + x)) AS BIGINT) AS g,
  CAST(sum(b * (1 + y * 8 + x)) AS BIGINT) AS b FROM px GROUP BY 1""")
def decoded_images(spark: SparkSession, sf: str) -> DataFrame:
    """Tiles encoded as images in base64, decoded again; position-weighted sums pin every pixel."""
    sent = with_png(tiles8(spark, sf)).select("image_id", F.base64("png").alias("img"))
    planes = images.decode_images(documents.accepted(documents.with_content(sent, "img")))

    def weighted(channel: str):
        return F.aggregate(
            F.zip_with(channel, F.sequence(F.lit(1), F.size(channel)), lambda value, at: (value * at).cast("bigint")),
            F.lit(0).cast("bigint"), lambda acc, x: acc + x,
        ).alias(channel)

    return planes.select("image_id", "w", "h", *[weighted(ch) for ch in ("r", "g", "b")])


@query("s4_resize", f"""WITH {px(32)} SELECT image_id, 12 AS w, 12 AS h, CAST(x * 12 // 32 AS INTEGER) AS x, CAST(y * 12 // 32 AS INTEGER) AS y,
  CAST(CAST(sum(r) AS BIGINT) // count(*) AS INTEGER) AS r, CAST(CAST(sum(g) AS BIGINT) // count(*) AS INTEGER) AS g,
  CAST(CAST(sum(b) AS BIGINT) // count(*) AS INTEGER) AS b FROM px GROUP BY ALL""")
def resize(spark: SparkSession, sf: str) -> DataFrame:
    from lumisift.operators.stencils import pixels

    small = images.cap_size(tiles32(spark, sf), 12)
    return pixels(small, {ch: F.col(ch) for ch in ("r", "g", "b")})


# --- features ------------------------------------------------------------------------------------

FUSED = {"CEDD": "d14_cedd", "EDGE_HISTOGRAM": "d08_edge_histogram", "FCTH": "d15_fcth", "JCD": "d16_jcd"}


def labelled(names: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT image_id, '{name}' AS feature, bin, value FROM ({DESCRIPTOR_SQL[key]})" for name, key in names.items()
    )


@query("s8_extract_features", labelled(FUSED))
def extract_features(spark: SparkSession, sf: str) -> DataFrame:
    """Four features from one pass over the blocks of each image."""
    return features.extract(tiles32(spark, sf), FUSED)


@query("s9_stored_features", f"""WITH {v.VECTORS} SELECT doc_id, count(*) AS dim, CAST(sum(v * (i + 1)) AS BIGINT) AS checksum FROM ql GROUP BY 1""")
def stored_features(spark: SparkSession, sf: str) -> DataFrame:
    """Written partitioned by feature, read back through the partition filter."""
    path = shared_folder(spark, "features")
    sinks.write_features(vectors(spark, sf), path)
    stored = spark.read.parquet(path).filter(F.col("feature") == "EMBEDDING")
    weighted = F.zip_with("vec", F.sequence(F.lit(1), F.size("vec")), lambda x, at: x * at)
    return stored.select(
        "doc_id", F.size("vec").cast("bigint").alias("dim"),
        F.aggregate(weighted, F.lit(0).cast("bigint"), lambda acc, x: acc + x).alias("checksum"),
    )


@query("s10_stored_postings", f"""WITH {v.SIGNATURES} SELECT d.doc_id, d.bundle, d.h FROM sig d
WHERE d.h IN (SELECT h FROM sig WHERE doc_id = 0)""")
def stored_postings(spark: SparkSession, sf: str) -> DataFrame:
    """A bucketed posting table; the search reads the buckets of its hashes only."""
    index = signed(spark, sf)
    path = shared_folder(spark, "postings")
    name = "postings_" + path.rsplit("-", 1)[1]
    sinks.write_postings(posting_table(index), name, path, buckets=16)
    hashes = search.query_signature("BIT_SAMPLING", query_vec(vectors(spark, sf)))
    wanted = (F.col("feature") == "EMBEDDING") & (F.col("hash_mode") == "BIT_SAMPLING") & F.col("h").isin(sorted(set(hashes)))
    return spark.table(name).filter(wanted).select("doc_id", "bundle", "h")


@query("s11_source_exclusion", "SELECT doc_id, lang, source, n_chars FROM documents")
def source_exclusion(spark: SparkSession, sf: str) -> DataFrame:
    return documents.stored_source(table(spark, sf, "documents"), ["text"])


MULTI = ("SIMPLE_COLOR_HISTOGRAM", "LOCAL_BINARY_PATTERNS", "OPPONENT_HISTOGRAM")


@query("s12_multi_feature", f"""WITH f AS ({labelled(dict(zip(MULTI, ('d01_simple_color_histogram', 'd04_local_binary_patterns', 'd02_opponent_histogram'))))})
SELECT image_id, 64 AS simple_dim, 256 AS lbp_dim, 64 AS opponent_dim,
  CAST(sum(value) FILTER (feature = 'SIMPLE_COLOR_HISTOGRAM') AS BIGINT) AS simple_total,
  CAST(sum(value * bin) FILTER (feature = 'LOCAL_BINARY_PATTERNS') AS BIGINT) AS lbp_weighted,
  CAST(sum(value * bin) FILTER (feature = 'OPPONENT_HISTOGRAM') AS BIGINT) AS opponent_weighted FROM f GROUP BY 1""")
def multi_feature(spark: SparkSession, sf: str) -> DataFrame:
    """Dense vectors of three features side by side."""
    rows = features.wide(features.feature_table(tiles8(spark, sf), MULTI), MULTI)

    def weighted(name: str, first: int):
        places = F.sequence(F.lit(first), F.size(name) + F.lit(first - 1))
        return F.aggregate(F.zip_with(name, places, lambda x, at: x * at), F.lit(0).cast("bigint"), lambda acc, x: acc + x)

    total = F.aggregate(MULTI[0], F.lit(0).cast("bigint"), lambda acc, x: acc + x)
    return rows.select(
        "image_id", F.size(MULTI[0]).alias("simple_dim"), F.size(MULTI[1]).alias("lbp_dim"), F.size(MULTI[2]).alias("opponent_dim"),
        total.alias("simple_total"), weighted(MULTI[1], 0).alias("lbp_weighted"), weighted(MULTI[2], 0).alias("opponent_weighted"),
    )


@query("s13_missing_features", """SELECT d.doc_id, 'EMBEDDING' AS feature FROM documents d
WHERE d.doc_id NOT IN (SELECT vec_id FROM embeddings)""")
def missing(spark: SparkSession, sf: str) -> DataFrame:
    return features.missing_features(table(spark, sf, "documents"), vectors(spark, sf), ["embedding"])


@query("s17_backfill", f"""SELECT image_id, 64 AS dim, CAST(sum(value * (bin + 1)) AS BIGINT) AS checksum
FROM ({DESCRIPTOR_SQL['d01_simple_color_histogram']}) WHERE image_id NOT IN (SELECT doc_id FROM labels) GROUP BY 1""")
def backfilled(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents already have the feature; only the rest is computed."""
    existing = table(spark, sf, "labels").select(F.col("doc_id").alias("image_id"), F.lit("SIMPLE_COLOR_HISTOGRAM").alias("feature"))
    vecs = features.backfill(tiles8(spark, sf), existing, ["SIMPLE_COLOR_HISTOGRAM"])
    weighted = F.zip_with("vec", F.sequence(F.lit(1), F.size("vec")), lambda x, at: x * at)
    return vecs.select(
        "image_id", F.size("vec").alias("dim"), F.aggregate(weighted, F.lit(0).cast("bigint"), lambda acc, x: acc + x).alias("checksum")
    )


def tile_index(spark: SparkSession, sf: str, names: list[str], large: bool = False) -> DataFrame:
    tiles = tiles32(spark, sf) if large else tiles8(spark, sf)
    return features.feature_table(tiles, names).select(F.col("image_id").alias("doc_id"), F.lit("img").alias("field"), "feature", "vec")


@query("q9_new_image", f"""WITH lbp AS ({DESCRIPTOR_SQL['d04_local_binary_patterns']}),
docs AS (SELECT vec_id AS doc_id FROM embeddings), bins AS (SELECT range AS bin FROM range(256)),
d AS (SELECT docs.doc_id, CAST(sum(abs(coalesce(a.value, 0) - coalesce(b.value, 0))) AS DOUBLE) AS distance FROM docs, bins
  LEFT JOIN lbp a ON a.image_id = docs.doc_id AND a.bin = bins.bin LEFT JOIN lbp b ON b.image_id = 0 AND b.bin = bins.bin GROUP BY 1)
SELECT doc_id, distance, {v.score('distance')} AS score FROM d""")
def new_image(spark: SparkSession, sf: str) -> DataFrame:
    """The query is an encoded image, decoded and extracted like a stored one."""
    payload = with_png(tiles8(spark, sf).filter(F.col("image_id") == 0)).select("png").head().png
    index = tile_index(spark, sf, ["LOCAL_BINARY_PATTERNS"])
    return result(search.image_search(index, ImageQuery(field="img", feature="local_binary_patterns", image=bytes(payload))))


TWO = {"CEDD": "d14_cedd", "FCTH": "d15_fcth"}


@query("q18_multi_feature", f"""WITH f AS ({labelled(TWO)}), q AS (SELECT * FROM f WHERE image_id = 1),
norm AS (SELECT image_id, feature, sum(value * value) AS aa FROM f GROUP BY 1, 2),
prod AS (SELECT f.image_id, f.feature, sum(f.value * q.value) AS ab FROM f JOIN q ON q.feature = f.feature AND q.bin = f.bin GROUP BY 1, 2),
d AS (SELECT n.image_id, n.feature, 100.0::DOUBLE * (1.0::DOUBLE - coalesce(p.ab, 0)::DOUBLE / (n.aa + m.aa - coalesce(p.ab, 0))::DOUBLE) AS distance
  FROM norm n JOIN norm m ON m.image_id = 1 AND m.feature = n.feature LEFT JOIN prod p ON p.image_id = n.image_id AND p.feature = n.feature)
SELECT image_id AS doc_id, sum(CASE feature WHEN 'CEDD' THEN {v.score('distance', 2.0)} ELSE {v.score('distance', 0.5)} END) AS score,
  count(*) AS clauses FROM d GROUP BY 1""")
def multi_feature_search(spark: SparkSession, sf: str) -> DataFrame:
    """Two image clauses with their own boosts, summed per document in one scan."""
    index = tile_index(spark, sf, list(TWO), large=True).withColumn("type", F.lit("t"))
    asked = [ImageQuery(field="img", feature=f, type="t", id=1, path="img", boost=b) for f, b in (("CEDD", 2.0), ("FCTH", 0.5))]
    return search.multi_feature_search(index, [(q, search.query_vector(index, q)) for q in asked])


@query("f1_layout", f"""WITH cl AS ({DESCRIPTOR_SQL['d09_color_layout']}), bins AS (SELECT range AS bin FROM range(12)),
w(bin, wt) AS (VALUES (0,3.0),(1,3.0),(2,3.0),(3,1.0),(4,1.0),(5,1.0),(6,2.0),(7,1.0),(8,1.0),(9,4.0),(10,2.0),(11,2.0)),
part AS (SELECT e.vec_id AS doc_id, CASE WHEN bins.bin < 6 THEN 0 WHEN bins.bin < 9 THEN 1 ELSE 2 END AS ch,
  sum(pow((coalesce(a.value, 0) - coalesce(b.value, 0)) / 8388608.0::DOUBLE, 2) * w.wt::DOUBLE) AS s
  FROM embeddings e CROSS JOIN bins JOIN w ON w.bin = bins.bin LEFT JOIN cl a ON a.image_id = e.vec_id AND a.bin = bins.bin
  LEFT JOIN cl b ON b.image_id = 0 AND b.bin = bins.bin GROUP BY 1, 2)
SELECT doc_id, round(sum(sqrt(s)), 6) AS distance FROM part GROUP BY 1""")
def metric_layout(spark: SparkSession, sf: str) -> DataFrame:
    index = tile_index(spark, sf, ["COLOR_LAYOUT"], large=True).withColumn("type", F.lit("t"))
    asked = ImageQuery(field="img", feature="COLOR_LAYOUT", type="t", id=0, path="img")
    return search.image_search(index, asked).select("doc_id", "distance")


# --- metadata ------------------------------------------------------------------------------------

TAGS = """elem AS (
  SELECT page_id AS doc_id, unnest(regexp_extract_all(html, '<([a-zA-Z][a-zA-Z0-9]*)\\s+([^<>]*)>', 1)) AS directory,
    unnest(regexp_extract_all(html, '<([a-zA-Z][a-zA-Z0-9]*)\\s+([^<>]*)>', 2)) AS body FROM pages),
tags AS (
  SELECT doc_id, directory, unnest(regexp_extract_all(body, '([a-zA-Z-]+)="([^"]*)"', 1)) AS tag_name,
    unnest(regexp_extract_all(body, '([a-zA-Z-]+)="([^"]*)"', 2)) AS description FROM elem
  UNION ALL SELECT page_id, 'Page URL', 'Host Name', regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1) FROM pages
  UNION ALL SELECT page_id, 'Page URL', 'Scheme', regexp_extract(url, '^([a-z]+):', 1) FROM pages),
keyed AS (SELECT doc_id, regexp_replace(lower(directory), '\\s+', '_', 'g') || '.' || regexp_replace(lower(tag_name), '\\s+', '_', 'g') AS key,
  description FROM tags)"""
DECLARED = {"page_url.host_name": "string", "html.lang": "string", "a.href": "string"}
KEYS = ", ".join(f"'{k}'" for k in DECLARED)


@query("m1_normalise", f"WITH {TAGS} SELECT doc_id, key, description FROM keyed")
def normalise(spark: SparkSession, sf: str) -> DataFrame:
    return metadata.normalised(page_tags(spark, sf))


@query("m2_whitelist", f"WITH {TAGS} SELECT doc_id, key, description FROM keyed WHERE key IN ({KEYS})")
def whitelist(spark: SparkSession, sf: str) -> DataFrame:
    return metadata.declared_only(page_tags(spark, sf), list(DECLARED))


@query("m3_html_attrs", f"WITH {TAGS} SELECT directory, tag_name, count(*) AS tags, count(DISTINCT doc_id) AS docs FROM tags GROUP BY 1, 2")
def html_attributes(spark: SparkSession, sf: str) -> DataFrame:
    return page_tags(spark, sf).groupBy("directory", "tag_name").agg(
        F.count(F.lit(1)).alias("tags"), F.count_distinct("doc_id").alias("docs")
    )


def event_tags(spark: SparkSession, sf: str) -> DataFrame:
    """Metadata of events: the number in ``props`` and the event's kind, both as descriptions."""
    events = table(spark, sf, "events").select(F.col("event_id").alias("doc_id"), "event_type", "props")
    parsed = F.from_json("props", "k string")["k"]
    parts = F.array(
        F.struct(F.lit("Event").alias("directory"), F.lit("K").alias("tag_name"), parsed.alias("description")),
        F.struct(F.lit("Event").alias("directory"), F.lit("Kind").alias("tag_name"), F.col("event_type").alias("description")),
    )
    return events.select("doc_id", F.explode(parts).alias("t")).select("doc_id", "t.*")


@query("m4_typed", """SELECT event_id AS doc_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, event_type AS kind FROM events""")
def typed(spark: SparkSession, sf: str) -> DataFrame:
    columns = metadata.typed_columns(event_tags(spark, sf), {"event.k": "integer", "event.kind": "string"})
    return columns.select("doc_id", F.get("`event.k`", F.lit(0)).alias("k"), F.get("`event.kind`", F.lit(0)).alias("kind"))


@query("m5_multi_value", f"""WITH {TAGS} SELECT doc_id, key, count(*) AS n, string_agg(description, '|' ORDER BY description) AS vals
FROM keyed WHERE key IN ({KEYS}) GROUP BY 1, 2""")
def multi_value(spark: SparkSession, sf: str) -> DataFrame:
    rows = metadata.multi_valued(metadata.declared_only(page_tags(spark, sf), list(DECLARED)))
    return rows.select("doc_id", "key", F.size("values").cast("bigint").alias("n"), F.array_join("values", "|").alias("vals"))


@query("m6_metadata_errors", """SELECT 'event.k' AS key, count(*) AS rows_seen, 0::BIGINT AS errors FROM events
UNION ALL SELECT 'event.kind', count(*), count(*) FROM events""")
def metadata_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Both keys declared as numbers: every kind is an error, which is recorded and ignored."""
    declared = {"event.k": "integer", "event.kind": "integer"}
    rows = metadata.with_errors(metadata.declared_only(event_tags(spark, sf), list(declared)), declared)
    return rows.groupBy("key").agg(F.count(F.lit(1)).alias("rows_seen"), F.count("error").alias("errors"))


@query("m8_metadata_in_hits", f"""WITH {v.DOCS}, {v.pairs()} SELECT d.doc_id, {v.score('d.cosine')} AS score, f.lang, CAST(f.n_chars AS INTEGER) AS n_chars
FROM dist d JOIN full_doc f ON f.doc_id = d.doc_id ORDER BY score DESC, d.doc_id LIMIT 10""")
def metadata_in_hits(spark: SparkSession, sf: str) -> DataFrame:
    index = documents_index(spark, sf)
    hits = search.top_hits(search.image_search(index, request(index)), 10)
    return hits.select(
        "doc_id", "score", F.element_at("meta", "document.lang").alias("lang"),
        metadata.typed(F.element_at("meta", "document.n_chars"), "integer").alias("n_chars"),
    )


# --- visibility ----------------------------------------------------------------------------------


def versions(spark: SparkSession, sf: str) -> DataFrame:
    """Every vector at version 1, every fifth again at version 2 with its sign turned."""
    first = vectors(spark, sf).select("doc_id", F.lit(1).cast("bigint").alias("version"), "vec")
    second = first.filter(F.col("doc_id") % 5 == 0).select(
        "doc_id", F.lit(2).cast("bigint").alias("version"), F.transform("vec", lambda x: -x).alias("vec")
    )
    return first.unionByName(second)


def tombstones(spark: SparkSession, sf: str) -> DataFrame:
    return vectors(spark, sf).filter(F.col("doc_id") % 17 == 0).select("doc_id")


def live_sql(rule: str, where: str) -> str:
    return f"""WITH {v.VECTORS} SELECT doc_id, {rule} AS version,
  CAST(sum(v * (i + 1)) AS BIGINT) * CASE WHEN {rule} = 2 THEN -1 ELSE 1 END AS checksum FROM ql WHERE {where} GROUP BY 1, 2"""


def checksum(rows: DataFrame) -> DataFrame:
    weighted = F.zip_with("vec", F.sequence(F.lit(1), F.size("vec")), lambda x, at: x * at)
    return rows.select("doc_id", "version", F.aggregate(weighted, F.lit(0).cast("bigint"), lambda acc, x: acc + x).alias("checksum"))


@query("s14_live_docs", live_sql("CASE WHEN doc_id % 5 = 0 THEN 2::BIGINT ELSE 1::BIGINT END", "doc_id % 17 <> 0"))
def live_docs(spark: SparkSession, sf: str) -> DataFrame:
    return checksum(live.live(versions(spark, sf), tombstones(spark, sf), ["doc_id"]))


@query("s15_snapshot", live_sql("1::BIGINT", "true"))
def snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Before the refresh that makes version 2 visible."""
    return checksum(live.latest(live.as_of(versions(spark, sf), 1), ["doc_id"]))


