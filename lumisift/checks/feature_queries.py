"""Search over each of the features, and searches on stored tables.

The oracle has each feature from pixel rows, fills the missing bins with zeros and takes the distance as sums over bins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lumisift.checks import oracle_views as v
from lumisift.checks.descriptor_queries import ORACLES as DESCRIPTOR_SQL, SMALL_TILES, px
from lumisift.checks.fixtures import signed, tiles32, vectors, with_png
from lumisift.checks.ingest_queries import tile_index
from lumisift.checks.registry import query
from lumisift.checks.search_queries import HASHED, HIT, posting_table, request, result
from lumisift.operators.index import index_documents
from lumisift.operators.registry import feature
from lumisift.plans import search
from lumisift.plans.request import ImageQuery
from lumisift.session import shared_folder
from lumisift.sources import sinks
from lumisift.sources.mapping import ImageMapping

QUERY_IMAGE = 1
HALF = "CASE WHEN {0} > 0 THEN {0} * ln(2.0::DOUBLE * {0} / ({0} + {1})) ELSE 0.0::DOUBLE END"
# Weights of the twelve colour layout coefficients and the scale of a coefficient.
LAYOUT = "(VALUES (0,3.0),(1,3.0),(2,3.0),(3,1.0),(4,1.0),(5,1.0),(6,2.0),(7,1.0),(8,1.0),(9,4.0),(10,2.0),(11,2.0)) w(bin, wt)"
DISTANCES = {
    "l1": "SELECT doc_id, sum(abs(x - y)) AS d FROM cell GROUP BY 1",
    "l2": "SELECT doc_id, sqrt(sum((x - y) * (x - y))) / 10000.0::DOUBLE AS d FROM cell GROUP BY 1",
    "tanimoto": """SELECT doc_id, CASE WHEN sum(x * x) = 0 AND sum(y * y) = 0 THEN 0.0::DOUBLE
      WHEN sum(x * x) = 0 OR sum(y * y) = 0 THEN 100.0::DOUBLE
      ELSE 100.0::DOUBLE * (1.0::DOUBLE - sum(x * y) / (sum(x * x) + sum(y * y) - sum(x * y))) END AS d FROM cell GROUP BY 1""",
    "jsd": f"""SELECT doc_id, round(sum({HALF.format('p', 'r')} + {HALF.format('r', 'p')}) / 2.0::DOUBLE, 6) AS d FROM (
      SELECT doc_id, x / sum(x) OVER (PARTITION BY doc_id) AS p, y / sum(y) OVER (PARTITION BY doc_id) AS r FROM cell) GROUP BY 1""",
    "layout": f"""SELECT doc_id, round(sum(sqrt(s)), 6) AS d FROM (
      SELECT doc_id, CASE WHEN cell.bin < 6 THEN 0 WHEN cell.bin < 9 THEN 1 ELSE 2 END AS channel,
        sum(pow((x - y) / 8388608.0::DOUBLE, 2) * wt::DOUBLE) AS s
      FROM cell JOIN {LAYOUT} ON w.bin = cell.bin GROUP BY 1, 2) GROUP BY 1""",
}


def _feature_search(key: str) -> None:
    number, name = key.split("_", 1)
    kind = feature(name)
    exact = kind.metric in ("jsd", "layout")  # rounded distances, equal in both engines; of the others the last digits may differ
    shown = lambda sql: sql if exact else f"round({sql}, 4)"
    oracle = f"""WITH f AS ({DESCRIPTOR_SQL[key]}), asked AS (SELECT bin, value FROM f WHERE image_id = {QUERY_IMAGE}),
cell AS (SELECT e.vec_id AS doc_id, b.range AS bin, coalesce(f.value, 0)::DOUBLE AS x, coalesce(asked.value, 0)::DOUBLE AS y
  FROM embeddings e CROSS JOIN range({kind.dim}) b LEFT JOIN f ON f.image_id = e.vec_id AND f.bin = b.range LEFT JOIN asked ON asked.bin = b.range),
dist AS ({DISTANCES[kind.metric]})
SELECT doc_id, {shown('d')} AS distance, {shown(v.score('d'))} AS score FROM dist"""

    @query(f"q1_{name}", oracle)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        index = tile_index(spark, sf, [name], large=number not in SMALL_TILES).withColumn("type", F.lit("tile"))
        hits = search.image_search(index, ImageQuery(field="img", feature=name, type="tile", id=QUERY_IMAGE, path="img"))
        return hits.select("doc_id", *[(F.col(n) if exact else F.round(n, 4)).alias(n) for n in ("distance", "score")])


for _key in DESCRIPTOR_SQL:
    _feature_search(_key)


# --- from documents to stored tables -------------------------------------------------------------

DECLARED = {"CEDD": {"hash": ["BIT_SAMPLING", "LSH"]}, "FCTH": {}, "EDGE_HISTOGRAM": {"hash": "LSH"}, "COLOR_LAYOUT": {}, "SIMPLE_COLOR_HISTOGRAM": {}}
INDEXED = " UNION ALL ".join(
    f"SELECT image_id, '{name}' AS feature, bin, value FROM ({DESCRIPTOR_SQL[key].replace(px(8), px(32))})"
    for key in DESCRIPTOR_SQL for name in (key.split("_", 1)[1].upper(),) if name in DECLARED
)
SIGNED = ", ".join(f"('{name}', {len(options['hash']) if isinstance(options.get('hash'), list) else int('hash' in options)})" for name, options in DECLARED.items())


@query("s8_index_documents", f"""WITH f AS ({INDEXED}), signed(feature, modes) AS (VALUES {SIGNED}),
sums AS (SELECT image_id, feature, sum(value * (bin + 1)) AS checksum FROM f GROUP BY 1, 2)
SELECT d.vec_id AS doc_id, s.feature, coalesce(sums.checksum, 0)::BIGINT AS checksum, s.modes * 50 AS postings, 'tile ' || d.vec_id % 7 AS title
FROM embeddings d CROSS JOIN signed s LEFT JOIN sums ON sums.image_id = d.vec_id AND sums.feature = s.feature""")
def index_all(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with an embedded image go in; features, hashes and postings come out, with one decode."""
    sent = with_png(tiles32(spark, sf)).select(
        F.col("image_id").alias("doc_id"), F.concat(F.lit("tile "), F.col("image_id") % 7).alias("title"), F.base64("png").alias("photo")
    )
    tags = spark.createDataFrame([], "doc_id bigint, directory string, tag_name string, description string")
    made = index_documents(sent, tags, "photo", ImageMapping.parse("photo", {"feature": DECLARED}), ["photo"], features_path=shared_folder(spark, "features"))
    weighted = F.zip_with("vec", F.sequence(F.lit(1), F.size("vec")), lambda x, at: x * at)
    posted = made.postings.groupBy("doc_id", "feature").agg(F.count(F.lit(1)).cast("int").alias("postings"))
    rows = made.index.select("doc_id", "title", "feature", F.aggregate(weighted, F.lit(0).cast("bigint"), lambda acc, x: acc + x).alias("checksum"))
    rows = rows.join(posted, ["doc_id", "feature"], "left")
    return rows.select("doc_id", "feature", "checksum", F.coalesce("postings", F.lit(0)).alias("postings"), "title")


def stored_index(spark: SparkSession, index: DataFrame) -> DataFrame:
    path = shared_folder(spark, "features")
    sinks.write_features(index, path)
    return spark.read.parquet(path)


@query("q2_stored_postings", f"{HASHED} SELECT {HIT} FROM dist d JOIN ov ON ov.doc_id = d.doc_id")
def stored_postings_search(spark: SparkSession, sf: str) -> DataFrame:
    """A hash search on tables as they lie on storage: postings by hash, features by document."""
    index = stored_index(spark, vectors(spark, sf))
    path = shared_folder(spark, "postings")
    name = "searched_" + path.rsplit("-", 1)[1]
    sinks.write_postings(posting_table(signed(spark, sf)), name, path, buckets=16)
    return result(search.image_search(index, request(index, hash="BIT_SAMPLING"), postings=spark.table(name)))


@query("q10_by_doc_stored", f"""WITH {v.VECTORS}, {v.pairs('q.doc_id = 7')}
SELECT doc_id, cosine AS distance, {v.score('cosine')} AS score FROM dist""")
def by_doc_stored(spark: SparkSession, sf: str) -> DataFrame:
    """The query document is read from a table laid out by document, which skips all row groups but one."""
    index = stored_index(spark, vectors(spark, sf))
    return result(search.image_search(index, request(index, 7)))
