"""From documents with embedded images to searches, through one declared mapping and the given tiles."""

import base64

import pytest
from pyspark.sql import functions as F

from lumisift.checks.fixtures import encode_png, tiles32
from lumisift.operators.index import index_documents
from lumisift.plans import search
from lumisift.plans.request import ImageQuery
from lumisift.sources.mapping import parse_properties

SMALLEST = "/root/testdata/sf0.001"
COUNT = 20
MAPPING = {
    "_source": {"excludes": ["photo"]},
    "properties": {
        "photo": {
            "type": "image",
            "feature": {"edge_histogram": {"hash": "LSH"}, "GABOR": {"hash": ["LSH", "BIT_SAMPLING"]}, "TAMURA": {}},
            "metadata": {"sensor.gain": {"type": "integer"}},
        },
        "title": {"type": "string"},
    },
}


@pytest.fixture(scope="module")
def tiles(spark):
    rows = tiles32(spark, SMALLEST).filter(F.col("image_id") < COUNT).collect()
    return {r.image_id: encode_png(r.w, r.h, r.r, r.g, r.b) for r in rows}


@pytest.fixture(scope="module")
def outcome(spark, tiles):
    sent = [(i, f"tile {i % 4}", base64.b64encode(p).decode()) for i, p in tiles.items()] + [(100, "none", None), (101, "bad", "aGVsbG8=")]
    docs = spark.createDataFrame(sent, "doc_id bigint, title string, photo string")
    tags = spark.createDataFrame([(i, "Sensor", "Gain", str(i * 10)) for i in tiles], "doc_id bigint, directory string, tag_name string, description string")
    mappings, excludes = parse_properties(MAPPING)
    return index_documents(docs, tags, "photo", mappings["photo"], excludes)


@pytest.fixture(scope="module")
def index(outcome):
    whole = outcome.index.withColumns({"index": F.lit("tiles"), "type": F.lit("tile"), "shard": F.pmod("doc_id", F.lit(3))})
    return whole.cache()


def by_image(tiles, i, **more):
    return ImageQuery(**{"field": "photo", "feature": "GABOR", "image": tiles[i], **more})


def by_document(i, **more):
    return ImageQuery(**{"field": "photo", "feature": "TAMURA", "type": "tile", "id": i, "path": "photo", **more})


def test_one_row_per_document_and_feature(index, tiles):
    assert index.count() == 3 * COUNT and "photo" not in index.columns
    assert {r.feature for r in index.select("feature").distinct().collect()} == {"EDGE_HISTOGRAM", "GABOR", "TAMURA"}
    gain = {r.doc_id: r["sensor.gain"] for r in index.filter("feature = 'TAMURA'").collect()}
    assert gain == {i: [i * 10] for i in tiles}


def test_failures_are_rows(outcome):
    errors = {r.doc_id: r.error for r in outcome.errors.collect()}
    assert set(errors) == {100, 101} and errors[100] == "the document carries no image"


def test_an_image_is_made_and_decoded_once(spark, tiles):
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def photo(i):
        made.add(1)
        return base64.b64encode(tiles[i]).decode() if i in tiles else None

    docs = spark.range(COUNT + 2).select(F.col("id").alias("doc_id"), photo("id").alias("photo"))
    mappings, excludes = parse_properties({"properties": {"photo": {"type": "image", "feature": {"SIMPLE_COLOR_HISTOGRAM": {}}}}})
    tags = spark.createDataFrame([], "doc_id bigint, directory string, tag_name string, description string")
    out = index_documents(docs, tags, "photo", mappings["photo"], ["photo"])
    assert made.value == COUNT + 2
    assert {r.doc_id for r in out.errors.collect()} == {COUNT, COUNT + 1} and out.index.count() == COUNT
    assert made.value == COUNT + 2


def test_signatures_follow_the_mapping(index):
    signed = {r.feature: (r.a, r.b) for r in index.groupBy("feature").agg(F.count("sig_lsh").alias("a"), F.count("sig_bit_sampling").alias("b")).collect()}
    assert signed == {"EDGE_HISTOGRAM": (COUNT, 0), "GABOR": (COUNT, COUNT), "TAMURA": (0, 0)}


@pytest.mark.parametrize("how", [{}, {"hash": "BIT_SAMPLING"}, {"hash": "LSH", "limit": 3}, {"boost": 3.0}])
def test_an_indexed_image_finds_itself(index, tiles, how):
    best = search.top_hits(search.image_search(index, by_image(tiles, 7, **how)), 1).head()
    assert (best.doc_id, best.score) == (7, 2.0 * how.get("boost", 1.0))


def test_hash_without_mapping_is_an_error(index):
    from lumisift.errors import QueryError

    with pytest.raises(QueryError, match="not mapped"):
        search.image_search(index, by_document(3, hash="LSH"))
    assert search.image_search(index, by_document(3, hash="LSH"), missing="empty").count() == 0


def test_lookup_with_other_conditions(index):
    hits = search.image_search(index, by_document(3), where=F.array_contains("`sensor.gain`", 50) | (F.col("title") == "tile 2"))
    assert {r.doc_id for r in hits.collect()} == {5} | {i for i in range(COUNT) if i % 4 == 2}


def test_decoded_once(outcome):
    plan = outcome.index._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" not in plan  # the planes are read back from the table they were written to


def test_documents_are_indexed_as_they_arrive(spark, tiles, tmp_path):
    from lumisift.streaming import ingest

    source, store = str(tmp_path / "in"), str(tmp_path / "store")
    schema = "doc_id bigint, title string, photo string"
    some = [(i, "new", base64.b64encode(tiles[i]).decode()) for i in range(4)]
    for rows in (some[:2], [*some[2:], (50, "broken", "aGVsbG8=")], [(0, "again", some[1][2])]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    mappings, excludes = parse_properties(MAPPING)
    ingest.start_indexing(stream, "photo", mappings["photo"], store, str(tmp_path / "c"), excludes=excludes).awaitTermination()
    index = ingest.ingested(spark, store)
    assert {(r.doc_id, r.title) for r in index.select("doc_id", "title").distinct().collect()} == {(0, "again"), (1, "new"), (2, "new"), (3, "new")}
    best = search.top_hits(search.image_search(index, by_image(tiles, 1, hash="LSH")), 2).collect()
    assert [(r.doc_id, r.score) for r in best] == [(0, 2.0), (1, 2.0)]
    assert [r.doc_id for r in ingest.ingested(spark, store, "errors").collect()] == [50]
    assert ingest.ingested(spark, store, "postings").filter("feature = 'GABOR'").count() == 4 * 2 * 50
