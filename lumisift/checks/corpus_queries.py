"""Batch and whole-corpus jobs, and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lumisift.checks import oracle_views as v
from lumisift.checks.fixtures import first_of_each_label, signed, table, vectors
from lumisift.checks.registry import query
from lumisift.checks.search_queries import posting_table, query_vec
from lumisift.functions import hashing
from lumisift.functions.vectors import quantise
from lumisift.plans import batch, classes, quality, search
from lumisift.session import shared_folder
from lumisift.streaming import ingest, match

ASKED = "asked AS (SELECT min(vec_id) AS id FROM embeddings GROUP BY label)"
BATCH = v.pairs("q.doc_id IN (SELECT id FROM asked)")
RANKED = f"""ranked AS (SELECT query_id, doc_id, cosine AS distance, {v.score('cosine')} AS score FROM dist),
top AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM ranked)"""


@query("q22_batch_topk", f"WITH {v.VECTORS}, {ASKED}, {BATCH}, {RANKED} SELECT query_id, doc_id, distance, score, rank FROM top WHERE rank <= 10")
def batch_topk(spark: SparkSession, sf: str) -> DataFrame:
    return batch.batch_topk(vectors(spark, sf), first_of_each_label(spark, sf), 10)


@query("q22_batch_hash_topk", f"""WITH {v.SIGNATURES}, {ASKED}, {BATCH},
near AS (SELECT DISTINCT q.doc_id AS query_id, d.doc_id FROM sig q JOIN sig d ON d.bundle = q.bundle AND d.h = q.h WHERE q.doc_id IN (SELECT id FROM asked)),
top AS (SELECT dist.query_id, dist.doc_id, cosine AS distance, {v.score('cosine')} AS score,
  row_number() OVER (PARTITION BY dist.query_id ORDER BY {v.score('cosine')} DESC, dist.doc_id) AS rank
  FROM dist JOIN near ON near.query_id = dist.query_id AND near.doc_id = dist.doc_id)
SELECT query_id, doc_id, distance, score, rank FROM top WHERE rank <= 10""")
def batch_hash_topk(spark: SparkSession, sf: str) -> DataFrame:
    queries = first_of_each_label(spark, sf)
    return batch.batch_topk(signed(spark, sf), queries, 10, hash="BIT_SAMPLING", bundle_aware=True)


PAIRS = f"""WITH {v.SIGNATURES},
met AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM sig x JOIN sig y ON x.bundle = y.bundle AND x.h = y.h AND x.doc_id < y.doc_id
  GROUP BY 1, 2 HAVING count(*) >= 2),
prod AS (SELECT a, b, shared, sum(x.v * y.v) AS ab, sum(x.v * x.v) AS aa, sum(y.v * y.v) AS bb
  FROM met JOIN ql x ON x.doc_id = a JOIN ql y ON y.doc_id = b AND y.i = x.i GROUP BY 1, 2, 3),
near AS (SELECT a, b, shared, 1.0::DOUBLE - ab::DOUBLE / sqrt(aa::DOUBLE * bb::DOUBLE) AS distance FROM prod)"""


@query("q23_same_image", f"{PAIRS} SELECT a, b, shared, distance FROM near WHERE distance <= 0.8")
def same_image(spark: SparkSession, sf: str) -> DataFrame:
    return batch.same_image(signed(spark, sf), "BIT_SAMPLING", threshold=0.8, min_shared=2)


@query("q23_near_duplicates", f"""{PAIRS} SELECT doc_id, min(distance) AS nearest FROM (
  SELECT a AS doc_id, distance FROM near UNION ALL SELECT b, distance FROM near) WHERE distance <= 0.8 GROUP BY 1""")
def near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """Every document that has a near-duplicate."""
    pairs = batch.same_image(signed(spark, sf), "BIT_SAMPLING", threshold=0.8, min_shared=2)
    ends = pairs.select(F.explode(F.array("a", "b")).alias("doc_id"), "distance")  # pairs are made once
    return ends.groupBy("doc_id").agg(F.min("distance").alias("nearest"))


LINKED = "link AS (SELECT a, b FROM near WHERE distance <= 0.8 UNION ALL SELECT b, a FROM near WHERE distance <= 0.8)"


@query("q23_image_classes", f"""{PAIRS.replace("WITH", "WITH RECURSIVE", 1)}, {LINKED},
reach AS (SELECT vec_id AS doc_id, vec_id AS root FROM embeddings UNION SELECT link.b, reach.root FROM reach JOIN link ON link.a = reach.doc_id),
class AS (SELECT doc_id, min(root) AS class_id FROM reach GROUP BY 1),
rep AS (SELECT c.doc_id, c.class_id, sum(x.v * y.v) AS ab, sum(x.v * x.v) AS aa, sum(y.v * y.v) AS bb
  FROM class c JOIN ql x ON x.doc_id = c.doc_id JOIN ql y ON y.doc_id = c.class_id AND y.i = x.i GROUP BY 1, 2)
SELECT doc_id, class_id, 1.0::DOUBLE - ab::DOUBLE / sqrt(aa::DOUBLE * bb::DOUBLE) AS distance FROM rep""")
def image_classes(spark: SparkSession, sf: str) -> DataFrame:
    return classes.image_classes(signed(spark, sf), "BIT_SAMPLING", threshold=0.8, min_shared=2)


@query("q23_image_links", f"""{PAIRS}, {LINKED}
SELECT vec_id AS doc_id, (SELECT count(*) FROM link WHERE link.a = e.vec_id) AS links FROM embeddings e""")
def image_links(spark: SparkSession, sf: str) -> DataFrame:
    return classes.image_links(signed(spark, sf), "BIT_SAMPLING", threshold=0.8, min_shared=2)


EVERY = v.pairs("true")
EVERY_NEAR = """near AS (SELECT DISTINCT q.doc_id AS query_id, d.doc_id FROM sig q JOIN sig d ON d.bundle = q.bundle AND d.h = q.h)"""


@query("q22_batch_hash_all", f"""WITH {v.SIGNATURES}, {EVERY}, {EVERY_NEAR},
top AS (SELECT dist.query_id, dist.doc_id, cosine AS distance, {v.score('cosine')} AS score,
  row_number() OVER (PARTITION BY dist.query_id ORDER BY {v.score('cosine')} DESC, dist.doc_id) AS rank
  FROM dist JOIN near ON near.query_id = dist.query_id AND near.doc_id = dist.doc_id)
SELECT query_id, doc_id, distance, score, rank FROM top WHERE rank <= 3""")
def batch_hash_all(spark: SparkSession, sf: str) -> DataFrame:
    """Every stored vector asks."""
    asked = vectors(spark, sf).select(F.col("doc_id").alias("query_id"), "vec")
    return batch.batch_topk(signed(spark, sf), asked, 3, hash="BIT_SAMPLING", bundle_aware=True)


@query("q22_batch_limit", f"""WITH {v.SIGNATURES}, {ASKED}, {BATCH},
shared AS (SELECT q.doc_id AS query_id, d.doc_id, count(*) AS overlap FROM (SELECT doc_id, h FROM sig WHERE doc_id IN (SELECT id FROM asked)) q
  JOIN (SELECT DISTINCT doc_id, h FROM sig) d ON d.h = q.h GROUP BY 1, 2),
kept AS (SELECT *, row_number() OVER (PARTITION BY query_id, doc_id % 5 ORDER BY overlap DESC, doc_id) AS r FROM shared),
top AS (SELECT dist.query_id, dist.doc_id, cosine AS distance, {v.score('cosine')} AS score,
  row_number() OVER (PARTITION BY dist.query_id ORDER BY {v.score('cosine')} DESC, dist.doc_id) AS rank
  FROM dist JOIN kept ON kept.query_id = dist.query_id AND kept.doc_id = dist.doc_id WHERE r <= 6)
SELECT query_id, doc_id, distance, score, rank FROM top WHERE rank <= 10""")
def batch_limit(spark: SparkSession, sf: str) -> DataFrame:
    """The six candidates of each shard with the largest overlap, then the ten best of them."""
    queries = first_of_each_label(spark, sf)
    return batch.batch_topk(signed(spark, sf), queries, 10, hash="BIT_SAMPLING", limit=6, per_shard=True)


@query("q24_recall", f"""WITH {v.SIGNATURES}, {ASKED}, {BATCH}, {RANKED},
near AS (SELECT DISTINCT q.doc_id AS query_id, d.doc_id FROM sig q JOIN sig d ON d.h = q.h WHERE q.doc_id IN (SELECT id FROM asked)),
size AS (SELECT query_id, count(*) AS candidates FROM near GROUP BY 1)
SELECT top.query_id, count(*) AS wanted, count(near.doc_id) AS hit, max(size.candidates) AS candidates, (SELECT count(*) FROM embeddings) AS docs
FROM top LEFT JOIN near ON near.query_id = top.query_id AND near.doc_id = top.doc_id JOIN size ON size.query_id = top.query_id
WHERE rank <= 10 GROUP BY 1""")
def recall(spark: SparkSession, sf: str) -> DataFrame:
    return quality.hash_quality(signed(spark, sf), first_of_each_label(spark, sf), 10, "BIT_SAMPLING", chunk_numbers=4 * 64)


PROBES = 40
MARGINS = v.SIGNATURES.replace("sig AS (", """margin AS (SELECT q.doc_id, p.bundle, CAST(p.bit AS INTEGER) AS bit, sum(q.v * p.coef) AS dot
    FROM ql q JOIN planes p ON p.i = q.i GROUP BY 1, 2, 3),
sig AS (""")


@query("q24_multi_probe", f"""WITH {MARGINS}, {ASKED}, {BATCH}, {RANKED},
place AS (SELECT doc_id, bundle, bit, abs(dot) AS m, row_number() OVER (PARTITION BY doc_id, bundle ORDER BY abs(dot), bit) - 1 AS place
  FROM margin WHERE doc_id IN (SELECT id FROM asked)),
turn AS (SELECT doc_id, bundle, s.range AS s, sum(CASE WHEN (s.range >> CAST(place AS INTEGER)) & 1 = 1 THEN m ELSE 0 END) AS cost,
  CAST(sum(CASE WHEN (s.range >> CAST(place AS INTEGER)) & 1 = 1 THEN 1 << bit ELSE 0 END) AS BIGINT) AS mask
  FROM place, range(128) s WHERE place < 7 GROUP BY 1, 2, 3),
probe AS (SELECT t.doc_id, t.bundle, xor(sig.h, t.mask) AS h FROM turn t JOIN sig ON sig.doc_id = t.doc_id AND sig.bundle = t.bundle
  QUALIFY row_number() OVER (PARTITION BY t.doc_id, t.bundle ORDER BY cost, mask) <= {PROBES} + 1),
met AS (SELECT q.doc_id AS query_id, d.doc_id, count(*) AS overlap FROM probe q JOIN sig d ON d.bundle = q.bundle AND d.h = q.h GROUP BY 1, 2),
kept AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY overlap DESC, doc_id) AS r FROM met),
size AS (SELECT query_id, count(*) AS candidates FROM kept WHERE r <= (SELECT count(*) // 5 FROM embeddings) GROUP BY 1)
SELECT top.query_id, count(*) AS wanted, count(kept.doc_id) AS hit, max(size.candidates) AS candidates, (SELECT count(*) FROM embeddings) AS docs
FROM top LEFT JOIN kept ON kept.query_id = top.query_id AND kept.doc_id = top.doc_id AND r <= (SELECT count(*) // 5 FROM embeddings)
JOIN size ON size.query_id = top.query_id WHERE rank <= 10 GROUP BY 1""")
def multi_probe(spark: SparkSession, sf: str) -> DataFrame:
    """Near hashes are asked as well, and the fifth of the documents that most bundles answer with is scored."""
    index = signed(spark, sf)
    fifth = table(spark, sf, "embeddings").count() // 5
    return quality.hash_quality(index, first_of_each_label(spark, sf), 10, "BIT_SAMPLING", probes=PROBES, limit=fifth)


@query("q25_hash_docfreq", f"WITH {v.SIGNATURES} SELECT h, count(DISTINCT doc_id) AS doc_freq, count(*) AS postings FROM sig GROUP BY 1")
def docfreq(spark: SparkSession, sf: str) -> DataFrame:
    return quality.document_frequency(posting_table(signed(spark, sf))).select("h", "doc_freq", "postings")


@query("q25_query_terms", f"""WITH {v.SIGNATURES} SELECT h, count(DISTINCT doc_id) AS doc_freq FROM sig
WHERE h IN (SELECT h FROM sig WHERE doc_id = 0) GROUP BY 1""")
def query_terms(spark: SparkSession, sf: str) -> DataFrame:
    hashes = search.query_signature("BIT_SAMPLING", query_vec(vectors(spark, sf)))
    return quality.query_term_frequency(posting_table(signed(spark, sf)), hashes).select("h", "doc_freq")


# --- streams -------------------------------------------------------------------------------------


def as_files(spark: SparkSession, purpose: str, *sent: DataFrame) -> str:
    """A directory of Parquet files for a file stream, in the order they are sent."""
    path = shared_folder(spark, purpose)
    for rows in sent:
        rows.write.mode("append").parquet(path)
    return path


def stream_of(spark: SparkSession, path: str, files: int = 2) -> DataFrame:
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def finish(started) -> None:
    started.awaitTermination()
    if started.exception():
        raise started.exception()


UPDATED = v.SIGNATURES.replace("sum(q.v * p.coef)", "sum(q.v * CASE WHEN q.doc_id % 5 = 0 THEN -1 ELSE 1 END * p.coef)")


@query("x1_stream_ingest", f"WITH {UPDATED} SELECT doc_id, bundle, h FROM sig")
def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors arrive as files in several micro-batches; a fifth of them is sent again as a second version, another
    third is repeated as it was."""
    first = table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), F.lit(0).alias("version"), quantise(F.col("embedding")).alias("vec"))
    second = first.filter("doc_id % 5 = 0").select("doc_id", F.lit(1).alias("version"), F.transform("vec", lambda x: -x).alias("vec"))
    source = as_files(spark, "incoming", first.repartition(3, "doc_id"), second.repartition(2, "doc_id"), first.filter("doc_id % 3 = 0").repartition(2, "doc_id"))
    out = shared_folder(spark, "ingested")
    finish(ingest.start_ingest(stream_of(spark, source), lambda rows: rows, f"{out}/store", f"{out}/checkpoint"))
    return ingest.ingested(spark, f"{out}/store", "postings").select("doc_id", "bundle", "h")


@query("x1_two_streams", f"WITH {UPDATED} SELECT doc_id, bundle, h FROM sig")
def two_streams(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors arrive without versions in several batches of one stream, a fifth of them turned twice; then a second stream
    brings that fifth as it should be, and the store is compacted before it is read."""
    first = table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), quantise(F.col("embedding")).alias("vec"))
    fifth = first.filter("doc_id % 5 = 0")
    turned = lambda by: fifth.select("doc_id", F.transform("vec", lambda x: x * by).alias("vec"))
    out = shared_folder(spark, "ingested")
    for name, rows in (("a", [first.repartition(2, "doc_id"), turned(3).coalesce(1), turned(5).coalesce(1)]), ("b", [turned(-1).coalesce(1)])):
        source = as_files(spark, "incoming", *rows)
        finish(ingest.start_ingest(stream_of(spark, source, 1), lambda batch: batch, f"{out}/store", f"{out}/checkpoint-{name}"))
    ingest.compact(spark, f"{out}/store")
    return ingest.ingested(spark, f"{out}/store", "postings").select("doc_id", "bundle", "h")


@query("x2_stream_dedup", "SELECT event_id, event_type, value FROM events")
def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every event is sent twice, the copy in a later micro-batch; each is kept once."""
    events = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    source = as_files(spark, "replayed", *[events.repartition(2, "event_id")] * 2)
    out = shared_folder(spark, "deduplicated")
    once = ingest.unique_documents(stream_of(spark, source), "ts", "40 days", ("event_id",))
    finish(
        once.writeStream.format("parquet").option("checkpointLocation", f"{out}/checkpoint").option("path", f"{out}/rows")
        .trigger(availableNow=True).start()
    )
    return spark.read.parquet(f"{out}/rows").select("event_id", "event_type", "value")


@query("x3_stream_match", f"""WITH {v.SIGNATURES}, {ASKED}, {BATCH},
near AS (SELECT q.doc_id AS query_id, d.doc_id, count(*) AS shared FROM sig q JOIN sig d ON d.bundle = q.bundle AND d.h = q.h
  WHERE q.doc_id IN (SELECT id FROM asked) GROUP BY 1, 2)
SELECT near.query_id AS new_id, near.doc_id, shared, cosine AS distance, {v.score('cosine')} AS score
FROM near JOIN dist ON dist.query_id = near.query_id AND dist.doc_id = near.doc_id WHERE cosine <= 1""")
def stream_match(spark: SparkSession, sf: str) -> DataFrame:
    """The first document of every label arrives again and is matched against the stored ones."""
    arriving = first_of_each_label(spark, sf).select(F.col("query_id").alias("doc_id"), "vec")
    source = as_files(spark, "arriving", arriving.repartition(2, "doc_id"))
    out = shared_folder(spark, "alerts")
    signed(spark, sf).write.parquet(f"{out}/stored")  # signatures are made once and not for every micro-batch
    stored = spark.read.parquet(f"{out}/stored")
    postings = hashing.postings(stored, "BIT_SAMPLING", ["doc_id"])
    finish(match.start_matching(stream_of(spark, source, 1), postings, stored, f"{out}/alerts", f"{out}/checkpoint"))
    return spark.read.parquet(f"{out}/alerts").select("new_id", "doc_id", "shared", "distance", "score")


@query("x3_stream_self_match", f"{PAIRS} SELECT a, b, shared, distance FROM near WHERE distance <= 0.8")
def stream_self_match(spark: SparkSession, sf: str) -> DataFrame:
    """All vectors arrive in four micro-batches and are matched with each other across them."""
    arriving = vectors(spark, sf).select("doc_id", "vec")
    source = as_files(spark, "arriving", arriving.repartition(4, "doc_id"))
    out = shared_folder(spark, "alerts")
    finish(match.start_self_matching(stream_of(spark, source, 1), f"{out}/alerts", f"{out}/checkpoint", threshold=0.8, min_shared=2))
    return spark.read.parquet(f"{out}/alerts").select("a", "b", "shared", "distance")
