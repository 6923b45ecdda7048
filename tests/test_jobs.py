"""Batch matching, same-image edges, quality and streams, against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumisift.functions import hashing
from lumisift.plans import batch, classes, hash_join, quality
from lumisift.streaming import commits, ingest, match

DIM = 16


def corpus():
    rng = np.random.default_rng(3)
    base = rng.integers(-4000, 4000, (8, DIM))
    out = {}
    for i in range(90):  # a third are copies of one vector
        out[i] = base[0] if i % 3 == 0 else base[i % 8] + rng.integers(-500, 500, DIM)
    return {i: [int(x) for x in v] for i, v in out.items()}


VECS = corpus()


@pytest.fixture(scope="module")
def index(spark):
    frame = spark.createDataFrame(list(VECS.items()), "doc_id bigint, vec array<bigint>").repartition(5)
    return hashing.with_signature(frame, "BIT_SAMPLING").cache()


def cosine(a, b):
    a, b = np.array(a, float), np.array(b, float)
    return 1.0 - (a @ b) / np.sqrt((a @ a) * (b @ b))


def score(d):
    return 2.0 - d if d <= 1 else 1.0 / d


SIGS = {i: [int(h) for h in hashing.signatures_of("BIT_SAMPLING", np.array([v]))[0]] for i, v in VECS.items()}


def brute(queries, k, allowed):
    out = {}
    for q in queries:
        ranked = sorted((-score(cosine(VECS[d], VECS[q])), d) for d in VECS if allowed(q, d))
        out[q] = [d for _, d in ranked[:k]]
    return out


def found(frame):
    out = {}
    for r in frame.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append(r.doc_id)
    return out


@pytest.mark.parametrize("queries_at_once", [100, 2])
def test_batch_in_chunks_and_blocks(index, queries_at_once, monkeypatch):
    monkeypatch.setattr(batch, "BLOCK_CELLS", 7 * queries_at_once)
    asked, chunk = [0, 1, 2, 3, 10, 31, 44], queries_at_once * DIM
    queries = index.filter(F.col("doc_id").isin(asked)).select(F.col("doc_id").alias("query_id"), "vec")
    assert found(batch.batch_topk(index, queries, 6, chunk_numbers=chunk)) == brute(asked, 6, lambda q, d: True)
    hashed = batch.batch_topk(index, queries, 6, hash="bit_sampling", bundle_aware=True)
    assert found(hashed) == brute(asked, 6, lambda q, d: any(a == b for a, b in zip(SIGS[q], SIGS[d])))
    free = batch.batch_topk(index, queries, 6, hash="bit_sampling")
    assert found(free) == brute(asked, 6, lambda q, d: bool(set(SIGS[q]) & set(SIGS[d])))


@pytest.mark.parametrize("per_shard", [True, False])
@pytest.mark.parametrize("aware", [True, False])
def test_batch_limit_keeps_the_largest_overlaps(index, per_shard, aware, monkeypatch):
    monkeypatch.setattr(batch, "BLOCK_CELLS", 20)
    asked = [1, 5, 8]
    queries = index.filter(F.col("doc_id").isin(asked)).select(F.col("doc_id").alias("query_id"), "vec")
    sharded = index.withColumn("shard", F.pmod("doc_id", F.lit(3)))
    got = found(batch.batch_topk(sharded, queries, 5, hash="bit_sampling", bundle_aware=aware, limit=4, per_shard=per_shard))
    for q in asked:
        same = lambda d: sum(a == b for a, b in zip(SIGS[q], SIGS[d])) if aware else sum(h in set(SIGS[d]) for h in SIGS[q])  # noqa: B023, E731
        kept = []
        for shard in range(3) if per_shard else (None,):
            of = [d for d in VECS if same(d) and (shard is None or d % 3 == shard)]
            kept += sorted(of, key=lambda d: (-same(d), d))[:4]
        assert got[q] == sorted(kept, key=lambda d: (-score(cosine(VECS[d], VECS[q])), d))[:5]


@pytest.mark.parametrize("aware", [True, False])
@pytest.mark.parametrize("hot", [2, 10_000])
def test_candidates_of_split_buckets_are_whole(index, aware, hot):
    heads = index.select(F.col("doc_id").alias("head"), F.col("sig_bit_sampling").alias("sig"))
    asked = heads.filter("head % 4 = 0").select(F.col("head").alias("asked"), "sig")
    got = {(r.asked, r.head): r.overlap for r in hash_join.candidates(heads, asked, aware, hot).collect()}
    same = lambda q, d: sum(a == b for a, b in zip(SIGS[q], SIGS[d])) if aware else sum(h in set(SIGS[d]) for h in SIGS[q])
    assert got == {(q, d): same(q, d) for q in VECS if q % 4 == 0 for d in VECS if same(q, d)}


def test_hash_batch_scores_candidates_only(spark, index):
    asked = index.select(F.col("doc_id").alias("query_id"), "vec")
    found_rows = batch.batch_topk(index, asked, 2, hash="bit_sampling", bundle_aware=True)
    plan = found_rows._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInPandas" not in plan and plan.count("Cross") == 2  # the total of all postings, one row, for either side
    # a third of all documents are copies, asked as often: each copy finds the first two of them
    got = found(found_rows)
    assert set(got) == set(VECS) and all(got[q] == [0, 3] for q in VECS if q % 3 == 0)


def test_batches_without_queries_or_documents(spark, index):
    none = index.filter("false").select(F.col("doc_id").alias("query_id"), "vec")
    asked = index.limit(2).select(F.col("doc_id").alias("query_id"), "vec")
    for hash in (None, "BIT_SAMPLING"):
        assert batch.batch_topk(index, none, 3, hash=hash).count() == 0
        assert batch.batch_topk(index.filter("false"), asked, 3, hash=hash).count() == 0
    assert [r.candidates for r in batch.candidate_counts(index.filter("false"), asked, "BIT_SAMPLING").collect()] == [0, 0]


def classes_of(docs, linked):
    root = {d: d for d in docs}
    moved = True
    while moved:
        moved = False
        for a, b in linked:
            low = min(root[a], root[b])
            moved |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return root


@pytest.mark.parametrize("metric,threshold", [("cosine", 0.02), ("cosine", 0.5), ("l2", 0.2)])
@pytest.mark.parametrize("shared,tile,crowd", [(1, 256, 64), (2, 4, 3), (1, 3, 0)])
def test_classes_and_links_agree_with_brute_force(index, metric, threshold, shared, tile, crowd):
    far = lambda a, b: cosine(a, b) if metric == "cosine" else np.sqrt(((np.array(a, float) - b) ** 2).sum()) / 10_000
    linked = set()
    for a in VECS:
        for b in VECS:
            same = sum(x == y for x, y in zip(SIGS[a], SIGS[b]))
            if a != b and (VECS[a] == VECS[b] or same >= shared and far(VECS[a], VECS[b]) <= threshold):
                linked.add((a, b))
    root = classes_of(VECS, linked)
    how = {"metric": metric, "threshold": threshold, "min_shared": shared, "tile": tile, "crowd": crowd, "hot": 5}
    got = {r.doc_id: r for r in classes.image_classes(index, "BIT_SAMPLING", **how).collect()}
    assert {d: r.class_id for d, r in got.items()} == root
    assert all(abs(r.distance - far(VECS[d], VECS[r.class_id])) < 1e-9 for d, r in got.items())
    links = {r.doc_id: r.links for r in classes.image_links(index, "BIT_SAMPLING", **how).collect()}
    assert links == {d: sum(a == d for a, _ in linked) for d in VECS}


def test_a_crowd_of_near_images_is_a_row_each(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(-4000, 4000, DIM)
    rows = [(i, [int(x) for x in (base + rng.integers(-40, 40, DIM) if i % 10 else rng.integers(-4000, 4000, DIM))]) for i in range(10_000)]
    crowd = hashing.with_signature(spark.createDataFrame(rows, "doc_id bigint, vec array<bigint>").repartition(8), "BIT_SAMPLING")
    got = classes.image_classes(crowd, "BIT_SAMPLING", threshold=0.01).groupBy("class_id").count().collect()
    sizes = sorted((r["count"] for r in got), reverse=True)
    assert sum(sizes) == 10_000 and sizes[0] == 9_000 and sizes[1] < 10


def test_classes_of_no_images(index):
    assert classes.image_classes(index.filter("false"), "BIT_SAMPLING").count() == 0
    assert classes.image_links(index.filter("false"), "BIT_SAMPLING").count() == 0


def test_batch_metrics_equal_columns(index):
    from lumisift.functions.vectors import distance, int_literal

    for metric in ("l1", "l2", "cosine", "tanimoto", "jsd", "layout"):
        up = F.transform("vec", lambda x: x + 9000) if metric == "jsd" else F.slice("vec", 1, 12) if metric == "layout" else F.col("vec")
        rows = index.select("doc_id", up.alias("vec"))
        queries = rows.filter("doc_id = 1").select(F.col("doc_id").alias("query_id"), "vec")
        vec = queries.head().vec
        have = {r.doc_id: r.distance for r in batch.batch_topk(rows, queries, 90, metric).collect()}
        want = {r.doc_id: r.d for r in rows.select("doc_id", distance(metric, F.col("vec"), int_literal(vec)).alias("d")).collect()}
        assert have == pytest.approx(want, abs=2e-6 if metric in ("jsd", "layout") else 0), metric


def test_huge_bins_do_not_overflow(spark):
    from lumisift.functions.vectors import distance, int_literal

    rows = spark.createDataFrame([(1, [10**18, -3 * 10**17]), (2, [5, 7])], "doc_id bigint, vec array<bigint>")
    vec = [-(10**18), 4 * 10**17]
    for metric in ("l1", "l2", "cosine", "tanimoto"):
        got = [r.d for r in rows.orderBy("doc_id").select(distance(metric, F.col("vec"), int_literal(vec)).alias("d")).collect()]
        one = batch.pairwise(metric, np.array([[10**18, -3 * 10**17], [5, 7]]), np.array([vec]))[:, 0]
        assert got == pytest.approx(list(one), rel=1e-12)
    big = np.array([[26 * 10**16] * 16, [1] * 16])
    planes, _ = hashing.plane_matrix("BIT_SAMPLING", 16)
    signs = [[sum(int(a) * int(b) for a, b in zip(row, col)) >= 0 for col in planes.T] for row in big]
    bits = np.array(signs).reshape(2, hashing.BUNDLES, hashing.BITS) @ (1 << np.arange(hashing.BITS))
    assert (hashing.signatures_of("BIT_SAMPLING", big) == bits).all()
    assert (hashing.signatures_of("BIT_SAMPLING", big)[0] == hashing.signatures_of("BIT_SAMPLING", big[1:])[0]).all()


@pytest.mark.parametrize("shared,crowd", [(2, 64), (2, 3), (1, 3)])
def test_same_image_is_complete(index, shared, crowd, monkeypatch):
    monkeypatch.setattr(batch, "CROWD", crowd)
    heads = {}
    for d in sorted(VECS):
        heads.setdefault(tuple(VECS[d]), d)
    want = {(heads[tuple(v)], d): hashing.BUNDLES for d, v in VECS.items() if heads[tuple(v)] != d}
    for a in heads.values():
        for b in heads.values():
            n = sum(x == y for x, y in zip(SIGS[a], SIGS[b]))
            if a < b and n >= shared and cosine(VECS[a], VECS[b]) <= 0.5:
                want[a, b] = n
    got = [(r.a, r.b, r.shared) for r in batch.same_image(index, "BIT_SAMPLING", threshold=0.5, min_shared=shared).collect()]
    assert {(a, b): n for a, b, n in got} == want and len(got) == len(want)


def test_quality_and_term_statistics(index):
    queries = index.filter("doc_id in (1, 2)").select(F.col("doc_id").alias("query_id"), "vec")
    rows = {r.query_id: r for r in quality.hash_quality(index, queries, 5, "BIT_SAMPLING").collect()}
    for q in (1, 2):
        allowed = [d for d in VECS if set(SIGS[q]) & set(SIGS[d])]
        assert (rows[q].candidates, rows[q].docs, rows[q].wanted) == (len(allowed), 90, 5)
    listed = hashing.postings(index.withColumn("feature", F.lit("EMBEDDING")), "BIT_SAMPLING", ["doc_id", "feature"])
    freq = {r.h: r.doc_freq for r in quality.document_frequency(listed).collect()}
    assert freq == {h: sum(h in s for s in SIGS.values()) for h in {h for s in SIGS.values() for h in s}}
    hot = {r.h for r in quality.hot_terms(quality.document_frequency(listed), 90, 0.3).collect()}
    assert hot == {h for h, n in freq.items() if n > 27}


def read_stream(spark, path, files=1):
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files).parquet(path)


def test_ingest_replays_updates_and_fresh_checkpoints(spark, index, tmp_path):
    source = str(tmp_path / "in")
    first = index.select("doc_id", F.lit(0).alias("version"), "vec")
    first.repartition(3, "doc_id").write.parquet(source)
    store = str(tmp_path / "store")
    run = lambda path, checkpoint, files=1: ingest.start_ingest(read_stream(spark, path, files), lambda b: b, store, str(tmp_path / checkpoint)).awaitTermination()
    run(source, "c1")
    assert ingest.ingested(spark, store, "postings").count() == 90 * 50
    # a second version of some documents and a repetition of others, in later batches of the same stream
    first.filter("doc_id < 10").withColumns({"version": F.lit(1), "vec": F.transform("vec", lambda x: -x)}).write.mode("append").parquet(source)
    first.filter("doc_id < 20").write.mode("append").parquet(source)
    run(source, "c1")
    latest = {r.doc_id: (r.version, r.sig_bit_sampling) for r in ingest.ingested(spark, store).collect()}
    flipped = {d: [int(h) for h in hashing.signatures_of("BIT_SAMPLING", -np.array([VECS[d]]))[0]] for d in range(10)}
    assert latest == {d: (1, flipped[d]) if d < 10 else (0, SIGS[d]) for d in VECS}
    assert ingest.ingested(spark, store, "postings").count() == 90 * 50
    # other files with a new checkpoint keep what is there
    other = str(tmp_path / "other")
    first.filter("doc_id < 5").withColumn("doc_id", F.col("doc_id") + 1000).write.parquet(other)
    run(other, "c2", 100)
    assert {r.doc_id for r in ingest.ingested(spark, store).collect()} == {*VECS, *range(1000, 1005)}


def test_commits_of_two_streams_are_in_order(spark, tmp_path):
    store, schema = str(tmp_path / "store"), "doc_id bigint, vec array<bigint>"

    def send(stream, *values):
        path = str(tmp_path / f"in-{stream}")
        for value in values:
            spark.createDataFrame([(1, [value] * DIM), (value, [value] * DIM)], schema).coalesce(1).write.mode("append").parquet(path)
        ingest.start_ingest(read_stream(spark, path), lambda b: b, store, str(tmp_path / f"c-{stream}")).awaitTermination()

    now = lambda: {r.doc_id: r.vec[0] for r in ingest.ingested(spark, store).collect()}
    send("a", 10, 20, 30)
    send("b", 99)
    assert now() == {1: 99, 10: 10, 20: 20, 30: 30, 99: 99}
    ingest.compact(spark, store)
    assert len(commits.live(spark, store)) == 1 and now() == {1: 99, 10: 10, 20: 20, 30: 30, 99: 99}
    send("a", 40)
    assert now()[1] == 40 and len(commits.live(spark, store)) == 2
    ingest.compact(spark, store)
    assert now() == {1: 40, 10: 10, 20: 20, 30: 30, 40: 40, 99: 99}
    assert ingest.ingested(spark, store, "postings").count() == 6 * 50


def test_a_batch_that_fails_half_way_is_not_there(spark, tmp_path):
    store, rows = str(tmp_path / "store"), spark.range(3).withColumnRenamed("id", "doc_id")
    whole = {"features": lambda written: rows, "postings": lambda written: written("features")}
    broken = {"features": lambda written: rows.selectExpr("doc_id + 10 AS doc_id"), "postings": lambda written: rows.select(F.raise_error(F.lit("lost")))}
    assert commits.commit(spark, store, whole, "s", 0)
    with pytest.raises(Exception, match="lost"):
        commits.commit(spark, store, broken, "s", 1)
    for table in ("features", "postings"):
        assert sorted(r.doc_id for r in commits.committed(spark, store, table).collect()) == [0, 1, 2]
    assert not commits.commit(spark, store, whole, "s", 0)  # a replay of what is committed
    assert commits.commit(spark, store, whole, "s", 1)
    assert [r.number for r in commits.manifests(spark, store)] == [1, 2]
    (tmp_path / "store" / "_commits" / f"{3:020d}.json").write_text("")  # another stream holds number 3 and has not written yet
    assert commits.commit(spark, store, whole, "t", 0) and [r.number for r in commits.manifests(spark, store)] == [1, 2, 4]


def test_incoming_images_are_matched(spark, index, tmp_path):
    source = str(tmp_path / "in")
    index.filter("doc_id in (0, 1, 2)").select("doc_id", "vec").repartition(2, "doc_id").write.parquet(source)
    listed = hashing.postings(index, "BIT_SAMPLING", ["doc_id"])
    out = str(tmp_path / "alerts")
    match.start_matching(read_stream(spark, source), listed, index, out, str(tmp_path / "c"), threshold=0.2).awaitTermination()
    got = {(r.new_id, r.doc_id): r.shared for r in spark.read.parquet(out).collect()}
    want = {}
    for q in (0, 1, 2):
        for d in VECS:
            shared = sum(a == b for a, b in zip(SIGS[q], SIGS[d]))
            if shared and cosine(VECS[q], VECS[d]) <= 0.2:
                want[q, d] = shared
    assert got == want


def test_incoming_images_match_each_other_across_batches(spark, index, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "alerts")
    rows = index.select("doc_id", "vec", F.timestamp_seconds(F.col("doc_id") * 3600 + 86400).alias("ts"))
    for low in (0, 15, 30):
        rows.filter(F.col("doc_id").between(low, low + 14)).coalesce(1).write.mode("append").parquet(source)
    near = {(a, b): sum(x == y for x, y in zip(SIGS[a], SIGS[b])) for a in range(45) for b in range(a + 1, 45) if cosine(VECS[a], VECS[b]) <= 0.2}
    near = {pair: n for pair, n in near.items() if n >= 2}
    match.start_self_matching(read_stream(spark, source), out, str(tmp_path / "c1"), threshold=0.2, min_shared=2).awaitTermination()
    got = [(r.a, r.b, r.shared) for r in spark.read.parquet(out).collect()]
    assert {(a, b): n for a, b, n in got} == near and len(got) == len(near)
    # only images at most six hours apart; what is older leaves the state
    query = match.start_self_matching(
        read_stream(spark, source), out + "-near", str(tmp_path / "c2"), threshold=0.2, min_shared=2, event_time="ts", within="6 hours", delay="1 hour"
    )
    query.awaitTermination()
    got = {(r.a, r.b) for r in spark.read.parquet(out + "-near").collect()}
    assert got == {(a, b) for a, b in near if b - a <= 6}
    held = [sum(op["numRowsTotal"] for op in p["stateOperators"]) for p in query.recentProgress if p["stateOperators"]]
    assert held[-1] < 2 * 45 * hashing.BUNDLES
