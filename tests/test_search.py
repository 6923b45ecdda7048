"""Requests, candidate rules and invariants of searches."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumisift.errors import QueryError
from lumisift.functions import hashing
from lumisift.operators.topk import top_n_per_group
from lumisift.plans import search
from lumisift.plans.request import ImageQuery

DIM = 64


@pytest.fixture(scope="module")
def index(spark):
    rng = np.random.default_rng(11)
    base = rng.integers(-3000, 3000, (6, DIM))
    rows = []
    for i in range(60):
        near = base[i % 6] + rng.integers(-300, 300, DIM)
        vec = None if i == 59 else [int(x) for x in (base[0] if i % 3 == 0 else near)]  # a third are copies
        rows.append((("a", "b")[i % 2], "doc", i, f"r{i % 4}", i % 5, "img", "EMBEDDING", vec, f"n{i}"))
    frame = spark.createDataFrame(
        rows, "index string, type string, doc_id bigint, routing string, shard bigint, field string, feature string, vec array<bigint>, name string"
    )
    return hashing.with_signature(frame, "BIT_SAMPLING").cache()


def ask(**more):
    return ImageQuery(**{"field": "img", "feature": "embedding", "type": "doc", "id": 0, "path": "img", **more})


def ids(hits):
    return {r.doc_id for r in hits.select("doc_id").collect()}


def test_request_errors():
    with pytest.raises(QueryError, match="needs a feature"):
        ImageQuery.parse({"img": {"image": b"x"}})
    with pytest.raises(QueryError, match="needs an image"):
        ImageQuery.parse({"img": {"feature": "CEDD"}})
    with pytest.raises(QueryError, match="needs an image"):
        ImageQuery.parse({"img": {"feature": "CEDD", "type": "t", "id": 1}})
    with pytest.raises(QueryError, match="unknown parameter 'size'"):
        ImageQuery.parse({"img": {"feature": "CEDD", "image": b"x", "size": 3}})
    with pytest.raises(QueryError, match="expected one field"):
        ImageQuery.parse({})
    with pytest.raises(QueryError, match="unknown feature"):
        ImageQuery.parse({"img": {"feature": "SIFT", "image": b"x"}})
    with pytest.raises(QueryError, match="unknown hash"):
        ImageQuery.parse({"img": {"feature": "CEDD", "image": b"x", "hash": "md5"}})


def test_request_roundtrip():
    asked = ImageQuery.parse({"img": {"feature": "cedd", "image": b"x", "hash": "lsh", "limit": 5, "routing": None}})
    assert (asked.feature, asked.hash, asked.boost, asked.limited) == ("CEDD", "LSH", 1.0, True)
    assert asked.to_dict() == {"img": {"feature": "CEDD", "image": "eA==", "hash": "LSH", "limit": 5}}
    assert ImageQuery.parse(asked.to_dict()) == asked
    assert not ImageQuery.parse({"img": {"feature": "cedd", "image": b"x", "limit": 5}}).limited


def test_missing_document_is_an_error(index):
    with pytest.raises(QueryError, match="no such feature or is not live"):
        search.image_search(index, ask(id=12345))
    with pytest.raises(QueryError, match="no such feature or is not live"):
        search.image_search(index, ask(id=59))  # stored without the feature
    with pytest.raises(QueryError, match="no such feature or is not live"):
        search.image_search(index, ask(id=0, routing="r3"))
    assert search.query_vector(index, ask(id=0, routing="r0"))


def test_images_of_requests_are_base64(index):
    assert ImageQuery.parse({"img": {"feature": "cedd", "image": "eA=="}}).image == b"x"
    with pytest.raises(QueryError, match="not base64"):
        ImageQuery.parse({"img": {"feature": "cedd", "image": "?"}})


def test_lookup_must_be_unique_and_live(index):
    with pytest.raises(QueryError, match="several vectors"):
        search.image_search(index, ask(), lookup=index.unionByName(index.withColumn("index", F.lit("c"))))
    with pytest.raises(QueryError, match="not live"):
        search.image_search(index, ask(), lookup=index.withColumn("deleted", F.col("doc_id") == 0))


def test_one_distance_in_the_plan(index):
    plan = search.image_search(index, ask())._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("zip_with") == 2  # the product with the query and the document's own length


def test_explain_and_clauses_with_hashes(index):
    why = search.image_search(index, ask(hash="BIT_SAMPLING", boost=2.0), explain=True).select("score", "explanation.*").collect()
    assert why and all(r.matched and r.value == r.score and r.image_score * 2 == r.score and r.boost == 2.0 for r in why)
    clauses = [ask(hash="BIT_SAMPLING", limit=3), ask(id=1, boost=0.5)]
    vecs = [search.query_vector(index, c) for c in clauses]
    got = {r.doc_id: (r.score, r.clauses) for r in search.multi_feature_search(index, list(zip(clauses, vecs))).collect()}
    parts = [{r.doc_id: r.score for r in search.image_search(index, c).collect()} for c in clauses]
    assert got == {d: (sum(p[d] for p in parts if d in p), sum(d in p for p in parts)) for d in parts[0].keys() | parts[1].keys()}


def test_subset_invariants(index):
    scan = search.image_search(index, ask())
    hashed = search.image_search(index, ask(hash="BIT_SAMPLING"))
    limited = search.image_search(index, ask(hash="BIT_SAMPLING", limit=4), per_shard=False)
    wide = search.image_search(index, ask(hash="BIT_SAMPLING", limit=1000), per_shard=False)
    assert ids(limited) <= ids(hashed) <= ids(scan) == set(range(59))
    assert ids(wide) == ids(hashed)
    assert limited.count() == 4
    best = search.top_hits(search.image_search(index, ask(boost=2.0)), 1).head()
    assert best.doc_id == 0 and best.score == pytest.approx(4.0, abs=1e-12)


@pytest.mark.parametrize("limit", [-1, 3])
@pytest.mark.parametrize("per_shard", [True, False])
@pytest.mark.parametrize("bundle_aware", [True, False])
def test_inline_equals_postings(index, limit, per_shard, bundle_aware):
    listed = hashing.postings(index.filter(F.col("vec").isNotNull()), "BIT_SAMPLING", ["doc_id", "shard", "field", "feature"])
    how = {"per_shard": per_shard, "bundle_aware": bundle_aware}
    asked = ask(id=1, hash="BIT_SAMPLING", limit=limit)
    assert ids(search.image_search(index, asked, **how)) == ids(search.image_search(index, asked, postings=listed, **how))


def test_overlap_counts_query_repeats_only(spark):
    docs = spark.createDataFrame([(1, [7]), (2, [7, 9]), (3, [7, 7]), (4, [3])], "doc_id bigint, sig_bit_sampling array<bigint>")
    got = {r.doc_id: r.o for r in docs.select("doc_id", search.overlap(F.col("sig_bit_sampling"), [7, 7, 9]).alias("o")).collect()}
    assert got == {1: 2, 2: 3, 3: 2, 4: 0}
    listed = hashing.postings(docs, "BIT_SAMPLING", ["doc_id"])
    assert {r.doc_id: r.overlap for r in search.postings_candidates(listed, [7, 7, 9]).collect()} == {1: 2, 2: 3, 3: 2}


def test_no_candidates_keeps_schema(index):
    rows = search.hash_candidates(index, "BIT_SAMPLING", [-7], limit=3)
    assert rows.count() == 0 and "vec" in rows.columns


def test_unmapped_hash(index):
    with pytest.raises(QueryError, match="not mapped"):
        search.image_search(index, ask(hash="LSH"))
    empty = search.image_search(index, ask(hash="LSH"), missing="empty")
    assert empty.count() == 0 and "score" in empty.columns


def test_the_mapping_tells_which_hashes_a_feature_has(spark, index):
    from lumisift.sources.mapping import ImageMapping

    declared = {"img": ImageMapping.parse("img", {"feature": {"EMBEDDING": {"hash": "BIT_SAMPLING"}, "CEDD": {}}})}
    assert ids(search.image_search(index, ask(hash="BIT_SAMPLING"), declared=declared)) == ids(search.image_search(index, ask(hash="BIT_SAMPLING")))
    with pytest.raises(QueryError, match="not mapped"):
        search.image_search(index, ask(hash="BIT_SAMPLING"), declared={"img": ImageMapping.parse("img", {"feature": {"EMBEDDING": {}}})})
    before = spark.sparkContext.statusTracker().getJobIdsForGroup()
    search.image_search(index, ask(hash="BIT_SAMPLING"), vec=[1] * DIM)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup() == before  # no job before the search


def test_filters_before_and_after_the_limit(index):
    asked = ask(id=1, hash="BIT_SAMPLING", limit=5)
    after = search.image_search(index, asked, per_shard=False, where=F.col("shard").isin(0, 1))
    before = search.image_search(index, asked, per_shard=False, pre_filter=F.col("shard").isin(0, 1))
    assert after.count() < before.count() == 5
    one = search.image_search(index, ask(), where=F.col("name") == "n3").select("name", "doc_id").collect()
    assert [tuple(r) for r in one] == [("n3", 3)]


def test_cross_index_lookup(index):
    stored, target = index.filter("index = 'a'"), index.filter("index = 'b'")
    hits = search.image_search(target, ask(id=0, index="a"), lookup=stored)
    assert ids(hits) == {i for i in range(59) if i % 2}


def test_should_sums_clause_scores(index):
    first, second = search.image_search(index, ask(id=0)), search.image_search(index, ask(id=1, boost=0.5))
    got = {r.doc_id: r.score for r in search.should(first, second).collect()}
    one, two = ({r.doc_id: r.score for r in h.collect()} for h in (first, second))
    assert got == {i: one[i] + two[i] for i in one}


def test_scan_has_no_join_and_no_shuffle(index, spark, tmp_path):
    index.drop("sig_bit_sampling").write.partitionBy("feature").parquet(str(tmp_path / "ix"))
    stored = spark.read.parquet(str(tmp_path / "ix"))
    plan = search.top_hits(search.image_search(stored, ask()), 5)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan and "TakeOrderedAndProject" in plan
    assert "PartitionFilters: [isnotnull(feature" in plan and "EqualTo(field,img)" in plan


def test_top_n_per_group_under_skew(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).alias("g"), F.col("id"), ((F.col("id") * 7919) % 101).alias("v")
    )
    got = top_n_per_group(rows, ["g"], [F.col("v").desc(), F.col("id")], 5, ["id"])
    want = {}
    for r in sorted(rows.collect(), key=lambda r: (-r.v, r.id)):
        want.setdefault(r.g, []).append(r.id)
    have = {}
    for r in got.orderBy("g", "rank").collect():
        have.setdefault(r.g, []).append(r.id)
    assert have == {g: members[:5] for g, members in want.items()}


def test_sql_search_is_one_plan(spark, index):
    from lumisift.functions.sql import register_search

    register_search(spark, index, "find_images", "BIT_SAMPLING")
    vec = search.query_vector(index, ask())
    numbers = lambda xs: f"array({', '.join(f'{x}L' for x in xs)})"
    call = lambda more, where="": spark.sql(f"SELECT * FROM find_images('img', 'embedding', {numbers(vec)}{more}) {where}")
    scan = {r.doc_id: r.score for r in search.image_search(index, ask()).collect()}
    assert {r.doc_id: r.score for r in call("").collect()} == scan
    best = [r.doc_id for r in search.top_hits(search.image_search(index, ask()), 7).collect()]
    assert sorted(r.doc_id for r in call(", size => 7").collect()) == sorted(best)
    hashes = search.query_signature("BIT_SAMPLING", vec)
    for limit in (-1, 3):
        want = search.image_search(index, ask(hash="BIT_SAMPLING", limit=limit), per_shard=False)
        assert ids(call(f", {numbers(hashes)}, q_limit => {limit}")) == ids(want)
    assert ids(call("", "WHERE doc_id < 5")) == {0, 1, 2, 3, 4}
    text = lambda frame: frame._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text(call("")) and "Exchange" not in text(call("")) and "TakeOrdered" in text(call(", size => 7"))
    why = call(", q_boost => 2D").select("score", "explanation.*").head()
    assert why.matched and why.value == why.score and why.image_score * 2 == why.score
