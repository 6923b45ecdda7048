"""Tiles of blocks: candidates never leave them, and what leaves is whole."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumisift.functions import hashing
from lumisift.plans import batch, classes, tiles
from lumisift.streaming import match

DIM = 8
RNG = np.random.default_rng(8)
BASE = RNG.integers(-4000, 4000, (6, DIM))
VECS = {i: [int(x) for x in BASE[i % 6] + RNG.integers(-600, 600, DIM)] for i in range(60)}
SIGS = {i: hashing.signatures_of("BIT_SAMPLING", np.array([v]))[0] for i, v in VECS.items()}


@pytest.fixture(scope="module")
def images(spark):
    rows = spark.createDataFrame(list(VECS.items()), "head bigint, vec array<bigint>").repartition(3)
    return hashing.with_signature(rows, "BIT_SAMPLING").withColumnRenamed("sig_bit_sampling", "sig").cache()


def cosine(a, b):
    a, b = np.array(a, float), np.array(b, float)
    return 1.0 - (a @ b) / np.sqrt((a @ a) * (b @ b))


def near(shared=2, threshold=0.1):
    pairs = ((a, b, int((SIGS[a] == SIGS[b]).sum())) for a in VECS for b in VECS if a < b)
    return {(a, b): n for a, b, n in pairs if n >= shared and cosine(VECS[a], VECS[b]) <= threshold}


@pytest.mark.parametrize("most", [1, 2_000_000])
def test_pairs_with_earlier_images_are_whole(images, monkeypatch, most):
    monkeypatch.setattr(tiles, "MOST", most)  # a strip of one image, or of all
    whole = [(r.a, r.b, r.shared) for r in tiles.near_pairs(images, "cosine", 0.1, 2, tile=5).collect()]
    assert {(a, b): n for a, b, n in whole} == near() and len(whole) == len(near())
    late = tiles.near_pairs(images.filter("head % 3 = 0"), "cosine", 0.1, 2, tile=5, earlier=images.filter("head % 3 <> 0")).collect()
    assert sorted((r.a, r.b) for r in late) == sorted(p for p in near() if p[0] % 3 == 0 or p[1] % 3 == 0)


def test_vectors_of_other_lengths_never_meet(images):
    short = images.withColumns({"head": F.col("head") + 100, "vec": F.slice("vec", 1, 5)})
    got = [(r.a, r.b) for r in tiles.near_pairs(images.unionByName(short), "cosine", 0.1, 2).collect()]
    assert len(got) == len(set(got)) and not [p for p in got if p[0] < 100 <= p[1]] and {p for p in got if p[1] < 100} == set(near())


def test_candidates_are_no_rows_of_a_plan(images):
    index = images.withColumnsRenamed({"head": "doc_id", "sig": "sig_bit_sampling"})
    asked = index.select(F.col("doc_id").alias("query_id"), "vec")
    frames = {
        "links": classes.image_links(index, "BIT_SAMPLING", threshold=0.1, min_shared=2),
        "pairs": batch.same_image(index, "BIT_SAMPLING", threshold=0.1, min_shared=2),
        "hits": batch.batch_topk(index, asked, 3, hash="BIT_SAMPLING", bundle_aware=True),
    }
    for name, frame in frames.items():  # postings joined as tables, whose pairs of rows are their square, need an explode of hashes
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert "posexplode" not in plan and "GroupsInArrow" in plan, name


def test_a_batch_of_the_stream_run_again_matches_once(spark, images, tmp_path):
    rows = images.select(F.col("head").alias("doc_id"), "vec")
    write = match._matcher(str(tmp_path / "out"), str(tmp_path / "seen"), threshold=0.1, min_shared=2)
    for number, part in ((0, 0), (1, 1), (1, 1), (2, 2)):
        write(rows.filter(F.col("doc_id") % 3 == part), number)
    got = [(r.a, r.b, r.shared) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert {(a, b): n for a, b, n in got} == near() and len(got) == len(near())
