"""Extraction, dense vectors, completeness and user descriptors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumisift.errors import QueryError
from lumisift.operators import features, live, stencils
from lumisift.operators.descriptors import DESCRIPTORS, Entry, Tally, described, dct_basis
from lumisift.operators.registry import feature

SCHEMA = "image_id bigint, w int, h int, r array<int>, g array<int>, b array<int>"


def image(image_id, w, h, seed):
    rgb = np.random.default_rng(seed).integers(0, 256, (3, h * w))
    return (image_id, w, h, *[[int(v) for v in plane] for plane in rgb])


@pytest.fixture(scope="module")
def images(spark):
    flat = (3, 16, 16, *[[90] * 256] * 3)
    return spark.createDataFrame([image(1, 16, 16, 1), image(2, 19, 13, 2), flat, image(4, 3, 2, 4)], SCHEMA).cache()


def cells(frame):
    return {(r.image_id, r.bin): r.value for r in frame.collect()}


def luminance(row):
    r, g, b = (np.array(row[k]).reshape(row[2], row[1]) for k in (3, 4, 5))
    return (299 * r + 587 * g + 114 * b) // 1000


def test_neighbours_of_uneven_images(spark, images):
    row = image(2, 19, 13, 2)
    lum = luminance(row)
    got = {(r.x, r.y): [r[f"n{k}"] for k in range(8)] for r in stencils.ring(images.filter("image_id = 2")).collect()}
    assert len(got) == 17 * 11
    for (x, y), values in got.items():
        assert values == [lum[y + dy, x + dx] for dx, dy in stencils.RING]


def test_block_transform_against_matrix_product(images):
    lum = luminance(image(1, 16, 16, 1))
    basis = np.array(dct_basis())
    want = {}
    for sy in range(2):
        for sx in range(2):
            block = lum[sy * 8 : sy * 8 + 8, sx * 8 : sx * 8 + 8]
            coef = np.einsum("ux,yx,vy->uv", basis, block, basis)
            klass = np.where(coef < -67108864, 0, np.where(coef < 0, 1, np.where(coef <= 67108864, 2, 3)))
            for u in range(8):
                for v in range(8):
                    key = (1, (u * 8 + v) * 4 + klass[u, v])
                    want[key] = want.get(key, 0) + 1
    got = cells(described(images.filter("image_id = 1"), DESCRIPTORS["JPEG_COEFFICIENT_HISTOGRAM"]))
    assert got == want


def test_fused_extraction_equals_single(images):
    names = [n for n in DESCRIPTORS if not n.startswith("TEST")]
    fused = {}
    for r in features.extract(images, names).collect():
        fused.setdefault(r.feature, {})[(r.image_id, r.bin)] = r.value
    for name in ("CEDD", "JCD", "PHOG", "BINARY_PATTERNS_PYRAMID", "SCALABLE_COLOR", "AUTO_COLOR_CORRELOGRAM"):
        assert fused[name] == cells(described(images, DESCRIPTORS[name]))
    for name, found in fused.items():
        assert max(b for _, b in found) < feature(name).dim and min(b for _, b in found) >= 0, name


def test_dense_vectors_cover_every_image(images):
    names = ["EDGE_HISTOGRAM", "LOCAL_BINARY_PATTERNS", "SIMPLE_COLOR_HISTOGRAM"]
    table = {(r.image_id, r.feature): r.vec for r in features.feature_table(images, names).collect()}
    assert len(table) == 12
    assert table[3, "EDGE_HISTOGRAM"] == [0] * 80  # a flat image has no edges
    assert sum(table[2, "LOCAL_BINARY_PATTERNS"]) == 17 * 11 and len(table[2, "LOCAL_BINARY_PATTERNS"]) == 256
    long = cells(described(images, DESCRIPTORS["SIMPLE_COLOR_HISTOGRAM"]))
    assert table[1, "SIMPLE_COLOR_HISTOGRAM"] == [long.get((1, b), 0) for b in range(64)]


def test_no_pixel_shuffle(images):
    """Beyond the layout by image, a chain of aggregations adds no exchange."""
    laid_out = stencils.by_image(images)
    for name in ("CEDD", "AUTO_COLOR_CORRELOGRAM", "JPEG_COEFFICIENT_HISTOGRAM", "LUMINANCE_LAYOUT"):
        plan = described(laid_out, DESCRIPTORS[name])._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(image_id") == 1 and plan.count("Exchange") == 1, name
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_tamura_goes_through_the_pixels_once(images):
    plan = described(images, DESCRIPTORS["TAMURA"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("posexplode") == 1


def test_user_descriptor(images):
    features.register_descriptor("test_brightness", 4, "l1", Tally(stencils.point, lambda: [Entry(stencils.idiv("lum", 64))]))
    table = {r.image_id: r.vec for r in features.feature_table(images, ["test_brightness"]).collect()}
    assert table[3] == [0, 256, 0, 0] and sum(table[2]) == 19 * 13

    def arrow(frame):
        def run(parts):
            for part in parts:
                yield part[["image_id"]].assign(bin=0, value=part["r"].map(sum))

        return frame.mapInPandas(run, "image_id bigint, bin bigint, value bigint")

    features.register_descriptor("TEST_RED", 1, "l1", arrow)
    assert {r.image_id: r.vec for r in features.feature_table(images, ["TEST_RED"]).collect()}[3] == [90 * 256]
    with pytest.raises(QueryError):
        features.extract(images, ["EMBEDDING"])


def test_completeness(spark, images):
    docs = spark.createDataFrame([(1,), (2,)], "doc_id bigint")
    have = spark.createDataFrame([(1, "CEDD", [1])], "doc_id bigint, feature string, vec array<bigint>")
    missing = features.missing_features(docs, have, ["cedd"]).collect()
    assert [(r.doc_id, r.feature) for r in missing] == [(2, "CEDD")]
    with pytest.raises(Exception, match="no vector for feature CEDD"):
        features.require_complete(docs, have, ["CEDD"]).collect()
    existing = spark.createDataFrame([(1, "CEDD")], "image_id bigint, feature string")
    assert {r.image_id for r in features.backfill(images, existing, ["CEDD"]).collect()} == {2, 3, 4}


def test_visibility(spark):
    rows = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (3, 3, "d")], "doc_id int, version int, name string")
    gone = spark.createDataFrame([(2,)], "doc_id int")
    got = {tuple(r) for r in live.live(rows, gone, ["doc_id"]).collect()}
    assert got == {(1, 2, "b"), (3, 3, "d")}
    assert {tuple(r) for r in live.latest(live.as_of(rows, 1), ["doc_id"]).collect()} == {(1, 1, "a"), (2, 1, "c")}


def test_bucketed_planes_need_no_exchange(spark, images, tmp_path):
    from lumisift.sources.sinks import write_planes

    write_planes(images, "planes_for_test", str(tmp_path / "planes"), buckets=4)
    stored = spark.table("planes_for_test")
    for name in ("CEDD", "LUMINANCE_LAYOUT", "JPEG_COEFFICIENT_HISTOGRAM"):
        frame = described(stored, DESCRIPTORS[name])
        assert "Exchange" not in frame._jdf.queryExecution().executedPlan().toString(), name
        assert cells(frame) == cells(described(images, DESCRIPTORS[name]))
