"""Mappings, documents, image decoding, size cap and metadata."""

import base64
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumisift.checks.fixtures import encode_png
from lumisift.errors import MappingError
from lumisift.operators import metadata
from lumisift.sources import documents, images, sinks
from lumisift.sources.mapping import ImageMapping, parse_properties

MAPPING = {
    "type": "image",
    "feature": {"phog": {"hash": "lsh"}, "TAMURA": {}, "Gabor": {"hash": ["LSH", "bit_sampling"]}},
    "metadata": {"camera.exposure_time": {"type": "double"}, "place.city_name": {"type": "string", "store": "yes"}},
}


def test_mapping_errors():
    for node, message in (
        ({"type": "image"}, "at least one feature"),
        ({"type": "image", "feature": {}}, "at least one feature"),
        ({"type": "image", "feature": {"CEDD": {"hash": 5}}}, "a name or a list of names"),
        ({"type": "image", "feature": {"SIFT": {}}}, "unknown feature"),
        ({"type": "image", "feature": {"CEDD": {"hash": "md5"}}}, "unknown hash"),
        ({"type": "image", "feature": {"CEDD": {}}, "metadata": {"k": {"type": "shape"}}}, "unknown type of a metadata key"),
    ):
        with pytest.raises(MappingError, match=message):
            ImageMapping.parse("img", node)


def test_mapping_expands_and_serialises(spark):
    mapping = ImageMapping.parse("img", MAPPING)
    assert mapping.features == {"PHOG": ("LSH",), "TAMURA": (), "GABOR": ("LSH", "BIT_SAMPLING")}
    fields = {r.sub_field: (r.kind, r.type, r.stored, r.indexed) for r in mapping.sub_fields(spark).collect()}
    assert fields["img.TAMURA"] == ("feature", "binary", True, False)
    assert fields["img.GABOR.hash.BIT_SAMPLING"] == ("hash", "string", True, True)
    assert fields["img.metadata.place.city_name"] == ("metadata", "string", True, True)
    assert len(fields) == 8
    assert "GABOR.hash.LSH" in mapping.schema().names
    again = ImageMapping.parse("img", json.loads(json.dumps(mapping.to_dict()))["img"])
    assert again == mapping
    found, excludes = parse_properties({"_source": {"excludes": ["img"]}, "properties": {"img": MAPPING, "name": {"type": "string"}}})
    assert list(found) == ["img"] and excludes == ["img"]


def test_content_rejection(spark):
    rows = spark.createDataFrame([(1, base64.b64encode(b"abc").decode()), (2, "!!"), (3, None)], "doc_id int, img string")
    got = documents.with_content(rows, "img")
    assert {r.doc_id: r.content and bytes(r.content) for r in documents.accepted(got).collect()} == {1: b"abc"}
    assert {r.doc_id: r.error for r in documents.quarantined(got).collect()} == {
        2: "the image is not base64", 3: "the document carries no image"
    }
    with pytest.raises(Exception, match="the document carries no image"):
        documents.with_content(rows, "img", "FAILFAST").collect()
    assert documents.stored_source(rows, ["img"]).columns == ["doc_id"]


def noise(w, h, seed=1):
    return np.random.default_rng(seed).integers(0, 256, (h, w, 3))


def png(rgb):
    h, w = rgb.shape[:2]
    return encode_png(w, h, *[rgb[:, :, k].reshape(-1) for k in range(3)])


def planes(row):
    return np.stack([np.array(row[ch]).reshape(row.h, row.w) for ch in ("r", "g", "b")], axis=2)


def test_image_files_and_bytes_agree(spark, tmp_path):
    rgb = noise(37, 21)
    (tmp_path / "good.png").write_bytes(png(rgb))
    (tmp_path / "junk.png").write_bytes(b"not an image")
    files = images.read_image_files(spark, str(tmp_path))
    rows = {r.image_id.rsplit("/", 1)[1]: r for r in images.planes_of_files(files).collect()}
    assert np.array_equal(planes(rows["good.png"]), rgb)
    assert rows["junk.png"].error == "undecodable image" and rows["junk.png"].r is None
    assert images.read_image_files(spark, str(tmp_path), drop_invalid=True).count() == 1
    encoded = spark.createDataFrame([(1, bytearray(png(rgb))), (2, bytearray(b"junk")), (3, None)], "image_id bigint, content binary")
    decoded = {r.image_id: r for r in images.decode_images(encoded).collect()}
    assert np.array_equal(planes(decoded[1]), rgb) and decoded[1].error is None
    assert decoded[2].error and decoded[3].error == "the document carries no image"


def test_png_filters():
    """Each line filter, written by hand, against the plain pixels."""
    import struct
    import zlib

    rgb = noise(9, 5, 3)
    raw = rgb.reshape(5, 27)
    lines, above = [], np.zeros(27, int)
    for y, method in enumerate((0, 1, 2, 3, 4)):
        line = raw[y]
        left = np.concatenate([np.zeros(3, int), line[:-3]])
        corner = np.concatenate([np.zeros(3, int), above[:-3]])
        base = left + above - corner
        da, db, dc = abs(base - left), abs(base - above), abs(base - corner)
        paeth = np.where((da <= db) & (da <= dc), left, np.where(db <= dc, above, corner))
        guess = (np.zeros(27, int), left, above, (left + above) // 2, paeth)[method]
        lines.append(bytes([method]) + ((line - guess) % 256).astype(np.uint8).tobytes())
        above = line

    def chunk(kind, body):
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    header = struct.pack(">IIBBBBB", 9, 5, 8, 2, 0, 0, 0)
    payload = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(b"".join(lines))) + chunk(b"IEND", b"")
    assert np.array_equal(images.unpack_png(payload), rgb)


@pytest.mark.parametrize("w,h,side", [(13, 7, 5), (7, 13, 12), (16, 16, 8), (5, 5, 9), (50, 1, 10)])
def test_cap_in_tasks_equals_cap_in_frames(spark, w, h, side):
    rgb = noise(w, h, w * h)
    new_w, new_h = images.capped_shape(w, h, side)
    want = np.zeros((new_h, new_w, 3), int)
    for gy in range(new_h):
        for gx in range(new_w):
            cell = [rgb[y, x] for y in range(h) for x in range(w) if (x * new_w // w, y * new_h // h) == (gx, gy)]
            want[gy, gx] = np.sum(cell, axis=0) // len(cell)
    assert np.array_equal(images.cap_array(rgb, side), want)
    frame = spark.createDataFrame(
        [(1, w, h, *[[int(x) for x in rgb[:, :, k].reshape(-1)] for k in range(3)])],
        "image_id bigint, w int, h int, r array<int>, g array<int>, b array<int>",
    )
    row = images.cap_size(frame, side).head()
    assert (row.w, row.h) == (new_w, new_h) and np.array_equal(planes(row), want)


TAG = "doc_id bigint, directory string, tag_name string, description string"


def test_metadata_columns(spark):
    tags = spark.createDataFrame([
        (1, "Exif IFD0", "X Resolution", "72 dots per inch"), (1, "JPEG", "Image  Width", "640"), (1, "JPEG", "Image Width", "320"),
        (2, "JPEG", "Image Width", "wide"), (2, "JPEG", "Comment", "left out"),
    ], TAG)
    declared = {"exif_ifd0.x_resolution": "string", "jpeg.image_width": "integer"}
    got = {r.doc_id: r for r in metadata.typed_columns(tags, declared).collect()}
    assert got[1]["exif_ifd0.x_resolution"] == ["72 dots per inch"]
    assert got[1]["jpeg.image_width"] == [320, 640] and got[2]["jpeg.image_width"] == []
    rows = metadata.declared_only(tags, list(declared))
    errors = [r.key for r in metadata.with_errors(rows, declared).filter(F.col("error").isNotNull()).collect()]
    assert errors == ["jpeg.image_width"]
    with pytest.raises(Exception, match="metadata not readable as declared"):
        metadata.with_errors(rows, declared, ignore_errors=False).collect()
    docs = spark.createDataFrame([(1,), (3,)], "doc_id bigint")
    assert metadata.attach(docs, tags, {}) is docs
    attached = {r.doc_id: r["jpeg.image_width"] for r in metadata.attach(docs, tags, declared).collect()}
    assert attached == {1: [320, 640], 3: None}


def rows_read(frame):
    """Rows the Parquet readers of a plan hand on, after whole row groups are left out, and the files they opened."""
    frame.collect()
    leaves = frame._jdf.queryExecution().executedPlan().collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.length())]
    return [sum(int(s.metrics().get(m).get().value()) for s in scans) for m in ("numOutputRows", "numFiles")]


def test_stored_tables_skip_data(spark, tmp_path):
    rows = spark.range(40_000).selectExpr("(id * 7919) % 40000 AS doc_id", "'CEDD' AS feature", "transform(sequence(1, 8), i -> id * i) AS vec")
    sinks.write_features(rows, str(tmp_path / "features"), row_group_bytes=64 << 10)
    stored = spark.read.parquet(str(tmp_path / "features"))
    found = stored.filter("feature = 'CEDD' AND doc_id = 777").select("vec")
    assert found.count() == 1 and rows_read(found)[0] < 10_000
    posted = rows.selectExpr("doc_id", "'f' AS field", "feature", "'LSH' AS hash_mode", "doc_id % 50 AS bundle", "doc_id % 4096 * 3 AS h")
    name = "skipped_" + tmp_path.name.replace("-", "_")
    sinks.write_postings(posted, name, str(tmp_path / "postings"), buckets=8, row_group_bytes=64 << 10)
    files = list((tmp_path / "postings").rglob("*.parquet"))
    assert len(files) == 8  # one for each bucket
    some = spark.table(name).filter("feature = 'CEDD' AND hash_mode = 'LSH' AND h IN (3, 300)").select("doc_id")
    assert some.count() == 2 * 10 and rows_read(some)[0] <= 2 * 40_000 // 8 and rows_read(some)[1] <= 2
    spark.sql(f"DROP TABLE {name}")
