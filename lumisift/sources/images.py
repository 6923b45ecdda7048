"""Image rows from files and from encoded bytes, capped in size.

Image files are read by Spark's own ``image`` source. Encoded bytes in a column (documents carry
images in base64) go through a small decoder inside Arrow batches. Both end as compact plane rows
``image_id, w, h, r, g, b``.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from lumisift.errors import ImageProcessError
from lumisift.operators.stencils import idiv, pixels
from lumisift.sources.documents import NO_CONTENT

MAX_SIDE = 1024
PIXELS_PER_BATCH = 4_000_000
PLANE_SCHEMA = "image_id {id}, w int, h int, r array<int>, g array<int>, b array<int>, error string"


def read_image_files(spark: SparkSession, path: str, drop_invalid: bool = False) -> DataFrame:
    """``image_id`` (the file), ``height, width, nChannels, mode, data`` from Spark's image source."""
    source = spark.read.format("image").option("dropInvalid", drop_invalid).load(path)
    return source.select(F.col("image.origin").alias("image_id"), "image.height", "image.width", "image.nChannels", "image.mode", "image.data")


def capped_shape(w: int, h: int, max_side: int) -> tuple[int, int]:
    longest = max(w, h)
    if longest <= max_side:
        return w, h
    return max(1, w * max_side // longest), max(1, h * max_side // longest)


def cap_array(rgb: np.ndarray, max_side: int) -> np.ndarray:
    """Block means: target cell of source x is ``x * new_w // w``, whole-number mean per cell."""
    h, w = rgb.shape[:2]
    new_w, new_h = capped_shape(w, h, max_side)
    if (new_w, new_h) == (w, h):
        return rgb
    first_x = -(-np.arange(new_w) * w // new_w)
    first_y = -(-np.arange(new_h) * h // new_h)
    sums = np.add.reduceat(np.add.reduceat(rgb.astype(np.int64), first_y, axis=0), first_x, axis=1)
    count = np.diff(np.append(first_y, h))[:, None] * np.diff(np.append(first_x, w))[None, :]
    return sums // count[:, :, None]


def unpack_png(payload: bytes) -> np.ndarray:
    """8-bit, non-interlaced PNG (grey, RGB, palette, with or without alpha) to an RGB array."""
    at, header, palette, packed = 8, None, None, []
    while at + 8 <= len(payload):
        size, kind = struct.unpack(">I4s", payload[at : at + 8])
        body = payload[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            header = struct.unpack(">IIBBBBB", body)
        elif kind == b"PLTE":
            palette = np.frombuffer(body, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            packed.append(body)
        at += size + 12
    if header is None or header[2] != 8 or header[6] != 0:
        raise ImageProcessError("unsupported PNG layout")
    w, h, channels = header[0], header[1], {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[header[3]]
    lines = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8).reshape(h, 1 + w * channels)
    out, above = np.zeros((h, w, channels), np.int32), np.zeros((w, channels), np.int32)
    for y in range(h):
        line, method = lines[y, 1:].reshape(w, channels).astype(np.int32), lines[y, 0]
        if method == 1:
            line = np.cumsum(line, axis=0) & 255
        elif method == 2:
            line = (line + above) & 255
        elif method in (3, 4):
            left, corner = np.zeros(channels, np.int32), np.zeros(channels, np.int32)
            for x in range(w):
                up = above[x]
                if method == 3:
                    guess = (left + up) // 2
                else:
                    base = left + up - corner
                    da, db, dc = abs(base - left), abs(base - up), abs(base - corner)
                    guess = np.where((da <= db) & (da <= dc), left, np.where(db <= dc, up, corner))
                line[x] = (line[x] + guess) & 255
                left, corner = line[x], up
        out[y] = above = line
    if header[3] == 3:
        return palette[out[:, :, 0]].astype(np.int64)
    colour = out[:, :, :3] if channels >= 3 else np.repeat(out[:, :, :1], 3, axis=2)
    return colour.astype(np.int64)


def unpack(payload: bytes) -> np.ndarray:
    """Encoded bytes to an (h, w, 3) RGB array; PNG is built in, the rest needs Pillow on the workers."""
    if payload[:8] == b"\x89PNG\r\n\x1a\n":
        try:
            return unpack_png(payload)
        except ImageProcessError:
            pass  # an unusual layout: leave it to the general decoder
    try:
        import io

        from PIL import Image
    except ImportError as cause:
        raise ImageProcessError("no decoder for this image format on the worker") from cause
    try:
        return np.asarray(Image.open(io.BytesIO(payload)).convert("RGB"), dtype=np.int64)
    except OSError as cause:
        raise ImageProcessError("the image cannot be decoded") from cause


def _plane_row(image_id: object, rgb: np.ndarray, max_side: int) -> tuple:
    small = cap_array(rgb, max_side)
    h, w = small.shape[:2]
    return (image_id, w, h, *[small[:, :, k].reshape(-1).astype(np.int32) for k in range(3)], None)


def _batches(rows: Iterator[tuple]) -> Iterator[pd.DataFrame]:
    """Output batches bounded by pixels, not by rows."""
    columns, held, size = ["image_id", "w", "h", "r", "g", "b", "error"], [], 0
    for row in rows:
        held.append(row)
        size += (row[1] or 0) * (row[2] or 0)
        if size >= PIXELS_PER_BATCH:
            yield pd.DataFrame(held, columns=columns)
            held, size = [], 0
    if held:
        yield pd.DataFrame(held, columns=columns)


def decode_images(encoded: DataFrame, max_side: int = MAX_SIDE) -> DataFrame:
    """``(image_id, content)`` to plane rows; ``error`` is set and the planes are NULL where decoding fails. A row that comes
    with an ``error`` keeps it and is not decoded, so nothing has to be filtered out before, which Spark would do by making
    the content twice.

    Lower ``spark.sql.execution.arrow.maxRecordsPerBatch`` in ingest sessions: a batch of encoded
    images should stay within the worker's memory.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows() -> Iterator[tuple]:
            for part in parts:
                for image_id, content, error in zip(part["image_id"], part["content"], part["error"]):
                    if isinstance(error, str):
                        yield (image_id, None, None, None, None, None, error)
                        continue
                    try:
                        if content is None:
                            raise ImageProcessError(NO_CONTENT)
                        yield _plane_row(image_id, unpack(bytes(content)), max_side)
                    except Exception as exc:  # data errors stay with their row
                        yield (image_id, None, None, None, None, None, str(exc) or type(exc).__name__)

        return _batches(rows())

    id_type = encoded.schema["image_id"].dataType.simpleString()
    error = F.col("error") if "error" in encoded.columns else F.lit(None).cast("string")
    return encoded.select("image_id", "content", error.alias("error")).mapInPandas(run, PLANE_SCHEMA.format(id=id_type))


def planes_of_files(files: DataFrame, max_side: int = MAX_SIDE) -> DataFrame:
    """Plane rows from the image source, whose pixel bytes are BGR, BGRA or grey."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows() -> Iterator[tuple]:
            for part in parts:
                for row in part.itertuples(index=False):
                    if row.height <= 0:
                        yield (row.image_id, None, None, None, None, None, "undecodable image")
                        continue
                    raw = np.frombuffer(row.data, np.uint8).reshape(row.height, row.width, row.nChannels).astype(np.int64)
                    rgb = raw[:, :, 2::-1] if row.nChannels >= 3 else np.repeat(raw[:, :, :1], 3, axis=2)
                    yield _plane_row(row.image_id, rgb, max_side)

        return _batches(rows())

    return files.mapInPandas(run, PLANE_SCHEMA.format(id="string"))


def cap_size(images: DataFrame, max_side: int = MAX_SIDE) -> DataFrame:
    """Plane rows with the longest side at most ``max_side``; smaller images pass through untouched."""
    small = images.filter(F.greatest("w", "h") <= max_side).select("image_id", "w", "h", "r", "g", "b")
    large = images.filter(F.greatest("w", "h") > max_side)
    px = pixels(large, {"r": F.col("r"), "g": F.col("g"), "b": F.col("b")})
    longest = F.greatest("w", "h")
    nw = F.greatest(F.lit(1), idiv(F.col("w") * max_side, longest).cast("int"))
    nh = F.greatest(F.lit(1), idiv(F.col("h") * max_side, longest).cast("int"))
    cells = px.select(
        "image_id", nw.alias("nw"), nh.alias("nh"), idiv(F.col("x") * nw, "w").cast("int").alias("gx"),
        idiv(F.col("y") * nh, "h").cast("int").alias("gy"), "r", "g", "b",
    ).groupBy("image_id", "nw", "nh", "gx", "gy").agg(
        *[idiv(F.sum(ch), F.count(F.lit(1))).cast("int").alias(ch) for ch in ("r", "g", "b")]
    )
    whole = cells.groupBy("image_id", "nw", "nh").agg(
        F.array_sort(F.collect_list(F.struct("gy", "gx", "r", "g", "b"))).alias("px")
    )
    return small.unionByName(whole.select(
        "image_id", F.col("nw").alias("w"), F.col("nh").alias("h"),
        *[F.col(f"px.{ch}").alias(ch) for ch in ("r", "g", "b")],
    ))
