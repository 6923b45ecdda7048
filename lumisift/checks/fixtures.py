"""Views derived from the given tables; the oracle mirrors each of them in SQL."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from lumisift.functions.hashing import with_signature
from lumisift.functions.vectors import quantise
from lumisift.operators.stencils import by_image

FIELD = "img"
FEATURE = "EMBEDDING"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` as an index table with the feature vector only: no join needed."""
    return table(spark, sf_dir, "embeddings").select(
        F.when(F.pmod("label", F.lit(2)) == 1, "a").otherwise("b").alias("index"),
        F.concat(F.lit("t"), F.pmod("label", F.lit(2)).cast("string")).alias("type"),
        F.col("vec_id").alias("doc_id"),
        F.lit(None).cast("string").alias("routing"),
        F.pmod("vec_id", F.lit(5)).cast("bigint").alias("shard"),
        F.lit(FIELD).alias("field"),
        F.lit(FEATURE).alias("feature"),
        quantise(F.col("embedding")).alias("vec"),
    )


def signed(spark: SparkSession, sf_dir: str, mode: str = "BIT_SAMPLING") -> DataFrame:
    return with_signature(vectors(spark, sf_dir), mode)


def documents_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index table with sibling scalars and metadata."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars")
    meta = F.when(
        F.col("lang").isNotNull(),
        F.create_map(
            F.lit("document.lang"), F.col("lang"), F.lit("document.n_chars"), F.col("n_chars").cast("string")
        ),
    )
    return vectors(spark, sf_dir).join(docs, "doc_id", "left").withColumn("name", F.col("source")).withColumn("meta", meta)


def tiles8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One 8x8 colour image per vector, laid out by image."""
    level = F.transform(
        "embedding",
        lambda e: F.least(F.lit(255), F.greatest(F.lit(0), F.floor(e.cast("double") * 400.0 + 128.0))).cast("int"),
    )
    rows = by_image(table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("image_id"), level.alias("r")))

    def turned(by: int):
        return F.concat(F.slice("r", by + 1, F.size("r") - by), F.slice("r", 1, by))

    return rows.select(
        "image_id", F.lit(8).alias("w"), F.lit(8).alias("h"), "r", turned(1).alias("g"), turned(7).alias("b")
    )


def tiles32(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tiles enlarged to 32x32 and lightly textured, shifted so that blocks cross tile edges."""

    place = [(((p // 32 + 1) // 4 % 8 * 8 + (p % 32 + 1) // 4 % 8), (p % 32 * 3 + p // 32 * 5) % 4) for p in range(1024)]

    def enlarged(turn: int):
        """A channel is the first one turned by a few places, so all three read one plane; where a pixel comes from and what
        is added to it are constants, in one number each."""
        codes = " ".join(str((at + turn) % 64 * 4 + more) for at, more in place)
        return F.expr(f"transform(CAST(split('{codes}', ' ') AS array<int>), c -> least(255, get(r, shiftright(c, 2)) + (c & 3)))")

    return tiles8(spark, sf_dir).select(
        "image_id", F.lit(32).alias("w"), F.lit(32).alias("h"),
        enlarged(0).alias("r"), enlarged(1).alias("g"), enlarged(7).alias("b"),
    )


def encode_png(w: int, h: int, r, g, b) -> bytes:
    """RGB planes to a PNG, for fixtures that need encoded images."""
    import struct
    import zlib

    import numpy as np

    rgb = np.stack([np.asarray(p, dtype=np.uint8).reshape(h, w) for p in (r, g, b)], axis=2).reshape(h, w * 3)
    lines = np.concatenate([np.zeros((h, 1), np.uint8), rgb], axis=1).tobytes()

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    header = struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


def with_png(images: DataFrame) -> DataFrame:
    """Adds the tile as encoded bytes."""

    @F.pandas_udf("binary")
    def pack(w: pd.Series, h: pd.Series, r: pd.Series, g: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([encode_png(*row) for row in zip(w, h, r, g, b)])

    return images.withColumn("png", pack("w", "h", "r", "g", "b"))


def page_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata rows of web pages: one per HTML attribute and per part of the address."""
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), "url", "html")
    element = r"<([a-zA-Z][a-zA-Z0-9]*)\s+([^<>]*)>"
    attribute = r'([a-zA-Z-]+)="([^"]*)"'

    def every(text, pattern: str, group: int):
        return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))

    elements = pages.select("doc_id", F.explode(F.arrays_zip(
        every("html", element, 1).alias("directory"), every("html", element, 2).alias("body")
    )).alias("e")).select("doc_id", "e.directory", "e.body")
    attributes = elements.select("doc_id", "directory", F.explode(F.arrays_zip(
        every("body", attribute, 1).alias("tag_name"), every("body", attribute, 2).alias("description")
    )).alias("a")).select("doc_id", "directory", "a.tag_name", "a.description")
    parts = F.array(*[
        F.struct(F.lit("Page URL").alias("directory"), F.lit(tag).alias("tag_name"), F.try_parse_url(F.col("url"), F.lit(part)).alias("description"))
        for tag, part in (("Host Name", "HOST"), ("Scheme", "PROTOCOL"))
    ])
    return attributes.unionByName(pages.select("doc_id", F.explode(parts).alias("p")).select("doc_id", "p.*"))


def first_of_each_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch of query documents: the first one of every label."""
    rows = table(spark, sf_dir, "embeddings").groupBy("label").agg(
        F.min("vec_id").alias("query_id"), F.min_by("embedding", "vec_id").alias("embedding")
    )
    return rows.select("query_id", quantise(F.col("embedding")).alias("vec"))
