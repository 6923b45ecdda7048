"""Images the distance rule calls the same, as classes: a row for each document instead of a row for each pair.

Documents of equal vectors are one image. Images meet in tiles of two blocks (``plans.tiles``) and there in the buckets of
their hashes. For classes, images of a bucket of more than ``CROWD`` are compared with its first one before, and only images
that are not connected yet are compared after, so a crowd of near images is not compared pair by pair; a tile gives back at
most a row for each of its images. `image_links` counts links and so has to compare all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lumisift.functions import hashing
from lumisift.functions.vectors import distance
from lumisift.operators.components import components, looked_up, written
from lumisift.plans.hash_join import HOT
from lumisift.plans.tiles import CROWD, TILE, connections, link_counts


def _heads(index: DataFrame, mode: str) -> tuple[DataFrame, DataFrame]:
    """Documents with a vector and their images ``(head, vec, sig, copies)``."""
    rows = index.filter(F.col("vec").isNotNull()).select("doc_id", "vec", F.col(hashing.signature_column(mode)).alias("sig"))
    return rows, rows.groupBy("vec", "sig").agg(F.min("doc_id").alias("head"), F.count(F.lit(1)).alias("copies"))


def image_classes(
    index: DataFrame, mode: str, metric: str = "cosine", threshold: float = 1.0, min_shared: int = 1, *, tile: int = TILE, crowd: int = CROWD, hot: int = HOT
) -> DataFrame:
    """``(doc_id, class_id, distance)`` for every document with a vector.

    Two documents are linked if their distance is within ``threshold`` and they share at least ``min_shared`` hashes in
    place, or if their vectors are equal. A class is what links connect, named by its smallest document, its
    representative; ``distance`` is the one to the representative (NULL where the metric has none). An empty table gives
    no rows. ``tile`` is the images of a block; ``hot`` has no effect any more, as buckets are not gathered in tasks.
    """
    rows, heads = _heads(index, mode)
    heads = written(heads, "images")
    joined = components(connections(heads, metric, threshold, min_shared, tile, crowd)).select(F.col("node").alias("head"), F.col("root").alias("class_id"))
    named = heads.select("head", "vec").join(joined, "head", "left").select("head", "vec", F.coalesce("class_id", "head").alias("class_id"))
    first = heads.select(F.col("head").alias("node"), F.col("vec").alias("root"))
    judged = looked_up(named, "class_id", "head", first)
    judged = judged.select("vec", "class_id", F.explode_outer(F.array(distance(metric, F.col("vec"), F.col("found")))).alias("distance"))
    return rows.select("doc_id", "vec").join(judged, "vec").select("doc_id", "class_id", "distance")


def image_links(
    index: DataFrame, mode: str, metric: str = "cosine", threshold: float = 1.0, min_shared: int = 1, *, tile: int = TILE, crowd: int = CROWD, hot: int = HOT
) -> DataFrame:
    """``(doc_id, links)``: with how many documents a document is linked, by the rule of :func:`image_classes`.

    All images of a bucket are compared, so the work is the square of a bucket's different images; ``crowd`` and ``hot`` have
    no effect. A tile gives back a row for each of its images.
    """
    rows, heads = _heads(index, mode)
    heads = written(heads, "images")
    found = link_counts(heads, metric, threshold, min_shared, tile)
    of = heads.join(found, "head", "left").select("vec", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    return rows.select("doc_id", "vec").join(of, "vec").select("doc_id", "links")
