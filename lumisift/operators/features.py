"""Extraction of declared features, dense vectors, and what is missing."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lumisift.errors import QueryError
from lumisift.operators.descriptors import DESCRIPTORS, Tally, described
from lumisift.operators.registry import feature, feature_name, register_feature

LONG_COLUMNS = ("image_id", "feature", "bin", "value")


def register_descriptor(name: str, dim: int, metric: str, kind: Tally | Callable[[DataFrame], DataFrame]) -> None:
    """Add a descriptor of your own: a tally, or a function from image rows to ``(image_id, bin, value)``."""
    DESCRIPTORS[register_feature(name, dim, metric).name] = kind


def extract(images: DataFrame, names: Iterable[str]) -> DataFrame:
    """``(image_id, feature, bin, value)`` of several features.

    Tallies over one stencil are fused: their entries are exploded together and summed in a single
    aggregation, so all features of one stencil cost one pass over the pixels.
    """
    wanted = list(dict.fromkeys(feature_name(n) for n in names))
    unknown = [n for n in wanted if n not in DESCRIPTORS]
    if unknown:
        raise QueryError(f"no descriptor for {', '.join(unknown)}")
    fused, parts = defaultdict(list), []
    for name in wanted:
        kind = DESCRIPTORS[name]
        if isinstance(kind, Tally) and kind.finish is None:
            fused[kind.stencil].append(name)
        else:
            parts.append(described(images, kind).withColumn("feature", F.lit(name)))
    for stencil, members in fused.items():
        entries = [e.struct(feature=name) for name in members for e in DESCRIPTORS[name].entries()]
        parts.append(
            stencil(images)
            .select("image_id", F.explode(F.array(*entries)).alias("e"))
            .groupBy("image_id", F.col("e.feature").alias("feature"), F.col("e.bin").alias("bin"))
            .agg(F.sum("e.value").alias("value"))
            .filter(F.col("value") != 0)
        )
    out = parts[0].select(*LONG_COLUMNS)
    for part in parts[1:]:
        out = out.unionByName(part.select(*LONG_COLUMNS))
    return out


def fill(entries: Column, dim: Column) -> Column:
    """Sorted ``(bin, value)`` entries to a dense array: runs of zeros go between neighbours."""
    zero = F.lit(0).cast("bigint")
    start = F.array(F.struct(F.lit(-1).cast("bigint").alias("bin"), zero.alias("value")))
    before = F.slice(F.concat(start, entries), F.lit(1), F.size(entries))
    body = F.flatten(F.zip_with(
        before, entries, lambda p, e: F.concat(F.array_repeat(zero, (e["bin"] - p["bin"] - 1).cast("int")), F.array(e["value"]))
    ))
    last = F.coalesce(F.try_element_at(entries, F.lit(-1))["bin"], F.lit(-1).cast("bigint"))
    return F.concat(body, F.array_repeat(zero, (dim - 1 - last).cast("int")))


def dense(images: DataFrame, long: DataFrame, names: Iterable[str]) -> DataFrame:
    """``(image_id, feature, vec)`` for every image and feature; an image without bins gets zeros."""
    wanted = [feature(n) for n in names]
    spine = images.select(
        "image_id", F.explode(F.array(*[F.lit(f.name) for f in wanted])).alias("feature"),
        F.lit(-1).cast("bigint").alias("bin"), F.lit(0).cast("bigint").alias("value"),
    )
    dims = F.create_map(*[F.lit(x) for f in wanted for x in (f.name, f.dim)])
    cells = long.select(*LONG_COLUMNS).unionByName(spine)
    grouped = cells.groupBy("image_id", "feature").agg(F.collect_list(F.struct("bin", "value")).alias("cells"))
    entries = F.array_sort(F.filter("cells", lambda e: e["bin"] >= 0))
    return grouped.withColumn("entries", entries).select(
        "image_id", "feature", fill(F.col("entries"), F.element_at(dims, F.col("feature"))).alias("vec")
    )


def feature_table(images: DataFrame, names: Sequence[str]) -> DataFrame:
    names = [feature_name(n) for n in names]
    return dense(images, extract(images, names), names)


def wide(features: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per image with a vector column per feature."""
    return features.groupBy("image_id").pivot("feature", [feature_name(n) for n in names]).agg(F.first("vec"))


def vector_of_image(spark: SparkSession, payload: bytes, name: str) -> list[int]:
    """Vector of one encoded image, through the same decode, cap and extraction as stored ones."""
    from lumisift.sources.images import decode_images

    one = spark.createDataFrame([(0, bytearray(payload))], "image_id bigint, content binary")
    decoded = decode_images(one).filter(F.col("error").isNull()).drop("error")
    row = feature_table(decoded, [name]).select("vec").limit(1).head()
    if row is None:
        raise QueryError("the image of the query cannot be decoded")
    return list(row.vec)


# --- completeness --------------------------------------------------------------------------------


def expected_pairs(docs: DataFrame, names: Sequence[str], key: str = "doc_id") -> DataFrame:
    return docs.select(key, F.explode(F.array(*[F.lit(feature_name(n)) for n in names])).alias("feature"))


def missing_features(docs: DataFrame, features: DataFrame, names: Sequence[str], key: str = "doc_id") -> DataFrame:
    """Declared (document, feature) pairs with no stored vector."""
    return expected_pairs(docs, names, key).join(features.select(key, "feature"), [key, "feature"], "left_anti")


def backfill(images: DataFrame, existing: DataFrame, names: Sequence[str]) -> DataFrame:
    """Vectors of the missing pairs only, after a mapping gained features."""
    names = [feature_name(n) for n in names]
    have = existing.filter(F.col("feature").isin(names)).groupBy("image_id").agg(F.collect_set("feature").alias("have"))
    todo = images.join(have, "image_id", "left").filter(F.size(F.coalesce("have", F.array().cast("array<string>"))) < len(set(names)))
    made = feature_table(todo.drop("have"), names)  # images that lack any feature go through the pixels once, for all of them
    return made.join(existing.select("image_id", "feature"), ["image_id", "feature"], "left_anti")


def require_complete(docs: DataFrame, features: DataFrame, names: Sequence[str], key: str = "doc_id") -> DataFrame:
    """Strict mode: reading the result fails if any declared pair has no vector."""
    pairs = expected_pairs(docs, names, key).join(features, [key, "feature"], "left")
    failure = F.raise_error(F.concat(F.lit("no vector for feature "), F.col("feature")))
    return pairs.withColumn("vec", F.coalesce("vec", failure.cast("array<bigint>")))
