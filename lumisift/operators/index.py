"""From documents with an image field to everything the field's mapping declares."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from lumisift.functions import hashing
from lumisift.operators import features, metadata
from lumisift.session import shared_folder
from lumisift.sources import documents, images, sinks
from lumisift.sources.mapping import ImageMapping


@dataclass(frozen=True)
class Indexed:
    """What indexing makes: a row for each document and feature, posting rows, and documents that failed."""

    index: DataFrame
    postings: DataFrame
    errors: DataFrame


def index_documents(
    docs: DataFrame, tags: DataFrame, field: str, mapping: ImageMapping, excludes: Sequence[str] = (), *, mode: str = "PERMISSIVE",
    max_side: int = images.MAX_SIDE, features_path: str | None = None, postings_table: str | None = None, buckets: int = 64,
) -> Indexed:
    """Index documents ``doc_id, <field> (base64), ...`` with metadata rows ``doc_id, directory, tag_name, description``.

    Each image is decoded and capped once; the planes are written to the shared folder and all declared
    features are taken from there. A signature column is filled for the features whose mapping names its
    hash and NULL for the others. Documents without a decodable image are listed in ``errors``, or fail the
    job with ``mode="FAILFAST"``. With paths the feature and posting tables are written too, and read back.
    """
    spark = docs.sparkSession
    content = documents.with_content(docs, field, mode)
    sent = content.select(F.col("doc_id").alias("image_id"), "content", "error")
    path = shared_folder(spark, "planes")
    images.decode_images(sent, max_side).write.parquet(path)
    planes = spark.read.parquet(path)
    broken = planes.filter("error IS NOT NULL").select(F.col("image_id").alias("doc_id"), "error")
    if mode == "FAILFAST":
        planes = planes.withColumn("w", F.coalesce("w", F.raise_error(F.concat(F.lit("image not decodable: "), "error")).cast("int")))
    good = planes.filter("error IS NULL").drop("error")
    vectors = features.feature_table(good, list(mapping.features)).withColumnRenamed("image_id", "doc_id")
    for hash_mode in hashing.MODES:
        named = [f for f, modes in mapping.features.items() if hash_mode in modes]
        if named:
            wanted = F.when(F.col("feature").isin(named), F.col("vec"))
            name = hashing.signature_column(hash_mode)
            # the schema says which features the hash is declared for, so that a search need not look at rows
            vectors = vectors.select("*", hashing.signature(wanted, hash_mode).alias(name, metadata={hashing.DECLARED: named}))
    vectors = vectors.withColumn("field", F.lit(field))
    if features_path is not None:
        made = shared_folder(spark, "vectors")  # laying rows out by ranges reads them twice, which is cheaper than making them twice
        vectors.write.parquet(made)
        sinks.write_features(spark.read.parquet(made), features_path)
        vectors = spark.read.parquet(features_path)
    posted = None
    for hash_mode in hashing.MODES:
        if hashing.signature_column(hash_mode) in vectors.columns:
            part = hashing.postings(vectors, hash_mode, ["doc_id", "field", "feature"])
            posted = part if posted is None else posted.unionByName(part)
    if posted is None:
        posted = spark.createDataFrame([], "doc_id bigint, field string, feature string, hash_mode string, bundle bigint, h bigint")
    if postings_table is not None:
        sinks.write_postings(posted, postings_table, f"{shared_folder(spark, 'postings')}", buckets)
        posted = spark.table(postings_table)
    declared = {key: options["type"] for key, options in mapping.metadata.items()}
    stored = documents.stored_source(docs, list(excludes))
    stored = metadata.attach(stored, tags, declared) if declared else stored
    return Indexed(stored.join(vectors, "doc_id"), posted, broken)
