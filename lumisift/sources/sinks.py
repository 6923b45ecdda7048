"""Feature and posting tables on storage."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lumisift.errors import MappingError


def write_features(features: DataFrame, path: str, mode: str = "overwrite", row_group_bytes: int = 16 << 20) -> None:
    """Partitioned by feature, so that a search reads one directory and only the columns it needs; within a feature in
    ranges of ``doc_id``, so that a lookup of one document skips all files and row groups but one by their bounds, and
    those that are left by their Bloom filters."""
    laid_out = features.repartitionByRange("feature", "doc_id").sortWithinPartitions("feature", "doc_id")
    writer = laid_out.write.mode(mode).option("parquet.block.size", row_group_bytes)
    writer.option("parquet.bloom.filter.enabled#doc_id", "true").partitionBy("feature").parquet(path)


def write_postings(postings: DataFrame, table: str, path: str, buckets: int, mode: str = "overwrite", row_group_bytes: int = 16 << 20) -> None:
    """Partitioned by feature and hash mode, bucketed and sorted by hash.

    A search asks for a few dozen literal hash values: bucket pruning leaves as many buckets, the sort a few row groups in
    each, and their Bloom filters drop those whose bounds only span a value. Rows are dealt by the hash before they are
    written, so that a bucket is one file and not one for each task.
    """
    if buckets < 1:
        raise MappingError("buckets must be positive")
    writer = postings.repartition(buckets, "h").write.mode(mode).format("parquet").option("path", path)
    writer = writer.option("parquet.block.size", row_group_bytes).option("parquet.bloom.filter.enabled#h", "true")
    writer.partitionBy("feature", "hash_mode").bucketBy(buckets, "h").sortBy("h").saveAsTable(table)


def write_planes(images: DataFrame, table: str, path: str, buckets: int, mode: str = "overwrite") -> None:
    """Decoded plane rows, bucketed by image.

    Decoding is the costly step of ingest, so it is done once and kept; every descriptor then reads
    the table without decoding and, being laid out by image, without any exchange.
    """
    if buckets < 1:
        raise MappingError("buckets must be positive")
    rows = images.select("image_id", "w", "h", "r", "g", "b").filter("w IS NOT NULL")
    laid_out = rows.repartition(buckets, "image_id")
    laid_out.write.mode(mode).format("parquet").option("path", path).bucketBy(buckets, "image_id").saveAsTable(table)
