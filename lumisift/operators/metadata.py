"""Image metadata: ``(doc_id, directory, tag_name, description)`` rows to typed, filterable columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lumisift.sources.mapping import SCALAR_TYPES


def _part(name: str) -> Column:
    return F.regexp_replace(F.lower(F.col(name)), r"\s+", "_")


def tag_key() -> Column:
    """``directory.tag_name`` in lower case with runs of white space as underscores."""
    return F.concat(_part("directory"), F.lit("."), _part("tag_name"))


def normalised(tags: DataFrame) -> DataFrame:
    return tags.select("doc_id", tag_key().alias("key"), "description")


def declared_only(tags: DataFrame, declared: Sequence[str]) -> DataFrame:
    """Rows of declared keys; the list comes from the mapping and becomes a literal filter."""
    return normalised(tags).filter(F.col("key").isin(list(declared)))


def typed(values: Column, type_name: str) -> Column:
    return values.try_cast(SCALAR_TYPES[type_name])


def with_errors(rows: DataFrame, declared: Mapping[str, str], ignore_errors: bool = True) -> DataFrame:
    """Adds ``error`` where a description does not read as its declared type, or fails the job."""
    bad = None
    for key, type_name in declared.items():
        mine = (F.col("key") == key) & F.col("description").isNotNull() & typed(F.col("description"), type_name).isNull()
        bad = mine if bad is None else bad | mine
    message = F.concat(F.lit("metadata not readable as declared: "), F.col("key"))
    if ignore_errors:
        return rows.withColumn("error", F.when(bad, message))
    return rows.withColumn("error", F.when(bad, F.raise_error(message).cast("string")))


def multi_valued(rows: DataFrame) -> DataFrame:
    """All occurrences of a key of a document, in order."""
    return rows.groupBy("doc_id", "key").agg(F.sort_array(F.collect_list("description")).alias("values"))


def typed_columns(tags: DataFrame, declared: Mapping[str, str]) -> DataFrame:
    """One row per document and an array column of the declared type per key.

    One aggregation with conditional lists: no pivot job to discover keys, no join per key.
    """
    rows = declared_only(tags, list(declared))
    aggregates = [
        F.sort_array(F.collect_list(F.when(F.col("key") == key, typed(F.col("description"), kind)))).alias(key)
        for key, kind in declared.items()
    ]
    return rows.groupBy("doc_id").agg(*aggregates)


def attach(docs: DataFrame, tags: DataFrame, declared: Mapping[str, str]) -> DataFrame:
    """Documents with their metadata columns; nothing is read when no metadata is declared."""
    if not declared:
        return docs
    return docs.join(typed_columns(tags, declared), "doc_id", "left")
