"""Documents with base64 images: decoding, rejection, and the stored source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

NO_CONTENT = "the document carries no image"


def with_content(docs: DataFrame, field: str, mode: str = "PERMISSIVE") -> DataFrame:
    """Adds ``content`` (bytes) and ``error``; in FAILFAST mode reading a bad row fails the job."""
    content = F.try_to_binary(F.col(field), F.lit("base64"))
    if mode.upper() == "FAILFAST":
        failed = F.raise_error(F.lit(NO_CONTENT)).cast("binary")
        return docs.withColumn("content", F.coalesce(content, failed)).withColumn("error", F.lit(None).cast("string"))
    return docs.withColumn("content", content).withColumn(
        "error",
        F.when(F.col(field).isNull(), F.lit(NO_CONTENT)).when(F.col("content").isNull(), F.lit("the image is not base64")),
    )


def accepted(docs: DataFrame) -> DataFrame:
    return docs.filter(F.col("error").isNull()).drop("error")


def quarantined(docs: DataFrame) -> DataFrame:
    return docs.filter(F.col("error").isNotNull())


def stored_source(docs: DataFrame, excludes: Sequence[str]) -> DataFrame:
    return docs.drop(*excludes)
