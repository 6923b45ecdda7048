"""Continuous ingest: new documents become features and postings, and a document sent again replaces itself."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from lumisift.functions import hashing
from lumisift.operators.index import index_documents
from lumisift.sources.mapping import ImageMapping
from lumisift.streaming import commits

FEATURES, POSTINGS, ERRORS = "features", "postings", "errors"
TAGS = "doc_id bigint, directory string, tag_name string, description string"


def unique_documents(stream: DataFrame, event_time: str, delay: str, keys: tuple[str, ...] = ("doc_id", "version")) -> DataFrame:
    """Drops replays of a document version that arrive within the watermark delay."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def _once(batch: DataFrame) -> DataFrame:
    keys = [c for c in ("doc_id", "version") if c in batch.columns]
    return batch.dropDuplicates(keys) if keys else batch


def _postings(features: DataFrame) -> DataFrame:
    """Posting rows of all signatures that stored features have."""
    keys = [c for c in ("doc_id", "version", "field", "feature") if c in features.columns]
    parts = [hashing.postings(features, mode, keys) for mode in hashing.MODES if hashing.signature_column(mode) in features.columns]
    out = parts[0] if parts else features.select(*keys, F.lit("").alias("hash_mode"), F.lit(0).alias("bundle"), F.lit(0).alias("h")).filter("false")
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _start(stream: DataFrame, tables: Callable[[DataFrame], dict], store: str, checkpoint: str):
    """Processes what is available and stops. Every micro-batch is one commit of the store; a batch that is run again
    after a failure is committed once. The stream's id lies with its checkpoint, so a stream that starts afresh gets a
    new one."""
    stream_id = _stream_id(stream.sparkSession, checkpoint)

    def write(batch: DataFrame, number: int) -> None:
        commits.commit(batch.sparkSession, store, tables(_once(batch)), stream_id, number)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def start_ingest(stream: DataFrame, to_features: Callable[[DataFrame], DataFrame], store: str, checkpoint: str, mode: str = "BIT_SAMPLING"):
    """Ingest of rows that ``to_features`` turns into feature rows. The signature is computed once, with the features, and
    the postings are made from the features as written."""
    make = lambda batch: {
        FEATURES: lambda written: hashing.with_signature(to_features(batch), mode),
        POSTINGS: lambda written: _postings(written(FEATURES)),
    }
    return _start(stream, make, store, checkpoint)


def start_indexing(
    stream: DataFrame, field: str, mapping: ImageMapping, store: str, checkpoint: str, tags: DataFrame | None = None, excludes: Sequence[str] = ()
):
    """Ingest of documents with an image field by the field's mapping: each image is decoded once, and the declared
    features, hashes and metadata, the postings and the documents that failed are committed together."""

    def make(batch: DataFrame) -> dict:
        rows = batch.sparkSession.createDataFrame([], TAGS) if tags is None else tags
        indexed = index_documents(batch, rows, field, mapping, excludes)
        return {FEATURES: lambda written: indexed.index, POSTINGS: lambda written: _postings(written(FEATURES)), ERRORS: lambda written: indexed.errors}

    return _start(stream, make, store, checkpoint)


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    path = f"{checkpoint.rstrip('/')}-id"
    try:
        return spark.read.text(path).head()[0]
    except AnalysisException:
        made = uuid.uuid4().hex
        spark.createDataFrame([(made,)], "id string").coalesce(1).write.mode("overwrite").text(path)
        return made


def ingested(spark: SparkSession, store: str, table: str = FEATURES, key: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The rows of each document's latest version, from the last commit that brought it, whichever stream that was.

    Versions are compared first where rows have them; then the order of commits decides. What is not committed does not
    count.
    """
    return _latest(commits.committed(spark, store, table), key).drop("commit")


def _latest(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    order = [c for c in ("version", "commit") if c in rows.columns]
    last = rows.groupBy(*key).agg(F.max(F.struct(*order)).alias("__last"))
    same = F.lit(True)
    for name in order:
        same = same & F.col(name).eqNullSafe(F.col(f"__last.{name}"))
    return rows.join(last, list(key)).filter(same).drop("__last")


def compact(spark: SparkSession, store: str, tables: Sequence[str] = (FEATURES, POSTINGS), key: Sequence[str] = ("doc_id",)) -> None:
    """Writes the latest rows of all commits so far as one. Commits that come meanwhile stay as they are; files of the
    old ones are left to readers that have begun."""
    rows = commits.live(spark, store)
    if len(rows) < 2:
        return
    last = max(r.covers if r.covers is not None else r.number for r in rows)
    made = {name: (lambda written, name=name: _latest(_up_to(spark, store, name, last), key).drop("commit")) for name in tables}
    commits.commit(spark, store, made, covers=last)


def _up_to(spark: SparkSession, store: str, name: str, last: int) -> DataFrame:
    return commits.committed(spark, store, name).filter(F.col("commit") <= last)
