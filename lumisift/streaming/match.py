"""Incoming images matched against stored signatures, and against each other."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lumisift.functions import hashing
from lumisift.functions.scoring import score_of
from lumisift.functions.vectors import distance
from lumisift.plans.tiles import near_pairs


def match_incoming(
    incoming: DataFrame,
    stored_postings: DataFrame,
    stored_features: DataFrame,
    mode: str,
    metric: str,
    threshold: float,
    min_shared: int = 1,
) -> DataFrame:
    """``(new_id, doc_id, shared, distance, score)`` for one micro-batch of new feature rows.

    The micro-batch is the small side; the join strategy is left to the optimizer, which broadcasts
    it only while its measured size allows. Shared bundles are counted before vectors are fetched, so
    each pair is scored once.
    """
    asked = hashing.postings(
        hashing.with_signature(incoming.select("doc_id", "vec"), mode), mode, ["doc_id"]
    ).select(F.col("doc_id").alias("new_id"), "bundle", "h")
    pairs = (
        stored_postings.select("doc_id", "bundle", "h")
        .join(asked, ["bundle", "h"])
        .groupBy("new_id", "doc_id")
        .agg(F.count(F.lit(1)).alias("shared"))
        .filter(F.col("shared") >= min_shared)
    )
    scored = (
        pairs.join(stored_features.select("doc_id", "vec"), "doc_id")
        .join(incoming.select(F.col("doc_id").alias("new_id"), F.col("vec").alias("new_vec")), "new_id")
        .withColumn("distance", distance(metric, F.col("vec"), F.col("new_vec")))
    )
    near = scored.filter(F.col("distance") <= threshold)
    return near.select("new_id", "doc_id", "shared", "distance", score_of(F.col("distance")).alias("score"))


def start_matching(
    stream: DataFrame, stored_postings: DataFrame, stored_features: DataFrame, alerts_path: str, checkpoint: str,
    mode: str = "BIT_SAMPLING", metric: str = "cosine", threshold: float = 1.0, min_shared: int = 1,
):
    """Writes the alerts of batch ``n`` to ``batch=n``; a replayed batch replaces its own output."""

    def write(batch: DataFrame, number: int) -> None:
        alerts = match_incoming(batch, stored_postings, stored_features, mode, metric, threshold, min_shared)
        alerts.write.mode("overwrite").parquet(f"{alerts_path}/batch={number}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def self_matches(
    stream: DataFrame, mode: str = "BIT_SAMPLING", metric: str = "cosine", threshold: float = 1.0, min_shared: int = 1,
    event_time: str | None = None, within: str | None = None, delay: str = "0 seconds",
) -> DataFrame:
    """``(a, b, shared, distance)``, ``a < b``, as a stream: images of one stream that are near each other, in the same
    micro-batch or in different ones.

    The stream's postings are joined with themselves on ``(bundle, h)``, so what has arrived is state that lies by bucket
    in the state store. A pair comes out once, from the first bundle it shares, with its distance taken there; no state is
    collected and nothing is looked up. With ``event_time`` only images at most ``within`` apart match, and older ones
    leave the state once the watermark, ``delay`` behind the newest, has passed them. A document that is sent again
    matches again: drop replays first (``ingest.unique_documents``).
    """
    times = [] if event_time is None else [event_time]
    rows = stream.select("doc_id", "vec", *times)
    if event_time is not None:
        rows = rows.withWatermark(event_time, delay)

    def side(name: str) -> DataFrame:
        signed = hashing.with_signature(rows, mode).withColumnRenamed(hashing.signature_column(mode), "sig")
        posted = signed.select("*", F.posexplode_outer("sig").alias("bundle", "h")).filter("h IS NOT NULL")
        columns = [F.col(c).alias(f"{c}_{name}") for c in ("vec", "sig", "bundle", "h")]
        return posted.select(F.col("doc_id").alias(name), *columns, *[F.col(c).alias(f"time_{name}") for c in times])

    met = (F.col("bundle_a") == F.col("bundle_b")) & (F.col("h_a") == F.col("h_b")) & (F.col("a") < F.col("b"))
    if event_time is not None:
        met = met & F.expr(f"time_b BETWEEN time_a - INTERVAL {within} AND time_a + INTERVAL {within}")
    same = F.zip_with("sig_a", "sig_b", lambda x, y: x == y)
    pairs = side("a").join(side("b"), met).withColumn("shared", F.size(F.filter(same, lambda x: x)).cast("bigint"))
    first = pairs.filter((F.array_position(same, True) - 1 == F.col("bundle_a")) & (F.col("shared") >= min_shared))
    judged = first.select("a", "b", "shared", F.explode_outer(F.array(distance(metric, F.col("vec_a"), F.col("vec_b")))).alias("distance"))
    return judged.filter(F.col("distance") <= threshold)


def start_self_matching(stream: DataFrame, alerts_path: str, checkpoint: str, event_time: str | None = None, **how):
    """Writes the matches of :func:`self_matches` to files, each once, and stops when what is available is processed.

    Without ``event_time`` nothing ever leaves, and state would hold every image once for each bundle, on either side. So
    what arrived lies with its signature in a table beside the checkpoint, a folder for each micro-batch, and a micro-batch is
    compared in tiles (``plans.tiles``) with itself and those before it. A batch that is run again replaces what it wrote.
    """
    if event_time is not None:
        writer = self_matches(stream, event_time=event_time, **how).writeStream.format("parquet").option("path", alerts_path)
        return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    return stream.writeStream.foreachBatch(_matcher(alerts_path, f"{checkpoint.rstrip('/')}-seen", **how)).option(
        "checkpointLocation", checkpoint
    ).trigger(availableNow=True).start()


def _matcher(alerts_path: str, seen: str, mode: str = "BIT_SAMPLING", metric: str = "cosine", threshold: float = 1.0, min_shared: int = 1):
    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        signed = hashing.with_signature(batch.select("doc_id", "vec").filter("vec IS NOT NULL"), mode)
        signed = signed.withColumnsRenamed({"doc_id": "head", hashing.signature_column(mode): "sig"})
        signed.write.mode("overwrite").parquet(f"{seen}/batch={number}")
        read = lambda *paths: spark.read.schema(signed.schema).parquet(*paths)
        earlier = read(*(f"{seen}/batch={n}" for n in range(number))) if number else None
        found = near_pairs(read(f"{seen}/batch={number}"), metric, threshold, min_shared, earlier=earlier)
        found.write.mode("overwrite").parquet(f"{alerts_path}/batch={number}")

    return write
