"""How good and how selective hash search is."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lumisift.plans.batch import batch_topk, candidate_counts


def recall_at_k(exact: DataFrame, found: DataFrame) -> DataFrame:
    """``(query_id, wanted, hit)``: how many of the exact top results a search returned."""
    got = found.select("query_id", "doc_id").withColumn("got", F.lit(1))
    return (
        exact.join(got, ["query_id", "doc_id"], "left")
        .groupBy("query_id")
        .agg(F.count(F.lit(1)).alias("wanted"), F.count("got").alias("hit"))
    )


def hash_quality(
    index: DataFrame, queries: DataFrame, k: int, hash: str, metric: str = "cosine", bundle_aware: bool = False, probes: int = 0, limit: int = -1, **how
) -> DataFrame:
    """Recall against the scan together with the number of documents left to score."""
    exact = batch_topk(index, queries, k, metric, **how)
    found = batch_topk(index, queries, k, metric, hash=hash, bundle_aware=bundle_aware, probes=probes, limit=limit)
    counts = candidate_counts(index, queries, hash, bundle_aware, probes)
    if limit > 0:
        counts = counts.withColumn("candidates", F.least("candidates", F.lit(limit).cast("bigint")))
    return recall_at_k(exact, found).join(counts, "query_id")


def document_frequency(postings: DataFrame) -> DataFrame:
    """Documents per hash term; a document counts once however many of its bundles carry the term.

    Bundles are folded per (document, term) first, so a hot term arrives as partial counts.
    """
    return (
        postings.groupBy("feature", "hash_mode", "h", "doc_id").agg(F.count(F.lit(1)).alias("times"))
        .groupBy("feature", "hash_mode", "h")
        .agg(F.count(F.lit(1)).alias("doc_freq"), F.sum("times").alias("postings"))
    )


def hot_terms(frequencies: DataFrame, docs: int, share: float = 0.1) -> DataFrame:
    """Terms carried by more than ``share`` of the documents."""
    return frequencies.filter(F.col("doc_freq") > docs * share)


def query_term_frequency(postings: DataFrame, hashes: list[int]) -> DataFrame:
    """Document frequency of the terms of one query."""
    return document_frequency(postings.filter(F.col("h").isin(sorted(set(hashes)))))


