"""Many query images at once.

An exact batch is matched in scans of the documents, one for each chunk of queries. A chunk is bounded in numbers, so
what is shipped with the tasks is bounded however many queries there are; every Arrow batch of documents meets it in
blocks of bounded size, and each task keeps only its best rows per query. What is shuffled is ``tasks x queries x kept``
rows; no (query, document) pair is ever materialised as a row and no document is replicated. A batch with a hash is a
join on the hashes instead (``hash_join``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from lumisift.functions import hashing
from lumisift.functions.pairwise import pairwise, scores
from lumisift.operators.topk import top_n_per_group
from lumisift.plans.hash_join import hash_counts, hash_topk
from lumisift.plans.tiles import TILE, near_pairs

CHUNK_NUMBERS = 4_000_000
"""Vector elements of a chunk of queries (32 MB)."""
BLOCK_CELLS = 1_000_000
"""(document, query) cells scored at a time; at most ``dim`` times as many numbers are held for the stepwise metrics."""
CROWD = 64
HIT_SCHEMA = "query_id bigint, doc_id bigint, distance double, score double"


class Matcher:
    """Scores document batches against a chunk of queries and keeps the best rows per query."""

    def __init__(self, queries: pd.DataFrame, keep: int, metric: str):
        self.ids = queries["query_id"].to_numpy(np.int64)
        self.vecs = np.stack(queries["vec"].to_numpy()).astype(np.int64)
        self.keep, self.metric = keep, metric
        self.best = [np.empty((0, 2)) for _ in self.ids]  # doc_id is kept apart: it may not fit a double
        self.docs = [np.empty(0, np.int64) for _ in self.ids]

    def add(self, docs: pd.DataFrame) -> None:
        rows = max(1, BLOCK_CELLS // max(1, len(self.ids)))
        for start in range(0, len(docs), rows):
            self._add(docs.iloc[start : start + rows])

    def _add(self, docs: pd.DataFrame) -> None:
        ids = docs["doc_id"].to_numpy(np.int64)
        distances = pairwise(self.metric, np.stack(docs["vec"].to_numpy()).astype(np.int64), self.vecs)
        for j in range(len(self.ids)):
            mask = ~np.isnan(distances[:, j])
            new = np.stack([distances[mask, j], scores(distances[mask, j])], axis=1)
            held, all_ids = np.concatenate([self.best[j], new]), np.concatenate([self.docs[j], ids[mask]])
            order = np.lexsort((all_ids, -held[:, 1]))[: self.keep]
            self.best[j], self.docs[j] = held[order], all_ids[order]

    def result(self) -> pd.DataFrame:
        rows, lengths = np.concatenate(self.best), [len(d) for d in self.docs]
        return pd.DataFrame({"query_id": np.repeat(self.ids, lengths), "doc_id": np.concatenate(self.docs), "distance": rows[:, 0], "score": rows[:, 1]})


def query_chunks(queries: DataFrame, numbers: int) -> Iterator[pd.DataFrame]:
    """Queries in chunks of at most ``numbers`` vector elements, one chunk at a time on the driver."""
    held, size = [], 0
    for row in queries.select("query_id", "vec").filter("vec IS NOT NULL").toLocalIterator():
        if held and size + len(row.vec) > numbers:
            yield pd.DataFrame(held, columns=["query_id", "vec"])
            held, size = [], 0
        held.append((row.query_id, row.vec))
        size += len(row.vec)
    if held:
        yield pd.DataFrame(held, columns=["query_id", "vec"])


def batch_topk(
    index: DataFrame,
    queries: DataFrame,
    k: int,
    metric: str = "cosine",
    *,
    hash: str | None = None,
    bundle_aware: bool = False,
    limit: int = -1,
    per_shard: bool = False,
    probes: int = 0,
    chunk_numbers: int = CHUNK_NUMBERS,
) -> DataFrame:
    """``(query_id, doc_id, distance, score, rank)``: the best ``k`` documents of each query.

    With ``hash`` only documents sharing a hash with the query take part, with a positive ``limit`` only the ``limit`` of
    them with the largest overlap, in total or in each shard; ``probes`` are further hashes asked in each bundle. A batch without queries gives no rows.
    """
    if hash is not None:
        return hash_topk(index, queries, k, metric, hashing.hash_mode(hash), bundle_aware=bundle_aware, limit=limit, per_shard=per_shard, probes=probes)
    docs = index.filter(F.col("vec").isNotNull()).select("doc_id", "vec")

    def matched(chunk: pd.DataFrame) -> DataFrame:
        shipped = docs.sparkSession.sparkContext.broadcast(chunk)

        def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            matcher = Matcher(shipped.value, k, metric)
            for part in parts:
                matcher.add(part)
            yield matcher.result()

        return docs.mapInPandas(run, HIT_SCHEMA)

    hits = docs.sparkSession.createDataFrame([], HIT_SCHEMA)
    for chunk in query_chunks(queries, chunk_numbers):
        hits = hits.unionByName(matched(chunk))
    best = top_n_per_group(hits, ["query_id"], [F.col("score").desc(), F.col("doc_id")], k, ["doc_id"])
    return best.select("query_id", "doc_id", "distance", "score", "rank")


def candidate_counts(index: DataFrame, queries: DataFrame, hash: str, bundle_aware: bool = False, probes: int = 0) -> DataFrame:
    """``(query_id, candidates, docs)``: how much a hash search leaves to score."""
    return hash_counts(index, queries, hashing.hash_mode(hash), bundle_aware, probes)


def same_image(index: DataFrame, mode: str, metric: str = "cosine", threshold: float = 1.0, min_shared: int = 2) -> DataFrame:
    """``(a, b, shared, distance)``: pairs of different images within ``threshold`` that share at least
    ``min_shared`` hashes in place, plus a pair of distance 0 from each further document of one and the same
    vector to the first.

    Equal vectors are collapsed before, so a picture copied any number of times is one image here. Images are compared in
    tiles of two blocks (``plans.tiles``), where buckets of more than ``CROWD`` images are as good as small ones: what
    leaves a tile is near pairs, and the pairs reported are all there are.
    """
    sig = hashing.signature_column(mode)
    rows = index.filter(F.col("vec").isNotNull()).select("doc_id", "vec", F.col(sig).alias("sig"))
    heads = rows.groupBy("vec").agg(F.min("doc_id").alias("head"), F.count(F.lit(1)).alias("copies"))
    copies = rows.join(heads.filter("copies > 1"), "vec").filter("doc_id <> head")
    twins = copies.select(F.col("head").alias("a"), F.col("doc_id").alias("b"), F.size("sig").cast("bigint").alias("shared"), F.lit(0.0).alias("distance"))
    images = rows.join(heads.select(F.col("head").alias("doc_id")), "doc_id", "left_semi").withColumnRenamed("doc_id", "head")
    return near_pairs(images, metric, threshold, min_shared, TILE).unionByName(twins)
