"""Batch hash search as a join: candidates come from equal hashes, and only candidates are scored.

Documents and queries meet on ``(bundle, h)``, or on ``h`` where the position of a hash does not count, and neither side
passes through the driver. Work follows the candidates, not documents times queries:

* Equal vectors are one candidate. Of a group of copies the first ids are kept, as many as a query could want, and a
  vector that is asked many times is searched once.
* A search without a limit joins in tiles of a block of documents and a block of queries (``plans.tiles``): candidates are scored where they
  meet, and a tile gives back the best of each query.
* A search with a limit, and counts of candidates, join tables of postings. A bucket that holds more than ``1 / HOT`` of all postings is split into parts
  by the document; the queries that ask for it visit every part. There are at most ``HOT`` such buckets, so their list may be
  broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from lumisift.functions import hashing
from lumisift.functions.scoring import score_of
from lumisift.functions.vectors import distance
from lumisift.operators.topk import top_n_per_group
from lumisift.plans.tiles import best_hits

HOT = 200
"""A bucket is split if it holds more than this part of all postings."""


def distinct_documents(index: DataFrame, mode: str, keep: int, per_shard: bool = False) -> DataFrame:
    """``(doc_id, head, shard, vec, sig)``: the first ``keep`` documents of each vector; ``head`` is the first of them."""
    shard = F.col("shard").cast("bigint") if per_shard else F.lit(0).cast("bigint")
    rows = index.filter(F.col("vec").isNotNull()).select("doc_id", shard.alias("shard"), "vec", F.col(hashing.signature_column(mode)).alias("sig"))
    few = top_n_per_group(rows, ["vec", "shard"], [F.col("doc_id")], keep, ["doc_id"]).drop("rank")
    return few.withColumn("head", F.min("doc_id").over(Window.partitionBy("vec", "shard")))


def distinct_queries(queries: DataFrame, mode: str, probes: int = 0) -> DataFrame:
    """``(asked, vec, sig)``: each query vector once, under the smallest id that asks it; with ``probes`` also the nearest
    other hashes of each bundle as ``near``."""
    heads = queries.filter(F.col("vec").isNotNull()).groupBy("vec").agg(F.min("query_id").alias("asked"))
    near = [hashing.probes(F.col("vec"), mode, probes).alias("near")] if probes else []
    return heads.select("asked", "vec", hashing.signature(F.col("vec"), mode).alias("sig"), *near)


def _posted(heads: DataFrame, bundle_aware: bool) -> DataFrame:
    """``(head, bundle, h)``; without regard to positions a hash of a document counts once."""
    if bundle_aware:
        rows = heads.select("head", F.posexplode_outer("sig").alias("bundle", "h"))
    else:
        rows = heads.select("head", F.lit(0).alias("bundle"), F.explode_outer(F.array_distinct("sig")).alias("h"))
    return rows.filter(F.col("h").isNotNull())


def _asked(heads: DataFrame, bundle_aware: bool) -> DataFrame:
    """``(asked, bundle, h, times)``; without regard to positions repeats of a query's hash count."""
    if "near" in heads.columns:
        rows = heads.select("asked", F.posexplode_outer("near").alias("bundle", "hs"))
        return rows.select("asked", "bundle", F.explode_outer("hs").alias("h"), F.lit(1).cast("bigint").alias("times")).filter(F.col("h").isNotNull())
    if bundle_aware:
        rows = heads.select("asked", F.posexplode_outer("sig").alias("bundle", "h"), F.lit(1).cast("bigint").alias("times"))
        return rows.filter(F.col("h").isNotNull())
    counted = F.transform(
        F.array_distinct("sig"), lambda h: F.struct(h.alias("h"), F.size(F.filter("sig", lambda x: x == h)).cast("bigint").alias("times"))
    )
    return heads.select("asked", F.lit(0).alias("bundle"), F.inline_outer(counted)).filter(F.col("h").isNotNull())


def candidates(documents: DataFrame, queries: DataFrame, bundle_aware: bool = False, hot: int = HOT) -> DataFrame:
    """``(asked, head, overlap)`` for every pair with a hash in common, of ``(head, sig)`` and ``(asked, sig)``."""
    posted, asked = _posted(documents, bundle_aware), _asked(queries, bundle_aware)
    sizes = posted.groupBy("bundle", "h").agg(F.count(F.lit(1)).alias("size"))
    total = sizes.agg(F.sum("size").alias("total"))
    split = sizes.crossJoin(F.broadcast(total)).filter(F.col("size") * hot > F.col("total"))  # one row; at most `hot` are left
    split = F.broadcast(split.select("bundle", "h", F.ceil(F.col("size") * hot / F.col("total")).cast("int").alias("parts")))
    part = F.coalesce(F.pmod(F.xxhash64("head"), F.col("parts")).cast("int"), F.lit(0))
    posted = posted.join(split, ["bundle", "h"], "left").select("head", "bundle", "h", part.alias("part"))
    visits = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("parts"), F.lit(1)) - 1))
    asked = asked.join(split, ["bundle", "h"], "left").select("asked", "bundle", "h", "times", visits.alias("part"))
    return posted.join(asked, ["bundle", "h", "part"]).groupBy("asked", "head").agg(F.sum("times").alias("overlap"))


def _scored(pairs: DataFrame, documents: DataFrame, queries: DataFrame, metric: str) -> DataFrame:
    """The pairs with ``distance`` and ``score``, each computed once."""
    left = documents.select("head", F.col("vec").alias("vec_d"))
    right = queries.select("asked", F.col("vec").alias("vec_q"))
    both = pairs.join(left, "head").join(right, "asked")
    hit = F.transform(F.array(distance(metric, F.col("vec_d"), F.col("vec_q"))), lambda x: F.struct(x.alias("distance"), score_of(x).alias("score")))
    return both.select(*pairs.columns, F.inline_outer(hit)).filter(F.col("score").isNotNull())


def hash_topk(
    index: DataFrame, queries: DataFrame, k: int, metric: str, mode: str, *, bundle_aware: bool = False, limit: int = -1, per_shard: bool = False,
    probes: int = 0,
) -> DataFrame:
    """``(query_id, doc_id, distance, score, rank)``: the best ``k`` of the documents that share a hash with the query.

    With a positive ``limit`` only the ``limit`` of them with the largest overlap take part, in total or in each shard.
    With ``probes`` a query asks in each bundle for that many of its nearest other hashes too (hashes in place only), and
    the overlap counts the bundles that answer. Vectors of null and tables without rows give none; equal scores are ranked
    by ``doc_id``.
    """
    bundle_aware = bundle_aware or probes > 0
    members = distinct_documents(index, mode, max(k, limit), per_shard and limit > 0)
    heads, asked = members.filter("doc_id = head"), distinct_queries(queries, mode, probes)
    if limit > 0:
        of_shard = candidates(heads, asked, bundle_aware).join(heads.select("head", "shard"), "head")
        order = lambda key: [F.col("overlap").desc(), F.col(key)]
        few = top_n_per_group(of_shard, ["asked", "shard"], order("head"), limit, ["head"]).drop("rank")
        few = few.join(members.select("head", "doc_id"), "head")
        few = top_n_per_group(few, ["asked", "shard"], order("doc_id"), limit, ["doc_id"]).select("asked", "head", "doc_id")
        hits = _scored(few, heads, asked, metric)
    else:
        hits = best_hits(heads, asked, k, bundle_aware, metric)
        best = top_n_per_group(hits, ["asked"], [F.col("score").desc(), F.col("head")], k, ["head"]).drop("rank")
        hits = best.join(members.select("head", "doc_id"), "head")
    best = top_n_per_group(hits, ["asked"], [F.col("score").desc(), F.col("doc_id")], k, ["doc_id"])
    all_of_them = queries.filter(F.col("vec").isNotNull()).select("query_id", "vec").join(asked.select("vec", "asked"), "vec")
    return all_of_them.join(best, "asked").select("query_id", "doc_id", "distance", "score", "rank")


def hash_counts(index: DataFrame, queries: DataFrame, mode: str, bundle_aware: bool = False, probes: int = 0) -> DataFrame:
    """``(query_id, candidates, docs)``: how much a hash search leaves to score, for every query with a vector."""
    rows = index.filter(F.col("vec").isNotNull()).select("doc_id", "vec", F.col(hashing.signature_column(mode)).alias("sig"))
    heads = rows.groupBy("vec", "sig").agg(F.min("doc_id").alias("head"), F.count(F.lit(1)).alias("copies"))
    asked = distinct_queries(queries, mode, probes)
    found = candidates(heads, asked, bundle_aware or probes > 0).join(heads.select("head", "copies"), "head")
    found = found.groupBy("asked").agg(F.sum("copies").alias("candidates"))
    of = queries.filter(F.col("vec").isNotNull()).select("query_id", "vec").join(asked.select("vec", "asked"), "vec").join(found, "asked", "left")
    docs = rows.agg(F.count(F.lit(1)).alias("docs"))  # one row
    return of.crossJoin(F.broadcast(docs)).select("query_id", F.coalesce("candidates", F.lit(0)).cast("bigint").alias("candidates"), "docs")
