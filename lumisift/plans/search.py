"""Image search over an index table.

An index table has one row per (document, field, feature)::

    index, type, doc_id, routing, shard, field, feature, vec ARRAY<BIGINT>,
    sig_bit_sampling ARRAY<BIGINT>, sig_lsh ARRAY<BIGINT>, ...any scalar columns

The query vector is resolved first (one document or one image, so a few hundred numbers) and enters
the plan as a literal. A scan search is then a single stage - scan, project, top-k - with no join and
no shuffle, and filters on ``feature``, ``field`` or any scalar reach the Parquet reader.

Two ways find hash candidates, with equal results:

* inline - the signature is a column of the index table, so candidates and scores come from one scan;
* postings - ``(h, doc_id)`` rows bucketed by ``h``; the literal ``IN`` list prunes buckets and row
  groups, and the rows of other documents are dropped before they are scored. Right when hashes are
  selective.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from lumisift.errors import QueryError
from lumisift.functions import hashing
from lumisift.functions.scoring import explanation, score_of
from lumisift.functions.vectors import distance, int_literal
from lumisift.operators.registry import metric_of
from lumisift.operators.topk import top_n_per_group
from lumisift.plans.request import ImageQuery
from lumisift.sources.mapping import ImageMapping

Declared = Mapping[str, ImageMapping]


def clause_rows(index: DataFrame, field: str, feature: str) -> DataFrame:
    """Rows of one feature field; documents without the feature take no part."""
    return index.filter((F.col("field") == field) & (F.col("feature") == feature) & F.col("vec").isNotNull())


def stored_vector(
    lookup: DataFrame, *, index: str | None, type: str, id: object, path: str, feature: str, routing: str | None = None
) -> list[int]:
    """Feature vector of a stored document, read back rather than extracted again."""
    rows = clause_rows(lookup, path, feature).filter((F.col("type") == type) & (F.col("doc_id") == F.lit(id)))
    if "deleted" in lookup.columns:
        rows = rows.filter(~F.coalesce(F.col("deleted"), F.lit(False)))
    if index is not None:
        rows = rows.filter(F.col("index") == index)
    if routing is not None:
        rows = rows.filter(F.col("routing") == routing)
    found = rows.select("vec").limit(2).collect()
    if not found:
        raise QueryError("the query document has no such feature or is not live")
    if len(found) > 1:
        raise QueryError("several vectors match the query document: name its index, or look it up among latest versions")
    return list(found[0].vec)


def query_vector(index: DataFrame, query: ImageQuery, lookup: DataFrame | None = None) -> list[int]:
    """The query side of a request; an image wins over a lookup."""
    if query.image is not None:
        from lumisift.operators.features import vector_of_image

        return vector_of_image(index.sparkSession, query.image, query.feature)
    return stored_vector(
        index if lookup is None else lookup,
        index=query.index, type=query.type, id=query.id, path=query.path,
        feature=query.feature, routing=query.routing,
    )


def query_signature(mode: str, vec: Sequence[int]) -> list[int]:
    """Signature of the query vector, from the same function the index was built with."""
    return [int(h) for h in hashing.signatures_of(hashing.hash_mode(mode), np.array([vec], dtype=np.int64))[0]]


def scored(rows: DataFrame, vec: Sequence[int], metric: str, boost: float = 1.0) -> DataFrame:
    """Distance and score, each computed once per row.

    As plain columns they would be copied into the filter on the score, which the optimizer moves below
    them; the rows of a generator are not. The query's squared length is a number from the start.
    """
    d = distance(metric, F.col("vec"), int_literal(vec), F.lit(float(sum(int(v) * int(v) for v in vec))))
    hit = F.transform(F.array(d), lambda x: F.struct(x.alias("distance"), score_of(x, boost).alias("score")))
    return rows.select("*", F.inline_outer(hit)).filter(F.col("score").isNotNull())


def shares_hash(sig: Column, hashes: Sequence[int], bundle_aware: bool = False) -> Column:
    """At least one hash in common; by default a hash matches whatever its position."""
    if bundle_aware:
        return F.exists(F.zip_with(sig, int_literal(hashes), lambda a, b: a == b), lambda same: same)
    return F.arrays_overlap(sig, int_literal(sorted(set(hashes))))


def overlap(sig: Column, hashes: Sequence[int], bundle_aware: bool = False) -> Column:
    """Number of matching query hashes: repeats count on the query side, not on the document side."""
    if bundle_aware:
        return F.size(F.filter(F.zip_with(sig, int_literal(hashes), lambda a, b: a == b), lambda same: same)).cast("bigint")
    return F.size(F.filter(int_literal(hashes), lambda h: F.array_contains(sig, h))).cast("bigint")


def keep_best(candidates: DataFrame, limit: int, per_shard: bool, key: str = "doc_id") -> DataFrame:
    """The ``limit`` best candidates by overlap, in total or in each shard."""
    order = [F.col("overlap").desc(), F.col(key)]
    if per_shard:
        return top_n_per_group(candidates, ["shard"], order, limit, [key]).drop("rank")
    return candidates.orderBy(*order).limit(limit)


def hash_candidates(
    rows: DataFrame, mode: str, hashes: Sequence[int], *, limit: int = -1, per_shard: bool = False, bundle_aware: bool = False
) -> DataFrame:
    """Candidate rows from the inline signature column, each once, with their overlap."""
    sig = F.col(hashing.signature_column(mode))
    if limit <= 0:
        return rows.filter(shares_hash(sig, hashes, bundle_aware))
    counted = rows.withColumn("overlap", overlap(sig, hashes, bundle_aware)).filter(F.col("overlap") > 0)
    return keep_best(counted, limit, per_shard)


def postings_candidates(
    postings: DataFrame, hashes: Sequence[int], *, limit: int = -1, per_shard: bool = False, bundle_aware: bool = False
) -> DataFrame:
    """``(doc_id[, shard], overlap)`` from posting rows of one feature and hash mode.

    A document contributes at most one row per bundle, so the set collected per document is bounded
    by the number of bundles, and partial aggregation shrinks it before the shuffle.
    """
    wanted = postings.filter(F.col("h").isin(sorted(set(hashes))))
    keys = ["doc_id", "shard"] if per_shard else ["doc_id"]
    if bundle_aware:
        wanted = wanted.filter(F.col("h") == F.get(int_literal(hashes), F.col("bundle").cast("int")))
        grouped = wanted.groupBy(*keys).agg(F.count(F.lit(1)).alias("overlap"))
    else:
        weight = F.create_map(*[F.lit(x).cast("bigint") for pair in Counter(hashes).items() for x in pair])
        found = F.aggregate(F.collect_set("h"), F.lit(0).cast("bigint"), lambda acc, h: acc + F.element_at(weight, h))
        grouped = wanted.groupBy(*keys).agg(found.alias("overlap"))
    return grouped if limit <= 0 else keep_best(grouped, limit, per_shard)


def _mapped(index: DataFrame, query: ImageQuery, declared: Declared | None) -> bool:
    """Whether the index has signatures of the hash for the feature: by the declaration of its fields if there is one, else
    by what the column's metadata declares, else by the column alone. No data is looked at."""
    if declared is not None:
        spec = declared.get(query.field)
        return spec is not None and query.hash in spec.features.get(query.feature, ())
    column = hashing.signature_column(query.hash)
    if column not in index.columns:
        return False
    return query.feature in index.schema[column].metadata.get(hashing.DECLARED, [query.feature])


def image_search(
    index: DataFrame,
    query: ImageQuery,
    *,
    lookup: DataFrame | None = None,
    postings: DataFrame | None = None,
    metric: str | None = None,
    per_shard: bool = True,
    bundle_aware: bool = False,
    where: Column | None = None,
    pre_filter: Column | None = None,
    missing: str = "error",
    declared: Declared | None = None,
    vec: Sequence[int] | None = None,
    explain: bool = False,
) -> DataFrame:
    """Documents of ``index`` with ``distance`` and ``score`` against the query.

    ``where`` is the rest of the request and applies after a candidate limit; ``pre_filter`` applies
    before it. ``missing="empty"`` turns a search on a hash that the index does not carry into an
    empty result instead of an error; ``declared`` are the parsed fields of the index's mapping, which tell hashes apart
    by feature, where the columns alone do not. ``vec`` is the query's vector if it is known; ``explain`` adds
    why each row has its score.
    """
    vec = query_vector(index, query, lookup) if vec is None else vec
    metric = metric or metric_of(query.feature)
    rows = clause_rows(index, query.field, query.feature)
    if pre_filter is not None:
        rows = rows.filter(pre_filter)
    if query.hash is not None:
        if postings is None and not _mapped(index, query, declared):
            if missing != "empty":
                raise QueryError(f"hash {query.hash} is not mapped for {query.field}.{query.feature}")
            rows = rows.filter(F.lit(False))
        else:
            hashes = query_signature(query.hash, vec)
            limit = query.limit if query.limited else -1
            if postings is not None:
                listed = postings.filter(
                    (F.col("field") == query.field) & (F.col("feature") == query.feature) & (F.col("hash_mode") == query.hash)
                )
                if pre_filter is not None:
                    listed = listed.join(rows.select("doc_id"), "doc_id", "left_semi")
                found = postings_candidates(listed, hashes, limit=limit, per_shard=per_shard, bundle_aware=bundle_aware)
                rows = rows.join(found.select("doc_id"), "doc_id", "left_semi")
            else:
                rows = hash_candidates(
                    rows, query.hash, hashes, limit=limit, per_shard=per_shard, bundle_aware=bundle_aware
                ).drop("overlap")
    if where is not None:
        rows = rows.filter(where)
    hits = scored(rows, vec, metric, query.boost)
    return hits.withColumn("explanation", explanation(F.col("score"), query.boost)) if explain else hits


def top_hits(hits: DataFrame, size: int) -> DataFrame:
    """Best hits first, documents in id order among equals.

    For a page: the rows of a bounded ``size`` end in one task. To rank everything, sort the hits.
    """
    return hits.orderBy(F.col("score").desc(), F.col("doc_id")).limit(size)


def hits_summary(hits: DataFrame) -> DataFrame:
    """Total hits and maximum score in one aggregate."""
    return hits.agg(F.count(F.lit(1)).alias("total_hits"), F.max("score").alias("max_score"))


def should(*clauses: DataFrame) -> DataFrame:
    """Optional clauses: a document matching any of them scores the sum of those it matches."""
    merged = clauses[0].select("doc_id", "score")
    for clause in clauses[1:]:
        merged = merged.unionByName(clause.select("doc_id", "score"))
    return merged.groupBy("doc_id").agg(F.sum("score").alias("score"), F.count(F.lit(1)).alias("clauses"))


def multi_feature_search(index: DataFrame, clauses: Sequence[tuple[ImageQuery, Sequence[int]]]) -> DataFrame:
    """Several image clauses; a document scores the sum of those it matches.

    Clauses with a hash are searched each by itself, with their limits. The others share one scan: each row belongs to one
    feature, so a CASE picks its clause; the scores of a document meet in one aggregation with map-side partial sums instead
    of one scan and one join per clause.
    """
    if any(query.hash is not None for query, _ in clauses):
        return should(*(image_search(index, query, vec=vec) for query, vec in clauses))
    near, keep = None, None
    for query, vec in clauses:
        mine = (F.col("field") == query.field) & (F.col("feature") == query.feature)
        value = score_of(distance(metric_of(query.feature), F.col("vec"), int_literal(vec)), query.boost)
        near = F.when(mine, value) if near is None else near.when(mine, value)
        keep = mine if keep is None else keep | mine
    # a row of a generator, as in `scored`: the test of the score stays above it
    rows = index.filter(keep & F.col("vec").isNotNull()).select("doc_id", F.explode_outer(F.array(near)).alias("score"))
    return rows.filter(F.col("score").isNotNull()).groupBy("doc_id").agg(F.sum("score").alias("score"), F.count(F.lit(1)).alias("clauses"))
