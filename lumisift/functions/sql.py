"""SQL surface: ``img_distance`` and ``img_score`` as SQL-bodied temporary functions, and a table function that searches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lumisift.functions.hashing import signature_column
from lumisift.functions.vectors import LAYOUT_CHANNEL_SIZES, LAYOUT_SCALE, LAYOUT_WEIGHTS, QUANTUM
from lumisift.operators.registry import features, metric_of

_VECTOR = "ARRAY<BIGINT>"


def _fold(values: str) -> str:
    return f"aggregate({values}, 0D, (s, x) -> s + x)"


def _zip(body: str, left: str = "a", right: str = "b") -> str:
    return f"zip_with({left}, {right}, (x, y) -> {body})"


def _dot(left: str, right: str) -> str:
    return _fold(_zip("CAST(x AS DOUBLE) * CAST(y AS DOUBLE)", left, right))


def _jsd() -> str:
    bins = _zip("named_struct('x', CAST(x AS DOUBLE), 'y', CAST(y AS DOUBLE))")
    half = "CASE WHEN {0} > 0 THEN {0} * ln(2D * {0} / ({0} + {1})) ELSE 0D END".format
    p, q = "v.x / s.a", "v.y / s.b"
    sums = "named_struct('a', CAST({0} AS DOUBLE), 'b', CAST({1} AS DOUBLE), 'd', 0D)".format(
        *(f"aggregate({side}, 0L, (s, x) -> s + x)" for side in "ab")
    )
    step = f"named_struct('a', s.a, 'b', s.b, 'd', s.d + {half(p, q)} + {half(q, p)})"
    last = "CASE WHEN s.a = 0 AND s.b = 0 THEN 0D WHEN s.a = 0 OR s.b = 0 THEN round(ln(2D), 6) ELSE round(s.d / 2D, 6) END"
    return f"aggregate({bins}, {sums}, (s, v) -> CASE WHEN s.a = 0 OR s.b = 0 THEN s ELSE {step} END, s -> {last})"


def _layout() -> str:
    start, channels = 0, []
    for size in LAYOUT_CHANNEL_SIZES:
        weights = ", ".join(f"{float(w)}D" for w in LAYOUT_WEIGHTS[start : start + size])
        steps = _zip(f"CAST(x - y AS DOUBLE) / {LAYOUT_SCALE}D", f"slice(a, {start + 1}, {size})", f"slice(b, {start + 1}, {size})")
        channels.append(f"sqrt({_fold(_zip('x * x * y', steps, f'array({weights})'))})")
        start += size
    return f"round({' + '.join(channels)}, 6)"


def register_sql_functions(spark: SparkSession) -> None:
    """Define the functions in this session; their bodies are inlined by the optimizer."""
    ab, aa, bb = _dot("a", "b"), _dot("a", "a"), _dot("b", "b")
    difference = "(CAST(x AS DOUBLE) - CAST(y AS DOUBLE))"
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION img_distance(metric STRING, a {_VECTOR}, b {_VECTOR})
        RETURNS DOUBLE
        RETURN CASE lower(metric)
            WHEN 'l1' THEN {_fold(_zip(f"abs({difference})"))}
            WHEN 'l2' THEN sqrt({_fold(_zip(f"{difference} * {difference}"))}) / {float(QUANTUM)}D
            WHEN 'cosine' THEN 1D - try_divide({ab}, sqrt({aa} * {bb}))
            WHEN 'tanimoto' THEN CASE WHEN {aa} = 0 AND {bb} = 0 THEN 0D WHEN {aa} = 0 OR {bb} = 0 THEN 100D
                ELSE 100D * (1D - {ab} / ({aa} + {bb} - {ab})) END
            WHEN 'jsd' THEN {_jsd()}
            WHEN 'layout' THEN {_layout()}
            ELSE CAST(raise_error(concat('unknown metric ', metric)) AS DOUBLE) END""")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION img_score(distance DOUBLE, boost DOUBLE DEFAULT 1D)
        RETURNS DOUBLE
        RETURN CASE WHEN distance <= 1 THEN (2D - distance) * boost ELSE 1D / distance * boost END""")


def register_search(spark: SparkSession, index: DataFrame, name: str = "img_search", hash: str | None = None) -> None:
    """Define a table function that searches ``index`` (columns ``doc_id, field, feature, vec`` and, with ``hash``, that
    hash's signature)::

        SELECT * FROM img_search(q_field => 'img', q_feature => 'CEDD', q_vec => ..., size => 10)

    ``q_hashes`` are the query's hashes: only documents sharing one take part, with a positive ``q_limit`` only so many of
    them with the largest overlap; a positive ``size`` keeps so many of the best. ``overlap`` and ``explanation`` say why a
    row is there. The function's body is inlined: branches that constant arguments rule out leave the plan, limits become
    top-n operators, and conditions around a call without limits reach the scan.
    """
    register_sql_functions(spark)
    view = f"{name}_index"
    index.createOrReplaceTempView(view)
    sig = "CAST(NULL AS ARRAY<BIGINT>)" if hash is None else signature_column(hash)
    metrics = " ".join(f"WHEN '{f}' THEN '{metric_of(f)}'" for f in features())
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(
            q_field STRING, q_feature STRING, q_vec {_VECTOR}, q_hashes {_VECTOR} DEFAULT NULL, q_limit INT DEFAULT -1,
            size INT DEFAULT -1, q_boost DOUBLE DEFAULT 1D)
        RETURNS TABLE (doc_id BIGINT, distance DOUBLE, score DOUBLE, overlap BIGINT,
            explanation STRUCT<matched: BOOLEAN, value: DOUBLE, boost: DOUBLE, image_score: DOUBLE, description: STRING>)
        RETURN
            WITH candidate AS (
                SELECT d.doc_id, d.vec, CAST(size(filter({name}.q_hashes, h -> array_contains({sig}, h))) AS BIGINT) AS overlap
                FROM {view} d WHERE d.field = {name}.q_field AND d.feature = upper({name}.q_feature) AND d.vec IS NOT NULL
                  AND ({name}.q_hashes IS NULL OR arrays_overlap({sig}, {name}.q_hashes))),
            best AS (SELECT *, row_number() OVER (ORDER BY overlap DESC, doc_id) AS place FROM candidate),
            chosen AS (SELECT doc_id, vec, overlap FROM candidate WHERE {name}.q_limit <= 0 OR {name}.q_hashes IS NULL
                UNION ALL SELECT doc_id, vec, overlap FROM best WHERE {name}.q_limit > 0 AND {name}.q_hashes IS NOT NULL AND place <= {name}.q_limit),
            judged AS (SELECT doc_id, overlap, img_distance(CASE upper({name}.q_feature) {metrics} END, vec, {name}.q_vec) AS distance FROM chosen),
            scored AS (SELECT doc_id, overlap, distance, img_score(distance, {name}.q_boost) AS score FROM judged),
            ranked AS (SELECT *, row_number() OVER (ORDER BY score DESC, doc_id) AS place FROM scored),
            kept AS (SELECT doc_id, overlap, distance, score FROM scored WHERE {name}.size <= 0
                UNION ALL SELECT doc_id, overlap, distance, score FROM ranked WHERE {name}.size > 0 AND place <= {name}.size)
            SELECT doc_id, distance, score, overlap, named_struct('matched', true, 'value', score, 'boost', {name}.q_boost,
                'image_score', score / {name}.q_boost, 'description', 'score of the image times the boost')
            FROM kept WHERE score IS NOT NULL""")
