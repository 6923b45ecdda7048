"""Scores, distances, codecs and hashes on literal frames."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumisift.errors import QueryError
from lumisift.functions import hashing, vectors
from lumisift.functions.scoring import explanation, score_of
from lumisift.functions.sql import register_sql_functions

VEC = "id bigint, vec array<bigint>"


def test_score_branches(spark):
    distances = [0.0, 0.5, 1.0, 1.0000001, 4.0, float("nan"), float("inf"), None]
    rows = spark.createDataFrame([(i, d) for i, d in enumerate(distances)], "i int, d double")
    got = [r.s for r in rows.select("i", score_of(F.col("d")).alias("s")).orderBy("i").collect()]
    assert got[:5] == [2.0, 1.5, 1.0, 1 / 1.0000001, 0.25]
    assert math.isnan(got[5]) and got[6] == 0.0 and got[7] is None


def test_boost_and_explanation(spark):
    rows = spark.createDataFrame([(0.0,), (None,)], "d double")
    score = score_of(F.col("d"), 2.0)
    hit, miss = [r.e for r in rows.select(explanation(score, 2.0).alias("e")).collect()]
    assert (hit.matched, hit.value, hit.boost, hit.image_score) == (True, 4.0, 2.0, 2.0)
    assert (miss.matched, miss.value, miss.description) == (False, 0.0, "not a candidate of this clause")
    plain = rows.limit(1).select(explanation(score_of(F.col("d")), 1.0).alias("e")).head().e
    assert plain.boost is None


def test_distance_limits(spark):
    rows = spark.createDataFrame([([0, 0], [0, 0]), ([0, 0], [1, 2]), ([1, 2], [1, 2]), ([3, 0], [0, 4])], "a array<bigint>, b array<bigint>")
    a, b = F.col("a"), F.col("b")
    got = rows.select(*[vectors.distance(m, a, b).alias(m) for m in ("tanimoto", "cosine", "l1", "l2", "jsd")]).collect()
    assert [r.tanimoto for r in got] == [0.0, 100.0, 0.0, 100.0]
    assert got[0].cosine is None and got[1].cosine is None and abs(got[2].cosine) < 1e-12 and got[3].cosine == 1.0
    assert [r.l1 for r in got] == [0.0, 3.0, 0.0, 7.0]
    assert got[3].l2 == 5.0 / 10000
    assert [r.jsd for r in got] == [0.0, round(math.log(2), 6), 0.0, round(math.log(2), 6)]
    with pytest.raises(QueryError):
        vectors.distance("nope", a, b)


def test_quantise_and_codec(spark):
    rows = spark.createDataFrame([([0.12345, -0.00005, 1.0],), ([],)], "e array<float>")
    got = rows.select(vectors.quantise(F.col("e")).alias("q")).collect()
    assert got[0].q[1:] == [0, 10000] and got[1].q == []
    values = [0, 1, -1, 2**40, -(2**40), 2**63 - 1, -(2**63)]
    frame = spark.createDataFrame([(values,), ([],)], "v array<bigint>")
    packed = frame.select(vectors.vector_to_bytes(F.col("v")).alias("p"))
    assert [r.p for r in packed.collect()] == [np.array(values, ">i8").tobytes(), b""]
    assert [list(r.v) for r in packed.select(vectors.bytes_to_vector(F.col("p")).alias("v")).collect()] == [values, []]


def test_sql_functions_agree_with_columns(spark):
    register_sql_functions(spark)
    rows = spark.createDataFrame([([1, 2], [3, -4])], "a array<bigint>, b array<bigint>")
    for metric in ("l1", "l2", "cosine", "tanimoto"):
        row = rows.select(
            F.call_function("img_distance", F.lit(metric), "a", "b").alias("sql"),
            vectors.distance(metric, F.col("a"), F.col("b")).alias("col"),
        ).head()
        assert row.sql == row.col
    assert spark.sql("SELECT img_score(0.5D), img_score(4D, 2D)").head()[:] == (1.5, 0.5)


def table_signatures(spark, rows, mode, dim):
    """Signatures through the hash family as a table: join and two aggregations."""
    elements = rows.select("id", F.posexplode("vec").alias("i", "v"))
    dots = (
        elements.join(hashing.planes(spark, mode, dim), "i").groupBy("id", "bundle", "bit", "bias")
        .agg(F.sum(F.col("v") * F.col("coef")).alias("dot"))
    )
    if mode == "LSH":
        return dots.select("id", "bundle", F.floor((F.col("dot") + F.col("bias")) / F.lit(float(hashing.LSH_WIDTH))).alias("h"))
    bit = F.when(F.col("dot") >= 0, F.expr("shiftleft(1L, int(bit))")).otherwise(F.lit(0).cast("bigint"))
    return dots.groupBy("id", "bundle").agg(F.sum(bit).alias("h"))


@pytest.mark.parametrize("mode", hashing.MODES)
def test_signature_equals_family_table(spark, mode):
    rng = np.random.default_rng(5)
    rows = spark.createDataFrame([(i, [int(x) for x in rng.integers(-9000, 9000, 18)]) for i in range(6)], VEC)
    signed = hashing.with_signature(rows, mode)
    mine = {(r.id, r.bundle, r.h) for r in hashing.postings(signed, mode, ["id"]).select("id", "bundle", "h").collect()}
    assert mine == {tuple(r) for r in table_signatures(spark, rows, mode, 18).select("id", "bundle", "h").collect()}
    assert len(mine) == 6 * hashing.BUNDLES


def test_signature_edges(spark):
    big = [10**13, -(10**13)] * 3
    rows = spark.createDataFrame([(1, None), (2, [1, 2, 3]), (3, big)], VEC)
    got = {r.id: r.sig_bit_sampling for r in hashing.with_signature(rows, "bit_sampling").collect()}
    planes, _ = hashing.plane_matrix("BIT_SAMPLING", 6)
    exact = [sum(int(p) * v for p, v in zip(planes[:, k], big)) >= 0 for k in range(600)]
    assert got[1] is None and len(got[2]) == 50
    assert got[3] == [sum(1 << b for b in range(12) if exact[bundle * 12 + b]) for bundle in range(50)]
    with pytest.raises(QueryError):
        hashing.hash_mode("md5")


def test_terms(spark):
    rows = spark.createDataFrame([([5, -5, 0],)], "s array<bigint>").select(hashing.terms(F.col("s")).alias("t"))
    assert rows.head().t == "5 -5 0"
    assert rows.select(hashing.parse_terms(F.col("t")).alias("s")).head().s == [5, -5, 0]


def test_probes_are_the_nearest_hashes(spark):
    rng = np.random.default_rng(2)
    vecs = rng.integers(-5000, 5000, (3, 16))
    planes, bias = hashing.plane_matrix("BIT_SAMPLING", 16)
    got = hashing.probes_of("BIT_SAMPLING", vecs, 20)
    for i, own in enumerate(hashing.signatures_of("BIT_SAMPLING", vecs)):
        dots = np.abs(vecs[i] @ planes).reshape(hashing.BUNDLES, hashing.BITS)
        for bundle in range(hashing.BUNDLES):
            bits = sorted(range(hashing.BITS), key=lambda b: (dots[bundle, b], b))[: hashing.PROBED_BITS]  # noqa: B023
            turns = [sum(1 << b for j, b in enumerate(bits) if s >> j & 1) for s in range(1 << hashing.PROBED_BITS)]
            cost = {t: sum(dots[bundle, b] for b in range(hashing.BITS) if t >> b & 1) for t in turns}  # noqa: B023
            assert got[i, bundle].tolist() == [int(own[bundle]) ^ t for t in sorted(turns, key=lambda t: (cost[t], t))[:21]]  # noqa: B023
    cells, (planes, bias) = hashing.probes_of("LSH", vecs, 3), hashing.plane_matrix("LSH", 16)
    for i in range(3):
        for bundle in range(hashing.BUNDLES):
            at = (int(vecs[i] @ planes[:, bundle]) + int(bias[bundle])) / hashing.LSH_WIDTH
            own = int(np.floor(at))
            away = lambda c: max(c - at, at - (c + 1), 0)  # noqa: B023, E731
            assert cells[i, bundle].tolist() == sorted(range(own - 4, own + 5), key=lambda c: (c != own, away(c), c))[:4]
    column = spark.createDataFrame([(v.tolist(),) for v in vecs], "vec array<bigint>").select(hashing.probes(F.col("vec"), "bit_sampling", 20).alias("p"))
    assert [r.p for r in column.collect()] == got.tolist()
