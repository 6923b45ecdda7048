"""Locality-sensitive signatures: one integer per bundle from a fixed, seed-free hash family.

The family is arithmetic, so every executor derives the same planes and nothing has to be shipped,
loaded or kept in step with the data. A signature is one small matrix product; it runs as an
Arrow-batched UDF because the 600 dot products per vector cost milliseconds as nested array lambdas
and microseconds as one product over a batch (see README, measurements).
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.functions import pandas_udf

from lumisift.errors import QueryError

BUNDLES = 50
BITS = 12
MODES = ("BIT_SAMPLING", "LSH")

# Fixed values of the hash family.
PRIME = 2_147_483_647
STEP, SHIFT, MIX = 48_271, 11, 7
SPREAD, CENTRE = 2_001, 1_000
LSH_FIRST, LSH_STRIDE, LSH_WIDTH = 1_000, 768, 4_000_000
EXACT_DOUBLE = 1 << 53

DECLARED = "declared_features"
"""Key in the metadata of a signature column for the features that have the hash."""


def hash_mode(name: str) -> str:
    """Upper-case lookup of a hash mode name."""
    if not isinstance(name, str) or name.upper() not in MODES:
        raise QueryError(f"unknown hash {name!r}; known: {', '.join(MODES)}")
    return name.upper()


def signature_column(mode: str) -> str:
    """Name of the inline signature column of a hash mode in a feature table."""
    return "sig_" + hash_mode(mode).lower()


def _coefficients(n: np.ndarray) -> np.ndarray:
    a = (n * STEP + SHIFT) % PRIME
    return ((a * a + a * MIX) % PRIME) % SPREAD - CENTRE


@lru_cache(maxsize=32)
def plane_matrix(mode: str, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(dim x rows) coefficients and the bias of each row, derived from the row number alone."""
    i = np.arange(dim, dtype=np.int64)
    if hash_mode(mode) == "BIT_SAMPLING":
        rows = np.arange(BUNDLES * BITS, dtype=np.int64)
        return _coefficients(rows[None, :] * dim + i[:, None]), np.zeros(len(rows), np.int64)
    rows = (LSH_FIRST + np.arange(BUNDLES, dtype=np.int64)) * LSH_STRIDE
    return _coefficients(rows[None, :] + i[:, None]), (rows * STEP + SHIFT) % PRIME % LSH_WIDTH


def signatures_of(mode: str, vectors: np.ndarray) -> np.ndarray:
    """(batch x bundles) hashes of a batch of equally long integer vectors."""
    planes, bias = plane_matrix(mode, vectors.shape[1])
    # the largest partial sum of each row: a double holds it exactly, or the row is done with Python's whole numbers
    peak = np.abs(vectors.astype(np.float64)).max(axis=1, initial=0) * CENTRE * max(1, vectors.shape[1])
    large = peak >= EXACT_DOUBLE
    dots = np.where(large[:, None], 0, vectors).astype(np.float64) @ planes.astype(np.float64)
    exact = vectors[large].astype(object) @ planes.astype(object)
    if mode == "BIT_SAMPLING":
        signs = dots >= 0
        signs[large] = (exact >= 0).astype(bool)
        return signs.reshape(len(vectors), BUNDLES, BITS) @ (np.int64(1) << np.arange(BITS, dtype=np.int64))
    hashes = (dots.astype(np.int64) + bias) // LSH_WIDTH
    cells = (exact + bias) // LSH_WIDTH  # a cell number may need more than 64 bits: it wraps, as equal numbers do alike
    hashes[large] = ((cells + (1 << 63)) % (1 << 64) - (1 << 63)).astype(np.int64)
    return hashes


PROBED_BITS = 7
"""Bits of a bundle that probing may turn: those whose dot products are nearest to zero."""


@lru_cache(maxsize=1)
def _turns() -> np.ndarray:
    """(subsets x places): which of the probed bits a probe turns; the first turns none."""
    return (np.arange(1 << PROBED_BITS)[:, None] >> np.arange(PROBED_BITS)) & 1


def probes_of(mode: str, vectors: np.ndarray, extra: int) -> np.ndarray:
    """(batch x bundles x 1 + extra) hashes: a vector's own and the nearest other ones of each bundle.

    For signs, those that turn the bits with the smallest absolute dot products in sum; for cells, those whose border is
    nearest. Of equally near ones the smaller turn, or the lower cell, comes first.
    """
    planes, bias = plane_matrix(mode, vectors.shape[1])
    own = signatures_of(mode, vectors)
    dots = vectors.astype(np.float64) @ planes.astype(np.float64)
    if mode == "BIT_SAMPLING":
        extra = min(extra, (1 << PROBED_BITS) - 1)
        size = np.abs(dots).reshape(len(vectors), BUNDLES, BITS)
        place = np.argsort(size, axis=2, kind="stable")[:, :, :PROBED_BITS]
        cost = np.take_along_axis(size, place, 2) @ _turns().T
        mask = (np.int64(1) << place.astype(np.int64)) @ _turns().T
        order = np.lexsort((mask, cost), axis=2)[:, :, : extra + 1]
        return own[:, :, None] ^ np.take_along_axis(mask, order, 2)
    steps = np.array([s for j in range(1, extra + 1) for s in (-j, j)], np.int64)
    inside = ((dots + bias) % LSH_WIDTH)[:, :, None]
    cost = np.where(steps > 0, steps * LSH_WIDTH - inside, inside + (-steps - 1) * LSH_WIDTH)
    order = np.argsort(cost, axis=2, kind="stable")[:, :, :extra]
    return np.concatenate([own[:, :, None], own[:, :, None] + steps[order]], axis=2)


def probes(vec: Column, mode: str, extra: int) -> Column:
    """``ARRAY<ARRAY<BIGINT>>``: for each bundle the vector's own hash and the ``extra`` nearest others."""
    mode = hash_mode(mode)

    @pandas_udf("array<array<bigint>>")
    def probe(batch: pd.Series) -> pd.Series:
        return batch.map(lambda v: None if v is None else list(probes_of(mode, np.array([v], np.int64), extra)[0]))

    return probe(vec)


def signature(vec: Column, mode: str) -> Column:
    """``ARRAY<BIGINT>`` of :data:`BUNDLES` hashes; NULL vector, NULL signature."""
    mode = hash_mode(mode)

    @pandas_udf("array<bigint>")
    def sign(batch: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(batch), index=batch.index, dtype=object)
        lengths = batch.map(lambda v: -1 if v is None else len(v))
        for length in lengths.unique():
            if length < 0:
                continue
            at = lengths.index[lengths == length]
            block = np.stack(batch.loc[at].to_numpy()).astype(np.int64).reshape(len(at), length)
            out.loc[at] = pd.Series(list(signatures_of(mode, block)), index=at)
        return out

    return sign(vec)


def with_signature(features: DataFrame, mode: str, vec: str = "vec") -> DataFrame:
    return features.withColumn(signature_column(mode), signature(F.col(vec), mode))


def planes(spark: SparkSession, mode: str, dim: int) -> DataFrame:
    """The hash family as a table ``(bundle, bit, i, coef, bias)``, built by Spark from a range."""
    mode = hash_mode(mode)
    bits = BITS if mode == "BIT_SAMPLING" else 1
    base = spark.range(BUNDLES * bits * dim).select(
        F.expr(f"id div {bits * dim}").alias("bundle"),
        F.expr(f"(id div {dim}) % {bits}").alias("bit"),
        F.expr(f"id % {dim}").alias("i"),
    )
    if mode == "BIT_SAMPLING":
        first = F.expr(f"(bundle * {BITS} + bit) * {dim}")
        bias = F.lit(0).cast("bigint")
    else:
        first = (F.col("bundle") + LSH_FIRST) * LSH_STRIDE
        bias = (first * STEP + SHIFT) % PRIME % LSH_WIDTH
    a = ((first + F.col("i")) * STEP + SHIFT) % PRIME
    return base.select(
        "bundle", "bit", "i", (((a * a + a * MIX) % PRIME) % SPREAD - CENTRE).alias("coef"), bias.alias("bias")
    )


def terms(sig: Column) -> Column:
    """Signature as one string of space-separated terms."""
    return F.array_join(F.transform(sig, lambda h: h.cast("string")), " ")


def parse_terms(text: Column) -> Column:
    return F.transform(F.split(text, " "), lambda t: t.cast("bigint"))


def postings(features: DataFrame, mode: str, keys: list[str], sig: str | None = None) -> DataFrame:
    """One row per ``(document, bundle, hash)``: the inverted-index form of a signature column.

    Outer explode and a test of its output: an inner explode would be guarded by a filter on the
    signature, and the signature computed a second time for it.
    """
    sig = sig or signature_column(mode)
    exploded = features.select(*keys, F.lit(hash_mode(mode)).alias("hash_mode"), F.posexplode_outer(sig).alias("bundle", "h"))
    return exploded.filter(F.col("bundle").isNotNull()).withColumn("bundle", F.col("bundle").cast("bigint"))
