"""Column expressions over feature vectors: quantising, codecs and distances.

Feature vectors are ``ARRAY<BIGINT>``. Everything here stays inside the JVM; the distances take two
columns, so the query side may be a literal array (one query) or a column (joined pairs).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from lumisift.errors import QueryError

QUANTUM = 10_000

# Published MPEG-7 colour layout weights for the first 6 / 3 / 3 zig-zag coefficients.
LAYOUT_CHANNEL_SIZES = (6, 3, 3)
LAYOUT_WEIGHTS = (3, 3, 3, 1, 1, 1, 2, 1, 1, 4, 2, 2)
# A DCT sum carries two basis factors of 1024; eight more brings it to the range of a pixel mean.
LAYOUT_SCALE = float(1 << 23)


def quantise(values: Column) -> Column:
    """Float vector to integer vector, half-up at four decimals."""
    return F.transform(
        values, lambda x: F.floor(x.cast("double") * F.lit(float(QUANTUM)) + F.lit(0.5)).cast("bigint")
    )


def dequantise(values: Column) -> Column:
    return F.transform(values, lambda x: x.cast("double") / F.lit(float(QUANTUM)))


def vector_to_bytes(values: Column) -> Column:
    """Big-endian 8 bytes per element, the binary form of a feature column."""
    return F.unhex(F.array_join(F.transform(values, lambda v: F.lpad(F.hex(v), 16, "0")), ""))


def bytes_to_vector(payload: Column) -> Column:
    """Inverse of :func:`vector_to_bytes`.

    The hex text is cut into pieces of 16 digits once. ``conv`` reads them as unsigned numbers, so the
    upper half is read apart and shifted to restore the sign.
    """

    def element(digits: Column) -> Column:
        upper = F.conv(F.substring(digits, 1, 8), 16, 10).cast("bigint")
        lower = F.conv(F.substring(digits, 9, 8), 16, 10).cast("bigint")
        return F.shiftleft(upper, 32).bitwiseOR(lower)

    return F.transform(F.regexp_extract_all(F.hex(payload), F.lit("[0-9A-F]{16}"), F.lit(0)), element)


def int_literal(values: Sequence[int]) -> Column:
    """A constant ``ARRAY<BIGINT>``; Catalyst folds it into one literal."""
    return F.expr(f"CAST(array({', '.join(f'CAST({int(v)} AS BIGINT)' for v in values)}) AS ARRAY<BIGINT>)")


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda acc, x: acc + x)


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    """In doubles: products of large bins leave the range of whole numbers."""
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def l1(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: F.abs(x.cast("double") - y.cast("double"))))


def l2(a: Column, b: Column, scale: float = QUANTUM) -> Column:
    squares = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.sqrt(_sum(squares)) / F.lit(float(scale))


def cosine(a: Column, b: Column, bb: Column | None = None) -> Column:
    """NULL when either side is the zero vector. ``bb`` is the squared length of ``b`` if it is known."""
    bb = dot(b, b) if bb is None else bb
    return F.lit(1.0) - F.try_divide(dot(a, b), F.sqrt(dot(a, a) * bb))


def tanimoto(a: Column, b: Column, bb: Column | None = None) -> Column:
    bb = dot(b, b) if bb is None else bb
    sums = F.struct(dot(a, a).alias("aa"), bb.alias("bb"), dot(a, b).alias("ab"))
    return let(sums, lambda s: F.when((s["aa"] == 0) & (s["bb"] == 0), F.lit(0.0))
               .when((s["aa"] == 0) | (s["bb"] == 0), F.lit(100.0))
               .otherwise(F.lit(100.0) * (F.lit(1.0) - s["ab"] / (s["aa"] + s["bb"] - s["ab"]))))


def jsd(a: Column, b: Column) -> Column:
    """Jensen-Shannon divergence of two non-negative histograms, rounded to six decimals.

    The sums start the fold and travel with it, so each is taken once and not for every bin.
    """

    def half(p: Column, q: Column) -> Column:
        return F.when(p > 0, p * F.ln(F.lit(2.0) * p / (p + q))).otherwise(F.lit(0.0))

    def add(s: Column, v: Column) -> Column:
        p, q = v["x"] / s["a"], v["y"] / s["b"]
        return F.struct(s["a"].alias("a"), s["b"].alias("b"), (s["d"] + half(p, q) + half(q, p)).alias("d"))

    def finish(s: Column) -> Column:
        return (
            F.when((s["a"] == 0) & (s["b"] == 0), F.lit(0.0))
            .when((s["a"] == 0) | (s["b"] == 0), F.round(F.ln(F.lit(2.0)), 6))
            .otherwise(F.round(s["d"] / F.lit(2.0), 6))
        )

    bins = F.zip_with(a, b, lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")))
    sums = F.struct(total(a).cast("double").alias("a"), total(b).cast("double").alias("b"), F.lit(0.0).alias("d"))
    empty = lambda s: (s["a"] == 0) | (s["b"] == 0)
    return F.aggregate(bins, sums, lambda s, v: F.when(empty(s), s).otherwise(add(s, v)), finish)


def layout(
    a: Column,
    b: Column,
    sizes: Sequence[int] = LAYOUT_CHANNEL_SIZES,
    weights: Sequence[int] = LAYOUT_WEIGHTS,
    scale: float = LAYOUT_SCALE,
) -> Column:
    """Per channel, the root of the weighted squared differences; channels add up."""
    start, out = 0, None
    for size in sizes:
        squares = F.zip_with(
            F.zip_with(F.slice(a, start + 1, size), F.slice(b, start + 1, size), lambda x, y: x - y),
            F.array(*[F.lit(float(w)) for w in weights[start : start + size]]),
            lambda d, w: (d.cast("double") / F.lit(scale)) * (d.cast("double") / F.lit(scale)) * w,
        )
        root = F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x))
        out = root if out is None else out + root
        start += size
    return F.round(out, 6)


METRICS = {"l1": l1, "l2": l2, "cosine": cosine, "tanimoto": tanimoto, "jsd": jsd, "layout": layout}


def distance(metric: str, a: Column, b: Column, bb: Column | None = None) -> Column:
    """Distance of two vectors; ``bb``, the squared length of ``b``, saves its computation where a metric needs it."""
    try:
        fn = METRICS[metric.lower()]
        return fn(a, b, bb) if fn in (cosine, tanimoto) else fn(a, b)
    except KeyError:
        raise QueryError(f"unknown metric {metric!r}; known: {', '.join(sorted(METRICS))}") from None
