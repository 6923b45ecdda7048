"""From image rows to pixel rows that already carry their neighbours.

An image is one compact row::

    image_id, w INT, h INT, r ARRAY<INT>, g ARRAY<INT>, b ARRAY<INT>      (row-major planes)

A neighbour at (dx, dy) of every pixel is the same plane shifted by ``dy * w + dx``, so a stencil is
``arrays_zip`` over shifted planes followed by one ``posexplode``: no self-join, no window, no
shuffle. Pixels of an image never leave the task that holds its row, and the aggregations that follow
combine on the map side to a few hundred cells per image.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

RING = ((-1, -1), (0, -1), (1, -1), (1, 0), (1, 1), (0, 1), (-1, 1), (-1, 0))


def idiv(a: Column | str, b: Column | int | str) -> Column:
    """Whole division, truncated toward zero."""
    a = F.col(a) if isinstance(a, str) else a
    b = b if isinstance(b, Column) else F.col(b) if isinstance(b, str) else F.lit(b)
    return F.call_function("div", a, b)


def by_image(images: DataFrame) -> DataFrame:
    """Lay compact image rows out by image.

    Every descriptor groups by ``image_id`` and something else, which this layout already satisfies,
    so a chain of aggregations adds no further exchange. Explode, project and filter keep the layout.
    The count is explicit because work per row is far larger than its bytes suggest; a table bucketed
    by ``image_id`` needs no call at all.
    """
    parts = int(images.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return images.repartition(parts, "image_id")


def with_luminance(images: DataFrame) -> DataFrame:
    weighed = "CAST((p.r * 299 + p.g * 587 + p.b * 114) div 1000 AS INT)"
    return images.withColumn("lum", F.expr(f"transform(arrays_zip(r, g, b), p -> {weighed})"))


def with_packed(images: DataFrame) -> DataFrame:
    """Adds ``rgb``: the three channels in one number per pixel, so that a stencil zips one plane and not three."""
    packed = "shiftleft(p.r, 16) | shiftleft(p.g, 8) | p.b"
    return images.withColumn("rgb", F.expr(f"transform(arrays_zip(r, g, b), p -> {packed})"))


def unpacked(plane: str, suffix: str = "") -> list[str]:
    """Select items for the channels of a packed pixel."""
    return [
        f"shiftright({plane}, 16) AS r{suffix}", f"shiftright({plane}, 8) & 255 AS g{suffix}", f"{plane} & 255 AS b{suffix}"
    ]


def shifted(plane: str, dx: int, dy: int) -> Column:
    """Plane whose element p holds the value at (x + dx, y + dy).

    Elements whose neighbour falls outside the plane are NULL; those that wrap to another line are
    wrong and belong to pixels the caller excludes by position. The expression is SQL text because one
    parse is far cheaper than a driver call per operator, and stencils need dozens of these.
    """
    if (dx, dy) == (0, 0):
        return F.col(plane)
    ahead = f"slice({plane}, {dy} * w + {dx} + 1, greatest(w * h - ({dy} * w + {dx}), 0))"
    behind = f"slice(concat(array_repeat(CAST(NULL AS INT), -({dy} * w + {dx})), {plane}), 1, w * h)"
    return F.expr(f"CASE WHEN {dy} * w + {dx} > 0 THEN {ahead} ELSE {behind} END")


def pixels(images: DataFrame, planes: Mapping[str, Column]) -> DataFrame:
    """One row per pixel: ``image_id, w, h, x, y`` and one column per plane.

    The zip is a step of its own, so that the loop over pixels compiles to a small method. The explode
    is an outer one because the optimizer guards an inner one with a filter on the size of its input,
    which it then pushes down by computing the whole zip once more; the position test drops the rows of
    images without pixels just as well.
    """
    zipped = F.arrays_zip(*[plane.alias(name) for name, plane in planes.items()])
    return (
        images.select("image_id", "w", "h", zipped.alias("zipped"))
        .select("image_id", "w", "h", F.posexplode_outer("zipped").alias("p", "px"))
        .filter("p < w * h")
        .selectExpr("image_id", "w", "h", "p % w AS x", "CAST(p div w AS INT) AS y", *[f"px.{name} AS {name}" for name in planes])
    )


def point(images: DataFrame) -> DataFrame:
    """Colour pixels, with luminance."""
    return pixels(with_luminance(images), {c: F.col(c) for c in ("r", "g", "b", "lum")})


def ring(images: DataFrame) -> DataFrame:
    """Interior pixels with the luminance of their eight neighbours, ``n0`` to ``n7``."""
    planes = {"rgb": F.col("rgb"), "lum": F.col("lum")}
    planes |= {f"n{bit}": shifted("lum", dx, dy) for bit, (dx, dy) in enumerate(RING)}
    px = interior(pixels(with_packed(with_luminance(images)), planes), 1)
    return px.selectExpr("image_id", "w", "h", "x", "y", "lum", *unpacked("rgb"), *[f"n{bit}" for bit in range(8)])


def interior(px: DataFrame, margin: int) -> DataFrame:
    return px.filter(f"x BETWEEN {margin} AND w - {1 + margin} AND y BETWEEN {margin} AND h - {1 + margin}")


def blocks2(images: DataFrame) -> DataFrame:
    """Non-overlapping 2x2 blocks: corner luminances ``la lb lc ld`` and the block's mean colour."""
    corners = ((0, 0), (1, 0), (0, 1), (1, 1))
    planes = {f"p{k}": shifted("rgb", *at) for k, at in enumerate(corners)}
    px = pixels(with_packed(images), planes).filter("x % 2 = 0 AND y % 2 = 0 AND x + 1 < w AND y + 1 < h")
    split = px.selectExpr(
        "image_id", "w", "h", "x div 2 AS bx", "y div 2 AS by", *[item for k in range(4) for item in unpacked(f"p{k}", str(k))]
    )
    return split.selectExpr(
        "image_id", "w", "h", "bx", "by",
        *[f"(299 * r{k} + 587 * g{k} + 114 * b{k}) div 1000 AS l{name}" for k, name in enumerate("abcd")],
        *[f"({ch}0 + {ch}1 + {ch}2 + {ch}3) div 4 AS {ch}" for ch in ("r", "g", "b")],
    )


def window(images: DataFrame, plane: str, offsets: Iterable[tuple[int, int]], name=lambda dx, dy: f"p_{dx}_{dy}") -> DataFrame:
    """Pixels with one plane at the given offsets; excluding edges is left to the caller."""
    return pixels(images, {name(dx, dy).replace("-", "m"): shifted(plane, dx, dy) for dx, dy in offsets})


def line_segments(images: DataFrame, length: int = 8) -> DataFrame:
    """Whole ``length``-pixel pieces of each line: ``image_id, sx, y, f ARRAY<INT>`` (luminance)."""
    per_line = idiv("w", length).cast("int")
    lines = idiv("h", length).cast("int") * length
    starts = F.sequence(F.lit(0), per_line * lines - 1)
    piece = F.transform(
        starts,
        lambda s: F.struct(
            (s % per_line).alias("sx"),
            idiv(s, per_line).cast("int").alias("y"),
            F.slice(F.col("lum"), idiv(s, per_line).cast("int") * F.col("w") + (s % per_line) * length + 1, length).alias("f"),
        ),
    )
    whole = with_luminance(images).filter((F.col("w") >= length) & (F.col("h") >= length))
    return whole.select("image_id", "w", "h", F.explode(piece).alias("s")).select("image_id", "w", "h", "s.*")
