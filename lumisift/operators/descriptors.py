"""The descriptors, as integer-only aggregations over stencil rows.

Definitions follow the published descriptors in integer form; they are this library's own and claim
no byte parity with any other implementation. Each result is long and sparse,
``(image_id, bin, value)`` without zero values.

Most descriptors are *tallies*: every stencil row adds values to a few bins. Tallies over the same
stencil share one explode and one aggregation when extracted together (see ``features.extract``).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from lumisift.operators import stencils
from lumisift.operators.stencils import idiv


@dataclass(frozen=True)
class Entry:
    """Adds ``value`` to ``bin`` for every stencil row where ``when`` holds."""

    bin: Column
    value: Column | int = 1
    when: Column | None = None

    def struct(self, **labels: str) -> Column:
        """The entry as a value. Where ``when`` does not hold it adds nothing to bin 0.

        A filter would say the same, but it would be pushed below the derived columns with all of
        their expressions repeated in it.
        """
        value = (self.value if isinstance(self.value, Column) else F.lit(self.value)).cast("bigint")
        at = self.bin.cast("bigint")
        if self.when is not None:
            zero = F.lit(0).cast("bigint")
            at, value = F.coalesce(at, zero), F.when(self.when, value).otherwise(zero)
        return F.struct(*[F.lit(v).alias(k) for k, v in labels.items()], at.alias("bin"), value.alias("value"))


@dataclass(frozen=True)
class Tally:
    """A descriptor whose bins are sums over the rows of one stencil."""

    stencil: Callable[[DataFrame], DataFrame]
    entries: Callable[[], Sequence[Entry]]
    finish: Callable[[DataFrame], DataFrame] | None = None


def tally(rows: DataFrame, entries: Sequence[Entry]) -> DataFrame:
    if len(entries) == 1:
        only = entries[0].struct()
        exploded = rows.select("image_id", only.alias("e"))
    else:
        exploded = rows.select("image_id", F.explode(F.array(*[e.struct() for e in entries])).alias("e"))
    return (
        exploded.groupBy("image_id", F.col("e.bin").alias("bin"))
        .agg(F.sum("e.value").alias("value"))
        .filter(F.col("value") != 0)
    )


def described(images: DataFrame, kind: Tally | Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``(image_id, bin, value)`` of one descriptor."""
    if not isinstance(kind, Tally):
        return kind(images)
    out = tally(kind.stencil(images), kind.entries())
    return out if kind.finish is None else kind.finish(out)


# --- shared expressions --------------------------------------------------------------------------


def c(name: str) -> Column:
    return F.col(name)


def colour64() -> Column:
    return idiv("r", 64) * 16 + idiv("g", 64) * 4 + idiv("b", 64)


def with_hsv(rows: DataFrame) -> DataFrame:
    """Adds integer hue (0-359), saturation and value (0-255) as ``hue, sat, mx``.

    Derived values become columns step by step: each is then computed once per row, where nested
    expressions would repeat it in every branch and outgrow the limits of generated code.
    """
    r, g, b = c("r"), c("g"), c("b")
    rows = rows.withColumns({"mx": F.greatest(r, g, b), "chroma": F.greatest(r, g, b) - F.least(r, g, b)})
    hue = (
        F.when(c("chroma") == 0, F.lit(0).cast("bigint"))
        .when(c("mx") == r, idiv((g - b) * 60 + c("chroma") * 360, "chroma") % 360)
        .when(c("mx") == g, idiv((b - r) * 60 + c("chroma") * 120, "chroma"))
        .otherwise(idiv((r - g) * 60 + c("chroma") * 240, "chroma"))
    )
    saturation = F.when(c("mx") == 0, F.lit(0).cast("bigint")).otherwise(idiv(c("chroma") * 255, "mx"))
    return rows.withColumns({"hue": hue, "sat": saturation})


# Upper hue edges of seven hue regions, with the last one wrapping to the first.
HUE_EDGES = (20, 45, 75, 165, 195, 270, 340)


def with_colour24(rows: DataFrame) -> DataFrame:
    """Adds ``colour``: black, grey, white, then seven hues in three shades."""
    region = F.when(c("hue") < HUE_EDGES[0], 0)
    for k, edge in enumerate(HUE_EDGES[1:], start=1):
        region = region.when(c("hue") < edge, k)
    shade = F.when(c("mx") < 128, 0).when(c("sat") >= 128, 1).otherwise(2)
    return with_hsv(rows).withColumn("colour", (
        F.when(c("mx") < 52, 0)
        .when(c("sat") < 52, F.when(c("mx") < 204, 1).otherwise(2))
        .otherwise(region.otherwise(0) * 3 + shade + 3)
    ))


def with_patterns(rows: DataFrame) -> DataFrame:
    """Adds what the ring says about its centre: ``code`` and ``rclass``, ``rank``, ``gx`` and ``gy``."""
    code = " + ".join(f"IF(n{bit} >= lum, {1 << bit}, 0)" for bit in range(8))
    rank = " + ".join(f"IF(n{bit} < lum, 1, 0)" for bit in range(8))
    classes = ", ".join(map(str, rotation_classes()))
    rows = rows.withColumns({"code": F.expr(code), "rank": F.expr(rank)})
    return with_gradient(rows.withColumn("rclass", F.expr(f"get(array({classes}), code)")))


def with_gradient(rows: DataFrame) -> DataFrame:
    """Adds ``gx`` and ``gy`` from the neighbours beside, above and below, and what they make."""
    rows = rows.withColumns({"gx": F.expr("n3 - n7"), "gy": F.expr("n5 - n1")})
    rows = rows.withColumns({
        "octant": F.expr("IF(gx < 0, 4, 0) + IF(gy < 0, 2, 0) + IF(abs(gx) < abs(gy), 1, 0)"),
        "small": F.expr("least(abs(gx), abs(gy))"),
        "large": F.expr("greatest(abs(gx), abs(gy))"),
    })
    return rows.withColumn("weight", F.expr("small + large"))


def rotation_classes() -> list[int]:
    """Class of each 8-bit code: the index of its least rotation among the distinct least rotations."""
    least = [min(((v << k) | (v >> (8 - k))) & 255 for k in range(8)) for v in range(256)]
    order = {m: i for i, m in enumerate(sorted(set(least)))}
    return [order[m] for m in least]


def pyramid_cell(level: int) -> Column:
    """Cell index of a pixel over grids 1x1, 2x2, 4x4 laid one after another."""
    side, first = 1 << level, (0, 1, 5)[level]
    return idiv(c("y") * side, "h") * side + idiv(c("x") * side, "w") + first


# --- point tallies -------------------------------------------------------------------------------


def simple_colour_histogram() -> list[Entry]:
    return [Entry(colour64())]


def opponent_histogram() -> list[Entry]:
    o1 = idiv(c("r") - c("g") + 255, 128)
    o2 = idiv(c("r") + c("g") - c("b") * 2 + 510, 256)
    o3 = idiv(c("r") + c("g") + c("b"), 192)
    return [Entry(o1 * 16 + o2 * 4 + o3)]


def hsv_cells(images: DataFrame) -> DataFrame:
    rows = with_hsv(stencils.point(images))
    return rows.withColumn("cell", idiv(c("hue") * 16, 360) * 16 + idiv("sat", 64) * 4 + idiv("mx", 64))


def scalable_colour() -> list[Entry]:
    """Haar pyramid of a 256-bin HSV histogram, each coefficient as a signed sum over pixels.

    Bins 0-15 are the sums of level 4, 16-31 its differences, 32-63 the differences of level 3; a
    difference is first half minus second half.
    """
    cell = c("cell")
    return [
        Entry(idiv(cell, 16)),
        Entry(idiv(cell, 16) + 16, F.when(cell % 16 < 8, 1).otherwise(-1)),
        Entry(idiv(cell, 8) + 32, F.when(cell % 8 < 4, 1).otherwise(-1)),
    ]


# --- ring tallies --------------------------------------------------------------------------------


def rings(images: DataFrame) -> DataFrame:
    return with_patterns(stencils.ring(images))


def joint_histogram() -> list[Entry]:
    return [Entry(colour64() * 9 + c("rank"))]


def local_binary_patterns() -> list[Entry]:
    return [Entry(c("code"))]


def rotation_invariant_patterns() -> list[Entry]:
    return [Entry(c("rclass"))]


def patterns_pyramid() -> list[Entry]:
    return [Entry(pyramid_cell(level) * 36 + c("rclass")) for level in range(3)]


def gradient_pyramid() -> list[Entry]:
    return [Entry(pyramid_cell(level) * 8 + c("octant"), c("weight")) for level in range(3)]


# --- 2x2 block tallies ---------------------------------------------------------------------------

EDGE_THRESHOLD = 11_000


# Texture of the joint descriptor for each of the eight Haar textures.
JOINT_TEXTURE = (0, 5, 2, 3, 1, 4, 6, 6)


def blocks(images: DataFrame) -> DataFrame:
    """2x2 blocks with their colour, strongest edge ``kind`` (NULL below the threshold) and textures."""
    p, q, s, t = c("la"), c("lb"), c("lc"), c("ld")
    rows = with_colour24(stencils.blocks2(images)).withColumns({
        "vertical": F.abs(p - q + s - t),
        "horizontal": F.abs(p + q - s - t),
        "falling": F.abs(p - t) * 1414,
        "rising": F.abs(q - s) * 1414,
        "mixed": F.abs(p - q - s + t),
    })
    strengths = [c("vertical") * 1000, c("horizontal") * 1000, c("falling"), c("rising"), c("mixed") * 2000]
    rows = rows.withColumn("best", F.greatest(*strengths))
    kind = F.when(c("best") < EDGE_THRESHOLD, F.lit(None).cast("int"))
    for k, strength in enumerate(strengths):
        kind = kind.when(strength == c("best"), k)
    high = [F.when(c(band) >= 40, w).otherwise(0) for band, w in (("vertical", 4), ("horizontal", 2), ("mixed", 1))]
    rows = rows.withColumns({"kind": kind, "haar": high[0] + high[1] + high[2]})
    joint = F.get(F.array(*[F.lit(t) for t in JOINT_TEXTURE]), c("haar"))
    return rows.withColumns({"texture": F.coalesce(c("kind") + 1, F.lit(0)), "joint": joint})


def edge_histogram() -> list[Entry]:
    """Sub-images are a 4x4 grid over the blocks."""
    across, down = idiv("w", 2), idiv("h", 2)
    sub = idiv(c("by") * 4, down) * 4 + idiv(c("bx") * 4, across)
    return [Entry(sub * 5 + c("kind"), 1, c("kind").isNotNull())]


def cedd() -> list[Entry]:
    return [Entry(c("texture") * 24 + c("colour"))]


def fcth() -> list[Entry]:
    return [Entry(c("haar") * 24 + c("colour"))]


def jcd() -> list[Entry]:
    return [Entry(c("texture") * 24 + c("colour")), Entry(c("joint") * 24 + c("colour"))]


# --- correlogram ---------------------------------------------------------------------------------


def plane_name(dx: int, dy: int) -> str:
    return f"p_{dx}_{dy}".replace("-", "m")


def half_ring(d: int) -> list[tuple[int, int]]:
    """One of each two opposite places at Chebyshev distance ``d``."""
    span = range(-d, d + 1)
    return [(dx, dy) for dy in span for dx in span if max(abs(dx), abs(dy)) == d and (dy, dx) > (0, 0)]


def colour_windows(images: DataFrame) -> DataFrame:
    """Pixels with their colour and the colours half around them; a pair of pixels is seen from one of its ends."""
    bins = F.expr("transform(arrays_zip(r, g, b), p -> CAST(p.r div 64 * 16 + p.g div 64 * 4 + p.b div 64 AS INT))")
    offsets = [(0, 0)] + [at for d in (1, 2, 3) for at in half_ring(d)]
    px = stencils.window(images.withColumn("colour", bins), "colour", offsets)
    inside = [f"x + {k} BETWEEN 0 AND w - 1 AS x_{k}".replace("_-", "_m") for k in range(-3, 4)]
    inside += [f"y + {k} < h AS y_{k}" for k in range(4)]
    box = [f"(least(x + {d}, w - 1) - greatest(x - {d}, 0) + 1) * (least(y + {d}, h - 1) - greatest(y - {d}, 0) + 1) AS box{d}" for d in range(4)]
    return px.selectExpr("*", *inside, *box)


CORRELOGRAM_BINS = 192


def correlogram() -> list[Entry]:
    """Per colour and distance, same-coloured pairs; all pairs go to a second set of bins."""
    out = []
    for d in (1, 2, 3):
        at = [(plane_name(dx, dy), f"x_{dx}".replace("-", "m"), f"y_{dy}") for dx, dy in half_ring(d)]
        same = " + ".join(f"IF({x} AND {y} AND {plane} = p_0_0, 2, 0)" for plane, x, y in at)  # for either end
        out += [
            Entry(F.expr(f"p_0_0 * 3 + {d - 1}"), F.expr(same)),
            Entry(F.expr(f"p_0_0 * 3 + {d - 1 + CORRELOGRAM_BINS}"), F.expr(f"box{d} - box{d - 1}")),
        ]
    return out


def correlogram_ratio(sums: DataFrame) -> DataFrame:
    """Per mille of pairs with the same colour."""
    is_total = F.col("bin") >= CORRELOGRAM_BINS
    parts = sums.groupBy("image_id", (F.col("bin") % CORRELOGRAM_BINS).alias("bin")).agg(
        F.sum(F.when(~is_total, F.col("value")).otherwise(0)).alias("same"),
        F.sum(F.when(is_total, F.col("value")).otherwise(0)).alias("total"),
    )
    ratio = F.when(F.col("total") == 0, F.lit(0).cast("bigint")).otherwise(idiv(F.col("same") * 1000, "total"))
    return parts.select("image_id", "bin", ratio.alias("value")).filter(F.col("value") != 0)


# --- Gabor ---------------------------------------------------------------------------------------

SPAN = tuple(range(-2, 3))


def gabor_kernels() -> list[list[int]]:
    """Eight 5x5 kernels (two scales, four orientations) as whole numbers, row by row."""
    out = []
    for sigma, wave in ((1, 3), (2, 6)):
        for angle in (0, 45, 90, 135):
            cos, sin = math.cos(math.radians(angle)), math.sin(math.radians(angle))
            out.append([
                round(
                    1000 * math.exp(-(dx * dx + dy * dy) / (2 * sigma * sigma))
                    * math.cos(2 * math.pi * (dx * cos + dy * sin) / wave)
                )
                for dy in SPAN for dx in SPAN
            ])
    return out


def gabor_windows(images: DataFrame) -> DataFrame:
    """Centres on a grid of four with their 5x5 luminance window gathered in one array."""
    offsets = [(dx, dy) for dy in SPAN for dx in SPAN]
    px = stencils.window(stencils.with_luminance(images), "lum", offsets)
    centres = stencils.interior(px, 2).filter((c("x") % 4 == 2) & (c("y") % 4 == 2))
    return centres.selectExpr("image_id", *[f"CAST({plane_name(*at)} AS BIGINT) AS f{k}" for k, at in enumerate(offsets)])


def gabor(images: DataFrame) -> DataFrame:
    kernels = gabor_kernels()
    terms = [" + ".join(f"f{k} * {w}" for k, w in enumerate(kernel) if w) for kernel in kernels]
    responses = gabor_windows(images).selectExpr("image_id", *[f"{text} AS k{i}" for i, text in enumerate(terms)])
    sums = []
    for i in range(len(kernels)):
        sums += [F.expr(f"sum(abs(k{i}))").alias(f"v{2 * i}"), F.expr(f"sum(k{i} * k{i})").alias(f"v{2 * i + 1}")]
    return unpivot(responses.groupBy("image_id").agg(*sums), [f"v{j}" for j in range(2 * len(kernels))])


def unpivot(wide: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns to ``(bin, value)`` rows, in the order given."""
    cells = F.expr(f"array({', '.join(f'CAST({name} AS BIGINT)' for name in columns)})")
    return (
        wide.select("image_id", F.posexplode(cells).alias("bin", "value"))
        .select("image_id", F.col("bin").cast("bigint").alias("bin"), "value")
        .filter(F.col("value") != 0)
    )


# --- cosine transforms ---------------------------------------------------------------------------

# Zig-zag order of an 8x8 block as (u, v).
ZIGZAG_HEAD = ((0, 0), (1, 0), (0, 1), (0, 2), (1, 1), (2, 0))
JPEG_THRESHOLD = 67_108_864


def dct_basis() -> list[list[int]]:
    return [[round(1024 * math.cos((2 * x + 1) * u * math.pi / 16)) for x in range(8)] for u in range(8)]


def basis_value(u: int, position: str) -> str:
    """SQL text of ``basis[u][position]``; the table is a constant."""
    return f"get(array({', '.join(f'{b}L' for b in dct_basis()[u])}), CAST({position} AS INT))"


def grid_means(images: DataFrame, planes: dict[str, Column]) -> DataFrame:
    """Means over an 8x8 grid of cells: ``image_id, gx, gy`` and one mean per plane."""
    px = stencils.point(images).select(
        "image_id", idiv(c("x") * 8, "w").alias("gx"), idiv(c("y") * 8, "h").alias("gy"),
        *[value.cast("bigint").alias(name) for name, value in planes.items()],
    )
    sums = px.groupBy("image_id", "gx", "gy").agg(*[F.sum(n).alias(n) for n in planes], F.count(F.lit(1)).alias("n"))
    return sums.select("image_id", "gx", "gy", *[idiv(n, "n").alias(n) for n in planes])


def layout_coefficients(images: DataFrame, wanted: Sequence[tuple[str, int, int]], planes: dict[str, Column]) -> DataFrame:
    """Coefficients ``(plane, u, v)`` of the grid means; bins follow the order of ``wanted``."""
    cells = grid_means(images, planes).selectExpr(
        "*",
        *[f"{basis_value(u, 'gx')} AS across_{u}" for u in sorted({u for _, u, _ in wanted})],
        *[f"{basis_value(v, 'gy')} AS down_{v}" for v in sorted({v for _, _, v in wanted})],
    )
    sums = [
        F.expr(f"sum({plane} * across_{u} * down_{v})").alias(f"v{k}")
        for k, (plane, u, v) in enumerate(wanted)
    ]
    return unpivot(cells.groupBy("image_id").agg(*sums), [f"v{k}" for k in range(len(wanted))])


def colour_layout(images: DataFrame) -> DataFrame:
    r, g, b = (c(n).cast("bigint") for n in ("r", "g", "b"))
    planes = {
        "yy": c("lum"),
        "cb": idiv(r * -169 - g * 331 + b * 500 + 128000, 1000),
        "cr": idiv(r * 500 - g * 419 - b * 81 + 128000, 1000),
    }
    wanted = [(plane, u, v) for plane, n in (("yy", 6), ("cb", 3), ("cr", 3)) for u, v in ZIGZAG_HEAD[:n]]
    return layout_coefficients(images, wanted, planes)


def luminance_layout(images: DataFrame) -> DataFrame:
    return layout_coefficients(images, [("yy", u, v) for u in range(8) for v in range(8)], {"yy": c("lum")})


def jpeg_coefficient_histogram(images: DataFrame) -> DataFrame:
    """Separable 8x8 transform: lines by projection, columns by aggregation, then classes are counted."""
    basis = dct_basis()
    lines = stencils.line_segments(images).selectExpr(
        "image_id", "sx", "y div 8 AS sy", *[f"CAST(f[{x}] AS BIGINT) AS f{x}" for x in range(8)],
        *[f"{basis_value(v, 'y % 8')} AS down_{v}" for v in range(8)],
    )
    across = lines.selectExpr("image_id", "sx", "sy", *[f"down_{v}" for v in range(8)], *[
        " + ".join(f"f{x} * {basis[u][x]}" for x in range(8)) + f" AS u{u}" for u in range(8)
    ])
    blocks8 = across.groupBy("image_id", "sx", "sy").agg(*[
        F.expr(f"sum(u{u} * down_{v}) AS c{u * 8 + v}") for u in range(8) for v in range(8)
    ])
    coefficients = ", ".join(f"c{k}" for k in range(64))
    cells = blocks8.select("image_id", F.expr(f"posexplode(array({coefficients})) AS (k, coef)"))
    klass = f"CASE WHEN coef < -{JPEG_THRESHOLD} THEN 0 WHEN coef < 0 THEN 1 WHEN coef <= {JPEG_THRESHOLD} THEN 2 ELSE 3 END"
    return cells.groupBy("image_id", F.expr(f"CAST(k * 4 + {klass} AS BIGINT)").alias("bin")).agg(F.expr("count(1)").alias("value"))


# --- Tamura --------------------------------------------------------------------------------------


def with_box_sum(images: DataFrame, plane: str, half: int, name: str) -> DataFrame:
    """Adds the sum of a plane with its copies shifted by ``half`` right, down and both.

    Step by step, so that each plane is computed once and not once per shift.
    """
    add = lambda a, b: a + b
    across = images.withColumn("ahead", stencils.shifted(plane, half, 0))
    across = across.withColumn("across", F.zip_with(c(plane), "ahead", add))
    down = across.withColumn("ahead", stencils.shifted("across", 0, half))
    return down.withColumn(name, F.zip_with("across", "ahead", add)).drop("ahead", "across")


def tamura_windows(images: DataFrame) -> DataFrame:
    """Luminance with window sums of side 2 and 4 around each pixel, and the four neighbours its gradient needs."""
    rows = with_box_sum(stencils.with_luminance(images), "lum", 1, "w2")
    rows = with_box_sum(rows, "w2", 2, "w4")
    planes = {"lum": c("lum")} | {f"n{bit}": shifted for bit, shifted in enumerate(stencils.shifted("lum", *at) for at in stencils.RING) if bit % 2}
    for side, plane in ((2, "w2"), (4, "w4")):
        half = side // 2
        planes |= {
            f"right{side}": stencils.shifted(plane, 0, -half),
            f"left{side}": stencils.shifted(plane, -side, -half),
            f"below{side}": stencils.shifted(plane, -half, 0),
            f"above{side}": stencils.shifted(plane, -half, -side),
        }
    return with_gradient(stencils.pixels(rows, planes))


def best_window() -> Column:
    """Side whose adjacent windows differ most, compared at a common area; NULL where they do not fit."""
    strength = {}
    for side in (2, 4):
        fits = c("x").between(F.lit(side), c("w") - side) & c("y").between(F.lit(side), c("h") - side)
        apart = F.greatest(
            F.abs(c(f"right{side}") - c(f"left{side}")), F.abs(c(f"below{side}") - c(f"above{side}"))
        ) * (16 // (side * side))
        strength[side] = F.when(fits, apart)
    return F.when(strength[2].isNotNull(), F.when(strength[4] > strength[2], 4).otherwise(2))


def tamura(images: DataFrame) -> DataFrame:
    """Bin 0 coarseness, bin 1 contrast at four decimals, bins 2-17 directions.

    One pass over the pixels: sums of each image and direction first, bins of the image from those few rows.
    """
    lum = c("lum").cast("bigint")
    inside = c("x").between(F.lit(1), c("w") - 2) & c("y").between(F.lit(1), c("h") - 2) & (c("large") > 0)
    direction = c("octant") * 2 + F.when(c("small") * 1000 < c("large") * 414, 1).otherwise(0)
    px = tamura_windows(images).select("image_id", F.when(inside, direction + 2).cast("bigint").alias("bin"), best_window().alias("side"), lum.alias("lum"))
    parts = px.groupBy("image_id", "bin").agg(
        F.count(F.lit(1)).alias("value"), F.sum("side").alias("coarse"), *[F.sum(power(c("lum"), k)).alias(f"s{k}") for k in (1, 2, 3, 4)]
    )
    stats = parts.groupBy("image_id").agg(
        F.sum("value").alias("n"), *[F.sum(name).alias(name) for name in ("coarse", "s1", "s2", "s3", "s4")],
        F.collect_list(F.when(c("bin").isNotNull(), F.struct("bin", "value"))).alias("directions"),
    )
    n, s1, s2, s3, s4 = (c(k).cast("double") for k in ("n", "s1", "s2", "s3", "s4"))
    mean = s1 / n
    variance = s2 / n - mean * mean
    fourth = s4 / n - mean * s3 / n * 4.0 + mean * mean * s2 / n * 6.0 - mean * mean * mean * mean * 3.0
    flat = c("n") * c("s2") == c("s1") * c("s1")
    contrast = F.when(flat, F.lit(0.0)).otherwise(F.sqrt(variance) / F.pow(fourth / (variance * variance), F.lit(0.25)))
    moments = F.array(
        F.struct(F.lit(0).cast("bigint").alias("bin"), F.coalesce("coarse", F.lit(0)).cast("bigint").alias("value")),
        F.struct(F.lit(1).cast("bigint").alias("bin"), F.floor(contrast * 10000 + 0.5).cast("bigint").alias("value")),
    )
    return stats.select("image_id", F.explode(F.concat(moments, "directions")).alias("e")).select("image_id", "e.bin", "e.value").filter(c("value") != 0)


def power(x: Column, k: int) -> Column:
    out = x
    for _ in range(k - 1):
        out = out * x
    return out


DESCRIPTORS: dict[str, Tally | Callable[[DataFrame], DataFrame]] = {
    "SIMPLE_COLOR_HISTOGRAM": Tally(stencils.point, simple_colour_histogram),
    "OPPONENT_HISTOGRAM": Tally(stencils.point, opponent_histogram),
    "JOINT_HISTOGRAM": Tally(rings, joint_histogram),
    "LOCAL_BINARY_PATTERNS": Tally(rings, local_binary_patterns),
    "ROTATION_INVARIANT_LOCAL_BINARY_PATTERNS": Tally(rings, rotation_invariant_patterns),
    "BINARY_PATTERNS_PYRAMID": Tally(rings, patterns_pyramid),
    "AUTO_COLOR_CORRELOGRAM": Tally(colour_windows, correlogram, correlogram_ratio),
    "EDGE_HISTOGRAM": Tally(blocks, edge_histogram),
    "COLOR_LAYOUT": colour_layout,
    "LUMINANCE_LAYOUT": luminance_layout,
    "JPEG_COEFFICIENT_HISTOGRAM": jpeg_coefficient_histogram,
    "SCALABLE_COLOR": Tally(hsv_cells, scalable_colour),
    "PHOG": Tally(rings, gradient_pyramid),
    "CEDD": Tally(blocks, cedd),
    "FCTH": Tally(blocks, fcth),
    "JCD": Tally(blocks, jcd),
    "GABOR": gabor,
    "TAMURA": tamura,
}
