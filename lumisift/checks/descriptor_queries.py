"""Descriptors over image tiles derived from the given vectors.

The oracle works on pixel rows with neighbour joins, a formulation independent of the shifted planes
used in Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lumisift.checks.fixtures import tiles8, tiles32
from lumisift.checks.registry import query
from lumisift.operators.descriptors import DESCRIPTORS, described

PX8 = """lv AS (
  SELECT vec_id AS image_id, generate_subscripts(embedding, 1) - 1 AS i,
    CAST(least(255, greatest(0, floor(128 + CAST(unnest(embedding) AS DOUBLE) * 400))) AS BIGINT) AS v FROM embeddings),
px8 AS (
  SELECT a.image_id, a.i % 8 AS x, a.i // 8 AS y, 8 AS w, 8 AS h, a.v AS r, b.v AS g, c.v AS b
  FROM lv a JOIN lv b ON b.image_id = a.image_id AND b.i = (a.i + 1) % 64
            JOIN lv c ON c.image_id = a.image_id AND c.i = (a.i + 7) % 64)"""
PX32 = PX8 + """,
px32 AS (
  SELECT p.image_id, gx.range AS x, gy.range AS y, 32 AS w, 32 AS h,
    least(255, p.r + (3 * gx.range + 5 * gy.range) % 4) AS r, least(255, p.g + (3 * gx.range + 5 * gy.range) % 4) AS g,
    least(255, p.b + (3 * gx.range + 5 * gy.range) % 4) AS b
  FROM range(32) gx, range(32) gy, px8 p
  WHERE p.x = ((gx.range + 1) // 4) % 8 AND p.y = ((gy.range + 1) // 4) % 8)"""


def px(size: int) -> str:
    return f"""{PX8 if size == 8 else PX32},
px AS (SELECT *, (299 * r + 587 * g + 114 * b) // 1000 AS lum, (r // 64) * 16 + (g // 64) * 4 + b // 64 AS c64 FROM px{size})"""


RING = """off AS (SELECT * FROM (VALUES (0,-1,-1), (1,0,-1), (2,1,-1), (3,1,0), (4,1,1), (5,0,1), (6,-1,1), (7,-1,0)) t(bit, dx, dy)),
nb AS (
  SELECT p.image_id, p.x, p.y, o.bit, p.lum, n.lum AS nl, p.c64, p.w, p.h
  FROM px p, off o, px n WHERE n.image_id = p.image_id AND n.x = p.x + o.dx AND n.y = p.y + o.dy
    AND p.x BETWEEN 1 AND p.w - 2 AND p.y BETWEEN 1 AND p.h - 2),
ring AS (
  SELECT image_id, x, y, w, h, c64, CAST(sum(CASE WHEN nl >= lum THEN 1 << CAST(bit AS INTEGER) ELSE 0 END) AS BIGINT) AS code,
    sum(CASE WHEN nl < lum THEN 1 ELSE 0 END) AS rank,
    max(nl) FILTER (bit = 3) - max(nl) FILTER (bit = 7) AS gx, max(nl) FILTER (bit = 5) - max(nl) FILTER (bit = 1) AS gy
  FROM nb GROUP BY ALL),
oct AS (
  SELECT *, (CASE WHEN gx < 0 THEN 4 ELSE 0 END) + (CASE WHEN gy < 0 THEN 2 ELSE 0 END)
    + (CASE WHEN abs(gx) < abs(gy) THEN 1 ELSE 0 END) AS octant FROM ring)"""

ROT = """turns AS (
  SELECT v.range AS code, min(((v.range << CAST(k.range AS INTEGER)) | (v.range >> CAST(8 - k.range AS INTEGER))) & 255) AS least
  FROM range(256) v, range(8) k GROUP BY 1),
rot AS (SELECT code, dense_rank() OVER (ORDER BY least) - 1 AS class FROM turns)"""

HSV = """hv AS (SELECT *, greatest(r, g, b) AS mx, greatest(r, g, b) - least(r, g, b) AS cr FROM {source}),
hsv AS (SELECT *, CASE WHEN cr = 0 THEN 0 WHEN mx = r THEN ((60 * (g - b) + 360 * cr) // cr) % 360
    WHEN mx = g THEN (60 * (b - r) + 120 * cr) // cr ELSE (60 * (r - g) + 240 * cr) // cr END AS hue,
    CASE WHEN mx = 0 THEN 0 ELSE (255 * cr) // mx END AS sat FROM hv)"""

COLOUR24 = """col AS (SELECT *, CASE WHEN mx < 52 THEN 0 WHEN sat < 52 THEN (CASE WHEN mx < 204 THEN 1 ELSE 2 END)
  ELSE 3 + 3 * (CASE WHEN hue < 20 OR hue >= 340 THEN 0 WHEN hue < 45 THEN 1 WHEN hue < 75 THEN 2 WHEN hue < 165 THEN 3
    WHEN hue < 195 THEN 4 WHEN hue < 270 THEN 5 ELSE 6 END)
    + (CASE WHEN mx < 128 THEN 0 WHEN sat >= 128 THEN 1 ELSE 2 END) END AS colour FROM hsv)"""

BLOCKS = """blk AS (
  SELECT image_id, x // 2 AS bx, y // 2 AS bky, max(w) AS w, max(h) AS h,
    max(lum) FILTER (x % 2 = 0 AND y % 2 = 0) AS pa, max(lum) FILTER (x % 2 = 1 AND y % 2 = 0) AS pb,
    max(lum) FILTER (x % 2 = 0 AND y % 2 = 1) AS pc, max(lum) FILTER (x % 2 = 1 AND y % 2 = 1) AS pd,
    CAST(sum(r) AS BIGINT) // 4 AS r, CAST(sum(g) AS BIGINT) // 4 AS g, CAST(sum(b) AS BIGINT) // 4 AS b FROM px GROUP BY 1, 2, 3),
str AS (SELECT *, 1000 * abs(pa - pb + pc - pd) AS s0, 1000 * abs(pa + pb - pc - pd) AS s1, 1414 * abs(pa - pd) AS s2,
    1414 * abs(pb - pc) AS s3, 2000 * abs(pa - pb - pc + pd) AS s4,
    (CASE WHEN abs(pa - pb + pc - pd) >= 40 THEN 4 ELSE 0 END) + (CASE WHEN abs(pa + pb - pc - pd) >= 40 THEN 2 ELSE 0 END)
    + (CASE WHEN abs(pa - pb - pc + pd) >= 40 THEN 1 ELSE 0 END) AS haar FROM blk),
edge AS (SELECT *, CASE WHEN greatest(s0, s1, s2, s3, s4) < 11000 THEN NULL WHEN s0 >= greatest(s1, s2, s3, s4) THEN 0
    WHEN s1 >= greatest(s2, s3, s4) THEN 1 WHEN s2 >= greatest(s3, s4) THEN 2 WHEN s3 >= s4 THEN 3 ELSE 4 END AS kind FROM str)"""
BLOCK_COLOURS = f"{BLOCKS}, {HSV.format(source='edge')}, {COLOUR24}"


def counted(ctes: str, bin_sql: str, source: str, value: str = "1", where: str = "true") -> str:
    return f"""WITH {ctes} SELECT image_id, CAST({bin_sql} AS BIGINT) AS bin, CAST(sum({value}) AS BIGINT) AS value
FROM {source} WHERE {where} GROUP BY 1, 2 HAVING sum({value}) <> 0"""


LEVELS = "(VALUES (1, 0), (2, 1), (4, 5)) l(side, first)"
CELL = "(l.first + (y * l.side // h) * l.side + x * l.side // w)"
BASIS = """basis(u, x, c) AS MATERIALIZED (SELECT u.range, x.range, CAST(round(1024 * cos((2 * x.range + 1) * u.range * pi() / 16)) AS BIGINT)
  FROM range(8) u, range(8) x)"""
GABOR = """gk(k, dx, dy, c) AS MATERIALIZED (
  SELECT s.k * 4 + o.range, dx.range - 2, dy.range - 2, CAST(round(1000 * exp(-((dx.range - 2) * (dx.range - 2) + (dy.range - 2) * (dy.range - 2)) / (2.0 * s.sigma * s.sigma))
    * cos(2 * pi() * ((dx.range - 2) * cos(radians(o.range * 45)) + (dy.range - 2) * sin(radians(o.range * 45))) / s.wave)) AS BIGINT)
  FROM (VALUES (0, 1, 3), (1, 2, 6)) s(k, sigma, wave), range(4) o, range(5) dx, range(5) dy)"""
YCC = """ycc AS (
  SELECT image_id, x * 8 // w AS gx, y * 8 // h AS gy, p.plane, CAST(sum(CASE p.plane WHEN 0 THEN lum
      WHEN 1 THEN (128000 - 169 * r - 331 * g + 500 * b) // 1000 ELSE (128000 + 500 * r - 419 * g - 81 * b) // 1000 END) AS BIGINT) // count(*) AS m
  FROM px, (VALUES (0), (1), (2)) p(plane) GROUP BY 1, 2, 3, 4)"""

ORACLES = {
    "d01_simple_color_histogram": counted(px(8), "c64", "px"),
    "d02_opponent_histogram": counted(
        px(8), "((r - g + 255) // 128) * 16 + ((r + g - 2 * b + 510) // 256) * 4 + (r + g + b) // 192", "px"
    ),
    "d03_joint_histogram": counted(f"{px(8)}, {RING}", "c64 * 9 + rank", "ring"),
    "d04_local_binary_patterns": counted(f"{px(8)}, {RING}", "code", "ring"),
    "d05_rotation_invariant_local_binary_patterns": counted(
        f"{px(8)}, {RING}, {ROT}", "class", "ring JOIN rot ON rot.code = ring.code"
    ),
    "d06_binary_patterns_pyramid": counted(
        f"{px(8)}, {RING}, {ROT}", f"{CELL} * 36 + class", f"ring JOIN rot ON rot.code = ring.code, {LEVELS}"
    ),
    "d07_auto_color_correlogram": f"""WITH {px(8)}, pair AS (
  SELECT a.image_id, a.c64 AS ca, b.c64 AS cb, greatest(abs(a.x - b.x), abs(a.y - b.y)) AS d
  FROM px a JOIN px b ON a.image_id = b.image_id AND greatest(abs(a.x - b.x), abs(a.y - b.y)) BETWEEN 1 AND 3)
SELECT image_id, CAST(ca * 3 + d - 1 AS BIGINT) AS bin, CAST(1000 * sum(CASE WHEN ca = cb THEN 1 ELSE 0 END) AS BIGINT) // count(*) AS value
FROM pair GROUP BY image_id, ca, d HAVING CAST(1000 * sum(CASE WHEN ca = cb THEN 1 ELSE 0 END) AS BIGINT) // count(*) <> 0""",
    "d08_edge_histogram": counted(
        f"{px(32)}, {BLOCKS}", "((bky * 4 // (h // 2)) * 4 + bx * 4 // (w // 2)) * 5 + kind", "edge", "1", "kind IS NOT NULL"
    ),
    "d09_color_layout": f"""WITH {px(32)}, {YCC}, {BASIS}, zz(k, plane, u, v) AS (VALUES
  (0,0,0,0), (1,0,1,0), (2,0,0,1), (3,0,0,2), (4,0,1,1), (5,0,2,0), (6,1,0,0), (7,1,1,0), (8,1,0,1), (9,2,0,0), (10,2,1,0), (11,2,0,1))
SELECT image_id, CAST(k AS BIGINT) AS bin, CAST(sum(m * bu.c * bv.c) AS BIGINT) AS value FROM ycc JOIN zz ON zz.plane = ycc.plane
JOIN basis bu ON bu.u = zz.u AND bu.x = gx JOIN basis bv ON bv.u = zz.v AND bv.x = gy GROUP BY 1, 2 HAVING sum(m * bu.c * bv.c) <> 0""",
    "d10_luminance_layout": f"""WITH {px(32)}, {YCC}, {BASIS}
SELECT image_id, CAST(bu.u * 8 + bv.u AS BIGINT) AS bin, CAST(sum(m * bu.c * bv.c) AS BIGINT) AS value FROM ycc
JOIN basis bu ON bu.x = gx JOIN basis bv ON bv.x = gy WHERE plane = 0 GROUP BY 1, 2 HAVING sum(m * bu.c * bv.c) <> 0""",
    "d11_jpeg_coefficient_histogram": f"""WITH {px(32)}, {BASIS}, one AS (
  SELECT image_id, px.x // 8 AS sx, y, bu.u, sum(lum * bu.c) AS s FROM px JOIN basis bu ON bu.x = px.x % 8 GROUP BY 1, 2, 3, 4),
two AS (SELECT image_id, sx, y // 8 AS sy, one.u, bv.u AS v, sum(s * bv.c) AS c FROM one JOIN basis bv ON bv.x = one.y % 8 GROUP BY 1, 2, 3, 4, 5)
SELECT image_id, CAST((u * 8 + v) * 4 + CASE WHEN c < -67108864 THEN 0 WHEN c < 0 THEN 1 WHEN c <= 67108864 THEN 2 ELSE 3 END AS BIGINT) AS bin,
  count(*) AS value FROM two GROUP BY 1, 2""",
    "d12_scalable_color": f"""WITH {px(32)}, {HSV.format(source='px')}, cell AS (
  SELECT image_id, (hue * 16 // 360) * 16 + (sat // 64) * 4 + mx // 64 AS k, count(*) AS n FROM hsv GROUP BY 1, 2),
parts AS (SELECT image_id, k // 16 AS bin, n AS value FROM cell
  UNION ALL SELECT image_id, 16 + k // 16, CASE WHEN (k // 8) % 2 = 0 THEN n ELSE -n END FROM cell
  UNION ALL SELECT image_id, 32 + k // 8, CASE WHEN (k // 4) % 2 = 0 THEN n ELSE -n END FROM cell)
SELECT image_id, CAST(bin AS BIGINT) AS bin, CAST(sum(value) AS BIGINT) AS value FROM parts GROUP BY 1, 2 HAVING sum(value) <> 0""",
    "d13_phog": counted(f"{px(32)}, {RING}, {ROT}", f"{CELL} * 8 + octant", f"oct, {LEVELS}", "abs(gx) + abs(gy)"),
    "d14_cedd": counted(f"{px(32)}, {BLOCK_COLOURS}", "coalesce(kind + 1, 0) * 24 + colour", "col"),
    "d15_fcth": counted(f"{px(32)}, {BLOCK_COLOURS}", "haar * 24 + colour", "col"),
    "d16_jcd": counted(
        f"{px(32)}, {BLOCK_COLOURS}, tex(haar, t) AS (VALUES (0,0), (4,1), (2,2), (3,3), (5,4), (1,5), (6,6), (7,6)), "
        "both_parts AS (SELECT image_id, coalesce(kind + 1, 0) AS t, colour FROM col UNION ALL "
        "SELECT image_id, tex.t, colour FROM col JOIN tex ON tex.haar = col.haar)", "t * 24 + colour", "both_parts"
    ),
    "d17_gabor": f"""WITH {px(32)}, {GABOR}, resp AS (
  SELECT p.image_id, p.x, p.y, k, sum(n.lum * gk.c) AS s FROM px p, gk, px n WHERE p.x % 4 = 2 AND p.y % 4 = 2
    AND p.x BETWEEN 2 AND p.w - 3 AND p.y BETWEEN 2 AND p.h - 3
    AND n.image_id = p.image_id AND n.x = p.x + gk.dx AND n.y = p.y + gk.dy GROUP BY 1, 2, 3, 4)
SELECT image_id, CAST(2 * k + m AS BIGINT) AS bin, CAST(sum(CASE WHEN m = 0 THEN abs(s) ELSE s * s END) AS BIGINT) AS value
FROM resp, (VALUES (0), (1)) t(m) GROUP BY 1, 2 HAVING sum(abs(s)) <> 0""",
    "d18_tamura": f"""WITH {px(32)}, {RING},
side(side) AS (VALUES (2), (4)),
offs AS (SELECT side, dx.range AS dx, dy.range AS dy FROM side, range(4) dx, range(4) dy WHERE dx.range < side AND dy.range < side),
cells AS MATERIALIZED (SELECT p.image_id, p.x + o.dx AS nx, p.y + o.dy AS ny, o.side, p.x, p.y FROM px p, offs o),
win AS MATERIALIZED (SELECT c.image_id, c.x, c.y, c.side, sum(n.lum) AS a FROM cells c
  JOIN px n ON n.image_id = c.image_id AND n.x = c.nx AND n.y = c.ny GROUP BY 1, 2, 3, 4),
spot AS MATERIALIZED (SELECT image_id, x, y, side, x - side AS left_x, x - side // 2 AS mid_x, y - side // 2 AS mid_y, y - side AS up_y
  FROM px, side WHERE x BETWEEN side AND w - side AND y BETWEEN side AND h - side),
adj AS (SELECT p.image_id, p.x, p.y, p.side, greatest(abs(r.a - l.a), abs(d.a - u.a)) * (16 // (p.side * p.side)) AS e FROM spot p
  JOIN win r ON r.image_id = p.image_id AND r.side = p.side AND r.x = p.x AND r.y = p.mid_y
  JOIN win l ON l.image_id = p.image_id AND l.side = p.side AND l.x = p.left_x AND l.y = p.mid_y
  JOIN win d ON d.image_id = p.image_id AND d.side = p.side AND d.x = p.mid_x AND d.y = p.y
  JOIN win u ON u.image_id = p.image_id AND u.side = p.side AND u.x = p.mid_x AND u.y = p.up_y),
best AS (SELECT image_id, x, y, CASE WHEN max(e) FILTER (side = 4) > max(e) FILTER (side = 2) THEN 4 ELSE 2 END AS side FROM adj GROUP BY 1, 2, 3),
mom AS (SELECT image_id, count(*)::DOUBLE AS n, sum(lum)::DOUBLE AS s1, sum(lum * lum)::DOUBLE AS s2,
  sum(lum * lum * lum)::DOUBLE AS s3, sum(lum * lum * lum * lum)::DOUBLE AS s4 FROM px GROUP BY 1),
cen AS (SELECT image_id, s2 / n - (s1 / n) * (s1 / n) AS var,
  s4 / n - (s1 / n) * s3 / n * 4.0::DOUBLE + (s1 / n) * (s1 / n) * s2 / n * 6.0::DOUBLE
  - (s1 / n) * (s1 / n) * (s1 / n) * (s1 / n) * 3.0::DOUBLE AS m4 FROM mom WHERE n * s2 <> s1 * s1)
SELECT image_id, 0::BIGINT AS bin, CAST(sum(side) AS BIGINT) AS value FROM best GROUP BY 1
UNION ALL SELECT image_id, 1, CAST(floor(sqrt(var) / pow(m4 / (var * var), 0.25::DOUBLE) * 10000 + 0.5) AS BIGINT) FROM cen
UNION ALL SELECT image_id, CAST(2 + octant * 2 + CASE WHEN 1000 * least(abs(gx), abs(gy)) < 414 * greatest(abs(gx), abs(gy)) THEN 1 ELSE 0 END AS BIGINT),
  count(*) FROM oct WHERE abs(gx) + abs(gy) > 0 GROUP BY 1, 2""",
}

SMALL_TILES = {"d01", "d02", "d03", "d04", "d05", "d06", "d07"}


def _register(key: str, sql: str) -> None:
    number, feature = key.split("_", 1)
    source = tiles8 if number in SMALL_TILES else tiles32

    @query(key, sql)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return described(source(spark, sf), DESCRIPTORS[feature.upper()])


for _key, _sql in ORACLES.items():
    _register(_key, _sql)
