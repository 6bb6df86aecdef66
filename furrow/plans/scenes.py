"""Queries over GeoTIFF scenes: files are written to the shared folder and read back by Spark."""

from __future__ import annotations

import os
import tempfile

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow import session
from furrow.operators import raster
from furrow.plans.fixtures import query, query_n, r4n
from furrow.sources import synthetic, tiff

ROWS, COLS, DAYS = 96, 80, (110, 80, 140)
MAP = (10.0, 0.0, 500000.0, 0.0, -10.0, 4200000.0)  #: of the scenes
COVER = (30.0, 0.0, 499905.0, 0.0, -30.0, 4200085.0)  #: of a coarser raster that covers them but for a corner
PIXELS = f"(SELECT r.range AS r, c.range AS c FROM range({ROWS}) r CROSS JOIN range({COLS}) c)"
VALUE = "CAST(300 + 100 * b + (r * 13 + c * 7 + d * b) % 1700 AS DOUBLE)"
BANDS = f"SELECT d.d AS doy, CAST(b.range AS INT) AS band, p.r, p.c, {VALUE.replace(' b', ' b.range').replace('d * b.range', 'd.d * b.range')} AS value FROM (VALUES {', '.join(f'({d})' for d in DAYS)}) d(d) CROSS JOIN range(1, 6) b CROSS JOIN {PIXELS} p"
WIDE = f"s AS ({BANDS}), w AS (SELECT doy, r, c, {', '.join(f'max(CASE WHEN band = {b} THEN value END) AS b{b}' for b in range(1, 6))} FROM s GROUP BY 1, 2, 3)"
HOLE = "(r * 31 + c * 17) % 97 = 0"


def _scenes(spark: SparkSession) -> str:
    """A folder with a six-band scene for each date."""
    r, c = np.mgrid[:ROWS, :COLS]
    to = session.place(spark, "scenes")
    for d in DAYS:
        bands = np.stack([300 + 100 * b + (r * 13 + c * 7 + d * b) % 1700 for b in range(1, 7)]).astype("u2")
        tiff.put(spark, f"{to}/scene_doy_{d}.tif", tiff.tiff_bytes(bands, MAP, 32650))
    return to


def _cover(spark: SparkSession, elevation: bool = False) -> DataFrame:
    """The coarser raster, read back: a class with holes, or an elevation."""
    r, c = np.mgrid[:36, :32] if elevation else np.mgrid[:33, :30]
    a = (1000 + 7 * r * c + 30 * c).astype("f8") if elevation else np.where((r * 31 + c * 17) % 97 == 0, -9999, (r * 5 + c * 3) % 7).astype("f4")
    to = session.place(spark, "cover")
    tiff.put(spark, f"{to}/cover_doy_1.tif", tiff.tiff_bytes(a, COVER, 32650, -9999))
    return tiff.scenes_binary(spark, to).select("r", "c", "value")


def _tiles(spark: SparkSession) -> DataFrame:
    return tiff.scenes_binary(spark, _scenes(spark), 32)


@query(f"SELECT doy, band, CAST(r // 32 AS INT) AS tile_r, CAST(c // 32 AS INT) AS tile_c, r, c, value FROM ({BANDS})")
def tiff_windows(spark: SparkSession, d: str) -> DataFrame:
    """Every pixel of every band and date, tile by tile, the last tiles ragged."""
    return _tiles(spark).select("doy", "band", "tile_r", "tile_c", "r", "c", "value")


@query(f"SELECT 'scene_doy_' || d.d || '.tif' AS scene, d.d AS doy, 6 AS bands, CAST({ROWS} AS BIGINT) AS height, CAST({COLS} AS BIGINT) AS width, true AS multispectral, CAST(10 AS DOUBLE) AS step, CAST(500000 AS DOUBLE) AS x0, CAST(4200000 AS DOUBLE) AS y0, 32650 AS epsg, CAST(NULL AS DOUBLE) AS nodata FROM (VALUES {', '.join(f'({d})' for d in DAYS)}) d(d)")
def tiff_catalog(spark: SparkSession, d: str) -> DataFrame:
    return tiff.catalog(spark, _scenes(spark))


@query(f"SELECT r.range AS r, c.range AS c, CASE WHEN {HOLE.replace('r *', 'r.range *').replace('c *', 'c.range *')} THEN NULL ELSE CAST((r.range * 5 + c.range * 3) % 7 AS DOUBLE) END AS value FROM range(33) r CROSS JOIN range(30) c")
def tiff_nodata(spark: SparkSession, d: str) -> DataFrame:
    return _cover(spark)


def _fold(x: str, n: int) -> str:
    """A place beyond the border, mirrored with the border pixel repeated."""
    return f"CASE WHEN {x} < 0 THEN -1 - ({x}) WHEN {x} >= {n} THEN {2 * n - 1} - ({x}) ELSE {x} END"


FOUR = VALUE.replace(" b", " 4").replace("* b", "* 4").replace("r *", f"({_fold('y', ROWS)}) *").replace("c *", f"({_fold('x', COLS)}) *")
BOX = "OVER (PARTITION BY d, {} ORDER BY {} ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING)"
INDEX = f"""WITH {WIDE}, p AS (SELECT d, y, x, {FOUR} AS v FROM (VALUES {', '.join(f'({d})' for d in DAYS)}) d(d) CROSS JOIN range(-5, {ROWS + 5}) y(y) CROSS JOIN range(-5, {COLS + 5}) x(x)),
    h AS (SELECT d, y, x, sum(v) {BOX.format('y', 'x')} AS s, sum(v * v) {BOX.format('y', 'x')} AS q FROM p), k AS (SELECT d AS doy, y AS r, x AS c, sum(s) {BOX.format('x', 'y')} / 121 AS mean, sum(q) {BOX.format('x', 'y')} / 121 AS sq FROM h),
    t AS (SELECT * FROM k WHERE r >= 0 AND r < {ROWS} AND c >= 0 AND c < {COLS}),
    m AS (SELECT w.*, mean, sq, (b2 - b5) / greatest(b2 + b5, 1e-4) AS mn, CASE WHEN b4 + b3 > 0 THEN (b4 - b3) / (b4 + b3) ELSE 0 END AS nd, CASE WHEN b4 + b5 > 0 THEN (b4 - b5) / (b4 + b5) ELSE 0 END AS ls, greatest(-2, least(10, CASE WHEN b2 > 0 THEN b4 / b2 - 1 ELSE 0 END)) AS gc FROM w JOIN t USING (doy, r, c)),
    x AS (SELECT *, (mn > 0.02 AND b4 < 1200) OR (nd < 0 AND mn > -0.05) OR nd < -0.05 AS water FROM m)
    SELECT r, c, doy, round(CASE WHEN water THEN least(nd, -0.30) ELSE nd END, 4) AS ndvi, round(CASE WHEN water THEN 0.60 ELSE ls END, 4) AS lswi, round(CASE WHEN water THEN -1.0 ELSE gc END, 4) AS gcvi, round(sqrt(greatest(0, sq - mean * mean)) / greatest(mean, 1), 4) AS cv FROM x"""


@query_n(INDEX)
def scene_channels(spark: SparkSession, d: str) -> DataFrame:
    """Four index series of each pixel, one row a date."""
    s = tiff.channels(_tiles(spark))
    flat = s.select("r", "c", F.explode(F.arrays_zip("days", "ndvi", "lswi", "gcvi", "cv")).alias("x"))
    return flat.select("r", "c", F.col("x.days").alias("doy"), *(r4n(F.col(f"x.{k}")).alias(k) for k in ("ndvi", "lswi", "gcvi", "cv")))


@query_n(f"WITH s AS ({BANDS}), k AS (SELECT doy, r // 7 AS r, c // 7 AS c, avg(CASE WHEN band = 4 THEN value END) AS n, avg(CASE WHEN band = 3 THEN value END) AS red FROM s GROUP BY 1, 2, 3) SELECT doy, r, c, round((n - red) / (n + red + 1e-6), 4) AS value FROM k")
def date_thumbnails(spark: SparkSession, d: str) -> DataFrame:
    return tiff.thumbnails(_tiles(spark), 7).select("doy", "r", "c", r4n(F.col("value")).alias("value"))


def _stretched(b: str, name: str) -> str:
    return f"CAST(floor(255 * greatest(0, least(1, ({b} - quantile_cont({b}, 0.02) OVER ()) / (quantile_cont({b}, 0.98) OVER () - quantile_cont({b}, 0.02) OVER () + 1e-5)))) AS INT) AS {name}"


@query(f"WITH {WIDE}, l AS (SELECT * FROM w WHERE doy = (SELECT max(doy) FROM w)) SELECT r, c, {_stretched('b3', 'red')}, {_stretched('b2', 'green')}, {_stretched('b1', 'blue')} FROM l")
def rgb_composite(spark: SparkSession, d: str) -> DataFrame:
    return tiff.composite(_tiles(spark))


AT = f"(SELECT r, c, (4200000 - 10 * (r + 0.5) - 4200085) / -30 AS y, (500000 + 10 * (c + 0.5) - 499905) / 30 AS x FROM {PIXELS})"


@query(f"SELECT r.range AS r, c.range AS c, CAST((r.range * 7 + c.range * 3) % 5 AS DOUBLE) AS value FROM range({ROWS}) r CROSS JOIN range({COLS}) c")
def class_map(spark: SparkSession, d: str) -> DataFrame:
    """A map written as one tiled TIFF with overviews, read back by Spark."""
    pixels = spark.range(ROWS * COLS).select(F.expr(f"id DIV {COLS}").alias("r"), (F.col("id") % COLS).alias("c")).withColumn("code", F.expr("CAST((r * 7 + c * 3) % 5 AS INT)"))
    with tempfile.TemporaryDirectory() as folder:
        tiff.write_pyramid(tiff.class_tiles(pixels, 32), os.path.join(folder, "map.tif"), ROWS, COLS, MAP, 32650, 32)
        with open(os.path.join(folder, "map.tif"), "rb") as f:
            data = f.read()
    to = session.place(spark, "map")
    tiff.put(spark, f"{to}/map_doy_1.tif", data)
    return tiff.scenes_binary(spark, to).select("r", "c", "value")


@query(f"SELECT a.r, a.c, CASE WHEN s.range IS NULL OR q.range IS NULL OR (s.range * 31 + q.range * 17) % 97 = 0 THEN NULL ELSE CAST((s.range * 5 + q.range * 3) % 7 AS DOUBLE) END AS value FROM {AT} a LEFT JOIN range(33) s ON s.range = floor(a.y) LEFT JOIN range(30) q ON q.range = floor(a.x)")
def prior_reprojected(spark: SparkSession, d: str) -> DataFrame:
    """A coarser raster of another origin under each pixel; null in its holes."""
    target = spark.range(ROWS * COLS).select(F.expr(f"id DIV {COLS}").alias("r"), (F.col("id") % COLS).alias("c"))
    return raster.reproject_nearest(target, _cover(spark), MAP, COVER, ["value"])


DEM = f"""WITH e AS (SELECT r, c, 1000 + 7 * (y - 0.5) * (x - 0.5) + 30 * (x - 0.5) AS z FROM {AT}), s AS (SELECT *, lag(z) OVER (PARTITION BY c ORDER BY r) AS u, lead(z) OVER (PARTITION BY c ORDER BY r) AS d, lag(z) OVER (PARTITION BY r ORDER BY c) AS a, lead(z) OVER (PARTITION BY r ORDER BY c) AS b FROM e),
    k AS (SELECT r, c, z, CASE WHEN u IS NULL THEN d - z WHEN d IS NULL THEN z - u ELSE (d - u) / 2 END / 10 AS gy, CASE WHEN a IS NULL THEN b - z WHEN b IS NULL THEN z - a ELSE (b - a) / 2 END / 10 AS gx FROM s)
    SELECT r, c, round(z, 4) AS elev, round(degrees(atan(sqrt(gx * gx + gy * gy))), 4) AS slope, z > 1800 OR degrees(atan(sqrt(gx * gx + gy * gy))) > 25 AS veto FROM k"""


@query_n(DEM)
def dem_veto(spark: SparkSession, d: str) -> DataFrame:
    """An elevation raster brought to the scene's grid (it is bilinear itself, so the values are exact), its slope and the veto."""
    target = spark.range(ROWS * COLS).select(F.expr(f"id DIV {COLS}").alias("r"), (F.col("id") % COLS).alias("c"))
    grid = raster.reproject_bilinear(target, _cover(spark, True).withColumnRenamed("value", "elev"), MAP, COVER, "elev")
    return raster.terrain_veto(grid, resolution=10.0).select("r", "c", r4n(F.col("elev")).alias("elev"), r4n(F.col("slope")).alias("slope"), "veto")


# ---- synthetic scenes, whose draws SQL can make as well


def _u(*parts: str) -> str:
    """0 to 1 from the MD5 of the parts."""
    return f"(CAST('0x' || substr(md5(concat_ws(':', {', '.join(parts)})), 1, 13) AS BIGINT) / 4503599627370496.0)"


def _series(code: str, sigma: float, seed: int = 42) -> str:
    curves = " ".join(f"WHEN {k} THEN [{', '.join(map(str, v))}]" for k, v in synthetic.SCENE.items())
    normal = f"sqrt(-2 * ln(greatest({_u(str(seed), 'r', 'c', 't', chr(39) + 'u' + chr(39))}, 1e-12))) * cos(2 * pi() * {_u(str(seed), 'r', 'c', 't', chr(39) + 'v' + chr(39))})"
    return f"SELECT r, c, code, t, greatest(0.05, least(0.95, (CASE {code} {curves} END)[t + 1] + {sigma} * {normal})) AS v FROM coded CROSS JOIN (SELECT range AS t FROM range(8))"


SCENE = f"""WITH p AS (SELECT r.range AS r, c.range AS c, r.range // 18 AS i, c.range // 22 AS j, r.range % 18 AS y, c.range % 22 AS x FROM range(90) r CROSS JOIN range(110) c),
    f AS (SELECT *, 11 + floor(5 * {_u('42', 'i', 'j', "'h'")}) AS high, 14 + floor(6 * {_u('42', 'i', 'j', "'w'")}) AS wide, 1 + floor(4 * {_u('42', 'i', 'j', "'k'")}) AS kind FROM p),
    coded AS (SELECT r, c, CAST(CASE WHEN y >= 1 AND y <= high AND x >= 1 AND x <= wide AND NOT ((y = 1 OR y = high OR x = 1 OR x = wide) AND {_u('42', 'r', 'c', "'b'")} < 0.65) THEN kind ELSE 0 END AS INT) AS code FROM f), s AS ({_series('code', 0.025)})
    SELECT code, CAST(count(*) / 8 AS BIGINT) AS pixels, round(avg(v), 4) AS mean, round(max(v), 4) AS most FROM s GROUP BY 1"""


@query_n(SCENE)
def synthetic_scene(spark: SparkSession, d: str) -> DataFrame:
    """The drawn landscape: pixels of each class, and its series' mean and maximum."""
    s = synthetic.scene(spark, 90, 110).select("code", F.posexplode("ndvi").alias("t", "v"))
    return s.groupBy("code").agg(F.sum((F.col("t") == 0).cast("long")).alias("pixels"), r4n(F.avg("v")).alias("mean"), r4n(F.max("v")).alias("most"))


DEMO = f"""WITH p AS (SELECT r.range AS r, c.range AS c FROM range(80) r CROSS JOIN range(80) c), f AS (SELECT *, {_u('42', 'r // 16', 'c // 16')} AS u FROM p),
    coded AS (SELECT r, c, CAST(CASE WHEN (r % 16 = 0 OR c % 16 = 0) AND {_u('42', 'r', 'c', "'b'")} < 0.6 THEN 0 WHEN u < 0.5 THEN 1 WHEN u < 0.8 THEN 2 ELSE 3 END AS INT) AS code FROM f), s AS ({_series('code', 0.02)})
    SELECT code, t, count(*) AS pixels, round(avg(v), 4) AS mean FROM s GROUP BY 1, 2"""


@query_n(DEMO)
def demo_landscape(spark: SparkSession, d: str) -> DataFrame:
    """The quick start's scene: pixels of each class and the mean of each date."""
    s = synthetic.demo_scene(spark).select("code", F.posexplode("ndvi").alias("t", "v"))
    return s.groupBy("code", F.col("t").cast("long").alias("t")).agg(F.count("*").alias("pixels"), r4n(F.avg("v")).alias("mean"))
