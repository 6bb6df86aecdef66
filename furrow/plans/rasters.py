"""Queries on focal windows, parcels, polygons, models, sources and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow import session
from furrow.functions import series as S
from furrow.operators import classify, estimate, parcels, polygons, raster, sinks
from furrow.plans import fixtures as X
from furrow.plans import pipeline
from furrow.plans.fixtures import query, query_n, r4n
from furrow.sources import synthetic, tables, tiff
from furrow.streaming import ingest

G = f"WITH g AS ({X.GRID_SQL}), size AS (SELECT max(r) + 1 AS h, max(c) + 1 AS w FROM g)"


def _near(side: int, value: str, mode: str = "reflect") -> str:
    """Sum and square sum over a square, borders reflected, by a join on neighbour offsets."""
    h = side // 2
    fold = lambda x, n: f"CASE WHEN {x} < 0 THEN -1 - ({x}) WHEN {x} >= {n} THEN 2 * {n} - 1 - ({x}) ELSE {x} END"
    return f"""near AS (SELECT g.r, g.c, sum(n.{value}) / {side * side} AS m, sum(n.{value} * n.{value}) / {side * side} AS q FROM g CROSS JOIN size CROSS JOIN range(-{h}, {h + 1}) dr(dr) CROSS JOIN range(-{h}, {h + 1}) dc(dc)
        JOIN g n ON n.r = {fold('g.r + dr', 'h')} AND n.c = {fold('g.c + dc', 'w')} GROUP BY 1, 2)"""


@query(G + ", n AS (SELECT a.r, a.c FROM g a JOIN g b ON abs(a.r - b.r) + abs(a.c - b.c) = 1 AND b.r BETWEEN a.r - 1 AND a.r + 1 WHERE a.code > 0 AND b.code > 0 AND a.code <> b.code GROUP BY 1, 2) SELECT g.r, g.c, n.r IS NOT NULL AS edge FROM g LEFT JOIN n ON n.r = g.r AND n.c = g.c".replace("FROM g a JOIN g b", "FROM k a JOIN k b").replace(", n AS", ", k AS (SELECT r, c, 1 + (r // 3 + c // 4) % 3 AS code FROM g), n AS"))
def gradient_edges(spark: SparkSession, d: str) -> DataFrame:
    k = X.grid(spark, d).select("r", "c", (1 + (F.expr("r DIV 3") + F.expr("c DIV 4")) % 3).cast("int").alias("code"))
    return raster.gradient_edges(k).select("r", "c", "edge")


@query(G + ", n AS (SELECT DISTINCT a.r, a.c FROM g a JOIN (SELECT r + 1 AS r, c, code FROM g UNION ALL SELECT r - 1, c, code FROM g UNION ALL SELECT r, c + 1, code FROM g UNION ALL SELECT r, c - 1, code FROM g) b ON a.r = b.r AND a.c = b.c AND a.code <> b.code) SELECT g.r, g.c, n.r IS NOT NULL AS outline FROM g LEFT JOIN n ON n.r = g.r AND n.c = g.c")
def class_outline(spark: SparkSession, d: str) -> DataFrame:
    return raster.outline(X.grid(spark, d), "code").select("r", "c", "outline")


SPURS = "(code > 0 OR (r % 12 = 0 AND c % 15 = 7))"


def _opening_sql(offsets: str) -> str:
    return G + f""", o AS (SELECT r, c, {SPURS} AS f FROM g), d AS ({offsets}), n AS (SELECT count(*) AS n FROM d),
        e AS (SELECT o.r, o.c FROM o CROSS JOIN d JOIN o x ON x.r = o.r + d.dr AND x.c = o.c + d.dc AND x.f GROUP BY 1, 2 HAVING count(*) = (SELECT n FROM n)), z AS (SELECT DISTINCT e.r + d.dr AS r, e.c + d.dc AS c FROM e CROSS JOIN d)
        SELECT o.r, o.c, z.r IS NOT NULL AS opened FROM o LEFT JOIN z ON z.r = o.r AND z.c = o.c"""


@query(_opening_sql("SELECT a.range AS dr, b.range AS dc FROM range(-1, 2) a CROSS JOIN range(-1, 2) b"))
def binary_opening(spark: SparkSession, d: str) -> DataFrame:
    return raster.opening(X.grid(spark, d).withColumn("f", F.expr(SPURS)), "f", 3).select("r", "c", "opened")


@query(_opening_sql("SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (0, -1), (-1, 0)) AS v(dr, dc)"))
def cross_opening(spark: SparkSession, d: str) -> DataFrame:
    return raster.opening(X.grid(spark, d).withColumn("f", F.expr(SPURS)), "f", 3, cross=True).select("r", "c", "opened")


@query_n(G + ", " + _near(5, "conf") + " SELECT r, c, round(m, 4) AS mean FROM near")
def box_filter(spark: SparkSession, d: str) -> DataFrame:
    return raster.uniform_filter(X.grid(spark, d), "conf", 5).select("r", "c", r4n(F.col("box_mean")).alias("mean"))


@query_n(G + ", " + _near(5, "conf") + " SELECT r, c, round(conf - m, 4) AS contrast, round(sqrt(greatest(q - m * m, 0)), 4) AS local_std FROM near JOIN g USING (r, c)")
def local_contrast(spark: SparkSession, d: str) -> DataFrame:
    return raster.local_contrast(X.grid(spark, d), "conf").select("r", "c", r4n(F.col("contrast")).alias("contrast"), r4n(F.col("local_std")).alias("local_std"))


@query_n(G + ", " + _near(11, "value") + " SELECT r, c, round(sqrt(greatest(q - m * m, 0)) / greatest(m, 1), 4) AS texture FROM near")
def focal_texture(spark: SparkSession, d: str) -> DataFrame:
    return raster.texture(X.grid(spark, d), "value", 11).select("r", "c", r4n(F.col("texture")).alias("texture"))


def _mirror(x: str, n: str) -> str:
    return f"CASE WHEN {x} < 0 THEN -({x}) WHEN {x} >= {n} THEN 2 * {n} - 2 - ({x}) ELSE {x} END"


SOBEL = f"""x AS (SELECT g.r, g.c, sum(n.conf * d.kx) AS gx, sum(n.conf * d.ky) AS gy FROM g CROSS JOIN size CROSS JOIN (VALUES (-1, -1, -1, -1), (-1, 0, 0, -2), (-1, 1, 1, -1), (0, -1, -2, 0), (0, 1, 2, 0), (1, -1, -1, 1), (1, 0, 0, 2), (1, 1, 1, 1)) AS d(dr, dc, kx, ky)
    JOIN g n ON n.r = {_mirror('g.r + dr', 'h')} AND n.c = {_mirror('g.c + dc', 'w')} GROUP BY 1, 2)"""


@query_n(G + ", " + SOBEL + " SELECT r, c, round(sqrt(gx * gx + gy * gy), 4) AS magnitude, sqrt(gx * gx + gy * gy) > 0.22 AND conf < 0.55 AND code > 0 AS edge FROM x JOIN g USING (r, c)")
def sobel_edges(spark: SparkSession, d: str) -> DataFrame:
    g = X.grid(spark, d).withColumn("crop", F.col("code") > 0)
    return raster.spectral_edges(g, "conf", "crop").select("r", "c", r4n(F.col("magnitude")).alias("magnitude"), "edge")


SLOPE = """e AS (SELECT r, c, value * 10 AS z FROM g), s AS (SELECT *, lag(z) OVER (PARTITION BY c ORDER BY r) AS u, lead(z) OVER (PARTITION BY c ORDER BY r) AS d, lag(z) OVER (PARTITION BY r ORDER BY c) AS a, lead(z) OVER (PARTITION BY r ORDER BY c) AS b FROM e),
    k AS (SELECT r, c, z, CASE WHEN u IS NULL THEN d - z WHEN d IS NULL THEN z - u ELSE (d - u) / 2 END / 30 AS gy, CASE WHEN a IS NULL THEN b - z WHEN b IS NULL THEN z - a ELSE (b - a) / 2 END / 30 AS gx FROM s)"""


@query_n(G + ", " + SLOPE + " SELECT r, c, round(degrees(atan(sqrt(gx * gx + gy * gy))), 4) AS slope, z > 1800 OR degrees(atan(sqrt(gx * gx + gy * gy))) > 25 AS veto FROM k")
def slope_veto(spark: SparkSession, d: str) -> DataFrame:
    g = X.grid(spark, d).withColumn("elev", F.col("value") * 10)
    return raster.terrain_veto(g).select("r", "c", r4n(F.col("slope")).alias("slope"), "veto")


@query_n(G + " SELECT r // 7 AS r, c // 7 AS c, round(avg(value), 4) AS value FROM g GROUP BY 1, 2")
def preview_downsample(spark: SparkSession, d: str) -> DataFrame:
    return raster.preview(X.grid(spark, d), "value", 7).select("r", "c", r4n(F.col("value")).alias("value"))


@query(G + " SELECT r, c, CAST(code AS INT) AS code FROM g WHERE r % 3 = 0 AND c % 3 = 0")
def stepped_downsample(spark: SparkSession, d: str) -> DataFrame:
    return raster.downsample(X.grid(spark, d), raster.step_for(3600, 100)).select("r", "c", "code")


@query_n(G + " SELECT r, c, round(greatest(0, least(1, (value - lo) / (hi - lo))), 4) AS stretched FROM g CROSS JOIN (SELECT quantile_cont(value, 0.02) AS lo, quantile_cont(value, 0.98) AS hi FROM g)")
def percentile_stretch(spark: SparkSession, d: str) -> DataFrame:
    return raster.percentile_stretch(X.grid(spark, d), "value").select("r", "c", r4n(F.col("stretched")).alias("stretched"))


def _half(g: DataFrame) -> DataFrame:
    """Pixels of the whole grid at half the resolution; the extent is one row."""
    return g.crossJoin(F.broadcast(raster.extent(g))).where("2 * r < _h AND 2 * c < _w").select("r", "c")


@query(G + " SELECT t.r, t.c, s.value FROM (SELECT r, c FROM g CROSS JOIN size WHERE 2 * r < h AND 2 * c < w) t JOIN g s ON s.r = CAST(floor((t.r + 0.5) * 2) AS BIGINT) AND s.c = CAST(floor((t.c + 0.5) * 2) AS BIGINT)")
def resample_nearest(spark: SparkSession, d: str) -> DataFrame:
    g = X.grid(spark, d)
    return raster.resample_nearest(_half(g), g.select("r", "c", "value"), 2.0, 2.0, ["value"]).select("r", "c", "value")


@query_n(G + " SELECT t.r, t.c, round(avg(s.value), 4) AS value FROM (SELECT r, c FROM g CROSS JOIN size WHERE 2 * r < h AND 2 * c < w) t JOIN g s ON s.r IN (2 * t.r, 2 * t.r + 1) AND s.c IN (2 * t.c, 2 * t.c + 1) GROUP BY 1, 2")
def resample_bilinear(spark: SparkSession, d: str) -> DataFrame:
    """At half the resolution the centre lies amid four pixels."""
    g = X.grid(spark, d)
    return raster.resample_bilinear(_half(g), g.select("r", "c", "value"), 2.0, 2.0, "value").select("r", "c", r4n(F.col("value")).alias("value"))


@query_n(f"WITH g0 AS ({X.GRID_SQL}), l AS (SELECT r, c, t, CASE WHEN t = 1 THEN conf ELSE conf / 2 END AS v FROM g0 CROSS JOIN range(3) t(t)), g AS (SELECT r, c, v FROM l WHERE t = 1), size AS (SELECT max(r) + 1 AS h, max(c) + 1 AS w FROM g), " + _near(5, "v") + " SELECT r, c, round(v - m, 4) AS contrast, round(sqrt(greatest(q - m * m, 0)), 4) AS local_std FROM near JOIN g USING (r, c)")
def peak_contrast(spark: SparkSession, d: str) -> DataFrame:
    g = X.grid(spark, d).withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(2)))).withColumn("v", F.when(F.col("t") == 1, F.col("conf")).otherwise(F.col("conf") / 2))
    return raster.peak_contrast(g.select("r", "c", "t", "v")).select("r", "c", r4n(F.col("contrast")).alias("contrast"), r4n(F.col("local_std")).alias("local_std"))


# ---- parcels: ridges make components equal blocks

BLOCK = "GROUP BY r // 12, c // 15"


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    g = X.grid(spark, d)
    return parcels.label(g.where("code > 0").select("r", "c")).join(g, ["r", "c"])


@query(G + f" SELECT min(r) AS r0, min(c) AS c0, count(*) AS pixels FROM g WHERE code > 0 {BLOCK}")
def connected_parcels(spark: SparkSession, d: str) -> DataFrame:
    return parcels.bounding_boxes(parcels.label(X.grid(spark, d).where("code > 0").select("r", "c"))).select("r0", "c0", "pixels")


@query(G + f" SELECT min(r) AS r0, max(r) AS r1, min(c) AS c0, max(c) AS c1, count(*) AS pixels FROM g WHERE code > 0 {BLOCK}")
def parcel_bbox(spark: SparkSession, d: str) -> DataFrame:
    return parcels.bounding_boxes(parcels.label(X.grid(spark, d).where("code > 0").select("r", "c"), 4)).select("r0", "r1", "c0", "c1", "pixels")


@query(G + " SELECT r, c, code > 0 AS filled FROM g")
def hole_fill(spark: SparkSession, d: str) -> DataFrame:
    """One pixel punched out of each block comes back; ridges and open blocks do not fill."""
    g = X.grid(spark, d).withColumn("on", (F.col("code") > 0) & ~((F.col("r") % 12 == 6) & (F.col("c") % 15 == 7)))
    return parcels.fill_holes(g, "on").select("r", "c", "filled")


@query(G + f", p AS (SELECT min(r) AS r0, min(c) AS c0, count(*) AS pixels FROM g WHERE code > 0 {BLOCK}) SELECT r0, c0, pixels, CAST(row_number() OVER (ORDER BY pixels DESC, r0, c0) AS INT) AS parcel_no FROM p WHERE pixels * 100 >= 5000 ORDER BY parcel_no LIMIT 40")
def parcel_filter_rank(spark: SparkSession, d: str) -> DataFrame:
    sizes = parcels.bounding_boxes(_labelled(spark, d))
    return parcels.filter_rank(sizes, 10.0, 5000.0, None, 40).select("r0", "c0", "pixels", "parcel_no")


ZONAL = f"""SELECT min(r) AS r0, min(c) AS c0, count(*) AS pixels, round(count(*) * CAST(100 AS DOUBLE), 1) AS area_m2, round(count(*) * CAST(100 AS DOUBLE) * CAST(0.0015 AS DOUBLE), 2) AS area_mu, round(CAST(count(*) AS DOUBLE) / 100, 4) AS area_ha, CAST(any_value(code) AS INT) AS crop_code, CAST(1 AS DOUBLE) AS purity,
    round(sum(conf) / count(*), 3) AS confidence, round(CAST(sum(r) AS DOUBLE) / count(*), 2) AS centroid_row, round(CAST(sum(c) AS DOUBLE) / count(*), 2) AS centroid_col FROM g WHERE code > 0 {BLOCK}"""


@query(G + " " + ZONAL)
def zonal_stats(spark: SparkSession, d: str) -> DataFrame:
    z = parcels.zonal_stats(_labelled(spark, d))
    return z.withColumn("r0", F.expr(f"comp DIV {parcels.ROW}")).withColumn("c0", F.col("comp") % parcels.ROW).drop("comp")


@query(G + ", z AS (SELECT r // 20 AS zone, code, count(*) AS n FROM g GROUP BY 1, 2), t AS (SELECT zone, sum(n) AS pixels, sum(CASE WHEN code > 0 THEN n END) AS crop_n, max(CASE WHEN code > 0 THEN n END) AS top FROM z GROUP BY 1) SELECT t.zone, CAST(t.pixels AS BIGINT) AS pixels, CAST(min(z.code) AS INT) AS crop_code, round(CAST(top AS DOUBLE) / crop_n, 3) AS purity FROM t JOIN z ON z.zone = t.zone AND z.n = t.top AND z.code > 0 GROUP BY t.zone, t.pixels, top, crop_n")
def zonal_majority(spark: SparkSession, d: str) -> DataFrame:
    """Zones that mix classes; ties go to the smaller code."""
    z = X.grid(spark, d).withColumn("zone", F.expr("r DIV 20"))
    return parcels.zonal_stats(z, key="zone").select("zone", "pixels", "crop_code", "purity")


@query(G + ", s AS (SELECT r, c, code > 0 AS crop, (r // 5) * 1000 + c // 5 AS segment FROM g) SELECT r, c, avg(CAST(crop AS INT)) OVER (PARTITION BY segment) > 0.75 AS kept FROM s")
def superpixel_majority(spark: SparkSession, d: str) -> DataFrame:
    s = X.grid(spark, d).select("r", "c", (F.col("code") > 0).alias("crop"), (F.expr("r DIV 5") * 1000 + F.expr("c DIV 5")).alias("segment"))
    return parcels.superpixel_majority(s).select("r", "c", "kept")


@query(G + """, k AS (SELECT r // 10 AS i, c // 10 AS j, avg(r) AS y, avg(c) AS x, avg(value) AS m FROM g GROUP BY 1, 2),
    d AS (SELECT g.r, g.c, k.i, k.j, ((g.r - k.y) * (g.r - k.y) + (g.c - k.x) * (g.c - k.x)) * 0.25 + (g.value - k.m) * (g.value - k.m) AS d FROM g JOIN k ON k.i BETWEEN g.r // 10 - 1 AND g.r // 10 + 1 AND k.j BETWEEN g.c // 10 - 1 AND g.c // 10 + 1),
    n AS (SELECT i, j FROM d QUALIFY row_number() OVER (PARTITION BY r, c ORDER BY d, i, j) = 1) SELECT i * 2147483648 + j AS segment, count(*) AS pixels FROM n GROUP BY 1""")
def superpixels(spark: SparkSession, d: str) -> DataFrame:
    return parcels.superpixels(X.grid(spark, d).select("r", "c", "value"), "value").groupBy("segment").agg(F.count("*").alias("pixels"))


@query()
def subdivide(spark: SparkSession, d: str) -> DataFrame:
    """Touching discs are one component over the limit and come apart."""
    n = 400
    base = spark.range(n * n).select(F.expr(f"id DIV {n}").alias("r"), (F.col("id") % n).alias("c"))
    y, x = F.col("r") % 100 - 50, F.col("c") % 50 - 25
    disc = base.where((y * y + x * x <= 26 * 26) & (F.col("r") % 100 > 10))
    return parcels.subdivide(parcels.label(disc), 250_000.0).groupBy("comp", "part").agg(F.count("*").alias("pixels"))


RINGS = G + f", b AS (SELECT min(r) AS r0, max(r) + 1 AS r1, min(c) AS c0, max(c) + 1 AS c1 FROM g WHERE code > 0 {BLOCK})"


def _rings(spark: SparkSession, d: str) -> DataFrame:
    return polygons.rings(_labelled(spark, d).select("comp", "r", "c"), "comp")


@query(RINGS + " SELECT r0 * 2147483648 + c0 AS comp, CAST(2 * (r1 - r0) + 2 * (c1 - c0) + 1 AS BIGINT) AS traced, '(' || r0 || ',' || c0 || ')(' || r0 || ',' || c1 || ')(' || r1 || ',' || c1 || ')(' || r1 || ',' || c0 || ')(' || r0 || ',' || c0 || ')' AS ring FROM b")
def ring_trace(spark: SparkSession, d: str) -> DataFrame:
    """Blocks are rectangles: their simplified outline is their four corners."""
    text = F.array_join(F.transform("ring", lambda p: F.format_string("(%d,%d)", p["r"].cast("long"), p["c"].cast("long"))), "")
    return _rings(spark, d).select("comp", "traced", text.alias("ring"))


@query(RINGS + " SELECT r0 * 2147483648 + c0 AS comp, 9 AS points, round(CAST(2 * ((r1 - r0) + (c1 - c0)) * 5 AS DOUBLE) + 10 * sqrt(CAST((r1 - r0) * (r1 - r0) + (c1 - c0) * (c1 - c0) AS DOUBLE)), 1) AS perimeter, round(CAST((r1 - r0) * (c1 - c0) AS DOUBLE) * 7 / 8, 4) AS area FROM b")
def chaikin_ring(spark: SparkSession, d: str) -> DataFrame:
    s = _rings(spark, d).withColumn("s", polygons.chaikin(F.col("ring")))
    return s.select("comp", F.size("s").alias("points"), F.round(polygons.perimeter(F.col("s"), 10.0), 1).alias("perimeter"), F.round(F.abs(polygons.signed_area(F.col("s"))), 4).alias("area"))


@query(RINGS + " SELECT r0 * 2147483648 + c0 AS comp, CAST(20 * ((r1 - r0) + (c1 - c0)) AS DOUBLE) AS perimeter, CAST((r1 - r0) * (c1 - c0) AS DOUBLE) AS area, true AS counter_clockwise FROM b")
def perimeter_area(spark: SparkSession, d: str) -> DataFrame:
    r = _rings(spark, d)
    turned = polygons.counter_clockwise(polygons.to_map(F.col("ring"), 500000.0, 4200000.0, 10.0))
    return r.select("comp", polygons.perimeter(F.col("ring"), 10.0).alias("perimeter"), F.abs(polygons.signed_area(F.col("ring"))).alias("area"), (polygons.signed_area(turned, "x", "y") > 0).alias("counter_clockwise"))


def _segmented(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return parcels.segment(X.grid(spark, d), 10.0, 200.0, 500_000.0, None)


@query(G + f", p AS ({ZONAL}), n AS (SELECT *, CAST(row_number() OVER (ORDER BY pixels DESC, r0, c0) AS INT) AS parcel_no FROM p) SELECT 'P' || lpad(CAST(parcel_no AS VARCHAR), 4, '0') AS parcel_id, pixels, area_mu, crop_code, confidence, centroid_row, centroid_col FROM n WHERE least(pixels, 999) >= 2".replace("least(pixels, 999) >= 2", "pixels >= 2"))
def parcel_table(spark: SparkSession, d: str) -> DataFrame:
    """The whole chain from classes to parcels; opening leaves blocks as they are."""
    _, stats = _segmented(spark, d)
    return stats.select("parcel_id", "pixels", "area_mu", "crop_code", "confidence", "centroid_row", "centroid_col")


def _features(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    pixels, stats = _segmented(spark, d)
    pixels = session.written(pixels, "feature-pixels")
    named = polygons.attributes(session.written(stats, "feature-stats"), polygons.rings(pixels), estimate.legend_table(spark, X.LEGEND))
    return named, polygons.features(named)


@query()
def parcel_features(spark: SparkSession, d: str) -> DataFrame:
    return _features(spark, d)[0].drop("outline")


@query()
def geojson_lines(spark: SparkSession, d: str) -> DataFrame:
    return sinks.feature_lines(_features(spark, d)[1])


# ---- models


def _points(spark: SparkSession) -> tuple[DataFrame, list[str]]:
    p = synthetic.training_points(spark, X.LEGEND, 60)
    s = p.withColumn("ndvi", F.array(*(F.col(c) for c in tables.day_columns(p))))
    return pipeline.featured(s, "ndvi", len(synthetic.DAYS))


@query()
def rf_classify(spark: SparkSession, d: str) -> DataFrame:
    x, columns = _points(spark)
    scorer = classify.fit(x, columns, "random_forest", 20, 8)
    scene, _ = pipeline.featured(synthetic.scene(spark, 60, 60, 3).withColumnRenamed("code", "true_code"), "ndvi", len(synthetic.DAYS))
    return estimate.agreement(classify.score(scene, scorer, "ndvi", len(synthetic.DAYS)), "code", "true_code")


@query()
def gbt_ovr_classify(spark: SparkSession, d: str) -> DataFrame:
    x, columns = _points(spark)
    scorer = classify.fit(x, columns[:8], "gradient_boosting", 5, 3)
    code, prob = classify.decide(F.col("probs"), scorer.labels)
    return scorer.probabilities(x).select("point_id", "label", code.alias("code"), prob.alias("crop_prob"))


@query()
def cross_validation(spark: SparkSession, d: str) -> DataFrame:
    x, columns = _points(spark)
    return classify.cross_validate(x.where("label < 2"), columns[:8], "point_id", trees=5, depth=4, k=3).select("point_id", "label", F.get("probs", F.lit(0)).alias("p_bg"))


@query("SELECT label, count(*) AS n FROM (SELECT unnest(range(4)) AS label), range(60) GROUP BY label".replace("label, count(*) AS n FROM", "CAST(label AS INT) AS label, count(*) AS n FROM"))
def training_points(spark: SparkSession, d: str) -> DataFrame:
    return synthetic.training_points(spark, X.LEGEND, 60).groupBy("label").agg(F.count("*").alias("n"))


@query()
def demo_scene(spark: SparkSession, d: str) -> DataFrame:
    """The quick start: a small forest on the demo scene, its accuracy, and the calibrated areas of its map."""
    scene = synthetic.demo_scene(spark).withColumnRenamed("code", "true_code")
    v = F.col("ndvi")
    x = scene.withColumns({f"t{i}": F.get(v, F.lit(i)) for i in range(8)} | {"f_max": F.array_max(v), "f_std": S.std(v), "f_up": (F.get(v, F.lit(3)) - F.get(v, F.lit(1))) / 60, "f_down": (F.get(v, F.lit(6)) - F.get(v, F.lit(4))) / 60})
    columns = [*(f"t{i}" for i in range(8)), "f_max", "f_std", "f_up", "f_down"]
    drawn = x.withColumnRenamed("true_code", "label").orderBy(F.xxhash64("r", "c")).limit(200)
    scorer = classify.fit(drawn, columns, "random_forest", 50, 8)
    code, _ = classify.decide(F.col("probs"), scorer.labels)
    return estimate.agreement(scorer.probabilities(x).withColumn("code", code), "code", "true_code")


@query(f"""WITH pix AS ({X.GRID_SQL}), w AS (SELECT c.code, count(p.code) AS pixels, CAST(count(p.code) AS DOUBLE) / (SELECT count(*) FROM pix) AS weight FROM (VALUES (0), (1), (2), (3), (4)) AS c(code) LEFT JOIN pix p ON p.code = c.code GROUP BY 1),
    n AS (SELECT code, CASE WHEN pixels > 0 THEN 10 ELSE 5 END AS n FROM w), f AS (SELECT (SELECT min(code) FROM w WHERE code <> 0 AND pixels > 0) AS crop, (SELECT weight FROM w WHERE code = 0) AS w0)
    SELECT printf('VAL_%d_%02d', code, k.range) AS sample_id, CAST(code AS INT) AS map_label, CAST(CASE WHEN k.range < floor(n * 0.9) THEN code WHEN code <> 0 THEN 0 WHEN w0 < 0.70 AND (SELECT weight FROM w WHERE w.code = crop) >= 0.10 THEN crop ELSE 0 END AS INT) AS true_label, CAST(1 AS DOUBLE) AS weight FROM n CROSS JOIN f JOIN range(10) k ON k.range < n""")
def validation_sample(spark: SparkSession, d: str) -> DataFrame:
    return synthetic.validation_sample(X.grid(spark, d), [0, 1, 2, 3, 4])


# ---- sources, sinks, streams


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    to = session.place(spark, "csv")
    sinks.write_csv(X.table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal"), to)
    return tables.read_csv(spark, to, "c_custkey long, c_name string, c_acctbal double")


@query(G + ", t AS (SELECT l.k AS level, (r // l.k) // 64 AS tile_r, (c // l.k) // 64 AS tile_c, count(*) AS n, max(r // l.k) - min(r // l.k) + 1 AS height, max(c // l.k) - min(c // l.k) + 1 AS width FROM g CROSS JOIN (VALUES (1), (2), (4), (8), (16)) AS l(k) WHERE r % l.k = 0 AND c % l.k = 0 GROUP BY 1, 2, 3) SELECT CAST(level AS INT) AS level, tile_r, tile_c, height, width FROM t")
def class_tiles(spark: SparkSession, d: str) -> DataFrame:
    return tiff.class_tiles(X.grid(spark, d), 64).select("level", "tile_r", "tile_c", "height", "width")


@query("SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2")
def stream_windows(spark: SparkSession, d: str) -> DataFrame:
    """Events as a stream, counted by day and type."""
    schema = X.table(spark, d, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{d}/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp"))
    name = f"windows_{uuid.uuid4().hex}"
    out = ingest.drain(ingest.windowed(stream), name)
    return out.select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "event_type", "n", F.round("total", 2).alias("total"))


@query("SELECT event_id // 100 % 7 AS r, event_id % 100 AS c, count(*) AS dates, round(avg(value), 4) AS mean, max(value) AS most, min(value) AS least FROM events GROUP BY 1, 2".replace("round(avg(value), 4)", "round(avg(value) + 1e-9, 4)"))
def stream_pixels(spark: SparkSession, d: str) -> DataFrame:
    """Pixels that arrive date by date, with running figures."""
    schema = X.table(spark, d, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{d}/events.parquet*").select((F.expr("event_id DIV 100") % 7).alias("r"), (F.col("event_id") % 100).alias("c"), F.dayofyear("ts").alias("doy"), "value")
    out = ingest.drain(ingest.running_pixels(stream), f"pixels_{uuid.uuid4().hex}")
    return out.select("r", "c", "dates", r4n(F.col("mean")).alias("mean"), "most", "least")
