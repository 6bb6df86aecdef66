"""Queries on coordinates, zones, units, grades and reports over the parcel table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.functions import geo, grading, units, zoning
from furrow.operators import estimate, rollup
from furrow.plans import fixtures as X
from furrow.plans import report, statistics
from furrow.plans.fixtures import query, query_n, r4n

E2, EP2 = geo.E2, geo.EP2
ZONE = "(floor((lon + 180.0) / 6.0) + 1)"
#: The forward series in SQL, step by step.
FORWARD = f"""a AS (SELECT c_custkey, lon, lat, {ZONE} AS zone, radians(lat) AS phi, sin(radians(lat)) AS s, cos(radians(lat)) AS c, tan(radians(lat)) AS t, radians(6.0 * ({ZONE} - 1) - 180.0 + 3.0) AS l0 FROM pts),
    b AS (SELECT *, {geo.SEMI_MAJOR!r} / sqrt(1 - {E2!r} * s * s) AS n, t * t AS tt, {EP2!r} * c * c AS cc, (radians(lon) - l0) * c AS a,
        {geo.SEMI_MAJOR!r} * ({1 - E2 / 4 - 3 * E2**2 / 64 - 5 * E2**3 / 256!r} * phi - {3 * E2 / 8 + 3 * E2**2 / 32 + 45 * E2**3 / 1024!r} * sin(2 * phi) + {15 * E2**2 / 256 + 45 * E2**3 / 1024!r} * sin(4 * phi) - {35 * E2**3 / 3072!r} * sin(6 * phi)) AS m FROM a),
    f AS (SELECT c_custkey, lon, lat, zone, {geo.SCALE} * n * (a + (1 - tt + cc) * a ** 3 / 6 + (5 - 18 * tt + tt * tt + 72 * cc - {58 * EP2!r}) * a ** 5 / 120) + 500000 AS east,
        {geo.SCALE} * (m + n * t * (a ** 2 / 2 + (5 - tt + 9 * cc + 4 * cc * cc) * a ** 4 / 24 + (61 - 58 * tt + tt * tt + 600 * cc - {330 * EP2!r}) * a ** 6 / 720)) AS north FROM b)"""


def _utm(spark: SparkSession, d: str) -> DataFrame:
    p = X.points(spark, d).withColumn("zone", geo.utm_zone(F.col("lon")))
    return p.withColumn("u", geo.wgs84_to_utm(F.col("lon"), F.col("lat"), F.col("zone")))


@query(f"WITH pts AS ({X.POINT_SQL}), {FORWARD} SELECT c_custkey, CAST(zone AS INT) AS zone, round(east, 2) AS east, round(north, 2) AS north FROM f")
def utm_forward(spark: SparkSession, d: str) -> DataFrame:
    return _utm(spark, d).select("c_custkey", "zone", "u.east", "u.north")


@query(f"WITH pts AS ({X.POINT_SQL}) SELECT c_custkey, round(lon, 5) AS lon, round(lat, 5) AS lat, true AS close FROM pts")
def utm_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """To UTM and back returns the same place to well under a metre."""
    back = _utm(spark, d).withColumn("g", geo.utm_to_wgs84(F.col("u.east"), F.col("u.north"), F.col("zone"), F.lit(True)))
    close = (F.abs(F.col("g.lon") - F.col("lon")) < 2e-6) & (F.abs(F.col("g.lat") - F.col("lat")) < 2e-6)
    return back.select("c_custkey", F.round("lon", 5).alias("lon"), F.round("lat", 5).alias("lat"), close.alias("close"))


@query(f"SELECT CAST({ZONE} AS INT) AS zone, count(*) AS points FROM ({X.POINT_SQL}) GROUP BY 1")
def utm_zone(spark: SparkSession, d: str) -> DataFrame:
    return X.points(spark, d).groupBy(geo.utm_zone(F.col("lon")).alias("zone")).agg(F.count("*").alias("points"))


def zone_sql() -> str:
    """The rules as one CASE for the province and one for the zone."""
    edge = lambda v, low, high: f"{v} {'>' if low[-1] == 'o' else '>='} {low.rstrip('o')} AND {v} {'<' if high[-1] == 'o' else '<='} {high.rstrip('o')}"
    holds = [f"{edge('lon', w, e)} AND {edge('lat', s, n)}" for w, e, s, n, *_ in zoning.RULES]
    name = lambda names, cut: f"'{names[0]}'" if cut is None else f"CASE WHEN {cut[0]} < {cut[1]} THEN '{names[0]}' ELSE '{names[1]}' END"
    tail = "WHEN NOT (lon BETWEEN 73 AND 135 AND lat BETWEEN 18 AND 54) THEN '{}' ELSE '{}' END"
    province = "CASE " + " ".join(f"WHEN {h} THEN '{r[4]}'" for h, r in zip(holds, zoning.RULES, strict=True)) + " " + tail.format(zoning.ABROAD[0], zoning.HOME[0])
    zone = "CASE " + " ".join(f"WHEN {h} THEN {name(r[5], r[6])}" for h, r in zip(holds, zoning.RULES, strict=True)) + " " + tail.format(zoning.ABROAD[1], zoning.HOME[1])
    return f"{province} AS province, {zone} AS zone"


@query(f"SELECT c_custkey, {zone_sql()} FROM ({X.POINT_SQL})")
def zone_lookup(spark: SparkSession, d: str) -> DataFrame:
    return X.points(spark, d).withColumn("z", zoning.zone(F.col("lon"), F.col("lat"))).select("c_custkey", "z.province", "z.zone")


@query(f"SELECT c_custkey, {zone_sql()} FROM ({X.POINT_SQL})")
def zone_range_join(spark: SparkSession, d: str) -> DataFrame:
    return zoning.zone_join(X.points(spark, d)).select("c_custkey", "province", "zone")


SUIT = "CASE WHEN area_mu >= 3000 THEN '{0}' WHEN area_mu >= 1000 THEN '{1}' WHEN area_mu >= 200 AND compactness >= 0.10 THEN '{2}' WHEN area_mu >= 200 THEN '{3}' WHEN compactness >= 0.35 AND area_mu >= 30 THEN '{4}' WHEN compactness >= 0.20 AND area_mu >= 5 THEN '{5}' ELSE '{6}' END".format(*zoning.SUITABILITY)
TIER = "CASE WHEN area_mu >= 3000 THEN '{}' WHEN area_mu >= 1000 THEN '{}' WHEN area_mu >= 300 THEN '{}' WHEN area_mu >= 50 THEN '{}' ELSE '{}' END".format(*zoning.TIERS)


@query(f"SELECT s AS suitability, CASE WHEN s LIKE '%优%' THEN 'badge-opt' WHEN s LIKE '%良%' THEN 'badge-good' ELSE 'badge-warn' END AS badge, count(*) AS parcels FROM (SELECT {SUIT} AS s FROM ({X.POINT_SQL})) GROUP BY 1, 2")
def machinery_suitability(spark: SparkSession, d: str) -> DataFrame:
    s = X.points(spark, d).select(zoning.suitability(F.col("area_mu"), F.col("compactness")).alias("suitability"))
    return s.groupBy("suitability", grading.suitability_badge(F.col("suitability")).alias("badge")).agg(F.count("*").alias("parcels"))


@query(f"SELECT {TIER} AS tier, count(*) AS parcels FROM ({X.POINT_SQL}) GROUP BY 1")
def scale_tier(spark: SparkSession, d: str) -> DataFrame:
    return X.points(spark, d).groupBy(zoning.tier(F.col("area_mu")).alias("tier")).agg(F.count("*").alias("parcels"))


@query_n(f"SELECT c_custkey, round(area_mu * CAST(1 AS DOUBLE) / CAST(0.0015 AS DOUBLE) / 10000, 4) AS ha, round(area_mu / 15, 4) AS ha_direct, round(area_mu / 15 * 15, 4) AS mu, round(area_mu / 15 * 10000, 4) AS sqm, round(area_mu / 15 * 10000 * CAST(0.0015 AS DOUBLE), 4) AS mu_again FROM ({X.POINT_SQL})")
def area_units(spark: SparkSession, d: str) -> DataFrame:
    mu = F.col("area_mu")
    ha = units.mu_to_ha(mu)
    values = {"ha": units.sqm_to_ha(units.mu_to_sqm(mu)), "ha_direct": ha, "mu": units.ha_to_mu(ha), "sqm": units.ha_to_sqm(ha), "mu_again": units.sqm_to_mu(units.ha_to_sqm(ha))}
    return X.points(spark, d).select("c_custkey", *(r4n(v).alias(k) for k, v in values.items()))


@query(f"SELECT c_custkey, round(a, 2) AS area_m2, round(a * CAST(0.0015 AS DOUBLE), 2) AS area_mu, round(a / 10000, 2) AS area_ha, round(a * CAST(0.0015 AS DOUBLE) / 10000, 4) AS area_wan_mu FROM (SELECT c_custkey, area_mu * 1000 + CAST(0.001 AS DOUBLE) AS a FROM ({X.POINT_SQL}))")
def format_area(spark: SparkSession, d: str) -> DataFrame:
    return X.points(spark, d).withColumn("f", units.format_area(F.col("area_mu") * 1000 + F.lit(0.001))).select("c_custkey", "f.area_m2", "f.area_mu", "f.area_ha", "f.area_wan_mu")


@query_n(f"SELECT c_custkey, round(4 * pi() * area_mu / ((compactness * 100) * (compactness * 100)), 4) AS quotient, round(greatest(0.01, least(1, 4 * pi() * area_mu / ((compactness * 100) * (compactness * 100)))), 3) AS exported FROM ({X.POINT_SQL})")
def compactness(spark: SparkSession, d: str) -> DataFrame:
    a, p = F.col("area_mu"), F.col("compactness") * 100
    return X.points(spark, d).select("c_custkey", r4n(grading.isoperimetric(a, p)).alias("quotient"), grading.exported_compactness(a, p).alias("exported"))


NAMES = "SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'doy_' || (event_id % 366 + 1) || '.tif' WHEN 1 THEN 'GF2_' || strftime(ts, '%Y%m%d') || '_L2A.tif' WHEN 2 THEN 'Wheat_DOY-' || (event_id % 300) || '_NDVI.tif' ELSE 'scene.tif' END AS name, ts FROM events"


@query(f"SELECT event_id, CAST(CASE event_id % 4 WHEN 0 THEN event_id % 366 + 1 WHEN 1 THEN dayofyear(ts) WHEN 2 THEN event_id % 300 ELSE 150 END AS INT) AS doy FROM ({NAMES})")
def doy_parse(spark: SparkSession, d: str) -> DataFrame:
    e, k = F.col("event_id"), F.col("event_id") % 4
    name = F.when(k == 0, F.concat(F.lit("doy_"), (e % 366 + 1).cast("string"), F.lit(".tif"))).when(k == 1, F.concat(F.lit("GF2_"), F.date_format("ts", "yyyyMMdd"), F.lit("_L2A.tif"))).when(k == 2, F.concat(F.lit("Wheat_DOY-"), (e % 300).cast("string"), F.lit("_NDVI.tif"))).otherwise("scene.tif")
    return X.table(spark, d, "events").select("event_id", geo.parse_doy(name).alias("doy"))


CRS = [("EPSG:4326", True, 50, True), ("WGS84", True, 50, True), ("CGCS2000", True, 50, True), ("EPSG:32650", False, 50, True), ("EPSG:32710", False, 10, False), ("UTM Zone 33S", False, 33, False), ('PROJCS["WGS 84 / UTM zone 10N"]', False, 10, True), ("zone 7", False, 7, True), ("local", False, 50, True)]


@query("SELECT c_custkey, " + "CASE c_custkey % 9 " + " ".join(f"WHEN {i} THEN {str(c[1]).lower()}" for i, c in enumerate(CRS)) + " END AS geographic, CAST(CASE c_custkey % 9 " + " ".join(f"WHEN {i} THEN {c[2]}" for i, c in enumerate(CRS)) + " END AS INT) AS zone, CASE c_custkey % 9 " + " ".join(f"WHEN {i} THEN {str(c[3]).lower()}" for i, c in enumerate(CRS)) + " END AS northern FROM customer")
def crs_classify(spark: SparkSession, d: str) -> DataFrame:
    text = F.element_at(F.array(*(F.lit(c[0]) for c in CRS)), (F.col("c_custkey") % 9 + 1).cast("int"))
    z = geo.parse_utm_zone(F.col("crs"))
    return X.table(spark, d, "customer").select("c_custkey", text.alias("crs")).select("c_custkey", geo.is_geographic(F.col("crs")).alias("geographic"), z["zone"].alias("zone"), z["northern"].alias("northern"))


@query(f"SELECT r, c, CAST(500000 + c * 10 AS DOUBLE) AS x, CAST(4200000 - r * 10 AS DOUBLE) AS y, CAST(c AS INT) AS col, CAST(r AS INT) AS row, CAST(111320 * 0.0001 AS DOUBLE) AS step FROM ({X.GRID_SQL})")
def pixel_coordinates(spark: SparkSession, d: str) -> DataFrame:
    x, n = F.lit(500000.0), F.lit(4200000.0)
    zero = F.lit(0.0)
    g = X.grid(spark, d).withColumn("p", geo.affine(F.col("r"), F.col("c"), F.lit(10.0), zero, x, zero, F.lit(-10.0), n))
    back = geo.pixel_of(F.col("p.x") + 5, F.col("p.y") - 5, F.lit(10.0), x, F.lit(-10.0), n)
    return g.select("r", "c", "p.x", "p.y", back["col"].alias("col"), back["row"].alias("row"), F.round(geo.resolution_metres(F.lit(0.0001), F.lit(True)), 6).alias("step"))


# ---- reports over the parcel table

PARCEL_SQL = f"""SELECT 'P' || CASE WHEN c_custkey < 1000 THEN lpad(CAST(c_custkey AS VARCHAR), 4, '0') ELSE CAST(c_custkey AS VARCHAR) END AS parcel_id, CAST(c_custkey % 4 AS INT) AS crop_code, area_mu, area_mu / 15 AS area_ha,
    CAST(50 + c_custkey % 51 AS DOUBLE) / 100 AS purity, CAST(c_custkey % 100 AS DOUBLE) / 100 AS confidence, lon AS center_lon, lat AS center_lat, {SUIT} AS machinery_suitability, {zone_sql()} FROM ({X.POINT_SQL})"""


def parcels(spark: SparkSession, d: str) -> DataFrame:
    p, k = X.points(spark, d).withColumn("z", zoning.zone(F.col("lon"), F.col("lat"))), F.col("c_custkey")
    names = F.create_map(*(x for c, n in X.LEGEND.items() for x in (F.lit(c), F.lit(n))))
    return p.select(
        grading.parcel_name(k).alias("parcel_id"), (k % 4).cast("int").alias("crop_code"), names[(k % 4).cast("int")].alias("crop_name"), "area_mu", units.mu_to_ha(F.col("area_mu")).alias("area_ha"),
        ((50 + k % 51).cast("double") / 100).alias("purity"), ((k % 100).cast("double") / 100).alias("confidence"), F.col("lon").alias("center_lon"), F.col("lat").alias("center_lat"),
        zoning.suitability(F.col("area_mu"), F.col("compactness")).alias("machinery_suitability"), "z.province", "z.zone",
    )


@query(f"SELECT province, count(*) AS parcels, round(1e-6 + sum(area_mu), 2) AS area_mu, round(1e-6 + sum(area_ha), 2) AS area_ha, round(avg(purity), 3) AS mean_purity, round(avg(confidence), 3) AS mean_confidence, round(sum(area_mu) / greatest((SELECT sum(area_mu) FROM ({PARCEL_SQL})), 1e-4) * 100, 2) AS area_share_pct FROM ({PARCEL_SQL}) GROUP BY province")
def province_rollup(spark: SparkSession, d: str) -> DataFrame:
    return rollup.province_rollup(parcels(spark, d))


@query(f"WITH p AS (SELECT province, count(*) AS parcels, sum(area_mu) AS m, sum(area_ha) AS h, sum(area_mu) / (SELECT sum(area_mu) FROM ({PARCEL_SQL})) * 100 AS s FROM ({PARCEL_SQL}) GROUP BY province) SELECT province, parcels, round(1e-6 + m, 2) AS area_mu, round(1e-6 + h, 2) AS area_ha, round(s, 1) AS share_pct, round(least(100, s * 2.2), 1) AS bar_pct FROM p")
def province_report(spark: SparkSession, d: str) -> DataFrame:
    return rollup.province_rollup(parcels(spark, d), report=True)


@query(f"SELECT crop_code, count(*) AS parcels, round(1e-6 + sum(area_mu), 1) AS area_mu FROM ({PARCEL_SQL}) GROUP BY 1")
def crop_summary(spark: SparkSession, d: str) -> DataFrame:
    return rollup.crop_summary(parcels(spark, d))


@query(f"SELECT parcel_id, area_mu, province FROM ({PARCEL_SQL}) ORDER BY area_mu DESC, parcel_id LIMIT 10")
def top10_parcels(spark: SparkSession, d: str) -> DataFrame:
    return rollup.top_parcels(parcels(spark, d)).select("parcel_id", "area_mu", "province")


@query(f"SELECT count(*) AS parcels, round(1e-6 + sum(area_mu), 1) AS area_mu, round(1e-6 + sum(area_ha), 2) AS area_ha, round(CAST(count(CASE WHEN machinery_suitability LIKE '%优%' OR machinery_suitability LIKE '%良%' THEN 1 END) AS DOUBLE) / count(*) * 100, 1) AS machinery_pct, round(avg(center_lon), 5) AS center_lon, round(avg(center_lat), 5) AS center_lat, count(DISTINCT province) AS provinces, array_to_string(list_sort(list(DISTINCT province)), ',') AS province_list FROM ({PARCEL_SQL})")
def map_kpis(spark: SparkSession, d: str) -> DataFrame:
    return rollup.map_kpis(parcels(spark, d))


@query(f"SELECT parcel_id, crop_code, area_mu FROM ({PARCEL_SQL}) WHERE crop_code IN (1, 3) AND province = '河南省'")
def filtered_parcels(spark: SparkSession, d: str) -> DataFrame:
    return rollup.filtered(parcels(spark, d), [1, 3], "河南省").select("parcel_id", "crop_code", "area_mu")


@query(f"SELECT parcel_id, province FROM ({PARCEL_SQL}) WHERE province LIKE '%山东%' ORDER BY parcel_id LIMIT 1")
def parcel_search(spark: SparkSession, d: str) -> DataFrame:
    return rollup.search(parcels(spark, d), " 山东").select("parcel_id", "province")


@query(statistics.chain(X.MAP_SQL) + f" SELECT code, calibrated_mu FROM ({statistics.AREA}) ORDER BY calibrated_mu DESC, naive_mu DESC, code LIMIT 1")
def focus_crop(spark: SparkSession, d: str) -> DataFrame:
    w, p = estimate.prepare(X.class_map(spark, d), X.sample(spark, d), X.SAMPLE_CODES)
    return rollup.focus_crop(estimate.areas(p, w)).select("code", "calibrated_mu")


def _acreage(spark: SparkSession, d: str) -> DataFrame:
    w, p = estimate.prepare(X.class_map(spark, d), X.sample(spark, d), X.SAMPLE_CODES)
    return estimate.areas(p, w)


@query(statistics.chain(X.MAP_SQL) + f" SELECT code, cv_pct, CASE WHEN cv_pct <= 5 THEN 'badge-opt' WHEN cv_pct <= 10 THEN 'badge-good' WHEN cv_pct <= 20 THEN 'badge-warn' ELSE 'badge-danger' END AS badge FROM ({statistics.AREA})")
def cv_grade(spark: SparkSession, d: str) -> DataFrame:
    return _acreage(spark, d).select("code", "cv_pct", grading.cv_grade(F.col("cv_pct")).alias("badge"))


@query(statistics.chain(X.MAP_SQL) + f""", own AS (SELECT sum(area_mu) AS parcel_mu, count(*) AS parcels FROM ({PARCEL_SQL})), top AS (SELECT * FROM ({statistics.AREA}) ORDER BY calibrated_mu DESC, naive_mu DESC, code LIMIT 1)
    SELECT code, CASE WHEN calibrated_mu >= 1e7 THEN round(naive_mu / 1e8, 2) ELSE round(naive_mu / 1e4, 1) END AS naive, CASE WHEN calibrated_mu >= 1e7 THEN round(calibrated_mu / 1e8, 2) ELSE round(calibrated_mu / 1e4, 1) END AS calibrated, CASE WHEN calibrated_mu >= 1e7 THEN round(parcel_mu / 1e8, 2) ELSE round(parcel_mu / 1e4, 1) END AS in_parcels,
        CASE WHEN calibrated_mu >= 1e7 THEN '亿亩' ELSE '万亩' END AS unit, se_mu, cv_pct, ci_low_mu, ci_high_mu, bias_pct, parcels, round(least(100, parcel_mu / greatest(calibrated_mu, 1) * 100), 1) AS parcel_share_pct FROM top CROSS JOIN own""")
def kpi_cards(spark: SparkSession, d: str) -> DataFrame:
    return report.kpi_cards(_acreage(spark, d), parcels(spark, d))


@query(statistics.chain(X.MAP_SQL) + f" SELECT code, naive_mu, calibrated_mu, round(calibrated_mu - ci_low_mu, 1) AS err_low, round(ci_high_mu - calibrated_mu, 1) AS err_high FROM ({statistics.AREA})")
def chart_bars(spark: SparkSession, d: str) -> DataFrame:
    return report.chart_bars(_acreage(spark, d))


@query(f"SELECT crop_code, '{'|'.join(grading.PALETTE[:4])}'.split('|')[crop_code + 1] AS colour FROM ({PARCEL_SQL}) GROUP BY crop_code")
def crop_colours(spark: SparkSession, d: str) -> DataFrame:
    return parcels(spark, d).select("crop_code").distinct().select("crop_code", grading.crop_colour(F.col("crop_code"), 4).alias("colour"))


@query("SELECT kind, CASE WHEN kind LIKE '%粮豆%' THEN 'badge-opt' WHEN kind LIKE '%连作%' THEN 'badge-warn' ELSE 'badge-danger' END AS badge FROM (" + X.ORACLE_SQL["rotation_compliance"] + ")")
def compliance_badges(spark: SparkSession, d: str) -> DataFrame:
    return statistics.rotation_compliance(spark, d).select("kind", grading.compliance_badge(F.col("kind")).alias("badge"))


@query("SELECT c_name, coalesce(CASE c_custkey % 6 WHEN 0 THEN '背景/非农田' WHEN 1 THEN '玉米' WHEN 2 THEN '小麦' WHEN 3 THEN '大豆' END, '作物_' || (c_custkey % 6)) AS crop FROM customer")
def legend_join(spark: SparkSession, d: str) -> DataFrame:
    """A left join to the legend, with a name for codes that it lacks."""
    c = X.table(spark, d, "customer").select("c_name", (F.col("c_custkey") % 6).cast("int").alias("k"))
    legend = F.broadcast(estimate.legend_table(spark, X.LEGEND))
    return c.join(legend, F.col("k") == F.col("code"), "left").select("c_name", F.coalesce("name", F.concat(F.lit("作物_"), F.col("k").cast("string"))).alias("crop"))
