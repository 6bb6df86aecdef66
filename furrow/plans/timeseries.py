"""Queries on spectral indices, series features and priors."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.functions import series, spectral
from furrow.operators import classify, prior
from furrow.plans import fixtures as X
from furrow.plans.fixtures import query_n as query
from furrow.plans.fixtures import r4n as r4

# ---- spectral indices

NDVI = "CASE WHEN b4 + b3 > 0 THEN (b4 - b3) / (b4 + b3) ELSE 0 END"
LSWI = "CASE WHEN b4 + b5 > 0 THEN (b4 - b5) / (b4 + b5) ELSE 0 END"
GCVI = "greatest(-2, least(10, CASE WHEN b2 > 0 THEN b4 / b2 - 1 ELSE 0 END))"
INDEX_SQL = f"""WITH b AS ({X.BAND_SQL}), i AS (SELECT *, {NDVI} AS n, {LSWI} AS l, {GCVI} AS g, (b2 - b5) / greatest(b2 + b5, 1e-4) AS m FROM b),
    x AS (SELECT *, (m > 0.02 AND b4 < 1200) OR (n < 0 AND m > -0.05) OR n < -0.05 AS water FROM i)"""


@query(INDEX_SQL + " SELECT l_orderkey, l_linenumber, round(CASE WHEN water THEN least(n, -0.30) ELSE n END, 4) AS ndvi, round(CASE WHEN water THEN 0.60 ELSE l END, 4) AS lswi, round(CASE WHEN water THEN -1 ELSE g END, 4) AS gcvi, round(m, 4) AS mndwi FROM x")
def spectral_indices(spark: SparkSession, d: str) -> DataFrame:
    return spectral.with_indices(X.bands(spark, d)).select("l_orderkey", "l_linenumber", *(r4(F.col(c)).alias(c) for c in ("ndvi", "lswi", "gcvi", "mndwi")))


@query(INDEX_SQL + " SELECT water, count(*) AS pixels, round(avg(b4), 4) AS mean_nir FROM x GROUP BY water")
def water_mask(spark: SparkSession, d: str) -> DataFrame:
    return spectral.with_indices(X.bands(spark, d)).groupBy("water").agg(F.count("*").alias("pixels"), r4(F.avg("b4")).alias("mean_nir"))


@query(f"WITH b AS ({X.BAND_SQL}) SELECT l_orderkey, l_linenumber, round((b4 - b5) / CASE WHEN b4 + b5 = 0 THEN 1e-6 ELSE b4 + b5 END, 4) AS lswi, round((b2 - b4) / CASE WHEN b2 + b4 = 0 THEN 1e-6 ELSE b2 + b4 END, 4) AS ndwi FROM b")
def difference_indices(spark: SparkSession, d: str) -> DataFrame:
    return X.bands(spark, d).select("l_orderkey", "l_linenumber", r4(spectral.difference_index("b4", "b5")).alias("lswi"), r4(spectral.difference_index("b2", "b4")).alias("ndwi"))


@query(f"WITH b AS (SELECT *, l_orderkey % 3 AS scene, CASE WHEN l_orderkey % 3 = 0 THEN b3 / 10000 ELSE b3 END AS x FROM ({X.BAND_SQL})) SELECT scene, round(avg(CASE WHEN m > 100 THEN x / 10000 ELSE x END), 6) AS mean FROM (SELECT *, max(x) OVER (PARTITION BY scene) AS m FROM b) GROUP BY scene")
def reflectance_scale(spark: SparkSession, d: str) -> DataFrame:
    b = X.bands(spark, d).withColumn("scene", F.col("l_orderkey") % 3).withColumn("x", F.when(F.col("scene") == 0, F.col("b3") / 10000).otherwise(F.col("b3")))
    return spectral.autoscale(b, ["x"], ["scene"]).groupBy("scene").agg(F.round(F.avg("x"), 6).alias("mean"))


@query("""WITH v AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'nan'::DOUBLE WHEN 2 THEN 'inf'::DOUBLE WHEN 3 THEN '-inf'::DOUBLE ELSE value END AS x FROM events)
    SELECT event_id, round(CASE WHEN x IS NULL OR isnan(x) OR x = '-inf'::DOUBLE THEN 0 WHEN x = 'inf'::DOUBLE THEN 1 ELSE x END, 4) AS x FROM v""")
def clean_values(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("event_id") % 5
    x = F.when(k == 1, float("nan")).when(k == 2, float("inf")).when(k == 3, float("-inf")).when(k == 4, F.col("value"))
    return X.table(spark, d, "events").select("event_id", r4(spectral.clean(x)).alias("x"))


# ---- features of series of eight values; SQL lists count from 1

S = f"WITH s AS ({X.SERIES_SQL})"
GRAD = "[v[2] - v[1], (v[3] - v[1]) / 2, (v[4] - v[2]) / 2, (v[5] - v[3]) / 2, (v[6] - v[4]) / 2, (v[7] - v[5]) / 2, (v[8] - v[6]) / 2, v[8] - v[7]]"


def _features(spark: SparkSession, d: str, names: tuple[str, ...]) -> DataFrame:
    s = X.series(spark, d)
    f = series.features(F.col("v"), 8)
    return s.select("user_id", *(r4(f[n]).alias(n) for n in names))


@query(S + " SELECT user_id, round(list_max(v), 4) AS max, round(list_min(v), 4) AS min, round(list_max(v) - list_min(v), 4) AS range, round(list_aggregate(v, 'stddev_pop'), 4) AS std FROM s")
def ts_basic(spark: SparkSession, d: str) -> DataFrame:
    return _features(spark, d, ("max", "min", "range", "std"))


@query(S + f" SELECT user_id, round(list_max(g), 4) AS grad_max, round(list_min(g), 4) AS grad_min, round(list_avg(list_transform(g, lambda x: abs(x))), 4) AS grad_abs FROM (SELECT user_id, {GRAD} AS g FROM s)")
def ts_gradient(spark: SparkSession, d: str) -> DataFrame:
    return _features(spark, d, ("grad_max", "grad_min", "grad_abs"))


@query(f"WITH b AS ({X.BINS_SQL}), n AS (SELECT *, lag(v) OVER w AS a, lead(v) OVER w AS z FROM b WINDOW w AS (PARTITION BY user_id ORDER BY t)) SELECT user_id, t, round(CASE WHEN a IS NULL AND z IS NULL THEN 0 WHEN a IS NULL THEN z - v WHEN z IS NULL THEN v - a ELSE (z - a) / 2 END, 4) AS g FROM n")
def ts_gradient_window(spark: SparkSession, d: str) -> DataFrame:
    """The same gradient over the long form, with lag and lead."""
    from pyspark.sql import Window

    hours = F.timestamp_diff("HOUR", F.lit("2024-01-01 00:00:00").cast("timestamp"), F.col("ts"))
    bins = X.table(spark, d, "events").groupBy("user_id", F.floor(hours / 90.0).cast("int").alias("t")).agg((F.avg("value") / 200).alias("v"))
    w = Window.partitionBy("user_id").orderBy("t")
    a, z, v = F.lag("v").over(w), F.lead("v").over(w), F.col("v")
    return bins.select("user_id", "t", r4(F.when(a.isNull() & z.isNull(), 0.0).when(a.isNull(), z - v).when(z.isNull(), v - a).otherwise((z - a) / 2)).alias("g"))


@query(S + " SELECT user_id, round((v[3] - v[1]) / 2, 4) AS slope_early, round((v[7] - v[5]) / 2, 4) AS slope_mid, round(v[8] - v[7], 4) AS slope_late FROM s")
def ts_slopes(spark: SparkSession, d: str) -> DataFrame:
    return _features(spark, d, ("slope_early", "slope_mid", "slope_late"))


@query(S + """, p AS (SELECT user_id, v, greatest(0, v[1] - list_min(v[1:4])) AS dip, greatest(0, list_max(v) - list_min(v[1:4])) AS rebound FROM s)
    SELECT user_id, round(dip, 4) AS dip, round(rebound, 4) AS rebound, round(dip / CASE WHEN v[1] > 0.02 THEN v[1] + 0.05 ELSE 0.05 END * rebound / CASE WHEN list_max(v) > 0.02 THEN list_max(v) + 0.05 ELSE 0.05 END, 4) AS paddy FROM p""")
def paddy_index(spark: SparkSession, d: str) -> DataFrame:
    return _features(spark, d, ("dip", "rebound", "paddy"))


def _dft(k: int, f: str) -> str:
    return " + ".join(f"v[{i + 1}] * {f}({2 * math.pi * k * i / 8!r})" for i in range(8))


@query(S + f", h AS (SELECT user_id, {_dft(1, 'cos')} AS re, -({_dft(1, 'sin')}) AS im FROM s) SELECT user_id, round(sqrt(re * re + im * im) / 8, 4) AS amp1, round(cos(atan2(im, re)), 4) AS cos1, round(sin(atan2(im, re)), 4) AS sin1, CAST(0 AS DOUBLE) AS amp2 FROM h")
def fourier_harmonics(spark: SparkSession, d: str) -> DataFrame:
    s = X.series(spark, d)
    f = series.features(F.col("v"), 8)
    return s.select("user_id", r4(f["amp1"]).alias("amp1"), r4(F.cos(f["phase1"])).alias("cos1"), r4(F.sin(f["phase1"])).alias("sin1"), r4(f["amp2"]).alias("amp2"))


@query(S + """, c AS (SELECT user_id, v, list_transform(v, lambda x: x * 0.8 - 0.1) AS l, list_transform(v, lambda x: x * 3) AS g, list_transform(v, lambda x: x / 10) AS k FROM s)
    SELECT user_id, round(list_max(l), 4) AS lswi_max, round(list_min(l), 4) AS lswi_min, round(list_avg(l), 4) AS lswi_mean, round(list_aggregate(l, 'stddev_pop'), 4) AS lswi_std, round(list_avg(l) - list_avg(v), 4) AS lswi_gap,
        round(list_max(g), 4) AS gcvi_max, round(list_avg(g), 4) AS gcvi_mean, round(list_avg(k), 4) AS cv_mean, round(list_max(k), 4) AS cv_max FROM c""")
def channel_features(spark: SparkSession, d: str) -> DataFrame:
    s = X.series(spark, d)
    v = F.col("v")
    f = series.features(v, 8, F.transform(v, lambda x: x * 0.8 - 0.1), F.transform(v, lambda x: x * 3), F.transform(v, lambda x: x / 10))
    return s.select("user_id", *(r4(f[n]).alias(n) for n in ("lswi_max", "lswi_min", "lswi_mean", "lswi_std", "lswi_gap", "gcvi_max", "gcvi_mean", "cv_mean", "cv_max")))


def _repair_sql() -> str:
    """Unrolled: each step sees the value before as it was repaired."""
    out = "SELECT user_id, v, v[1] AS r1 FROM s"
    for t in range(2, 8):
        keep = ", ".join(f"r{i}" for i in range(1, t))
        out = f"SELECT user_id, v, {keep}, CASE WHEN v[{t}] < r{t - 1} - 0.18 AND v[{t}] < v[{t + 1}] - 0.18 THEN (r{t - 1} + v[{t + 1}]) / 2 ELSE v[{t}] END AS r{t} FROM ({out})"
    return out


@query(S + f" SELECT user_id, {', '.join(f'round(r{i}, 4) AS t{i - 1}' for i in range(1, 8))}, round(v[8], 4) AS t7 FROM ({_repair_sql()})")
def cloud_spike_repair(spark: SparkSession, d: str) -> DataFrame:
    s = X.series(spark, d).withColumn("x", series.repair_spikes(F.col("v")))
    return s.select("user_id", *(r4(F.get("x", F.lit(i))).alias(f"t{i}") for i in range(8)))


def _savgol_sql(i: int) -> str:
    row, begin = {0: (series.SAVGOL[0], 0), 1: (series.SAVGOL[1], 0), 6: (series.SAVGOL[1][::-1], 3), 7: (series.SAVGOL[0][::-1], 3)}.get(i, (series.SAVGOL[2], i - 2))
    return "(" + " + ".join(f"({k}) * v[{begin + j + 1}]" for j, k in enumerate(row)) + ") / 35"


@query(S + f" SELECT user_id, {', '.join(f'round({_savgol_sql(i)}, 4) AS t{i}' for i in range(8))} FROM s")
def savgol_smooth(spark: SparkSession, d: str) -> DataFrame:
    s = X.series(spark, d).withColumn("x", series.savgol(F.col("v"), 8))
    return s.select("user_id", *(r4(F.get("x", F.lit(i))).alias(f"t{i}") for i in range(8)))


@query(S + " SELECT user_id, round(v[1], 4) AS t0, round(v[3] , 4) AS t1, round(v[3], 4) AS t2, round(v[3] + (v[6] - v[3]) / 3, 4) AS t3, round(v[3] + (v[6] - v[3]) * 2 / 3, 4) AS t4, round(v[6], 4) AS t5, round(v[6], 4) AS t6, round(v[6], 4) AS t7 FROM (SELECT user_id, list_concat([v[3]], v[2:8]) AS v FROM s)".replace("round(v[1], 4) AS t0", "round(v[3], 4) AS t0"))
def gap_fill(spark: SparkSession, d: str) -> DataFrame:
    """Values 2 and 5 of a series are known; the ends are held and the gap is filled by a line."""
    holes = F.transform("v", lambda x, i: F.when((i == 2) | (i == 5), x))
    s = X.series(spark, d).withColumn("x", series.fill_gaps(holes))
    return s.select("user_id", *(r4(F.get("x", F.lit(i))).alias(f"t{i}") for i in range(8)))


TARGET = (60.0, 85.0, 100.0, 110.0, 155.0, 290.0, 300.0)


def _interp_sql(day: float) -> str:
    """Linear between bins on days 80 + 30 t, held beyond."""
    x = (day - 80) / 30
    if x <= 0 or x >= 7:
        return "v[1]" if x <= 0 else "v[8]"
    i = int(x)
    return f"v[{i + 1}] + (v[{i + 2}] - v[{i + 1}]) * {(day - 80 - 30 * i)!r} / 30" if x > i else f"v[{i + 1}]"


@query(S + f" SELECT user_id, {', '.join(f'round({_interp_sql(t)}, 4) AS d{i}' for i, t in enumerate(TARGET))} FROM s")
def doy_interpolate(spark: SparkSession, d: str) -> DataFrame:
    days = F.array(*(F.lit(80 + 30 * t) for t in range(8)))
    s = X.series(spark, d).withColumn("x", series.resample(days, F.col("v"), list(TARGET)))
    return s.select("user_id", *(r4(F.get("x", F.lit(i))).alias(f"d{i}") for i in range(len(TARGET))))


# ---- priors and rules over series

FOREST = "list_min(v) >= 0.42 AND list_avg(v) >= 0.55"
PRIOR_SQL = f"""CASE WHEN NOT ({FOREST}) AND NOT (v[3] > 0.82 AND v[4] > 0.68 AND v[1] < 0.50 AND list_max(v) - list_min(v) < 0.38) AND v[3] >= 0.50 AND list_max(v) - list_min(v) >= 0.20 AND list_min(v) <= 0.40 THEN 0.80
    WHEN v[3] > 0.82 AND v[4] > 0.68 AND v[1] < 0.50 AND list_max(v) - list_min(v) < 0.38 THEN 0.05 WHEN {FOREST} THEN 0.05 WHEN list_max(v) - list_min(v) < 0.15 AND list_max(v) < 0.50 THEN 0.02
    WHEN list_max(v) < 0.35 THEN 0.01 WHEN list_min(v) < 0 THEN 0 ELSE 0.5 END"""
#: Shifted series reach all rules.
WIDE = S + ", w AS (SELECT user_id, k.range AS k, list_transform(v, lambda x: CAST((x - 0.25) * (1 + k.range) + 0.1 * k.range AS DOUBLE)) AS v FROM s CROSS JOIN range(4) k)"


def _wide(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("k")
    s = X.series(spark, d).withColumn("k", F.explode(F.array(*(F.lit(i).cast("long") for i in range(4)))))
    return s.withColumn("v", F.transform("v", lambda x: (x - 0.25) * (1 + k) + k / 10))  # 0.1 * k is decimal in SQL: 0.3, not 0.30000000000000004


@query(WIDE + f" SELECT user_id, k, CAST({PRIOR_SQL} AS DOUBLE) AS prior FROM w")
def builtin_prior(spark: SparkSession, d: str) -> DataFrame:
    return _wide(spark, d).select("user_id", "k", prior.builtin_prior(F.col("v")).alias("prior"))


@query(WIDE + f""" SELECT user_id, k, CAST(CASE WHEN NOT ({FOREST}) AND NOT (l[2] > 0.15 AND l[4] > 0.15 AND v[2] > 0.70 AND v[4] > 0.70) AND v[3] >= 0.50 AND list_max(v) - list_min(v) >= 0.20 AND list_min(v) <= 0.40 AND l[3] >= -0.05 THEN 0.80
    WHEN l[2] > 0.15 AND l[4] > 0.15 AND v[2] > 0.70 AND v[4] > 0.70 THEN 0.05 WHEN {FOREST} THEN 0.05 WHEN list_max(v) - list_min(v) < 0.15 AND list_max(v) < 0.50 THEN 0.02
    WHEN list_max(v) < 0.35 THEN 0.01 WHEN list_min(v) < 0 THEN 0 ELSE 0.5 END AS DOUBLE) AS prior FROM (SELECT *, list_transform(v, lambda x: x * 0.8 - 0.1) AS l FROM w)""")
def builtin_prior_lswi(spark: SparkSession, d: str) -> DataFrame:
    return _wide(spark, d).select("user_id", "k", prior.builtin_prior(F.col("v"), F.transform("v", lambda x: x * 0.8 - 0.1)).alias("prior"))


CELLS = "SELECT event_id, CAST(event_id % 101 AS DOUBLE) / 100 AS local, CAST(event_id * 7 % 101 AS DOUBLE) / 100 AS prior, event_id % 13 = 0 AS steep, CAST(event_id % 10 AS INT) AS cover FROM events"


def _cells(spark: SparkSession, d: str) -> DataFrame:
    e = F.col("event_id")
    return X.table(spark, d, "events").select("event_id", ((e % 101).cast("double") / 100).alias("local"), ((e * 7 % 101).cast("double") / 100).alias("prior"), (e % 13 == 0).alias("steep"), (e % 10).cast("int").alias("cover"))


@query(f"SELECT event_id, CAST(CASE cover WHEN 1 THEN 0.95 WHEN 2 THEN 0.02 WHEN 3 THEN 0.08 WHEN 4 THEN 0.05 WHEN 5 THEN 0 WHEN 7 THEN 0.02 WHEN 8 THEN 0.01 ELSE 0 END AS DOUBLE) AS clcd, CAST(CASE WHEN cover * 10 IN (10, 100) THEN 0.95 WHEN cover > 0 THEN 0.03 ELSE 0 END AS DOUBLE) AS cereal, round(CAST(cover AS DOUBLE) / 9, 4) AS other FROM ({CELLS})")
def landcover_prior(spark: SparkSession, d: str) -> DataFrame:
    c = _cells(spark, d)
    most = c.agg(F.max("cover").alias("most"))
    return c.crossJoin(F.broadcast(most)).select("event_id", prior.landcover_prior(F.col("cover")).alias("clcd"), prior.landcover_prior(F.col("cover") * 10, "worldcereal", F.col("most") * 10).alias("cereal"), r4(prior.landcover_prior(F.col("cover"), "other", F.col("most"))).alias("other"))


BLEND = "(0.5 * prior + 0.5 * local)"
VETO = "(prior <= 0.05 OR (prior <= 0.25 AND local < 0.85))"


@query(f"""SELECT event_id, round(greatest(0, least(1, CASE WHEN steep THEN 0 WHEN {VETO} THEN 0 WHEN local >= 0.35 THEN greatest(local, {BLEND}) WHEN prior >= 0.70 THEN {BLEND} ELSE local * 0.5 END)), 4) AS builtin,
    round(greatest(0, least(1, CASE WHEN local < 0.30 THEN local * 0.5 ELSE {BLEND} END)), 4) AS external FROM ({CELLS})""")
def prior_fusion(spark: SparkSession, d: str) -> DataFrame:
    local, p = F.col("local"), F.col("prior")
    return _cells(spark, d).select("event_id", r4(prior.fuse(local, p, terrain=F.col("steep"))).alias("builtin"), r4(prior.fuse(local, p, external=True, hard_veto=False)).alias("external"))


@query(f"SELECT event_id, {VETO} AS vetoed FROM ({CELLS})")
def hard_veto(spark: SparkSession, d: str) -> DataFrame:
    return _cells(spark, d).select("event_id", prior.hard_vetoed(F.col("local"), F.col("prior")).alias("vetoed"))


@query(f"SELECT event_id, CAST(CASE WHEN local >= 0.40 THEN CASE WHEN cover = 0 THEN 1 ELSE cover END ELSE 0 END AS INT) AS code, CAST(CASE WHEN local >= 0.40 THEN 1 ELSE 0 END AS INT) AS binary_code FROM ({CELLS})")
def final_code(spark: SparkSession, d: str) -> DataFrame:
    return _cells(spark, d).select("event_id", prior.final_code(F.col("local"), F.col("cover")).alias("code"), prior.final_code(F.col("local"), F.col("cover"), binary=True).alias("binary_code"))


@query(WIDE + f""", p AS (SELECT *, CAST({PRIOR_SQL} AS DOUBLE) AS prior, user_id % 7 = 0 AS steep, list_min(v) AS lo, list_max(v) AS hi, list_avg(v) AS mean FROM w),
    q AS (SELECT *, prior >= 0.70 AND lo <= 0.40 AND hi >= 0.50 AND hi - lo >= 0.20 AND NOT steep AS pos, CASE WHEN hi <= 0.22 OR lo <= 0 THEN 'water' WHEN hi <= 0.32 AND hi - lo <= 0.15 THEN 'built' WHEN steep AND prior <= 0.10 THEN 'terrain' WHEN lo >= 0.42 AND mean >= 0.55 THEN 'forest' END AS neg FROM p)
    SELECT user_id, k, CAST(CASE WHEN pos THEN 1 WHEN neg IS NOT NULL THEN 0 END AS INT) AS pseudo, CASE WHEN pos THEN 'crop' ELSE neg END AS kind FROM q""")
def pseudo_labels(spark: SparkSession, d: str) -> DataFrame:
    w = _wide(spark, d).withColumn("prior", prior.builtin_prior(F.col("v"))).withColumn("steep", F.col("user_id") % 7 == 0)
    return prior.pseudo_labels(w, "v", "prior", "steep").select("user_id", "k", "pseudo", "kind")


@query(WIDE + f""", p AS (SELECT *, CAST({PRIOR_SQL} AS DOUBLE) AS prior, list_min(v) AS lo, list_max(v) AS hi, list_avg(v) AS mean, user_id * 4 + k AS pixel FROM w),
    q AS (SELECT *, prior >= 0.70 AND lo <= 0.40 AND hi >= 0.50 AND hi - lo >= 0.20 AS pos, CASE WHEN hi <= 0.22 OR lo <= 0 THEN 'water' WHEN hi <= 0.32 AND hi - lo <= 0.15 THEN 'built' WHEN lo >= 0.42 AND mean >= 0.55 THEN 'forest' END AS neg FROM p),
    z AS (SELECT pixel, CAST(CASE WHEN pos THEN 1 WHEN neg IS NOT NULL THEN 0 END AS INT) AS pseudo, CASE WHEN pos THEN 'crop' ELSE neg END AS kind FROM q)
    SELECT pixel, pseudo, kind FROM z WHERE pseudo IS NOT NULL QUALIFY row_number() OVER (PARTITION BY pseudo ORDER BY md5('42:' || pixel), pixel) <= 100""")
def mined_samples(spark: SparkSession, d: str) -> DataFrame:
    """A drawn sample of pseudo labels."""
    w = _wide(spark, d).withColumn("prior", prior.builtin_prior(F.col("v"))).withColumn("pixel", F.col("user_id") * 4 + F.col("k"))
    return prior.mine(prior.pseudo_labels(w, "v", "prior"), 100).select("pixel", "pseudo", "kind")


@query(S + """, a AS (SELECT 'U' || user_id AS point_id, CAST(user_id % 3 AS INT) AS label, '作物_' || (user_id % 3) AS crop_name, v FROM s)
    SELECT point_id, label, crop_name, round(v[1], 4) AS doy_80, round((v[1] + v[2]) / 2, 4) AS doy_95, round(v[8], 4) AS doy_290 FROM a
    UNION ALL SELECT 'M' || user_id, 1, 'mined', round(v[1], 4), round((v[1] + v[2]) / 2, 4), round(v[2], 4) FROM s WHERE user_id % 5 = 0""")
def merge_samples(spark: SparkSession, d: str) -> DataFrame:
    s = X.series(spark, d)
    base = s.select(F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("point_id"), (F.col("user_id") % 3).cast("int").alias("label"), *(F.get("v", F.lit(t)).alias(f"doy_{80 + 30 * t}") for t in range(8)))
    mined = s.where("user_id % 5 = 0").select(F.concat(F.lit("M"), F.col("user_id").cast("string")).alias("point_id"), F.lit(1).alias("label"), F.lit("mined").alias("crop_name"), *(F.get("v", F.lit(t)).alias(f"doy_{80 + 30 * t}") for t in range(2)))
    merged = prior.merge_samples(base, mined, [80, 95, 290], digits=12)
    return merged.select("point_id", "label", "crop_name", *(r4(F.col(c)).alias(c) for c in ("doy_80", "doy_95", "doy_290")))


# ---- scoring rules over fixed probabilities

PROBS = "SELECT event_id, CAST(event_id % 97 AS DOUBLE) / 97 AS p0, (1 - CAST(event_id % 97 AS DOUBLE) / 97) * CAST(event_id % 7 AS DOUBLE) / 6 AS p1, CAST(event_id * 3 % 4 > 0 AS INT) AS label FROM events"


def _probs(spark: SparkSession, d: str) -> DataFrame:
    e = F.col("event_id")
    p0 = (e % 97).cast("double") / 97
    return X.table(spark, d, "events").select("event_id", p0.alias("p0"), ((1 - p0) * (e % 7).cast("double") / 6).alias("p1"), (e * 3 % 4 > 0).cast("int").alias("label"))


@query(f"""WITH p AS ({PROBS}), t AS (SELECT CAST(round(0.10 + 0.05 * r.range, 2) AS DOUBLE) AS th FROM range(17) r),
    f AS (SELECT th, 2.0 * count(CASE WHEN p0 < th AND label > 0 THEN 1 END) / greatest(2 * count(CASE WHEN p0 < th AND label > 0 THEN 1 END) + count(CASE WHEN p0 < th AND label <= 0 THEN 1 END) + count(CASE WHEN NOT p0 < th AND label > 0 THEN 1 END), 1) AS f1 FROM p CROSS JOIN t GROUP BY th)
    SELECT th, round(CAST(f1 AS DOUBLE), 4) AS f1 FROM f WHERE f1 >= (SELECT max(f1) FROM f) - 1e-4 ORDER BY abs(th - 0.5), th LIMIT 1""")
def cv_threshold(spark: SparkSession, d: str) -> DataFrame:
    return classify.threshold_search(_probs(spark, d), "p0")


@query(f"SELECT event_id, CAST(CASE WHEN p0 >= 0.45 THEN 0 WHEN p1 >= 1 - p0 - p1 THEN 1 ELSE 2 END AS INT) AS code, round(1 - p0, 4) AS crop_prob FROM ({PROBS})")
def score_decision(spark: SparkSession, d: str) -> DataFrame:
    p = _probs(spark, d)
    code, prob = classify.decide(F.array("p0", "p1", 1 - F.col("p0") - F.col("p1")), [0, 1, 2], 0.45)
    return p.select("event_id", code.alias("code"), r4(prob).alias("crop_prob"))


@query(WIDE + """, r AS (SELECT user_id, k, v, list_min(v) AS lo, list_max(v) AS hi, list_avg(v) AS mean FROM w)
    SELECT user_id, k, CAST(CASE WHEN bad THEN 0 ELSE 1 END AS INT) AS code, CAST(CASE WHEN bad THEN 0 ELSE 0.9 END AS DOUBLE) AS crop_prob
    FROM (SELECT *, NOT (hi >= 0.35 AND lo <= 0.45 AND hi - lo >= 0.18) OR (lo >= 0.42 AND mean >= 0.55) OR (v[1] >= 0.38 AND v[5] >= 0.65 AND v[8] >= 0.55 AND hi - lo < 0.28) OR (hi - lo < 0.18 AND hi < 0.65) OR hi < 0.08 OR lo < -0.15 AS bad FROM r)""")
def score_rules(spark: SparkSession, d: str) -> DataFrame:
    w = _wide(spark, d).withColumn("code", F.lit(1)).withColumn("crop_prob", F.lit(0.9))
    return classify.apply_rules(w, "v", 8).select("user_id", "k", "code", "crop_prob")


@query(WIDE + " SELECT user_id, k, greatest(list_max(v), list_max(v) - list_min(v)) >= 0.28 AS vegetated FROM w")
def vegetation_gate(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("v")
    return _wide(spark, d).select("user_id", "k", classify.vegetated([F.array_max(v), F.array_min(v), series.span(v)]).alias("vegetated"))


@query("WITH l AS (SELECT CAST(o_custkey % 3 AS INT) AS label, count(*) AS n FROM orders GROUP BY 1) SELECT label, round(CAST((SELECT sum(n) FROM l) AS DOUBLE) / (3 * n), 4) AS class_weight FROM l")
def balanced_weights(spark: SparkSession, d: str) -> DataFrame:
    o = X.table(spark, d, "orders").select((F.col("o_custkey") % 3).cast("int").alias("label"))
    return classify.balanced(o).groupBy("label").agg(r4(F.max("class_weight")).alias("class_weight"))
