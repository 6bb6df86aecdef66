"""Synthetic scenes, training points and validation samples, drawn from seeds and hashes so that reruns agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.operators import estimate

# NDVI curves at these days.
DAYS = (80, 110, 140, 170, 200, 230, 260, 290)
CURVES = {
    "背景": (0.18, 0.20, 0.22, 0.21, 0.23, 0.22, 0.20, 0.18), "夏玉米": (0.20, 0.25, 0.35, 0.68, 0.85, 0.65, 0.30, 0.20), "冬小麦": (0.48, 0.78, 0.82, 0.32, 0.18, 0.20, 0.19, 0.25),
    "大豆": (0.20, 0.24, 0.38, 0.62, 0.79, 0.55, 0.28, 0.20), "水稻": (0.15, 0.11, 0.42, 0.75, 0.84, 0.62, 0.25, 0.18), "冬油菜": (0.68, 0.52, 0.35, 0.20, 0.22, 0.21, 0.22, 0.30),
    "棉花": (0.18, 0.22, 0.35, 0.65, 0.80, 0.55, 0.25, 0.20), "花生": (0.18, 0.22, 0.36, 0.65, 0.78, 0.52, 0.24, 0.20), "马铃薯": (0.20, 0.25, 0.45, 0.75, 0.80, 0.50, 0.25, 0.20),
    "甘蔗": (0.35, 0.45, 0.60, 0.75, 0.80, 0.75, 0.60, 0.45), "甜菜": (0.20, 0.30, 0.50, 0.75, 0.78, 0.50, 0.28, 0.20), "设施大棚": (0.45, 0.48, 0.46, 0.47, 0.45, 0.48, 0.46, 0.45),
    "果园茶园": (0.65, 0.68, 0.70, 0.72, 0.70, 0.68, 0.65, 0.62),
}
# Curves of scenes where they differ from those above, by class code.
SCENE = {
    0: CURVES["背景"], 1: (0.15, 0.18, 0.21, 0.35, 0.68, 0.85, 0.58, 0.22), 2: CURVES["冬小麦"],
    3: (0.16, 0.19, 0.22, 0.38, 0.62, 0.79, 0.49, 0.20), 4: CURVES["水稻"],
}
# Kinds of background points: base curve or range of a level, noise, limits.
BACKGROUND = [
    ("水体", (-0.10, 0.05), 0.01, (-0.2, 0.10)), ("裸地", (0.06, 0.18), 0.02, (0.04, 0.22)), ("城镇", (0.05, 0.14), 0.012, (0.04, 0.18)), ("常绿林", (0.55, 0.78), 0.015, (0.45, 0.85)),
    ("落叶林", (0.25, 0.45, 0.58, 0.65, 0.62, 0.52, 0.32, 0.18), 0.025, (0.08, 0.72)), ("河谷灌丛", (0.20, 0.22, 0.45, 0.78, 0.82, 0.65, 0.35, 0.22), 0.02, (0.12, 0.88)),
    ("高山灌丛", (0.20, 0.32, 0.42, 0.50, 0.48, 0.38, 0.28, 0.20), 0.02, (0.12, 0.58)),
]
FACILITY = (0.45, 0.52, 0.55, 0.58, 0.60, 0.58, 0.52, 0.48)


def _uniform(*parts: Column) -> Column:
    """0 to 1 from the first 13 hex digits of the MD5 of the parts, joined by colons."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *(p.cast("string") for p in parts))), 1, 13), 16, 10).cast("double") / float(1 << 52)


def _normal(*parts: Column) -> Column:
    """A standard normal from hashes of the parts."""
    u, v = F.greatest(_uniform(*parts, F.lit("u")), F.lit(1e-12)), _uniform(*parts, F.lit("v"))
    return F.sqrt(-2 * F.log(u)) * F.cos(2 * F.pi() * v)


def _curve(curves: dict[int, tuple[float, ...]], code: Column) -> Column:
    out = None
    for k, v in curves.items():
        arr = F.array(*(F.lit(float(x)) for x in v))
        out = F.when(code == k, arr) if out is None else out.when(code == k, arr)
    return out.otherwise(F.array(*(F.lit(float(x)) for x in next(iter(curves.values())))))


def _noisy(curve: Column, sigma: float | Column, low: float, high: float, *parts: Column) -> Column:
    return F.transform(curve, lambda x, i: F.greatest(F.lit(low), F.least(F.lit(high), x + sigma * _normal(*parts, i))))


def scene(spark: SparkSession, rows: int = 200, cols: int = 200, classes: int = 4, seed: int = 42, ridge: float = 0.65, sigma: float = 0.025) -> DataFrame:
    """(r, c, code, ndvi): fields of 11-15 by 14-19 pixels on a grid of 18 by 22, most of their outlines bare."""
    base = spark.range(rows * cols).select(F.expr(f"id DIV {cols}").alias("r"), F.pmod("id", F.lit(cols)).alias("c"))
    i, j, y, x = F.expr("r DIV 18"), F.expr("c DIV 22"), F.pmod("r", F.lit(18)), F.pmod("c", F.lit(22))
    s = F.lit(seed)
    high, wide = 11 + F.floor(5 * _uniform(s, i, j, F.lit("h"))), 14 + F.floor(6 * _uniform(s, i, j, F.lit("w")))
    kind = 1 + F.floor(classes * _uniform(s, i, j, F.lit("k")))
    border = (y == 1) | (y == high) | (x == 1) | (x == wide)
    within = (y >= 1) & (y <= high) & (x >= 1) & (x <= wide) & ~(border & (_uniform(s, F.col("r"), F.col("c"), F.lit("b")) < ridge))
    coded = base.withColumn("code", F.when(within, kind).otherwise(0).cast("int"))
    return coded.withColumn("ndvi", _noisy(_curve(SCENE, F.col("code")), sigma, 0.05, 0.95, s, F.col("r"), F.col("c")))


def demo_scene(spark: SparkSession, seed: int = 42) -> DataFrame:
    """80 x 80 pixels of three crops (shares 0.5, 0.3, 0.2) in blocks of 16 with bare ridges."""
    base = spark.range(6400).select(F.expr("id DIV 80").alias("r"), F.pmod("id", F.lit(80)).alias("c"))
    s = F.lit(seed)
    u = _uniform(s, F.expr("r DIV 16"), F.expr("c DIV 16"))
    kind = F.when(u < 0.5, 1).when(u < 0.8, 2).otherwise(3)
    edge = (F.pmod("r", F.lit(16)) == 0) | (F.pmod("c", F.lit(16)) == 0)
    bare = edge & (_uniform(s, F.col("r"), F.col("c"), F.lit("b")) < 0.6)
    coded = base.withColumn("code", F.when(bare, 0).otherwise(kind).cast("int"))
    return coded.withColumn("ndvi", _noisy(_curve(SCENE, F.col("code")), 0.02, 0.05, 0.95, s, F.col("r"), F.col("c")))


def training_points(spark: SparkSession, legend: dict[int, str], per_class: int = 50, seed: int = 42) -> DataFrame:
    """point_id, label, crop_name, doy_<n>: per_class points of each class. Background turns through seven covers; in a legend
    of two classes the crop turns through five crops."""
    codes = [c for c in sorted(legend) if c != 255]
    names = {1: "夏玉米", 2: "冬小麦", 3: "大豆", 4: "水稻"}
    by_name = {c: next((k for k in CURVES if k in legend[c] or legend[c] in k), names.get(c, "夏玉米")) for c in codes}
    k, s = F.col("k"), F.lit(seed)
    rows = spark.range(per_class * len(codes)).select(F.element_at(F.array(*(F.lit(c) for c in codes)), (F.expr(f"id DIV {per_class}") + 1).cast("int")).alias("label"), F.pmod("id", F.lit(per_class)).alias("k"))
    kind = F.pmod(k, F.lit(7))
    level = lambda a, b: F.array_repeat(F.lit(a) + (b - a) * _uniform(s, F.lit("level"), k), len(DAYS))
    background, cover = None, None
    for i, (name, base, sigma, (low, high)) in enumerate(BACKGROUND):
        curve = level(*base) if len(base) == 2 else F.array(*(F.lit(x) for x in base))
        v = _noisy(curve, sigma, low, high, s, F.lit(0), k)
        background = F.when(kind == i, v) if background is None else background.when(kind == i, v)
        cover = F.when(kind == i, F.lit(name)) if cover is None else cover.when(kind == i, F.lit(name))
    if len(codes) <= 2:
        five = {i: c for i, c in enumerate((CURVES["夏玉米"], CURVES["冬小麦"], CURVES["大豆"], CURVES["水稻"], FACILITY))}
        crop = _curve(five, F.pmod(k, F.lit(5)))
    else:
        crop = _curve({c: CURVES[by_name[c]] for c in codes if c}, F.col("label"))
    named = F.create_map(*(x for c in codes for x in (F.lit(c), F.lit(legend[c]))))
    v = F.when(F.col("label") == 0, background).otherwise(_noisy(crop, 0.02, 0.05, 0.95, s, F.col("label"), k))
    full = rows.withColumn("v", v).withColumn("crop_name", F.when(F.col("label") == 0, cover).otherwise(named[F.col("label")]))
    return full.select(F.format_string("TR_%d_%04d", "label", "k").alias("point_id"), "label", "crop_name", *(F.round(F.get("v", F.lit(i)), 4).alias(f"doy_{d}") for i, d in enumerate(DAYS)))


def short_season(days: list[int]) -> bool:
    """One date, a span of up to 15 days, or all days up to 60."""
    return len(days) <= 1 or max(days) - min(days) <= 15 or max(days) <= 60


def snapshot_align(df: DataFrame, values: Column, days: list[int], n_classes: int, target: int, seed: int = 42, key: str = "point_id") -> Column:
    """A series for scenes of one short season (span up to 15 days, or all days up to 60, or one date); other scenes and series
    that fit already keep their values.

    Up to three classes: background keeps the mean of its first three values, crops their greatest (winter-green 0.45-0.70 where
    it is under 0.40), repeated with a little noise. More classes: the value of the day nearest the scene's middle, repeated.
    """
    if not short_season(days):
        return values
    s = F.lit(seed)
    if n_classes <= 3:
        top = F.array_max(values)
        base = F.when(F.col("label") == 0, F.aggregate(F.slice(values, 1, 3), F.lit(0.0), lambda a, x: a + x) / F.least(F.size(values), F.lit(3))).otherwise(F.when(top < 0.40, 0.45 + 0.25 * _uniform(s, F.col(key))).otherwise(top))
        aligned = _noisy(F.array_repeat(base, target), 0.015, 0.0, 0.95, s, F.col(key))
    else:
        middle = sum(days) / max(1, len(days))
        nearest = min(range(len(DAYS)), key=lambda i: abs(DAYS[i] - middle))
        aligned = F.array_repeat(F.get(values, F.lit(nearest)), target)
    return F.when(F.size(values) == target, values).otherwise(aligned)


def channels(ndvi: Column, name: Column, is_crop: Column, seed: int = 42, key: str = "point_id") -> Column:
    """struct(lswi, gcvi, cv) made up for training points that only have NDVI, by what the point is called or looks like."""
    s, k = F.lit(seed), F.col(key)
    low, high, wide = F.array_min(ndvi), F.array_max(ndvi), F.array_max(ndvi) - F.array_min(ndvi)
    mean = F.aggregate(ndvi, F.lit(0.0), lambda a, x: a + x) / F.greatest(F.size(ndvi), F.lit(1))
    has = lambda *words: F.greatest(*(F.coalesce(F.contains(name, F.lit(w)), F.lit(False)) for w in words))
    clip = lambda x, a, b: F.greatest(F.lit(a), F.least(F.lit(b), x))
    noise = lambda tag, i: _normal(s, k, F.lit(tag), i)
    uni = lambda tag, a, b, i: a + (b - a) * _uniform(s, k, F.lit(tag), i)
    scrub = has("灌", "荒坡", "河谷") | ((low < 0.28) & (high > 0.65))
    forest = has("林", "山", "树") | ((low > 0.35) & (high > 0.55))
    lawn = has("草坪", "绿地") | ((wide < 0.15) & (mean > 0.45))
    water = has("水", "消落") | (mean < 0)
    pick = lambda crop, a, b, c, d, e: F.when(is_crop, crop).when(scrub, a).when(forest, b).when(lawn, c).when(water, d).otherwise(e)
    lswi = F.transform(ndvi, lambda v, i: pick(clip(v - 0.15 + 0.05 * noise("l", i), -1.0, 1.0), clip(v - 0.40 + 0.04 * noise("l", i), -0.25, 0.30), clip(v - 0.45 + 0.05 * noise("l", i), -0.10, 0.25), uni("l", 0.05, 0.18, i), uni("l", 0.30, 0.70, i), uni("l", -0.25, -0.05, i)))
    gcvi = F.transform(ndvi, lambda v, i: pick(clip(F.exp(2.2 * v) - 1 + 0.3 * noise("g", i), 0.0, 8.0), clip(2.8 * v + 0.2 * noise("g", i), 0.2, 4.5), clip(3.5 * v + 0.2 * noise("g", i), 1.0, 4.0), uni("g", 1.8, 3.5, i), F.lit(-0.5), uni("g", 0.0, 0.5, i)))
    cv = F.transform(ndvi, lambda v, i: clip(pick(uni("c", 0.015, 0.350, i), uni("c", 0.08, 0.22, i), uni("c", 0.07, 0.20, i), uni("c", 0.02, 0.035, i), uni("c", 0.005, 0.02, i), uni("c", 0.02, 0.05, i)), 0.0, 0.5))
    return F.struct(lswi.alias("lswi"), gcvi.alias("gcvi"), cv.alias("cv"))


def validation_sample(pixels: DataFrame, codes: list[int], code: str = "code") -> DataFrame:
    """sample_id, map_label, true_label, weight: ten points of each class on the map (five of absent ones), the first 90% right, the
    rest background; background's own misses are the first present crop, unless background rules the map or that crop is rare."""
    spark = pixels.sparkSession
    w = estimate.class_histogram(pixels, codes, code)
    first = w.where("code <> 0 AND pixels > 0").agg(F.min("code").alias("crop"))
    rich = w.join(F.broadcast(first), F.col("code") == F.col("crop")).select("crop", F.col("weight").alias("crop_w"))
    zero = w.where("code = 0").agg(F.max("weight").alias("w0"))
    base = w.crossJoin(F.broadcast(zero)).crossJoin(F.broadcast(first)).join(F.broadcast(rich), "crop", "left")
    n = F.when(F.col("pixels") > 0, 10).otherwise(5)
    drawn = base.withColumn("n", n).withColumn("k", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    right = F.col("k") < F.floor(F.col("n") * 0.9)
    miss = F.when(F.col("code") != 0, 0).when((F.coalesce("w0", F.lit(0.0)) < estimate.MACRO_BACKGROUND) & (F.coalesce("crop_w", F.lit(0.0)) >= 0.10), F.col("crop")).otherwise(0)
    return drawn.select(F.format_string("VAL_%d_%02d", "code", "k").alias("sample_id"), F.col("code").alias("map_label"), F.when(right, F.col("code")).otherwise(miss).cast("int").alias("true_label"), F.lit(1.0).alias("weight"))
