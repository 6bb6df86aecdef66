"""Focal operators over pixel tables (r, c, values): windows along rows, then along columns.

A window holds one raster row or column of one scene and is sorted and spilled by Spark, so a raster of any size and tiling gives
the same result; no tile border needs care. Frames are ranges over r or c, so a missing pixel counts as outside.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from furrow.functions import geo


def along(axis: str, keys: Sequence[str] = ()) -> Window:
    """The window over one row (axis "c") or one column (axis "r")."""
    return Window.partitionBy(*keys, "r" if axis == "c" else "c").orderBy(axis)


def neighbour(x: Column | str, axis: str, step: int, keys: Sequence[str] = ()) -> Column:
    """The value `step` pixels further along an axis; null where there is none."""
    return F.max(x).over(along(axis, keys).rangeBetween(step, step))


def extent(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rows and columns of each scene: _h, _w; a row a scene."""
    return df.groupBy(*keys).agg((F.max("r") + 1).alias("_h"), (F.max("c") + 1).alias("_w"))


def with_extent(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    size = extent(df, keys)
    return df.join(size, list(keys)) if keys else df.crossJoin(F.broadcast(size))  # one row without keys


def halo(df: DataFrame, h: int, mode: str = "reflect", keys: Sequence[str] = ()) -> DataFrame:
    """df with h mirrored rows and columns on each side: "reflect" repeats the border pixel, "mirror" does not.

    Scenes must have more than h rows and columns.
    """
    names = df.columns
    out = df
    for axis, size in (("r", "_h"), ("c", "_w")):
        known = with_extent(df.select(*keys, "r", "c"), keys).select(*keys, size).distinct()
        sized = out.join(known, list(keys)) if keys else out.crossJoin(F.broadcast(known))
        x, n = F.col(axis), F.col(size)
        low, low_to = (x < h, -1 - x) if mode == "reflect" else ((x > 0) & (x <= h), -x)
        high, high_to = (x >= n - h, 2 * n - 1 - x) if mode == "reflect" else ((x < n - 1) & (x >= n - 1 - h), 2 * n - 2 - x)
        places = F.array_compact(F.array(x, F.when(low, low_to), F.when(high, high_to)))
        out = sized.withColumn("_at", F.explode(places)).withColumn(axis, F.col("_at").cast(df.schema[axis].dataType)).select(*names)
    return out


def inside(padded: DataFrame, df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The pixels of padded that lie within df's extent."""
    size = extent(df.select(*keys, "r", "c"), keys)
    sized = padded.join(size, list(keys)) if keys else padded.crossJoin(F.broadcast(size))
    return sized.where("r >= 0 AND c >= 0 AND r < _h AND c < _w").drop("_h", "_w")


def box_sums(df: DataFrame, values: dict[str, Column], h: int, keys: Sequence[str] = ()) -> DataFrame:
    """Adds for each name the sum of a column over the (2h+1)-square around each pixel."""
    for axis in ("c", "r"):
        w = along(axis, keys).rangeBetween(-h, h)
        df = df.withColumns({n: F.sum(v if axis == "c" else F.col(n)).over(w) for n, v in values.items()})
    return df


def uniform_filter(df: DataFrame, value: str, size: int = 5, keys: Sequence[str] = ()) -> DataFrame:
    """Adds box_mean and box_sq_mean of a value over a square, borders reflected."""
    padded = halo(df.select(*keys, "r", "c", F.col(value).cast("double").alias("_v")), size // 2, "reflect", keys)
    summed = inside(box_sums(padded, {"_s": F.col("_v"), "_q": F.col("_v") * F.col("_v")}, size // 2, keys), df, keys)
    n = float(size * size)
    return df.join(summed.select(*keys, "r", "c", (F.col("_s") / n).alias("box_mean"), (F.col("_q") / n).alias("box_sq_mean")), [*keys, "r", "c"])


def local_contrast(df: DataFrame, value: str, size: int = 5, keys: Sequence[str] = ()) -> DataFrame:
    """Adds contrast (value less its surroundings' mean) and local_std."""
    m = uniform_filter(df, value, size, keys)
    return m.select(*df.columns, (F.col(value) - F.col("box_mean")).alias("contrast"), F.sqrt(F.greatest(F.col("box_sq_mean") - F.col("box_mean") * F.col("box_mean"), F.lit(0.0))).alias("local_std"))


def texture(df: DataFrame, value: str, size: int = 11, keys: Sequence[str] = ()) -> DataFrame:
    """Adds texture: the coefficient of variation over a square, with a mean of at least 1."""
    m = uniform_filter(df, value, size, keys)
    spread = F.sqrt(F.greatest(F.col("box_sq_mean") - F.col("box_mean") * F.col("box_mean"), F.lit(0.0)))
    return m.select(*df.columns, (spread / F.greatest("box_mean", F.lit(1.0))).alias("texture"))


def peak_contrast(long: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(r, c, t, v) -> contrast and local_std at the date whose scene mean is greatest (the earliest of equals)."""
    means = long.groupBy(*keys, "t").agg(F.avg("v").alias("m"))
    best = means.groupBy(*keys).agg(F.max_by("t", F.struct("m", -F.col("t"))).alias("t"))
    peak = long.join(F.broadcast(best), [*keys, "t"])  # one row a scene
    return local_contrast(peak, "v", 5, keys)


def sobel(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Adds magnitude: the length of the 3x3 Sobel gradient, borders mirrored."""
    p = halo(df.select(*keys, "r", "c", F.col(value).cast("double").alias("_v")), 1, "mirror", keys)
    n = lambda x, axis, step: neighbour(x, axis, step, keys)
    p = p.withColumns({"_dx": n("_v", "c", 1) - n("_v", "c", -1), "_sx": n("_v", "c", 1) + 2 * F.col("_v") + n("_v", "c", -1)})
    p = p.withColumns({"_gx": n("_dx", "r", 1) + 2 * F.col("_dx") + n("_dx", "r", -1), "_gy": n("_sx", "r", 1) - n("_sx", "r", -1)})
    g = inside(p, df, keys).select(*keys, "r", "c", F.sqrt(F.col("_gx") * F.col("_gx") + F.col("_gy") * F.col("_gy")).alias("magnitude"))
    return df.join(g, [*keys, "r", "c"])


def spectral_edges(df: DataFrame, ndvi: str = "ndvi", crop: str = "crop", keys: Sequence[str] = ()) -> DataFrame:
    """Adds edge: crop pixels on a sharp step of NDVI that are not dense green themselves."""
    return sobel(df, ndvi, keys).withColumn("edge", (F.col("magnitude") > 0.22) & (F.col(ndvi) < 0.55) & F.col(crop))


def on_class_border(code: str = "code", keys: Sequence[str] = ()) -> Column:
    """Crop pixels beside a pixel of another crop; both sides are marked."""
    beside = [neighbour(code, axis, step, keys) for axis in ("r", "c") for step in (-1, 1)]
    other = [F.coalesce((x > 0) & (x != F.col(code)), F.lit(False)) for x in beside]
    return (F.col(code) > 0) & (other[0] | other[1] | other[2] | other[3])


def gradient_edges(df: DataFrame, code: str = "code", keys: Sequence[str] = ()) -> DataFrame:
    """Adds edge: whether a pixel lies on a class border."""
    return df.withColumn("edge", on_class_border(code, keys))


def outline(df: DataFrame, label: str, keys: Sequence[str] = ()) -> DataFrame:
    """Adds outline: pixels beside another label; the image's border is no neighbour."""
    beside = [neighbour(label, axis, step, keys) for axis in ("r", "c") for step in (-1, 1)]
    return df.withColumn("outline", F.greatest(*(F.coalesce(x != F.col(label), F.lit(False)) for x in beside)))


def opening_size(resolution: float, connectivity: int = 8, has_edges: bool = False) -> tuple[int, bool]:
    """(square side, cross?) of the opening at a resolution; side 1 means none."""
    if resolution >= 20:
        return (1, False) if has_edges else (3, True)
    k = max(3, round(18 / max(resolution, 1.0)))
    k = min(k + 1 - k % 2, 9)
    return (k, False) if connectivity == 8 else (3, True)


def opening(df: DataFrame, flag: str, side: int = 3, cross: bool = False, keys: Sequence[str] = ()) -> DataFrame:
    """Adds opened: erosion, then dilation, by a square or a cross; outside is background."""
    if side <= 1:
        return df.withColumn("opened", F.col(flag))
    h = side // 2
    on = F.col(flag).cast("int")
    if cross:
        near = lambda x: [F.coalesce(neighbour(x, a, s, keys), F.lit(0)) for a in ("r", "c") for s in (-1, 1)]
        out = df.withColumn("_on", on).withColumn("_core", F.least("_on", *near("_on")))
        return out.withColumn("opened", F.greatest("_core", *near("_core")) == 1).drop("_on", "_core")
    row, col = along("c", keys).rangeBetween(-h, h), along("r", keys).rangeBetween(-h, h)
    out = df.withColumn("_a", (F.sum(on).over(row) == side).cast("int")).withColumn("_core", (F.sum("_a").over(col) == side).cast("int"))
    out = out.withColumn("_b", F.max("_core").over(row)).withColumn("opened", F.max("_b").over(col) == 1)
    return out.drop("_a", "_core", "_b")


def slope(df: DataFrame, elevation: str = "elev", resolution: float = 30.0, keys: Sequence[str] = ()) -> DataFrame:
    """Adds slope in degrees: central differences, one-sided at the borders."""
    x = F.col(elevation).cast("double")

    def diff(axis: str) -> Column:
        a, b = neighbour(x, axis, -1, keys), neighbour(x, axis, 1, keys)
        return F.when(a.isNull() & b.isNull(), 0.0).when(a.isNull(), b - x).when(b.isNull(), x - a).otherwise((b - a) / 2) / resolution

    return df.withColumns({"_gy": diff("r"), "_gx": diff("c")}).withColumn("slope", F.degrees(F.atan(F.sqrt(F.col("_gx") * F.col("_gx") + F.col("_gy") * F.col("_gy"))))).drop("_gx", "_gy")


def terrain_veto(df: DataFrame, max_elevation: float = 1800, max_slope: float = 25, elevation: str = "elev", slope_col: str | None = None, resolution: float = 30.0, keys: Sequence[str] = ()) -> DataFrame:
    """Adds veto: too high, or too steep by the slope band if there is one, else by the elevation's slope."""
    if slope_col is None:
        df, slope_col = slope(df, elevation, resolution, keys), "slope"
    return df.withColumn("veto", F.coalesce((F.col(elevation) > max_elevation) | (F.col(slope_col) > max_slope), F.lit(False)))


def step_for(h: int, w: int, most: int = 1200) -> int:
    return max(1, max(h, w) // most)


def downsample(df: DataFrame, step: int) -> DataFrame:
    """Every step-th row and column."""
    return df.where((F.pmod("r", F.lit(step)) == 0) & (F.pmod("c", F.lit(step)) == 0))


def preview(df: DataFrame, value: str, step: int, keys: Sequence[str] = ()) -> DataFrame:
    """Means over step x step blocks, at block coordinates."""
    return df.groupBy(*keys, F.expr(f"CAST(r DIV {step} AS BIGINT)").alias("r"), F.expr(f"CAST(c DIV {step} AS BIGINT)").alias("c")).agg(F.avg(value).alias(value))


def percentile_stretch(df: DataFrame, value: str, low: float = 0.02, high: float = 0.98, epsilon: float = 0.0, keys: Sequence[str] = ()) -> DataFrame:
    """Adds stretched: the value between two percentiles of its scene as 0 to 1."""
    edges = df.groupBy(*keys).agg(F.percentile(value, F.lit(low)).alias("_lo"), F.percentile(value, F.lit(high)).alias("_hi"))
    both = df.join(edges, list(keys)) if keys else df.crossJoin(F.broadcast(edges))
    span = F.col("_hi") - F.col("_lo") + epsilon
    return both.withColumn("stretched", F.when(span > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col(value) - F.col("_lo")) / span))).otherwise(0.0)).drop("_lo", "_hi")


def resample_nearest(target: DataFrame, source: DataFrame, scale_r: float, scale_c: float, values: Sequence[str]) -> DataFrame:
    """Values of the source pixel that holds each target pixel's centre (scale: source pixels a target pixel)."""
    at = lambda x, s: F.floor((F.col(x) + 0.5) * s).cast("long")
    right = source.select(F.col("r").alias("_sr"), F.col("c").alias("_sc"), *values)
    return target.withColumn("_sr", at("r", scale_r)).withColumn("_sc", at("c", scale_c)).join(right, ["_sr", "_sc"], "left").drop("_sr", "_sc")


def resample_bilinear(target: DataFrame, source: DataFrame, scale_r: float, scale_c: float, value: str) -> DataFrame:
    """The value at each target pixel's centre between the four nearest source pixels, held at the borders."""
    size = F.broadcast(extent(source))
    pos = lambda x, s: (F.col(x) + 0.5) * s - 0.5
    base = target.crossJoin(size).withColumn("_y", F.greatest(F.lit(0.0), F.least(pos("r", scale_r), F.col("_h") - 1.0))).withColumn("_x", F.greatest(F.lit(0.0), F.least(pos("c", scale_c), F.col("_w") - 1.0)))
    y0, x0 = F.floor("_y"), F.floor("_x")
    corner = lambda dy, dx: F.struct(F.least(y0 + dy, F.col("_h") - 1).cast("long").alias("sr"), F.least(x0 + dx, F.col("_w") - 1).cast("long").alias("sc"), ((F.col("_y") - y0 if dy else 1 - F.col("_y") + y0) * (F.col("_x") - x0 if dx else 1 - F.col("_x") + x0)).alias("k"))
    four = base.withColumn("_q", F.explode(F.array(*(corner(a, b) for a in (0, 1) for b in (0, 1))))).where(F.col("_q.k") > 0)
    right = source.select(F.col("r").alias("_sr"), F.col("c").alias("_sc"), F.col(value).alias("_sv"))
    met = four.join(right, (F.col("_q.sr") == F.col("_sr")) & (F.col("_q.sc") == F.col("_sc")))
    return met.groupBy(*target.columns).agg(F.sum(F.col("_sv") * F.col("_q.k")).alias(value))


def source_pixel(target_transform: Sequence[float], source_transform: Sequence[float], zone: int | None = None, northern: bool = True) -> Column:
    """struct(row, col), as exact numbers, in a source raster of each target pixel's centre (columns r, c).

    Transforms are (step x, 0, x0, 0, step y, y0). zone: the target lies in that UTM zone and the source in degrees.
    """
    a, _, x0, _, e, y0 = target_transform
    x, y = F.lit(float(x0)) + (F.col("c") + 0.5) * a, F.lit(float(y0)) + (F.col("r") + 0.5) * e
    sa, _, sx, _, se, sy = source_transform
    place = lambda px, py: F.struct(((py - sy) / se).alias("row"), ((px - sx) / sa).alias("col"))
    if zone is None:
        return place(x, y)
    return geo.let(geo.utm_to_wgs84(x, y, F.lit(zone), F.lit(northern)), lambda g: place(g["lon"], g["lat"]))


def reproject_nearest(target: DataFrame, source: DataFrame, target_transform: Sequence[float], source_transform: Sequence[float], values: Sequence[str], zone: int | None = None, northern: bool = True) -> DataFrame:
    """Values of the source pixel under each target pixel's centre; null outside the source. One equi-join."""
    right = source.select(F.col("r").alias("_sr"), F.col("c").alias("_sc"), *values)
    at = target.withColumn("_p", source_pixel(target_transform, source_transform, zone, northern))
    return at.withColumn("_sr", F.floor("_p.row")).withColumn("_sc", F.floor("_p.col")).join(right, ["_sr", "_sc"], "left").drop("_sr", "_sc", "_p")


def reproject_bilinear(target: DataFrame, source: DataFrame, target_transform: Sequence[float], source_transform: Sequence[float], value: str, zone: int | None = None, northern: bool = True) -> DataFrame:
    """The value at each target pixel's centre between the four nearest source pixels, held at the borders; null outside."""
    size = F.broadcast(extent(source))  # one row
    at = target.withColumn("_p", source_pixel(target_transform, source_transform, zone, northern)).crossJoin(size)
    inside = at.where("_p.row >= 0 AND _p.row < _h AND _p.col >= 0 AND _p.col < _w")
    held = lambda p, n: F.greatest(F.lit(0.0), F.least(F.col(p) - 0.5, F.col(n) - 1.0))
    placed = inside.withColumn("_y", held("_p.row", "_h")).withColumn("_x", held("_p.col", "_w"))
    y0, x0 = F.floor("_y"), F.floor("_x")
    corner = lambda dy, dx: F.struct(F.least(y0 + dy, F.col("_h") - 1).cast("long").alias("sr"), F.least(x0 + dx, F.col("_w") - 1).cast("long").alias("sc"), ((F.col("_y") - y0 if dy else 1 - F.col("_y") + y0) * (F.col("_x") - x0 if dx else 1 - F.col("_x") + x0)).alias("k"))
    four = placed.withColumn("_q", F.explode(F.array(*(corner(i, j) for i in (0, 1) for j in (0, 1))))).where("_q.k > 0")
    right = source.select(F.col("r").alias("_sr"), F.col("c").alias("_sc"), F.col(value).alias("_sv"))
    met = four.join(right, (F.col("_q.sr") == F.col("_sr")) & (F.col("_q.sc") == F.col("_sc"))).groupBy("r", "c").agg(F.sum(F.col("_sv") * F.col("_q.k")).alias(value))
    return target.join(met, ["r", "c"], "left")
