"""Parcels from class maps: clean mask, connected components, holes, subdivision, filter, rank and zonal statistics."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from furrow import session
from furrow.functions import grading, units
from furrow.operators import raster
from furrow.operators.components import components

ROW = 1 << 31  #: a run's node is r * ROW + its first column
SPAN = 256  #: columns of a bucket in which runs of neighbouring rows meet


def runs(mask: DataFrame) -> DataFrame:
    """Mask pixels (r, c) -> horizontal runs (node, r, a, b)."""
    island = F.col("c") - F.row_number().over(raster.along("c"))
    return mask.select("r", "c", island.alias("_g")).groupBy("r", "_g").agg(F.min("c").alias("a"), F.max("c").alias("b")).select((F.col("r").cast("long") * ROW + F.col("a")).alias("node"), "r", "a", "b")


def label(mask: DataFrame, connectivity: int = 8) -> DataFrame:
    """Mask pixels (r, c) -> (r, c, comp). comp names the component's first pixel, so components are ordered as a raster scan meets them."""
    reach = 1 if connectivity == 8 else 0
    found = runs(mask.select("r", "c").distinct())
    spread = lambda lo, hi: F.explode(F.sequence(F.floor((F.col("a") - lo) / SPAN), F.floor((F.col("b") + hi) / SPAN)))
    up = found.select(F.col("node").alias("u"), (F.col("r") + 1).alias("row"), "a", "b", spread(reach, reach).alias("k"))
    down = found.select(F.col("node").alias("v"), F.col("r").alias("row"), F.col("a").alias("a2"), F.col("b").alias("b2"), spread(0, 0).alias("k"))
    links = up.join(down, ["row", "k"]).where((F.col("a") <= F.col("b2") + reach) & (F.col("a2") <= F.col("b") + reach)).select("u", "v")
    named = components(links, "u", "v")
    whole = found.join(named, "node", "left").select("r", "a", "b", F.coalesce("component", "node").alias("comp"))
    return whole.select("r", F.explode(F.sequence("a", "b")).alias("c"), "comp")


def fill_holes(grid: DataFrame, flag: str, most: int = 25) -> DataFrame:
    """Adds filled: flag, or a hole of at most `most` pixels (4-connected, not at the image's border). grid holds every pixel."""
    holes = label(grid.where(~F.col(flag)), 4)
    sized = raster.with_extent(grid.select("r", "c")).select("_h", "_w").limit(1)
    marked = holes.crossJoin(F.broadcast(sized)).withColumn("_edge", (F.col("r") == 0) | (F.col("c") == 0) | (F.col("r") == F.col("_h") - 1) | (F.col("c") == F.col("_w") - 1))
    small = marked.groupBy("comp").agg(F.count("*").alias("n"), F.max("_edge").alias("edge")).where(~F.col("edge") & (F.col("n") <= most)).select("comp")
    fill = holes.join(small, "comp", "left_semi").select("r", "c", F.lit(True).alias("_fill"))
    return grid.join(fill, ["r", "c"], "left").withColumn("filled", F.col(flag) | F.coalesce("_fill", F.lit(False))).drop("_fill")


def superpixels(df: DataFrame, value: str, side: int = 10) -> DataFrame:
    """Adds segment: grid cells whose pixels move to the neighbouring cell centre nearest in place and value (one round of SLIC).

    Centres are means of place and value; compactness weighs the two as SLIC does. A pixel looks at the nine cells around it.
    """
    cell = df.withColumn("_i", F.expr(f"CAST(r DIV {side} AS BIGINT)")).withColumn("_j", F.expr(f"CAST(c DIV {side} AS BIGINT)"))
    centres = cell.groupBy("_i", "_j").agg(F.avg("r").alias("_y"), F.avg("c").alias("_x"), F.avg(value).alias("_m")).select(F.col("_i").alias("_ci"), F.col("_j").alias("_cj"), "_y", "_x", "_m")
    nine = F.explode(F.array(*(F.struct((F.col("_i") + a).alias("i"), (F.col("_j") + b).alias("j")) for a in (-1, 0, 1) for b in (-1, 0, 1))))
    met = cell.withColumn("_n", nine).join(centres, (F.col("_n.i") == F.col("_ci")) & (F.col("_n.j") == F.col("_cj")))
    d = ((F.col("r") - F.col("_y")) * (F.col("r") - F.col("_y")) + (F.col("c") - F.col("_x")) * (F.col("c") - F.col("_x"))) * (25.0 / side / side) + (F.col(value) - F.col("_m")) * (F.col(value) - F.col("_m"))
    best = met.groupBy(*df.columns).agg(F.min(F.struct(d.alias("d"), "_ci", "_cj")).alias("b"))
    return best.select(*df.columns, (F.col("b._ci") * ROW + F.col("b._cj")).alias("segment"))


def superpixel_majority(df: DataFrame, segment: str = "segment", crop: str = "crop", share: float = 0.75) -> DataFrame:
    """Adds kept: the pixel's segment is crop by more than `share`."""
    part = df.groupBy(segment).agg(F.avg(F.col(crop).cast("int")).alias("_share"))
    return df.join(part, segment).withColumn("kept", F.col("_share") > share).drop("_share")


def clean_mask(grid: DataFrame, resolution: float = 10.0, connectivity: int = 8, erode: bool = True, edge: str | None = None, fill: bool = True, code: str = "code", crop: str | None = None) -> DataFrame:
    """Crop pixels (by a flag, else by code) without class borders and physical edges, opened, small holes filled: adds mask."""
    physical = F.coalesce(F.col(edge), F.lit(False)) if edge else F.lit(False)
    cut = grid.withColumn("_border", raster.on_class_border(code)).withColumn("_on", (F.col(crop) if crop else F.col(code) > 0) & ~F.col("_border") & ~physical).drop("_border")
    side, cross = raster.opening_size(resolution, connectivity, edge is not None) if erode else (1, False)
    opened = raster.opening(cut, "_on", side, cross)
    return fill_holes(opened, "opened").withColumn("mask", F.col("filled")).drop("_on", "opened", "filled") if fill else opened.withColumn("mask", F.col("opened")).drop("_on", "opened")


# ---- subdivision of oversized components: each is one group, a few, and worked on as an array ----


def _distance(mask: np.ndarray) -> np.ndarray:
    """Exact Euclidean distance of each mask pixel to the nearest pixel outside it (beyond the array is outside)."""
    m = np.pad(mask, 1)
    h, w = m.shape
    far = h + w
    gap = np.where(m, far, 0).astype(np.int64)
    for i in range(1, h):
        gap[i] = np.minimum(gap[i], gap[i - 1] + 1)
    for i in range(h - 2, -1, -1):
        gap[i] = np.minimum(gap[i], gap[i + 1] + 1)
    away = (np.arange(w)[:, None] - np.arange(w)[None]) ** 2
    out = np.stack([(away + (g * g)[None]).min(1) for g in gap])
    return np.sqrt(out)[1:-1, 1:-1]


def _widest(x: np.ndarray, win: int) -> np.ndarray:
    """Maximum over a win x win square."""
    h = win // 2
    for axis in (0, 1):
        pad = [(h, h) if a == axis else (0, 0) for a in (0, 1)]
        p = np.pad(x, pad, constant_values=-1)
        x = np.max(np.stack([np.take(p, range(i, i + x.shape[axis]), axis) for i in range(win)]), 0)
    return x


def _groups(mask: np.ndarray) -> np.ndarray:
    """8-connected groups, numbered from 1 in scan order."""
    out = np.where(mask, np.arange(1, mask.size + 1).reshape(mask.shape), 0)
    while True:
        p = np.pad(np.where(mask, out, mask.size + 1), 1, constant_values=mask.size + 1)
        low = np.min(np.stack([p[1 + a : 1 + a + mask.shape[0], 1 + b : 1 + b + mask.shape[1]] for a in (-1, 0, 1) for b in (-1, 0, 1)]), 0)
        new = np.where(mask, np.minimum(out, low), 0)
        if (new == out).all():
            return np.searchsorted(np.unique(out[out > 0]), out) * (out > 0) + (out > 0)
        out = new


def split_parcel(mask: np.ndarray, max_area: float, resolution: float, spacing: float) -> np.ndarray:
    """A mask cut along the lines between its wide places: numbers from 1, or all 1 where there is one such place."""
    whole = mask.astype(np.int64)
    if mask.sum() * resolution * resolution <= max_area:
        return whole
    d = _distance(mask)
    if d.max() < 2:
        return whole
    win = max(3, round(spacing / max(resolution, 1.0)))
    win += 1 - win % 2
    peaks = mask & (d == _widest(d, win)) & (d >= max(1.5, min(2.5, 0.15 * d.max())))
    seeds = np.zeros_like(mask)
    groups = _groups(peaks)
    for g in range(1, groups.max() + 1):
        at = np.argwhere(groups == g)
        y, x = (int(v) for v in (at - at.min(0)).mean(0))
        y, x = y + at[:, 0].min(), x + at[:, 1].min()
        seeds[y, x] |= mask[y, x]
    marks = _groups(seeds)
    if marks.max() <= 1:
        return whole
    points = np.argwhere(marks > 0)
    number = marks[points[:, 0], points[:, 1]]
    pixels = np.argwhere(mask)
    near = np.concatenate([((p[:, None] - points[None]) ** 2).sum(2).argmin(1) for p in np.array_split(pixels, max(1, len(pixels) * len(points) // 4_000_000 + 1))])
    out = np.zeros_like(whole)
    out[pixels[:, 0], pixels[:, 1]] = number[near]
    return out


def subdivide(labelled: DataFrame, max_area: float, resolution: float = 10.0) -> DataFrame:
    """Components over max_area are cut (parts over 3 times that once more, finer): adds part, 1 for all that stays whole."""
    first, second = max(180.0, 5 * resolution), max(100.0, 3.5 * resolution)

    def cut(pdf: pd.DataFrame) -> pd.DataFrame:
        r, c = (pdf[x].to_numpy() - pdf[x].min() for x in ("r", "c"))
        mask = np.zeros((r.max() + 1, c.max() + 1), bool)
        mask[r, c] = True
        marks = split_parcel(mask, max_area, resolution, first)
        out, n = np.zeros_like(marks), 0
        for m in np.unique(marks[marks > 0]):
            own = marks == m
            inner = split_parcel(own, max_area, resolution, second) if marks.max() > 1 and own.sum() * resolution**2 > 3 * max_area else own.astype(np.int64)
            for k in np.unique(inner[inner > 0]):
                n += 1
                out[inner == k] = n
        return pdf.assign(part=out[r, c])

    sizes = labelled.groupBy("comp").agg(F.count("*").alias("_n"))
    sized = labelled.select("r", "c", "comp").join(sizes, "comp")
    large = F.col("_n") * F.lit(resolution * resolution) > max_area
    kept = sized.where(~large).select("r", "c", "comp", F.lit(1).cast("long").alias("part"))
    kinds = {c: labelled.schema[c].dataType.simpleString() for c in ("r", "c")}
    parts = sized.where(large).select("r", "c", "comp").groupBy("comp").applyInPandas(cut, f"r {kinds['r']}, c {kinds['c']}, comp long, part long")
    return kept.unionByName(parts)


def numbered(df: DataFrame, *order: Column | str) -> DataFrame:
    """Adds parcel_no from 1 in a total order of all rows: tasks sort ranges, and each counts on from those before it."""
    placed = session.written(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "ranks").withColumn("_task", F.shiftright("_at", 33))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    begins = placed.groupBy("_task").agg(F.count("*").alias("_n")).select("_task", before.alias("_before"))  # a row a task
    number = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return placed.join(F.broadcast(begins), "_task").withColumn("parcel_no", number.cast("int")).drop("_at", "_task", "_before")


def filter_rank(sizes: DataFrame, resolution: float = 10.0, min_area: float = 200.0, max_area: float | None = None, most: int | None = 500, keys: tuple[str, ...] = ("comp",)) -> DataFrame:
    """Components in the area range (all, if none is), largest first, at most `most` (None: every one): adds parcel_no from 1."""
    area = F.col("pixels") * F.lit(resolution * resolution)
    fits = area >= max(min_area, 2 * resolution * resolution)
    if max_area is not None:
        fits = fits & (area <= max_area)
    any_fits = sizes.agg(F.max(fits).alias("_any"))
    kept = sizes.withColumn("_fits", fits).crossJoin(F.broadcast(any_fits)).where("_fits OR NOT _any").drop("_fits", "_any")
    if most is None:
        return numbered(kept, F.desc("pixels"), *keys)
    top = kept.orderBy(F.desc("pixels"), *keys).limit(most)  # bounded before the ranking window
    return top.withColumn("parcel_no", F.row_number().over(Window.orderBy(F.desc("pixels"), *keys)))


def zonal_stats(pixels: DataFrame, resolution: float = 10.0, key: str = "comp", code: str = "code", conf: str = "conf") -> DataFrame:
    """One row a zone: size, areas, dominant crop, its share, mean confidence, centre. Ties go to the smaller code.

    Confidences are added in scan order: in any other the last bit differs, and with it how a mean on a half is rounded.
    """
    so_far = Window.partitionBy(key, code).orderBy("r", "c").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # streams, and spills
    added = pixels.select(key, code, "r", "c", F.count("*").over(so_far).alias("n"), F.sum(conf).over(so_far).alias("s"))
    cells = added.groupBy(key, code).agg(F.max("n").alias("n"), F.max_by("s", "n").alias("s"), F.sum("r").alias("rs"), F.sum("c").alias("cs"))
    crop = F.col(code) > 0
    by = cells.groupBy(key).agg(
        F.sum("n").alias("pixels"), F.max_by(F.when(crop, F.col(code)), F.when(crop, F.struct("n", -F.col(code)))).alias("top"), F.max(F.when(crop, F.col("n"))).alias("top_n"),
        F.max_by(code, F.struct("n", -F.col(code))).alias("any_top"), F.sum(F.when(crop, F.col("n"))).alias("crop_n"), F.sum("s").alias("s"), F.sum("rs").alias("rs"), F.sum("cs").alias("cs"),
    )
    area = F.col("pixels") * F.lit(resolution * resolution)
    return by.select(
        key, "pixels", F.round(area, 1).alias("area_m2"), F.round(units.sqm_to_mu(area), 2).alias("area_mu"), F.round(units.sqm_to_ha(area), 4).alias("area_ha"),
        F.coalesce("top", "any_top").alias("crop_code"), F.round(F.coalesce(F.col("top_n") / F.col("crop_n"), F.lit(1.0)), 3).alias("purity"),
        F.round(F.col("s") / F.col("pixels"), 3).alias("confidence"), F.round(F.col("rs") / F.col("pixels"), 2).alias("centroid_row"), F.round(F.col("cs") / F.col("pixels"), 2).alias("centroid_col"),
    )


def bounding_boxes(pixels: DataFrame, key: str = "comp") -> DataFrame:
    return pixels.groupBy(key).agg(F.min("r").alias("r0"), F.max("r").alias("r1"), F.min("c").alias("c0"), F.max("c").alias("c1"), F.count("*").alias("pixels"))


def segment(grid: DataFrame, resolution: float = 10.0, min_area: float = 200.0, max_area: float = 500_000.0, most: int | None = 500, connectivity: int = 8, erode: bool = True, subdivided: bool = True, discard: bool = False, edge: str | None = None, fill: bool = True, crop: str | None = None) -> tuple[DataFrame, DataFrame]:
    """grid (r, c, code, conf) -> (pixels with parcel_no, parcels with all attributes)."""
    mask = clean_mask(grid, resolution, connectivity, erode, edge, fill, crop=crop)
    labelled = label(mask.where("mask"), connectivity)
    parts = subdivide(labelled, max_area, resolution) if subdivided else labelled.withColumn("part", F.lit(1).cast("long"))
    sizes = parts.groupBy("comp", "part").agg(F.count("*").alias("pixels"))
    ranked = filter_rank(sizes, resolution, min_area, max_area if discard else None, most, ("comp", "part")).select("comp", "part", "parcel_no")
    pixels = parts.join(ranked if most is None else F.broadcast(ranked), ["comp", "part"]).join(grid.select("r", "c", "code", "conf"), ["r", "c"])  # broadcast: at most `most` rows
    stats = zonal_stats(pixels, resolution, "parcel_no").withColumn("parcel_id", grading.parcel_name(F.col("parcel_no")))
    return pixels.select("r", "c", "parcel_no", "code", "conf"), stats
