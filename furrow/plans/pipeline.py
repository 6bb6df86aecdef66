"""The whole chain: scenes -> series -> features -> classes -> fusion -> parcels -> polygons -> statistics -> files."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow import session
from furrow.functions import series
from furrow.operators import classify, estimate, parcels, polygons, prior, raster, rollup, sinks, transition
from furrow.plans import report
from furrow.sources import synthetic, tables, tiff
from furrow.sources.scene import Scene, under

#: Features that the classifier is given besides the series itself, and those of scenes with all four channels. Contrast to the
#: surroundings is not among them: training points have no surroundings, so no tree could split on it.
FEATURES = ("max", "min", "range", "std", "grad_max", "grad_min", "grad_abs", "slope_early", "slope_mid", "slope_late", "dip", "rebound", "paddy", "amp1", "phase1")
CHANNELS = ("lswi", "gcvi", "cv")
CHANNEL_FEATURES = ("lswi_max", "lswi_min", "lswi_mean", "lswi_std", "lswi_gap", "gcvi_max", "gcvi_mean", "cv_mean", "cv_max", "amp2", "phase2")


def featured(df: DataFrame, ndvi: str, n: int, smooth: bool = False) -> tuple[DataFrame, list[str]]:
    """Adds t0..t<n-1> and the named features of a series column, and of lswi, gcvi and cv where df has them; gives the columns in order."""
    v = series.smooth(F.col(ndvi), n) if smooth else series.fill_gaps(F.col(ndvi))
    others = [c for c in CHANNELS if c in df.columns]
    # written between the steps, so that no later expression repeats an earlier one
    base = session.written(df.withColumns({ndvi: v} | {c: series.fill_gaps(F.col(c)) for c in others}), "series")
    all_features = series.features(F.col(ndvi), n, **{c: F.col(c) for c in others})
    names = FEATURES + (CHANNEL_FEATURES if others else ())
    columns = {f"t{i}": F.get(F.col(ndvi), F.lit(i)) for i in range(n)} | {f"f_{k}": all_features[k] for k in names}
    return session.written(base.withColumns(columns), "features"), list(columns)


def aligned(points: DataFrame, days: list[int], classes: int, seed: int) -> DataFrame:
    """Training points (doy_<n> columns) with their series on the scenes' days: adds ndvi."""
    own = tables.day_columns(points)
    v = F.array(*(F.col(c).cast("double") for c in own))
    if synthetic.short_season(days):
        return points.withColumn("ndvi", synthetic.snapshot_align(points, v, days, classes, len(days), seed))
    if [int(c[4:]) for c in own] == days:
        return points.withColumn("ndvi", v)
    return points.withColumn("ndvi", series.resample(F.array(*(F.lit(int(c[4:])) for c in own)), v, [float(d) for d in days]))


def train(points: DataFrame, config: dict, days: list[int], channels: bool = False) -> classify.Scorer:
    """A scorer from training points, with the background threshold found by cross-validation."""
    c = config["classification"]
    s = aligned(points, days, len(config["legend"]), c["random_state"])
    if channels:
        made = synthetic.channels(F.col("ndvi"), F.col("crop_name"), F.col("label") > 0, c["random_state"])
        s = session.written(s.withColumn("_made", made), "points").withColumns({k: F.col(f"_made.{k}") for k in CHANNELS}).drop("_made")
    x, columns = featured(s, "ndvi", len(days))
    oof = classify.cross_validate(x, columns, "point_id", c["model_type"], c["n_estimators"], c["max_depth"], seed=c["random_state"])
    scorer = classify.fit(x, columns, c["model_type"], c["n_estimators"], c["max_depth"], c["random_state"])
    if 0 in scorer.labels:
        scorer.threshold = classify.threshold_search(oof.withColumn("p_bg", F.get("probs", F.lit(scorer.labels.index(0))))).first()["th"]
    return scorer


def with_prior(spark: SparkSession, pixels: DataFrame, config: dict, scene: Scene, spatial: dict) -> DataFrame:
    """Adds prior, a crop probability of the land-cover raster at prior_fusion.path or of the series, and terrain, the elevation's veto."""
    p, t = config["prior_fusion"], config["terrain"]
    if p["path"]:
        found = under(spark, pixels, p["path"], scene, spatial, ["_cover"]).withColumn("_cover", F.coalesce("_cover", F.lit(0.0)))
        found = found.crossJoin(F.broadcast(found.agg(F.max("_cover").alias("_most"))))  # one row
        out = found.withColumn("prior", prior.landcover_prior(F.col("_cover"), p["provider"], F.col("_most"))).drop("_cover", "_most")
    else:
        out = pixels.withColumn("prior", prior.builtin_prior(F.col("ndvi"), F.col("lswi") if "lswi" in pixels.columns else None))
    if not (t["enable"] and t["path"]):
        return session.written(out.withColumn("terrain", F.lit(False)), "prior")
    ground = under(spark, pixels.select("r", "c"), t["path"], scene, spatial, ["elev", "slope"], smooth=True)
    vetoed = raster.terrain_veto(ground, t["max_elevation_m"], t["max_slope_deg"], slope_col="slope" if "slope" in ground.columns else None, resolution=spatial["resolution_meters"])
    high = out.join(vetoed.select("r", "c", F.col("veto").alias("terrain")), ["r", "c"])
    return session.written(high.withColumn("prior", F.when(F.col("terrain"), 0.0).otherwise(F.col("prior"))), "prior")


def with_mined(pixels: DataFrame, points: DataFrame, days: list[int], most: int, seed: int) -> DataFrame:
    """Training points and at most `most` crop and other pixels that prior and series agree on, all on the scenes' days."""
    named = pixels.withColumn("pixel", F.concat_ws(":", "r", "c"))
    mined = prior.mine(prior.pseudo_labels(named, terrain="terrain"), most, seed)
    table = mined.select(F.col("pseudo").alias("label"), F.col("kind").alias("crop_name"), *(F.get("ndvi", F.lit(i)).alias(f"doy_{d}") for i, d in enumerate(days)), "pixel")
    return prior.merge_samples(points, table.withColumn("point_id", F.concat(F.lit("MINED_"), "pixel")).drop("pixel"), days)


@dataclass
class Result:
    pixels: DataFrame
    parcels: DataFrame
    acreage: DataFrame
    matrix: DataFrame
    plan: DataFrame
    files: dict[str, str]


def run(spark: SparkSession, scene: DataFrame | Scene, config: dict, out: str | None = None, points: DataFrame | None = None, sample: DataFrame | None = None, late: DataFrame | None = None) -> Result:
    """Scenes (`sources.scene.opened`, or pixels r, c and an ndvi series of the eight usual dates) to statistics; with `out`, also to
    files there. late: (r, c, code) of another year."""
    session.ship(spark)
    legend, seg, seed = config["legend"], config["segmentation"], config["classification"]["random_state"]
    if isinstance(scene, DataFrame):
        step, (x0, y0) = config["spatial"]["resolution_meters"], config["spatial"]["origin"]
        scene, spatial = Scene(scene.select("r", "c", "ndvi"), list(synthetic.DAYS), (step, 0.0, x0, 0.0, -step, y0)), config["spatial"] | {"degrees": None}
    else:
        spatial = scene.spatial(config["spatial"])
    days, n, step = scene.days, len(scene.days), spatial["resolution_meters"]
    channels = "lswi" in scene.pixels.columns
    points = points if points is not None else synthetic.training_points(spark, legend, 50, seed)
    pixels, _ = featured(scene.pixels, "ndvi", n, config["time_series"]["apply_temporal_smoothing"])
    p = config["prior_fusion"]
    if p["enable"]:
        pixels = with_prior(spark, pixels, config, scene, spatial)
        if p["mined_samples"]:
            points = session.written(with_mined(pixels, points, days, p["mined_samples"], seed), "samples")
    scorer = train(points, config, days, channels)
    scored = classify.score(pixels, scorer, "ndvi", n, cv_mean="f_cv_mean" if channels else None)
    scored = scored.withColumn("peak", F.get("ndvi", F.lit(n // 2 if n > 1 else 0)))
    if p["enable"]:
        fused = scored.withColumn("conf", prior.fuse(F.col("crop_prob"), F.col("prior"), p["weight"], bool(p["path"]), p["hard_veto"], F.col("terrain")))
        scored = fused.withColumn("code", prior.final_code(F.col("conf"), F.col("code"), threshold=p["threshold"]))
    else:
        scored = scored.withColumn("conf", F.col("crop_prob"))
    grid = session.written(scored.select("r", "c", "code", "conf", "peak"), "classified")
    cut, edge = grid, None
    if channels:  # roads and ditches show in the reflectances of the middle date
        cut, edge = session.written(raster.spectral_edges(grid.withColumn("crop", F.col("code") > 0), "peak", "crop"), "edges"), "edge"
    crop = None
    if seg["enable_obia"]:  # superpixels of about 1,000 square metres that are mostly crop are fields as a whole
        side = max(3, round(max(10.0, 1000 / step**2) ** 0.5))
        cut = cut.withColumn("crop", (F.col("code") > 0) & ~F.coalesce(F.col(edge), F.lit(False)) if edge else F.col("code") > 0)
        cut, crop = session.written(parcels.superpixel_majority(session.written(parcels.superpixels(cut, "peak", side), "superpixels")), "majority"), "kept"
    marked, stats = parcels.segment(cut, step, seg["min_parcel_area_m2"], seg["max_parcel_area_m2"], seg["max_export_parcels"], seg["connectivity"], seg["apply_erosion"], seg["subdivide_oversized"], seg["discard_oversized"], edge, seg["fill_internal_holes"], crop)
    marked = session.written(marked, "parcel-pixels")
    x0, y0 = spatial["origin"]
    named = polygons.attributes(stats, polygons.rings(marked), estimate.legend_table(spark, legend), x0, y0, step, spatial["utm_zone"], spatial["northern"], spatial["degrees"])
    named = session.written(named, "parcels")
    sample = sample if sample is not None else synthetic.validation_sample(grid, sorted(legend))
    acreage = session.written(estimate.acreage_report(grid, sample, legend, step, draws=config["unbiased_estimation"]["n_bootstrap"]), "acreage")
    weights, cells = estimate.prepare(grid, sample, sorted(legend))
    matrix = estimate.error_matrix_table(cells, sorted(legend))
    plan = estimate.neyman(weights, legend, resolution=step)
    files = {}
    if out:
        os.makedirs(out, exist_ok=True)
        sinks.clean_folder(out)
        files = {k: os.path.join(out, k) for k in ("parcels.geojson", "parcels.csv", "provinces.csv", "acreage.csv", "error_matrix.csv", "sample_plan.csv", "briefing.html", "map.html")}
        shapes = polygons.features(named)
        sinks.write_geojson(shapes, files["parcels.geojson"])
        flat = named.drop("outline")
        for name, df in (("parcels.csv", flat.orderBy("parcel_no")), ("provinces.csv", rollup.province_rollup(flat)), ("acreage.csv", acreage.orderBy("code")), ("error_matrix.csv", matrix), ("sample_plan.csv", plan.orderBy("code"))):
            sinks.write_csv_bom(df, files[name])
        size = raster.extent(grid).first()
        block = config["streaming"]["block_size"]
        files["classes.tif"] = os.path.join(out, "classes.tif")
        epsg = scene.epsg or (32600 if spatial["northern"] else 32700) + spatial["utm_zone"]
        tiff.write_pyramid(session.written(tiff.class_tiles(grid, block), "tiles"), files["classes.tif"], size["_h"], size["_w"], scene.transform, epsg, block)
        rotation = None
        if late is not None:
            matrix_of = session.written(transition.transition_matrix(transition.pair(grid, late), sorted(legend), step), "transitions")
            rotation = transition.compliance(matrix_of, legend, resolution=step)
            for name, df in (("transitions.csv", matrix_of.orderBy("early", "late")), ("rotation.csv", rotation)):
                files[name] = os.path.join(out, name)
                sinks.write_csv_bom(df, files[name])
        for name, page in (("briefing.html", report.briefing(acreage, flat, rotation, matrix, plan)), ("map.html", report.map_page(shapes, flat))):
            with open(files[name], "w", encoding="utf-8") as f:
                f.write(page)
    return Result(marked, named, acreage, matrix, plan, files)
