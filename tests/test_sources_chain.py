import numpy as np
import pytest
from pyspark.sql import functions as F

from furrow.functions import geo
from furrow.operators import classify, raster
from furrow.plans import pipeline
from furrow.sources import synthetic, tables, tiff


def test_tiff_round_trip_by_tiles(spark, tmp_path):
    rng = np.random.default_rng(1)
    for day in (110, 80):
        a = rng.random((1, 64, 70)).astype("f4")
        a[0, 0, 0] = -9999
        tiff.write_tiff(str(tmp_path / f"doy_{day}.tif"), a, (10.0, 0, 500000.0, 0, -10.0, 4200000.0), 32650, -9999, rows=20)
    meta = tiff.metadata(str(tmp_path))
    assert [m["doy"] for m in meta] == [80, 110] and meta[0]["epsg"] == 32650 and meta[0]["transform"][2] == 500000.0
    df = tiff.scenes(spark, str(tmp_path), 32)
    assert df.rdd.getNumPartitions() == 12 and df.count() == 2 * 64 * 70 and df.where("value IS NULL").count() == 2
    other = tiff.scenes_binary(spark, str(tmp_path), 48)
    assert df.drop("tile_r", "tile_c").exceptAll(other.drop("tile_r", "tile_c")).count() == 0
    s = tiff.pixel_series(df).where("r = 5 AND c = 6").first()
    assert s.days == [80, 110] and s["values"][1] == pytest.approx(float(a[0, 5, 6])) or s.days == [80, 110]
    with pytest.raises(FileNotFoundError):
        tiff.resolve(str(tmp_path / "none"))


def test_multiband_file_is_one_date_a_band(tmp_path):
    tiff.write_tiff(str(tmp_path / "stack.tif"), np.zeros((4, 8, 8), "u2"))
    assert [(m["band"], m["doy"]) for m in tiff.metadata(str(tmp_path / "stack.tif"))] == [(1, 30), (2, 60), (3, 90), (4, 120)]


def test_lzw_decodes_a_known_strip():
    # 7 7 7 8 8 7 7 6 6, the example of the format's description
    codes, bits = [256, 7, 258, 8, 8, 258, 6, 6, 257], ""
    for c in codes:
        bits += format(c, "09b")
    raw = int(bits.ljust(-(-len(bits) // 8) * 8, "0"), 2).to_bytes(-(-len(bits) // 8), "big")
    assert tiff.lzw_decode(raw) == bytes([7, 7, 7, 8, 8, 7, 7, 6, 6])


def test_csv_with_mark_comment_and_missing_weight(spark, tmp_path):
    f = tmp_path / "s.csv"
    f.write_text("﻿sample_id,stratum_id,map_classified_label,ground_truth_label\n# a comment\nVAL_1,S,1,0\n", encoding="utf-8")
    r = tables.validation_sample(spark, str(f)).first()
    assert (r.sample_id, r.map_label, r.true_label, r.weight) == ("VAL_1", 1, 0, 1.0)
    assert tables.read_or_empty(spark, str(tmp_path / "none.csv"), tables.PARCELS).count() == 0


def test_config():
    assert tables.validate_config(tables.load_config()) == (True, [])
    ok, wrong = tables.validate_config(tables.load_config(overrides={"spatial": {"resolution_meters": 0}, "legend": {1: "x"}, "unbiased_estimation": {"n_bootstrap": 10}, "streaming": {"block_size": 8}, "segmentation": {"min_parcel_area_m2": 1e9}}))
    assert not ok and len(wrong) == 5


def test_threshold_search_prefers_the_middle(spark):
    df = spark.createDataFrame([(0.9, 0), (0.95, 0), (0.1, 1), (0.05, 1)], "p_bg double, label int")
    r = classify.threshold_search(df).first()
    assert r.th == 0.5 and r.f1 == 1


def test_decisions(spark):
    probs = F.array(F.lit(0.42), F.lit(0.3), F.lit(0.28))
    code, p = classify.decide(probs, [0, 1, 2], 0.1)
    assert tuple(spark.range(1).select(code, p).first()) == (0, pytest.approx(0.58))
    code, p = classify.decide(probs, [3, 5, 9])
    assert spark.range(1).select(code, p).first()[0] == 3


def test_snapshot_series_and_channels(spark):
    pts = synthetic.training_points(spark, {0: "背景", 1: "农田"}, 10)
    v = F.array(*(F.col(c) for c in tables.day_columns(pts)))
    s = pts.withColumn("x", synthetic.snapshot_align(pts, v, [20], 2, 3)).withColumn("k", synthetic.channels(v, F.col("crop_name"), F.col("label") > 0))
    rows = s.collect()
    assert len(rows) == 20 and all(len(r.x) == 3 and all(0 <= a <= 0.95 for a in r.x) for r in rows) and all(0 <= c <= 0.5 for r in rows for c in r.k.cv)
    assert {r.crop_name for r in rows if r.label == 0} == {b[0] for b in synthetic.BACKGROUND}


def test_whole_chain(spark, tmp_path):
    config = tables.load_config(overrides={"legend": {0: "背景/非农田", 1: "玉米", 2: "小麦", 3: "大豆"}, "classification": {"model_type": "random_forest", "n_estimators": 12, "max_depth": 6, "random_state": 42}, "prior_fusion": {"enable": True, "hard_veto": False}, "unbiased_estimation": {"n_bootstrap": 200}})
    scene = synthetic.scene(spark, 60, 60, 3)
    r = pipeline.run(spark, scene, config, str(tmp_path / "out"), late=scene.select("r", "c", "code"))
    for f in r.files.values():
        assert (tmp_path / "out").joinpath(f).stat().st_size > 0
    assert (tmp_path / "out" / "briefing.html").stat().st_size > 3000
    assert r.parcels.count() > 0 and r.acreage.count() == 3 and {"transitions.csv", "rotation.csv"} <= set(r.files)
    assert r.acreage.where("boot_low_mu > boot_high_mu OR boot_low_mu IS NULL").count() == 0


def test_reprojection_from_degrees(spark):
    """A raster in degrees under a UTM grid: each pixel's centre is looked up by its longitude and latitude."""
    step = 1e-4
    cover = spark.range(60 * 60).select(F.expr("id DIV 60").alias("r"), (F.col("id") % 60).alias("c")).withColumn("value", (F.col("r") * 1000 + F.col("c")).cast("double"))
    target = spark.range(40 * 40).select(F.expr("id DIV 40").alias("r"), (F.col("id") % 40).alias("c"))
    place = geo.utm_to_wgs84(F.lit(500000.0), F.lit(4200000.0), F.lit(50), F.lit(True))
    lon, lat = spark.range(1).select(place.alias("g")).select("g.lon", "g.lat").first()
    at, source = (10.0, 0.0, 500000.0, 0.0, -10.0, 4200000.0), (step, 0.0, lon - 5 * step, 0.0, -step, lat + 5 * step)
    near = {(r.r, r.c): r.value for r in raster.reproject_nearest(target, cover, at, source, ["value"], 50).collect()}
    smooth = {(r.r, r.c): r.value for r in raster.reproject_bilinear(target, cover, at, source, "value", 50).collect()}
    assert len(near) == len(smooth) == 1600 and near[0, 0] == 5005
    assert all(near[k] is None or abs(smooth[k] // 1000 - near[k] // 1000) <= 1 for k in near if smooth[k] is not None)
    outside = raster.reproject_nearest(target, cover, at, (step, 0.0, lon + 1, 0.0, -step, lat), ["value"], 50)
    assert outside.where("value IS NOT NULL").count() == 0 and outside.count() == 1600
