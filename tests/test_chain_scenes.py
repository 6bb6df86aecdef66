"""The chain from GeoTIFF files, and the maps it writes."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from furrow import __main__ as command
from furrow.plans import pipeline
from furrow.sources import scene, synthetic, tables, tiff

UTM = (10.0, 0.0, 500000.0, 0.0, -10.0, 4200000.0)
LEGEND = {0: "背景/非农田", 1: "玉米", 2: "小麦", 3: "大豆"}
SMALL = {"legend": LEGEND, "classification": {"n_estimators": 4, "max_depth": 5}, "unbiased_estimation": {"n_bootstrap": 100}}


def cube(spark, rows, cols):
    """A made-up landscape as (rows, cols, dates) and its classes."""
    got = synthetic.scene(spark, rows, cols, 3).select("r", "c", "ndvi", "code").collect()
    a, code = np.zeros((rows, cols, len(synthetic.DAYS))), np.zeros((rows, cols), int)
    for r in got:
        a[r.r, r.c], code[r.r, r.c] = r.ndvi, r.code
    return a, code


def six_bands(ndvi):
    """Reflectances, stored as integers, whose index is ndvi."""
    red = np.full(ndvi.shape, 800.0)
    nir = red * (1 + ndvi) / (1 - ndvi)
    return np.stack([red * 0.9, red * 0.95, red, nir, nir * 0.7 + 300, red]).round().astype("u2")


def test_pyramid_reads_back(spark, tmp_path):
    pixels = spark.range(70 * 45).select(F.expr("id DIV 45").alias("r"), (F.col("id") % 45).alias("c"), ((F.col("id") * 7) % 5).cast("int").alias("code"))
    path = str(tmp_path / "m.tif")
    tiff.write_pyramid(tiff.class_tiles(pixels.where("NOT (r >= 32 AND r < 64 AND c < 32)"), 32), path, 70, 45, UTM, 32650, 32)
    t = tiff.Tiff.open(path)
    assert (t.height, t.width, t.epsg, t.transform, t.nodata, t.block) == (70, 45, 32650, UTM, 255.0, (32, 32))
    want = (np.arange(70 * 45) * 7 % 5).reshape(70, 45).astype(float)
    want[32:64, :32] = np.nan
    np.testing.assert_array_equal(t.window(1, 0, 70, 0, 45), want)
    # the overviews follow one another in the chain of directories
    data, sizes = open(path, "rb").read(), []
    at = int.from_bytes(data[4:8], "little")
    while at:
        n = int.from_bytes(data[at : at + 2], "little")
        entries = [data[at + 2 + 12 * i : at + 14 + 12 * i] for i in range(n)]
        tags = {int.from_bytes(e[:2], "little"): int.from_bytes(e[8:12], "little") for e in entries}
        assert list(tags) == sorted(tags)
        sizes.append((tags[254], tags[257], tags[256]))
        at = int.from_bytes(data[at + 2 + 12 * n : at + 6 + 12 * n], "little")
    assert sizes == [(0, 70, 45), (1, 35, 23), (1, 18, 12), (1, 9, 6), (1, 5, 3)]


def test_chain_over_six_bands(spark, tmp_path):
    """Files with four index series, a land cover that denies the north, an elevation that vetoes the east."""
    a, code = cube(spark, 60, 60)
    folder = tmp_path / "scenes"
    folder.mkdir()
    for i, d in enumerate(synthetic.DAYS):
        tiff.write_tiff(str(folder / f"s_doy_{d}.tif"), six_bands(a[:, :, i]), UTM, 32650)
    cover = np.ones((20, 20), "u1")
    cover[:5] = 2
    tiff.write_tiff(str(tmp_path / "cover.tif"), cover, (30.0, 0.0, 500000.0, 0.0, -30.0, 4200000.0), 32650)
    ground = np.zeros((2, 60, 60), "f4")
    ground[0, :, 45:] = 3000
    tiff.write_tiff(str(tmp_path / "ground.tif"), ground, UTM, 32650)
    config = tables.load_config(overrides=SMALL | {"prior_fusion": {"enable": True, "path": str(tmp_path / "cover.tif")}, "terrain": {"enable": True, "path": str(tmp_path / "ground.tif")}})
    s = scene.opened(spark, str(folder), 32)
    assert s.days == list(synthetic.DAYS) and s.epsg == 32650
    r = pipeline.run(spark, s, config, str(tmp_path / "out"))
    found = tiff.Tiff.open(r.files["classes.tif"]).window(1, 0, 60, 0, 60)
    assert (found[:15] == 0).all() and (found[:, 45:] == 0).all()
    inside = np.s_[15:, :45]
    assert ((found[inside] > 0) == (code[inside] > 0)).mean() > 0.85
    assert r.parcels.count() > 0 and r.acreage.count() == 3
    spark_read = scene.opened(spark, f"file://{folder}")
    assert spark_read.days == s.days and spark_read.pixels.count() == 3600


def test_chain_over_degrees_and_other_days(spark, tmp_path):
    """One file, a date a band, in degrees: training points are brought to its days, outlines stay in degrees."""
    a, _ = cube(spark, 40, 40)
    step = 0.0001
    at = (step, 0.0, 117.0, 0.0, -step, 36.0)
    tiff.write_tiff(str(tmp_path / "all.tif"), np.moveaxis(a[:, :, [0, 2, 4, 6]], 2, 0).astype("f4"), at, 4326)
    s = scene.opened(spark, str(tmp_path / "all.tif"))
    assert s.days == [30, 60, 90, 120]
    points = synthetic.training_points(spark, LEGEND, 20, 42)
    x = pipeline.aligned(points, s.days, 4, 42)
    assert {r.n for r in x.select(F.size("ndvi").alias("n")).distinct().collect()} == {4}
    config = tables.load_config(overrides=SMALL | {"segmentation": {"enable_obia": True}, "prior_fusion": {"enable": True, "mined_samples": 50}})
    r = pipeline.run(spark, s, config, str(tmp_path / "out"))
    shapes = json.loads((tmp_path / "out" / "parcels.geojson").read_text())["features"]
    for f in shapes:
        for lon, lat in f["geometry"]["coordinates"][0]:
            assert 117 <= lon <= 117 + 40 * step and 36 - 40 * step <= lat <= 36
    assert tiff.Tiff.open(r.files["classes.tif"]).epsg == 4326


def test_scenes_that_do_not_fit(spark, tmp_path):
    for name, shape in (("a_doy_80.tif", (8, 8)), ("b_doy_90.tif", (8, 9))):
        tiff.write_tiff(str(tmp_path / name), np.zeros(shape, "f4"), UTM, 32650)
    with pytest.raises(ValueError, match="differ"):
        scene.opened(spark, str(tmp_path))
    tiff.write_tiff(str(tmp_path / "b_doy_90.tif"), np.zeros((8, 8), "f4"), UTM, 32650)
    tiff.write_tiff(str(tmp_path / "c_doy_90.tif"), np.zeros((8, 8), "f4"), UTM, 32650)
    with pytest.raises(ValueError, match="one day"):
        scene.opened(spark, str(tmp_path))
    with pytest.raises(ValueError, match="UTM"):
        scene.Scene(None, [1], UTM, 3857).spatial({})


def test_command_refuses_wrong_settings(spark, tmp_path):
    with pytest.raises(SystemExit):
        command.main([])
