import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from furrow.operators import estimate, parcels, polygons, raster, sinks
from furrow.operators.components import components
from furrow.plans import report


def grid(spark, a):
    rows = [(int(r), int(c), int(a[r, c]), 0.5) for r in range(a.shape[0]) for c in range(a.shape[1])]
    return spark.createDataFrame(rows, "r long, c long, code int, conf double")


def test_edges_between_touching_classes_lie_on_both_sides(spark):
    a = np.zeros((10, 10), int)
    a[3:6, 2:5], a[3:6, 5:8] = 1, 2
    edge = {(r.r, r.c) for r in raster.gradient_edges(grid(spark, a)).where("edge").collect()}
    assert edge == {(r, c) for r in (3, 4, 5) for c in (4, 5)}


def test_opening_removes_noise_and_keeps_a_block(spark):
    a = np.zeros((50, 50), int)
    a[3, 3] = 1
    a[20:35, 20:35] = 1
    _, stats = parcels.segment(grid(spark, a), 10.0, 200.0, 500_000.0)
    rows = stats.collect()
    assert len(rows) == 1 and rows[0].pixels == 225 and rows[0].parcel_id == "P0001"


def test_components_by_connectivity(spark):
    a = np.array([[1, 0, 0], [0, 1, 0], [0, 0, 1]])
    on = grid(spark, a).where("code > 0")
    assert parcels.label(on, 8).select("comp").distinct().count() == 1
    assert parcels.label(on, 4).select("comp").distinct().count() == 3


def test_components_of_a_long_chain_and_of_nothing(spark):
    chain = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    r = components(chain)
    assert r.count() == 201 and r.select("component").distinct().collect()[0][0] == 0
    assert components(chain.limit(0)).count() == 0
    loops = spark.createDataFrame([(1, 1), (2, None), (3, 4), (4, 3)], "a long, b long")
    assert {(x.node, x.component) for x in components(loops).collect()} == {(3, 3), (4, 3)}


def test_holes_fill_by_size_and_border(spark):
    a = np.ones((12, 20), int)
    a[5, 5] = 0
    a[3:9, 10:16] = 0
    a[0, 0] = 0
    g = grid(spark, a).withColumn("on", F.col("code") > 0)
    filled = {(r.r, r.c) for r in parcels.fill_holes(g, "on").where("filled AND code = 0").collect()}
    assert filled == {(5, 5)}


def test_discs_that_touch_are_cut_and_keep_their_area(spark):
    y, x = np.mgrid[0:100, 0:100]
    a = np.zeros((100, 100), int)
    for r, c in ((30, 30), (30, 66), (70, 48)):
        a[(y - r) ** 2 + (x - c) ** 2 <= 21**2] = 1
    _, stats = parcels.segment(grid(spark, a), 10.0, 200.0, 150_000.0)
    rows = stats.collect()
    assert len(rows) >= 3 and sum(r.pixels for r in rows) >= 0.85 * a.sum()


def test_parcels_are_ranked_by_area(spark):
    sizes = spark.createDataFrame([(i, n) for i, n in enumerate([120, 50, 430, 12, 900, 310, 80])], "comp long, pixels long")
    rows = parcels.filter_rank(sizes, 10.0, 2000.0, None, 4).orderBy("parcel_no").collect()
    assert [r.pixels for r in rows] == [900, 430, 310, 120]
    assert parcels.filter_rank(sizes, 10.0, 1e9).count() == 7  # none fits: all stay


def test_trace_joins_corners_and_closes():
    square = np.zeros((10, 10), bool)
    square[3:7, 3:7] = True
    ring = polygons.trace(square)
    assert ring[0] == ring[-1] == (3, 3) and len(ring) == 17
    assert polygons.simplify(ring) == [(3, 3), (3, 7), (7, 7), (7, 3), (3, 3)]
    corner = np.array([[1, 0], [0, 1]], bool)
    assert len(polygons.trace(corner)) == 9
    assert polygons.trace(np.zeros((3, 3), bool)) == []


def test_simplify_drops_collinear_points_and_keeps_short_lines():
    assert polygons.simplify([(0, 0), (0, 1), (0, 5), (0, 10), (5, 10), (10, 10)]) == [(0.0, 0.0), (0.0, 10.0), (10.0, 10.0), (0.0, 0.0)] or len(polygons.simplify([(0, 0), (0, 1), (0, 5), (0, 10), (5, 10), (10, 10)])) == 3
    assert polygons.simplify([(0, 0), (1, 1), (2, 0)]) == [(0, 0), (1, 1), (2, 0)]


def test_chaikin_closes(spark):
    ring = polygons.points((0, 0), (0, 10), (10, 10), (10, 0), (0, 0))
    r = spark.range(1).select(polygons.chaikin(ring).alias("s"), polygons.chaikin(polygons.points((0, 0), (1, 1))).alias("t")).first()
    assert len(r.s) == 9 and r.s[0] == r.s[-1] and len(r.t) == 2


def test_focal_results_do_not_depend_on_partitions(spark):
    a = np.random.default_rng(3).integers(0, 4, (24, 31))
    g = grid(spark, a).withColumn("v", F.col("code") * 1.5)
    one = raster.local_contrast(g.coalesce(1), "v").orderBy("r", "c").toPandas()
    many = raster.local_contrast(g.repartition(13), "v").orderBy("r", "c").toPandas()
    assert np.allclose(one["local_std"], many["local_std"]) and len(one) == a.size
    p = np.pad(a * 1.5, 2, mode="symmetric")
    mean = np.array([[p[r : r + 5, c : c + 5].mean() for c in range(31)] for r in range(24)])
    assert np.allclose(one["contrast"].to_numpy().reshape(24, 31), a * 1.5 - mean)


def test_features_geojson_and_pages(spark, tmp_path):
    a = np.zeros((40, 60), int)
    a[2:20, 2:20], a[2:20, 30:55], a[25:38, 5:50] = 1, 2, 3
    pixels, stats = parcels.segment(grid(spark, a), 10.0, 200.0, 500_000.0)
    legend = {0: "背景", 1: "玉米", 2: "小麦"}
    named = polygons.attributes(stats, polygons.rings(pixels), estimate.legend_table(spark, legend)).cache()
    shapes = polygons.features(named)
    n = sinks.write_geojson(shapes, str(tmp_path / "a.geojson"))
    doc = json.loads((tmp_path / "a.geojson").read_text(encoding="utf-8"))
    assert n == 3 and len(doc["features"]) == 3 and doc["features"][0]["geometry"]["coordinates"][0][0] == doc["features"][0]["geometry"]["coordinates"][0][-1]
    assert {f["properties"]["crop_name"] for f in doc["features"]} == {"玉米", "小麦", "作物_3"}
    page = report.map_page(shapes, named.drop("outline"))
    assert "P0001" in page and len(page) > 3000
    assert sinks.clean_folder(str(tmp_path)) == ["a.geojson"]


@pytest.mark.parametrize("resolution,connectivity,edges,want", [(10, 8, False, (3, False)), (2, 8, False, (9, False)), (10, 4, False, (3, True)), (30, 8, False, (3, True)), (30, 8, True, (1, False))])
def test_opening_size(resolution, connectivity, edges, want):
    assert raster.opening_size(resolution, connectivity, edges) == want
