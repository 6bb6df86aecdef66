import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from furrow.functions import geo, grading, series, spectral, units, zoning


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def array(values):
    return F.array(*(F.lit(float(v)) if v is not None else F.lit(None).cast("double") for v in values))


@pytest.mark.parametrize("east,north", [(500000, 4200000), (450000, 4150000), (550000, 4250000), (480000, 4000000)])
def test_utm_round_trip_is_within_a_millimetre_of_rounding(spark, east, north):
    g = geo.utm_to_wgs84(F.lit(float(east)), F.lit(float(north)), F.lit(50), F.lit(True))
    back = geo.wgs84_to_utm(g["lon"], g["lat"], F.lit(50))
    r = one(spark, back["east"].alias("e"), back["north"].alias("n"))
    assert abs(r.e - east) <= 0.01 and abs(r.n - north) <= 0.01


def test_crs_texts(spark):
    for text, want in [("EPSG:4326", True), ("WGS84", True), ("CGCS2000", True), ("EPSG:32650", False), ('PROJCS["WGS 84 / UTM zone 50N"]', False), (None, False)]:
        assert one(spark, geo.is_geographic(F.lit(text).cast("string")))[0] is want
    for text, want in [("EPSG:32610", (10, True)), ("EPSG:32710", (10, False)), ("UTM Zone 50S", (50, False)), ("", (50, True)), (None, (50, True))]:
        assert tuple(one(spark, geo.parse_utm_zone(F.lit(text).cast("string")).alias("z"))[0]) == want


def test_days_in_file_names(spark):
    for name, want in [("doy_110.tif", 110), ("Wheat_DOY_200_NDVI.tif", 200), ("GF2_20240415_L2A.tif", 106), ("unknown.tif", 150), ("x_20241399.tif", 150)]:
        assert one(spark, geo.parse_doy(F.lit(name)))[0] == want


def test_quotient_of_circle_and_square(spark):
    r = one(spark, grading.isoperimetric(F.lit(math.pi * 100), F.lit(20 * math.pi)), grading.isoperimetric(F.lit(100.0), F.lit(40.0)), grading.isoperimetric(F.lit(1.0), F.lit(0.0)))
    assert r[0] == pytest.approx(1) and r[1] == pytest.approx(math.pi / 4) and r[2] == 0


def test_parcel_names_and_colours(spark):
    r = one(spark, grading.parcel_name(F.lit(7)), grading.parcel_name(F.lit(12345)), grading.crop_colour(F.lit(3), 4), grading.crop_colour(F.lit(0), 30))
    assert tuple(r) == ("P0007", "P12345", "#3498db", "#ecf0f1")


def test_units(spark):
    r = one(spark, units.sqm_to_mu(F.lit(10000.0)), units.mu_to_ha(F.lit(15.0)), units.format_area(F.lit(20_000_000.0))["area_wan_mu"])
    assert r[0] == pytest.approx(15) and r[1] == 1 and r[2] == 3


def test_zones_by_cascade_and_by_join_agree(spark):
    p = spark.createDataFrame([(80.0, 39.0), (80.0, 40.0), (114.0, 35.0), (0.0, 0.0), (90.0, 30.0), (110.8, 33.8), (122.5, 46.0), (47.0, 31.0)], "lon double, lat double")
    a = {(r.lon, r.lat): tuple(r.z) for r in p.withColumn("z", zoning.zone(F.col("lon"), F.col("lat"))).collect()}
    b = {(r.lon, r.lat): (r.province, r.zone) for r in zoning.zone_join(p).collect()}
    assert a == b and a[80.0, 39.0][1] == "南疆绿洲冬春麦区" and a[0.0, 0.0] == zoning.ABROAD


def test_indices_of_water_and_empty_pixels(spark):
    df = spark.createDataFrame([(900.0, 400.0, 300.0, 200.0), (0.0, 0.0, 0.0, 0.0), (500.0, 400.0, 3000.0, 900.0)], "b2 double, b3 double, b4 double, b5 double")
    r = spectral.with_indices(df).collect()
    assert r[0].water and r[0].lswi == 0.6 and r[0].gcvi == -1
    assert not r[1].water and r[1].ndvi == 0 and r[1].lswi == 0
    assert r[2].ndvi == pytest.approx(2600 / 3400)


def test_features_match_numpy(spark):
    v = np.array([0.2, 0.15, 0.3, 0.6, 0.8, 0.5, 0.3, 0.2])
    f = series.features(array(v), 8)
    r = one(spark, *(f[k].alias(k) for k in f))
    g = np.gradient(v)
    fft = np.fft.fft(v)
    assert r.std == pytest.approx(v.std()) and r.grad_max == pytest.approx(g.max()) and r.grad_abs == pytest.approx(np.abs(g).mean())
    assert r.amp1 == pytest.approx(abs(fft[1]) / 8) and r.phase1 == pytest.approx(np.angle(fft[1])) and r.amp2 == 0
    assert len(f) == 28 - 2  # the two focal features live in operators.raster


@pytest.mark.parametrize("n", [1, 2, 3])
def test_short_series(spark, n):
    v = [0.3, 0.5, 0.4][:n]
    f = series.features(array(v), n)
    r = one(spark, *(f[k].alias(k) for k in f))
    assert r.slope_mid == 0 and r.amp1 == 0 and (n > 1 or r.grad_max == 0)


def test_gaps_spikes_and_smoothing(spark):
    assert one(spark, series.fill_gaps(array([None, 0.2, None, 0.4, float("nan")])))[0] == pytest.approx([0.2, 0.2, 0.3, 0.4, 0.4])
    assert one(spark, series.fill_gaps(array([None, None])))[0] == [0, 0]
    # the second dip sees the first one repaired
    assert one(spark, series.repair_spikes(array([0.8, 0.5, 0.75, 0.2, 0.7])))[0] == pytest.approx([0.8, 0.775, 0.75, 0.725, 0.7])
    assert one(spark, series.repair_spikes(array([0.5, 0.1])))[0] == [0.5, 0.1]
    x = np.arange(8) * 0.1 + 0.02 * np.arange(8) ** 2
    assert one(spark, series.savgol(array(x), 8))[0] == pytest.approx(list(x))  # parabolas pass


def test_resampling_months_and_days(spark):
    days = F.array(F.lit(1), F.lit(3))
    assert one(spark, series.resample(days, array([0.1, 0.5]), [15.5, 46.0, 76.5, 200.0]))[0] == pytest.approx([0.1, 0.3, 0.5, 0.5])
