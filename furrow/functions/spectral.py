"""Spectral indices of band columns; every function takes and gives columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return (F.col(x) if isinstance(x, str) else x).cast("double")


def guarded_ratio(top: Column, bottom: Column) -> Column:
    """top / bottom, 0 where bottom is not positive."""
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def ndvi(nir: Column | str, red: Column | str) -> Column:
    return guarded_ratio(_c(nir) - _c(red), _c(nir) + _c(red))


def lswi(nir: Column | str, swir: Column | str) -> Column:
    return guarded_ratio(_c(nir) - _c(swir), _c(nir) + _c(swir))


def gcvi(nir: Column | str, green: Column | str) -> Column:
    return F.greatest(F.lit(-2.0), F.least(F.lit(10.0), F.when(_c(green) > 0, _c(nir) / _c(green) - 1).otherwise(F.lit(0.0))))


def mndwi(green: Column | str, swir: Column | str) -> Column:
    return (_c(green) - _c(swir)) / F.greatest(_c(green) + _c(swir), F.lit(1e-4))


def difference_index(a: Column | str, b: Column | str) -> Column:
    """(a - b) / (a + b) with a zero sum taken as 1e-6: the free-standing LSWI (nir, swir) and NDWI (green, nir)."""
    total = _c(a) + _c(b)
    return (_c(a) - _c(b)) / F.when(total == 0, F.lit(1e-6)).otherwise(total)


def is_water(nir: Column | str, red: Column | str, green: Column | str, swir: Column | str) -> Column:
    n, m = ndvi(nir, red), mndwi(green, swir)
    return ((m > 0.02) & (_c(nir) < 1200)) | ((n < 0) & (m > -0.05)) | (n < -0.05)


def with_indices(df: DataFrame, green: str = "b2", red: str = "b3", nir: str = "b4", swir: str = "b5") -> DataFrame:
    """ndvi, lswi, gcvi, mndwi and water of each pixel; water takes fixed index values."""
    water = is_water(nir, red, green, swir)
    return (
        df.withColumn("water", water)
        .withColumn("mndwi", mndwi(green, swir))
        .withColumn("ndvi", F.when(F.col("water"), F.least(ndvi(nir, red), F.lit(-0.30))).otherwise(ndvi(nir, red)))
        .withColumn("lswi", F.when(F.col("water"), F.lit(0.60)).otherwise(lswi(nir, swir)))
        .withColumn("gcvi", F.when(F.col("water"), F.lit(-1.0)).otherwise(gcvi(nir, green)))
    )


def clean(x: Column | str) -> Column:
    """Missing as 0, plus infinity as 1, minus infinity as 0."""
    x = _c(x)
    return F.when(x.isNull() | F.isnan(x) | (x == float("-inf")), 0.0).when(x == float("inf"), 1.0).otherwise(x)


def autoscale(df: DataFrame, columns: list[str], scene: list[str] | None = None) -> DataFrame:
    """Reflectances over 100 anywhere in a scene mean stored integers: the scene's columns are divided by 10000."""
    scene = scene or []
    top = F.greatest(*(F.max(c) for c in columns)) if len(columns) > 1 else F.max(columns[0])
    if scene:
        most = df.groupBy(*scene).agg(top.alias("_top"))
        joined = df.join(F.broadcast(most), scene, "left")  # one row a scene
    else:
        joined = df.crossJoin(F.broadcast(df.agg(top.alias("_top"))))  # one row
    return joined.select(*(F.when(F.col("_top") > 100, F.col(c) / 10000.0).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in df.columns))
