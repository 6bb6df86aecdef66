"""Scenes of one place on several dates: their pixels as series, and other rasters brought to their grid."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.functions import geo
from furrow.operators import raster
from furrow.sources import tiff


def in_degrees(epsg: int | None) -> bool:
    """Whether a code is that of a geographic system (the register keeps them from 4000 on)."""
    return epsg is not None and 4000 <= epsg < 5000


@dataclass
class Scene:
    """Pixels (r, c, ndvi series and, of six-band scenes, lswi, gcvi and cv series), their days, and where they lie."""

    pixels: DataFrame
    days: list[int]
    transform: tuple[float, ...]
    epsg: int | None = None

    def spatial(self, given: dict) -> dict:
        """The settings of the place: pixel size in metres, origin, UTM zone; `degrees` is the step of a map in degrees, else None."""
        step, x0, y0 = self.transform[0], self.transform[2], self.transform[5]
        if in_degrees(self.epsg):
            return given | {"resolution_meters": step * geo.METRES_A_DEGREE, "origin": (x0, y0), "degrees": step}
        out = given | {"resolution_meters": step, "origin": (x0, y0), "degrees": None}
        if self.epsg is None:
            return out
        if not (32601 <= self.epsg <= 32660 or 32701 <= self.epsg <= 32760):
            raise ValueError(f"scenes must be in UTM (WGS84) or degrees, not EPSG:{self.epsg}")
        return out | {"utm_zone": self.epsg % 100, "northern": self.epsg < 32700}


def opened(spark: SparkSession, path: str, block_size: int = 1024) -> Scene:
    """All scenes at a path. A path with a scheme is read by Spark, a file a task; any other must be mounted everywhere, a tile a task.

    Files must agree in size, place and kind, and no two may be of one day. Six bands or more give four index series; fewer hold an
    index already, a date a file (or a date a band, 30 days apart, where there is one file).
    """
    if "://" in path:
        files = [r.asDict() | {"transform": (r.step, 0.0, r.x0, 0.0, -r.step, r.y0)} for r in tiff.catalog(spark, path).collect()]  # a row a date
        tiles = tiff.scenes_binary(spark, path, block_size)
    else:
        files, tiles = tiff.metadata(path), tiff.scenes(spark, path, block_size)
    if not files:
        raise FileNotFoundError(f"no TIFF files at {path}")
    kinds = {(f["height"], f["width"], f["transform"], f["epsg"], f["multispectral"]) for f in files}
    if len(kinds) > 1:
        raise ValueError(f"the scenes at {path} differ in size, place or kind")
    days = sorted(f["doy"] for f in files)
    if len(set(days)) < len(days):
        raise ValueError(f"two scenes at {path} are of one day")
    _, _, transform, epsg, many = kinds.pop()
    pixels = tiff.channels(tiles).drop("days") if many else tiff.pixel_series(tiles).select("r", "c", F.col("values").alias("ndvi"))
    return Scene(pixels, days, transform, epsg)


def under(spark: SparkSession, target: DataFrame, path: str, scene: Scene, spatial: dict, names: list[str], smooth: bool = False) -> DataFrame:
    """target (r, c, ...) with the leading bands of another raster at each pixel, null outside it: nearest, or bilinear.

    The raster lies in the scene's own system, or in degrees under scenes in UTM. Bands that it lacks are left out.
    """
    head = tiff.catalog(spark, path).first()
    if head is None:
        raise FileNotFoundError(f"no TIFF file at {path}")
    zone = spatial["utm_zone"] if in_degrees(head.epsg) and not in_degrees(scene.epsg) else None
    if zone is None and None not in (head.epsg, scene.epsg) and head.epsg != scene.epsg and not (in_degrees(head.epsg) and in_degrees(scene.epsg)):
        raise ValueError(f"{path} is in EPSG:{head.epsg}, the scenes in EPSG:{scene.epsg}")
    at = (head.step, 0.0, head.x0, 0.0, -head.step, head.y0)
    out = target
    for i, name in enumerate(names[: head.bands], 1):
        band = tiff.scenes_binary(spark, path, bands=[i]).select("r", "c", F.col("value").alias(name))
        if smooth:
            out = raster.reproject_bilinear(out, band, scene.transform, at, name, zone, spatial["northern"])
        else:
            out = raster.reproject_nearest(out, band, scene.transform, at, [name], zone, spatial["northern"])
    return out
