"""Outputs: CSV, GeoJSON, rendered files. Large tables stay tables; what is rendered is small."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CLEANED = (".geojson", ".csv", ".html", ".tif", ".tiff", ".png", ".jpg")


def write_csv(df: DataFrame, path: str, one_file: bool = False) -> None:
    (df.coalesce(1) if one_file else df).write.mode("overwrite").option("header", True).csv(path)


def write_csv_bom(df: DataFrame, path: str) -> None:
    """One CSV file with a byte order mark, on the driver: for report tables."""
    df.toPandas().to_csv(path, index=False, encoding="utf-8-sig")


def crs_name(crs: str = "WGS84") -> str:
    return "urn:ogc:def:crs:OGC:1.3:CRS84" if crs.upper() in ("WGS84", "EPSG:4326", "CRS84") else f"urn:ogc:def:crs:{crs.replace(':', '::')}"


def feature_lines(features: DataFrame) -> DataFrame:
    """One JSON text a feature, in parcel order."""
    return features.orderBy("parcel_no").select(F.to_json("feature").alias("value"))


def write_geojson_lines(features: DataFrame, path: str) -> None:
    """A folder of newline-delimited features: for any number of them."""
    feature_lines(features).write.mode("overwrite").text(path)


def write_geojson(features: DataFrame, path: str, crs: str = "WGS84") -> int:
    """One FeatureCollection, a feature a line. Rows come to the driver partition by partition."""
    n = 0
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write('{"type":"FeatureCollection","crs":{"type":"name","properties":{"name":"' + crs_name(crs) + '"}},"features":[')
        for row in feature_lines(features).toLocalIterator():
            f.write((",\n" if n else "\n") + row["value"])
            n += 1
        f.write("\n]}\n")
    return n


def clean_folder(path: str) -> list[str]:
    """Remove results of an earlier run from a folder: files of the known kinds, nothing else."""
    gone = [f for f in sorted(os.listdir(path)) if f.lower().endswith(CLEANED) and os.path.isfile(os.path.join(path, f))] if os.path.isdir(path) else []
    for f in gone:
        os.remove(os.path.join(path, f))
    return gone


def console_table(df: DataFrame, n: int = 20) -> str:
    """The first rows as text."""
    rows = df.limit(n).collect()
    cells = [df.columns, *[["" if v is None else str(v) for v in r] for r in rows]]
    wide = [max(len(r[i]) for r in cells) for i in range(len(df.columns))]
    return "\n".join(" | ".join(v.ljust(w) for v, w in zip(r, wide, strict=True)) for r in cells)
