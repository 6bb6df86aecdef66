"""CSV tables with declared schemas, and the configuration."""

from __future__ import annotations

import os
from copy import deepcopy

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.operators.estimate import DEFAULT_LEGEND

VALIDATION = "sample_id string, stratum_id string, map_label int, true_label int, weight double, lat double, lon double, source string"
PARCELS = "parcel_id string, parcel_no int, crop_code int, crop_name string, pixels long, area_m2 double, area_mu double, area_ha double, perimeter_m double, compactness double, purity double, confidence double, center_lon double, center_lat double, province string, agri_zone string, machinery_suitability string, scale_tier string"
#: Columns of validation files and what they are called here.
VALIDATION_NAMES = {"map_classified_label": "map_label", "ground_truth_label": "true_label", "weight_sampling_prob": "weight"}

#: Defaults of every setting.
DEFAULTS = {
    "spatial": {"resolution_meters": 10.0, "crs": "WGS84", "utm_zone": 50, "northern": True, "origin": (500000.0, 4200000.0)},
    "legend": DEFAULT_LEGEND,
    "segmentation": {"min_parcel_area_m2": 200.0, "max_parcel_area_m2": 500_000.0, "max_export_parcels": 500, "connectivity": 8, "apply_erosion": True, "subdivide_oversized": True, "discard_oversized": False, "enable_obia": False, "fill_internal_holes": True},
    "classification": {"model_type": "random_forest", "n_estimators": 100, "max_depth": 12, "random_state": 42},
    "time_series": {"apply_temporal_smoothing": False},
    "unbiased_estimation": {"n_bootstrap": 2000, "confidence_level": 0.95},
    "prior_fusion": {"enable": False, "provider": "clcd", "path": None, "weight": 0.5, "hard_veto": True, "threshold": 0.40, "mined_samples": 0},
    "terrain": {"enable": False, "path": None, "max_elevation_m": 1800.0, "max_slope_deg": 25.0},
    "streaming": {"block_size": 1024},
}


def load_config(path: str | None = None, overrides: dict | None = None) -> dict:
    """The defaults, a YAML file's settings over them (where PyYAML is installed), and overrides. Paths are taken from the file's folder."""
    out = deepcopy(DEFAULTS)
    given = [overrides or {}]
    if path:
        try:
            import yaml
        except ImportError as e:
            raise RuntimeError("reading a YAML file needs PyYAML; pass overrides instead") from e
        with open(path, encoding="utf-8") as f:
            given.insert(0, yaml.safe_load(f) or {})
        out["base_dir"] = os.path.dirname(os.path.abspath(path))
    for part in given:
        for k, v in part.items():
            if k == "legend":
                out[k] = {int(c): n for c, n in v.items()}
            elif isinstance(v, dict) and isinstance(out.get(k), dict):
                out[k] |= v
            else:
                out[k] = v
    return out


def validate_config(config: dict) -> tuple[bool, list[str]]:
    """Whether settings make sense, and what does not."""
    wrong = []
    number = lambda x: isinstance(x, int | float) and not isinstance(x, bool)
    step = config.get("spatial", {}).get("resolution_meters")
    if not number(step) or step <= 0:
        wrong.append("spatial.resolution_meters must be a positive number")
    seg = config.get("segmentation", {})
    low, high = seg.get("min_parcel_area_m2", 0), seg.get("max_parcel_area_m2", float("inf"))
    if not number(low) or not number(high) or low < 0 or low >= high:
        wrong.append("segmentation.min_parcel_area_m2 must be below max_parcel_area_m2")
    legend = config.get("legend")
    if not legend:
        wrong.append("legend must name at least one class")
    elif 0 not in legend:
        wrong.append("legend must name class 0, the background")
    boot = config.get("unbiased_estimation", {}).get("n_bootstrap", 2000)
    if not isinstance(boot, int) or boot < 50:
        wrong.append("unbiased_estimation.n_bootstrap must be a whole number of at least 50")
    block = config.get("streaming", {}).get("block_size", 1024)
    if not isinstance(block, int) or block < 16:
        wrong.append("streaming.block_size must be a whole number of at least 16")
    return not wrong, wrong


def read_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A CSV file with a header; lines that begin with # are left out, a byte order mark is too. Without a schema all columns are text."""
    reader = spark.read.option("header", True).option("comment", "#").option("encoding", "UTF-8").option("enforceSchema", False)
    return (reader.schema(schema) if schema else reader).csv(path)


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The file, or an empty table where there is none."""
    try:
        return read_csv(spark, path, schema)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def validation_sample(spark: SparkSession, path: str) -> DataFrame:
    """A survey's points with map_label, true_label and weight (1 where the file has none); other columns stay text."""
    raw = read_csv(spark, path)
    named = raw.select(*(F.col(f"`{c}`").alias(VALIDATION_NAMES.get(c.lstrip("﻿"), c.lstrip("﻿"))) for c in raw.columns))
    out = named.withColumn("map_label", F.col("map_label").cast("int")).withColumn("true_label", F.col("true_label").cast("int"))
    return out.withColumn("weight", F.coalesce(F.col("weight").cast("double"), F.lit(1.0)) if "weight" in out.columns else F.lit(1.0))


def day_columns(df: DataFrame) -> list[str]:
    """The doy_<n> columns of a table, by day."""
    return sorted((c for c in df.columns if c.startswith("doy_") and c[4:].isdigit()), key=lambda c: int(c[4:]))


def training_points(spark: SparkSession, path: str) -> DataFrame:
    """point_id, label, crop_name, days and values of a training table, whatever days it has."""
    raw = read_csv(spark, path)
    days = day_columns(raw)
    return raw.select(
        F.col("point_id"), F.col("label").cast("int").alias("label"), F.col("crop_name") if "crop_name" in raw.columns else F.lit(None).cast("string").alias("crop_name"),
        F.array(*(F.lit(int(c[4:])) for c in days)).alias("days"), F.array(*(F.col(c).cast("double") for c in days)).alias("values"),
    )


def curve_library(spark: SparkSession, path: str | None = None) -> DataFrame:
    """crop_id, crop_name, days, values of reference curves: a file's, or the fixed ones where there is none."""
    from furrow.sources.synthetic import DAYS, SCENE

    if path:
        raw = read_csv(spark, path)
        days = day_columns(raw)
        return raw.select(F.col("crop_id").cast("int"), "crop_name", F.array(*(F.lit(int(c[4:])) for c in days)).alias("days"), F.array(*(F.col(c).cast("double") for c in days)).alias("values"))
    return spark.createDataFrame([(k, DEFAULT_LEGEND[k], list(DAYS), list(map(float, v))) for k, v in SCENE.items()], "crop_id int, crop_name string, days array<int>, values array<double>")
