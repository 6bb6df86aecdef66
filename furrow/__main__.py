"""python -m furrow --out FOLDER [--scenes FOLDER] ...: the whole chain from GeoTIFF scenes, or from a made-up landscape."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from furrow import session
from furrow.operators import sinks
from furrow.plans import pipeline
from furrow.sources import scene, synthetic, tables


def main(argv: list[str] | None = None) -> None:
    a = argparse.ArgumentParser(prog="furrow", description="Crop areas, parcels and reports from scenes of several dates.")
    a.add_argument("--out", required=True, help="folder of the results; those of an earlier run are replaced")
    a.add_argument("--scenes", help="a GeoTIFF or a folder of them; without it a landscape is made up")
    a.add_argument("--config", help="YAML file of settings")
    a.add_argument("--points", help="CSV of training points: point_id, label, crop_name, doy_<n> ...")
    a.add_argument("--sample", help="CSV of the validation sample")
    a.add_argument("--prior", help="GeoTIFF of land cover; turns prior fusion on")
    a.add_argument("--terrain", help="GeoTIFF of elevation (and slope); turns prior fusion and its veto on")
    a.add_argument("--late", help="GeoTIFF of another year's classes on the same grid, for crop rotation")
    a.add_argument("--obia", action="store_true", help="take mostly cropped superpixels as fields")
    a.add_argument("--cores", help="run on this machine with so many threads; default: the session that is there")
    given = a.parse_args(argv)
    spark = session.local_session(given.cores) if given.cores else SparkSession.builder.appName("furrow").getOrCreate()
    session.ship(spark)

    config = tables.load_config(given.config)
    if given.prior or given.terrain:
        config["prior_fusion"] |= {"enable": True, "path": given.prior or config["prior_fusion"]["path"]}
    if given.terrain:
        config["terrain"] |= {"enable": True, "path": given.terrain}
    config["segmentation"]["enable_obia"] |= given.obia
    ok, wrong = tables.validate_config(config)
    if not ok:
        a.error("; ".join(wrong))

    pixels = scene.opened(spark, given.scenes, config["streaming"]["block_size"]) if given.scenes else synthetic.scene(spark, 120, 120)
    points = tables.read_csv(spark, given.points) if given.points else None
    if points is not None:
        points = points.withColumn("label", F.col("label").cast("int"))
    sample = tables.validation_sample(spark, given.sample) if given.sample else None
    late = scene.opened(spark, given.late).pixels.select("r", "c", F.get("ndvi", F.lit(0)).cast("int").alias("code")) if given.late else None
    r = pipeline.run(spark, pixels, config, given.out, points, sample, late)
    print(sinks.console_table(r.acreage.orderBy("code")))
    print("\n".join(r.files.values()))


if __name__ == "__main__":
    main()
