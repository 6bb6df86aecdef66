"""Roll-ups of parcels and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.functions import units

HAIR = 1e-6


def _share(total: str, least: float):
    return F.col("area_mu") / F.greatest(total, F.lit(least)) * 100


def province_rollup(parcels: DataFrame, report: bool = False) -> DataFrame:
    """A row a province: parcels, areas, means, share of the whole; report: with the bar's width instead of the means."""
    by = parcels.groupBy("province").agg(F.count("*").alias("parcels"), F.sum("area_mu").alias("area_mu"), F.sum("area_ha").alias("area_ha"), F.avg("purity").alias("mean_purity"), F.avg("confidence").alias("mean_confidence"))
    whole = parcels.agg(F.coalesce(F.sum("area_mu"), F.lit(0.0)).alias("_t"))
    joined = by.crossJoin(F.broadcast(whole))  # one row
    head = ["province", "parcels", units.rounded(F.col("area_mu"), 2, HAIR).alias("area_mu"), units.rounded(F.col("area_ha"), 2, HAIR).alias("area_ha")]
    if report:
        share = _share("_t", 1.0)
        out = joined.select(*head, F.round(share, 1).alias("share_pct"), F.round(F.least(F.lit(100.0), share * 2.2), 1).alias("bar_pct"))
    else:
        out = joined.select(*head, F.round("mean_purity", 3).alias("mean_purity"), F.round("mean_confidence", 3).alias("mean_confidence"), F.round(_share("_t", 1e-4), 2).alias("area_share_pct"))
    return out.orderBy(F.desc("area_mu"), "province")


def crop_summary(parcels: DataFrame) -> DataFrame:
    return parcels.groupBy("crop_code").agg(F.count("*").alias("parcels"), units.rounded(F.sum("area_mu"), 1, HAIR).alias("area_mu"))


def map_kpis(parcels: DataFrame) -> DataFrame:
    """One row: totals, share fit for machines, centre, provinces."""
    good = F.col("machinery_suitability").contains("优") | F.col("machinery_suitability").contains("良")
    named = F.when(F.col("province") != "", F.col("province"))
    return parcels.agg(
        F.count("*").alias("parcels"), units.rounded(F.coalesce(F.sum("area_mu"), F.lit(0.0)), 1, HAIR).alias("area_mu"), units.rounded(F.coalesce(F.sum("area_ha"), F.lit(0.0)), 2, HAIR).alias("area_ha"),
        F.round(F.count_if(good) / F.greatest(F.count("*"), F.lit(1)) * 100, 1).alias("machinery_pct"),
        F.round(F.coalesce(F.avg("center_lon"), F.lit(117.001)), 5).alias("center_lon"), F.round(F.coalesce(F.avg("center_lat"), F.lit(37.946)), 5).alias("center_lat"),
        F.count_distinct(named).alias("provinces"), F.array_join(F.sort_array(F.collect_set(named)), ",").alias("province_list"),
    )


def focus_crop(acreage: DataFrame, choice: int | None = None) -> DataFrame:
    """The crop a report turns on: the chosen one, else the largest by calibrated, then by naive area, then the first."""
    order = [F.desc(F.coalesce(F.col("code") == F.lit(choice), F.lit(False)))] if choice is not None else []
    return acreage.orderBy(*order, F.desc("calibrated_mu"), F.desc("naive_mu"), "code").limit(1)


def top_parcels(parcels: DataFrame, n: int = 10) -> DataFrame:
    return parcels.orderBy(F.desc("area_mu"), "parcel_id").limit(n)


def search(parcels: DataFrame, text: str) -> DataFrame:
    """The first parcel whose id equals the text, or whose crop or province holds it, letters' case aside."""
    t = text.strip().lower()
    hit = (F.lower("parcel_id") == t) | F.lower("crop_name").contains(t) | F.lower("province").contains(t)
    return parcels.where(hit).orderBy("parcel_id").limit(1)


def filtered(parcels: DataFrame, crops: list[int], province: str = "ALL") -> DataFrame:
    out = parcels.where(F.col("crop_code").isin(crops))
    return out if province == "ALL" else out.where(F.col("province") == province)
