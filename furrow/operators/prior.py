"""Prior knowledge: land-cover and built-in priors, fusion with predictions, vetoes, pseudo labels and sample tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furrow.functions import series

#: Crop probability of land-cover codes.
CLCD = {1: 0.95, 2: 0.02, 3: 0.08, 4: 0.05, 5: 0.0, 7: 0.02, 8: 0.01}
CROP_CODES = (10, 100)


def landcover_prior(code: Column, provider: str = "clcd", most: Column | None = None) -> Column:
    """Probability of crops from a land-cover product. most: the product's greatest value, for those that are no known code list."""
    x = code.cast("double")
    if provider == "clcd":
        out = F.when(code == 1, CLCD[1])
        for k in list(CLCD)[1:]:
            out = out.when(code == k, CLCD[k])
        return out.otherwise(0.0)
    clip = F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))
    if provider in ("worldcereal", "from_glc"):
        coded = F.when(code.isin(*CROP_CODES), 0.95).when(code > 0, 0.03).otherwise(0.0)
        return F.when(most <= 10, clip).otherwise(coded) if most is not None else coded
    return F.when(most > 1, x / most).otherwise(clip) if most is not None else clip


def builtin_prior(ndvi: Column, lswi: Column | None = None) -> Column:
    """Crop probability from a pixel's series. Rules are set down in order and the last that holds wins, so they are tested backwards."""
    low, high, wide, mean = F.array_min(ndvi), F.array_max(ndvi), series.span(ndvi), series.mean(ndvi)
    v = lambda i: series.at(ndvi, i)
    forest = (low >= 0.42) & (mean >= 0.55)
    if lswi is not None:
        w = lambda i: series.at(lswi, i)
        meadow = (w(1) > 0.15) & (w(3) > 0.15) & (v(1) > 0.70) & (v(3) > 0.70)
        crop = ~forest & ~meadow & (v(2) >= 0.50) & (wide >= 0.20) & (low <= 0.40) & (w(2) >= -0.05)
    else:
        meadow = (v(2) > 0.82) & (v(3) > 0.68) & (v(0) < 0.50) & (wide < 0.38)
        crop = ~forest & ~meadow & (v(2) >= 0.50) & (wide >= 0.20) & (low <= 0.40)
    four = F.size(ndvi) >= 4
    return (
        F.when(four & F.coalesce(crop, F.lit(False)), 0.80).when(four & F.coalesce(meadow, F.lit(False)), 0.05).when(forest, 0.05)
        .when((wide < 0.15) & (high < 0.50), 0.02).when(high < 0.35, 0.01).when(low < 0, 0.0).otherwise(0.5)
    )


def fuse(local: Column, prior: Column, weight: float = 0.5, external: bool = False, hard_veto: bool = True, terrain: Column | None = None) -> Column:
    """A prediction's crop probability joined with the prior, then vetoed and clipped to 0..1."""
    blend = weight * prior + (1 - weight) * local
    if external:
        out = F.when(local < 0.30, local * 0.5).otherwise(blend)
    else:
        out = F.when(local >= 0.35, F.greatest(local, blend)).when(prior >= 0.70, blend).otherwise(local * 0.5)
    if hard_veto:
        out = F.when(hard_vetoed(local, prior), 0.0).otherwise(out)
    if terrain is not None:
        out = F.when(F.coalesce(terrain, F.lit(False)), 0.0).otherwise(out)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), out))


def hard_vetoed(local: Column, prior: Column) -> Column:
    return (prior <= 0.05) | ((prior <= 0.25) & (local < 0.85))


def final_code(conf: Column, code: Column, binary: bool = False, threshold: float = 0.40) -> Column:
    """The class after fusion: crop from the threshold on. Binary output knows 1 only; else the class stays where there is one."""
    crop = F.lit(1) if binary else F.coalesce(F.nullif(code, F.lit(0)), F.lit(1))
    return F.when(conf >= threshold, crop).otherwise(0).cast("int")


def pseudo_labels(df: DataFrame, ndvi: str = "ndvi", prior: str = "prior", terrain: str | None = None) -> DataFrame:
    """Adds pseudo (1 crop, 0 not, null neither) and kind (name of what a negative is)."""
    v = F.col(ndvi)
    low, high, wide, mean = F.array_min(v), F.array_max(v), series.span(v), series.mean(v)
    steep = F.coalesce(F.col(terrain), F.lit(False)) if terrain else F.lit(False)
    positive = (F.col(prior) >= 0.70) & (low <= 0.40) & (high >= 0.50) & (wide >= 0.20) & ~steep
    water, built = (high <= 0.22) | (low <= 0), (high <= 0.32) & (wide <= 0.15)
    forest, high_land = (low >= 0.42) & (mean >= 0.55), steep & (F.col(prior) <= 0.10)
    kind = F.when(water, "water").when(built, "built").when(high_land, "terrain").when(forest, "forest")
    return df.withColumn("pseudo", F.when(positive, 1).when(kind.isNotNull(), 0)).withColumn("kind", F.when(positive, "crop").otherwise(kind))


def mine(df: DataFrame, most: int = 200, seed: int = 42, key: str = "pixel") -> DataFrame:
    """At most `most` pixels of each pseudo label, drawn by the MD5 of seed and key, so that reruns agree."""
    order = F.md5(F.concat_ws(":", F.lit(seed), F.col(key)))
    side = lambda k: df.where(F.col("pseudo") == k).orderBy(order, key).limit(most)
    return side(1).unionByName(side(0))


def merge_samples(base: DataFrame, mined: DataFrame, days: list[int], digits: int = 4) -> DataFrame:
    """Both tables on the target's days: point_id, label, crop_name (defaults filled) and rounded doy_<n>.

    A table's own doy_<n> (or month) columns are interpolated to the days; ends are held.
    """

    def align(df: DataFrame, prefix: str) -> DataFrame:
        own = sorted((c for c in df.columns if c.startswith("doy_") and c[4:].isdigit()), key=lambda c: int(c[4:]))
        s = series.resample(F.array(*(F.lit(int(c[4:])) for c in own)), F.array(*(F.col(c).cast("double") for c in own)), [float(d) for d in days])
        number = F.xxhash64(F.struct(*df.columns)).cast("string")
        point = F.col("point_id") if "point_id" in df.columns else F.concat(F.lit(prefix), number)
        name = F.col("crop_name") if "crop_name" in df.columns else F.concat(F.lit("作物_"), F.col("label").cast("string"))
        return df.select(point.cast("string").alias("point_id"), F.col("label").cast("int").alias("label"), name.alias("crop_name"), *(F.round(F.get(s, F.lit(i)), digits).alias(f"doy_{d}") for i, d in enumerate(days)))

    return align(base, "BASE_").unionByName(align(mined, "MINED_"))
