"""Design-based area statistics: error matrix, stratified estimator, bootstrap, prediction-powered mean, sample allocation.

Pixels and samples are aggregated once, with partial aggregation; what follows has a row for each pair of classes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from furrow.functions import grading, md5, units

# Fixed values.
Z95 = 1.96
MACRO_BACKGROUND, RARE_CLASS, CAP_SHARE = 0.70, 0.05, 0.35
PRIOR_UA = {0: 0.92, 1: 0.88, 2: 0.94, 3: 0.85, 4: 0.90}
DEFAULT_UA = 0.85
DRAW_TASKS = 200  #: tasks that the resamples of a bootstrap are dealt to, at most
DEFAULT_LEGEND = {0: "背景/非农田", 1: "玉米", 2: "小麦", 3: "大豆", 4: "水稻"}


def legend_table(spark: SparkSession, legend: dict[int, str]) -> DataFrame:
    return spark.createDataFrame(sorted(legend.items()), "code int, name string")


def _all(*, codes: list[int], spark: SparkSession, names: tuple[str, ...]) -> DataFrame:
    """All combinations of codes: the zero-filled skeleton; a row for each pair of classes."""
    one = [spark.createDataFrame([(int(c),) for c in codes], f"{n} int") for n in names]
    return reduce(lambda a, b: a.crossJoin(F.broadcast(b)), one)


def class_histogram(pixels: DataFrame, codes: list[int], code: str = "code") -> DataFrame:
    """code, pixels, weight (share of all pixels) of each legend class; absent ones have zeros."""
    counted = pixels.groupBy(F.col(code).cast("int").alias("code")).agg(F.count("*").alias("pixels"))
    every = counted.agg(F.coalesce(F.sum("pixels"), F.lit(0)).alias("total"))
    shape = _all(codes=codes, spark=pixels.sparkSession, names=("code",))
    return shape.join(counted, "code", "left").crossJoin(F.broadcast(every)).select(
        "code", F.coalesce("pixels", F.lit(0)).cast("long").alias("pixels"), (F.coalesce("pixels", F.lit(0)) / F.greatest("total", F.lit(1))).alias("weight"), "total"
    )


def error_matrix(sample: DataFrame, codes: list[int], map_col: str = "map_label", true_col: str = "true_label", weight: str = "weight") -> DataFrame:
    """i, j, n: summed weights by map class and true class, zero-filled; other codes are left out. No weight column counts 1."""
    w = F.col(weight).cast("double") if weight in sample.columns else F.lit(1.0)
    cells = sample.groupBy(F.col(map_col).cast("int").alias("i"), F.col(true_col).cast("int").alias("j")).agg(F.sum(w).alias("n"))
    return _all(codes=codes, spark=sample.sparkSession, names=("i", "j")).join(cells, ["i", "j"], "left").select("i", "j", F.coalesce("n", F.lit(0.0)).alias("n"))


def conditional_matrix(matrix: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Adds n_i (the row's sum) and cond = P(true j | map i); an empty row is the identity's."""
    n_i = F.sum("n").over(Window.partitionBy(*keys, "i"))
    return matrix.withColumn("n_i", n_i).withColumn("cond", F.when(F.col("n_i") > 0, F.col("n") / F.col("n_i")).otherwise((F.col("i") == F.col("j")).cast("double")))


def domain_protection(cond: DataFrame, weights: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Background row: absent crops cannot hide in it, and rare crops only up to a share of their own size; the row sums to 1."""
    w = weights.select(F.col("code").alias("j"), F.col("pixels").alias("pixels_j"), F.col("weight").alias("w_j"))
    w0 = weights.where("code = 0").select(F.col("weight").alias("w_0"))
    joined = cond.join(F.broadcast(w), "j").crossJoin(F.broadcast(w0))  # one row a class
    cap = CAP_SHARE * F.col("w_j") / F.greatest("w_0", F.lit(1e-6))
    held = F.when(F.col("pixels_j") == 0, 0.0).when((F.col("w_0") >= MACRO_BACKGROUND) | (F.col("w_j") < RARE_CLASS), F.least("cond", cap)).otherwise(F.col("cond"))
    row = Window.partitionBy(*keys, "i")
    first = joined.withColumn("p", F.when((F.col("i") == 0) & (F.col("j") != 0), held).otherwise(F.col("cond")))
    others = F.sum(F.when(F.col("j") != 0, F.col("p")).otherwise(0.0)).over(row)
    second = first.withColumn("p", F.when((F.col("i") == 0) & (F.col("j") == 0), F.greatest(F.lit(0.0), 1 - others)).otherwise(F.col("p")))
    whole = F.sum("p").over(row)
    out = second.withColumn("p", F.when((F.col("i") == 0) & (whole > 0), F.col("p") / whole).otherwise(F.col("p")))
    return out.select(*keys, "i", "j", "n", "n_i", F.col("p").alias("cond"))


def joint(cond: DataFrame, weights: DataFrame) -> DataFrame:
    """Adds w_i and p_ij = W_i * P(j | i)."""
    w = weights.select(F.col("code").alias("i"), F.col("weight").alias("w_i"))
    return cond.join(F.broadcast(w), "i").withColumn("p", F.col("w_i") * F.col("cond"))


def prepare(pixels: DataFrame, sample: DataFrame, codes: list[int], code: str = "code", protect: bool = True) -> tuple[DataFrame, DataFrame]:
    """(class weights, joint matrix) of a map and its validation sample."""
    weights = class_histogram(pixels, codes, code)
    cond = conditional_matrix(error_matrix(sample, codes))
    if protect and 0 in codes:
        cond = domain_protection(cond, weights)
    return weights, joint(cond, weights)


def accuracy(p: DataFrame) -> DataFrame:
    """code, ua, ua_se, pa, pa_se, oa, oa_se of a joint matrix."""
    spread = F.when(F.col("n_i") > 1, F.col("cond") * (1 - F.col("cond")) / (F.col("n_i") - 1)).otherwise(0.0)
    col = Window.partitionBy("j")
    m = p.withColumn("v", spread).withColumn("p_j", F.sum("p").over(col))
    m = m.withColumn("raw_pa", F.when(F.col("p_j") > 0, F.max(F.when(F.col("i") == F.col("j"), F.col("p"))).over(col) / F.col("p_j")).otherwise(0.0))
    own, other = F.col("i") == F.col("j"), F.col("i") != F.col("j")
    w2v = F.col("w_i") * F.col("w_i") * F.col("v")
    by = m.groupBy(F.col("j").alias("code")).agg(
        F.max(F.when(own, F.col("cond"))).alias("ua"), F.sqrt(F.max(F.when(own, F.col("v")))).alias("ua_se"),
        F.least(F.lit(1.0), F.max("raw_pa")).alias("pa"), F.max("p_j").alias("p_j"), F.max("raw_pa").alias("raw_pa"),
        F.max(F.when(own, w2v)).alias("own"), F.sum(F.when(other, w2v).otherwise(0.0)).alias("others"),
    )
    var = (F.pow(1 - F.col("raw_pa"), F.lit(2.0)) * F.col("own") + F.pow("raw_pa", F.lit(2.0)) * F.col("others")) / F.pow("p_j", F.lit(2.0))
    overall = m.where(own).agg(F.sum("p").alias("oa"), F.sqrt(F.sum(w2v)).alias("oa_se"))
    return by.withColumn("pa_se", F.when(F.col("p_j") > 0, F.sqrt(var)).otherwise(0.0)).select("code", "ua", "ua_se", "pa", "pa_se").crossJoin(F.broadcast(overall))


def areas(p: DataFrame, weights: DataFrame, resolution: float = 10.0) -> DataFrame:
    """Naive and calibrated area of each class but the background, with standard error, CV, 95% interval and bias, in mu."""
    mu = F.col("total") * F.lit(resolution * resolution * units.MU_PER_SQM)
    spread = F.when(F.col("n_i") > 1, F.col("w_i") * F.col("w_i") * F.col("cond") * (1 - F.col("cond")) / (F.col("n_i") - 1)).otherwise(0.0)
    by = p.groupBy(F.col("j").alias("code")).agg(F.sum("p").alias("share"), F.sqrt(F.sum(spread)).alias("share_se"))
    a = by.join(F.broadcast(weights), "code").where("code <> 0")
    r1 = lambda c: F.round(c, 1)
    a = a.select("code", "pixels", "weight", "share", "share_se", units.rounded(F.col("weight") * mu).alias("naive_mu"), r1(F.col("share") * mu).alias("calibrated_mu"), (F.col("share") * mu).alias("_c"), (F.col("share_se") * mu).alias("_s"))
    bias = F.col("naive_mu") - F.col("calibrated_mu")
    return a.select(
        "code", "pixels", "naive_mu", F.round(F.col("naive_mu") / units.MU_PER_HA, 2).alias("naive_ha"), "calibrated_mu", F.round(F.col("calibrated_mu") / units.MU_PER_HA, 2).alias("calibrated_ha"),
        r1(F.col("_s")).alias("se_mu"), F.round(F.col("_s") / F.greatest("_c", F.lit(1e-6)) * 100, 2).alias("cv_pct"),
        r1(F.greatest(F.lit(0.0), F.col("_c") - Z95 * F.col("_s"))).alias("ci_low_mu"), r1(F.col("_c") + Z95 * F.col("_s")).alias("ci_high_mu"),
        r1(bias).alias("bias_mu"), F.round(bias / F.greatest("calibrated_mu", F.lit(1e-6)) * 100, 1).alias("bias_pct"),
    )


def acreage_report(pixels: DataFrame, sample: DataFrame, legend: dict[int, str], resolution: float = 10.0, draws: int = 0, code: str = "code") -> DataFrame:
    """The full report: areas, accuracies as text, and the bootstrap interval when draws are asked for."""
    weights, p = prepare(pixels, sample, sorted(legend), code)
    acc = accuracy(p)
    out = areas(p, weights, resolution).join(acc, "code").join(F.broadcast(legend_table(pixels.sparkSession, legend)), "code")
    out = out.withColumn("users_accuracy", grading.accuracy_text(F.col("ua"), F.col("ua_se"))).withColumn("producers_accuracy", grading.accuracy_text(F.col("pa"), F.col("pa_se")))
    out = out.withColumn("grade", grading.cv_grade(F.col("cv_pct")))
    if draws:
        out = out.join(bootstrap_ci(sample, weights, sorted(legend), draws, resolution), "code")
    return out


def error_matrix_table(p: DataFrame, codes: list[int]) -> DataFrame:
    """The matrix for reading: a row a map class with p in percent, UA and W_i; a footer with PA and OA. All text."""
    acc = accuracy(p)
    cell = lambda x, d: F.format_string(f"%.{d}f", x)
    wide = p.groupBy("i").pivot("j", codes).agg(F.first(F.round(F.col("p") * 100, 4)))
    body = wide.join(acc, F.col("i") == F.col("code")).join(p.select("i", "w_i").distinct(), "i")
    rows = body.select(F.concat(F.lit("Map_"), F.col("i").cast("string")).alias("map_class"), *(cell(F.col(str(c)), 4).alias(f"ref_{c}") for c in codes), cell(F.round("ua", 4), 4).alias("ua"), cell(F.round("w_i", 5), 5).alias("w_i"))
    foot = acc.groupBy().pivot("code", codes).agg(F.first("pa")).crossJoin(acc.select("oa").limit(1))
    footer = foot.select(F.lit("PA").alias("map_class"), *(cell(F.round(F.col(str(c)), 4), 4).alias(f"ref_{c}") for c in codes), cell(F.round("oa", 4), 4).alias("ua"), F.lit("OA").alias("w_i"))
    return rows.unionByName(footer)


def _kinds(sample: DataFrame, codes: list[int]) -> DataFrame:
    """One row: the sample's class pairs and weights in their order, i, j, w and hi (rows up to and with each) as arrays."""
    w = F.col("weight") if "weight" in sample.columns else F.lit(1.0)
    kinds = sample.where(F.col("map_label").isin(codes) & F.col("true_label").isin(codes)).groupBy(F.col("map_label").cast("int").alias("i"), F.col("true_label").cast("int").alias("j"), w.cast("double").alias("w")).agg(F.count("*").alias("c"))
    listed = kinds.agg(F.sort_array(F.collect_list(F.struct("i", "j", "w", "c"))).alias("x"))
    return listed.select(*(F.col(f"x.{c}").alias(c) for c in ("i", "j", "w", "c")))


def _draw(draws: int, parts: int):
    """Of each part (every parts-th resample) the weight in each class pair."""

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            for part, i, j, w, c in zip(*(t[x].to_pylist() for x in ("part", "i", "j", "w", "c")), strict=True):
                i, j = np.asarray(i, np.int32), np.asarray(j, np.int32)
                hi = np.cumsum(np.asarray(c, np.int64))
                resamples = list(range(part, draws, parts))
                counts = np.zeros((len(resamples), len(hi)), np.int64)
                for at, x in md5.leading(resamples, int(hi[-1]) if len(hi) else 0):
                    counts[at] += np.bincount(np.searchsorted(hi, x.astype(np.int64) % hi[-1], "right"), minlength=len(hi))
                weight = counts * np.asarray([0.0 if x is None else x for x in w])
                pairs, pair_of = np.unique(np.stack([i, j], 1), axis=0, return_inverse=True)
                for b, row in zip(resamples, weight, strict=True):
                    n = np.bincount(pair_of.ravel(), row, len(pairs))
                    yield pa.RecordBatch.from_pydict({"b": pa.array(np.full(len(pairs), b), pa.int64()), "i": pa.array(pairs[:, 0], pa.int32()), "j": pa.array(pairs[:, 1], pa.int32()), "n": pa.array(n, pa.float64())})

    return drawn


def bootstrap(sample: DataFrame, weights: DataFrame, codes: list[int], draws: int = 200, protect: bool = True, order: tuple[str, ...] = ("map_label", "true_label")) -> DataFrame:
    """b, code, share: calibrated share of each class in each resample of the sample.

    Each resample is as large as the sample. Draw j of resample b takes the row that the first 32 bits of the MD5 of "b:j", mod the
    rows, name in the order of classes: the same on any engine. Equal rows are exchangeable, so rows are numbered by class pair and weight and drawn from running counts; a task draws whole resamples and gives
    back a row for each class pair.
    """
    spark = sample.sparkSession
    parts = max(1, min(draws, DRAW_TASKS))
    dealt = spark.range(0, parts, 1, parts).select(F.col("id").alias("part"))  # without a shuffle, whose small rows would become one task
    cells = dealt.crossJoin(F.broadcast(_kinds(sample, codes))).mapInArrow(_draw(draws, parts), "b long, i int, j int, n double")  # one row
    shape = spark.range(draws).select(F.col("id").alias("b")).crossJoin(F.broadcast(_all(codes=codes, spark=spark, names=("i", "j"))))
    full = shape.join(cells, ["b", "i", "j"], "left").select("b", "i", "j", F.coalesce("n", F.lit(0.0)).alias("n"))
    cond = conditional_matrix(full, ("b",))
    if protect and 0 in codes:
        cond = domain_protection(cond, weights, ("b",))
    return joint(cond, weights).groupBy("b", F.col("j").alias("code")).agg(F.sum("p").alias("share"))


def bootstrap_ci(sample: DataFrame, weights: DataFrame, codes: list[int], draws: int = 200, resolution: float = 10.0, level: float = 0.95, protect: bool = True) -> DataFrame:
    """code, boot_low_mu, boot_high_mu: percentile interval of the calibrated area."""
    a = (1 - level) / 2
    total = weights.select("total").limit(1)
    shares = bootstrap(sample, weights, codes, draws, protect).crossJoin(F.broadcast(total))
    mu = F.col("share") * F.col("total") * F.lit(resolution * resolution * units.MU_PER_SQM)
    return shares.groupBy("code").agg(F.percentile(mu, F.lit(a)).alias("lo"), F.percentile(mu, F.lit(1 - a)).alias("hi")).select("code", F.round("lo", 1).alias("boot_low_mu"), F.round("hi", 1).alias("boot_high_mu"))


def ppi_mean(everything: DataFrame, sample: DataFrame, value: str, truth: str, weight: str | None = None) -> DataFrame:
    """Prediction-powered mean: the map's mean, moved by the sample's mean error, with standard errors and what the map gains."""
    w = F.col(weight) if weight else F.lit(1.0)
    whole = everything.agg(F.avg(value).alias("map_mean"))
    gap = F.col(truth) - F.col(value)
    s = sample.agg(
        F.count("*").alias("n"), (F.sum(w * F.col(truth)) / F.sum(w)).alias("gt"), (F.sum(w * F.col(value)) / F.sum(w)).alias("ms"),
        (F.coalesce(F.stddev_samp(gap), F.lit(0.0)) / F.sqrt(F.count("*"))).alias("se"), (F.coalesce(F.stddev_samp(truth), F.lit(0.0)) / F.sqrt(F.count("*"))).alias("survey_se"),
    )
    est, r3 = F.col("map_mean") + F.col("gt") - F.col("ms"), lambda c: F.round(c, 3)
    gain = F.when(F.col("se") > 0, F.round(F.pow("survey_se", F.lit(2.0)) / F.greatest(F.pow("se", F.lit(2.0)), F.lit(1e-12)), 2)).otherwise(1.0)
    return whole.crossJoin(F.broadcast(s)).select(
        r3(est).alias("ppi_mean"), r3("se").alias("ppi_se"), r3(est - Z95 * F.col("se")).alias("ci_low"), r3(est + Z95 * F.col("se")).alias("ci_high"),
        r3("gt").alias("survey_mean"), r3("survey_se").alias("survey_se"), gain.alias("gain"),
    )


def neyman(weights: DataFrame, legend: dict[int, str], budget: int = 150, least: int = 20, prior_ua: dict[int, float] | None = None, resolution: float = 10.0) -> DataFrame:
    """How many samples each class should get: by size, by Neyman's rule, and with a floor, the rest going to the largest class."""
    spark, ua = weights.sparkSession, prior_ua or PRIOR_UA
    rows = [(c, name, float(ua.get(c, DEFAULT_UA))) for c, name in sorted(legend.items())]
    base = weights.join(F.broadcast(spark.createDataFrame(rows, "code int, name string, ua double")), "code")
    sigma = F.sqrt(F.greatest(F.lit(0.01), F.col("ua") * (1 - F.col("ua"))))
    base = base.withColumn("sigma", sigma)
    sums = base.agg(F.sum(F.col("weight") * F.col("sigma")).alias("ws"))
    share = budget * (F.col("weight") * F.col("sigma") / F.greatest("ws", F.lit(1e-12)))
    counts = base.crossJoin(F.broadcast(sums)).withColumn("proportional_n", F.bround(budget * F.col("weight")).cast("long")).withColumn("neyman_n", F.bround(share).cast("long"))
    counts = counts.withColumn("floored", F.greatest("neyman_n", F.lit(least).cast("long")))
    rest = counts.agg((F.lit(budget) - F.sum("floored")).alias("rest"), F.max_by("code", F.struct("weight", -F.col("code"))).alias("dominant"))
    final = F.when(F.col("code") == F.col("dominant"), F.greatest(F.lit(least).cast("long"), F.col("floored") + F.col("rest"))).otherwise(F.col("floored"))
    return counts.crossJoin(F.broadcast(rest)).select(
        "code", "name", units.rounded(F.col("weight") * F.col("total") * F.lit(resolution * resolution * units.MU_PER_SQM)).alias("map_area_mu"), F.round("weight", 4).alias("weight"), F.round("sigma", 3).alias("sigma"),
        "proportional_n", "neyman_n", final.alias("recommended_n"), F.round(final / F.lit(float(budget)) * 100, 1).alias("share_pct"),
    )


def naive_calibration(pixels: DataFrame, sample: DataFrame, codes: list[int], code: str = "code") -> DataFrame:
    """Calibrated pixel counts without domain protection."""
    weights, p = prepare(pixels, sample, codes, code, protect=False)
    total = weights.select("total").limit(1)
    return p.groupBy(F.col("j").alias("code")).agg(F.sum("p").alias("share")).crossJoin(F.broadcast(total)).select("code", F.round(F.col("share") * F.col("total"), 2).alias("calibrated_pixels"))


def agreement(df: DataFrame, predicted: str, true: str) -> DataFrame:
    """n, overall accuracy and Cohen's kappa."""
    cells = df.groupBy(F.col(predicted).alias("p"), F.col(true).alias("t")).agg(F.count("*").alias("n"))
    rows = cells.groupBy("p").agg(F.sum("n").alias("a"))
    cols = cells.groupBy("t").agg(F.sum("n").alias("b"))
    chance = rows.join(cols, F.col("p") == F.col("t")).agg(F.coalesce(F.sum(F.col("a").cast("double") * F.col("b")), F.lit(0.0)).alias("e"))
    hit = cells.agg(F.sum("n").alias("n"), F.sum(F.when(F.col("p") == F.col("t"), F.col("n")).otherwise(0)).alias("h"))
    x = hit.crossJoin(F.broadcast(chance))
    oa, pe = F.col("h") / F.col("n"), F.col("e") / (F.col("n").cast("double") * F.col("n"))
    return x.select("n", oa.alias("oa"), F.when(pe < 1, (oa - pe) / (1 - pe)).otherwise(0.0).alias("kappa"))
