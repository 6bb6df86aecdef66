"""Two-date transitions and rotation compliance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.functions import units
from furrow.operators.estimate import _all


def pair(early: DataFrame, late: DataFrame, keys: tuple[str, ...] = ("r", "c"), code: str = "code") -> DataFrame:
    """The two dates' classes of each pixel that both have."""
    return early.select(*keys, F.col(code).alias("early")).join(late.select(*keys, F.col(code).alias("late")), list(keys))


def transition_matrix(pairs: DataFrame, codes: list[int], resolution: float = 10.0) -> DataFrame:
    """early, late, pixels, mu: every pair of legend codes, zero-filled."""
    counted = pairs.groupBy(F.col("early").cast("int").alias("early"), F.col("late").cast("int").alias("late")).agg(F.count("*").alias("pixels"))
    shape = _all(codes=codes, spark=pairs.sparkSession, names=("early", "late"))
    n = F.coalesce("pixels", F.lit(0))
    return shape.join(counted, ["early", "late"], "left").select("early", "late", n.cast("long").alias("pixels"), units.rounded(n * F.lit(resolution * resolution * units.MU_PER_SQM)).alias("mu"))


def transition_table(matrix: DataFrame, legend: dict[int, str], early: int = 2020, late: int = 2023) -> DataFrame:
    """The matrix for reading: a row an early class, a column a late class."""
    names = F.create_map(*(x for c, n in legend.items() for x in (F.lit(c), F.lit(n))))
    wide = matrix.groupBy("early").pivot("late", sorted(legend)).agg(F.first("mu"))
    return wide.select(F.concat(F.lit(f"{early}年_"), names[F.col("early")]).alias("class"), *(F.col(str(c)).alias(f"{late}年_{legend[c]}") for c in sorted(legend)))


def compliance(matrix: DataFrame, legend: dict[int, str], early: int = 2020, late: int = 2023, soy_codes: tuple[int, ...] = (3,), resolution: float = 10.0) -> DataFrame:
    """What the transitions say: grain to soy, each crop grown twice (where any), land left fallow.

    The grain record needs both kinds of crop in the legend. Soy is what the legend names so, and soy_codes.
    """
    mu = lambda cond: units.rounded(F.sum(F.when(cond, F.col("pixels")).otherwise(0)) * F.lit(resolution * resolution * units.MU_PER_SQM))
    soy = [c for c, name in legend.items() if "豆" in name or c in soy_codes]
    grain = [c for c in legend if c != 0 and c not in soy]
    sums = [mu((F.col("early") > 0) & (F.col("late") == 0)).alias("fallow"), *([mu(F.col("early").isin(grain) & F.col("late").isin(soy)).alias("grain")] if soy and grain else []), *(mu((F.col("early") == c) & (F.col("late") == c)).alias(f"mono_{c}") for c in legend if c)]
    record = lambda kind, meaning, area, advice: F.struct(F.lit(kind).alias("kind"), F.lit(meaning).alias("meaning"), area.alias("mu"), F.lit(advice).alias("advice"))
    rows = []
    if soy and grain:
        rows.append(record("🌾 粮豆健康轮作", f"{early}年主要粮食 -> {late}年大豆/豆类", F.col("grain"), "建议纳入国家大豆玉米带状复合种植/轮作补贴核发白名单"))
    rows += [record(f"⚠️ 连作重茬地块 ({legend[c]})", f"{early}年与{late}年连续重茬种植{legend[c]}", F.col(f"mono_{c}"), "提示土传病害与地力透支风险，建议下期实施深松改土或间套轮作") for c in sorted(legend) if c]
    rows.append(record("🚨 疑似耕地撂荒/休耕", f"{early}年为在耕农田 -> {late}年退化为背景/撂荒裸地", F.col("fallow"), "向基层农技部门派发带经纬度地块核查工单，排查弃耕原因"))
    # one aggregate over a row for each pair of classes
    return matrix.agg(*sums).select(F.explode(F.array(*rows)).alias("x")).select("x.*").where(~F.col("kind").contains("连作") | (F.col("mu") > 0))
