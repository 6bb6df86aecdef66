"""Grades, badges, formats and shapes for reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values.
CV_BADGES = ("badge-opt", "badge-good", "badge-warn", "badge-danger")
CV_TEXTS = (
    "极高精度（优于联合国 5% 卓越统计控制标准，具备国家级法定直报采信资格）",
    "优良（符合联合国 10% 统计调查规程标准，具备官方直接采信资格）",
    "可接受（处于 10%~20% 统计监测允许区间，建议后续加密样方以进一步提升精度）",
    "抽样误差偏大（变异系数高于 20%，需扩充实地调查样方或优化分层以收敛误差）",
)


def cv_grade(cv: Column, words: tuple[str, ...] = CV_BADGES) -> Column:
    return F.when(cv <= 5, words[0]).when(cv <= 10, words[1]).when(cv <= 20, words[2]).otherwise(words[3])


def suitability_badge(text: Column) -> Column:
    return F.when(text.contains("优"), "badge-opt").when(text.contains("良"), "badge-good").otherwise("badge-warn")


def compliance_badge(kind: Column) -> Column:
    return F.when(kind.contains("粮豆"), "badge-opt").when(kind.contains("连作"), "badge-warn").otherwise("badge-danger")


def kpi(value: Column, calibrated: Column) -> Column:
    """struct(value, unit): areas in 亿亩 once the calibrated one reaches ten million mu, else in 万亩."""
    large = calibrated >= 1e7
    return F.struct(F.when(large, F.round(value / 1e8, 2)).otherwise(F.round(value / 1e4, 1)).alias("value"), F.when(large, "亿亩").otherwise("万亩").alias("unit"))


def isoperimetric(area: Column, perimeter: Column) -> Column:
    """4 pi A / P^2; 0 for an empty outline."""
    return F.when(perimeter > 0, 4 * F.pi() * area / (perimeter * perimeter)).otherwise(F.lit(0.0))


def exported_compactness(area: Column, perimeter: Column) -> Column:
    return F.round(F.greatest(F.lit(0.01), F.least(F.lit(1.0), isoperimetric(area, perimeter))), 3)


def parcel_name(n: Column) -> Column:
    return F.concat(F.lit("P"), F.when(F.length(n.cast("string")) < 4, F.lpad(n.cast("string"), 4, "0")).otherwise(n.cast("string")))


def accuracy_text(share: Column, se: Column) -> Column:
    """`93.0% ± 2.8%`."""
    return F.format_string("%.1f%% ± %.1f%%", share * 100, se * 100)


#: Colours of crop codes 0 to 15, and the 20 that take turns where there are more classes (0 keeps its own).
PALETTE = (
    "#ecf0f1", "#f39c12", "#2ecc71", "#3498db", "#1abc9c", "#e74c3c", "#9b59b6", "#f1c40f",
    "#16a085", "#d35400", "#8e44ad", "#27ae60", "#7f8c8d", "#c0392b", "#2980b9", "#f368e0",
)
MANY = (
    "#1f77b4", "#aec7e8", "#ff7f0e", "#ffbb78", "#2ca02c", "#98df8a", "#d62728", "#ff9896", "#9467bd", "#c5b0d5",
    "#8c564b", "#c49c94", "#e377c2", "#f7b6d2", "#7f7f7f", "#c7c7c7", "#bcbd22", "#dbdb8d", "#17becf", "#9edae5",
)


def crop_colour(code: Column, n_classes: int) -> Column:
    """The colour of a class in a map of n_classes."""
    colours = PALETTE if n_classes <= len(PALETTE) else (PALETTE[0], *MANY[1:])
    many = n_classes > len(PALETTE)
    place = F.when(code == 0, 0).when(F.pmod(code, F.lit(20)) == 0, 20).otherwise(F.pmod(code, F.lit(20))) if many else code
    return F.element_at(F.array(*(F.lit(c) for c in (*colours, MANY[0]))), (place + 1).cast("int"))
