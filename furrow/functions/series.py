"""Features of value series held as ARRAY<DOUBLE> columns: no explode, no UDF."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

Z = lambda: F.lit(0.0)


def at(v: Column, i: Column | int) -> Column:
    """Value i from 0 on, null outside."""
    return F.get(v, i if isinstance(i, Column) else F.lit(i))


def total(v: Column) -> Column:
    return F.aggregate(v, Z(), lambda a, x: a + x)


def mean(v: Column) -> Column:
    """Mean of the values that are not null; 0 for an empty series, null where all are null."""
    known = F.filter(v, lambda x: x.isNotNull())
    return F.when(F.size(v) > 0, F.try_divide(total(known), F.size(known))).otherwise(Z())


def std(v: Column) -> Column:
    """Population standard deviation."""
    m = mean(v)
    return F.when(F.size(v) > 0, F.sqrt(F.aggregate(v, Z(), lambda a, x: a + (x - m) * (x - m)) / F.size(v))).otherwise(Z())


def span(v: Column) -> Column:
    return F.array_max(v) - F.array_min(v)


def gradient(v: Column) -> Column:
    """Central differences, one-sided at both ends; [0] for fewer than two values."""
    last = F.size(v) - 1
    inner = F.transform(v, lambda x, i: F.when(i == 0, at(v, 1) - x).when(i == last, x - at(v, i - 1)).otherwise((at(v, i + 1) - at(v, i - 1)) / 2))
    return F.when(F.size(v) >= 2, inner).otherwise(F.array(Z()))


def slopes(v: Column, n: int) -> dict[str, Column]:
    """Early, middle and late slope of n values."""
    if n < 4:
        return {"early": (at(v, n - 1) - at(v, 0)) / max(1, n - 1), "mid": Z(), "late": Z()}
    ie = max(1, n // 4)
    im, il = max(ie + 1, n // 2), min(n - 1, 3 * n // 4)
    return {"early": (at(v, ie) - at(v, 0)) / max(1, ie), "mid": (at(v, il) - at(v, im)) / max(1, il - im), "late": (at(v, n - 1) - at(v, il)) / max(1, n - 1 - il)}


def paddy(v: Column, n: int) -> dict[str, Column]:
    """Flooding dip, rebound and their index."""
    if n < 3:
        return {"dip": Z(), "rebound": Z(), "index": Z()}
    low = F.array_min(F.slice(v, 1, max(2, (n + 1) // 2)))
    dip, rebound = F.greatest(Z(), at(v, 0) - low), F.greatest(Z(), F.array_max(v) - low)
    over = lambda x: F.when(x > 0.02, x + 0.05).otherwise(F.lit(0.05))
    index = dip / over(at(v, 0)) * rebound / over(F.array_max(v))
    return {"dip": dip, "rebound": rebound, "index": F.when(F.isnan(index) | index.isNull(), Z()).otherwise(index)}


def harmonic(v: Column, n: int, k: int) -> dict[str, Column]:
    """Amplitude and phase of harmonic k; 0 for series too short for it (8 values for the first, 12 for the second)."""
    if n < (8 if k == 1 else 12):
        return {"amp": Z(), "phase": Z()}
    turn = lambda f, sign: F.aggregate(F.transform(v, lambda x, i: sign * x * f(2 * math.pi * k * i / n)), Z(), lambda a, x: a + x)
    re, im = turn(F.cos, 1.0), turn(F.sin, -1.0)
    return {"amp": F.sqrt(re * re + im * im) / n, "phase": F.atan2(im, re)}


def features(ndvi: Column, n: int, lswi: Column | None = None, gcvi: Column | None = None, cv: Column | None = None) -> dict[str, Column]:
    """All per-pixel features of a series of n values, by name."""
    g, s, p = gradient(ndvi), slopes(ndvi, n), paddy(ndvi, n)
    out = {
        "max": F.array_max(ndvi), "min": F.array_min(ndvi), "range": span(ndvi), "std": std(ndvi),
        "grad_max": F.array_max(g), "grad_min": F.array_min(g), "grad_abs": mean(F.transform(g, F.abs)),
        "slope_early": s["early"], "slope_mid": s["mid"], "slope_late": s["late"],
        "dip": p["dip"], "rebound": p["rebound"], "paddy": p["index"],
    }
    both = lswi is not None
    out |= {f"lswi_{k}": f(lswi) if both else Z() for k, f in (("max", F.array_max), ("min", F.array_min), ("mean", mean), ("std", std))}
    out["lswi_gap"] = mean(lswi) - mean(ndvi) if both else Z()
    out |= {"gcvi_max": F.array_max(gcvi) if gcvi is not None else Z(), "gcvi_mean": mean(gcvi) if gcvi is not None else Z()}
    out |= {"cv_mean": mean(cv) if cv is not None else Z(), "cv_max": F.array_max(cv) if cv is not None else Z()}
    for k in (1, 2):
        h = harmonic(ndvi, n, k)
        out |= {f"amp{k}": h["amp"], f"phase{k}": h["phase"]}
    return out


def fill_gaps(v: Column) -> Column:
    """Missing values (null or NaN) by linear interpolation, the ends held; all missing gives zeros."""
    known = F.filter(F.transform(v, lambda x, i: F.struct(i.cast("double").alias("t"), F.nanvl(x, F.lit(None).cast("double")).alias("v"))), lambda s: s["v"].isNotNull())
    return F.when(F.size(known) == 0, F.transform(v, lambda x: Z())).otherwise(F.transform(v, lambda x, i: interpolate(known, i.cast("double"))))


def interpolate(known: Column, t: Column) -> Column:
    """The value at t of points (t, v) in ascending order, linear between, held beyond the ends."""
    before, after = F.filter(known, lambda s: s["t"] <= t), F.filter(known, lambda s: s["t"] >= t)
    a, b = F.element_at(before, -1), F.get(after, F.lit(0))
    return F.when(F.size(before) == 0, b["v"]).when(F.size(after) == 0, a["v"]).when(a["t"] == b["t"], a["v"]).otherwise(a["v"] + (b["v"] - a["v"]) * (t - a["t"]) / (b["t"] - a["t"]))


def resample(days: Column, values: Column, target: list[float]) -> Column:
    """A series at other days of the year. Days that are months (none above 12) stand for 30.5 m - 15."""
    day = F.when(F.array_max(days) <= 12, F.transform(days, lambda d: 30.5 * d - 15)).otherwise(F.transform(days, lambda d: d.cast("double")))
    known = F.array_sort(F.filter(F.zip_with(day, values, lambda d, v: F.struct(d.alias("t"), v.alias("v"))), lambda s: s["v"].isNotNull()))
    return F.transform(F.array(*(F.lit(float(t)) for t in target)), lambda t: interpolate(known, t))


def repair_spikes(v: Column, drop: float = 0.18) -> Column:
    """A value that lies `drop` below both neighbours becomes their mean, left to right, on values already repaired."""
    last = F.size(v) - 1

    def step(acc: Column, x: Column) -> Column:
        i, before, after = acc["i"], F.element_at(acc["out"], -1), at(v, acc["i"] + 1)
        low = (i > 0) & (i < last) & (x < before - drop) & (x < after - drop)
        return F.struct(F.concat(acc["out"], F.array(F.when(low, (before + after) / 2).otherwise(x))).alias("out"), (i + 1).alias("i"))

    first = F.struct(F.array(at(v, 0)).alias("out"), F.lit(1).alias("i"))
    return F.when(F.size(v) < 3, v).otherwise(F.aggregate(F.slice(v, F.lit(2), F.greatest(F.size(v) - 1, F.lit(0))), first, step)["out"])


#: Second-order fits over five points; the first two rows serve the ends, mirrored at the other one.
SAVGOL = ((31, 9, -3, -5, 3), (9, 13, 12, 6, -5), (-3, 12, 17, 12, -3))


def savgol(v: Column, n: int) -> Column:
    """Second-order smoothing over five points; fewer than five values come back as they are."""
    if n < 5:
        return v

    def value(x: Column, i: Column) -> Column:
        dot = lambda begin, row: sum((k * at(v, begin + j) for j, k in enumerate(row)), F.lit(0.0)) / 35.0
        return (
            F.when(i == 0, dot(F.lit(0), SAVGOL[0])).when(i == 1, dot(F.lit(0), SAVGOL[1]))
            .when(i == n - 2, dot(F.lit(n - 5), SAVGOL[1][::-1])).when(i == n - 1, dot(F.lit(n - 5), SAVGOL[0][::-1])).otherwise(dot(i - 2, SAVGOL[2]))
        )

    return F.transform(v, value)


def smooth(v: Column, n: int) -> Column:
    """Gaps filled, spikes repaired, smoothed."""
    return savgol(repair_spikes(fill_gaps(v)), n)
