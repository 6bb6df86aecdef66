"""Areas: square metres, mu and hectares."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
MU_PER_SQM = 0.0015
SQM_PER_MU = 1 / 0.0015
SQM_PER_HA = 10000.0
MU_PER_HA = 15.0
WAN_MU = 10000.0


def rounded(x: Column, digits: int = 1, hair: float = 1e-9) -> Column:
    """Round halves up. An area that should end in a half may lie a hair below it in binary, after long sums by more than one."""
    return F.round(x + hair, digits)


def sqm_to_mu(x: Column) -> Column:
    return x * F.lit(MU_PER_SQM)


def mu_to_sqm(x: Column) -> Column:
    return x * F.lit(SQM_PER_MU)


def sqm_to_ha(x: Column) -> Column:
    return x / F.lit(SQM_PER_HA)


def ha_to_sqm(x: Column) -> Column:
    return x * F.lit(SQM_PER_HA)


def mu_to_ha(x: Column) -> Column:
    return x / F.lit(MU_PER_HA)


def ha_to_mu(x: Column) -> Column:
    return x * F.lit(MU_PER_HA)


def format_area(sqm: Column, precision: int = 2) -> Column:
    """Square metres as a struct of rounded m2, mu, ha and ten thousand mu (two more decimals)."""
    mu = sqm_to_mu(sqm)
    return F.struct(
        F.round(sqm, precision).alias("area_m2"), F.round(mu, precision).alias("area_mu"), F.round(sqm_to_ha(sqm), precision).alias("area_ha"), F.round(mu / F.lit(WAN_MU), precision + 2).alias("area_wan_mu")
    )
