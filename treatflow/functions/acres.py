"""Managed acreage rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from treatflow.fixed_values import CLAMP_ACRES_PER_SQ_M


def _reported(units: Column) -> Column:
    return units.isNotNull() & (units != 0)


def clamped_acres(units: Column, area_sq_m: Column) -> Column:
    """Reported units, never more than the footprint; footprint when none are reported."""
    gis = F.coalesce(area_sq_m, F.lit(0.0)) * CLAMP_ACRES_PER_SQ_M
    return F.when(_reported(units), F.least(units, gis)).otherwise(gis)


def clamped_acres_by_unit(unit: Column, value: Column, gis_acres: Column) -> Column:
    """As above, but only values whose unit is acres count as reported."""
    in_acres = F.coalesce(F.lower(unit) == "acres", F.lit(False))
    return F.when(in_acres & _reported(value), F.least(value, gis_acres)).otherwise(gis_acres)


def managed_acres(reported: Column, gis_acres: Column) -> Column:
    return F.coalesce(reported, gis_acres)
