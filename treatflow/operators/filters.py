"""Row filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treatflow.fixed_values import (
    END_YEAR, EXCLUDE, SLIVER_CHECK_ACRES, SLIVER_COMPACTNESS, SLIVER_FLOOR_ACRES, START_YEAR,
)
from treatflow.functions.geometry import compactness, repaired_rows


def region(df: DataFrame, value: str, column: str = "STATE_ABBR") -> DataFrame | None:
    """Rows of one region; a table without the column is skipped (None)."""
    return df.filter(F.col(column) == value) if column in df.columns else None


def filter_year(df: DataFrame, column: str = "YEAR_COMP", start: int = START_YEAR, end: int = END_YEAR) -> DataFrame:
    """Years in the range, both ends included; null years go."""
    return df.filter(F.col(column).between(start, end))


def drop_excluded(df: DataFrame, label: str) -> DataFrame:
    return df.filter(F.col(label) != EXCLUDE)


def repaired(df: DataFrame, geom: str = "geom") -> DataFrame:
    """Repair polygons and drop the rows that have none left.

    A generator does both at once; a filter on the repaired column would repair every row twice.
    """
    return df.select(*[c for c in df.columns if c != geom], repaired_rows(geom).alias(geom))


def is_sliver(acres: Column, area: Column, perimeter: Column, min_acres: float = SLIVER_CHECK_ACRES) -> Column:
    """Missing, tiny, or small and thin."""
    thin = (acres < min_acres) & (perimeter > 0) & (compactness(area, perimeter) < SLIVER_COMPACTNESS)
    return (
        acres.isNull() | area.isNull() | F.coalesce(acres <= SLIVER_FLOOR_ACRES, F.lit(False))
        | F.coalesce(thin, F.lit(False))
    )


def drop_slivers(df: DataFrame, acres: str, area: str, perimeter: str) -> DataFrame:
    return df.filter(~is_sliver(F.col(acres), F.col(area), F.col(perimeter)))
