"""Completion date and year from prioritized date columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from treatflow.fixed_values import START_YEAR


def completion_date(dates: Sequence[Column]) -> Column:
    """First date that is not null."""
    return F.coalesce(*dates)


def completion_year(dates: Sequence[Column], min_year: int = START_YEAR) -> Column:
    """Year of the first date that is in or after ``min_year``."""
    return F.coalesce(*[F.when(F.year(d) >= min_year, F.year(d)) for d in dates])
