"""Delimited lists held in text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from treatflow.fixed_values import LIST_NULL_WORDS
from treatflow.functions.strings import empty_to_null, strip


def tokens(text: Column, separators: str) -> Column:
    """Trimmed, non-blank items between the separator characters."""
    parts = F.split(F.coalesce(text, F.lit("")), f"[{separators}]")
    return F.filter(F.transform(parts, lambda v: strip(v)), lambda v: v != "")


def longest_first(values: Column) -> Column:
    """Longest value first; values of one length keep their order."""
    keyed = F.transform(values, lambda v, i: F.struct((-F.length(v)).alias("n"), i.alias("i"), v.alias("v")))
    return F.transform(F.array_sort(keyed), lambda s: s["v"])


def clean_list(text: Column) -> Column:
    """Distinct items, longest first, without items contained in a kept one (any case)."""
    items = F.filter(tokens(text, ";,"), lambda v: ~F.upper(v).isin(LIST_NULL_WORDS))
    return F.aggregate(
        longest_first(F.array_distinct(items)),
        F.array().cast("array<string>"),
        lambda kept, v: F.when(
            F.exists(kept, lambda k: F.contains(F.upper(k), F.upper(v))), kept
        ).otherwise(F.array_append(kept, v)),
    )


def distinct_list(text: Column) -> Column:
    """Items between ``'; '``, first occurrences in order, joined by ``', '``; none gives null."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), "; "), lambda v: strip(v))
    kept = F.filter(parts, lambda v: ~F.lower(v).isin("", "none"))
    return empty_to_null(F.array_join(F.array_distinct(kept), ", "))


def drop_other(names: Column, other: str = "Other") -> Column:
    """Distinct names in order; the catch-all name goes when a real one is there."""
    unique = F.array_distinct(names)
    real = F.filter(unique, lambda n: n != other)
    return F.when(F.size(real) > 0, real).otherwise(unique)
