"""Text helpers: trimming, cleaning, names and objective texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from treatflow.fixed_values import PLACEHOLDER_DOC_NAMES
from treatflow.functions.lists import clean_list, distinct_list
from treatflow.functions.strings import blank_to_null, empty_to_null, strip

__all__ = ["clean_text", "combine_text", "clean_doc_name", "project_name", "objective_text", "provenance"]


def clean_text(text: Column) -> Column:
    """Lower case, letters and digits only, single spaces; null gives ''."""
    spaced = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " ")
    return F.trim(spaced)


def combine_text(columns: Sequence[Column], width: int | None = None) -> Column:
    """Non-empty values joined by a space; blank result gives null.

    ``width`` is the width of the target column where it has one; by default the whole text is kept.
    """
    joined = F.concat_ws(" ", *[empty_to_null(c.cast("string")) for c in columns])
    out = joined if width is None else F.substring(joined, 1, width)
    return F.when(strip(joined) != "", out)


def clean_doc_name(name: Column) -> Column:
    """Placeholder or blank document names give null; a leading ``(PALS)`` mark is removed."""
    return F.when(
        name.isNotNull() & (strip(name) != "") & ~name.isin(PLACEHOLDER_DOC_NAMES),
        F.when(name.startswith("(PALS)"), strip(F.replace(name, F.lit("(PALS)"), F.lit("")))).otherwise(name),
    )


def project_name(treatment: Column, document: Column) -> Column:
    """``treatment, [NEPA] document`` from two delimited lists, or the one that exists."""
    left = empty_to_null(F.array_join(clean_list(treatment), ", "))
    right = empty_to_null(F.array_join(clean_list(document), ", "))
    both = F.concat_ws(", ", left, F.concat(F.lit("[NEPA] "), right))
    return F.coalesce(empty_to_null(both), F.lit("Unknown"))


def objective_text(description: Column, comment: Column, width: int | None = None) -> Column:
    """Description and comment as one distinct list; whole, unless a caller's target has a ``width``."""
    joined = F.concat(F.coalesce(description, F.lit("")), F.lit("; "), F.coalesce(comment, F.lit("")))
    whole = distinct_list(F.btrim(joined, F.lit("; ")))
    return whole if width is None else F.substring(whole, 1, width)


def provenance(file_name: Column, date_text: str) -> Column:
    """``<base name without extension> <date>``."""
    base = F.regexp_extract(file_name, r"([^/\\]*)$", 1)
    return F.concat_ws(" ", F.regexp_replace(base, r"\.[^.]*$", ""), F.lit(date_text))
