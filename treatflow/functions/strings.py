"""Null words and trimming."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space when text is trimmed.
WHITE_SPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Trim all white space, not only blanks."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def empty_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def blank_to_null(text: Column, words: Sequence[str] = ()) -> Column:
    """Trimmed value, or null when blank or one of the (lower-case) null words."""
    value = strip(text.cast("string"))
    return F.when(~F.lower(value).isin("", *words), value)


def key_part(text: Column, words: Sequence[str]) -> Column:
    """Trimmed lookup key; null and null words give ''."""
    return F.coalesce(blank_to_null(text, words), F.lit(""))
