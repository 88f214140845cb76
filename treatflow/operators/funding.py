"""Funding codes to names and types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treatflow.functions.lists import drop_other, tokens
from treatflow.functions.strings import strip
from treatflow.operators.crosswalk import resolve_codes


def fund_names(df: DataFrame, lookup: DataFrame, codes: str = "FUND_CODE") -> DataFrame:
    """``funding_update``: distinct fund names of a code list; ``funding_type`` is always Federal.

    The whole text is tried as one key before it is split at commas and bars.  Unknown codes are
    ``Other``, dropped when a known one is there; no code at all gives ``No Funding Code``.
    """
    blank = F.col(codes).isNull() | (F.col(codes) == "")
    whole = F.array(strip(F.col(codes)))
    with_codes = df.withColumn("__codes", F.concat(whole, tokens(F.col(codes), ",|")))
    named = resolve_codes(with_codes, "__codes", lookup, "fund_code", ["fund_source"])
    names = F.transform(F.col("__codes"), lambda s: F.coalesce(s["fund_source"], F.lit("Other")))
    known_whole = F.get(F.col("__codes"), F.lit(0))["fund_source"].isNotNull()
    chosen = F.when(known_whole, F.slice(names, 1, 1)).otherwise(
        drop_other(F.slice(names, 2, F.greatest(F.size(names) - 1, F.lit(0))))
    )
    return named.withColumns(
        {
            "funding_update": F.when(blank, F.lit("No Funding Code")).otherwise(F.array_join(chosen, ", ")),
            "funding_type": F.lit("Federal"),
        }
    ).drop("__codes")


def fund_source_type(df: DataFrame, lookup: DataFrame, funding: str = "FUNDING") -> DataFrame:
    """FUND_SOURCE, FUND_TYPE and ``fund_flag`` of a list split at commas and slashes."""
    unknown = F.lit("Unknown")
    blank = F.coalesce(strip(F.col(funding)), F.lit("")) == ""
    with_codes = df.withColumn("__codes", tokens(F.col(funding), ",/"))
    found = resolve_codes(with_codes, "__codes", lookup, "fund_code", ["fund_source", "fund_type"])

    def text(field: str):
        return F.array_join(
            F.array_distinct(F.transform(F.col("__codes"), lambda s: F.coalesce(s[field], unknown))), ", "
        )

    source, kind = text("fund_source"), text("fund_type")
    return found.withColumns(
        {
            "FUND_SOURCE": F.when(blank, unknown).otherwise(source),
            "FUND_TYPE": F.when(blank, unknown).otherwise(kind),
            "fund_flag": ~blank & (F.contains(source, unknown) | F.contains(kind, unknown)),
        }
    ).drop("__codes")
