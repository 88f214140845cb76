"""Quality checks of the merged table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treatflow.fixed_values import ACTIVITY_MAP, MGT_TYPE_WORDS, OLDER_ACTIVITY_COLUMNS, SINGLE_CHOICE_COLUMNS
from treatflow.functions.strings import strip


def normalized_mgt_type(mgt_type: Column) -> Column:
    """Type by the first word the text contains; other texts stay."""
    text = F.replace(F.lower(mgt_type), F.lit(" "), F.lit(""))
    out = None
    for word, value in MGT_TYPE_WORDS:
        test = F.contains(text, F.lit(word))
        out = F.when(test, F.lit(value)) if out is None else out.when(test, F.lit(value))
    return out.otherwise(mgt_type)


def no_mgt_type(mgt_type: Column) -> Column:
    return F.coalesce(mgt_type, F.lit("")) == ""


def single_activity(df: DataFrame, columns=SINGLE_CHOICE_COLUMNS) -> DataFrame:
    """ACTIVITY from the one filled column; ``activity_error`` when none, several or not allowed."""
    filled = F.filter(F.array(*[F.col(c) for c in columns]), lambda v: v.isNotNull() & ~v.isin("", " "))
    values = F.transform(filled, lambda v: strip(v))
    one = F.size(values) == 1
    value = F.get(values, F.lit(0))
    return df.withColumns(
        {
            "ACTIVITY": F.when(one, value).otherwise(F.lit("")),
            "activity_error": ~(one & value.isin(list(ACTIVITY_MAP))),
        }
    )


def activity_columns(df: DataFrame, activity: str,
                     table: Mapping[str, tuple[str, str]] = OLDER_ACTIVITY_COLUMNS) -> DataFrame:
    """The activity in its one column, '' in the other three, and its type.

    An unknown activity leaves all as they were and sets ``unknown_activity``.
    """
    label = strip(F.col(activity))
    known = F.coalesce(label.isin(list(table)), F.lit(False))
    columns = list(dict.fromkeys(c for c, _ in table.values()))
    new = {}
    for c in columns:
        mine = [a for a, (col, _) in table.items() if col == c]
        new[c] = F.when(known, F.when(label.isin(mine), label).otherwise(F.lit(""))).otherwise(F.col(c))
    kinds = F.create_map(*[F.lit(v) for a, (_, kind) in table.items() for v in (a, kind)])
    new["MGT_TYPE"] = F.coalesce(F.try_element_at(kinds, label), F.col("MGT_TYPE"))
    new["unknown_activity"] = ~known & F.coalesce(F.col(activity) != "", F.lit(False))
    return df.withColumns(new)


def year_out_of_range(year: Column, first: int = 2000, last: int = 2024) -> Column:
    return F.coalesce(~year.between(first, last), F.lit(False))


def qa_flags(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """``qa_flags`` lists the failed checks in order; ``ERROR_FLAG`` is the last one."""
    flags = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in checks.items()]))
    return df.withColumn("qa_flags", flags).withColumn("ERROR_FLAG", F.try_element_at(F.col("qa_flags"), F.lit(-1)))
