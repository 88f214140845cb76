"""Keyword classification of records and the routing of its results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treatflow.fixed_values import DELETE, KEYWORD_RULES, NOT_A_LABEL, REVIEW_LABELS, UNCLASSIFIED
from treatflow.functions.keywords import keyword_classes
from treatflow.functions.strings import empty_to_null, strip
from treatflow.functions.text import combine_text

CLASS_COLUMNS = ["ActClass_1", "Keyword_1", "ActClass_2", "Keyword_2", "ActClass_3", "Keyword_3"]


def classify_treatments(df: DataFrame, fields: Sequence[str], rules: Sequence[tuple[str, str]] = KEYWORD_RULES,
                        width: int | None = None) -> DataFrame:
    """Combine the text fields and add the first three keyword classes; none gives UNCLASSIFIED."""
    combined = df.withColumn("Class_Combine", combine_text([F.col(f) for f in fields], width))
    return keyword_classes(combined, "Class_Combine", rules)


def explode_activity(df: DataFrame) -> DataFrame:
    """One row per distinct label, with its keyword; no label gives one UNCLASSIFIED row."""
    pairs = F.array(*[F.struct(empty_to_null(F.col(f"ActClass_{n}")).alias("activity_reclass"),
                               F.col(f"Keyword_{n}").alias("Keyword")) for n in (1, 2, 3)])
    labelled = F.filter(pairs, lambda p: p["activity_reclass"].isNotNull())
    firsts = F.filter(
        labelled,
        lambda p, i: F.array_position(
            F.transform(labelled, lambda q: q["activity_reclass"]), p["activity_reclass"]
        ) == i + 1,
    )
    none = F.array(F.struct(F.lit(UNCLASSIFIED).alias("activity_reclass"), F.lit("None").alias("Keyword")))
    rows = F.when(F.size(firsts) > 0, firsts).otherwise(none)
    base = df.drop("activity_reclass", "Keyword")
    return base.select("*", F.inline(rows))


def _is_real(label: Column) -> Column:
    return F.coalesce(~strip(label).isin(NOT_A_LABEL), F.lit(False))


def drop_redundant_delete(df: DataFrame) -> DataFrame:
    """Drop a DELETE row when its record has any real label."""
    labels = [c for c in ("ActClass_1", "ActClass_2", "ActClass_3", "ACT_CSV") if c in df.columns]
    real = F.lit(False)
    for c in labels:
        real = real | _is_real(F.col(c))
    return df.filter(~(F.coalesce(F.col("activity_reclass") == DELETE, F.lit(False)) & real))


def route_of(label: Column) -> Column:
    """deleted, review or classified; null without a label."""
    return (
        F.when(label == DELETE, F.lit("deleted"))
        .when(label.isin(REVIEW_LABELS), F.lit("review"))
        .when(label.isNotNull(), F.lit("classified"))
    )


def route(df: DataFrame, label: str = "activity_reclass") -> DataFrame:
    """Add ``route``; class columns go."""
    drop = {c.lower() for c in CLASS_COLUMNS} | {"status"}
    return df.withColumn("route", route_of(F.col(label))).drop(*[c for c in df.columns if c.lower() in drop])


def split_routes(df: DataFrame) -> DataFrame:
    """Explode, clean and route in one narrow pass."""
    return route(drop_redundant_delete(explode_activity(df))).filter(F.col("route").isNotNull())
