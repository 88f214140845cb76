"""Writing staged layers, archives, routed outputs and review tables.  Row counts come from the one write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treatflow.fixed_values import ROUTES
from treatflow.operators.counts import StepCounts


def write_layer(df: DataFrame, path: str) -> int:
    """Overwrite a staged layer; gives the number of rows written."""
    counts = StepCounts()
    counts.step(df, path).write.mode("overwrite").parquet(path)
    return counts.rows()[0][2]


def archive_layers(df: DataFrame, path: str) -> int:
    """The standardized rows of every source layer, one folder per layer; layers that ``df`` lacks stay as they are."""
    counts = StepCounts()
    counts.step(df, path).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("layer").parquet(path)
    return counts.rows()[0][2]


def write_routes(df: DataFrame, path: str) -> dict[str, int]:
    """Deleted, review and classified rows, one folder per route, written in one pass; gives the rows of each route.

    The whole output is replaced, so a route without rows leaves no rows of an earlier run.
    """
    counts = StepCounts()
    by_route = counts.parts(df, {r: F.col("route") == r for r in ROUTES})
    by_route.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("route").parquet(path)
    return {name: n for _, name, n in counts.rows()}


def write_qa_csv(df: DataFrame, path: str) -> int:
    """Review table; polygons and lists go as JSON text.  Null and empty text are told apart on reading."""
    flat = [
        F.to_json(f.name).alias(f.name) if f.dataType.typeName() in ("array", "struct", "map") else F.col(f.name)
        for f in df.schema.fields
    ]
    counts = StepCounts()
    counts.step(df.select(flat), path).write.mode("overwrite").option("header", True).option("quote", '"').option(
        "escape", '"').option("emptyValue", '""').csv(path)
    return counts.rows()[0][2]
