"""Reading layers, lookups and polygon texts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from treatflow.functions.geometry import repair


def read_where(spark: SparkSession, path: str, predicate: Column, columns: Sequence[str]) -> DataFrame:
    """Read some columns of the rows that satisfy a predicate; both reach the Parquet scan."""
    return spark.read.parquet(path).filter(predicate).select(*columns)


def merge_layers(layers: Sequence[DataFrame], contract: Mapping[str, str] | None = None) -> DataFrame:
    """One table of all layers: columns by name, missing ones null, duplicates kept.

    The fields of a ``contract`` (name to type) are there with their types whatever the layers hold, so that no layer at all
    gives an empty table of them; values are cast where a layer differs.
    """
    if contract is None and not layers:
        raise ValueError("no layers and no contract: nothing tells the columns")
    if contract is None:
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), layers)
    typed = [layer.withColumns({n: (F.col(n) if n in layer.columns else F.lit(None)).cast(t) for n, t in contract.items()})
             for layer in layers]
    if not typed:
        schema = T.StructType([T.StructField(n, T._parse_datatype_string(t)) for n, t in contract.items()])
        return SparkSession.active().createDataFrame([], schema)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), typed)


def load_layers(spark: SparkSession, registry: Mapping[str, str]) -> dict[str, DataFrame]:
    """Each named layer that can be read, tagged with its name; missing ones are left out.

    An empty layer adds no rows to a merge and needs no check.
    """
    layers = {}
    for name, path in registry.items():
        try:
            layers[name] = spark.read.parquet(path).withColumn("layer", F.lit(name))
        except AnalysisException as problem:
            if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
    return layers


def union_workspace(spark: SparkSession, registry: Mapping[str, str], contract: Mapping[str, str] | None = None) -> DataFrame:
    return merge_layers(list(load_layers(spark, registry).values()), contract)


def read_lookup(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """CSV lookup, all columns text, blanks kept as ''; ``line_no`` is the order of its rows."""
    raw = spark.read.csv(path, header=True, encoding=encoding, quote='"', escape='"', multiLine=True)
    return raw.fillna("").withColumn("line_no", F.monotonically_increasing_id())


def read_rules(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """Ordered (regex, activity) rules of a hand-written file; they become expressions of the plan."""
    rows = read_lookup(spark, path).orderBy("line_no").select("regex", "activity").collect()
    return [(r["regex"], r["activity"]) for r in rows]


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """Polygon features, one JSON feature per line, to ``properties`` (map) and ``geom``."""
    feature = "struct<properties:map<string,string>,geometry:struct<type:string,coordinates:string>>"
    rows = spark.read.text(path).select(F.from_json("value", feature).alias("f")).filter(F.col("f").isNotNull())
    kind = F.col("f.geometry.type")
    coordinates = F.col("f.geometry.coordinates")
    one = F.array(F.from_json(coordinates, "array<array<array<double>>>"))
    many = F.from_json(coordinates, "array<array<array<array<double>>>>")
    parts = rows.withColumn("parts", F.when(kind == "Polygon", one).when(kind == "MultiPolygon", many))
    vertex = "named_struct('x', get(v, 0), 'y', get(v, 1))"
    geom = repair(f"transform(parts, part -> transform(part, r -> transform(r, v -> {vertex})))")
    return parts.select(F.col("f.properties").alias("properties"), geom.alias("geom"))
