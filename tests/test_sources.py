import json

from pyspark.sql import functions as F

from treatflow.functions.geometry import area
from treatflow.functions.lists import clean_list
from treatflow.functions.text import clean_text
from treatflow.operators import crosswalk
from treatflow.sources import readers, writers
from treatflow.session import small_table
from tests.shapes import frame, square


def test_lookup_files(spark, tmp_path):
    bom = tmp_path / "bom.csv"
    bom.write_bytes('﻿regex,activity,notes\n"a,b",X,"say ""hi"""\nNULL,,\n'.encode("utf-8"))
    rows = readers.read_lookup(spark, str(bom)).orderBy("line_no").collect()
    assert [(r["regex"], r["activity"], r["notes"]) for r in rows] == [("a,b", "X", 'say "hi"'), ("NULL", "", "")]
    assert readers.read_rules(spark, str(bom)) == [("a,b", "X"), ("NULL", "")]
    latin = tmp_path / "latin.csv"
    latin.write_bytes("fund_code,fund_source\nA,Peña\n".encode("latin-1"))
    assert readers.read_lookup(spark, str(latin), "ISO-8859-1").head()["fund_source"] == "Peña"


def test_write_and_read_layers(spark, tmp_path):
    df = frame(spark, [(1, square(0, 0, 2)), (2, square(9, 9, 1))]).withColumn("layer", F.lit("a"))
    writers.write_layer(df, str(tmp_path / "staged"))
    writers.write_layer(df, str(tmp_path / "staged"))
    assert readers.union_workspace(spark, {"x": str(tmp_path / "staged"), "none": str(tmp_path / "none")}).count() == 2
    writers.archive_layers(df, str(tmp_path / "archive"))
    assert (tmp_path / "archive" / "layer=a").is_dir()
    writers.write_routes(df.withColumn("route", F.lit("review")), str(tmp_path / "routes"))
    assert (tmp_path / "routes" / "route=review").is_dir()
    writers.write_qa_csv(df, str(tmp_path / "qa"))
    assert spark.read.csv(str(tmp_path / "qa"), header=True).count() == 2


def test_geojson(spark, tmp_path):
    box = [[[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]]
    features = [
        {"type": "Feature", "properties": {"id": "1"}, "geometry": {"type": "Polygon", "coordinates": box}},
        {"type": "Feature", "properties": {"id": "2"}, "geometry": {"type": "MultiPolygon", "coordinates": [box, [[[5, 5], [6, 5], [6, 6]]]]}},
        {"type": "Feature", "properties": {"id": "3"}, "geometry": None},
    ]
    path = tmp_path / "f.geojsonl"
    path.write_text("\n".join(json.dumps(f) for f in features))
    rows = readers.read_geojson(spark, str(path)).select(F.col("properties")["id"].alias("id"), area("geom").alias("a")).collect()
    assert {r["id"]: r["a"] for r in rows} == {"1": 4.0, "2": 4.5, "3": None}


def test_operators_run_on_a_stream(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([("k1", "A; b; ab"), ("zz", "__X")], "key string, t string").write.parquet(source)
    table = small_table(spark, [("k1", "hit", 0)], ["key", "label", "line_no"])
    stream = spark.readStream.schema("key string, t string").parquet(source)
    out = crosswalk.crosswalk(stream, table, ["key"], {"label": "label"}).select(
        "key", "label", F.array_join(clean_list(F.col("t")), "|").alias("items"), clean_text(F.col("t")).alias("clean"))
    q = (out.writeStream.format("parquet").option("path", str(tmp_path / "out"))
         .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("key", "label", "items", "clean").collect())
    assert got == [("k1", "hit", "ab", "a b ab"), ("zz", None, "__X", "x")]
