from pyspark.sql import functions as F

import __spark_entry__ as entry
from treatflow.operators import crosswalk, overlay
from treatflow.session import broadcast_if_small, small_table
from tests.shapes import frame, square

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().toString()


def test_no_python_and_no_cartesian_product(spark):
    for name in ("j2_tiered", "x2_keyword_classes", "x5_fund_codes", "j6_overlay", "j8_near_identical", "l2_keyword_flow"):
        text = plan(entry.queries()[name](spark, SF))
        assert "Python" not in text and "CartesianProduct" not in text and "BroadcastNestedLoop" not in text, name


def test_pushed_filters_and_pruned_columns(spark):
    text = plan(entry.queries()["s2_read_where"](spark, SF))
    assert "EqualTo(o_orderstatus,F)" in text
    assert "o_custkey" not in text.split("ReadSchema")[1]


def test_lookups_are_broadcast_only_when_small(spark):
    table = small_table(spark, [("a", "b", 0)], ["key", "label", "line_no"])
    df = spark.range(10).select(F.col("id").cast("string").alias("key"))
    assert "BroadcastHashJoin" in plan(crosswalk.crosswalk(df, table, ["key"], {"label": "label"}))
    assert "hint" not in plan(broadcast_if_small(df, limit=1)).lower()


def test_overlay_moves_rows_by_cell_only(spark):
    left = frame(spark, [(1, square(0, 0, 2))])
    right = frame(spark, [(1, square(0, 0, 2))], "pid bigint")
    text = plan(overlay.overlay_acres(left, right, ["oid", "pid"], "oid", ["pid"], 5.0))
    assert "cx" in text and "CartesianProduct" not in text
