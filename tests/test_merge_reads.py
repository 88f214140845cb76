"""A merge reads and repairs its layers once."""

from pyspark.sql import functions as F

from tests.shapes import frame, square
from treatflow.plans import flows
from treatflow.session import small_table


def test_layers_are_repaired_once(spark, monkeypatch):
    seen, real = [], flows.fund_source_type
    monkeypatch.setattr(flows, "fund_source_type", lambda df, funds: seen.append(df) or real(df, funds))
    layer = frame(spark, [(1, square(0, 0, 10))]).withColumns(
        {"MGT_TYPE": F.lit("canopy"), "FUNDING": F.lit("A"), "YEAR_COMP": F.lit(2024)})
    parcels = frame(spark, [(1, square(-5, -5, 50))], "pid bigint").withColumn("owner", F.lit("West"))
    funds = small_table(spark, [("A", "a", "x", 0)], ["fund_code", "fund_source", "fund_type", "line_no"])
    out = flows.merge_qa([layer], parcels, "owner", funds)
    # later passes start from the written rows
    assert "Generate" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert [(r["LANDOWNER"], r["FUND_SOURCE"]) for r in out.collect()] == [("West", "a")]
