import pytest
from pyspark.sql import functions as F

from tests.shapes import brute_groups, frame, rng, square
from treatflow.operators import footprints


def town(seed, n=120):
    """Squares in a few places, some moved, some of two parts, and copies that start at another vertex."""
    r = rng(seed)
    rows = []
    for i in range(n):
        x, y, w = r.choice([0, 480, 3195, 9000]) + r.randint(0, 40), r.choice([0, 505]) + r.randint(0, 60), 300 + r.randint(0, 60)
        shape = square(x, y, w)
        if i % 4 == 0:
            shape = shape + square(x + 1000, y, w)
        elif i % 4 == 1:
            # as many vertices in the same places, but one part with a hole
            shape = [shape[0] + square(x + 1000, y, w)[0]]
        rows.append((i, shape))
    for i in range(0, n, 5):
        rows.append((1000 + i, [[ring[2:] + ring[:2] for ring in part] for part in rows[i][1]]))
    return rows + [(5000, square(50_000, 0, 10)), (5001, square(50_000, 0, 10)), (5002, square(60_000, 0, 10))]


@pytest.mark.parametrize("hubs, limit", [(2, 1 << 26), (8, 0), (1000, 1 << 26)])
def test_groups_are_those_of_all_pairs(spark, monkeypatch, hubs, limit):
    monkeypatch.setattr(footprints, "HUBS", hubs)
    monkeypatch.setattr(footprints, "BROADCAST_LIMIT_BYTES", limit)
    rows = town(hubs)
    got = footprints.near_identical(frame(spark, rows), 25.0).collect()
    assert {x.oid: x.grp for x in got} == brute_groups(rows, 25.0) and len(got) == len({x.oid for x in got})


def test_polygons_stay_out_of_the_blocks_around_them(spark, monkeypatch):
    """Boxes go to all blocks near them, polygons to found pairs only; the groups come from a written table."""
    plans, original = [], footprints.cut_lineage
    monkeypatch.setattr(footprints, "cut_lineage", lambda df: plans.append(str(df._jdf.queryExecution().executedPlan())) or original(df))
    monkeypatch.setattr(footprints, "HUBS", 1000)
    groups = footprints.near_identical(frame(spark, town(3)), 25.0)
    spread = [line for plan in plans for line in plan.splitlines() if "Generate explode(sequence" in line]
    assert spread and not any("geom" in line for line in spread)
    assert "Join" not in groups._jdf.queryExecution().optimizedPlan().toString()


def test_rows_without_a_group_do_not_meet_in_one_task(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(0, 4000, 1, 16).select("id", F.when(F.col("id") % 100 == 0, F.concat(F.lit("k"), F.col("id") % 300)).alias("k"))
        out = footprints.dense_number(df, "k", "no").withColumn("task", F.spark_partition_id())
        rows = out.collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(x.id for x in rows) == list(range(4000))
    order = sorted({x.k for x in rows if x.k})
    assert all(x.no == (order.index(x.k) + 1 if x.k else None) for x in rows)
    lone = [x.task for x in rows if x.k is None]
    assert max(map(lone.count, set(lone))) < 0.8 * len(lone)


def test_crowded_rows_without_an_id_end(spark, monkeypatch):
    monkeypatch.setattr(footprints, "HUBS", 2)
    rows = [(None, square(i, 0, 300)) for i in range(6)] + [(7, square(6, 0, 300)), (8, square(7, 0, 300))]
    assert {tuple(x) for x in footprints.near_identical(frame(spark, rows), 25.0).collect()} == {(7, 7), (8, 7)}
