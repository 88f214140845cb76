from treatflow.operators import footprints

from tests.shapes import brute_groups, frame, rng, square


def test_links_are_compared_once_and_written(spark, monkeypatch):
    r = rng(8)
    rows = [(i, square(r.choice([0, 1590, 3195, 6400]) + r.randint(0, 30), r.randint(0, 60), 300 + r.randint(0, 40))) for i in range(160)]
    rows = [(i, s) for i, s in rows if i % 5] + [(i + 1000, s) for i, s in rows[:20]]
    handed = []
    original = footprints.components
    monkeypatch.setattr(footprints, "components", lambda edges: handed.append(edges) or original(edges))
    monkeypatch.setattr(footprints, "HUBS", 1000)
    found = {x.oid: x.grp for x in footprints.near_identical(frame(spark, rows), 25.0).collect()}
    assert found == brute_groups(rows, 25.0)
    # links come from a written table, not from a join that every round would run again
    plan = handed[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    assert handed[0].filter("u >= v").isEmpty()
