import math

from pyspark.sql import functions as F

from treatflow.functions.geometry import area
from treatflow.operators import footprints
from treatflow.operators.components import components
from treatflow.operators.dissolve import dissolve_shapes
from tests.shapes import brute_groups, frame, inside, rng, square, star


def jitter(r, geom, size, turn=0):
    out = []
    for part in geom:
        rings = []
        for points in part:
            k = turn % len(points)
            moved = points[k:] + points[:k]
            rings.append([{"x": p["x"] + r.uniform(-size, size), "y": p["y"] + r.uniform(-size, size)} for p in moved])
        out.append(rings)
    return out


def near_rows(seed, n_bases, n_copies, spread, size):
    r = rng(seed)
    rows, oid = [], 1
    for _ in range(n_bases):
        base = star(r, r.uniform(0, spread), r.uniform(0, spread), 400, n=r.choice([4, 5]))
        for _ in range(r.randint(1, n_copies)):
            rows.append((oid, jitter(r, base, size, r.randint(0, 4))))
            oid += 1
    rows.append((oid, rows[0][1]))
    return rows


def found(spark, rows, tol):
    return {r["oid"]: r["grp"] for r in footprints.near_identical(frame(spark, rows), tol).collect()}


def test_near_identical_pairs(spark):
    rows = near_rows(1, 15, 4, 2000, 45)
    assert found(spark, rows, 100.0) == brute_groups(rows, 100.0)


def test_near_identical_crowded_block(spark, monkeypatch):
    monkeypatch.setattr(footprints, "HUBS", 2)
    for seed, size in ((2, 30), (4, 90)):
        rows = near_rows(seed, 6, 9, 150, size)
        assert found(spark, rows, 100.0) == brute_groups(rows, 100.0)


def test_shapes_of_different_boxes_do_not_meet(spark, monkeypatch):
    """Concentric rectangles have one mean vertex, but no two of them are candidates."""
    monkeypatch.setattr(footprints, "_boxes_within", lambda tol: F.lit(True))
    monkeypatch.setattr(footprints, "within_tolerance", lambda a, b, tol: F.lit(True))
    rows = [(i, square(-700.0 * i, -700.0 * i, 1400.0 * i)) for i in range(1, 801)]
    assert found(spark, rows, 100.0) == {}


def test_crowd_of_variants_meets_hubs_only(spark, monkeypatch):
    """1,500 jittered copies of one shape: some tens of comparisons each, not all pairs, and one group."""
    counted = []
    original = footprints._links
    monkeypatch.setattr(footprints, "_links", lambda *a: counted.append(original(*a)) or counted[-1])
    r = rng(5)
    base = star(r, 0, 0, 400, n=12)
    rows = [(i, jitter(r, base, 30)) for i in range(1500)]
    assert found(spark, rows, 100.0) == {i: 0 for i in range(1500)}
    assert sum(links.count() for links in counted) < 1500 * 100


def test_chain_is_one_group_and_copies_count_once(spark):
    rows = [(i, square(80.0 * i, 0, 500)) for i in range(1, 12)] + [(100 + i, square(5e4, 0, 300)) for i in range(50)]
    rows += [(200, square(9e4, 0, 300))]
    got = found(spark, rows, 100.0)
    assert {got[i] for i in range(1, 12)} == {1}
    assert {got[100 + i] for i in range(50)} == {100}
    assert 200 not in got


def test_components_long_chain(spark):
    edges = spark.range(1, 60).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    got = {r["u"]: r["grp"] for r in components(edges).collect()}
    assert got == {i: 1 for i in range(1, 61)}
    assert components(edges.limit(0)).count() == 0


def union_area(shapes, step):
    xs = [p["x"] for g in shapes for part in g for r in part for p in r]
    ys = [p["y"] for g in shapes for part in g for r in part for p in r]
    hits, x = 0, min(xs)
    while x < max(xs):
        y = min(ys)
        while y < max(ys):
            hits += any(inside(g, x + step / 2, y + step / 2) for g in shapes)
            y += step
        x += step
    return hits * step * step


def test_union_of_stars_and_rectangles(spark):
    r = rng(7)
    groups = {g: [star(r, r.uniform(0, 60), r.uniform(0, 60), 60) for _ in range(3)] for g in range(1, 5)}
    groups[10] = [square(0, 0, 10), square(0, 0, 10), square(5, 0, 10)]
    groups[11] = [square(0, 0, 10), square(10, 0, 10)]                       # share an edge
    groups[12] = [square(0, 0, 10), square(0, 10, 10)]                       # share a flat edge
    groups[13] = [square(0, 0, 10), square(50, 50, 10)]                      # two parts
    groups[14] = [[square(0, 0, 30)[0] + [list(reversed(square(10, 10, 10)[0][0]))]], square(12, 12, 4)]  # in a hole
    groups[15] = [square(0, 0, 10)]
    rows = [(g, s) for g, shapes in groups.items() for s in shapes]
    df = frame(spark, rows, "g bigint")
    got = {x["g"]: x for x in dissolve_shapes(df, "g").withColumn("a2", area("geom")).collect()}
    for g, shapes in groups.items():
        if g < 10:
            assert math.isclose(got[g]["area"], union_area(shapes, 0.5), rel_tol=0.01)
    expected = {10: (150, 50), 11: (200, 60), 12: (200, 60), 13: (200, 80), 14: (816, 176), 15: (100, 40)}
    for g, (a, p) in expected.items():
        assert math.isclose(got[g]["area"], a, abs_tol=1e-6)
        assert math.isclose(got[g]["perimeter"], p, abs_tol=1e-6)
    for x in got.values():
        assert math.isclose(x["area"], x["a2"], abs_tol=1e-6)


def test_union_is_the_same_in_chunks(spark, monkeypatch):
    from treatflow.operators import dissolve

    r = rng(9)
    shapes = [star(r, r.uniform(0, 80), r.uniform(0, 80), 50) for _ in range(40)]
    df = frame(spark, [(1, s) for s in shapes], "g bigint")
    whole = dissolve_shapes(df, "g").head()
    monkeypatch.setattr(dissolve, "CHUNK_EDGES", 30)
    monkeypatch.setattr(dissolve, "BIN_EDGES", 10)
    parts = dissolve_shapes(df, "g").head()
    assert math.isclose(whole["area"], parts["area"], rel_tol=1e-9)
    assert math.isclose(whole["perimeter"], parts["perimeter"], rel_tol=1e-6)
    assert math.isclose(whole["area"], union_area(shapes, 0.5), rel_tol=0.01)


def test_dense_number_over_partitions(spark):
    df = spark.range(1000).select(F.concat(F.lit("k"), F.col("id") % 137).alias("k"))
    got = footprints.dense_number(df, "k", "no").distinct().collect()
    order = sorted({x["k"] for x in got})
    assert {x["k"]: x["no"] for x in got} == {k: i + 1 for i, k in enumerate(order)}
