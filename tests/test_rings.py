import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.shapes import frame, inside, rng, square, star
from treatflow.functions.geometry import area
from treatflow.operators import dissolve
from treatflow.operators.dissolve import dissolve_shapes
from treatflow.operators.rings import polygon, ring_area, straightened


def directed(rings):
    edges = [(*a, *b) for ring in rings for a, b in zip(ring, ring[1:] + ring[:1])]
    random.Random(3).shuffle(edges)
    return [np.array(c, dtype=float) for c in zip(*edges)]


def box(x, y, w, h, hole=False):
    ring = [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]
    return ring[::-1] if hole else ring


def test_rings_of_directed_edges():
    # an island in a hole, and a shell beside them
    parts = polygon(*directed([box(0, 0, 10, 10), box(2, 2, 6, 6, True), box(4, 4, 2, 2), box(20, 0, 1, 1)]))
    assert [len(p) for p in parts] == [2, 1, 1]
    assert [[round(ring_area(r)) for r in p] for p in parts] == [[100, -36], [4], [1]]
    # squares that touch in a corner are two parts; a hole that touches its shell in one is a hole
    assert len(polygon(*directed([box(0, 0, 1, 1), box(1, 1, 1, 1)]))) == 2
    diamond = [(0, 5), (3, 2), (6, 5), (3, 8)][::-1]
    touching = polygon(*directed([box(0, 0, 10, 10), diamond]))
    assert [[round(ring_area(r)) for r in p] for p in touching] == [[100, -18]]
    # three holes around one vertex, where the walk must not cross itself
    fan = [[(5, 5), (9, 4), (9, 6)][::-1], [(5, 5), (6, 9), (4, 9)][::-1], [(5, 5), (4, 1), (6, 1)][::-1]]
    assert [round(sum(ring_area(r) for r in p)) for p in polygon(*directed([box(0, 0, 10, 10), *fan]))] == [88]


def test_noise_and_straight_vertices_go():
    ring = [(0, 0), (5, 0), (10, 0), (10, 10), (10, 10 + 1e-9), (0, 10)]
    x1, y1, x2, y2 = directed([ring])
    assert polygon(x1, y1 + np.random.default_rng(1).uniform(-1e-8, 1e-8, len(y1)), x2, y2)[0][0][0] == pytest.approx((0, 0), abs=1e-6)
    assert len(polygon(x1, y1, x2, y2)[0][0]) == 4
    assert straightened([(0, 0), (2, 0), (4, 0), (4, 4)]) == [(0, 0), (4, 0), (4, 4)]
    assert polygon(*directed([box(0, 0, 10, 1e-7)])) == []
    assert polygon(*[np.zeros(0)] * 4) == []


def valid(geom):
    """No two edges of a polygon cross or overlap, shells run counter-clockwise, holes clockwise and inside."""
    edges = []
    for part in geom:
        for i, ring in enumerate(part):
            points = [(p["x"], p["y"]) for p in ring]
            assert (ring_area(points) > 0) == (i == 0)
            if i:
                (ax, ay), (bx, by) = points[:2]
                assert inside([[part[0]]], (ax + bx) / 2, (ay + by) / 2)
            edges += list(zip(points, points[1:] + points[:1]))
    side = lambda p, q, r: (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
    for i, (a, b) in enumerate(edges):
        for c, d in edges[:i]:
            far = 1e-4
            assert not (side(a, b, c) * side(a, b, d) < -far and side(c, d, a) * side(c, d, b) < -far)
    return True


def test_unions_are_valid_polygons(spark, monkeypatch):
    r = rng(11)
    groups = {g: [star(r, r.uniform(0, 90), r.uniform(0, 90), 50) for _ in range(r.choice([2, 5, 14]))] for g in range(8)}
    groups[20] = [square(0, 0, 10), square(5, 3, 10)]
    groups[21] = [square(0, 0, 40, 10), square(0, 0, 10, 40), square(30, 0, 10, 40), square(0, 30, 40, 10), square(15, 15, 5)]
    groups[22] = [square(0, 2 * i, 100, 1) for i in range(40)] + [square(0, 0, 1, 79)]          # a comb lying along x
    groups[23] = [square(2 * i, 0, 1, 100) for i in range(40)] + [square(0, 0, 79, 1)]
    df = frame(spark, [(g, s) for g, shapes in groups.items() for s in shapes], "g bigint")
    for chunk, bins in ((256, 64), (30, 8)):
        monkeypatch.setattr(dissolve, "CHUNK_EDGES", chunk)
        monkeypatch.setattr(dissolve, "BIN_EDGES", bins)
        got = {x["g"]: x for x in dissolve_shapes(df, "g").withColumn("a", area("geom")).collect()}
        for g, shapes in groups.items():
            geom = got[g]["geom"]
            assert valid(geom)
            for _ in range(60):
                x, y = r.uniform(-20, 110), r.uniform(-20, 110)
                assert inside(geom, x, y) == any(inside(s, x, y) for s in shapes)
        assert [len(got[g]["geom"]) for g in (20, 21, 22, 23)] == [1, 2, 1, 1]
        assert math.isclose(got[20]["perimeter"], 56) and math.isclose(got[20]["area"], 165)
        assert sum(len(p) for p in got[21]["geom"]) == 3 and got[21]["area"] == pytest.approx(1225)
        assert got[22]["area"] == pytest.approx(got[23]["area"]) == pytest.approx(40 * 99 + 79)
        assert len(got[22]["geom"][0][0]) == len(got[23]["geom"][0][0]) == 160


def test_finished_groups_leave_the_rounds(spark, monkeypatch):
    """Only the groups with several chunks are swept in a round."""
    monkeypatch.setattr(dissolve, "CHUNK_EDGES", 16)
    swept = []
    original = dissolve._sweep
    monkeypatch.setattr(dissolve, "_sweep", lambda pieces: swept.append(pieces.select("grp").distinct().count()) or original(pieces))
    small = [(g, square(3 * i, i, 5)) for g in range(6) for i in range(3)]
    large = [(99, square(3 * i, i % 7, 5)) for i in range(150)]
    assert dissolve_shapes(frame(spark, small + large, "g bigint"), "g").count() == 7
    assert len(swept) >= 3 and set(swept[:-1]) == {1} and swept[-1] == 7


def test_chunks_of_groups_without_edges(spark):
    df = frame(spark, [(1, None), (2, [])], "g bigint").filter(F.col("geom").isNotNull())
    assert [len(r["geom"]) for r in dissolve_shapes(df, "g").collect()] == [0]
