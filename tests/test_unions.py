import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.shapes import frame, rng, square, star
from treatflow.functions.geometry import area, perimeter
from treatflow.operators import dissolve
from treatflow.operators.unions import outline, unions, united


def holed(x, y, w):
    hole = [{"x": x + w * a, "y": y + w * b} for a, b in ((0.25, 0.25), (0.25, 0.75), (0.75, 0.75), (0.75, 0.25))]
    return [[square(x, y, w)[0][0], hole]]


def random_shape(r, kind):
    if kind == 0:
        return star(r, r.uniform(0, 20), r.uniform(0, 20), 8)
    if kind == 1:
        return square(r.randint(0, 6), r.randint(0, 6), r.randint(1, 4), r.randint(1, 4))
    if kind == 2:
        return holed(r.randint(0, 8), r.randint(0, 8), r.choice([4, 8]))
    return star(r, 0, 0, 8, n=3) + square(r.randint(10, 14), r.randint(0, 4), 2)


def test_small_groups_are_united_as_in_the_chunked_sweep(spark):
    r = rng(4)
    rows = [(g, random_shape(r, g % 4)) for g in range(120) for _ in range(r.randint(1, 5))]
    rows += [(200, square(0, 0, 1))] * 3 + [(None, square(0, 0, 1))]
    df = frame(spark, rows, "grp bigint").filter("grp is not null").cache()
    measured = lambda d: {x[0]: x[1:] for x in d.select(
        "grp", F.size("geom"), F.size(F.flatten("geom")), F.size(F.flatten(F.flatten("geom"))), F.round(area("geom"), 3),
        F.round(perimeter("geom"), 3), F.expr("flatten(flatten(transform(geom, p -> transform(p, q -> transform(q, v -> round(v.x + 7 * v.y, 2))))))"),
    ).collect()}
    found, expected = measured(united(df)), measured(dissolve._chunked(df))
    assert found.keys() == expected.keys() and len(found) == 121
    for g in found:
        assert found[g][:3] == expected[g][:3]
        assert np.allclose([*found[g][3:5], *found[g][5]], [*expected[g][3:5], *expected[g][5]], atol=0.02)


def test_small_groups_need_no_sweep_of_their_own(spark, monkeypatch):
    def refuse(pieces):
        raise AssertionError("row by row sweep")

    monkeypatch.setattr(dissolve, "_sweep", refuse)
    df = frame(spark, [(g, square(g % 10 + i, 0, 5)) for g in range(200) for i in range(3)] + [(None, square(0, 0, 1))], "g bigint")
    assert [tuple(x) for x in dissolve.dissolve_shapes(df, "g").select("area", "perimeter").distinct().collect()] == [(35.0, 24.0)]


def test_rings_that_need_placing_are_left_to_the_walk():
    box = lambda x, y, w, h: ([x, x], [y, y + h], [x + w, x + w], [y, y + h], [-1, 1])
    joined = lambda *boxes: [np.concatenate(c).astype(float) for c in zip(*boxes)]
    frame_of_four = joined(box(0, 0, 8, 1), box(0, 0, 1, 8), box(7, 0, 1, 8), box(0, 7, 8, 1))
    island = joined(box(0, 0, 8, 1), box(0, 0, 1, 8), box(7, 0, 1, 8), box(0, 7, 8, 1), box(3, 3, 1, 1))
    corners = joined(box(0, 0, 1, 1), box(1, 1, 1, 1))
    g = np.repeat([0, 1, 2], [len(frame_of_four[0]), len(island[0]), len(corners[0])])
    edges = [np.concatenate(c) for c in zip(frame_of_four, island, corners)]
    odd, x, y, per_ring, per_part, per_group = unions(outline(g, *edges[:4], edges[4].astype(int)), 3)
    assert odd.tolist() == [False, True, False] and per_group.tolist() == [1, 0, 2]
    assert per_part.tolist() == [2, 1, 1] and per_ring.tolist() == [4, 4, 4, 4]


@pytest.mark.parametrize("groups", [[], [(1, [[[]]]), (1, [[]])]])
def test_nothing_to_unite(spark, groups):
    assert dissolve.dissolve_shapes(frame(spark, groups, "g bigint"), "g").count() == 0
