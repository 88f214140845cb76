"""Polygons for the tests, and plain-Python answers to compare with."""

import math
import random

from pyspark.sql import types as T

from treatflow.fixed_values import GEOM


def ring(points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


def square(x, y, w, h=None):
    h = w if h is None else h
    return [[ring([(x, y), (x + w, y), (x + w, y + h), (x, y + h)])]]


def star(rng, cx, cy, radius, n=7):
    """Simple polygon: one vertex per direction from the centre."""
    spokes = [(2 * math.pi * (i + rng.uniform(0, 0.8)) / n, radius * rng.uniform(0.4, 1)) for i in range(n)]
    return [[ring([(cx + d * math.cos(a), cy + d * math.sin(a)) for a, d in spokes])]]


def frame(spark, rows, extra="oid bigint"):
    schema = T._parse_datatype_string(extra)
    return spark.createDataFrame(rows, T.StructType(schema.fields + [T.StructField("geom", GEOM)]))


def inside(geom, x, y):
    odd = False
    for part in geom:
        for r in part:
            n = len(r)
            for i in range(n):
                a, b = r[i], r[(i + 1) % n]
                if (a["y"] > y) != (b["y"] > y):
                    if x < a["x"] + (y - a["y"]) * (b["x"] - a["x"]) / (b["y"] - a["y"]):
                        odd = not odd
    return odd


def fits(a, b, tol):
    ra = [r for p in a for r in p]
    rb = [r for p in b for r in p]
    if [[len(r) for r in p] for p in a] != [[len(r) for r in p] for p in b]:
        return False
    for p, q in zip(ra, rb):
        n = len(p)
        if not any(all(math.hypot(p[i]["x"] - q[(i + k) % n]["x"], p[i]["y"] - q[(i + k) % n]["y"]) <= tol
                       for i in range(n)) for k in range(n)):
            return False
    return True


def brute_groups(rows, tol):
    label = {oid: oid for oid, _ in rows}

    def find(v):
        while label[v] != v:
            v = label[v]
        return v

    for i, (a, ga) in enumerate(rows):
        for b, gb in rows[:i]:
            if fits(ga, gb, tol):
                ra, rb = find(a), find(b)
                label[max(ra, rb)] = min(ra, rb)
    roots = {oid: find(oid) for oid, _ in rows}
    sizes = {}
    for r in roots.values():
        sizes[r] = sizes.get(r, 0) + 1
    return {oid: r for oid, r in roots.items() if sizes[r] > 1}


def rng(seed):
    return random.Random(seed)
