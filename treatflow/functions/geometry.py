"""Polygon measures as column expressions.

A polygon column is parts -> rings -> vertices ``(x, y)``; ring 0 of a part is its shell,
the others are its holes; the closing vertex is not stored.

The functions take the column's name (or other SQL text for it) and return a Column; the nested
lambdas are written as SQL text, which Spark parses at once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from treatflow.fixed_values import SQ_M_PER_ACRE, TARGET_SRID


def rectangle(x0: str, y0: str, w: str, h: str) -> Column:
    """One-part rectangle, counter-clockwise."""
    corner = lambda x, y: f"named_struct('x', double({x}), 'y', double({y}))"
    ring = ", ".join(
        [corner(x0, y0), corner(f"{x0} + {w}", y0), corner(f"{x0} + {w}", f"{y0} + {h}"), corner(x0, f"{y0} + {h}")]
    )
    return F.expr(f"array(array(array({ring})))")


def _successors(ring: str) -> str:
    """The ring's vertices, each replaced by the next one."""
    return f"concat(slice({ring}, 2, greatest(size({ring}) - 1, 0)), slice({ring}, 1, 1))"


def _sum(values: str) -> str:
    return f"aggregate({values}, 0D, (total, v) -> total + v)"


def _ring_area(ring: str) -> str:
    """Signed area, positive for counter-clockwise; taken relative to the first vertex."""
    o = f"get({ring}, 0)"
    cross = f"(a.x - {o}.x) * (b.y - {o}.y) - (b.x - {o}.x) * (a.y - {o}.y)"
    return _sum(f"zip_with({ring}, {_successors(ring)}, (a, b) -> {cross})") + " / 2"


def area(geom: str) -> Column:
    """Shell areas less hole areas, in square units of the projection."""
    rings = f"transform(part, (r, i) -> if(i = 0, abs({_ring_area('r')}), -abs({_ring_area('r')})))"
    return F.expr(_sum(f"transform({geom}, part -> {_sum(rings)})"))


def acres(geom: str) -> Column:
    return area(geom) / SQ_M_PER_ACRE


def perimeter(geom: str) -> Column:
    lengths = f"zip_with(r, {_successors('r')}, (a, b) -> hypot(b.x - a.x, b.y - a.y))"
    return F.expr(_sum(f"transform(flatten({geom}), r -> {_sum(lengths)})"))


def compactness(area_col: Column, perimeter_col: Column) -> Column:
    return F.when(perimeter_col > 0, area_col / (perimeter_col * perimeter_col))


def bounds(geom: str) -> Column:
    """Struct of xmin, ymin, xmax, ymax."""
    axis = lambda a: f"transform(flatten(flatten({geom})), v -> v.{a})"
    return F.expr(
        f"named_struct('xmin', array_min({axis('x')}), 'ymin', array_min({axis('y')}), "
        f"'xmax', array_max({axis('x')}), 'ymax', array_max({axis('y')}))"
    )


def cell_range(low: Column, high: Column, size: float) -> Column:
    """Grid cells an interval touches, lowest first."""
    return F.sequence(F.floor(low / size), F.floor(high / size))


def edges(geom: str) -> Column:
    """Non-vertical edges, left to right, with ``s`` = +1 on top edges and -1 on bottom edges.

    Rings must have repaired directions (shell counter-clockwise, holes clockwise).
    """
    edge = lambda a, b, s: f"named_struct('x1', {a}.x, 'y1', {a}.y, 'x2', {b}.x, 'y2', {b}.y, 's', {s})"
    of_ring = f"zip_with(r, {_successors('r')}, (a, b) -> if(a.x < b.x, {edge('a', 'b', -1)}, {edge('b', 'a', 1)}))"
    return F.expr(f"filter(flatten(transform(flatten({geom}), r -> {of_ring})), e -> e.x1 < e.x2)")


def _repaired_list(geom: str) -> str:
    """List of the repaired polygon, empty when nothing is left of it."""
    no_repeats = "filter(r, (v, i) -> i = 0 or v != get(r, i - 1))"
    open_ring = "if(size(c) > 1 and get(c, 0) = get(c, size(c) - 1), slice(c, 1, size(c) - 1), c)"
    # every cleaned ring beside its area, which is looked at several times
    measured = (
        f"transform({geom}, part -> transform(transform(transform(part, r -> {no_repeats}), c -> {open_ring}), "
        f"o -> named_struct('ring', o, 'area', if(size(o) >= 3, {_ring_area('o')}, 0D))))"
    )
    with_shell = f"filter({measured}, part -> coalesce(get(part, 0).area, 0D) != 0)"
    directed = "if((i = 0) = (m.area > 0), m.ring, reverse(m.ring))"
    parts = f"transform({with_shell}, part -> transform(filter(part, m -> m.area != 0), (m, i) -> {directed}))"
    return f"filter(array({parts}), g -> size(g) > 0)"


def repair(geom: str) -> Column:
    """Clean rings, right directions, no empty rings or parts; nothing left gives null.

    Repeated neighbouring vertices and closing vertices go, then rings under three vertices or
    without area; a part goes with its shell.
    """
    return F.expr(f"get({_repaired_list(geom)}, 0)")


def repaired_rows(geom: str) -> Column:
    """The repaired polygon as a generator: no row when nothing is left of it."""
    return F.explode(F.expr(_repaired_list(geom)))


def crosses_itself(geom: str) -> Column:
    """Whether two edges of one ring cross at inner points.  Flagged only, never rebuilt."""
    side = lambda e, p: f"signum(({e}.b.x - {e}.a.x) * ({p}.y - {e}.a.y) - ({e}.b.y - {e}.a.y) * ({p}.x - {e}.a.x))"
    pairs = f"zip_with(r, {_successors('r')}, (a, b) -> named_struct('a', a, 'b', b))"
    cross = (
        f"{side('p', 'q.a')} * {side('p', 'q.b')} < 0 and {side('q', 'p.a')} * {side('q', 'p.b')} < 0"
    )
    return F.expr(f"exists(flatten({geom}), r -> exists({pairs}, p -> exists({pairs}, q -> {cross})))")


# --- fixed values: GRS 80 ellipsoid and UTM zone 13 north ----------------------
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257222101
CENTRAL_MERIDIAN = -105.0
SCALE_FACTOR = 0.9996
FALSE_EASTING = 500000.0
GEOGRAPHIC_SRIDS = (4269, 4326)


def _utm13(lon: str, lat: str) -> str:
    """Transverse Mercator forward series (Snyder 1987, eqs. 8-9 to 8-15)."""
    e2 = FLATTENING * (2 - FLATTENING)
    ep2 = e2 / (1 - e2)
    phi = f"radians({lat})"
    n = f"({SEMI_MAJOR}D / sqrt(1 - {e2!r}D * pow(sin({phi}), 2)))"
    t = f"pow(tan({phi}), 2)"
    c = f"({ep2!r}D * pow(cos({phi}), 2))"
    a = f"(radians({lon} - {CENTRAL_MERIDIAN}D) * cos({phi}))"
    m = (
        f"{SEMI_MAJOR}D * ({1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256!r}D * {phi}"
        f" - {3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024!r}D * sin(2 * {phi})"
        f" + {15 * e2**2 / 256 + 45 * e2**3 / 1024!r}D * sin(4 * {phi})"
        f" - {35 * e2**3 / 3072!r}D * sin(6 * {phi}))"
    )
    x = (
        f"{FALSE_EASTING}D + {SCALE_FACTOR}D * {n} * (({a}) + pow({a}, 3) * (1 - {t} + {c}) / 6"
        f" + pow({a}, 5) * (5 - 18 * {t} + {t} * {t} + 72 * {c} - 58 * {ep2!r}D) / 120)"
    )
    y = (
        f"{SCALE_FACTOR}D * ({m} + {n} * tan({phi}) * (pow({a}, 2) / 2"
        f" + pow({a}, 4) * (5 - {t} + 9 * {c} + 4 * {c} * {c}) / 24"
        f" + pow({a}, 6) * (61 - 58 * {t} + {t} * {t} + 600 * {c} - 330 * {ep2!r}D) / 720))"
    )
    return f"named_struct('x', {x}, 'y', {y})"


def reproject(geom: str, srid: str) -> Column:
    """Polygon in UTM zone 13 north; unchanged when it is there already."""
    vertex = _utm13("v.x", "v.y")
    projected = f"transform({geom}, part -> transform(part, r -> transform(r, v -> {vertex})))"
    known = ", ".join(str(s) for s in GEOGRAPHIC_SRIDS)
    return F.expr(
        f"case when {srid} = {TARGET_SRID} then {geom} when {srid} in ({known}) then {projected} "
        f"else raise_error(concat('no projection from srid ', coalesce(string({srid}), 'null'))) end"
    )
