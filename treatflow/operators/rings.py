"""Polygons from boundary edges: a half-edge walk that closes rings and puts holes into their shells."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from treatflow.fixed_values import GEOM

SNAP_M = 1e-5          # ends of edges that are nearer than this are one vertex
STRAIGHT_M = 1e-6      # a vertex this near to the line between its neighbours is left out

Ring = list[tuple[float, float]]


def vertex_numbers(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, list[tuple[float, float]]]:
    """Number of the vertex of each point, and the vertices: points are put together by x, then by y."""
    order = np.argsort(x, kind="stable")
    column = np.empty(len(x), dtype=np.int64)
    column[order] = np.cumsum(np.diff(x[order], prepend=x[order[:1]]) > SNAP_M)
    order = np.lexsort((y, column))
    new = (np.diff(column[order], prepend=-1) != 0) | (np.diff(y[order], prepend=y[order[:1]]) > SNAP_M)
    number = np.empty(len(x), dtype=np.int64)
    number[order] = np.cumsum(new) - 1
    first = order[new]
    # all vertices of a column of points take its smallest x
    lowest = np.full(int(column.max()) + 1 if len(column) else 0, np.inf)
    np.minimum.at(lowest, column, x)
    return number, list(zip(lowest[column[first]].tolist(), y[first].tolist()))


def closed_walks(ends: list[tuple[int, int]], vertices: list[tuple[float, float]]) -> list[list[int]]:
    """Rings of vertices of directed edges with the inside on their left.

    At a vertex with several ways on, the walk takes the first one clockwise from where it came: it stays
    with the piece of inside that it walks along.  A walk that meets one of its vertices again gives off a ring.
    """
    count = Counter(ends)
    ways: dict[int, list[int]] = defaultdict(list)
    for (a, b), n in count.items():
        # an edge and its opposite have no inside between them
        ways[a] += [b] * max(0, n - count.get((b, a), 0))
    angle = lambda a, b: np.arctan2(vertices[b][1] - vertices[a][1], vertices[b][0] - vertices[a][0])
    rings = []
    for start in sorted(ways):
        while ways[start]:
            walk, at, came = [start], start, None
            seen = {start: 0}
            while ways[at]:
                options = ways[at]
                if len(options) > 1 and came is not None:
                    back = angle(at, came)
                    options.sort(key=lambda b: (back - angle(at, b)) % (2 * np.pi) or 2 * np.pi, reverse=True)
                came, at = at, options.pop()
                if at in seen:
                    rings.append(walk[seen[at]:])
                    for v in walk[seen[at] + 1:]:
                        del seen[v]
                    del walk[seen[at] + 1:]
                else:
                    seen[at] = len(walk)
                    walk.append(at)
    return rings


def ring_area(ring: Ring) -> float:
    x0, y0 = ring[0]
    return sum((ax - x0) * (by - y0) - (bx - x0) * (ay - y0) for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1])) / 2


def straightened(ring: Ring) -> Ring:
    """The ring without vertices on the line between their neighbours, from its smallest vertex on."""
    at = ring.index(min(ring))
    ring = ring[at:] + ring[:at]
    kept = [ring[0]]
    for (px, py), (nx, ny) in zip(ring[1:], ring[2:] + ring[:1]):
        ax, ay = kept[-1]
        length = np.hypot(nx - ax, ny - ay)
        ahead = (px - ax) * (nx - px) + (py - ay) * (ny - py) > 0
        if not ahead or abs((px - ax) * (ny - ay) - (nx - ax) * (py - ay)) > STRAIGHT_M * length:
            kept.append((px, py))
    return kept


def holds(shell: np.ndarray, x: float, y: float) -> bool:
    """Whether the point is inside the ring, by crossings of a ray."""
    x1, y1 = shell.T
    x2, y2 = np.roll(x1, -1), np.roll(y1, -1)
    crossed = (y1 > y) != (y2 > y)
    with np.errstate(divide="ignore", invalid="ignore"):
        right = x < x1 + (y - y1) * (x2 - x1) / (y2 - y1)
    return bool(np.count_nonzero(crossed & right) % 2)


def polygon(x1: np.ndarray, y1: np.ndarray, x2: np.ndarray, y2: np.ndarray) -> list[list[Ring]]:
    """Parts of the polygon with these directed boundary edges: shells counter-clockwise, each with its holes.

    Rings that are thinner than the accuracy of vertices are left out.  Parts and holes come in the order of
    their smallest vertices.
    """
    number, vertices = vertex_numbers(np.concatenate([x1, x2]), np.concatenate([y1, y2]))
    a, b = number[:len(x1)].tolist(), number[len(x1):].tolist()
    shells, holes = [], []
    for walk in closed_walks([e for e in zip(a, b) if e[0] != e[1]], vertices):
        ring = straightened([vertices[v] for v in walk])
        size = ring_area(ring) if len(ring) >= 3 else 0.0
        outline = sum(np.hypot(p[0] - q[0], p[1] - q[1]) for p, q in zip(ring, ring[1:] + ring[:1]))
        if abs(size) > SNAP_M * outline:
            (shells if size > 0 else holes).append((abs(size), ring))
    shells.sort()
    arrays = [np.array(ring) for _, ring in shells]
    boxes = [(*s.min(axis=0), *s.max(axis=0)) for s in arrays]
    parts: list[list[Ring]] = [[ring] for _, ring in shells]
    for size, ring in sorted(holes, key=lambda h: min(h[1])):
        # the middle of an edge: rings may touch in vertices, not along edges
        px, py = (ring[0][0] + ring[1][0]) / 2, (ring[0][1] + ring[1][1]) / 2
        for i, (shell_size, _) in enumerate(shells):
            box = boxes[i]
            if shell_size > size and box[0] <= px <= box[2] and box[1] <= py <= box[3] and holds(arrays[i], px, py):
                parts[i].append(ring)
                break
    return sorted(parts)


def stitch(edges: DataFrame) -> DataFrame:
    """(``grp``, ``geom``) from (``grp``, ``e``): lists of directed edges x1, y1, x2, y2 with the inside on the left.

    A group's outline is one value of the result, so its edges meet in one row, too.
    """
    schema = T.StructType([edges.schema["grp"], T.StructField("geom", GEOM)])
    kind = pa.list_(pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            e = batch.column("e")
            flat = [np.asarray(e.flatten().field(n)) for n in ("x1", "y1", "x2", "y2")]
            at = np.cumsum([0, *e.value_lengths().to_pylist()])
            found = [polygon(*[f[i:j] for f in flat]) for i, j in zip(at, at[1:])]
            geoms = [[[[{"x": x, "y": y} for x, y in ring] for ring in part] for part in parts] for parts in found]
            yield pa.RecordBatch.from_arrays([batch.column("grp"), pa.array(geoms, kind)], ["grp", "geom"])

    return edges.select("grp", "e").mapInArrow(run, schema)
