"""Unions of groups with few edges: the sweep of ``dissolve`` and the walk of ``rings`` on arrays of many groups at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from treatflow.fixed_values import GEOM
from treatflow.operators.rings import SNAP_M, STRAIGHT_M, polygon

PLACES = 6             # heights that agree to a micrometre are the same line
WORK = 1_000_000       # heights of edges that are held at once, at most about

Edges = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``counts[i]`` times ``i`` for every i, and the place among them."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def _new(*columns: np.ndarray) -> np.ndarray:
    """Where sorted rows differ from the row before."""
    out = np.ones(len(columns[0]), dtype=bool)
    out[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return out


def _heights(x1, y1, x2, y2, e, x):
    return y1[e] + (x - x1[e]) * (y2[e] - y1[e]) / (x2[e] - x1[e])


def outline(g: np.ndarray, x1: np.ndarray, y1: np.ndarray, x2: np.ndarray, y2: np.ndarray, s: np.ndarray) -> Edges:
    """(group, x1, y1, x2, y2) of the directed boundary edges of each group, inside on the left.

    Edges run from left to right, ``s`` is +1 on top and -1 at the bottom, and ``g`` ascends.
    """
    m = len(g)
    last = np.searchsorted(g, g, side="right")
    a, k = _spread(last - np.arange(m) - 1)
    b = a + 1 + k
    lo, hi = np.maximum(x1[a], x1[b]), np.minimum(x2[a], x2[b])
    # only pairs with a sloped edge can cross
    meet = (lo < hi) & ((y1[a] != y2[a]) | (y1[b] != y2[b]))
    a, b, lo, hi = a[meet], b[meet], lo[meet], hi[meet]
    d0 = _heights(x1, y1, x2, y2, a, lo) - _heights(x1, y1, x2, y2, b, lo)
    d1 = _heights(x1, y1, x2, y2, a, hi) - _heights(x1, y1, x2, y2, b, hi)
    cross = d0 * d1 < 0
    d0, d1, lo, hi = d0[cross], d1[cross], lo[cross], hi[cross]
    at_g = np.concatenate([g, g, g[a[cross]]])
    at_x = np.concatenate([x1, x2, lo + (hi - lo) * d0 / (d0 - d1)])
    order = np.lexsort((at_x, at_g))
    new = _new(at_g[order], at_x[order])
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.cumsum(new) - 1
    breaks, owners = at_x[order][new], at_g[order][new]
    # every edge in every slab that it spans, bottom to top; edges that open cover come first at one height
    e, k = _spread(place[m:2 * m] - place[:m])
    slab = place[e] + k
    left, right = breaks[slab], breaks[slab + 1]
    h0, h1 = _heights(x1, y1, x2, y2, e, left), _heights(x1, y1, x2, y2, e, right)
    middle = np.round(_heights(x1, y1, x2, y2, e, (left + right) / 2), PLACES)
    order = np.lexsort((e, h1, h0, s[e], middle, slab))
    e, slab, left, right, h0, h1 = e[order], slab[order], left[order], right[order], h0[order], h1[order]
    step = s[e]
    run = np.cumsum(-step)
    first = _new(slab)
    before = run + step - np.repeat((run + step)[first], np.diff(np.append(np.flatnonzero(first), len(e))))
    opened = np.maximum.accumulate(np.where((before == 0) & (step < 0), np.arange(len(e)), -1))
    t = np.flatnonzero((before == 1) & (step > 0))
    o = opened[t]
    parts = []
    for top, i in ((False, o), (True, t)):
        # neighbours on one edge are made one again
        order = np.lexsort((left[i], e[i]))
        i = i[order]
        start = np.ones(len(i), dtype=bool)
        start[1:] = (e[i][1:] != e[i][:-1]) | (right[i][:-1] != left[i][1:])
        end = np.append(start[1:], True)[:len(i)]
        i, j = i[start], i[end]
        ends = ((left[i], h0[i]), (right[j], h1[j]))
        (ax, ay), (bx, by) = ends[::-1] if top else ends
        parts.append((g[e[i]], ax, ay, bx, by))
    # upright edges: where cover differs left and right of a break
    spans = [(slab[t], h0[o], h0[t], 1), (slab[t] + 1, h1[o], h1[t], -1)]
    spans = [(x[y0 < y1_], y0[y0 < y1_], y1_[y0 < y1_], side) for x, y0, y1_, side in spans]
    at = np.concatenate([v for x, _, _, _ in spans for v in (x, x)])
    y = np.concatenate([v for _, y0, y1_, _ in spans for v in (y0, y1_)])
    d = np.concatenate([np.full(len(x), sign) for x, _, _, side in spans for sign in (side, -side)])
    order = np.lexsort((y, at))
    at, y = at[order], y[order]
    starts = np.flatnonzero(_new(at, y)) if len(at) else np.zeros(0, dtype=np.int64)
    d = np.add.reduceat(d[order], starts) if len(starts) else d
    at, y, d = at[starts][d != 0], y[starts][d != 0], d[d != 0]
    differ = np.cumsum(d)
    k = np.flatnonzero(differ != 0)
    k = k[k + 1 < len(at)]
    down = differ[k] > 0          # inside on the right
    owner = owners[at[k]]
    x = breaks[at[k]]
    parts.append((owner, x, np.where(down, y[k + 1], y[k]), x, np.where(down, y[k], y[k + 1])))
    return tuple(np.concatenate([p[c] for p in parts]) for c in range(5))


def _vertices(g: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Number of the vertex of each point, and group, x and y of the vertices; see ``rings.vertex_numbers``."""
    order = np.lexsort((x, g))
    far = np.ones(len(x), dtype=bool)
    far[1:] = (np.diff(g[order]) != 0) | (np.diff(x[order]) > SNAP_M)
    column = np.empty(len(x), dtype=np.int64)
    column[order] = np.cumsum(far) - 1
    lowest = x[order][far]
    order = np.lexsort((y, column))
    far = np.ones(len(x), dtype=bool)
    far[1:] = (np.diff(column[order]) != 0) | (np.diff(y[order]) > SNAP_M)
    number = np.empty(len(x), dtype=np.int64)
    number[order] = np.cumsum(far) - 1
    first = order[far]
    return number, g[first], lowest[column[first]], y[first]


def _followers(a: np.ndarray, b: np.ndarray, vx: np.ndarray, vy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The edge after each edge, the first one clockwise from where it came, and vertices at which that is not plain."""
    n = len(a)
    vertex = np.concatenate([b, a])
    out = np.repeat([False, True], n)
    other = np.concatenate([a, b])
    angle = np.arctan2(vy[other] - vy[vertex], vx[other] - vx[vertex])
    order = np.lexsort((-angle, vertex))
    vertex, out, angle, edge = vertex[order], out[order], angle[order], np.tile(np.arange(n), 2)[order]
    first = np.flatnonzero(_new(vertex))
    size = np.diff(np.append(first, 2 * n))
    after = np.arange(1, 2 * n + 1)
    after[first + size - 1] = first
    # ways in and out take turns around a vertex
    bad = (out == out[after]) | ((angle == angle[after]) & (np.repeat(size, size) > 1))
    follower = np.empty(n, dtype=np.int64)
    follower[edge[~out]] = edge[after[~out]]
    return follower, vertex[bad]


def unions(edges: Edges, n_groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(groups that are left to ``rings.polygon``, x, y, vertices per ring, rings per part, parts per group) of the stitched edges."""
    g, x1, y1, x2, y2 = edges
    number, vg, vx, vy = _vertices(np.tile(g, 2), np.concatenate([x1, x2]), np.concatenate([y1, y2]))
    a, b = number[:len(g)], number[len(g):]
    a, b = a[a != b], b[a != b]
    # an edge and its opposite have no inside between them
    low, high, sign = np.minimum(a, b), np.maximum(a, b), np.where(a < b, 1, -1)
    order = np.lexsort((high, low))
    low, high = low[order], high[order]
    starts = np.flatnonzero(_new(low, high)) if len(low) else np.zeros(0, dtype=np.int64)
    net = np.add.reduceat(sign[order], starts) if len(starts) else starts
    low, high = low[starts], high[starts]
    odd = np.zeros(n_groups, dtype=bool)
    odd[vg[low[np.abs(net) > 1]]] = True
    a, b = np.where(net > 0, low, high)[net != 0], np.where(net > 0, high, low)[net != 0]
    ways_out, ways_in = np.bincount(a, minlength=len(vg)), np.bincount(b, minlength=len(vg))
    odd[vg[ways_out != ways_in]] = True
    plain = ~odd[vg[a]]
    a, b = a[plain], b[plain]
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    empty = np.zeros(0, dtype=np.int64)
    if not len(a):
        return odd, empty.astype(float), empty.astype(float), empty, empty, np.zeros(n_groups, dtype=np.int64)
    follower, bad = _followers(a, b, vx, vy)
    odd[vg[bad]] = True
    plain = ~odd[vg[a]]
    # left out groups end every walk at once
    follower = np.where(plain, follower, np.arange(len(a)))
    most = int(np.bincount(vg[a]).max())
    ring, jump = np.arange(len(a)), follower
    for _ in range(most.bit_length()):
        ring, jump = np.minimum(ring, ring[jump]), jump[jump]
    # a ring that meets a vertex twice is more than one ring
    order = np.lexsort((ring, a))
    twice = order[1:][(a[order][1:] == a[order][:-1]) & (ring[order][1:] == ring[order][:-1])]
    odd[vg[a[twice]]] = True
    plain = ~odd[vg[a]]
    starts = np.flatnonzero((ring == np.arange(len(a))) & plain)
    # all rings are walked at once, from their smallest vertex on, leaving out vertices on a line
    kept, at = np.zeros(len(a), dtype=bool), np.zeros(len(a), dtype=np.int64)
    kept[starts] = True
    begin, ax, ay = starts, vx[a[starts]], vy[a[starts]]
    now, k = follower[starts], 0
    while len(now):
        k += 1
        px, py, nx, ny = vx[a[now]], vy[a[now]], vx[b[now]], vy[b[now]]
        ahead = (px - ax) * (nx - px) + (py - ay) * (ny - py) > 0
        off = np.abs((px - ax) * (ny - ay) - (nx - ax) * (py - ay)) > STRAIGHT_M * np.hypot(nx - ax, ny - ay)
        keep = ~ahead | off
        kept[now], at[now] = keep, k
        ax, ay = np.where(keep, px, ax), np.where(keep, py, ay)
        now = follower[now]
        on = now != begin
        begin, ax, ay, now = begin[on], ax[on], ay[on], now[on]
    points = np.flatnonzero(kept & plain)
    points = points[np.lexsort((at[points], ring[points]))]
    first = np.flatnonzero(_new(ring[points])) if len(points) else empty
    size = np.diff(np.append(first, len(points)))
    of = np.repeat(np.arange(len(first)), size)
    x, y = vx[a[points]], vy[a[points]]
    after = np.arange(1, len(points) + 1)
    if len(first):
        after[first + size - 1] = first
    ox, oy = x[first][of], y[first][of]
    area = np.bincount(of, (x - ox) * (y[after] - oy) - (x[after] - ox) * (y - oy), len(first)) / 2
    length = np.bincount(of, np.hypot(x[after] - x, y[after] - y), len(first))
    group = vg[a[points[first]]]
    real = (size >= 3) & (np.abs(area) > SNAP_M * length)
    shells = np.bincount(group[real & (area > 0)], minlength=n_groups)
    holes = np.bincount(group[real & (area < 0)], minlength=n_groups)
    # with several shells holes have to be placed
    odd |= (holes > 0) & (shells != 1)
    taken = np.flatnonzero(real & ~odd[group])
    second = a[points[np.minimum(first + 1, len(points) - 1)]]
    taken = taken[np.lexsort((second[taken], a[points[first]][taken], area[taken] < 0, group[taken]))]
    owner, k = _spread(size[taken])
    index = first[taken][owner] + k
    is_shell = area[taken] > 0
    rings = np.diff(np.append(np.flatnonzero(is_shell), len(taken)))
    return odd, x[index], y[index], size[taken], rings, np.where(odd, 0, shells)


def _offsets(counts: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())


KIND = pa.list_(pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))))


def _polygon_edges(geoms: pa.Array) -> tuple[np.ndarray, ...]:
    """Row, x1, y1, x2, y2 and ``s`` of the edges that are not upright, left to right."""
    per_part, parts = geoms.value_lengths().to_numpy(), geoms.flatten()
    per_ring, rings = parts.value_lengths().to_numpy(), parts.flatten()
    size, points = rings.value_lengths().to_numpy(), rings.flatten()
    row = np.repeat(np.repeat(np.repeat(np.arange(len(geoms)), per_part), per_ring), size)
    x, y = (points.field(n).to_numpy(zero_copy_only=False) for n in ("x", "y"))
    after = np.arange(1, len(points) + 1)
    ends = np.cumsum(size)
    after[ends[size > 0] - 1] = (ends - size)[size > 0]
    bx, by = x[after], y[after]
    right = x < bx
    use = right | (bx < x)
    columns = (row, np.where(right, x, bx), np.where(right, y, by), np.where(right, bx, x), np.where(right, by, y), np.where(right, -1, 1))
    return tuple(c[use] for c in columns)


def _union_batches(keys: pa.Array, geoms: pa.Array, hashes: np.ndarray, start: np.ndarray) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Groups and their unions; groups begin at the rows ``start``."""
    group = np.cumsum(start) - 1
    begin = np.flatnonzero(start)
    several = np.zeros(len(begin), dtype=bool)
    several[group[1:][(hashes[1:] != hashes[:-1]) & ~start[1:]]] = True
    alone = pa.array(begin[~several])
    if len(alone):
        yield keys.take(alone), geoms.take(alone)
    g, *edges = _polygon_edges(geoms)
    g = group[g]
    edges = [e[several[g]] for e in edges]
    g = g[several[g]]
    # as many groups at once as the heights of their edges allow
    count = np.bincount(g, minlength=len(begin)).astype(np.int64)
    share = np.cumsum(count ** 2 * (1 + count // 8)) // WORK
    for i in np.unique(share[count > 0]):
        chosen = np.flatnonzero((share == i) & (count > 0))
        here = slice(*np.searchsorted(g, [chosen[0], chosen[-1] + 1]))
        number = np.searchsorted(chosen, g[here])
        found = outline(number, *[e[here] for e in edges])
        odd, x, y, per_ring, per_part, per_group = unions(found, len(chosen))
        bounded = np.bincount(found[0], minlength=len(chosen)) > 0
        points = pa.StructArray.from_arrays([pa.array(x), pa.array(y)], ["x", "y"])
        shapes = pa.ListArray.from_arrays(_offsets(per_ring), points)
        shapes = pa.ListArray.from_arrays(_offsets(per_part), shapes)
        shapes = pa.ListArray.from_arrays(_offsets(per_group), shapes)
        whole = pa.array(np.flatnonzero(~odd & bounded))
        if len(whole):
            yield keys.take(pa.array(begin[chosen])).take(whole), shapes.take(whole)
        rest = np.flatnonzero(odd)
        if len(rest):
            parts = [polygon(*[c[found[0] == r] for c in found[1:]]) for r in rest]
            listed = [[[[{"x": x, "y": y} for x, y in ring] for ring in part] for part in parts_] for parts_ in parts]
            yield keys.take(pa.array(begin[chosen[rest]])), pa.array(listed, KIND)


def united(rows: DataFrame) -> DataFrame:
    """(``grp``, ``geom``): the union of each group's polygons; a group with one distinct shape keeps it as it is.

    Groups are sorted and come one after the other, so a task holds one batch of them at a time.
    """
    schema = T.StructType([rows.schema["grp"], T.StructField("geom", GEOM)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None

        def done(table: pa.Table) -> Iterator[pa.RecordBatch]:
            keys, geoms, hashes = (table.column(c).combine_chunks() for c in ("grp", "geom", "h"))
            start = np.ones(len(keys), dtype=bool)
            start[1:] = pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_numpy(zero_copy_only=False)
            for k, shapes in _union_batches(keys, geoms, hashes.to_numpy(), start):
                yield pa.RecordBatch.from_arrays([k, shapes.cast(KIND)], ["grp", "geom"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            keys = table.column("grp").combine_chunks()
            # the last group may go on in the next batch
            same = pc.equal(keys, keys[len(keys) - 1]).to_numpy(zero_copy_only=False) if len(keys) else np.zeros(0, dtype=bool)
            cut = int(np.argmax(same)) if len(keys) else 0
            if cut:
                yield from done(table.slice(0, cut))
            rest = table.slice(cut)
        if rest is not None and rest.num_rows:
            yield from done(rest)

    # a hash of nested arrays sees their values only
    sizes = [F.expr("transform(geom, p -> size(p))"), F.expr("transform(flatten(geom), r -> size(r))")]
    sorted_rows = rows.select("grp", "geom", F.xxhash64("geom", F.size("geom"), *sizes).alias("h")).repartition("grp").sortWithinPartitions("grp", "h")
    return sorted_rows.mapInArrow(run, schema)
