"""Union of footprints per group: area, perimeter and shape.

A group's edges are cut into chunks of shapes and bins of x, each of bounded size; bins hold about equally many
ends of edges.  Within a bin the plane is swept in slabs between neighbouring x breaks (edge ends and
crossings); in a slab no edges cross, so running over them from bottom to top shows where the group covers
the plane.  The covered trapezoids' bottom and top edges are again a set of edges, so chunk unions are united
in turn until one is left per group; a group whose last chunk is left waits for the others no longer.  Groups
whose edges run along x are swept along y instead.  The last unions' boundary edges are stitched to rings.
Groups of few edges, most of them in practice, are swept and stitched many at a time (``unions``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treatflow.functions.geometry import area, edges, perimeter
from treatflow.operators.rings import stitch
from treatflow.operators.unions import PLACES, united
from treatflow.session import broadcast_if_small, cut_lineage

CHUNK_EDGES = 256
BIN_EDGES = 64
FAN_IN = 4
FEW_EDGES = 64   # groups with no more vertices than this are united many at a time
FEW_GROUPS = 64  # beside larger ones, as many such groups are united with these


def _y(e: str, x: str) -> str:
    return f"({e}.y1 + ({x} - {e}.x1) * ({e}.y2 - {e}.y1) / ({e}.x2 - {e}.x1))"


def _crossings() -> str:
    """x of every inner crossing of two of the edges ``e``; pairs are taken once, by position."""
    lo, hi = "greatest(a.x1, b.x1)", "least(a.x2, b.x2)"
    d0 = f"({_y('a', lo)} - {_y('b', lo)})"
    d1 = f"({_y('a', hi)} - {_y('b', hi)})"
    # only pairs with a sloped edge can cross
    cross = f"a.x1 < b.x2 and b.x1 < a.x2 and (a.y1 != a.y2 or b.y1 != b.y2) and {d0} * {d1} < 0"
    at = f"{lo} + ({hi} - {lo}) * {d0} / ({d0} - {d1})"
    return (
        "flatten(transform(e, (a, i) -> "
        f"transform(filter(slice(e, i + 2, size(e)), b -> {cross}), b -> {at})))"
    )


TRAPEZOIDS = "array<struct<lo:double,hi:double,b0:double,b1:double,t0:double,t1:double,bi:int,ti:int>>"


def _slab(lo: str, hi: str) -> str:
    """Covered trapezoids of the slab from ``lo`` to ``hi``, bottom to top."""
    mid = f"(({lo} + {hi}) / 2)"
    numbered = "transform(e, (a, i) -> named_struct('x1', a.x1, 'y1', a.y1, 'x2', a.x2, 'y2', a.y2, 's', a.s, 'i', i))"
    spanning = f"filter({numbered}, a -> a.x1 < {mid} and {mid} < a.x2)"
    # at one height edges that open cover come first, so touching shapes leave no seam
    ordered = (
        f"array_sort(transform({spanning}, a -> named_struct('y', round({_y('a', mid)}, {PLACES}), 's', a.s, "
        f"'y0', {_y('a', lo)}, 'y1', {_y('a', hi)}, 'i', a.i)))"
    )
    zero = f"named_struct('cover', 0, 'b0', 0D, 'b1', 0D, 'bi', -1, 'out', cast(array() as {TRAPEZOIDS}))"
    opens, closes = "(acc.cover = 0 and a.s < 0)", "(acc.cover = 1 and a.s > 0)"
    done = (
        f"named_struct('lo', {lo}, 'hi', {hi}, 'b0', acc.b0, 'b1', acc.b1, 't0', a.y0, 't1', a.y1, "
        "'bi', acc.bi, 'ti', a.i)"
    )
    step = (
        "named_struct('cover', acc.cover - a.s, "
        f"'b0', if({opens}, a.y0, acc.b0), 'b1', if({opens}, a.y1, acc.b1), 'bi', if({opens}, a.i, acc.bi), "
        f"'out', if({closes}, array_append(acc.out, {done}), acc.out))"
    )
    return f"aggregate({ordered}, {zero}, (acc, a) -> {step}, acc -> acc.out)"


KEYS = ("grp", "turned", "chunk", "chunks")


def _place(x: str) -> str:
    """How many of the sorted ``cuts`` are at or below ``x``, by bisection."""
    middle = "((s.lo + s.hi) div 2)"
    step = (f"if(s.lo >= s.hi, s, if(get(cuts, {middle}) <= {x}, named_struct('lo', {middle} + 1, 'hi', s.hi), "
            f"named_struct('lo', s.lo, 'hi', {middle})))")
    return f"aggregate(steps, named_struct('lo', 0L, 'hi', bigint(size(cuts))), (s, k) -> {step}, s -> s.lo)"


def _sweep(pieces: DataFrame) -> DataFrame:
    """Trapezoids (``z``) of the union of each chunk, one row per x bin."""
    ends = F.array_sort(F.concat(F.collect_list("x1"), F.collect_list("x2")))
    ranked = pieces.groupBy(*KEYS).agg(ends.alias("ends")).withColumn("bins", F.expr(f"ceil(size(ends) / {2 * BIN_EDGES})"))
    # inner borders of the bins: every so many ends of edges
    border = "get(ends, int(k * size(ends) div bins))"
    cuts = F.expr(f"if(bins > 1, filter(array_distinct(transform(sequence(1L, bins - 1), k -> {border})), c -> c > get(ends, 0)), array())")
    ruled = ranked.select(*KEYS, cuts.cast("array<double>").alias("cuts")).withColumn(
        "steps", F.expr("sequence(0, if(size(cuts) = 0, 0, int(log2(size(cuts))) + 1))"))
    placed = pieces.join(ruled, list(KEYS))
    spread = placed.withColumn("bin", F.expr(f"explode(sequence({_place('x1')}, {_place('x2')}))"))
    # outside the array there is no border, and least and greatest skip nulls
    ranged = spread.withColumns({"a": F.expr("greatest(x1, get(cuts, int(bin) - 1))"), "b": F.expr("least(x2, get(cuts, int(bin)))")})
    height = lambda x: f"y1 + ({x} - x1) * (y2 - y1) / (x2 - x1)"
    cut = F.expr(
        f"named_struct('x1', a, 'y1', if(a = x1, y1, {height('a')}), 'x2', b, 'y2', if(b = x2, y2, {height('b')}), 's', s)"
    )
    gathered = (
        ranged.select(*KEYS, "bin", cut.alias("e"))
        .filter(F.col("e.x1") < F.col("e.x2"))
        .groupBy(*KEYS, "bin")
        .agg(F.collect_list("e").alias("e"))
    )
    ends = "transform(e, a -> a.x1), transform(e, a -> a.x2)"
    breaks = gathered.withColumn("x", F.expr(f"array_sort(array_distinct(concat({ends}, {_crossings()})))"))
    slabs = f"transform(sequence(0, size(x) - 2), k -> {_slab('get(x, k)', 'get(x, k + 1)')})"
    return breaks.select(*KEYS, F.expr(f"flatten({slabs})").alias("z"))


RUNS = "array<struct<x1:double,y1:double,x2:double,y2:double,i:int>>"


def _joined_runs(low: str, high: str, index: str) -> str:
    """Bottom (or top) edges of the trapezoids, with neighbours on one source edge made one again."""
    sides = (
        f"array_sort(transform(z, t -> named_struct('i', t.{index}, 'x1', t.lo, 'y1', t.{low}, "
        f"'x2', t.hi, 'y2', t.{high})))"
    )
    last = "try_element_at(acc, -1)"
    run = lambda start: f"named_struct('x1', {start}.x1, 'y1', {start}.y1, 'x2', t.x2, 'y2', t.y2, 'i', t.i)"
    follows = f"coalesce({last}.i = t.i and {last}.x2 = t.x1, false)"
    step = (
        f"if({follows}, array_append(slice(acc, 1, size(acc) - 1), {run(last)}), array_append(acc, {run('t')}))"
    )
    return f"aggregate({sides}, cast(array() as {RUNS}), (acc, t) -> {step})"


def _boundary(swept: DataFrame) -> DataFrame:
    """Bottom (s = -1) and top (s = +1) edges of the swept unions."""
    both = (
        f"inline(array(named_struct('s', -1, 'r', {_joined_runs('b0', 'b1', 'bi')}), "
        f"named_struct('s', 1, 'r', {_joined_runs('t0', 't1', 'ti')})))"
    )
    one = swept.select(*KEYS, F.expr(both))
    return one.select(*KEYS, "s", F.inline("r")).select(*KEYS, "x1", "y1", "x2", "y2", "s")


SPANS = "array<struct<y0:double,y1:double,d:int>>"


def _uprights(swept: DataFrame) -> DataFrame:
    """Vertical boundary edges with the inside on their left: where cover differs left and right of an x."""
    ends = (
        "inline(flatten(transform(z, t -> array("
        "named_struct('x', t.lo, 'y0', t.b0, 'y1', t.t0, 'side', 1), "
        "named_struct('x', t.hi, 'y0', t.b1, 'y1', t.t1, 'side', -1)))))"
    )
    spans = swept.select("grp", "turned", F.expr(ends)).filter(F.col("y0") < F.col("y1"))
    # left and right spans do not overlap their own kind, so +1/-1 steps of "right minus left" suffice
    steps = spans.select(
        "grp", "turned", "x", F.expr("inline(array(named_struct('y', y0, 'd', side), named_struct('y', y1, 'd', -side)))")
    )
    # equal heights cancel here; most borders between slabs leave nothing
    level = steps.groupBy("grp", "turned", "x", "y").agg(F.sum("d").cast("int").alias("d")).filter("d != 0")
    per_x = level.groupBy("grp", "turned", "x").agg(F.array_sort(F.collect_list(F.struct("y", "d"))).alias("steps"))
    differing = F.expr(
        f"aggregate(steps, named_struct('diff', 0, 'at', 0D, 'out', cast(array() as {SPANS})), (acc, s) -> named_struct("
        "'diff', acc.diff + s.d, 'at', s.y, 'out', if(acc.diff != 0, "
        "array_append(acc.out, named_struct('y0', acc.at, 'y1', s.y, 'd', acc.diff)), acc.out)), acc -> acc.out)"
    )
    listed = per_x.select("grp", "turned", "x", F.inline(differing))
    # inside on the right of x: downwards
    return listed.select("grp", "turned", F.col("x").alias("x1"), F.expr("if(d > 0, y1, y0)").alias("y1"),
                         F.col("x").alias("x2"), F.expr("if(d > 0, y0, y1)").alias("y2"))


def _outline(swept: DataFrame) -> DataFrame:
    """(``grp``, ``e``): the directed boundary edges of each group, inside on the left, turned back."""
    sloped = _boundary(swept)
    # bottom edges run to the right, top edges to the left
    along = sloped.select(
        "grp", "turned", *[F.expr(f"if(s < 0, {a}, {b})").alias(a) for a, b in (("x1", "x2"), ("y1", "y2"), ("x2", "x1"), ("y2", "y1"))]
    )
    every = along.unionByName(_uprights(swept))
    # turning mirrors the plane, which swaps left and right: edges run the other way
    back = every.select("grp", *[F.expr(f"if(turned, {t}, {c})").alias(c) for c, t in (("x1", "y2"), ("y1", "x2"), ("x2", "y1"), ("y2", "x1"))])
    return back.groupBy("grp").agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("e"))


def _turned_edges(geom: str) -> Column:
    """Edges of the polygon with x and y exchanged, whose rings then run the other way."""
    swapped = f"transform({geom}, p -> transform(p, r -> transform(r, v -> named_struct('x', v.y, 'y', v.x))))"
    return F.transform(edges(swapped), lambda e: e.withField("s", -e["s"]))


def _chunked(rows: DataFrame) -> DataFrame:
    """(``grp``, ``geom``): unions of groups of any size, chunk by chunk."""
    sized = rows.distinct().withColumns({"e": edges("geom"), "f": _turned_edges("geom")})
    length = lambda e: F.sum(F.expr(f"aggregate({e}, 0D, (n, a) -> n + a.x2 - a.x1)"))
    extent = lambda e: F.max(F.expr(f"array_max({e}.x2)")) - F.min(F.expr(f"array_min({e}.x1)"))
    totals = sized.groupBy("grp").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.size("e")).alias("n_edges"), F.sum(F.size("f")).alias("n_turned"),
        # how many edges a slab meets on average, along x and along y
        (length("e") / extent("e")).alias("met"), (length("f") / extent("f")).alias("met_turned"),
    )
    turned = F.coalesce(F.col("met_turned") < F.col("met"), F.lit(False))
    totals = totals.withColumn("turned", turned).withColumn(
        "chunks", F.greatest(F.ceil(F.expr("if(turned, n_turned, n_edges)") / CHUNK_EDGES), F.lit(1)))
    known = cut_lineage(sized.join(totals, "grp").withColumn("e", F.expr("if(turned, f, e)")).select(
        "grp", "geom", "e", "n", "turned", "chunks"))
    single = known.filter(F.col("n") == 1).select("grp", "geom")
    several = known.filter(F.col("n") > 1)
    most = several.agg(F.max("chunks")).head()[0]
    if most is None:
        return single
    pieces = several.select(
        "grp", "turned", F.pmod(F.xxhash64("geom"), F.col("chunks")).alias("chunk"), "chunks", F.inline("e"))
    ready = pieces.filter("chunks = 1")
    while most > 1:
        # unions of chunks, several of which then make one chunk of the next level
        fewer = F.ceil(F.col("chunks") / FAN_IN)
        most = -(-most // FAN_IN)
        pieces = cut_lineage(
            _boundary(_sweep(pieces.filter("chunks > 1"))).withColumns({"chunk": F.pmod(F.col("chunk"), fewer), "chunks": fewer})
        )
        ready = ready.unionByName(pieces.filter("chunks = 1"))
    return single.unionByName(stitch(_outline(cut_lineage(_sweep(ready)))))


def dissolve_shapes(df: DataFrame, group: str, geom: str = "geom") -> DataFrame:
    """(group, geom, area, perimeter) of the union of each group's polygons.

    Exact copies count once, and groups with one distinct shape keep it as it is.  The other unions are valid
    polygons: shells counter-clockwise with their holes, no two parts share more than a vertex, no vertex lies on
    the line between its neighbours.
    """
    rows = df.filter(F.col(geom).isNotNull() & F.col(group).isNotNull()).select(F.col(group).alias("grp"), F.col(geom).alias("geom"))
    counted = rows.groupBy("grp").agg(F.sum(F.size(F.flatten(F.flatten("geom")))).alias("n"))
    crowded = cut_lineage(counted.filter(F.col("n") > FEW_EDGES).select("grp"))
    if crowded.isEmpty():
        shapes = united(rows)
    else:
        crowded = broadcast_if_small(crowded)
        others = rows.join(crowded, "grp", "left_anti")
        if others.select("grp").distinct().limit(FEW_GROUPS + 1).count() <= FEW_GROUPS:
            # a handful of groups is no work of its own: they join the last sweep
            shapes = _chunked(rows)
        else:
            shapes = united(others).unionByName(_chunked(rows.join(crowded, "grp", "left_semi")))
    measured = shapes.withColumns({"area": area("geom"), "perimeter": perimeter("geom")})
    return measured.withColumnRenamed("grp", group)
