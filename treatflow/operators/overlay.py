"""Overlap areas between two polygon tables, and the owner with the largest share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treatflow.fixed_values import SQ_M_PER_ACRE
from treatflow.functions.geometry import bounds, cell_range, edges
from treatflow.session import broadcast_if_small, cut_lineage

# a millimetre: the accuracy of coordinates
TOLERANCE_M = 0.001
EDGES_PER_BIN = 32


def grid_cells(df: DataFrame, geom: str, size: float) -> DataFrame:
    """One row per grid cell (``cell_x``, ``cell_y``) the polygon's bounding box touches."""
    boxed = df.withColumn("__b", bounds(geom))
    by_column = boxed.withColumn("cell_x", F.explode(cell_range(F.col("__b.xmin"), F.col("__b.xmax"), size)))
    return by_column.withColumn("cell_y", F.explode(cell_range(F.col("__b.ymin"), F.col("__b.ymax"), size))).drop("__b")


def typical_width(df: DataFrame, geom: str = "geom") -> float:
    """Median bounding-box width, a good cell size for the overlay."""
    b = bounds(geom)
    row = df.select((b["xmax"] - b["xmin"]).alias("w")).agg(F.percentile_approx("w", 0.5)).head()
    return float(row[0] or 1.0)


def _staged(df: DataFrame, keep: list[str], geom: str, size: float, tag: str) -> DataFrame:
    """Written polygons with a number of their own, box, edges, bins of edges and size level.

    On level l cells are ``size * 2^l`` wide, and a polygon's own level is the lowest one whose cells are as wide as its box:
    it touches at most four of them, however large it is.
    """
    boxed = df.filter(F.col(geom).isNotNull()).select(*keep, bounds(geom).alias("b"), edges(geom).alias("e"))
    width = F.greatest(F.col("b.xmax") - F.col("b.xmin"), F.col("b.ymax") - F.col("b.ymin"))
    named = boxed.filter(F.size("e") > 0).withColumns({
        "id": F.monotonically_increasing_id(),
        "level": F.greatest(F.ceil(F.log2(width / F.lit(size))), F.lit(0)).cast("int"),
        "bins": F.ceil(F.size("e") / EDGES_PER_BIN).cast("int"),
    })
    return cut_lineage(named.withColumnsRenamed({c: f"{c}{tag}" for c in ("id", "b", "e", "level", "bins")}))


def level_cells(boxes: DataFrame, tag: str, size: float, levels: Column) -> DataFrame:
    """The cells (``l``, ``cx``, ``cy``) that each box touches on each of ``levels``."""
    on_level = boxes.withColumn("l", F.explode(levels))
    side = F.lit(size) * F.pow(F.lit(2.0), F.col("l"))
    cells = lambda axis: F.sequence(F.floor(F.col(f"b{tag}.{axis}min") / side), F.floor(F.col(f"b{tag}.{axis}max") / side))
    return on_level.withColumn("cx", F.explode(cells("x"))).withColumn("cy", F.explode(cells("y")))


def _box_pairs(p: DataFrame, q: DataFrame, left_keep: list[str], right_keep: list[str], size: float) -> DataFrame:
    """Pairs of polygons whose boxes overlap, each once, by numbers and boxes only.

    The larger one of a pair is looked up in the cells of its own level, to which the smaller one comes up.  Of the
    cells they share the one with the lower corner of the common box counts.
    """
    kinds = {t: df.select(f"level{t}").distinct() for t, df in (("p", p), ("q", q))}
    # levels are binary logarithms of widths, so there are few of them
    known = {t: F.array(*[F.lit(r[0]) for r in df.collect()]).cast("array<int>") for t, df in kinds.items()}
    low = p.select("idp", "bp", "levelp", "binsp", *left_keep)
    high = q.select("idq", "bq", "levelq", "binsq", *right_keep)
    own = lambda tag: F.array(F.col(f"level{tag}"))
    meets = ["l", "cx", "cy"]
    larger_right = level_cells(low, "p", size, F.filter(known["q"], lambda v: v >= F.col("levelp"))).join(
        level_cells(high, "q", size, own("q")), meets)
    larger_left = level_cells(low, "p", size, own("p")).join(
        level_cells(high, "q", size, F.filter(known["p"], lambda v: v > F.col("levelq"))), meets)
    side = F.lit(size) * F.pow(F.lit(2.0), F.col("l"))
    corner = lambda axis: F.floor(F.greatest(f"bp.{axis}min", f"bq.{axis}min") / side)
    return larger_right.unionByName(larger_left).filter(
        (F.col("cx") == corner("x")) & (F.col("cy") == corner("y"))
        & (F.col("bp.xmin") < F.col("bq.xmax")) & (F.col("bq.xmin") < F.col("bp.xmax"))
        & (F.col("bp.ymin") < F.col("bq.ymax")) & (F.col("bq.ymin") < F.col("bp.ymax"))
    ).drop(*meets)


def _binned_edges(staged: DataFrame, tag: str) -> DataFrame:
    """(``id``, ``bin``, ``e``): the edges that reach into each of a polygon's x bins, about ``EDGES_PER_BIN`` each."""
    width = (F.col(f"b{tag}.xmax") - F.col(f"b{tag}.xmin")) / F.col(f"bins{tag}")
    place = lambda x: F.least(F.floor((x - F.col(f"b{tag}.xmin")) / width).cast("int"), F.col(f"bins{tag}") - 1)
    # an edge goes to the bins it touches, so no bin looks at all edges
    spread = staged.filter(F.col(f"bins{tag}") > 1).select(f"id{tag}", f"b{tag}", f"bins{tag}", F.explode(f"e{tag}").alias("e"))
    listed = spread.withColumn(f"bin{tag}", F.explode(F.sequence(place(F.col("e.x1")), place(F.col("e.x2")))))
    several = listed.groupBy(f"id{tag}", f"bin{tag}").agg(F.collect_list("e").alias(f"e{tag}"))
    one = staged.filter(F.col(f"bins{tag}") == 1).select(f"id{tag}", F.lit(0).alias(f"bin{tag}"), f"e{tag}")
    return one.unionByName(several)


def _fetch_bins(pairs: DataFrame, staged: DataFrame, tag: str) -> DataFrame:
    """Pairs once for every bin of one polygon in the x range ``lo`` to ``hi``, which is narrowed to the bin."""
    low, bins = F.col(f"b{tag}.xmin"), F.col(f"bins{tag}")
    width = (F.col(f"b{tag}.xmax") - low) / bins
    place = lambda x: F.least(F.floor((x - low) / width).cast("int"), bins - 1)
    number = F.col(f"bin{tag}")
    spread = pairs.withColumn(f"bin{tag}", F.explode(F.sequence(place(F.col("lo")), place(F.col("hi")))))
    joined = spread.join(broadcast_if_small(_binned_edges(staged, tag)), [f"id{tag}", f"bin{tag}"])
    narrowed = joined.withColumns({
        "lo": F.when(number == 0, F.col("lo")).otherwise(F.greatest("lo", low + number * width)),
        "hi": F.when(number == bins - 1, F.col("hi")).otherwise(F.least("hi", low + (number + 1) * width)),
    })
    return narrowed.filter(F.col("lo") < F.col("hi")).drop(f"bin{tag}", f"b{tag}", f"bins{tag}", f"id{tag}")


def _y(e: str, x: Column) -> Column:
    return F.col(f"{e}.y1") + (x - F.col(f"{e}.x1")) * (F.col(f"{e}.y2") - F.col(f"{e}.y1")) / (
        F.col(f"{e}.x2") - F.col(f"{e}.x1")
    )


def overlap_pieces(left: DataFrame, left_keep: list[str], right: DataFrame, right_keep: list[str], size: float,
                   geom: str = "geom") -> DataFrame:
    """Signed area pieces whose sum over a pair of polygons is its overlap area.

    Pairs are found by boxes; then the edges of each side come bin by bin, and only those of bins that share a
    range of x are multiplied.  There the overlap is the sum over pairs of edges of
    ``s_p * s_q * integral(min(y_p, y_q) - base)``, exact for simple polygons with holes.  ``reach`` is
    half the outline of the common box.  ``size`` is the width of the smallest cells.
    """
    p, q = _staged(left, left_keep, geom, size, "p"), _staged(right, right_keep, geom, size, "q")
    keys = [*left_keep, *right_keep]
    reach = (F.least("bp.xmax", "bq.xmax") - F.greatest("bp.xmin", "bq.xmin")
             + F.least("bp.ymax", "bq.ymax") - F.greatest("bp.ymin", "bq.ymin"))
    pairs = _box_pairs(p, q, left_keep, right_keep, size).select(
        *keys, "idp", "idq", "bp", "bq", "binsp", "binsq", F.col("bp.ymin").alias("base"), reach.alias("reach"),
        F.greatest("bp.xmin", "bq.xmin").alias("lo"), F.least("bp.xmax", "bq.xmax").alias("hi"),
    )
    shared = _fetch_bins(_fetch_bins(pairs, p, "p"), q, "q")
    one = shared.select(*keys, "base", "reach", "lo", "hi", "eq", F.explode("ep").alias("p")).filter(
        (F.col("p.x1") < F.col("hi")) & (F.col("p.x2") > F.col("lo")))
    two = one.select(*keys, "base", "reach", "lo", "hi", "p", F.explode("eq").alias("q"))
    ranged = two.select(
        *keys, "base", "reach", "p", "q", F.greatest("p.x1", "q.x1", "lo").alias("lo"), F.least("p.x2", "q.x2", "hi").alias("hi"),
    ).filter(F.col("lo") < F.col("hi"))
    lo, hi = F.col("lo"), F.col("hi")
    heights = ranged.select(
        *keys, "reach", "lo", "hi", (F.col("p.s") * F.col("q.s")).alias("s"),
        (_y("p", lo) - F.col("base")).alias("p0"), (_y("p", hi) - F.col("base")).alias("p1"),
        (_y("q", lo) - F.col("base")).alias("q0"), (_y("q", hi) - F.col("base")).alias("q1"),
    )
    d0, d1 = F.col("p0") - F.col("q0"), F.col("p1") - F.col("q1")
    m0, m1 = F.least("p0", "q0"), F.least("p1", "q1")
    t = d0 / (d0 - d1)
    yc = F.col("p0") + t * (F.col("p1") - F.col("p0"))
    mean = F.when(d0 * d1 < 0, ((m0 + yc) * t + (yc + m1) * (1 - t)) / 2).otherwise((m0 + m1) / 2)
    return heights.select(*keys, "reach", (F.col("s") * mean * (hi - lo)).alias("piece"))


def overlay_acres(left: DataFrame, right: DataFrame, keys: list[str], left_id: str, right_keep: list[str],
                  size: float, tolerance: float = TOLERANCE_M) -> DataFrame:
    """Acres of overlap per ``keys``, for keys that overlap at all.

    An overlap thinner than ``tolerance`` (in metres) along the common box is a shared border: polygons that
    touch on a long edge have a rounding error that grows with its length.
    """
    pieces = overlap_pieces(left, [left_id], right, right_keep, size)
    summed = pieces.groupBy(*keys).agg(F.sum("piece").alias("__sq_m"), F.max("reach").alias("__reach"))
    return summed.filter(F.col("__sq_m") > F.col("__reach") * tolerance).select(
        *keys, (F.col("__sq_m") / SQ_M_PER_ACRE).alias("acres")
    )


def largest_owner(owner_acres: DataFrame, left_id: str, owner: str) -> DataFrame:
    """Owner with the largest overlap per feature; the smallest label wins a tie."""
    # sums that agree to a tenth of a milliacre count as a tie
    rank = F.struct(-F.round("acres", 4), F.col(owner))
    return owner_acres.groupBy(left_id).agg(F.min_by(owner, rank).alias("__owner"))


def majority_owner(features: DataFrame, parcels: DataFrame, left_id: str, owner: str, size: float | None = None,
                   target: str = "LANDOWNER") -> DataFrame:
    """Set ``target`` to the owner with most overlap; features on no parcel keep their value.

    Without a ``size`` of the smallest cells the typical width of a parcel is taken.
    """
    size = typical_width(parcels) if size is None else size
    shares = overlay_acres(features, parcels, [left_id, owner], left_id, [owner], size)
    best = largest_owner(shares, left_id, owner).withColumnRenamed(left_id, "__id")
    old = F.col(target) if target in features.columns else F.lit(None).cast("string")
    joined = features.join(best, F.col(left_id) == F.col("__id"), "left")
    return joined.withColumn(target, F.coalesce(F.col("__owner"), old)).drop("__id", "__owner")
