"""Near-identical footprints: finding them, numbering their groups, and flattening them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from treatflow.functions.geometry import area, bounds, perimeter
from treatflow.operators.components import components
from treatflow.operators.dissolve import dissolve_shapes
from treatflow.session import BROADCAST_LIMIT_BYTES, broadcast_if_small, cut_lineage, estimated_bytes

HUBS = 8      # hubs that a block takes in its first round
SIDE = 5      # width of a block, in tolerances
# the hash first, so that sorting by block seldom compares more than that
BLOCK = ["block", "sig"]
CELLS = ["c0", "c1", "c2", "c3"]
CORNERS = ("xmin", "ymin", "xmax", "ymax")


def canonical(geom: str) -> Column:
    """Every ring started at its lowest vertex, so that equal rings are equal arrays."""
    placed = "transform(part, r -> named_struct('r', r, 'at', int(array_position(r, array_min(r)))))"
    turned = "if(p.at = 1, p.r, concat(slice(p.r, p.at, size(p.r)), slice(p.r, 1, p.at - 1)))"
    return F.expr(f"transform({geom}, part -> transform({placed}, p -> {turned}))")


def within_tolerance(a: str, b: str, tol: float) -> Column:
    """Each ring of ``a`` fits its ring of ``b`` vertex by vertex, from some start vertex.

    Both must have the same ring and vertex counts.
    """
    partner = "get(r.q, (i + k) % size(r.q))"
    near = f"hypot(get(r.p, i).x - {partner}.x, get(r.p, i).y - {partner}.y) <= {float(tol)!r}D"
    steps = "sequence(0, size(r.p) - 1)"
    pairs = f"zip_with(flatten({a}), flatten({b}), (p, q) -> named_struct('p', p, 'q', q))"
    return F.expr(f"forall({pairs}, r -> exists({steps}, k -> forall({steps}, i -> {near})))")


def _shape_rows(df: DataFrame, tol: float, keep: Sequence[str] = ()) -> DataFrame:
    """What a shape shares with a near-identical one: counts, and a box whose corners are within ``tol``.

    ``block`` is a hash of the counts and of the cells of the box's two corners, so of its place and its size.
    """
    rows = df.select(
        "id", F.expr("transform(geom, part -> transform(part, r -> size(r)))").alias("sig"), bounds("geom").alias("b"), "geom", *keep,
    )
    # none without a box, which has no neighbours
    return rows.withColumn("block", F.when(F.col("b.xmin").isNotNull() & F.col("b.ymin").isNotNull(), F.xxhash64("sig", *_cells(tol))))


def _counted_copies(footprints: DataFrame) -> DataFrame:
    """Every shape once, with the smallest ``id`` of its rows and their number ``n``.

    Hashes tell which shapes have copies; while these are few, only their polygons are shuffled.
    """
    keys = ["k1", "k2"]
    count = lambda df: df.groupBy(*keys, "geom").agg(F.min("oid").alias("id"), F.count(F.lit(1)).alias("n"))
    repeated = cut_lineage(footprints.groupBy(keys).count().filter("count > 1").select(keys))
    if estimated_bytes(repeated) > BROADCAST_LIMIT_BYTES:
        return count(footprints)
    alone = footprints.join(F.broadcast(repeated), keys, "left_anti").select(
        *keys, "geom", F.col("oid").alias("id"), F.lit(1).cast("bigint").alias("n")
    )
    return alone.unionByName(count(footprints.join(F.broadcast(repeated), keys, "left_semi")))


def _cells(tol: float) -> list[Column]:
    side = SIDE * tol * (1 + 1e-9)
    return [F.floor(F.col(f"b.{c}") / F.lit(side)) for c in CORNERS]


def _spread(nodes: DataFrame, tol: float, reach: int = 1) -> DataFrame:
    """The nodes, once for the cells ``c0`` to ``c3`` of every block with boxes within ``reach`` tolerances of theirs."""
    side, far = SIDE * tol * (1 + 1e-9), reach * tol * (1 + 1e-9)
    for cell, c in zip(CELLS, CORNERS):
        near = F.sequence(F.floor((F.col(f"b.{c}") - far) / F.lit(side)), F.floor((F.col(f"b.{c}") + far) / F.lit(side)))
        nodes = nodes.withColumn(cell, F.explode(near))
    return nodes


def _neighbours(nodes: DataFrame, tol: float, reach: int = 1) -> DataFrame:
    """The nodes, once for every block with boxes within ``reach`` tolerances of theirs."""
    spread = _spread(nodes.drop("block"), tol, reach).withColumn("block", F.xxhash64("sig", *CELLS))
    return spread.select(*BLOCK, *[F.col(c).alias(c + "2") for c in nodes.columns if c not in BLOCK])


def _boxes_within(tol: float) -> Column:
    near = [F.abs(F.col(f"b.{s}") - F.col(f"b2.{s}")) <= tol for s in ("xmin", "ymin", "xmax", "ymax")]
    return near[0] & near[1] & near[2] & near[3]


def _links(shapes: DataFrame, nodes: DataFrame, tol: float, blocks: DataFrame | None = None) -> DataFrame:
    """Linked (shape, node) pairs of different shapes that meet in the shape's block.

    ``blocks`` are those of the shapes, so that nodes far from them stay where they are.
    """
    near = _neighbours(nodes, tol)
    if blocks is not None:
        near = near.join(broadcast_if_small(blocks), BLOCK, "left_semi")
    met = shapes.join(near, BLOCK).filter((F.col("id") != F.col("id2")) & _boxes_within(tol))
    return met.filter(within_tolerance("geom", "geom2", tol)).select(
        F.col("id").alias("u"), F.col("id2").alias("v")
    )


def _near_boxes(shapes: DataFrame, tol: float) -> DataFrame:
    """Pairs of shapes (``id``, ``k1`` and ``id2``, ``k12``) whose boxes are within ``tol``, each pair once.

    No polygon moves.  Of two shapes in different blocks only the one with the higher cells comes to the other.
    """
    own = shapes.select("block", "id", "k1", "b")
    # a shape in its own block, or in a lower one
    cells, home = F.struct(*CELLS), F.struct(*[c.alias(n) for n, c in zip(CELLS, _cells(tol))])
    spread = _spread(shapes.select("sig", "id", "k1", "b"), tol).filter(cells <= home).select(
        F.xxhash64("sig", *CELLS).alias("block"), F.col("id").alias("id2"), F.col("k1").alias("k12"), F.col("b").alias("b2"),
        (cells == home).alias("at_home"),
    )
    met = own.join(spread, "block").filter(_boxes_within(tol))
    return met.filter((F.col("id") != F.col("id2")) & (~F.col("at_home") | (F.col("id") < F.col("id2")))).select(
        "id", "k1", "id2", "k12"
    )


def _links_of_few(shapes: DataFrame, tol: float) -> DataFrame:
    """Linked pairs, smaller id first, of shapes with few others in any block.

    Pairs are found on boxes alone; polygons are then brought to the pairs, so that none is copied to all blocks near it.
    """
    side = lambda a: shapes.select(*[F.col(c).alias(f"{c}_{a}") for c in ("id", "k1", "sig", "geom")])
    pairs = _near_boxes(shapes, tol).select(
        F.col("id").alias("id_p"), F.col("k1").alias("k1_p"), F.col("id2").alias("id_q"), F.col("k12").alias("k1_q")
    )
    met = pairs.join(side("p"), ["id_p", "k1_p"]).join(side("q"), ["id_q", "k1_q"])
    # different blocks may share a hash; inside coalesce, so that counts do not become a key of the join
    alike = F.coalesce(F.col("sig_p") == F.col("sig_q"), F.lit(False))
    return met.filter(alike & within_tolerance("geom_p", "geom_q", tol)).select(
        F.least("id_p", "id_q").alias("u"), F.greatest("id_p", "id_q").alias("v")
    )


def _crowded(shapes: DataFrame) -> DataFrame:
    return cut_lineage(shapes.groupBy(BLOCK).count().filter(F.col("count") > HUBS).select(BLOCK))


def _hubs(crowd: DataFrame, blocks: DataFrame, tol: float) -> tuple[DataFrame, DataFrame]:
    """(hubs, member links): shapes of crowded blocks that stand in for the others, and the others' links to them.

    A round takes up to ``HUBS`` shapes of every block, from where most shapes lie, and links the rest to the hubs within
    tolerance.  What is left goes to the next round, with twice as many hubs.  A block with no more shapes than that has
    hubs only and is done.  Shapes meet hubs only, never all others.
    """
    side = tol / 2
    snapped = F.expr(
        "transform(flatten(geom), r -> transform(r, v -> "
        f"named_struct('x', floor(v.x / {side!r}D), 'y', floor(v.y / {side!r}D))))"
    )
    rest = crowd.withColumn("fine", F.xxhash64(snapped))
    nodes, member_links, most = None, None, HUBS
    while not blocks.isEmpty():
        spots = rest.groupBy(*BLOCK, "fine").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
        chosen = spots.groupBy(*BLOCK, F.pmod(F.xxhash64("fine"), F.lit(most)).alias("part")).agg(
            F.min_by("first", F.struct(-F.col("n"), F.col("first"))).alias("id")
        )
        hubs = cut_lineage(rest.join(chosen.select("id"), "id", "left_semi").drop("fine"))
        links = cut_lineage(_links(rest.drop("fine"), hubs, tol))
        member_links = links if member_links is None else member_links.union(links)
        nodes = hubs if nodes is None else nodes.unionByName(hubs)
        placed = links.select(F.col("u").alias("id")).union(hubs.select("id")).distinct()
        rest = cut_lineage(rest.join(placed, "id", "left_anti"))
        # blocks with few shapes left leave the rounds
        blocks = _crowded(rest)
        nodes = nodes.unionByName(rest.join(blocks, BLOCK, "left_anti").drop("fine"))
        rest = rest.join(blocks, BLOCK, "left_semi")
        most *= 2
    return cut_lineage(nodes), member_links


def _links_between_balls(shapes: DataFrame, member_links: DataFrame, found: DataFrame, tol: float) -> DataFrame:
    """Links between members of two hubs that no hub shows.

    Two such members are within ``tol``, so each is within ``2 * tol`` of the other one's hub and the
    hubs are within ``3 * tol``; only hubs of different components are looked at.
    """
    named = found.select(F.col("u").alias("id"), "grp")
    hubs = shapes.join(member_links.select(F.col("v").alias("id")).distinct(), "id", "left_semi").join(named, "id")
    pairs = (
        hubs.join(_neighbours(hubs, tol, reach=3), BLOCK)
        .filter((F.col("grp") != F.col("grp2")) & _boxes_within(3 * tol))
        .select(F.col("id").alias("p"), F.col("id2").alias("q"), F.col("geom2").alias("geom_q"), F.col("b2"))
    )
    members = member_links.select(F.col("u").alias("id"), F.col("v").alias("p")).join(shapes, "id")
    edge_of_ball = (
        members.join(pairs, "p")
        .filter(_boxes_within(2 * tol))
        .filter(within_tolerance("geom", "geom_q", 2 * tol))
        .select("p", "q", "id", "geom", "b")
    )
    other = edge_of_ball.select(
        F.col("q").alias("p"), F.col("p").alias("q"), F.col("id").alias("id2"),
        F.col("geom").alias("geom2"), F.col("b").alias("b2"),
    )
    met = edge_of_ball.filter(F.col("p") < F.col("q")).join(other, ["p", "q"]).filter(_boxes_within(tol))
    return met.filter(within_tolerance("geom", "geom2", tol)).select(
        F.col("id").alias("u"), F.col("id2").alias("v")
    )


def near_identical(df: DataFrame, tol: float, oid: str = "oid", geom: str = "geom") -> DataFrame:
    """(``oid``, ``grp``) of footprints that have a near-identical one; ``grp`` is the smallest member id.

    Two shapes are near-identical when they have the same ring and vertex counts and some start vertex
    puts every vertex within ``tol`` of its partner; chains of such shapes are one group.

    Exact copies are counted down to one shape before anything is compared.  Shapes then meet by
    counts and by the cells of both corners of their box, which move by at most ``tol``.
    """
    footprints = (
        df.filter(F.col(geom).isNotNull())
        .select(F.col(oid).alias("oid"), canonical(geom).alias("geom"))
        .withColumns({"k1": F.xxhash64("geom"), "k2": F.xxhash64(F.lit(1), "geom")})
    )
    copies = cut_lineage(_shape_rows(_counted_copies(footprints), tol, ["k1", "k2", "n"]))
    # links name ids, so a shape without one has none
    shapes = copies.drop("k2", "n").filter(F.col("id").isNotNull())
    blocks = _crowded(shapes)
    # links are read several times by the rounds of components, so the comparison is computed once
    if blocks.isEmpty():
        found = components(cut_lineage(_links_of_few(shapes, tol)))
    else:
        few = shapes.join(blocks, BLOCK, "left_anti")
        crowd = cut_lineage(shapes.join(blocks, BLOCK, "left_semi"))
        hubs, member_links = _hubs(crowd, blocks, tol)
        member_links = cut_lineage(member_links)
        node_links = _links_of_few(few, tol).union(_links(crowd, few.unionByName(hubs), tol, blocks))
        links = cut_lineage(member_links.union(node_links).distinct())
        found = components(links.union(_links_between_balls(shapes, member_links, components(links), tol)))
    found = found.withColumnRenamed("u", "id")
    # the id of a shape without copies is its row's; only shapes with copies are looked up in all rows
    grouped = copies.filter("n = 1").select("id").join(found, "id").select(F.col("id").alias("oid"), "grp")
    several = cut_lineage(copies.filter("n > 1").select("k1", "k2", "id"))
    if not several.isEmpty():
        members = footprints.select("oid", "k1", "k2").join(broadcast_if_small(several), ["k1", "k2"])
        grp = F.coalesce(F.col("grp"), F.col("id"))
        named = members.join(found, "id", "left").select("oid", grp.alias("grp"))
        grouped = grouped.union(named).filter(F.col("grp").isNotNull())
    # read twice by those who join it, and narrow
    return cut_lineage(grouped)


def join_duplicates(df: DataFrame, groups: DataFrame, with_size: bool = False, oid: str = "oid") -> DataFrame:
    """``DuplID`` of every row, null when it stands alone; optionally the group's size.

    Null and not 0, because 0 may be a row's own id.
    """
    named = groups.select(F.col("oid").alias("__oid"), F.col("grp").alias("DuplID"))
    if with_size:
        sizes = named.groupBy("DuplID").agg(F.count(F.lit(1)).alias("DuplCount"))
        named = named.join(sizes, "DuplID")
    return df.join(named, F.col(oid) == F.col("__oid"), "left").drop("__oid")


def dense_number(df: DataFrame, key: str, name: str) -> DataFrame:
    """Number the values of ``key`` 1, 2, ... in their order; null keys get null.

    The distinct keys are range-partitioned and numbered per partition on top of the sizes of the
    partitions before it, so no task sees all keys.
    """
    keys = df.select(key).filter(F.col(key).isNotNull()).distinct()
    placed = cut_lineage(keys.repartitionByRange(key).withColumn("__part", F.spark_partition_id()))
    sizes = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition, so this global window and its broadcast are small by construction
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    within = Window.partitionBy("__part").orderBy(key)
    numbered = placed.join(F.broadcast(offsets), "__part").select(
        F.col(key).alias("__key"), (F.col("__before") + F.row_number().over(within)).alias(name)
    )
    # rows without a key would all go to one task, so they are dealt out by the one they come from
    dealt = F.when(F.col(key).isNull(), F.spark_partition_id()).otherwise(-1)
    keyed = df.withColumn("__dealt", F.struct(F.col(key).alias("key"), dealt.alias("part")))
    named = numbered.select(F.struct(F.col("__key").alias("key"), F.lit(-1).alias("part")).alias("__named"), name)
    # the hash first, so that sorting seldom compares more than that
    same = (F.xxhash64("__dealt") == F.xxhash64("__named")) & (F.col("__dealt") == F.col("__named"))
    return keyed.join(named, same, "left").drop("__dealt", "__named")


def dissolve_groups(df: DataFrame, fields: Sequence[str], dup: str = "DuplID") -> DataFrame:
    """``DISSOLVE_GRP``: number of the row's ``dup|fields`` key, as text; ``'None'`` when it stands alone."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in (dup, *fields)]
    keyed = df.withColumn("__dkey", F.when(F.col(dup).isNotNull(), F.concat_ws("|", *text)))
    numbered = dense_number(keyed, "__dkey", "__dno")
    return numbered.withColumn(
        "DISSOLVE_GRP", F.coalesce(F.col("__dno").cast("string"), F.lit("None"))
    ).drop("__dkey", "__dno")


def dissolve_statistics(df: DataFrame, by: Sequence[str], stats: Mapping[str, str], oid: str = "oid") -> DataFrame:
    """``max``, ``first`` and ``concatenate`` per group; plain column names, nulls left out.

    ``first`` is the value of the smallest id.  ``concatenate`` lists every distinct value once, in
    the order of its first id, joined by ``'; '``: the lists made from it drop repeats in any case, and
    a group with very many rows is counted down to its distinct values before it meets in one place.
    """
    plain = []
    for c, how in stats.items():
        if how == "max":
            plain.append(F.max(c).alias(c))
        elif how == "first":
            plain.append(F.min_by(c, F.when(F.col(c).isNotNull(), F.col(oid))).alias(c))
    out = df.groupBy(*by).agg(F.min(oid).alias(oid), F.count(F.lit(1)).alias("n_members"), *plain)
    listed = [c for c, how in stats.items() if how == "concatenate"]
    if not listed:
        return out
    # (group, column, value) with its first id; all listed columns in one pass
    pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in listed])
    values = (
        df.select(*by, oid, F.inline(pairs))
        .filter(F.col("v").isNotNull())
        .groupBy(*by, "c", "v")
        .agg(F.min(oid).alias("at"))
    )
    joined_values = lambda c: F.array_join(
        F.transform(
            F.array_sort(F.collect_list(F.when(F.col("c") == c, F.struct("at", "v")))), lambda s: s["v"]
        ), "; "
    )
    texts = values.groupBy(*by).agg(*[joined_values(c).alias(f"__t_{c}") for c in listed])
    match = None
    renamed = texts.withColumnsRenamed({k: f"__g_{k}" for k in by})
    for k in by:
        test = F.col(k).eqNullSafe(F.col(f"__g_{k}"))
        match = test if match is None else match & test
    merged = out.join(renamed, match, "left")
    return merged.select(
        *[c for c in out.columns],
        *[F.when(F.col(f"__t_{c}") != "", F.col(f"__t_{c}")).alias(c) for c in listed],
    )


def group_summary(df: DataFrame, group: str = "DISSOLVE_GRP") -> DataFrame:
    grouped = df.filter(F.col(group) != "None")
    return grouped.agg(F.countDistinct(group).alias("n_groups"), F.count(F.lit(1)).alias("n_members"))


def flatten(df: DataFrame, tol: float, fields: Sequence[str], stats: Mapping[str, str], oid: str = "oid",
            geom: str = "geom") -> DataFrame:
    """Dissolve near-identical footprints that agree in ``fields``; all other rows pass through.

    Adds ``area`` and ``perimeter`` of every footprint, the union's for dissolved ones.
    """
    # read several times below, so what leads up to it is computed once
    df = cut_lineage(df)
    groups = near_identical(df, tol, oid, geom)
    tagged = cut_lineage(dissolve_groups(join_duplicates(df, groups, oid=oid), fields))
    alone = tagged.filter(F.col("DISSOLVE_GRP") == "None").withColumns(
        {"area": area(geom), "perimeter": perimeter(geom)}
    )
    twins = tagged.filter(F.col("DISSOLVE_GRP") != "None")
    by = ["DuplID", *fields, "DISSOLVE_GRP"]
    attributes = dissolve_statistics(twins, by, stats, oid)
    shapes = dissolve_shapes(twins, "DISSOLVE_GRP", geom)
    dissolved = attributes.join(shapes, "DISSOLVE_GRP")
    return alone.unionByName(dissolved.drop("n_members"), allowMissingColumns=True)
