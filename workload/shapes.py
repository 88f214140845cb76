"""Queries over polygons: measures, overlay, near-identical footprints and dissolve.

The polygons are rectangles, so the oracle SQL has closed forms that share nothing with the operators.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from treatflow.fixed_values import MERGED_FIELDS
from treatflow.functions import geometry as geo
from treatflow.operators import filters, footprints, overlay, schema
from treatflow.operators.dissolve import dissolve_shapes
from treatflow.plans.flows import single_parts
from treatflow.session import cut_lineage
from workload.fixtures import oracle, view
from workload.registry import query

ACRE = 4046.8564224
CELL = 2700.0


@query("g1_area", oracle(f"SELECT oid, round(w * h / {ACRE}, 4) AS ACRES_GIS FROM footprints", "footprints"))
def g1_area(spark, sf):
    return view(spark, sf, "footprints").select("oid", F.round(geo.acres("geom"), 4).alias("ACRES_GIS"))


@query("g2_compactness", oracle("SELECT oid, round(2 * (w + h), 4) AS perimeter, round(w * h / (4 * (w + h) * (w + h)), 6) AS compactness FROM footprints", "footprints"))
def g2_compactness(spark, sf):
    df = view(spark, sf, "footprints").select("oid", geo.area("geom").alias("a"), geo.perimeter("geom").alias("p"))
    return df.select(
        "oid", F.round("p", 4).alias("perimeter"), F.round(geo.compactness(F.col("a"), F.col("p")), 6).alias("compactness")
    )


def two_parts(spark, sf):
    """Every footprint with a second part half its size, to its right."""
    second = geo.rectangle("x0 + 2 * w", "y0", "w / 2", "h / 2")
    return view(spark, sf, "footprints").select("oid", F.concat("geom", second).alias("geom"))


@query("g3_singlepart", oracle("""
    SELECT oid, round(w * h, 3) AS area FROM footprints UNION ALL SELECT oid, round(w * h / 4, 3) FROM footprints""", "footprints"))
def g3_singlepart(spark, sf):
    parts = single_parts(two_parts(spark, sf))
    oid = F.floor(F.col("oid") / 2147483648).cast("bigint")
    return parts.select(oid.alias("oid"), F.round(geo.area("geom"), 3).alias("area"))


@query("g4_repair", oracle("""
    SELECT oid, CAST(1 AS BIGINT) AS n_parts, CAST(CASE WHEN oid % 5 = 0 THEN 1 ELSE 2 END AS BIGINT) AS n_rings,
           CAST(CASE WHEN oid % 5 = 0 THEN 4 ELSE 8 END AS BIGINT) AS n_vertices,
           round(CASE WHEN oid % 5 = 0 THEN w * h ELSE w * h * 0.75 END, 3) AS area, true AS shell_first FROM footprints WHERE oid % 7 <> 0""", "footprints"))
def g4_repair(spark, sf):
    """Wrong directions, closing and repeated vertices, a flat part, a hole or a flat hole, and null shapes."""
    df = view(spark, sf, "footprints").withColumns(
        {"hole": geo.rectangle("x0 + w / 4", "y0 + h / 4", "w / 2", "IF(oid % 5 = 0, 0.0D, h / 2)"), "flat": geo.rectangle("x0", "y0", "w", "0")}
    )
    messy = F.expr(
        "IF(oid % 7 = 0, flat, concat(array(array("
        "concat(slice(reverse(geom[0][0]), 1, 2), slice(reverse(geom[0][0]), 2, 3), slice(reverse(geom[0][0]), 1, 1)), "
        "hole[0][0])), flat))"
    )
    fixed = filters.repaired(df.withColumn("geom", messy))
    return fixed.select(
        "oid", F.size("geom").cast("bigint").alias("n_parts"), F.expr("bigint(size(geom[0]))").alias("n_rings"),
        F.expr("bigint(size(flatten(flatten(geom))))").alias("n_vertices"), F.round(geo.area("geom"), 3).alias("area"),
        F.expr("geom[0][0][0].x < geom[0][0][1].x or geom[0][0][1].x < geom[0][0][2].x").alias("shell_first"),
    )


LON = "(-105.0 + (x0 - 550000) / 100000)"
LAT = "(39.0 + (y0 - 4400000) / 100000)"
E2 = "0.006694380022903415787"
EP2 = "0.006739496775481621889"


def snyder_sql():
    """Equations 8-9 and 8-10 in plain SQL on one longitude and latitude."""
    return f"""
    deg AS (SELECT oid, radians({LAT}) AS p, radians({LON} + 105.0) AS dl FROM footprints),
    t AS (SELECT oid, p, 6378137.0 / sqrt(1 - {E2} * sin(p) * sin(p)) AS n, tan(p) * tan(p) AS t, {EP2} * cos(p) * cos(p) AS c, dl * cos(p) AS a,
          6378137.0 * ((1 - {E2} / 4 - 3 * pow({E2}, 2) / 64 - 5 * pow({E2}, 3) / 256) * p - (3 * {E2} / 8 + 3 * pow({E2}, 2) / 32 + 45 * pow({E2}, 3) / 1024) * sin(2 * p)
             + (15 * pow({E2}, 2) / 256 + 45 * pow({E2}, 3) / 1024) * sin(4 * p) - 35 * pow({E2}, 3) / 3072 * sin(6 * p)) AS m FROM deg)
    SELECT oid, round(500000 + 0.9996 * n * (a + (1 - t + c) * pow(a, 3) / 6 + (5 - 18 * t + t * t + 72 * c - 58 * {EP2}) * pow(a, 5) / 120), 2) AS x,
           round(0.9996 * (m + n * tan(p) * (a * a / 2 + (5 - t + 9 * c + 4 * c * c) * pow(a, 4) / 24
             + (61 - 58 * t + t * t + 600 * c - 330 * {EP2}) * pow(a, 6) / 720)), 2) AS y FROM t"""


@query("g5_reproject", oracle("WITH " + snyder_sql(), "footprints"))
def g5_reproject(spark, sf):
    df = view(spark, sf, "footprints").withColumn("geom", geo.rectangle(LON, LAT, "0.01", "0.01")).withColumn("srid", F.lit(4269))
    first = df.select("oid", geo.reproject("geom", "srid").alias("g")).select("oid", F.expr("g[0][0][0]").alias("v"))
    return first.select("oid", F.round("v.x", 2).alias("x"), F.round("v.y", 2).alias("y"))


@query("g6_cells", oracle("""
    SELECT oid, cell_x, unnest(range(CAST(floor(y0 / 250) AS BIGINT), CAST(floor((y0 + h) / 250) AS BIGINT) + 1)) AS cell_y
    FROM (SELECT *, unnest(range(CAST(floor(x0 / 250) AS BIGINT), CAST(floor((x0 + w) / 250) AS BIGINT) + 1)) AS cell_x FROM footprints) t""", "footprints"))
def g6_cells(spark, sf):
    return overlay.grid_cells(view(spark, sf, "footprints"), "geom", 250.0).select("oid", "cell_x", "cell_y")


@query("f6_slivers", oracle(f"""
    SELECT oid FROM (SELECT oid, CASE WHEN oid % 11 <> 0 THEN w * h / 40000.0 / {ACRE} END AS ac, w / 200 * h / 200 AS a, 2 * (w / 200 + h / 200) AS p FROM footprints
        UNION ALL SELECT 1000000000 + oid, w * 0.5 / {ACRE}, w * 0.5, 2 * (w + 0.5) FROM footprints) t
    WHERE NOT (ac IS NULL OR ac <= 0.01 OR (ac < 0.05 AND a / (p * p) < 0.025))""", "footprints"))
def f6_slivers(spark, sf):
    """Small squares and long strips."""
    df = view(spark, sf, "footprints")
    small = df.select("oid", geo.rectangle("x0", "y0", "w / 200", "h / 200").alias("geom"))
    strips = df.select((F.col("oid") + 1000000000).alias("oid"), geo.rectangle("x0", "y0", "w", "0.5").alias("geom"))
    measured = small.union(strips).select("oid", geo.area("geom").alias("area"), geo.perimeter("geom").alias("perimeter"))
    acres = F.when((F.col("oid") % 11 != 0) | (F.col("oid") >= 1000000000), F.col("area") / ACRE)
    return filters.drop_slivers(measured.withColumn("acres", acres), "acres", "area", "perimeter").select("oid")


@query("p10_final", oracle(f"""
    SELECT 'NAME' AS PRJ_NAME, CAST(NULL AS VARCHAR) AS AGENCY, CAST(NULL AS VARCHAR) AS AGENCY_C, CAST(NULL AS VARCHAR) AS FUND_SOURCE,
           CAST(NULL AS VARCHAR) AS FUND_TYPE, CAST(NULL AS VARCHAR) AS PARTNERS, CAST(NULL AS VARCHAR) AS LANDOWNER, CAST(NULL AS VARCHAR) AS MGT_TYPE,
           activity_reclass AS ACTIVITY, CAST(oid AS INTEGER) AS TREE_COUNT, CAST(NULL AS VARCHAR) AS SPECIES, CAST(NULL AS VARCHAR) AS PRJ_OBJECT,
           CAST(1999 AS INTEGER) AS YEAR_COMP, w * h / {ACRE} AS ACRES_GIS, CAST(NULL AS DOUBLE) AS ACRES_MGT, CAST(NULL AS VARCHAR) AS NOTES,
           CAST(NULL AS VARCHAR) AS ORGFILE, DATE '2024-05-06' AS UPDATED, CAST(NULL AS VARCHAR) AS MODIFY_BY FROM footprints""".replace("w * h / 4046.8564224", "round(w * h / 4046.8564224, 4)"), "footprints"))
def p10_final(spark, sf):
    df = view(spark, sf, "footprints").select(
        F.lit("NAME").alias("prj_name"), F.col("activity_reclass").alias("Activity"), F.col("oid").alias("TREE_COUNT"),
        F.lit("1999").alias("YEAR_COMP"), F.lit("2024-05-06").alias("UPDATED"), F.round(geo.acres("geom"), 4).alias("ACRES_GIS"),
    )
    return schema.final_projection(schema.add_fields(df, MERGED_FIELDS), MERGED_FIELDS)


# --- overlay ----------------------------------------------------------------------

OVERLAP = """overlap AS (SELECT f.oid, p.parcel_id, p.owner,
        greatest(0, least(f.x0 + f.w, p.x0 + p.w) - greatest(f.x0, p.x0)) * greatest(0, least(f.y0 + f.h, p.y0 + p.h) - greatest(f.y0, p.y0)) / 4046.8564224 AS acres
    FROM footprints f JOIN parcels p ON f.x0 < p.x0 + p.w AND p.x0 < f.x0 + f.w AND f.y0 < p.y0 + p.h AND p.y0 < f.y0 + f.h)"""
SHARES = f"""{OVERLAP}, shares AS (SELECT oid, owner, sum(acres) AS acres FROM overlap GROUP BY oid, owner),
    best AS (SELECT oid, owner FROM (SELECT *, row_number() OVER (PARTITION BY oid ORDER BY round(acres, 4) DESC, owner) AS r FROM shares) x WHERE r = 1)"""


@query("j6_overlay", oracle(f"WITH {OVERLAP} SELECT oid, parcel_id, round(acres, 4) AS acres FROM overlap", "footprints", "parcels"))
def j6_overlay(spark, sf):
    pairs = overlay.overlay_acres(
        view(spark, sf, "footprints"), view(spark, sf, "parcels"), ["oid", "parcel_id"], "oid", ["parcel_id"], CELL
    )
    return pairs.withColumn("acres", F.round("acres", 4))


@query("a3_owner_acres", oracle(f"WITH {SHARES} SELECT oid, owner, round(acres, 4) AS acres FROM shares", "footprints", "parcels"))
def a3_owner_acres(spark, sf):
    shares = overlay.overlay_acres(
        view(spark, sf, "footprints"), view(spark, sf, "parcels"), ["oid", "owner"], "oid", ["owner"], CELL
    )
    return shares.withColumn("acres", F.round("acres", 4))


@query("j7_majority_owner", oracle(f"""WITH {SHARES}
    SELECT m.oid, coalesce(b.owner, m.LANDOWNER) AS LANDOWNER FROM merged m LEFT JOIN best b ON m.oid = b.oid""", "footprints", "parcels", "merged"))
def j7_majority_owner(spark, sf):
    owned = overlay.majority_owner(view(spark, sf, "merged"), view(spark, sf, "parcels"), "oid", "owner", CELL)
    return owned.select("oid", "LANDOWNER")


# --- near-identical footprints ------------------------------------------------------


def near_cte(tol):
    """Corner distances of every two rectangles that start near each other; smallest partner is the group.

    The fixture has no chains, so the smallest linked id is the group of all its members.
    """
    far = f"sqrt(greatest(pow(a.x0 - b.x0, 2), pow(a.x0 + a.w - b.x0 - b.w, 2)) + greatest(pow(a.y0 - b.y0, 2), pow(a.y0 + a.h - b.y0 - b.h, 2)))"
    return f"""cell AS (SELECT *, CAST(floor(x0 / 1000) AS BIGINT) AS cx, CAST(floor(y0 / 1000) AS BIGINT) AS cy FROM footprints),
    near AS (SELECT a.oid, min(b.oid) AS other FROM cell a JOIN cell b ON a.cy = b.cy AND b.cx = a.cx
             WHERE a.oid <> b.oid AND {far} <= {tol} GROUP BY a.oid),
    dups AS (SELECT oid, least(oid, other) AS grp FROM near)"""


@query("j8_near_identical", oracle(f"WITH {near_cte(100)} SELECT oid, grp FROM dups", "footprints"))
def j8_near_identical(spark, sf):
    return footprints.near_identical(view(spark, sf, "footprints"), 100.0)


@query("j5_dup_join", oracle(f"""
    WITH {near_cte(100)} SELECT f.oid, d.grp AS DuplID, CASE WHEN d.grp IS NOT NULL THEN count(*) OVER (PARTITION BY d.grp) END AS DuplCount
    FROM footprints f LEFT JOIN dups d ON f.oid = d.oid""", "footprints"))
def j5_dup_join(spark, sf):
    df = view(spark, sf, "footprints")
    joined = footprints.join_duplicates(df, footprints.near_identical(df, 100.0), with_size=True)
    return joined.select("oid", "DuplID", "DuplCount")


GROUPS = f"""{near_cte(100)},
    keyed AS (SELECT f.*, d.grp AS DuplID,
        CASE WHEN d.grp IS NOT NULL THEN d.grp || '|' || activity_reclass || '|' || CAST(DATE_COMPLETED AS VARCHAR) END AS dkey
        FROM footprints f LEFT JOIN dups d ON f.oid = d.oid),
    numbers AS (SELECT dkey, row_number() OVER (ORDER BY dkey) AS no FROM (SELECT DISTINCT dkey FROM keyed WHERE dkey IS NOT NULL) k),
    grouped AS (SELECT keyed.*, coalesce(CAST(no AS VARCHAR), 'None') AS DISSOLVE_GRP FROM keyed LEFT JOIN numbers ON keyed.dkey = numbers.dkey)"""


def grouped(spark, sf):
    df, fields = view(spark, sf, "footprints"), ["activity_reclass", "DATE_COMPLETED"]
    dups = footprints.join_duplicates(df.select("oid", *fields), footprints.near_identical(df, 100.0))
    # read for the keys and for their numbers
    return footprints.dissolve_groups(cut_lineage(dups), fields)


@query("w1_dissolve_group", oracle(f"WITH {GROUPS} SELECT oid, DISSOLVE_GRP FROM grouped", "footprints"))
def w1_dissolve_group(spark, sf):
    return grouped(spark, sf).select("oid", "DISSOLVE_GRP")


@query("a8_group_summary", oracle(f"""
    WITH {GROUPS} SELECT count(DISTINCT DISSOLVE_GRP) AS n_groups, count(*) AS n_members FROM grouped WHERE DISSOLVE_GRP <> 'None'""", "footprints"))
def a8_group_summary(spark, sf):
    return footprints.group_summary(grouped(spark, sf))


STATS = {"NBR_UNITS_ACCOMPLISHED": "max", "TREATMENT_NAME": "first", "FUND_CODE": "concatenate"}


def distinct_text(column, by):
    return f"(SELECT {by}, string_agg(v, '; ' ORDER BY pos) AS txt FROM (SELECT {by}, {column} AS v, min(oid) AS pos FROM {{source}} WHERE {column} IS NOT NULL GROUP BY {by}, {column}) d GROUP BY {by})"


@query("a5_dissolve_stats", oracle(f"""
    SELECT f.g, count(*) AS n_members, max(NBR_UNITS_ACCOMPLISHED) AS NBR_UNITS_ACCOMPLISHED,
           arg_min(TREATMENT_NAME, oid) AS TREATMENT_NAME, max(t.txt) AS FUND_CODE
    FROM footprints f LEFT JOIN {distinct_text('FUND_CODE', 'g').format(source='footprints')} t ON f.g = t.g GROUP BY f.g""", "footprints"))
def a5_dissolve_stats(spark, sf):
    return footprints.dissolve_statistics(view(spark, sf, "footprints", geometry=False), ["g"], STATS).drop("oid")


@query("a6_dissolve_area", oracle("""
    SELECT g, round(max(h) * (max(x0 + w) - min(x0)), 3) AS area, round(2 * (max(h) + max(x0 + w) - min(x0)), 3) AS perimeter,
           1 AS n_parts, 4 AS n_vertices, round(min(x0), 3) AS west, round(max(x0 + w), 3) AS east, round(min(y0), 3) AS south, round(max(y0 + h), 3) AS north
    FROM footprints GROUP BY g""", "footprints"))
def a6_dissolve_area(spark, sf):
    united = dissolve_shapes(view(spark, sf, "footprints"), "g").withColumn("b", geo.bounds("geom"))
    sides = {"west": "xmin", "east": "xmax", "south": "ymin", "north": "ymax"}
    return united.select(
        "g", F.round("area", 3).alias("area"), F.round(geo.perimeter("geom"), 3).alias("perimeter"), *shape_counts(),
        *[F.round(f"b.{c}", 3).alias(n) for n, c in sides.items()],
    )


def shape_counts():
    """Parts and vertices of ``geom``."""
    return F.size("geom").alias("n_parts"), F.size(F.flatten(F.flatten("geom"))).alias("n_vertices")


def arranged(df):
    """Up to four rectangles of each footprint's size: overlapping corners, a closed frame, or touching corners."""
    at = lambda x, y, w="w", h="h": geo.rectangle(f"x0 + {x} * w", f"y0 + {y} * h", w, h)
    frame = [at(0, 0, "4 * w"), at(0, 0, "w", "4 * h"), at(3, 0, "w", "4 * h"), at(0, 3, "4 * w")]
    kind = F.col("oid") % 3
    shapes = F.when(kind == 0, F.array(at(0, 0), at(0.5, 0.5))).when(kind == 1, F.array(*frame)).otherwise(F.array(at(0, 0), at(1, 1)))
    return df.select("oid", F.explode(shapes).alias("geom"))


@query("a6_dissolve_rings", oracle("""
    SELECT oid, round(CASE oid % 3 WHEN 0 THEN 1.75 WHEN 1 THEN 12 ELSE 2 END * w * h, 3) AS area,
           round(CASE oid % 3 WHEN 0 THEN 3 WHEN 1 THEN 12 ELSE 4 END * (w + h), 3) AS perimeter,
           CASE oid % 3 WHEN 2 THEN 2 ELSE 1 END AS n_parts, CASE oid % 3 WHEN 0 THEN 1 ELSE 2 END AS n_rings, 8 AS n_vertices FROM footprints""", "footprints"))
def a6_dissolve_rings(spark, sf):
    united = dissolve_shapes(arranged(view(spark, sf, "footprints")), "oid")
    return united.select(
        "oid", F.round(geo.area("geom"), 3).alias("area"), F.round(geo.perimeter("geom"), 3).alias("perimeter"),
        F.size("geom").alias("n_parts"), F.size(F.flatten("geom")).alias("n_rings"), F.size(F.flatten(F.flatten("geom"))).alias("n_vertices"),
    )


@query("u2_flatten", oracle(f"""
    WITH {GROUPS}
    SELECT oid, activity_reclass, DuplID, DISSOLVE_GRP, NBR_UNITS_ACCOMPLISHED, TREATMENT_NAME, FUND_CODE, round(w * h, 3) AS area, round(2 * (w + h), 3) AS perimeter,
           1 AS n_parts, 4 AS n_vertices
    FROM grouped WHERE DISSOLVE_GRP = 'None'
    UNION ALL
    SELECT min(oid), activity_reclass, DuplID, g.DISSOLVE_GRP, max(NBR_UNITS_ACCOMPLISHED), arg_min(TREATMENT_NAME, oid), max(t.txt),
           round(max(h) * (max(x0 + w) - min(x0)), 3), round(2 * (max(h) + max(x0 + w) - min(x0)), 3), 1, 4
    FROM grouped g LEFT JOIN {distinct_text('FUND_CODE', 'DISSOLVE_GRP').format(source='grouped')} t ON g.DISSOLVE_GRP = t.DISSOLVE_GRP
    WHERE g.DISSOLVE_GRP <> 'None' GROUP BY activity_reclass, DuplID, g.DISSOLVE_GRP""", "footprints"))
def u2_flatten(spark, sf):
    columns = ["oid", "activity_reclass", "DATE_COMPLETED", "NBR_UNITS_ACCOMPLISHED", "TREATMENT_NAME", "FUND_CODE", "geom"]
    flat = footprints.flatten(
        view(spark, sf, "footprints").select(columns), 100.0, ["activity_reclass", "DATE_COMPLETED"], STATS
    )
    return flat.select(
        "oid", "activity_reclass", "DuplID", "DISSOLVE_GRP", "NBR_UNITS_ACCOMPLISHED", "TREATMENT_NAME", "FUND_CODE",
        F.round("area", 3).alias("area"), F.round(geo.perimeter("geom"), 3).alias("perimeter"), *shape_counts(),
    )
