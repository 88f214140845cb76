"""Queries that run whole flows."""

from __future__ import annotations

from pyspark.sql import functions as F

from treatflow.operators import classify
from treatflow.operators.counts import StepCounts
from treatflow.plans import flows
from treatflow.sources.writers import write_routes
from workload.fixtures import oracle, values, view
from workload.lookups import FUNDS, RULES, TIER_1, TIER_2, TIER_3, TYPES
from workload.records import (
    FIRST, FUND_TYPE_CTE, LAST, MGT_SQL, SINGLE_SQL, STANDARD_A, STANDARD_B, TYPE_ROWS, cleaned_cte, key_sql, lookup,
    lookup_cte, scratch,
)
from workload.registry import query
from workload.shapes import ACRE, CELL, SHARES, shape_counts
from workload.texts import CLASSES, KEPT, LONG, NOTES_LONG, NOTES_WIDE, ROUTE, WIDE, classes_cte, classified

YEARS = (FIRST, LAST)
TYPED = values(TYPE_ROWS, "a", "k, act, mgt")


def year_sql(*dates):
    return "coalesce(" + ", ".join(f"CASE WHEN year({d}) >= {FIRST} THEN year({d}) END" for d in dates) + ")"


# --- crosswalk flow ---------------------------------------------------------------

STATE = "2-HIGH"
CROSSWALK_SQL = f"""
    WITH {lookup_cte(TIER_1, 't1', 'ACTIVITY', 'reclass')}, {lookup_cte(TIER_2, 't2', 'METHOD', 'reclass')},
    {lookup_cte(TIER_3, 't3', 'EQUIPMENT', 'reclass')},
    raw AS (SELECT *, {year_sql('DATE_COMPLETED', 'DATE_AWARDED')} AS y FROM ({STANDARD_A} UNION ALL {STANDARD_B}) s WHERE STATE_ABBR = '{STATE}'),
    two AS (SELECT r.*, CASE WHEN t1.reclass = 'SKIP' AND t2.hit THEN t2.reclass ELSE t1.reclass END AS l2 FROM raw r
            LEFT JOIN t1 ON {key_sql('r.ACTIVITY')} = t1.ACTIVITY LEFT JOIN t2 ON {key_sql('r.METHOD')} = t2.METHOD
            WHERE y BETWEEN {FIRST} AND {LAST}),
    three AS (SELECT two.*, CASE WHEN l2 = 'SKIP' AND t3.hit THEN t3.reclass ELSE l2 END AS label FROM two
              LEFT JOIN t3 ON {key_sql('two.EQUIPMENT')} = t3.EQUIPMENT),
    counted AS (SELECT ACTIVITY, label, count(*) AS n FROM three WHERE label <> 'SKIP' AND ACTIVITY <> '' GROUP BY ALL),
    majority AS (SELECT ACTIVITY, label AS best FROM counted QUALIFY row_number() OVER (PARTITION BY ACTIVITY ORDER BY n DESC, label) = 1),
    final AS (SELECT r.oid, r.ACTIVITY, r.DATE_COMPLETED, r.NBR_UNITS_ACCOMPLISHED, r.y, f.g, f.x0, f.w, f.h,
                     CASE WHEN label = 'SKIP' THEN coalesce(m.best, label) ELSE label END AS label,
                     CASE WHEN f.g % 2 = 0 THEN 'g' || f.g ELSE 'o' || f.oid END AS comp
              FROM three r JOIN footprints f ON r.orderkey = f.oid LEFT JOIN majority m ON r.ACTIVITY = m.ACTIVITY),
    kept AS (SELECT *, count(*) OVER (PARTITION BY comp) AS members FROM final WHERE label <> 'EXCLUDE'),
    flat AS (SELECT min(oid) AS SourceOID, arg_min(y, oid) AS y, label, max(NBR_UNITS_ACCOMPLISHED) AS units,
                    max(h) * (max(x0 + w) - min(x0)) AS area
             FROM kept GROUP BY label, CASE WHEN members = 1 THEN 'alone' || oid ELSE comp || coalesce(CAST(DATE_COMPLETED AS VARCHAR), '') END)
    SELECT SourceOID, CAST(y AS INTEGER) AS YEAR_COMP, a.act AS known_activity, a.mgt AS MGT_TYPE, round(area / {ACRE}, 4) AS ACRES_GIS,
           round(CASE WHEN units IS NULL OR units = 0 THEN area * 0.000247105 ELSE least(units, area * 0.000247105) END, 4) AS ACRES_MGT,
           'US Forest Service' AS AGENCY, DATE '2024-05-06' AS UPDATED, label = 'SKIP' AS UNRESOLVED, 1 AS n_parts, 4 AS n_vertices
    FROM flat LEFT JOIN {TYPED} ON flat.label = a.k"""


@query("l1_crosswalk_flow", oracle(CROSSWALK_SQL, "layer_a", "layer_b", "footprints"))
def l1_crosswalk_flow(spark, sf):
    layers = {n: view(spark, sf, f"placed_{n}") for n in ("a", "b")}
    files = {n: f"https://host/Actv_{n}.gdb.zip" for n in layers}
    tiers = [
        (lookup(spark, TIER_1, "ACTIVITY", "reclass"), "ACTIVITY", "reclass", "ACTIVITY"),
        (lookup(spark, TIER_2, "METHOD", "reclass"), "METHOD", "reclass", "METHOD"),
        (lookup(spark, TIER_3, "EQUIPMENT", "reclass"), "EQUIPMENT", "reclass", "EQUIPMENT"),
    ]
    funds = lookup(spark, FUNDS, "fund_code", "fund_source", "fund_type")
    out = flows.crosswalk_flow(layers, files, STATE, tiers, funds, "2024-05-06", "builder", YEARS)
    known = F.when(F.col("MGT_TYPE").isNotNull(), F.col("ACTIVITY"))
    return out.select(
        "SourceOID", "YEAR_COMP", known.alias("known_activity"), "MGT_TYPE", F.round("ACRES_GIS", 4).alias("ACRES_GIS"),
        F.round("ACRES_MGT", 4).alias("ACRES_MGT"), "AGENCY", "UPDATED", "UNRESOLVED", *shape_counts(),
    )


# --- keyword flows -------------------------------------------------------------------

SERVICE_TEXT = "trim(concat_ws(' ', nullif(Name, ''), nullif(Notes, ''), nullif(ACT_CSV, '')))"
SERVICE_CTES = f"""{lookup_cte(TYPES, 'ty', 'Type', 'Category', 'SubType', 'reclass')},
    coded AS (SELECT s.*, s.ID AS oid, CASE WHEN y.hit THEN y.reclass END AS ACT_CSV, {year_sql('CompletionDate', 'InitiationDate')} AS yr
              FROM service s LEFT JOIN ty y ON {key_sql('s.Type')} = y.Type AND {key_sql('s.Category')} = y.Category AND {key_sql('s.SubType')} = y.SubType
              WHERE State = 'Colorado' AND Class = 'Actual Treatment'),
    src AS (SELECT *, {SERVICE_TEXT} AS txt FROM coded WHERE yr BETWEEN {FIRST} AND {LAST}),
    {classes_cte('src', 'txt', 'oid')}, {WIDE.format(source='src')}, {LONG.format(source='src')}"""
SERVICE_KEPT = """
    kept AS (SELECT l.* FROM long l JOIN wide w ON l.oid = w.oid JOIN src s ON s.oid = l.oid
        WHERE NOT (l.activity_reclass = 'DELETE' AND len(list_filter([ActClass_1, ActClass_2, ActClass_3, ACT_CSV],
            lambda v: v IS NOT NULL AND trim(v) NOT IN ('', 'None', 'DELETE', 'UNCLASSIFIED', 'Null'))) > 0))"""
SERVICE_SQL = f"""
    WITH {SERVICE_CTES}, {SERVICE_KEPT},
    {cleaned_cte('src', 'Name', 'n1', 'nm')}, {cleaned_cte('n1', 'FundingSource', 'n2', 'fs')}
    SELECT s.oid AS SourceOID, CAST(s.yr AS INTEGER) AS YEAR_COMP, k.activity_reclass, k.Keyword, {ROUTE} AS route,
           a.act AS ACTIVITY, a.mgt AS MGT_TYPE, array_to_string(s.nm, '; ') AS PRJ_NAME, array_to_string(s.fs, '; ') AS FUND_SOURCE,
           s.FundingAgency AS AGENCY_C, round(s.w * s.h / {ACRE}, 4) AS ACRES_GIS
    FROM kept k JOIN n2 s ON k.oid = s.oid LEFT JOIN {TYPED} ON k.activity_reclass = a.k"""


@query("l2_keyword_flow", oracle(SERVICE_SQL, "service"))
def l2_keyword_flow(spark, sf):
    types = lookup(spark, TYPES, "Type", "Category", "SubType", "reclass")
    out = flows.keyword_flow(service_rows(spark, sf), types, RULES, YEARS)
    return out.select(
        "SourceOID", "YEAR_COMP", "activity_reclass", F.when(F.col("Keyword") != "None", F.col("Keyword")).alias("Keyword"), "route",
        "ACTIVITY", "MGT_TYPE", "PRJ_NAME", "FUND_SOURCE", "AGENCY_C", F.round("ACRES_GIS", 4).alias("ACRES_GIS"),
    )


def service_rows(spark, sf):
    service = view(spark, sf, "service")
    return service.filter((F.col("State") == "Colorado") & (F.col("Class") == "Actual Treatment"))


@query("l2_trust_crosswalk", oracle(f"""
    WITH {SERVICE_CTES}, trusted AS (SELECT l.oid, CASE WHEN w.ActClass_1 = 'UNCLASSIFIED' AND coalesce(s.ACT_CSV, '') <> '' THEN s.ACT_CSV ELSE l.activity_reclass END AS label
        FROM long l JOIN wide w ON l.oid = w.oid JOIN src s ON s.oid = l.oid),
    kept AS (SELECT t.oid, t.label AS activity_reclass FROM trusted t JOIN wide w ON t.oid = w.oid JOIN src s ON s.oid = t.oid
        WHERE NOT (t.label = 'DELETE' AND len(list_filter([ActClass_2, ActClass_3, CASE WHEN ActClass_1 = 'UNCLASSIFIED' THEN NULL ELSE ActClass_1 END, ACT_CSV],
            lambda v: v IS NOT NULL AND trim(v) NOT IN ('', 'None', 'DELETE', 'UNCLASSIFIED', 'Null'))) > 0))
    SELECT oid AS SourceOID, activity_reclass, {ROUTE} AS route FROM kept""", "service"))
def l2_trust_crosswalk(spark, sf):
    types = lookup(spark, TYPES, "Type", "Category", "SubType", "reclass")
    out = flows.keyword_flow(service_rows(spark, sf), types, RULES, YEARS, trust_crosswalk=True)
    return out.select("SourceOID", "activity_reclass", "route")


@query("a7_step_counts", oracle(f"""
    WITH {SERVICE_CTES}, {SERVICE_KEPT}, routed AS (SELECT {ROUTE} AS route FROM kept)
    SELECT CAST(1 AS INTEGER) AS step_no, 'source' AS step, (SELECT count(*) FROM coded) AS n_rows
    UNION ALL SELECT 2, 'in years', (SELECT count(*) FROM src) UNION ALL SELECT 3, 'deleted', (SELECT count(*) FROM routed WHERE route = 'deleted')
    UNION ALL SELECT 4, 'review', (SELECT count(*) FROM routed WHERE route = 'review')
    UNION ALL SELECT 5, 'classified', (SELECT count(*) FROM routed WHERE route = 'classified')""", "service"))
def a7_step_counts(spark, sf):
    """The counts of a flow's steps, from its one write."""
    counts = StepCounts()
    types = lookup(spark, TYPES, "Type", "Category", "SubType", "reclass")
    write_routes(flows.keyword_flow(service_rows(spark, sf), types, RULES, YEARS, counts=counts), scratch(spark, "routes"))
    return counts.table(spark)


ROUTED = f"routed AS (SELECT oid, activity_reclass AS label, Keyword, {ROUTE} AS route FROM kept)"
FIXED = """fixed AS (SELECT oid, Keyword, CASE WHEN c THEN CASE WHEN oid % 9 = 0 THEN 'DELETE' ELSE 'Plant Trees' END ELSE label END AS activity_reclass,
        CASE WHEN c THEN CASE WHEN oid % 9 = 0 THEN 'deleted' ELSE 'classified' END ELSE route END AS route
        FROM (SELECT *, route = 'review' AND oid % 3 = 0 AND coalesce(Keyword, '') = 'plate' AS c FROM routed) r)"""


def corrections(df):
    """A reviewer's table: some of the records of one review keyword get their label, each at the second try."""
    ninth = F.array(F.lit("Plant Trees"), F.lit("DELETE"))
    labels = F.when(F.col("oid") % 9 == 0, ninth).otherwise(F.array(F.lit("Manual"), F.lit("Plant Trees")))
    chosen = df.filter(F.col("oid") % 3 == 0)
    return chosen.select("oid", F.lit("plate").alias("Keyword"), F.posexplode(labels).alias("line_no", "activity_reclass"))


@query("l3_review_flow", oracle(f"""
    WITH {CLASSES}, {NOTES_WIDE}, {NOTES_LONG}, {KEPT}, {ROUTED}, {FIXED}
    SELECT f.oid AS SourceOID, CAST(year(n.started) AS INTEGER) AS YEAR_COMP, f.activity_reclass, f.route, a.act AS ACTIVITY, a.mgt AS MGT_TYPE,
           round(n.reported_acres, 6) AS ACRES_MGT, 'BLM' AS AGENCY_C
    FROM fixed f JOIN notes n ON f.oid = n.oid LEFT JOIN {TYPED} ON f.activity_reclass = a.k
    WHERE year(n.started) BETWEEN {FIRST} AND {LAST}""", "notes"))
def l3_review_flow(spark, sf):
    notes = view(spark, sf, "notes").withColumnsRenamed(
        {"name": "TRTMNT_NM", "comments": "TRTMNT_COMMENTS", "started": "TRTMNT_START_DT", "reported_acres": "BLM_ACRES"}
    )
    out = flows.review_flow(notes, ["TRTMNT_START_DT"], RULES, YEARS, corrections(notes))
    return out.select(
        "SourceOID", "YEAR_COMP", "activity_reclass", "route", "ACTIVITY", "MGT_TYPE",
        F.round("ACRES_MGT", 6).alias("ACRES_MGT"), "AGENCY_C",
    )


@query("l6_review_merge", oracle(f"""
    WITH {CLASSES}, {NOTES_WIDE}, {NOTES_LONG}, {KEPT}, {ROUTED}, {FIXED} SELECT oid, activity_reclass, route FROM fixed""", "notes"))
def l6_review_merge(spark, sf):
    routed = classify.split_routes(classified(spark, sf))
    merged = flows.review_merge(routed, corrections(view(spark, sf, "notes")), ["oid", "Keyword"])
    return merged.select("oid", "activity_reclass", "route")


# --- older record ----------------------------------------------------------------------


@query("l4_unit_flow", oracle(f"""
    WITH tagged AS (SELECT *, count(*) OVER (PARTITION BY CASE WHEN g % 2 = 0 THEN 'g' || g ELSE 'o' || oid END) AS members FROM units),
    keyed AS (SELECT *, CASE WHEN members = 1 THEN 'o' || oid ELSE 'g' || g || ActClass || CAST(COMPLETED1 AS VARCHAR) END AS grp FROM tagged),
    funds AS (SELECT grp, string_agg(FUNDING_SO, ', ' ORDER BY pos) AS txt FROM
              (SELECT grp, FUNDING_SO, min(oid) AS pos FROM keyed WHERE FUNDING_SO IS NOT NULL GROUP BY grp, FUNDING_SO) d GROUP BY grp),
    flat AS (SELECT grp, min(oid) AS oid, max(COMPLETED_) AS amount, arg_min(UNIT_OF_ME, oid) AS unit, arg_min(NAME_REDACT, oid) AS nm,
                    min(ActClass) AS act, min(COMPLETED1) AS done, max(h) * (max(x0 + w) - min(x0)) / {ACRE} AS gis FROM keyed GROUP BY grp)
    SELECT oid AS SourceOID, nm AS PRJ_NAME, txt AS FUNDING, CASE WHEN act = 'Manual' THEN 'Manual' ELSE '' END AS CANOPY_MGT,
           CASE WHEN act = 'Removal' THEN 'Removal' ELSE '' END AS SURF_MGT, CASE WHEN act = 'Manual' THEN 'CANOPY' ELSE 'SURFACE' END AS MGT_TYPE,
           CAST(CASE WHEN year(done) >= {FIRST} THEN year(done) END AS INTEGER) AS YEAR_COMP, round(gis, 4) AS ACRES_GIS,
           round(CASE WHEN lower(unit) = 'acres' AND amount <> 0 AND amount <= gis THEN amount ELSE gis END, 6) AS ACRES_MGT,
           'GEOTRACKS_' || coalesce(CAST(CASE WHEN year(done) >= {FIRST} THEN year(done) END AS VARCHAR), 'None') || '_Completed_ForestManagementTreatment' AS ORGFILE
    FROM flat LEFT JOIN funds ON flat.grp = funds.grp""", "units"))
def l4_unit_flow(spark, sf):
    out = flows.unit_flow(view(spark, sf, "units"), "2024-05-06", "builder", FIRST)
    return out.select(
        "SourceOID", "PRJ_NAME", "FUNDING", "CANOPY_MGT", "SURF_MGT", "MGT_TYPE", "YEAR_COMP",
        F.round("ACRES_GIS", 4).alias("ACRES_GIS"), F.round("ACRES_MGT", 6).alias("ACRES_MGT"), "ORGFILE",
    )


# --- merge -----------------------------------------------------------------------------


@query("l5_merge_qa", oracle(f"""
    WITH {SHARES}, {FUND_TYPE_CTE}
    SELECT s.oid, coalesce(b.owner, s.LANDOWNER, '') AS LANDOWNER, coalesce(s.mgt, '') AS MGT_TYPE, s.ACTIVITY, f.FUND_SOURCE, f.FUND_TYPE, s.YEAR_COMP,
           round(s.w * s.h / {ACRE}, 4) AS ACRES_GIS,
           row_number() OVER (ORDER BY s.oid % 2, s.oid) AS ORGID,
           CASE WHEN s.YEAR_COMP NOT BETWEEN 2000 AND 2024 THEN 'YEAR FLAG' WHEN f.fund_flag THEN 'FUND_FLAG'
                WHEN coalesce(s.activity_error, true) THEN 'ACTIVITY ERROR' WHEN coalesce(s.MGT_TYPE, '') = '' THEN 'NO MGT_TYPE' ELSE '' END AS ERROR_FLAG
    FROM (SELECT *, {MGT_SQL} AS mgt FROM (SELECT *, replace(lower(MGT_TYPE), ' ', '') AS t FROM ({SINGLE_SQL}) x) y) s
    JOIN funded f ON s.oid = f.oid LEFT JOIN best b ON s.oid = b.oid""", "merged", "parcels", "codes"))
def l5_merge_qa(spark, sf):
    merged = view(spark, sf, "merged")
    # two tables that number their rows alike: ``record`` tells rows apart, ``oid`` does not
    numbered = merged.withColumnRenamed("oid", "record").withColumn("oid", F.floor(F.col("record") / 2))
    layers = [
        numbered.filter(F.col("record") % 2 == 0),
        numbered.filter(F.col("record") % 2 == 1).withColumnRenamed("REFOR_MGT", "REFOREST"),
    ]
    funds = lookup(spark, FUNDS, "fund_code", "fund_source", "fund_type")
    out = flows.merge_qa(layers, view(spark, sf, "parcels"), "owner", funds, CELL, ["record"])
    return out.select(
        F.col("record").alias("oid"), "LANDOWNER", "MGT_TYPE", "ACTIVITY", "FUND_SOURCE", "FUND_TYPE", "YEAR_COMP",
        F.round("ACRES_GIS", 4).alias("ACRES_GIS"), "ERROR_FLAG", "ORGID",
    )
