"""Queries over attributes: sources, columns, filters, lookups, lists, dates and acres."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from treatflow.fixed_values import ACTIVITY_MAP, TARGET_FIELDS
from treatflow.functions import acres, dates, lists, text
from treatflow.functions import geometry as geo
from treatflow.operators import crosswalk as cw
from treatflow.operators import filters, funding, schema
from treatflow.operators import qa
from treatflow.plans.flows import prepare_dates
from treatflow.session import shared_folder, small_table
from treatflow.sources import readers, writers
from workload.fixtures import oracle, values, view
from workload.lookups import FUNDS, TIER_1, TIER_2, TIER_3, TYPES, with_line_no
from workload.registry import query

FIRST, LAST = 1996, 2000


def lookup(spark, rows, *columns):
    return small_table(spark, with_line_no(rows), [*columns, "line_no"])


# --- sources --------------------------------------------------------------------


@query("s1_load_layers", """
    SELECT layer, count(*) AS n, round(sum(acctbal), 2) AS total FROM (
        SELECT 'customer' AS layer, c_acctbal AS acctbal FROM customer
        UNION ALL SELECT 'supplier', s_acctbal FROM supplier) t GROUP BY layer""")
def s1_load_layers(spark, sf):
    paths = {n: f"{sf}/{n}.parquet" for n in ("customer", "no_such_layer", "supplier")}
    merged = readers.merge_layers(list(readers.load_layers(spark, paths).values()))
    balance = F.coalesce("c_acctbal", "s_acctbal")
    return merged.groupBy("layer").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(balance), 2).alias("total"))


@query("s2_read_where", """
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'""")
def s2_read_where(spark, sf):
    test = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    return readers.read_where(spark, f"{sf}/orders.parquet", test, ["o_orderkey", "o_totalprice"])


def scratch(spark, name):
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


LAYER_COLUMNS = "oid, ACTIVITY, METHOD, STATE_ABBR, DATE_COMPLETED, NBR_UNITS_ACCOMPLISHED"


@query("s4_write_layer", oracle(f"SELECT {LAYER_COLUMNS}, (SELECT count(*) FROM layer_b) AS written FROM layer_b", "layer_b"))
def s4_write_layer(spark, sf):
    """A staged layer, written twice over, is there once."""
    layer, path = view(spark, sf, "layer_b").select(*LAYER_COLUMNS.split(", ")), scratch(spark, "staged")
    writers.write_layer(layer.limit(5), path)
    n = writers.write_layer(layer, path)
    return spark.read.parquet(path).withColumn("written", F.lit(n))


@query("s5_archive_layers", oracle("""
    SELECT 'a' AS layer, oid, ACTIVITY, STATE_ABBR FROM layer_a WHERE oid % 2 = 0 UNION ALL SELECT 'b', oid, ACTIVITY, STATE_ABBR FROM layer_b""", "layer_a", "layer_b"))
def s5_archive_layers(spark, sf):
    """A second run of one layer replaces its folder and leaves the other one."""
    path = scratch(spark, "archive")
    tagged = {n: view(spark, sf, f"layer_{n}").select("oid", "ACTIVITY", "STATE_ABBR").withColumn("layer", F.lit(n)) for n in ("a", "b")}
    writers.archive_layers(readers.merge_layers(list(tagged.values())), path)
    writers.archive_layers(tagged["a"].filter(F.col("oid") % 2 == 0), path)
    return spark.read.parquet(path).select("layer", "oid", "ACTIVITY", "STATE_ABBR")


@query("s6_qa_csv", oracle("""
    SELECT CAST(oid AS VARCHAR) AS oid, ACTIVITY, AU_NAME, printf('[[[{"x":%d.0,"y":0.0}]]]', oid % 7) AS geom FROM layer_b""", "layer_b"))
def s6_qa_csv(spark, sf):
    """The review table with a polygon as JSON text, read back."""
    vertex = F.struct((F.col("oid") % 7).cast("double").alias("x"), F.lit(0.0).alias("y"))
    layer = view(spark, sf, "layer_b").select("oid", "ACTIVITY", "AU_NAME", F.array(F.array(F.array(vertex))).alias("geom"))
    path = scratch(spark, "qa")
    writers.write_qa_csv(layer, path)
    return spark.read.option("header", True).option("quote", '"').option("escape", '"').csv(path)


@query("s7_union_workspace", oracle("""
    SELECT 'a' AS layer, oid, NAME, CAST(NULL AS VARCHAR) AS AU_NAME, CAST(NULL AS DOUBLE) AS ACRES FROM layer_a
    UNION ALL SELECT 'b', oid, NULL, AU_NAME, NULL FROM layer_b""", "layer_a", "layer_b"))
def s7_union_workspace(spark, sf):
    """Two layers of a workspace and one that is not there, under a contract with a field that none has."""
    folder = scratch(spark, "workspace")
    for n in ("a", "b"):
        writers.write_layer(view(spark, sf, f"layer_{n}"), f"{folder}/{n}")
    contract = {"oid": "bigint", "NAME": "string", "AU_NAME": "string", "ACRES": "double"}
    merged = readers.union_workspace(spark, {n: f"{folder}/{n}" for n in ("a", "b", "none")}, contract)
    return merged.select("layer", *contract)


@query("s9_geojson", oracle("""
    SELECT CAST(oid AS VARCHAR) AS oid, TREATMENT_NAME AS name, round(w * h, 3) AS area, round(2 * (w + h), 3) AS perimeter FROM footprints""", "footprints"))
def s9_geojson(spark, sf):
    """Footprints written as GeoJSON lines with closed rings, and read back."""
    corner = lambda x, y: f"array({x}, {y})"
    ring = f"array({corner('x0', 'y0')}, {corner('x0 + w', 'y0')}, {corner('x0 + w', 'y0 + h')}, {corner('x0', 'y0 + h')}, {corner('x0', 'y0')})"
    feature = ("to_json(named_struct('type', 'Feature', 'properties', map('oid', string(oid), 'name', TREATMENT_NAME), "
               f"'geometry', named_struct('type', 'Polygon', 'coordinates', array({ring}))), map('ignoreNullFields', 'false'))")
    path = scratch(spark, "geojson")
    view(spark, sf, "footprints", geometry=False).select(F.expr(feature).alias("value")).write.text(path)
    read = readers.read_geojson(spark, path).withColumns({"area": geo.area("geom"), "perimeter": geo.perimeter("geom")})
    return read.select(F.col("properties")["oid"].alias("oid"), F.col("properties")["name"].alias("name"),
                       F.round("area", 3).alias("area"), F.round("perimeter", 3).alias("perimeter"))


@query("s3_lookup_profile", """
    SELECT p_type, count(*) AS n_keys, sum(CASE WHEN label = '' THEN 1 ELSE 0 END)::BIGINT AS n_blank,
           max(label) AS last_label
    FROM (SELECT DISTINCT p_type, p_brand,
                 CASE WHEN p_brand = 'Brand#1' THEN '' ELSE 'a "' || p_brand || '", ' || p_type END AS label FROM part) t
    GROUP BY p_type""")
def s3_lookup_profile(spark, sf):
    label = F.when(F.col("p_brand") != "Brand#1", F.concat(F.lit('a "'), "p_brand", F.lit('", '), "p_type"))
    keys = view(spark, sf, "part").select("p_type", "p_brand", label.alias("label")).distinct()
    path = f"{shared_folder(spark)}/lookup-{uuid.uuid4().hex}"
    keys.write.option("header", True).option("escape", '"').csv(path)
    table = readers.read_lookup(spark, path)
    return table.groupBy("p_type").agg(
        F.count(F.lit(1)).alias("n_keys"), F.count(F.when(F.col("label") == "", 1)).alias("n_blank"),
        F.max("label").alias("last_label"),
    )


# --- columns --------------------------------------------------------------------


@query("p1_add_fields", oracle("""
    SELECT oid, activity, CAST(NULL AS INTEGER) AS YEAR_COMP, CAST(NULL AS DOUBLE) AS ACRES_GIS,
           CAST(NULL AS VARCHAR) AS NOTES FROM treatments""", "treatments"))
def p1_add_fields(spark, sf):
    fields = {n: TARGET_FIELDS[n] for n in ("ACTIVITY", "YEAR_COMP", "ACRES_GIS", "NOTES")}
    return schema.add_fields(view(spark, sf, "treatments").select("oid", "activity"), fields)


@query("p2_prune", oracle("SELECT oid, activity, NOTES, shape_len FROM (SELECT oid, activity, equipment AS NOTES, gis_acres AS shape_len FROM treatments) t", "treatments"))
def p2_prune(spark, sf):
    df = view(spark, sf, "treatments").withColumns({"NOTES": F.col("equipment"), "shape_len": F.col("gis_acres")})
    return schema.prune_to(df, list(TARGET_FIELDS))


@query("p3_keep_fields", oracle("SELECT oid, NBR_UNITS_ACCOMPLISHED, DATE_AWARDED, METHOD FROM layer_b", "layer_b"))
def p3_keep_fields(spark, sf):
    return schema.keep_fields(view(spark, sf, "layer_b"), ["NBR_UNITS_ACCOMPLISHED", "METHOD"], ["DATE_AWARDED", "au_name"])


def value_or_null(c):
    return f"CASE WHEN lower(trim({c})) NOT IN ('', 'none') THEN trim({c}) END"


STANDARD_A = f"""
    SELECT oid, coalesce({value_or_null('NAME')}, {value_or_null('TREATMENT_NAME')}, 'Unknown') AS TREATMENT_NAME,
           coalesce({value_or_null('NEPA_DOC_NAME')}, '') AS NEPA_DOC_NAME,
           coalesce({value_or_null('ACTIVITY_NAME')}, '') AS ACTIVITY,
           coalesce({value_or_null('METHOD_DESC')}, '') AS METHOD, coalesce({value_or_null('EQUIPMENT_DESC')}, '') AS EQUIPMENT,
           coalesce({value_or_null('FUND_CODES')}, 'No Funding Code') AS FUND_CODE,
           STATE_ABBR, DATE_COMPLETED, DATE_AWARDED, NBR_UNITS_ACCOMPLISHED, gis_acres, orderkey, 'a' AS layer FROM layer_a"""
STANDARD_B = f"""
    SELECT oid, coalesce({value_or_null('AU_NAME')}, {value_or_null('SUBUNIT_NAME')}, 'Unknown') AS TREATMENT_NAME,
           coalesce({value_or_null('NEPA_PROJECT_NAME')}, '') AS NEPA_DOC_NAME,
           coalesce({value_or_null('ACTIVITY')}, '') AS ACTIVITY,
           coalesce({value_or_null('METHOD')}, '') AS METHOD, '' AS EQUIPMENT, 'No Funding Code' AS FUND_CODE,
           STATE_ABBR, DATE_COMPLETED, DATE_AWARDED, NBR_UNITS_ACCOMPLISHED, gis_acres, orderkey, 'b' AS layer FROM layer_b"""


def standardized_layers(spark, sf):
    return [
        schema.standardize(view(spark, sf, f"layer_{n}")).withColumn("layer", F.lit(n)) for n in ("a", "b")
    ]


@query("p4_standardize", oracle(f"{STANDARD_A} UNION ALL {STANDARD_B}", "layer_a", "layer_b"))
def p4_standardize(spark, sf):
    return readers.merge_layers(standardized_layers(spark, sf))


@query("p5_constants", oracle("""
    SELECT oid, 'US Forest Service' AS AGENCY, 'USFS' AS AGENCY_C, equipment AS ORGFILE, 'Federal' AS FUND_TYPE,
           DATE '2024-05-06' AS UPDATED FROM treatments""", "treatments"))
def p5_constants(spark, sf):
    from treatflow.fixed_values import AGENCY_CONSTANTS

    df = view(spark, sf, "treatments").select("oid", F.col("equipment").alias("fileNmDate"))
    return schema.stamp_updated(schema.stamp_constants(df, AGENCY_CONSTANTS["usfs"]), "2024-05-06").drop("fileNmDate")


CLEAN_LIST = """list_reduce(
        list_prepend(CAST([] AS VARCHAR[]), list_transform(list_sort(list_transform(list_zip({d}, range(1, len({d}) + 1)),
            lambda z: {{'n': -length(z[1]), 'i': z[2], 'v': z[1]}})), lambda s: [s.v])),
        lambda kept, one: CASE WHEN len(list_filter(kept, lambda k: contains(upper(k), upper(one[1])))) > 0
                               THEN kept ELSE list_concat(kept, one) END)"""


def items_sql(column, drop="'NONE', 'UNKNOWN'"):
    raw = f"list_filter(list_transform(string_split_regex(coalesce({column}, ''), '[;,]'), lambda v: trim(v)), lambda v: v <> '' AND upper(v) NOT IN ({drop}))"
    return distinct_sql(raw)


def distinct_sql(raw):
    return f"list_filter({raw}, lambda v, i: list_position({raw}, v) = i)"


def cleaned_cte(source, column, name="cleaned", alias="vals"):
    """CTE with ``alias`` = cleaned list of ``column``, next to the columns of ``source``."""
    return (
        f"{name} AS (SELECT *, {CLEAN_LIST.format(d='d_' + alias)} AS {alias} FROM "
        f"(SELECT *, {items_sql(column)} AS d_{alias} FROM {source}) {name}_in)"
    )


@query("p6_map_fields", oracle(
    f"WITH {cleaned_cte('codes', 'names')} SELECT oid, array_to_string(vals, '; ') AS PRJ_NAME, substr(array_to_string(vals, '; '), 1, 20) AS PRJ_OBJECT FROM cleaned",
    "codes"))
def p6_map_fields(spark, sf):
    df = view(spark, sf, "codes").select("oid", "names")
    whole = schema.map_fields(df, {"PRJ_NAME": "names"})
    return schema.map_fields(whole, {"PRJ_OBJECT": "names"}, 20).drop("names")


@query("p7_provenance", oracle("""
    SELECT oid, 'Actv_' || flag || '.gdb 2024-05-06' AS fileNmDate FROM treatments""", "treatments"))
def p7_provenance(spark, sf):
    df = view(spark, sf, "treatments").select("oid", "flag")
    name = F.concat(F.lit("https://host/folder/Actv_"), "flag", F.lit(".gdb.zip"))
    return schema.stamp_provenance(df, name, "2024-05-06").drop("flag")


@query("p8_rename", oracle("""
    SELECT g, max(NBR_UNITS_ACCOMPLISHED) AS NBR_UNITS_ACCOMPLISHED, min(TREATMENT_NAME) AS TREATMENT_NAME,
           max(x0) AS REFOR_MGT FROM footprints GROUP BY g""", "footprints"))
def p8_rename(spark, sf):
    df = view(spark, sf, "footprints", geometry=False).groupBy("g").agg(
        F.max("NBR_UNITS_ACCOMPLISHED").alias("MAX_NBR_UNITS_ACCOMPLISHED"),
        F.min("TREATMENT_NAME").alias("FIRST_TREATMENT_NAME"), F.max("x0").alias("REFOREST"),
    )
    return schema.rename(schema.strip_prefix(df), {"REFOREST": "REFOR_MGT", "FIRE_MGT": "RXFIRE_MGT"})


@query("p9_source_id", oracle("""
    SELECT oid, CAST(oid AS BIGINT) AS SourceOID, row_number() OVER (ORDER BY equipment NULLS FIRST, oid) AS ORGID FROM treatments""", "treatments"))
def p9_source_id(spark, sf):
    df = schema.copy_source_id(view(spark, sf, "treatments").select("oid", "equipment"))
    return schema.number_rows(df, ["equipment", "oid"], "ORGID").select("oid", "SourceOID", "ORGID")


# --- filters --------------------------------------------------------------------


@query("f1_region", oracle("SELECT oid, STATE_ABBR FROM layer_a WHERE STATE_ABBR = '2-HIGH'", "layer_a"))
def f1_region(spark, sf):
    layers = [view(spark, sf, "layer_a"), view(spark, sf, "codes")]
    found = [filters.region(df, "2-HIGH") for df in layers]
    return readers.merge_layers([df.select("oid", "STATE_ABBR") for df in found if df is not None])


YEAR_SQL = f"coalesce(CASE WHEN year(date_completed) >= {FIRST} THEN year(date_completed) END, CASE WHEN year(date_awarded) >= {FIRST} THEN year(date_awarded) END)"


@query("f2_year", oracle(f"""
    SELECT oid, CAST({YEAR_SQL} AS INTEGER) AS YEAR_COMP FROM treatments WHERE {YEAR_SQL} BETWEEN {FIRST} AND {LAST}""", "treatments"))
def f2_year(spark, sf):
    df = prepare_dates(view(spark, sf, "treatments"), ["date_completed", "date_awarded"], FIRST)
    return filters.filter_year(df, "YEAR_COMP", FIRST, LAST).select("oid", "YEAR_COMP")


@query("x9_dates", oracle(f"""
    SELECT oid, coalesce(date_completed, date_awarded) AS DATE_COMP, CAST({YEAR_SQL} AS INTEGER) AS YEAR_COMP FROM treatments""", "treatments"))
def x9_dates(spark, sf):
    df = view(spark, sf, "treatments")
    both = [F.col("date_completed"), F.col("date_awarded")]
    return df.select(
        "oid", dates.completion_date(both).alias("DATE_COMP"), dates.completion_year(both, FIRST).alias("YEAR_COMP")
    )


# --- lookups --------------------------------------------------------------------


def tiers(spark):
    return [
        (lookup(spark, TIER_1, "ACTIVITY", "reclass"), "ACTIVITY", "reclass", "activity"),
        (lookup(spark, TIER_2, "METHOD", "reclass"), "METHOD", "reclass", "method"),
        (lookup(spark, TIER_3, "EQUIPMENT", "reclass"), "EQUIPMENT", "reclass", "equipment"),
    ]


def key_sql(c):
    return f"CASE WHEN lower(trim(coalesce({c}, ''))) IN ('nan', 'none', 'null') THEN '' ELSE trim(coalesce({c}, '')) END"


def lookup_cte(rows, name, *columns):
    """Cleaned lookup: one row per key, the last one wins."""
    keys, out = columns[:-1], columns[-1]
    cleaned = ", ".join(f"{key_sql(k)} AS {k}" for k in keys)
    return (
        f"{name} AS (SELECT {', '.join(keys)}, arg_max({out}, n) AS {out}, true AS hit FROM (SELECT {cleaned}, {out}, n FROM "
        f"{values(with_line_no(rows), 'raw_' + name, ', '.join(columns) + ', n')}) c GROUP BY {', '.join(keys)})"
    )


@query("j1_crosswalk", oracle(
    f"WITH {lookup_cte(TIER_3, 'eq', 'EQUIPMENT', 'reclass')} "
    f"SELECT oid, CASE WHEN e.hit THEN e.reclass ELSE t.region END AS region FROM treatments t LEFT JOIN eq e ON {key_sql('t.equipment')} = e.EQUIPMENT",
    "treatments"))
def j1_crosswalk(spark, sf):
    df = view(spark, sf, "treatments").select("oid", "equipment", "region")
    table = lookup(spark, TIER_3, "EQUIPMENT", "reclass")
    return cw.crosswalk(df, table, ["equipment"], {"reclass": "region"}, ["EQUIPMENT"]).drop("equipment")


@query("j1_composite", oracle(
    f"WITH {lookup_cte(TYPES, 'ty', 'Type', 'Category', 'SubType', 'reclass')} "
    f"SELECT ID, CASE WHEN y.hit THEN y.reclass END AS ACT_CSV FROM service s LEFT JOIN ty y ON {key_sql('s.Type')} = y.Type AND {key_sql('s.Category')} = y.Category AND {key_sql('s.SubType')} = y.SubType",
    "service"))
def j1_composite(spark, sf):
    df = view(spark, sf, "service", geometry=False)
    table = lookup(spark, TYPES, "Type", "Category", "SubType", "reclass")
    return cw.crosswalk(df, table, ["Type", "Category", "SubType"], {"reclass": "ACT_CSV"}).select("ID", "ACT_CSV")


LABEL_CTE = f"""
    {lookup_cte(TIER_1, 't1', 'ACTIVITY', 'reclass')}, {lookup_cte(TIER_2, 't2', 'METHOD', 'reclass')},
    {lookup_cte(TIER_3, 't3', 'EQUIPMENT', 'reclass')},
    two AS (SELECT t.*, CASE WHEN t1.reclass = 'SKIP' AND t2.hit THEN t2.reclass ELSE t1.reclass END AS l2 FROM treatments t
            LEFT JOIN t1 ON t.activity = t1.ACTIVITY LEFT JOIN t2 ON t.method = t2.METHOD),
    labelled AS (SELECT two.*, CASE WHEN l2 = 'SKIP' AND t3.hit THEN t3.reclass ELSE l2 END AS label FROM two
                 LEFT JOIN t3 ON two.equipment = t3.EQUIPMENT)"""


def labelled(spark, sf):
    return cw.tiered_crosswalk(view(spark, sf, "treatments"), tiers(spark), "label", "method")


@query("j2_tiered", oracle(f"WITH {LABEL_CTE} SELECT oid, label FROM labelled WHERE label <> 'EXCLUDE'", "treatments"))
def j2_tiered(spark, sf):
    return filters.drop_excluded(labelled(spark, sf), "label").select("oid", "label")


MAJORITY_CTE = f"""{LABEL_CTE},
    counted AS (SELECT activity, label, count(*) AS n FROM labelled WHERE label <> 'SKIP' GROUP BY activity, label),
    majority AS (SELECT activity, label AS majority_label FROM
                 (SELECT *, row_number() OVER (PARTITION BY activity ORDER BY n DESC, label) AS r FROM counted) x WHERE r = 1)"""


@query("a1_majority_label", oracle(f"WITH {MAJORITY_CTE} SELECT activity, majority_label FROM majority", "treatments"))
def a1_majority_label(spark, sf):
    return cw.majority_label(labelled(spark, sf), "activity", "label")


FINAL_LABEL = "CASE WHEN label = 'SKIP' THEN coalesce(m.majority_label, label) ELSE label END"


@query("j4_majority", oracle(f"""WITH {MAJORITY_CTE}
    SELECT oid, {FINAL_LABEL} AS label FROM labelled l LEFT JOIN majority m ON l.activity = m.activity""", "treatments"))
def j4_majority(spark, sf):
    return cw.majority_fallback(labelled(spark, sf), "activity", "label").select("oid", "label")


@query("j9_unmatched", oracle(f"""
    WITH {lookup_cte(TIER_3, 'eq', 'EQUIPMENT', 'reclass')}
    SELECT trim(equipment) AS equipment, count(*) AS n_rows FROM treatments t
    WHERE trim(equipment) <> '' AND NOT EXISTS (SELECT 1 FROM eq WHERE eq.EQUIPMENT = {key_sql('t.equipment')})
    GROUP BY 1""", "treatments"))
def j9_unmatched(spark, sf):
    table = lookup(spark, TIER_3, "EQUIPMENT", "reclass")
    return cw.crosswalk_unmatched(view(spark, sf, "treatments"), table, ["equipment"], ["EQUIPMENT"])


TYPE_ROWS = [(k, a, m) for k, (a, m) in ACTIVITY_MAP.items()]


@query("j11_activity_map", oracle(f"""
    WITH {LABEL_CTE} SELECT oid, coalesce(a.act, l.activity) AS ACTIVITY, coalesce(a.mgt, l.region) AS MGT_TYPE
    FROM labelled l LEFT JOIN {values(TYPE_ROWS, 'a', 'k, act, mgt')} ON trim(l.label) = a.k""", "treatments"))
def j11_activity_map(spark, sf):
    df = labelled(spark, sf).select("oid", F.col("activity").alias("ACTIVITY"), F.col("region").alias("MGT_TYPE"), "label")
    return cw.activity_to_type(df, "label").drop("label")


# --- lists and texts ------------------------------------------------------------


FUND_CTE = f"""fund AS (SELECT code, arg_max(src, n) AS src, arg_max(typ, n) AS typ FROM
    {values(with_line_no(FUNDS), 'raw_fund', 'code, src, typ, n')} GROUP BY code)"""


@query("x5_fund_codes", oracle(f"""
    WITH {FUND_CTE},
    item AS (SELECT oid, i, trim(parts[i]) AS code FROM (
        SELECT oid, string_split_regex(fund_code, '[,|]') AS parts, unnest(range(1, len(string_split_regex(fund_code, '[,|]')) + 1)) AS i
        FROM codes WHERE fund_code <> '') s WHERE trim(parts[i]) <> ''),
    named AS (SELECT oid, coalesce(f.src, 'Other') AS nm, min(i) AS i FROM item LEFT JOIN fund f ON item.code = f.code GROUP BY 1, 2),
    real AS (SELECT *, max(CASE WHEN nm <> 'Other' THEN 1 ELSE 0 END) OVER (PARTITION BY oid) AS has_real FROM named),
    joined AS (SELECT oid, string_agg(nm, ', ' ORDER BY i) AS txt FROM real WHERE nm <> 'Other' OR has_real = 0 GROUP BY oid)
    SELECT c.oid, CASE WHEN c.fund_code IS NULL OR c.fund_code = '' THEN 'No Funding Code'
                       ELSE coalesce(w.src, j.txt, '') END AS funding_update, 'Federal' AS funding_type
    FROM codes c LEFT JOIN fund w ON trim(c.fund_code) = w.code LEFT JOIN joined j ON c.oid = j.oid""", "codes"))
def x5_fund_codes(spark, sf):
    df = view(spark, sf, "codes").select("oid", "fund_code")
    table = lookup(spark, FUNDS, "fund_code", "fund_source", "fund_type")
    return funding.fund_names(df, table, "fund_code").drop("fund_code")


FUND_TYPE_CTE = f"""{FUND_CTE},
    item AS (SELECT oid, i, trim(parts[i]) AS code FROM (
        SELECT oid, string_split_regex(fund_code, '[,/]') AS parts, unnest(range(1, len(string_split_regex(fund_code, '[,/]')) + 1)) AS i
        FROM codes WHERE trim(fund_code) <> '') s WHERE trim(parts[i]) <> ''),
    found AS (SELECT oid, i, coalesce(f.src, 'Unknown') AS src, coalesce(f.typ, 'Unknown') AS typ FROM item LEFT JOIN fund f ON item.code = f.code),
    sources AS (SELECT oid, string_agg(src, ', ' ORDER BY i) AS src FROM (SELECT oid, src, min(i) AS i FROM found GROUP BY 1, 2) a GROUP BY oid),
    kinds AS (SELECT oid, string_agg(typ, ', ' ORDER BY i) AS typ FROM (SELECT oid, typ, min(i) AS i FROM found GROUP BY 1, 2) b GROUP BY oid),
    funded AS (SELECT c.oid, coalesce(s.src, 'Unknown') AS FUND_SOURCE, coalesce(k.typ, 'Unknown') AS FUND_TYPE,
                      s.src IS NOT NULL AND (contains(s.src, 'Unknown') OR contains(k.typ, 'Unknown')) AS fund_flag
               FROM codes c LEFT JOIN sources s ON c.oid = s.oid LEFT JOIN kinds k ON c.oid = k.oid)"""


@query("x6_fund_source_type", oracle(f"WITH {FUND_TYPE_CTE} SELECT * FROM funded", "codes"))
def x6_fund_source_type(spark, sf):
    df = view(spark, sf, "codes").select("oid", "fund_code")
    table = lookup(spark, FUNDS, "fund_code", "fund_source", "fund_type")
    return funding.fund_source_type(df, table, "fund_code").drop("fund_code")


@query("x7_clean_list", oracle(
    f"WITH {cleaned_cte('codes', 'names')} SELECT oid, array_to_string(vals, '|') AS items, len(vals) AS n FROM cleaned", "codes"))
def x7_clean_list(spark, sf):
    items = lists.clean_list(F.col("names"))
    return view(spark, sf, "codes").select(
        "oid", F.array_join(items, "|").alias("items"), F.size(items).cast("bigint").alias("n")
    )


def distinct_list_sql(column):
    raw = f"list_filter(list_transform(string_split(coalesce({column}, ''), '; '), lambda v: trim(v)), lambda v: lower(v) NOT IN ('', 'none'))"
    return f"nullif(array_to_string({distinct_sql(raw)}, ', '), '')"


@query("x8_distinct_list", oracle(f"SELECT oid, {distinct_list_sql('names')} AS FUNDING FROM codes", "codes"))
def x8_distinct_list(spark, sf):
    return view(spark, sf, "codes").select("oid", lists.distinct_list(F.col("names")).alias("FUNDING"))


@query("x10_doc_name", oracle("""
    SELECT oid, CASE WHEN doc_name IS NULL OR trim(doc_name) = '' OR doc_name IN ('DEFAULT FOR NOT REQUIRED', 'CE without DM',
                    'DECISION NOTICE AND FINDING OF NO SIGNIFICANT IMPACT', 'NEPA Pending') THEN NULL
                WHEN starts_with(doc_name, '(PALS)') THEN trim(replace(doc_name, '(PALS)', '')) ELSE doc_name END AS NEPA_DOC_NAME
    FROM codes""", "codes"))
def x10_doc_name(spark, sf):
    return view(spark, sf, "codes").select("oid", text.clean_doc_name(F.col("doc_name")).alias("NEPA_DOC_NAME"))


@query("x11_project_name", oracle(f"""
    WITH {cleaned_cte('codes', 'names', 'one', 'trt')}, {cleaned_cte('one', 'doc_name', 'two', 'doc')}
    SELECT oid, CASE WHEN len(trt) > 0 AND len(doc) > 0 THEN array_to_string(trt, ', ') || ', [NEPA] ' || array_to_string(doc, ', ')
                     WHEN len(trt) > 0 THEN array_to_string(trt, ', ')
                     WHEN len(doc) > 0 THEN '[NEPA] ' || array_to_string(doc, ', ') ELSE 'Unknown' END AS PRJ_NAME FROM two""", "codes"))
def x11_project_name(spark, sf):
    return view(spark, sf, "codes").select("oid", text.project_name(F.col("names"), F.col("doc_name")).alias("PRJ_NAME"))


@query("x12_objective", oracle(f"""
    SELECT oid, {distinct_list_sql("trim(coalesce(names, '') || '; ' || coalesce(doc_name, ''), '; ')")} AS PRJ_OBJECT FROM codes""", "codes"))
def x12_objective(spark, sf):
    return view(spark, sf, "codes").select(
        "oid", text.objective_text(F.col("names"), F.col("doc_name")).alias("PRJ_OBJECT")
    )


# --- acres ----------------------------------------------------------------------


@query("n1_clamp", oracle("""
    SELECT oid, round(CASE WHEN units IS NULL OR units = 0 OR units >= a THEN a ELSE units END, 6) AS ACRES_MGT
    FROM (SELECT oid, units, coalesce(CASE WHEN oid % 10 <> 0 THEN gis_acres * 4000 END, 0) * 0.000247105 AS a FROM treatments) t""", "treatments"))
def n1_clamp(spark, sf):
    area = F.when(F.col("oid") % 10 != 0, F.col("gis_acres") * 4000)
    return view(spark, sf, "treatments").select("oid", F.round(acres.clamped_acres(F.col("units"), area), 6).alias("ACRES_MGT"))


@query("n2_unit_clamp", oracle("""
    SELECT oid, round(CASE WHEN lower(unit) = 'acres' AND units IS NOT NULL AND units <> 0 AND units <= gis_acres THEN units ELSE gis_acres END, 6) AS ACRES_MGT
    FROM (SELECT *, CASE oid % 4 WHEN 0 THEN 'Acres' WHEN 1 THEN 'trees' WHEN 2 THEN NULL ELSE 'ACRES' END AS unit FROM treatments) t""", "treatments"))
def n2_unit_clamp(spark, sf):
    unit = F.when(F.col("oid") % 4 == 0, "Acres").when(F.col("oid") % 4 == 1, "trees").when(F.col("oid") % 4 == 3, "ACRES")
    value = acres.clamped_acres_by_unit(unit, F.col("units"), F.col("gis_acres"))
    return view(spark, sf, "treatments").select("oid", F.round(value, 6).alias("ACRES_MGT"))


@query("n3_acres", oracle("SELECT oid, round(coalesce(units, gis_acres), 6) AS ACRES_MGT FROM treatments", "treatments"))
def n3_acres(spark, sf):
    return view(spark, sf, "treatments").select(
        "oid", F.round(acres.managed_acres(F.col("units"), F.col("gis_acres")), 6).alias("ACRES_MGT")
    )


# --- merging and checks -----------------------------------------------------------


@query("u1_merge", oracle("""
    SELECT layer, count(*) AS n, count(NAME) AS n_name, count(AU_NAME) AS n_au, count(FUND_CODES) AS n_fund,
           count(ACTIVITY) AS n_activity FROM (
        SELECT 'a' AS layer, NAME, NULL AS AU_NAME, FUND_CODES, ACTIVITY FROM layer_a
        UNION ALL SELECT 'b', NULL, AU_NAME, NULL, ACTIVITY FROM layer_b
        UNION ALL SELECT 'b', NULL, AU_NAME, NULL, ACTIVITY FROM layer_b) t GROUP BY layer""", "layer_a", "layer_b"))
def u1_merge(spark, sf):
    a = view(spark, sf, "layer_a").withColumn("layer", F.lit("a"))
    b = view(spark, sf, "layer_b").withColumn("layer", F.lit("b"))
    counts = {"n_name": "NAME", "n_au": "AU_NAME", "n_fund": "FUND_CODES", "n_activity": "ACTIVITY"}
    return readers.merge_layers([a, b, b]).groupBy("layer").agg(
        F.count(F.lit(1)).alias("n"), *[F.count(c).alias(n) for n, c in counts.items()]
    )


MGT_SQL = """CASE WHEN contains(t, 'canopy') OR contains(t, 'surface') THEN 'Mechanical and Hand Equipment'
         WHEN contains(t, 'reforest') THEN 'Reforestation'
         WHEN contains(t, 'rxfire') OR contains(t, 'prescribed') OR contains(t, 'fire') THEN 'Prescribed Fire' ELSE MGT_TYPE END"""


@query("x13_mgt_type", oracle(f"""
    SELECT oid, {MGT_SQL} AS MGT_TYPE, coalesce(MGT_TYPE, '') = '' AS no_type
    FROM (SELECT *, replace(lower(MGT_TYPE), ' ', '') AS t FROM merged) m""", "merged"))
def x13_mgt_type(spark, sf):
    return view(spark, sf, "merged", geometry=False).select(
        "oid", qa.normalized_mgt_type(F.col("MGT_TYPE")).alias("MGT_TYPE"), qa.no_mgt_type(F.col("MGT_TYPE")).alias("no_type")
    )


ACTIVITY_NAMES = ", ".join(f"'{a}'" for a in ACTIVITY_MAP)
SINGLE_SQL = f"""SELECT *, CASE WHEN len(f) = 1 THEN trim(f[1]) ELSE '' END AS ACTIVITY,
        NOT (len(f) = 1 AND trim(f[1]) IN ({ACTIVITY_NAMES})) AS activity_error
        FROM (SELECT *, list_filter([CANOPY_MGT, SURF_MGT, RXFIRE_MGT, REFOR_MGT], lambda v: v IS NOT NULL AND v NOT IN ('', ' ')) AS f FROM merged) m"""


@query("x14_single_activity", oracle(f"""
    SELECT oid, ACTIVITY, coalesce(activity_error, true) AS activity_error FROM ({SINGLE_SQL}) s""", "merged"))
def x14_single_activity(spark, sf):
    df = qa.single_activity(view(spark, sf, "merged", geometry=False))
    return df.select("oid", "ACTIVITY", F.coalesce("activity_error", F.lit(True)).alias("activity_error"))


@query("x15_activity_columns", oracle(f"""
    WITH {LABEL_CTE}, k AS (SELECT oid, trim(label) AS label, label IS NOT NULL AND label <> '' AS filled, region AS mgt, CASE
        WHEN trim(label) IN ('Broadcast Burn', 'Pile Burn') THEN 1
        WHEN trim(label) IN ('Manual', 'Mechanical', 'Mastication', 'Chemical') THEN 2
        WHEN trim(label) IN ('Removal', 'Lop and Scatter', 'Pile Fuels', 'Mulching') THEN 3
        WHEN trim(label) IN ('Plant Trees', 'Seed') THEN 4 END AS c FROM labelled)
    SELECT oid, CASE WHEN c = 1 THEN label WHEN c IS NOT NULL THEN '' ELSE 'old' END AS RXFIRE_MGT,
           CASE WHEN c = 2 THEN label WHEN c IS NOT NULL THEN '' ELSE 'old' END AS CANOPY_MGT,
           CASE WHEN c = 3 THEN label WHEN c IS NOT NULL THEN '' ELSE 'old' END AS SURF_MGT,
           CASE WHEN c = 4 THEN label WHEN c IS NOT NULL THEN '' ELSE 'old' END AS REFOREST,
           CASE c WHEN 1 THEN 'FIRE' WHEN 2 THEN 'CANOPY' WHEN 3 THEN 'SURFACE' WHEN 4 THEN 'REFOREST' ELSE mgt END AS MGT_TYPE,
           c IS NULL AND filled AS unknown_activity FROM k""", "treatments"))
def x15_activity_columns(spark, sf):
    df = labelled(spark, sf).select("oid", "label", F.col("region").alias("MGT_TYPE"))
    old = df.withColumns({c: F.lit("old") for c in ("RXFIRE_MGT", "CANOPY_MGT", "SURF_MGT", "REFOREST")})
    return qa.activity_columns(old, "label").drop("label")


@query("x16_fill_text", oracle("""
    SELECT oid, coalesce(MGT_TYPE, '') AS MGT_TYPE, coalesce(RXFIRE_MGT, '') AS RXFIRE_MGT, coalesce(LANDOWNER, '') AS LANDOWNER,
           coalesce(FUNDING, '') AS FUNDING, YEAR_COMP FROM merged""", "merged"))
def x16_fill_text(spark, sf):
    columns = ["oid", "MGT_TYPE", "RXFIRE_MGT", "LANDOWNER", "FUNDING", "YEAR_COMP"]
    return schema.fill_text(view(spark, sf, "merged", geometry=False).select(columns))


@query("x17_qa_flags", oracle(f"""
    SELECT oid, array_to_string(list_filter([CASE WHEN coalesce(MGT_TYPE, '') = '' THEN 'NO MGT_TYPE' END,
               CASE WHEN coalesce(activity_error, true) THEN 'ACTIVITY ERROR' END,
               CASE WHEN YEAR_COMP NOT BETWEEN 2000 AND 2024 THEN 'YEAR FLAG' END], lambda v: v IS NOT NULL), ',') AS flags,
           CASE WHEN YEAR_COMP NOT BETWEEN 2000 AND 2024 THEN 'YEAR FLAG' WHEN coalesce(activity_error, true) THEN 'ACTIVITY ERROR'
                WHEN coalesce(MGT_TYPE, '') = '' THEN 'NO MGT_TYPE' END AS ERROR_FLAG FROM ({SINGLE_SQL}) s""", "merged"))
def x17_qa_flags(spark, sf):
    df = qa.single_activity(view(spark, sf, "merged", geometry=False))
    checks = {
        "NO MGT_TYPE": qa.no_mgt_type(F.col("MGT_TYPE")), "ACTIVITY ERROR": F.col("activity_error"),
        "YEAR FLAG": qa.year_out_of_range(F.col("YEAR_COMP")),
    }
    flagged = qa.qa_flags(df, checks)
    return flagged.select("oid", F.array_join("qa_flags", ",").alias("flags"), "ERROR_FLAG")


# --- flagship -------------------------------------------------------------------


@query("managed_acres_by_type", oracle(f"""
    WITH {MAJORITY_CTE}, yr AS (SELECT l.*, CAST({YEAR_SQL} AS INTEGER) AS y, {FINAL_LABEL} AS final
        FROM labelled l LEFT JOIN majority m ON l.activity = m.activity)
    SELECT coalesce(a.mgt, 'Unmapped') AS MGT_TYPE, y AS YEAR_COMP, count(*) AS n,
           round(sum(CASE WHEN units IS NULL OR units = 0 THEN gis_acres * 4046.8564224 * 0.000247105
                          ELSE least(units, gis_acres * 4046.8564224 * 0.000247105) END), 2) AS acres
    FROM yr LEFT JOIN {values(TYPE_ROWS, 'a', 'k, act, mgt')} ON yr.final = a.k
    WHERE y BETWEEN {FIRST} AND {LAST} AND final <> 'EXCLUDE' GROUP BY 1, 2""", "treatments"))
def managed_acres_by_type(spark, sf):
    """Labels by tier and majority, years, clamped acres: the attribute part of the crosswalk flow."""
    final = filters.drop_excluded(cw.majority_fallback(labelled(spark, sf), "activity", "label"), "label")
    dated = filters.filter_year(prepare_dates(final, ["date_completed", "date_awarded"], FIRST), "YEAR_COMP", FIRST, LAST)
    typed = cw.activity_to_type(
        dated.withColumnRenamed("activity", "ACTIVITY").withColumn("MGT_TYPE", F.lit("Unmapped")), "label"
    )
    managed = acres.clamped_acres(F.col("units"), F.col("gis_acres") * 4046.8564224)
    return typed.groupBy("MGT_TYPE", "YEAR_COMP").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(managed), 2).alias("acres")
    )


KNOWN_LABELS = ", ".join("'" + k.replace("'", "''") + "'" for k in ACTIVITY_MAP)


@query("q10_label_lint", oracle(f"""
    SELECT label, count(*) AS n_rows, (SELECT max(k) FROM (SELECT unnest([{KNOWN_LABELS}]) AS k) WHERE lower(k) = lower(label)) AS differs_in_case
    FROM (SELECT CASE oid % 5 WHEN 0 THEN ' MANUAL ' WHEN 1 THEN 'Manual' WHEN 2 THEN 'SKIP' WHEN 3 THEN activity ELSE '' END AS raw, trim(raw) AS label FROM treatments)
    WHERE label NOT IN ('', 'SKIP', 'EXCLUDE', 'DELETE', 'UNCLASSIFIED', 'TREE CHECK', 'PLANT CHECK', {KNOWN_LABELS}) GROUP BY label""", "treatments"))
def q10_label_lint(spark, sf):
    pick = F.col("oid") % 5
    label = (F.when(pick == 0, F.lit(" MANUAL ")).when(pick == 1, F.lit("Manual")).when(pick == 2, F.lit("SKIP"))
             .when(pick == 3, F.col("activity")).otherwise(F.lit("")))
    return cw.label_lint(view(spark, sf, "treatments").select(label.alias("label")), "label")
