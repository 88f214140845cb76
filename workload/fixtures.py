"""Input views over the supplied tables.

Each view is one SQL text that means the same in Spark and in DuckDB; ``{name}`` stands for a table or
another view.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

from treatflow.functions.geometry import rectangle

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "documents"]

VIEWS = {
    "treatments": """
        SELECT ((l.l_orderkey * 20001 + l.l_partkey) * 1001 + l.l_suppkey) * 8 + l.l_linenumber AS oid,
               p.p_type AS activity, p.p_name AS method, p.p_brand AS equipment,
               CASE WHEN l.l_linenumber <> 7 THEN l.l_shipdate END AS date_completed,
               o.o_orderdate AS date_awarded,
               CASE WHEN l.l_linenumber = 6 THEN CAST(0 AS DOUBLE)
                    WHEN l.l_linenumber = 5 THEN NULL ELSE l.l_quantity END AS units,
               o.o_orderpriority AS region, l.l_extendedprice / 2000 AS gis_acres,
               l.l_returnflag AS flag, l.l_orderkey AS orderkey
        FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
        JOIN {part} p ON l.l_partkey = p.p_partkey""",
    "layer_a": """
        SELECT oid, CASE WHEN oid % 5 = 0 THEN 'None' WHEN oid % 7 = 0 THEN '  ' ELSE ' ' || method || ' ' END AS NAME,
               CASE WHEN oid % 3 = 0 THEN NULL ELSE equipment END AS TREATMENT_NAME,
               CASE WHEN oid % 4 = 0 THEN ' none' ELSE activity END AS ACTIVITY_NAME, 'raw' AS ACTIVITY,
               method AS METHOD_DESC, equipment AS EQUIPMENT_DESC,
               CASE WHEN oid % 6 = 0 THEN NULL ELSE flag || '1' END AS FUND_CODES,
               CASE WHEN oid % 2 = 0 THEN '' ELSE 'DOC ' || equipment END AS NEPA_DOC_NAME,
               region AS STATE_ABBR, date_completed AS DATE_COMPLETED, date_awarded AS DATE_AWARDED,
               units AS NBR_UNITS_ACCOMPLISHED, gis_acres, orderkey
        FROM {treatments} WHERE flag = 'R'""",
    "layer_b": """
        SELECT oid, CASE WHEN oid % 5 < 2 THEN NULL ELSE method END AS AU_NAME,
               CASE WHEN oid % 5 = 0 THEN NULL ELSE 'SUB ' || region END AS SUBUNIT_NAME,
               activity AS ACTIVITY, method AS METHOD,
               CASE WHEN oid % 3 = 0 THEN 'PRJ ' || equipment END AS NEPA_PROJECT_NAME,
               region AS STATE_ABBR, date_completed AS DATE_COMPLETED, date_awarded AS DATE_AWARDED,
               units AS NBR_UNITS_ACCOMPLISHED, gis_acres, orderkey
        FROM {treatments} WHERE flag <> 'R'""",
    "order_notes": """
        SELECT o.o_orderkey AS oid, p1.p_name AS name,
               CASE WHEN o.o_orderkey % 17 = 0 THEN NULL WHEN o.o_orderkey % 19 = 0 THEN ' _ '
                    ELSE upper(p2.p_name) || CASE WHEN o.o_orderkey % 3 = 0 THEN '; ' WHEN o.o_orderkey % 3 = 1 THEN '_' ELSE ' -- (' END
                         || p3.p_name || '!' END AS comments,
               o.o_orderdate AS started, o.o_totalprice / 2000 AS reported_acres
        FROM {orders} o
        JOIN {part} p1 ON p1.p_partkey = o.o_custkey
        JOIN {part} p2 ON p2.p_partkey = (o.o_orderkey * 7 + 3) % 150
        JOIN {part} p3 ON p3.p_partkey = (o.o_orderkey * 13 + 5) % 150""",
    "notes": """
        SELECT oid, name, comments, started, reported_acres FROM {order_notes}
        UNION ALL
        SELECT 1000000000000 + doc_id AS oid, source AS name, text AS comments,
               CAST(NULL AS TIMESTAMP) AS started, CAST(NULL AS DOUBLE) AS reported_acres
        FROM {documents}""",
    "codes": """
        SELECT o.o_orderkey AS oid,
               CASE o.o_orderkey % 9 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN c.c_mktsegment
                    WHEN 3 THEN c.c_mktsegment || ',' || o.o_orderpriority
                    WHEN 4 THEN c.c_mktsegment || '|ZZZZ'
                    WHEN 5 THEN ' ' || c.c_mktsegment || ' , , ' || c.c_mktsegment
                    WHEN 6 THEN c.c_mktsegment || '/' || o.o_orderpriority
                    WHEN 7 THEN 'Unknown' ELSE 'ZZZZ' END AS fund_code,
               CASE o.o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'None; ' || c.c_mktsegment
                    WHEN 3 THEN c.c_mktsegment || '; ' || c.c_mktsegment || '; ' || lower(c.c_mktsegment) || ' co'
                    WHEN 4 THEN ' unknown ' WHEN 5 THEN c.c_name || ', ' || c.c_mktsegment || ';' || c.c_name
                    ELSE c.c_mktsegment || '; NONE; ' || substr(c.c_mktsegment, 1, 4) || ';' || o.o_orderpriority END AS names,
               CASE o.o_orderkey % 6 WHEN 0 THEN 'DEFAULT FOR NOT REQUIRED' WHEN 1 THEN '(PALS) ' || c.c_name
                    WHEN 2 THEN '  ' WHEN 3 THEN NULL WHEN 4 THEN 'NEPA Pending' ELSE c.c_name || ' (PALS)' END AS doc_name,
               c.c_mktsegment AS segment, o.o_orderpriority AS priority, o.o_orderdate AS ordered,
               o.o_totalprice AS price
        FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey""",
    "footprints": """
        SELECT oid, g, k, CAST(500000 + (g % 100) * 1000 + k * 20 AS DOUBLE) AS x0,
               CAST(4400000 + floor(g / 100) * 1000 AS DOUBLE) AS y0,
               CAST(200 + 10 * (g % 30) + CASE WHEN g % 2 = 1 THEN 150 * k ELSE 0 END AS DOUBLE) AS w,
               CAST(150 + 10 * (g % 20) AS DOUBLE) AS h,
               CASE WHEN g % 4 = 0 OR k < 2 THEN 'Manual' ELSE 'Removal' END AS activity_reclass,
               CASE WHEN g % 3 = 0 THEN o_orderdate ELSE CAST('1999-06-01 00:00:00' AS TIMESTAMP) END AS DATE_COMPLETED,
               o_totalprice / 2000 AS NBR_UNITS_ACCOMPLISHED,
               CASE WHEN oid % 5 = 0 THEN NULL ELSE o_orderpriority END AS FUND_CODE,
               CASE WHEN oid % 4 = 0 THEN 'NAME ' || o_orderstatus ELSE o_orderpriority END AS TREATMENT_NAME
        FROM (SELECT o_orderkey AS oid, CAST(floor(o_orderkey / 3) AS BIGINT) AS g, o_orderkey % 3 AS k,
                     o_orderdate, o_totalprice, o_orderpriority, o_orderstatus FROM {orders}) keyed""",
    "placed_a": """
        SELECT a.*, f.x0, f.y0, f.w, f.h FROM {layer_a} a JOIN {footprints} f ON a.orderkey = f.oid""",
    "placed_b": """
        SELECT b.*, f.x0, f.y0, f.w, f.h FROM {layer_b} b JOIN {footprints} f ON b.orderkey = f.oid""",
    "units": """
        SELECT oid, g, k, x0, y0, w, h, activity_reclass AS ActClass, DATE_COMPLETED AS COMPLETED1,
               NBR_UNITS_ACCOMPLISHED AS COMPLETED_,
               CASE oid % 4 WHEN 0 THEN 'Acres' WHEN 1 THEN 'trees' WHEN 2 THEN NULL ELSE 'ACRES' END AS UNIT_OF_ME,
               TREATMENT_NAME AS NAME_REDACT, CAST(oid AS VARCHAR(20)) AS ID_CODE, FUND_CODE AS FUNDING_SO,
               CASE WHEN oid % 3 = 0 THEN 'none' ELSE TREATMENT_NAME END AS DESCRIPTION_REDACT,
               CASE WHEN oid % 2 = 0 THEN FUND_CODE END AS COMMENT_REDACT, 'thin' AS Class_Combine
        FROM {footprints}""",
    "parcels": """
        SELECT i * 1000000 + j AS parcel_id, n.n_name AS owner,
               CAST(500000 + i * 2700 AS DOUBLE) AS x0, CAST(4400000 + j * 2700 AS DOUBLE) AS y0,
               CAST(2700 AS DOUBLE) AS w, CAST(2700 AS DOUBLE) AS h
        FROM (SELECT CAST(floor((x0 - 500000) / 2700) AS BIGINT) AS i, CAST(floor((y0 - 4400000) / 2700) AS BIGINT) AS j FROM {footprints}
              UNION SELECT CAST(floor((x0 + w - 500000) / 2700) AS BIGINT) AS i, CAST(floor((y0 - 4400000) / 2700) AS BIGINT) AS j FROM {footprints}
              UNION SELECT CAST(floor((x0 - 500000) / 2700) AS BIGINT) AS i, CAST(floor((y0 + h - 4400000) / 2700) AS BIGINT) AS j FROM {footprints}
              UNION SELECT CAST(floor((x0 + w - 500000) / 2700) AS BIGINT) AS i, CAST(floor((y0 + h - 4400000) / 2700) AS BIGINT) AS j FROM {footprints}) cells
        JOIN {nation} n ON n.n_nationkey = (i * 7 + j * 3) % 25
        WHERE (i * 7 + j * 3) % 25 <> 24""",
    "merged": """
        SELECT f.*, CASE oid % 8 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'Canopy Fuels' WHEN 3 THEN 'SUR FACE'
                         WHEN 4 THEN 'Reforest' WHEN 5 THEN 'RX Fire' WHEN 6 THEN 'prescribed burn' ELSE 'Other work' END AS MGT_TYPE,
               CASE WHEN oid % 5 = 0 THEN ' Manual ' WHEN oid % 5 = 1 THEN 'Chopping' ELSE '' END AS CANOPY_MGT,
               CASE WHEN oid % 15 = 0 THEN 'Removal' ELSE ' ' END AS SURF_MGT,
               CASE WHEN oid % 5 = 2 THEN 'Pile Burn' END AS RXFIRE_MGT,
               CASE WHEN oid % 5 = 3 THEN 'Seed' END AS REFOR_MGT,
               CAST(1995 + oid % 36 AS INTEGER) AS YEAR_COMP, c.fund_code AS FUNDING, c.segment AS NOTES,
               CASE WHEN oid % 3 = 0 THEN 'NOBODY' END AS LANDOWNER
        FROM {footprints} f JOIN (SELECT oid AS code_oid, fund_code, segment FROM {codes}) c ON f.oid = c.code_oid""",
    "service": """
        SELECT f.oid AS ID, n.name AS Name, n.comments AS Notes, t.p_type AS Type, t.p_brand AS Category,
               CASE WHEN f.oid % 4 = 0 THEN NULL WHEN f.oid % 4 = 1 THEN 'None' ELSE t.p_name END AS SubType,
               CASE WHEN f.oid % 10 = 0 THEN 'Planned Treatment' ELSE 'Actual Treatment' END AS Class,
               CASE WHEN f.oid % 6 = 0 THEN 'Utah' ELSE 'Colorado' END AS State,
               CASE WHEN f.oid % 5 = 0 THEN NULL ELSE f.DATE_COMPLETED END AS CompletionDate,
               n.started AS InitiationDate, c.names AS FundingSource, c.segment AS FundingAgency,
               f.x0, f.y0, f.w, f.h
        FROM {footprints} f JOIN {order_notes} n ON n.oid = f.oid JOIN {codes} c ON c.oid = f.oid
        JOIN {part} t ON t.p_partkey = f.oid % 150""",
}

WITH_GEOMETRY = {"footprints", "placed_a", "placed_b", "units", "parcels", "merged", "service"}


def _names(text: str) -> list[str]:
    return list(dict.fromkeys(n for _, n, _, _ in string.Formatter().parse(text) if n))


def view(spark: SparkSession, sf_dir: str, name: str, geometry: bool = True) -> DataFrame:
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = VIEWS[name]
    inputs = {n: view(spark, sf_dir, n, geometry=False) for n in _names(text)}
    df = spark.sql(text, **inputs)
    if geometry and name in WITH_GEOMETRY:
        df = df.withColumn("geom", rectangle("x0", "y0", "w", "h"))
    return df


def oracle(body: str, *views: str) -> str:
    """The body with the named views, and those under them, as common table expressions."""
    order: list[str] = []

    def add(name: str) -> None:
        if name in TABLES or name in order:
            return
        for n in _names(VIEWS[name]):
            add(n)
        order.append(name)

    for v in views:
        add(v)
    ctes = [f"{n} AS ({VIEWS[n].format(**{m: m for m in _names(VIEWS[n])})})" for n in order]
    if not ctes:
        return body
    glue = ", " if body.lstrip().upper().startswith("WITH ") else " "
    rest = body.lstrip()[5:] if glue == ", " else body
    return "WITH " + ", ".join(ctes) + glue + rest


def values(rows: list[tuple], name: str, columns: str) -> str:
    """A lookup as a VALUES table of the oracle SQL."""
    text = lambda v: "NULL" if v is None else str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"
    return f"(VALUES {', '.join('(' + ', '.join(text(v) for v in r) + ')' for r in rows)}) AS {name}({columns})"
