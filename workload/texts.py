"""Queries over keyword classes and their routing."""

from __future__ import annotations

from pyspark.sql import functions as F

from treatflow.functions import text
from treatflow.operators import classify
from workload.fixtures import oracle, values, view
from workload.lookups import RULES
from workload.registry import query

FIELDS = ["name", "comments"]


def cleaned_sql(column):
    return f"trim(regexp_replace(lower(coalesce({column}, '')), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"


COMBINED = """CASE WHEN trim(concat_ws(' ', nullif(name, ''), nullif(comments, ''))) <> ''
                   THEN concat_ws(' ', nullif(name, ''), nullif(comments, '')) END"""


@query("x1_clean_text", oracle(f"SELECT oid, {cleaned_sql('comments')} AS txt FROM notes", "notes"))
def x1_clean_text(spark, sf):
    return view(spark, sf, "notes").select("oid", text.clean_text(F.col("comments")).alias("txt"))


@query("x3_combine", oracle(f"""
    SELECT oid, txt AS whole, substr(txt, 1, 5000) AS Class_Combine FROM (SELECT oid, {COMBINED} AS txt FROM notes) t""", "notes"))
def x3_combine(spark, sf):
    columns = [F.col(c) for c in FIELDS]
    return view(spark, sf, "notes").select(
        "oid", text.combine_text(columns).alias("whole"), text.combine_text(columns, 5000).alias("Class_Combine")
    )


def classes_cte(source, combined, id_col):
    """CTEs that end in ``classes``: id, label and rule position of the first three labels, in order ``rank``."""
    rules = values([(i, p, a) for i, (p, a) in enumerate(RULES)], "rules", "pos, pattern, label")
    spans = """list_transform(range(1, len(hits) + 1), lambda i: {
        's': list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda h: length(h))), 0),
        'e': list_sum(list_transform(gaps[1:i], lambda g: length(g))) + list_sum(list_transform(hits[1:i], lambda h: length(h)))})"""
    taken = """len(list_filter(acc.spans, lambda k: (k.s <= m.s AND m.s < k.e) OR (k.s < m.e AND m.e <= k.e))) > 0"""
    free = f"list_filter(r.spans, lambda m: NOT ({taken}))"
    return f"""
    cleaned AS (SELECT {id_col} AS id, {cleaned_sql(combined)} AS c FROM {source}),
    matched AS (SELECT id, pos, string_split_regex(c, pattern) AS gaps, regexp_extract_all(c, pattern) AS hits
                FROM cleaned, {rules} WHERE regexp_matches(c, pattern)),
    spanned AS (SELECT id, pos, {spans} AS spans FROM matched),
    listed AS (SELECT id, list({{'won': [pos], 'spans': spans}} ORDER BY pos) AS steps FROM spanned GROUP BY id),
    folded AS (SELECT id, list_reduce(
        list_prepend({{'won': steps[1].won[1:0], 'spans': steps[1].spans[1:0]}}, steps),
        lambda acc, r: {{'won': CASE WHEN len({free}) > 0 THEN list_concat(acc.won, r.won) ELSE acc.won END,
                         'spans': list_concat(acc.spans, {free})}}).won AS won FROM listed),
    won AS (SELECT id, unnest(won) AS pos FROM folded),
    labels AS (SELECT id, label, min(won.pos) AS pos FROM won JOIN {rules} ON won.pos = rules.pos GROUP BY id, label),
    classes AS (SELECT labels.id, labels.label, rules.pattern, row_number() OVER (PARTITION BY id ORDER BY labels.pos) AS rank
                FROM labels JOIN {rules} ON labels.pos = rules.pos QUALIFY rank <= 3)"""


CLASSES = f"combined AS (SELECT oid, {COMBINED} AS txt FROM notes), " + classes_cte("combined", "txt", "oid")
WIDE = """wide AS (SELECT n.oid, coalesce(max(CASE WHEN rank = 1 THEN label END), 'UNCLASSIFIED') AS ActClass_1,
        max(CASE WHEN rank = 1 THEN pattern END) AS Keyword_1, max(CASE WHEN rank = 2 THEN label END) AS ActClass_2,
        max(CASE WHEN rank = 2 THEN pattern END) AS Keyword_2, max(CASE WHEN rank = 3 THEN label END) AS ActClass_3,
        max(CASE WHEN rank = 3 THEN pattern END) AS Keyword_3 FROM {source} n LEFT JOIN classes c ON n.oid = c.id GROUP BY n.oid)"""
LONG = """long AS (SELECT n.oid, coalesce(c.label, 'UNCLASSIFIED') AS activity_reclass, c.pattern AS Keyword
        FROM {source} n LEFT JOIN classes c ON n.oid = c.id)"""
NOTES_WIDE, NOTES_LONG = WIDE.format(source="notes"), LONG.format(source="notes")


def classified(spark, sf):
    return classify.classify_treatments(view(spark, sf, "notes"), FIELDS, RULES)


@query("x2_keyword_classes", oracle(f"WITH {CLASSES}, {NOTES_WIDE} SELECT * FROM wide", "notes"))
def x2_keyword_classes(spark, sf):
    return classified(spark, sf).select("oid", *classify.CLASS_COLUMNS)


@query("x4_explode", oracle(f"WITH {CLASSES}, {NOTES_LONG} SELECT * FROM long", "notes"))
def x4_explode(spark, sf):
    return classify.explode_activity(classified(spark, sf)).select("oid", "activity_reclass", "Keyword")


KEPT = """kept AS (SELECT l.*, w.ActClass_1, w.ActClass_2, w.ActClass_3 FROM long l JOIN wide w ON l.oid = w.oid
        WHERE NOT (l.activity_reclass = 'DELETE' AND (
            coalesce(ActClass_1, '') NOT IN ('', 'None', 'DELETE', 'UNCLASSIFIED', 'Null')
            OR coalesce(ActClass_2, '') NOT IN ('', 'None', 'DELETE', 'UNCLASSIFIED', 'Null')
            OR coalesce(ActClass_3, '') NOT IN ('', 'None', 'DELETE', 'UNCLASSIFIED', 'Null'))))"""
ROUTE = """CASE WHEN activity_reclass = 'DELETE' THEN 'deleted'
        WHEN activity_reclass IN ('UNCLASSIFIED', 'TREE CHECK', 'PLANT CHECK') THEN 'review' ELSE 'classified' END"""


@query("f7_redundant_delete", oracle(f"WITH {CLASSES}, {NOTES_WIDE}, {NOTES_LONG}, {KEPT} SELECT oid, activity_reclass FROM kept", "notes"))
def f7_redundant_delete(spark, sf):
    return classify.drop_redundant_delete(classify.explode_activity(classified(spark, sf))).select("oid", "activity_reclass")


@query("s8_route_counts", oracle(f"""
    WITH {CLASSES}, {NOTES_WIDE}, {NOTES_LONG}, {KEPT} SELECT {ROUTE} AS route, count(*) AS n FROM kept GROUP BY 1""", "notes"))
def s8_route_counts(spark, sf):
    return classify.split_routes(classified(spark, sf)).groupBy("route").agg(F.count(F.lit(1)).alias("n"))
