import math
import random
import re

import pytest
from pyspark.sql import functions as F

from treatflow.fixed_values import KEYWORD_RULES, MERGED_FIELDS
from treatflow.functions import geometry as geo
from treatflow.functions import lists, text
from treatflow.functions.keywords import check_rules, keyword_classes
from treatflow.operators import classify, crosswalk, funding, overlay, qa, schema
from treatflow.operators.filters import repaired
from treatflow.plans.flows import merge_qa, review_merge, single_parts
from treatflow.session import small_table
from tests.shapes import frame, inside, ring, rng, square, star


def one(spark, expr, **values):
    df = small_table(spark, [tuple(values.values())], list(values)) if values else spark.range(1)
    return df.select(expr.alias("v")).head()["v"]


def text_values(spark, build, items):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], "i int, t string")
    return [r["v"] for r in df.select("i", build(F.col("t")).alias("v")).orderBy("i").collect()]


# --- keyword rules against a plain loop -------------------------------------------


def plain_clean(s):
    s = re.sub(r"[^\w\s]", " ", (s or "").lower())
    return re.sub(r"\s+", " ", re.sub(r"_", " ", s)).strip()


def plain_classes(s, rules):
    t, spans, seen = plain_clean(s), [], []
    for pattern, label in rules:
        for m in re.finditer(pattern, t, re.IGNORECASE):
            a, b = m.span()
            if any(x <= a < y or x < b <= y for x, y in spans):
                continue
            spans.append((a, b))
            if label not in [k for k, _ in seen]:
                seen.append((label, pattern))
    return seen[:3]


WORDS = ("hand thin handthinning cut manual pile burn piles rx thinning without removal removed salvage broadcast prescribed fire "
         "control mastication hydroax fecon bull hog mow mx slash biomass chips crushing lop and scatter wildfire use cheat grass "
         "cheatgrass invasives weeds seeding herbicide biological oak russian olive planting feller buncher mechanical Übergröße naïve").split()


def random_texts(n):
    r = random.Random(5)
    glue = [" ", ", ", "_", "-", " / ", "  ", ". ", "\n", " é "]
    out = [None, "", "  ", "___", "Hand-Thin & PILE_BURN", "pile burn pile fuels", "thin without removing"]
    for _ in range(n):
        out.append("".join(w + r.choice(glue) for w in (r.choice(WORDS).title() if r.random() < 0.3 else r.choice(WORDS)
                                                         for _ in range(r.randint(1, 12)))))
    return out


def test_keyword_classes_match_a_plain_loop(spark):
    texts = random_texts(1500)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: r for r in keyword_classes(df, "t", KEYWORD_RULES).collect()}
    for i, t in enumerate(texts):
        want = plain_classes(t, KEYWORD_RULES) or [("UNCLASSIFIED", None)]
        row = got[i]
        have = [(row[f"ActClass_{n}"], row[f"Keyword_{n}"]) for n in (1, 2, 3) if row[f"ActClass_{n}"] is not None]
        assert have == want, t


def test_enclosing_match_is_taken_and_refused_match_takes_nothing(spark):
    rules = [("red ring", "A"), ("hot red ring hot", "B"), ("hot red", "C"), ("hot", "D")]
    df = spark.createDataFrame([(1, "hot red ring hot")], "i int, t string")
    row = keyword_classes(df, "t", rules).head()
    assert [row["ActClass_1"], row["ActClass_2"], row["ActClass_3"]] == ["A", "B", None]
    assert plain_classes("hot red ring hot", rules) == [("A", "red ring"), ("B", "hot red ring hot")]


def test_long_text_is_read_to_its_end(spark):
    df = spark.createDataFrame([(1, "word " * 40000 + "salvage")], "i int, t string")
    assert keyword_classes(df, "t", KEYWORD_RULES).head()["ActClass_1"] == "Removal"


def test_bad_rules(spark):
    with pytest.warns(UserWarning):
        assert check_rules([("(", "X"), (" a ", " L ")]) == [("a", "L")]
    with pytest.raises(ValueError):
        check_rules([("a*", "X")])
    with pytest.raises(ValueError):
        check_rules([(r"(a)\1", "X")])


def test_clean_text_like_the_plain_one(spark):
    texts = random_texts(300) + ["Naïve ÉCOLE_x² ½  z", "tab\tnew\nline", "中文、字"]
    assert text_values(spark, text.clean_text, texts) == [plain_clean(t) for t in texts]


# --- lists ----------------------------------------------------------------------------


def test_clean_list(spark):
    items = [None, "", " none ", "Unknown", "a; A; ab, b", "x,x;x", "NONE;pine; Pineapple", "  tab\t; tab"]
    got = text_values(spark, lists.clean_list, items)
    assert got == [[], [], [], [], ["ab"], ["x"], ["Pineapple"], ["tab"]]
    again = text_values(spark, lists.clean_list, ["; ".join(v) for v in got])
    assert again == got


def test_distinct_list(spark):
    got = text_values(spark, lists.distinct_list, [None, " ", "a; b; a; None", "none", "a;b; c"])
    assert got == [None, None, "a, b", None, "a;b, c"]


def test_names(spark):
    docs = ["NEPA Pending", "(PALS) Big Creek", "Big (PALS)", "  ", None, "ok"]
    assert text_values(spark, text.clean_doc_name, docs) == [None, "Big Creek", "Big (PALS)", None, None, "ok"]
    name = lambda a, b: one(spark, text.project_name(F.lit(a), F.lit(b)))
    assert name("a; b", "d") == "a, b, [NEPA] d"
    assert (name("", "d"), name("a", None), name(None, "none")) == ("[NEPA] d", "a", "Unknown")
    objective = lambda a, b, n=50: one(spark, text.objective_text(F.lit(a), F.lit(b), n))
    assert (objective(None, None), objective("x", None), objective("x; y", "y"), objective("abc", "d", 2)) == (None, "x", "x, y", "ab")
    assert one(spark, text.provenance(F.lit("https://h/f/S_X.gdb.zip"), "2024-01-02")) == "S_X.gdb 2024-01-02"


FUNDS = [("BIL", "Law (BIL)", "Federal", 0), ("REC", "Recreation, Heritage", "Federal", 1), ("A|B", "Joint", "State", 2),
         ("CONT", "Other", "Federal", 3)]


def test_fund_names_and_types(spark):
    # a lookup row without a code matches nothing
    table = small_table(spark, [*FUNDS, (None, "Nobody", "State", 4)], ["fund_code", "fund_source", "fund_type", "line_no"])
    codes = [None, "", "BIL", "ZZ", "ZZ,BIL", "A|B", " REC , CONT|BIL,BIL", " , "]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(codes)], "oid int, FUND_CODE string")
    got = [r["funding_update"] for r in funding.fund_names(df, table).orderBy("oid").collect()]
    assert got == ["No Funding Code", "No Funding Code", "Law (BIL)", "Other", "Law (BIL)", "Joint",
                   "Recreation, Heritage, Law (BIL)", ""]
    both = funding.fund_source_type(df, table, "FUND_CODE").orderBy("oid").collect()
    assert [(r["FUND_SOURCE"], r["FUND_TYPE"], r["fund_flag"]) for r in both[:5]] == [
        ("Unknown", "Unknown", False), ("Unknown", "Unknown", False), ("Law (BIL)", "Federal", False),
        ("Unknown", "Unknown", True), ("Unknown, Law (BIL)", "Unknown, Federal", True)]


def test_codes_of_rows_with_one_id(spark):
    table = small_table(spark, [("A", "S", "Federal", 0), ("A", "T", "State", 1)], ["fund_code", "fund_source", "fund_type", "line_no"])
    df = spark.createDataFrame([(1, "A"), (1, "Z,A")], "oid int, FUNDING string")
    got = sorted(r["FUND_SOURCE"] for r in funding.fund_source_type(df, table).collect())
    assert got == ["T", "Unknown, T"]


# --- lookups ---------------------------------------------------------------------------


def test_crosswalk_contract(spark):
    rows = [("k1", "first", 0), (" k1 ", "last", 1), ("k2", "", 2), ("None", "for null words", 3), ("NA", "na", 4)]
    table = small_table(spark, rows, ["key", "label", "line_no"])
    keys = ["k1", " k1", "k2", "null", None, "NA", "zz"]
    df = spark.createDataFrame([(i, k, "old") for i, k in enumerate(keys)], "i int, key string, label string")
    got = [r["label"] for r in crosswalk.crosswalk(df, table, ["key"], {"label": "label"}).orderBy("i").collect()]
    assert got == ["last", "last", "", "for null words", "for null words", "na", "old"]
    missing = crosswalk.crosswalk_unmatched(df, table, ["key"]).collect()
    assert [(r["key"], r["n_rows"]) for r in missing] == [("zz", 1)]


def test_majority_ties_and_null_words(spark):
    rows = [("a", "X"), ("a", "Y"), ("a", "SKIP"), ("a", "SKIP"), ("b", "EXCLUDE"), ("", "Z"), ("NA", "Z"), ("c", "SKIP")]
    df = spark.createDataFrame(rows, "k string, l string")
    assert {r["k"]: r["majority_label"] for r in crosswalk.majority_label(df, "k", "l").collect()} == {"a": "X", "b": "EXCLUDE"}
    after = sorted((r["k"], r["l"]) for r in crosswalk.majority_fallback(df, "k", "l").collect())
    assert after.count(("a", "X")) == 3 and ("c", "SKIP") in after


def test_route_and_redundant_delete(spark):
    rows = [(1, "DELETE", None, None, None), (2, "DELETE", "Manual", None, None), (3, "DELETE", None, None, "TREE CHECK"),
            (4, None, None, None, None), (5, "Manual", "Manual", "DELETE", None)]
    df = spark.createDataFrame(rows, "oid int, ActClass_1 string, ActClass_2 string, ActClass_3 string, ACT_CSV string")
    df = df.withColumns({f"Keyword_{n}": F.lit("k") for n in (1, 2, 3)})
    got = sorted((r["oid"], r["activity_reclass"], r["Keyword"], r["route"]) for r in classify.split_routes(df).collect())
    assert got == [(1, "DELETE", "k", "deleted"), (2, "Manual", "k", "classified"), (4, "UNCLASSIFIED", "None", "review"),
                   (5, "Manual", "k", "classified")]


def test_review_merge(spark):
    routed = spark.createDataFrame([(1, "PLANT CHECK", "review"), (2, "UNCLASSIFIED", "review"), (3, "Seed", "classified")],
                                   "oid int, activity_reclass string, route string")
    fixed = spark.createDataFrame([(1, "Plant Trees"), (3, "never")], "oid int, activity_reclass string")
    got = sorted(tuple(r) for r in review_merge(routed, fixed, ["oid"]).select("oid", "activity_reclass", "route").collect())
    assert got == [(1, "Plant Trees", "classified"), (2, "UNCLASSIFIED", "review"), (3, "Seed", "classified")]


def test_review_merge_last_correction_and_its_route(spark):
    routed = spark.createDataFrame([(i, "PLANT CHECK", "review") for i in (1, 2, 3, 4)], "oid int, activity_reclass string, route string")
    rows = [(1, "Seed", 1), (1, "Manual", 2), (2, "DELETE", 3), (3, "UNCLASSIFIED", 4), (4, None, 5)]
    fixed = spark.createDataFrame(rows, "oid int, activity_reclass string, line_no int")
    got = sorted(tuple(r) for r in review_merge(routed, fixed, ["oid"]).collect())
    assert got == [(1, "Manual", "classified"), (2, "DELETE", "deleted"), (3, "UNCLASSIFIED", "review"), (4, "PLANT CHECK", "review")]


def test_merge_keeps_rows_of_equal_ids_apart(spark):
    layers = [frame(spark, [(1, square(x, 0, 10))]).withColumns({
        "MGT_TYPE": F.lit("canopy"), "FUNDING": F.lit(code), "YEAR_COMP": F.lit(2024)}) for x, code in ((0, "A"), (1000, "B"))]
    parcels = frame(spark, [(1, square(-5, -5, 50)), (2, square(990, -5, 50))], "pid bigint").withColumn(
        "owner", F.when(F.col("pid") == 1, "West").otherwise("East"))
    funds = small_table(spark, [("A", "a", "x", 0), ("B", "b", "y", 1)], ["fund_code", "fund_source", "fund_type", "line_no"])
    out = merge_qa(layers, parcels, "owner", funds)
    assert out.columns == [*MERGED_FIELDS, "ORGID", "ERROR_FLAG", "qa_flags", "geom"]
    assert sorted((r["ORGID"], r["LANDOWNER"]) for r in out.collect()) == [(1, "West"), (2, "East")]
    assert sorted((r["LANDOWNER"], r["FUND_SOURCE"]) for r in out.collect()) == [("East", "b"), ("West", "a")]


def test_touching_triangles_do_not_overlap(spark):
    far = 1e5
    low = [[[(0.0, 0.0), (far, 0.0), (far, far / 3)]]]
    high = [[[(0.0, 0.0), (far * 0.7, far * 0.7 / 3), (far, far / 3), (0.0, far)]]]
    shape = "oid bigint, geom array<array<array<struct<x:double,y:double>>>>"
    left, right = (spark.createDataFrame([(1, g)], shape) for g in (low, high))
    pairs = overlay.overlay_acres(left, right.withColumnRenamed("oid", "pid"), ["oid", "pid"], "oid", ["pid"], far)
    assert pairs.count() == 0


def test_single_activity(spark):
    rows = [("Manual", None, "", " "), (None, None, None, None), ("Manual", "Seed", None, None), ("Odd", "", "", ""), ("  ", "", "", "")]
    df = spark.createDataFrame(rows, "CANOPY_MGT string, SURF_MGT string, RXFIRE_MGT string, REFOR_MGT string")
    got = [(r["ACTIVITY"], r["activity_error"]) for r in qa.single_activity(df).collect()]
    assert got == [("Manual", False), ("", True), ("", True), ("Odd", True), ("", True)]


def test_schema_ignores_letter_case(spark):
    df = spark.createDataFrame([(1, "n", 2.0)], "oid int, prj_name string, Shape_Len double")
    assert schema.add_fields(df, {"PRJ_NAME": "string", "AGENCY": "string"}).columns == ["oid", "prj_name", "Shape_Len", "AGENCY"]
    assert schema.prune_to(df, ["PRJ_NAME"]).columns == ["oid", "prj_name", "Shape_Len"]
    assert schema.keep_fields(df, ["PRJ_NAME"]).columns == ["oid"]


# --- polygons ---------------------------------------------------------------------------


def hole(x, y, w):
    return list(reversed(square(x, y, w)[0][0]))


def test_repair(spark):
    closed = [[ring([(0, 0), (4, 0), (4, 0), (4, 4), (0, 4), (0, 0)])]]
    clockwise = [[list(reversed(square(0, 0, 4)[0][0])), square(1, 1, 1)[0][0]]]
    flat_shell = [[ring([(0, 0), (1, 0), (2, 0)])], square(5, 5, 1)[0]]
    rows = [(1, closed), (2, clockwise), (3, flat_shell), (4, [[ring([(0, 0), (1, 1)])]]), (5, None), (6, [])]
    got = {r["oid"]: r for r in repaired(frame(spark, rows)).withColumn("a", geo.area("geom")).collect()}
    assert set(got) == {1, 2, 3}
    assert [got[i]["a"] for i in (1, 2, 3)] == [16, 15, 1]
    assert len(got[1]["geom"][0][0]) == 4
    assert one_ring(got[2]["geom"][0][0]) > 0 > one_ring(got[2]["geom"][0][1])


def one_ring(r):
    return sum(r[i]["x"] * r[(i + 1) % len(r)]["y"] - r[(i + 1) % len(r)]["x"] * r[i]["y"] for i in range(len(r))) / 2


def test_measures(spark):
    bow = [[ring([(0, 0), (2, 2), (2, 0), (0, 2)])]]
    rows = [(1, [square(4.4e6, 5e5, 10)[0] + [hole(4.4e6 + 2, 5e5 + 2, 2)]]), (2, bow), (3, square(0, 0, 3) + square(9, 9, 1))]
    got = frame(spark, rows).select("oid", geo.area("geom").alias("a"), geo.perimeter("geom").alias("p"),
                                    geo.crosses_itself("geom").alias("x"), geo.bounds("geom").alias("b")).collect()
    assert (got[0]["a"], got[0]["p"], got[0]["x"]) == (96, 48, False)
    assert got[1]["x"] is True
    assert (got[2]["a"], got[2]["b"]["xmax"]) == (10, 10)
    parts = single_parts(frame(spark, rows)).withColumn("a", geo.area("geom")).collect()
    assert len(parts) == 4 and math.isclose(sum(p["a"] for p in parts), got[0]["a"] + got[1]["a"] + got[2]["a"])
    assert len({p["oid"] for p in parts}) == 4


def test_overlap_of_general_polygons(spark):
    r = rng(3)
    a = [(i, star(r, r.uniform(-20, 20), r.uniform(-20, 20), 60)) for i in range(6)]
    a.append((6, [square(-30, -30, 60)[0] + [hole(-10, -10, 20)]]))
    left, right = frame(spark, a), frame(spark, a).withColumnRenamed("oid", "pid")

    def pairs(size):
        rows = overlay.overlay_acres(left, right, ["oid", "pid"], "oid", ["pid"], size).collect()
        return {(x["oid"], x["pid"]): x["acres"] * 4046.8564224 for x in rows}

    got = pairs(25.0)
    areas = {x["oid"]: x["a"] for x in left.select("oid", geo.area("geom").alias("a")).collect()}
    wide = pairs(1000.0)
    for (i, g), (j, h) in [(p, q) for p in a for q in a]:
        v = got.get((i, j), 0)
        assert math.isclose(v, got.get((j, i), 0), abs_tol=1e-6)
        assert math.isclose(v, wide.get((i, j), 0), abs_tol=1e-6)
        if i == j:
            assert math.isclose(v, areas[i], rel_tol=1e-9)
    for i, j in ((0, 1), (2, 6), (3, 4)):
        step, hits = 0.5, 0
        for u in range(-160, 160):
            for w in range(-160, 160):
                x, y = (u + 0.5) * step, (w + 0.5) * step
                hits += inside(a[i][1], x, y) and inside(a[j][1], x, y)
        assert math.isclose(got.get((i, j), 0), hits * step * step, rel_tol=0.02, abs_tol=5)


def test_owner_tie_and_no_parcel(spark):
    features = frame(spark, [(1, square(5, 0, 10)), (2, square(500, 500, 10))]).withColumn("LANDOWNER", F.lit("was"))
    parcels = frame(spark, [(1, square(0, 0, 10)), (2, square(10, 0, 10))]).withColumn(
        "owner", F.when(F.col("oid") == 1, "Zed").otherwise("Abe")).drop("oid")
    got = {r["oid"]: r["LANDOWNER"] for r in overlay.majority_owner(features, parcels, "oid", "owner", 7.0).collect()}
    assert got == {1: "Abe", 2: "was"}


def test_projection(spark):
    df = frame(spark, [(1, [[ring([(-105, 39), (-105.5, 39.5), (-104, 40)])]])]).withColumn("srid", F.lit(4269))
    v = df.select(geo.reproject("geom", "srid").alias("g")).head()["g"][0][0]
    assert math.isclose(v[0]["x"], 500000, abs_tol=1e-6) and math.isclose(v[0]["y"], 4316777.6, abs_tol=20)
    same = df.withColumn("srid", F.lit(26913)).select(geo.reproject("geom", "srid").alias("g")).head()["g"]
    assert same[0][0][0]["x"] == -105
    with pytest.raises(Exception):
        df.withColumn("srid", F.lit(1)).select(geo.reproject("geom", "srid")).collect()
