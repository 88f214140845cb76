"""Operators whose cost must not grow with the square of their input, and what flows do without input."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tests.shapes import frame, square
from treatflow.functions import keywords
from treatflow.operators import crosswalk, overlay, schema
from treatflow.operators.counts import StepCounts
from treatflow.plans import flows
from treatflow.session import small_table
from treatflow.sources import readers, writers


def saw(n, y, up):
    """A polygon of 2 n + 2 vertices: teeth on one side."""
    teeth = [(i, y + up * (1 + (i * 7919 % 13) / 13)) for i in range(n, -1, -1)]
    return [[[{"x": float(a), "y": float(b)} for a, b in [(0, y), (n, y), *teeth]]]]


def test_overlay_of_long_outlines_multiplies_neighbouring_edges_only(spark):
    """Pairs of edges grow with the number of edges."""
    made = {}
    for n in (500, 2000):
        left, right = frame(spark, [(1, saw(n, 0.0, 5.0))]), frame(spark, [(7, saw(n, 1.0, 4.0))], "pid bigint")
        pieces = overlay.overlap_pieces(left, ["oid"], right, ["pid"], 10.0)
        made[n] = pieces.count()
        # the lower polygon of height 5 to 10 holds a part of the upper one, by a sum over unit strips
        strips = lambda y, up: [y + up * (1 + (i * 7919 % 13) / 13) for i in range(n + 1)]
        a, b = strips(0.0, 5.0), strips(1.0, 4.0)
        area = 0.0
        for i in range(n):
            for k in range(200):
                t = (k + 0.5) / 200
                area += max(0.0, min(a[i] + t * (a[i + 1] - a[i]), b[i] + t * (b[i + 1] - b[i])) - 1.0) / 200
        assert pieces.agg(F.sum("piece")).head()[0] == pytest.approx(area, rel=1e-4)
    assert made[2000] < 6 * made[500] and made[2000] < 2000 * 200


def test_a_statewide_polygon_takes_few_cells(spark):
    big, small = square(0, 0, 1_000_000), [square(10 * i, 5 * i, 3) for i in range(200)]
    rows = frame(spark, [(1, big), *[(10 + i, s) for i, s in enumerate(small)]])
    staged = overlay._staged(rows, ["oid"], "geom", 4.0, "p")
    cells = overlay.level_cells(staged, "p", 4.0, F.array("levelp")).groupBy("oid").count()
    assert cells.agg(F.max("count")).head()[0] <= 4
    found = overlay.overlay_acres(rows, rows.withColumnRenamed("oid", "pid"), ["oid", "pid"], "oid", ["pid"], 4.0)
    pairs = {(r["oid"], r["pid"]) for r in found.collect()}
    assert pairs == {(1, 1)} | {(i, i) for i in range(10, 210)} | {(1, i) for i in range(10, 210)} | {(i, 1) for i in range(10, 210)}


def plain_rules(text, rules):
    taken, won = [], []
    import re

    for i, (pattern, _) in enumerate(rules):
        for m in re.finditer(pattern, text):
            if any(s <= m.start() < e or s < m.end() <= e for s, e in taken):
                continue
            taken.append(m.span())
            won.append(i)
    return list(dict.fromkeys(won))


def test_keyword_fold_equals_plain_loop_on_dense_texts(spark):
    """Matches that hold earlier ones, touch them and lie in them."""
    rules = [("bb", "A"), ("abba", "B"), ("a", "C"), ("c+", "D"), ("bcb", "E"), ("[abc]{5}", "F"), ("ca", "G")]
    r = random.Random(8)
    texts = ["".join(r.choice("abc ") for _ in range(r.randint(0, 60))) for _ in range(300)]
    spans = ", ".join(keywords.rule_spans("t", p) for p, _ in rules)
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {x["i"]: x["won"] for x in df.select("i", F.expr(keywords.accepted_rules(f"array({spans})")).alias("won")).collect()}
    assert got == {i: plain_rules(t, rules) for i, t in enumerate(texts)}


def test_keyword_time_grows_with_the_text(spark):
    seconds = {}
    for n in (4000, 16_000):
        df = small_table(spark, [("thin pile burn mow removal " * n,)], ["t"])
        classed = keywords.keyword_classes(df, "t", [("thin", "A"), ("pile", "B"), ("burn", "C"), ("n p", "D"), ("mow", "E")])
        classed.collect()
        start = time.perf_counter()
        classed.collect()
        seconds[n] = time.perf_counter() - start
    assert seconds[16_000] < 8 * seconds[4000] + 1


def test_code_dictionary_broadcast_and_salted(spark, monkeypatch):
    lookup = small_table(spark, [("A", "a", 0), ("B", "b", 1), ("A", "aa", 2)], ["fund_code", "fund_source", "line_no"])
    rows = [(i, ["A", "B"] if i % 3 else ["B", "?"]) for i in range(60)] + [(100, None), (101, [])]
    df = spark.createDataFrame(rows, "i int, codes array<string>").repartition(4)
    resolve = lambda: crosswalk.resolve_codes(df, "codes", lookup, "fund_code", ["fund_source"])
    text = resolve()._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    plain = lambda out: {r["i"]: None if r["codes"] is None else [v and v["fund_source"] for v in r["codes"]] for r in out.collect()}
    small = plain(resolve())
    assert small == {i: None if c is None else [{"A": "aa", "B": "b"}.get(x) for x in c] for i, c in rows}
    monkeypatch.setattr(crosswalk, "BROADCAST_LIMIT_BYTES", 0)
    assert plain(resolve()) == small and "__salt" in resolve()._jdf.queryExecution().toString()


def test_numbers_are_the_same_on_replay(spark):
    rows = [(i % 3, i // 2, f"t{i}") for i in range(200)] + [(None, 5, "x"), (0, None, "y"), (1, 1, "same"), (1, 1, "same")]
    numbered = []
    for parts in (1, 7):
        df = spark.createDataFrame(rows, "layer int, oid long, t string").repartition(parts)
        numbered.append(sorted(map(str, schema.number_rows(df, ["layer", "oid"], "n").collect())))
    assert numbered[0] == numbered[1]
    out = schema.number_rows(spark.createDataFrame(rows, "layer int, oid long, t string"), ["layer", "oid"], "n").collect()
    assert sorted(r["n"] for r in out) == list(range(1, len(rows) + 1))
    key = lambda r: (r["layer"] is not None, r["layer"] or 0, r["oid"] is not None, r["oid"] or 0)
    ordered = sorted(out, key=lambda r: r["n"])
    assert [key(r) for r in ordered] == sorted(map(key, out))
    assert schema.number_rows(spark.createDataFrame([], "layer int, oid long"), ["layer", "oid"], "n").count() == 0


def test_merges_without_layers_are_typed_tables(spark):
    empty = readers.merge_layers([], {"oid": "bigint", "NAME": "string"})
    assert empty.dtypes == [("oid", "bigint"), ("NAME", "string")] and empty.count() == 0
    with pytest.raises(ValueError):
        readers.merge_layers([])
    typed = readers.merge_layers([spark.createDataFrame([("7",)], "oid string")], {"oid": "bigint", "NAME": "string"})
    assert [tuple(r) for r in typed.collect()] == [(7, None)]
    lookup = small_table(spark, [("x", "Manual", 0)], ["ACTIVITY", "reclass", "line_no"])
    funds = small_table(spark, [("A", "a", "x", 0)], ["fund_code", "fund_source", "fund_type", "line_no"])
    out = flows.crosswalk_flow({}, {}, "CO", [(lookup, "ACTIVITY", "reclass", "ACTIVITY")], funds, "2024-05-06", "me")
    assert out.count() == 0 and {"ACTIVITY", "UNRESOLVED", "geom"} <= set(out.columns)
    parcels = frame(spark, [(1, square(0, 0, 5))], "pid bigint").withColumn("owner", F.lit("o"))
    assert flows.merge_qa([], parcels, "owner", funds).count() == 0


def test_counts_ride_on_the_write(spark, tmp_path):
    counts = StepCounts()
    df = counts.step(spark.range(100), "all")
    df = counts.parts(df.filter("id >= 40"), {"even": F.col("id") % 2 == 0, "odd": F.col("id") % 2 == 1})
    plan = df._jdf.queryExecution().toString()
    assert plan.split("== Physical Plan ==")[1].count("Range") == 1
    assert writers.write_layer(df, str(tmp_path / "x")) == 60
    assert counts.rows() == [(1, "all", 100), (2, "even", 30), (3, "odd", 30)]
    assert writers.write_layer(df.limit(0), str(tmp_path / "x")) == 0
    routed = spark.range(9).withColumn("route", F.when(F.col("id") < 4, "review").otherwise("deleted"))
    assert writers.write_routes(routed, str(tmp_path / "r")) == {"deleted": 5, "review": 4, "classified": 0}


def test_label_lint(spark):
    table = small_table(spark, [(v,) for v in ("MANUAL", "Manual", " Odd ", "SKIP", "", "DELETE", "Odd")], ["reclass"])
    assert {tuple(r) for r in crosswalk.label_lint(table, "reclass").collect()} == {("MANUAL", 1, "Manual"), ("Odd", 2, None)}
