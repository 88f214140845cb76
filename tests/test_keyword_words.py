"""Words of a rule are looked for before its pattern."""

import random

from pyspark.sql import functions as F

from treatflow.functions import keywords

PATTERNS = ["red widget", "(?:^| )the(?: |$)", "[^ ]+ ring", "gizmo|licen[sc]e", r"\bchip\w*\b", r"(?:thin(?:ning)?){1,2} x?kiss", r"\w+", "a|\\d+"]


def test_words_of_patterns():
    words = lambda p: keywords.may_match("t", p)
    assert "contains(t, ' ring')" in words("[^ ]+ ring")
    assert "contains(t, 'gizmo') or contains(t, 'licen')" in words("gizmo|licen[sc]e")
    # an optional part is in no rule's words, and a pattern without plain text may match anywhere
    assert "'x" not in words(PATTERNS[5]) and words(r"\w+") == words("a|\\d+") == "true"


def test_no_match_is_lost(spark):
    rand = random.Random(5)
    pieces = ["red", "widget", " ", "the", "ring", "gizmo", "license", "chips", "thin", "thinning", "kiss", "x", "7", "a",
              "gızmo", "kiſſ", "lıcenſe", "Kiss", "rİng"]
    rows = [(i, "".join(rand.choice(pieces) for _ in range(rand.randrange(9)))) for i in range(400)]
    tests = [F.expr(f"rlike(t, {keywords._literal('(?iU)' + p)}) and not {keywords.may_match('t', p)}").alias(f"p{i}")
             for i, p in enumerate(PATTERNS)]
    lost = spark.createDataFrame(rows, "i int, t string").select(*tests).collect()
    assert not any(any(row) for row in lost)
