"""Ordered keyword rules over cleaned text, without a Python UDF.

Every rule lists its matches in a text as ``(start, end)`` spans.  Rules are taken in order; a
match counts unless its start or its end lies in a span that an earlier rule has taken.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Sequence
from re import _constants as parts
from re import _parser as parser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treatflow.functions.text import clean_text

SPANS = "array<struct<s:int,e:int>>"
# letters other than a-z that a pattern's a-z match when case is ignored
FOLDED = "\u0130\u0131\u017f\u212a"
FEW_SPANS = 8    # up to so many are looked at one by one


def check_rules(rules: Sequence[tuple[str, str]]) -> list[tuple[str, str]]:
    """Trimmed rules in order; a pattern that does not compile is left out with a warning.

    Patterns that match empty text are refused: they have no span to take.
    """
    kept = []
    for pattern, label in rules:
        pattern, label = pattern.strip(), label.strip()
        try:
            empty = re.compile(pattern, re.IGNORECASE).match("")
        except re.error as problem:
            warnings.warn(f"rule left out, bad pattern {pattern!r}: {problem}", stacklevel=2)
            continue
        if empty:
            raise ValueError(f"rule matches empty text: {pattern!r}")
        if re.search(r"\\[1-9]", pattern):
            raise ValueError(f"rule refers back to a group: {pattern!r}")
        kept.append((pattern, label))
    return kept


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _needed(sequence) -> list[str]:
    """Plain texts, a-z in lower case, one of which every match holds; none when that cannot be told."""
    choices, run = [], ""
    for kind, value in [*sequence, (None, None)]:
        if kind is parts.LITERAL and chr(value).isascii():
            run += chr(value).lower()
            continue
        choices.append([run] if run else [])
        run = ""
        if kind is parts.SUBPATTERN:
            choices.append(_needed(value[-1]))
        elif kind is parts.BRANCH:
            each = [_needed(branch) for branch in value[1]]
            choices.append([t for texts in each for t in texts] if all(each) else [])
        elif kind in (parts.MAX_REPEAT, parts.MIN_REPEAT) and value[0] > 0:
            choices.append(_needed(value[2]))
    return max(choices, key=lambda texts: min(map(len, texts), default=0))


def may_match(text: str, pattern: str) -> str:
    """SQL test that only a lower-case text without a match of the pattern can fail."""
    texts = list(dict.fromkeys([*_needed(parser.parse(pattern, re.IGNORECASE)), *FOLDED]))
    if len(texts) == len(FOLDED):
        return "true"
    return "(" + " or ".join(f"contains({text}, {_literal(t)})" for t in texts) + ")"


def rule_spans(text: str, pattern: str) -> str:
    """Spans of all matches, as SQL text: gaps before matches and matches, walked left to right."""
    # group 1 is the gap since the match before, where \G holds the search; compiled once per task
    stepped = _literal(rf"(?iU)\G((?s:.*?))(?:{pattern})")
    # without empty matches a plain search finds the same ones, and faster
    plain = parser.parse(pattern, re.IGNORECASE).getwidth()[0] > 0
    lengths = lambda found, group: f"transform(regexp_extract_all({text}, {found}, {group}), m -> length(m))"
    if plain:
        steps = f"zip_with({lengths(stepped, 1)}, {lengths(_literal(f'(?iU)(?:{pattern})'), 0)}, (g, n) -> named_struct('n', n, 'e', g + n))"
    else:
        steps = f"zip_with({lengths(stepped, 1)}, {lengths(stepped, 0)}, (g, w) -> named_struct('n', w - g, 'e', w))"
    # ends are running sums, by adding what stands 1, 2, 4, ... places before
    behind = "coalesce(get(acc, i - int(shiftleft(1, k))).e, 0)"
    added = f"transform(acc, (v, i) -> named_struct('n', v.n, 'e', v.e + {behind}))"
    walk = (
        f"aggregate(array({steps}), cast(array() as {SPANS}), (none, w) -> aggregate(sequence(0, int(log2(greatest(size(w), 1)))), w, "
        f"(acc, k) -> {added}, acc -> transform(acc, v -> named_struct('s', v.e - v.n, 'e', v.e))))"
    )
    # most rules do not occur in most texts, so the walk is behind a plain search
    return f"if(rlike({text}, {_literal('(?iU)' + pattern)}), {walk}, cast(array() as {SPANS}))"


def _lies_in(at: str, spans: str) -> str:
    """Whether a place lies in one of the spans, which are sorted and do not overlap; among many by bisection."""
    middle = "int((b.lo + b.hi) div 2)"
    halved = (f"if(b.lo >= b.hi, b, if(get({spans}, {middle}).s <= {at}, named_struct('lo', {middle} + 1, 'hi', b.hi), "
              f"named_struct('lo', b.lo, 'hi', {middle})))")
    bisected = (f"aggregate(sequence(0, int(log2(greatest(size({spans}), 1)))), "
                f"named_struct('lo', 0, 'hi', size({spans})), (b, k) -> {halved}, b -> coalesce(get({spans}, b.lo - 1).e > {at}, false))")
    return f"if(size({spans}) <= {FEW_SPANS}, exists({spans}, h -> h.s <= {at} and {at} < h.e), {bisected})"


def accepted_rules(spans_by_rule: str) -> str:
    """Positions of the rules with at least one match that counts, as SQL text.

    What is taken is kept as sorted spans that do not overlap: a match that counts either holds a taken span whole, which
    it then replaces, or meets none.
    """
    matched = f"filter(transform({spans_by_rule}, (spans, i) -> named_struct('rule', i, 'spans', spans)), r -> size(r.spans) > 0)"
    free = (f"if(size(acc.taken) = 0, r.spans, filter(r.spans, m -> not {_lies_in('m.s', 'acc.taken')} "
            f"and not {_lies_in('m.e - 1', 'acc.taken')}))")
    outside = f"filter(x.taken, t -> not {_lies_in('t.s', 'free')})"
    taken = (
        f"if(size(free) = 0, x, named_struct('taken', if(size(x.taken) = 0, free, sort_array(concat({outside}, free))), "
        "'won', array_append(x.won, r.rule)))"
    )
    # an array of one binds the free spans, which are looked at three times
    step = f"aggregate(array({free}), acc, (x, free) -> {taken})"
    zero = f"named_struct('taken', cast(array() as {SPANS}), 'won', cast(array() as array<int>))"
    return f"aggregate({matched}, {zero}, (acc, r) -> {step}, acc -> acc.won)"


def keyword_classes(
    df: DataFrame, text: str, rules: Sequence[tuple[str, str]], top: int = 3, unclassified: str = "UNCLASSIFIED"
) -> DataFrame:
    """Add ``ActClass_1..top`` and ``Keyword_1..top``: the first labels in rule order with their patterns."""
    rules = check_rules(rules)
    names = list(dict.fromkeys(label for _, label in rules))
    cleaned = df.withColumn("__clean", clean_text(F.col(text)))
    # a search for plain words is much faster than one by a pattern
    none = f"cast(array() as {SPANS})"
    spans = ", ".join(f"if({may_match('__clean', p)}, {rule_spans('__clean', p)}, {none})" for p, _ in rules)
    won = cleaned.withColumn("__won", F.expr(accepted_rules(f"array({spans})"))).drop("__clean")
    # rule -> number of its label; the first rule of every label stays, in rule order
    label_of = F.array(*[F.lit(names.index(label)) for _, label in rules])
    found = won.withColumn("__label", label_of).withColumn(
        "__won",
        F.expr(
            "slice(filter(__won, (r, i) -> "
            f"array_position(transform(__won, q -> get(__label, q)), get(__label, r)) = i + 1), 1, {top})"
        ),
    )
    labels = F.array(*[F.lit(label) for _, label in rules])
    patterns = F.array(*[F.lit(pattern) for pattern, _ in rules])
    columns = {}
    for n in range(top):
        rule = F.get("__won", F.lit(n))
        label = F.get(labels, rule)
        columns[f"ActClass_{n + 1}"] = F.coalesce(label, F.lit(unclassified)) if n == 0 else label
        columns[f"Keyword_{n + 1}"] = F.get(patterns, rule)
    return found.withColumns(columns).drop("__won", "__label")
