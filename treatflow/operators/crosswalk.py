"""Lookup joins: single and composite keys, tiers, code lists and the majority fallback."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treatflow.fixed_values import (
    ACTIVITY_MAP, CSV_NULL_WORDS, DELETE, EXCLUDE, KEY_NULL_WORDS, REVIEW_LABELS, SKIP, SWEEP_METHODS,
)
from treatflow.functions.strings import key_part, strip
from treatflow.session import BROADCAST_LIMIT_BYTES, broadcast_if_small, cut_lineage, estimated_bytes

LOOKUP_ROWS_LIMIT = 10_000
SALTS = 32


def prepare_lookup(lookup: DataFrame, keys: Sequence[str], outputs: Sequence[str]) -> DataFrame:
    """One row per cleaned key; the last of several lookup rows wins (``line_no`` is the row order)."""
    cleaned = [key_part(F.col(k), KEY_NULL_WORDS).alias(f"__k{i}") for i, k in enumerate(keys)]
    last = [F.max_by(F.col(o), F.col("line_no")).alias(f"__v{i}") for i, o in enumerate(outputs)]
    return lookup.groupBy(*cleaned).agg(*last, F.lit(True).alias("__hit"))


def _matched(df: DataFrame, lookup: DataFrame, keys: Sequence[str], lookup_keys: Sequence[str],
             outputs: Sequence[str], tag: str) -> DataFrame:
    """Left join under tagged names, so several lookups can be joined in one pass."""
    small = broadcast_if_small(prepare_lookup(lookup, lookup_keys, outputs))
    small = small.toDF(*[c + tag for c in small.columns])
    parts = {f"__p{i}{tag}": key_part(F.col(k), KEY_NULL_WORDS) for i, k in enumerate(keys)}
    on = reduce(
        lambda a, b: a & b, [F.col(f"__p{i}{tag}") == F.col(f"__k{i}{tag}") for i in range(len(keys))]
    )
    return df.withColumns(parts).join(small, on, "left")


def _without_temporaries(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("__")])


def crosswalk(df: DataFrame, lookup: DataFrame, keys: Sequence[str], outputs: Mapping[str, str],
              lookup_keys: Sequence[str] | None = None) -> DataFrame:
    """Left lookup; a match overwrites, even with blank, and no match leaves the old value.

    ``outputs`` maps lookup columns to target columns, which are added when missing.
    """
    names = list(outputs)
    joined = _matched(df, lookup, keys, lookup_keys or keys, names, "")
    hit = F.coalesce(F.col("__hit"), F.lit(False))
    new = {}
    for i, name in enumerate(names):
        target = outputs[name]
        old = F.col(target) if target in df.columns else F.lit(None).cast("string")
        new[target] = F.when(hit, F.col(f"__v{i}")).otherwise(old)
    return _without_temporaries(joined.withColumns(new))


def tiered_crosswalk(df: DataFrame, tiers: Sequence[tuple[DataFrame, str, str, str]], target: str,
                     method: str = "METHOD") -> DataFrame:
    """First tier on all rows; each later tier, then the method sweep, only where the label is ``SKIP``.

    A tier is (lookup, lookup key, lookup label, column).  All tiers are joined in one pass.
    """
    joined = df
    label = F.lit(None).cast("string")
    for n, (lookup, key, value, column) in enumerate(tiers):
        joined = _matched(joined, lookup, [column], [key], [value], f"_{n}")
        hit = F.coalesce(F.col(f"__hit_{n}"), F.lit(False))
        applies = hit if n == 0 else hit & F.coalesce(label == SKIP, F.lit(False))
        label = F.when(applies, F.col(f"__v0_{n}")).otherwise(label)
    if method in df.columns:
        label = F.when((label == SKIP) & F.col(method).isin(SWEEP_METHODS), F.col(method)).otherwise(label)
    return _without_temporaries(joined.withColumn(target, label))


def majority_label(df: DataFrame, key: str, label: str) -> DataFrame:
    """Most common label per key, ``SKIP`` left out; the smallest label wins a tie.

    Counted per (key, label) first, so a key with very many rows costs one row per task.
    """
    counted = (
        df.filter((F.col(label) != SKIP) & ~F.col(key).isin(CSV_NULL_WORDS) & ~F.col(label).isin(CSV_NULL_WORDS))
        .groupBy(key, label)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.groupBy(key).agg(F.min_by(label, F.struct(-F.col("n"), F.col(label))).alias("majority_label"))


def majority_fallback(df: DataFrame, key: str, label: str) -> DataFrame:
    """Rows still on ``SKIP`` take the majority label of their key.

    The majority table has one row per key; it is written out once, so its size is known
    before it is broadcast.
    """
    majority = cut_lineage(majority_label(df, key, label).withColumnRenamed(key, "__key"))
    if majority.count() <= LOOKUP_ROWS_LIMIT:
        majority = F.broadcast(majority)
    joined = df.join(majority, F.col(key) == F.col("__key"), "left")
    new = F.when(F.col(label) == SKIP, F.coalesce(F.col("majority_label"), F.col(label))).otherwise(F.col(label))
    return joined.withColumn(label, new).drop("__key", "majority_label")


def crosswalk_unmatched(df: DataFrame, lookup: DataFrame, keys: Sequence[str],
                        lookup_keys: Sequence[str] | None = None) -> DataFrame:
    """Keys with content that the lookup does not have, with their row counts."""
    cleaned = [key_part(F.col(k), KEY_NULL_WORDS).alias(k) for k in keys]
    counts = df.groupBy(*cleaned).agg(F.count(F.lit(1)).alias("n_rows"))
    content = reduce(lambda a, b: a | b, [F.col(k) != "" for k in keys])
    known = prepare_lookup(lookup, lookup_keys or keys, [])
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__k{i}") for i, k in enumerate(keys)])
    return counts.filter(content).join(broadcast_if_small(known), on, "left_anti")


def activity_to_type(df: DataFrame, label: str = "activity_reclass") -> DataFrame:
    """ACTIVITY and MGT_TYPE from the label; labels outside the map leave both as they were."""
    key = strip(F.col(label))
    activity = F.create_map(*[F.lit(v) for k, (a, _) in ACTIVITY_MAP.items() for v in (k, a)])
    mgt_type = F.create_map(*[F.lit(v) for k, (_, m) in ACTIVITY_MAP.items() for v in (k, m)])
    return df.withColumns(
        {
            "ACTIVITY": F.coalesce(F.try_element_at(activity, key), F.col("ACTIVITY")),
            "MGT_TYPE": F.coalesce(F.try_element_at(mgt_type, key), F.col("MGT_TYPE")),
        }
    )


def resolve_codes(df: DataFrame, codes: str, lookup: DataFrame, code: str, values: Sequence[str]) -> DataFrame:
    """Replace an array of codes by an array of structs of the lookup's values, in order.

    Every distinct array is resolved once, by a join of its codes with the lookup; this dictionary is written, so its size
    is known.  Below the limit it is broadcast and no row of ``df`` moves.  Above, rows and dictionary are spread by salt, so
    a list that very many rows hold is no hot key.  An unknown code gives a null, a lookup row without a code matches nothing,
    and of a repeated code the last row wins.
    """
    unique = lookup.groupBy(F.col(code).alias("__code")).agg(
        F.max_by(F.struct(*[F.col(v).alias(v) for v in values]), "line_no").alias("__value")
    )
    wanted = df.select(F.col(codes).alias("__codes_key")).filter(F.size("__codes_key") > 0).distinct()
    exploded = wanted.select("__codes_key", F.posexplode("__codes_key").alias("__pos", "__code"))
    dictionary = cut_lineage(
        exploded.join(broadcast_if_small(unique), "__code", "left")
        .groupBy("__codes_key")
        .agg(F.array_sort(F.collect_list(F.struct("__pos", "__value"))).alias("__list"))
        .select("__codes_key", F.transform("__list", lambda s: s["__value"]).alias("__values"))
    )
    same = F.col(codes) == F.col("__codes_key")
    if estimated_bytes(dictionary) <= BROADCAST_LIMIT_BYTES:
        joined = df.join(F.broadcast(dictionary), same, "left")
    else:
        spread = dictionary.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = df.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
        joined = salted.join(spread, same & (F.col("__salt") == F.col("__copy")), "left").drop("__salt", "__copy")
    kind = dictionary.schema["__values"].dataType
    filled = F.coalesce(F.col("__values"), F.array().cast(kind))
    return joined.withColumn(codes, F.when(F.col(codes).isNotNull(), filled)).drop("__codes_key", "__values")


def label_lint(lookup: DataFrame, label: str, known: Sequence[str] = tuple(ACTIVITY_MAP)) -> DataFrame:
    """Labels of a lookup or table that the activity map lacks: ``label``, its rows and the known label that ``differs_in_case``.

    Blank labels and the words that steer a flow are no labels of activities.
    """
    words = [SKIP, EXCLUDE, DELETE, *REVIEW_LABELS]
    text = strip(F.col(label))
    counted = lookup.filter((F.coalesce(text, F.lit("")) != "") & ~text.isin([*words, *known])).groupBy(text.alias("label")).agg(
        F.count(F.lit(1)).alias("n_rows"))
    by_case = F.create_map(*[F.lit(v) for k in known for v in (k.lower(), k)])
    return counted.withColumn("differs_in_case", F.try_element_at(by_case, F.lower("label")))
