"""URL filters: pattern rules that are fetched by their rarest literal token.  No Python runs on the rows."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from treatflow.llm.common import LOWER, UPPER, ascii_lower, join_counted, without
from treatflow.session import broadcast_if_small, cut_lineage

TOKEN = "[a-z0-9]+"
SPREAD = 256
RULE_SCHEMA = "rule string, action string, tier int, pattern string, literals array<string>"


def host_rule(rule: str, action: str) -> tuple:
    """A rule ``host/path``: it fits the host and its subdomains if the URL's path starts with the path."""
    host, _, path = rule.partition("/")
    text = host.translate(str.maketrans(UPPER, LOWER)) + "/" + path
    # a token is literal if the rule itself ends it; the path's last one may go on in a URL
    whole = re.findall(TOKEN + "(?=[^a-z0-9])", text) if re.fullmatch("[\x00-\x7f]*", text) else []
    return rule, action, 1, r"^(?:[^/]*\.)?" + _escaped(text), _lower_only(whole, text)


def token_rule(name: str, words: str, action: str = "block") -> tuple:
    """A rule of the method itself: the given tokens follow one another in the host."""
    tokens = words.split()
    return name, action, 0, "^(?:[^/]*[^/a-z0-9])?" + "[^/a-z0-9]".join(tokens) + "(?:[^a-z0-9]|$)", tokens


def _escaped(text: str) -> str:
    return "".join("\\" + c if c in r"\.[]{}()*+?^$|-&#~" else c for c in text)


def _lower_only(tokens: Sequence[str], text: str) -> list[str]:
    # tokens are cut from lower-cased URLs, so pieces beside capitals of a path are no tokens of their own
    return [t for t in tokens if re.search(f"(?<![A-Za-z0-9]){t}(?![A-Za-z0-9])", text)]


def rule_table(spark: SparkSession, rules: Sequence[tuple]) -> DataFrame:
    """Rules of a program as a table; larger lists come as a table of these columns."""
    quote = lambda v: "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    rows = [f"({quote(r)}, {quote(a)}, {t}, {quote(p)}, cast(array({', '.join(map(quote, ls))}) as array<string>))"
            for r, a, t, p, ls in rules]
    if not rows:
        return spark.createDataFrame([], RULE_SCHEMA)
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS rules(rule, action, tier, pattern, literals)")


def _mark(number: Column) -> Column:
    """A token that no URL has."""
    return F.concat(F.lit("#"), number.cast("string"))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, lower-cased; empty without ``://``."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict``.

    Rules of tier 1 give ``rule`` and verdict, the longest first, then ``block`` before ``allow``, then by
    text.  Where none fits, the method's own rules (tier 0) give the verdict, and ``default`` otherwise.
    A rule is filed under the one of its literal tokens that is rarest in the URLs at hand; a rule that has
    none is filed under each of ``SPREAD`` marks, of which every URL has one by its hash.  URLs fetch rules
    by equal tokens, and only those pairs run a regular expression.  Distinct addresses are judged, so a URL
    of very many rows counts once, and a hot one gets its verdict by broadcast.  Null URLs, and those without
    ``://``, have empty host and path.  Columns of the result's names are replaced, other
    columns and repeated rows stay, and an empty table gives an empty one.
    """
    parsed = without(pages, "host", "path", "rule", "verdict").withColumns(
        {"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    address = F.concat("host", "path")
    addresses = parsed.groupBy(address.alias("__a")).agg(F.count(F.lit(1)).alias("__rows"))

    listed = addresses.select("__a", F.explode(F.array_union(
        F.regexp_extract_all(ascii_lower(F.col("__a")), F.lit(f"({TOKEN})"), 1), F.array(_mark(F.pmod(F.xxhash64("__a"), F.lit(SPREAD)))))).alias("__t"))
    literals = rules.select(F.explode("literals").alias("__t")).distinct()
    counts = listed.join(broadcast_if_small(literals), "__t").groupBy("__t").agg(F.count(F.lit(1)).alias("__n"))
    filed = rules.select("*", F.explode_outer("literals").alias("__t")).join(counts, "__t", "left").groupBy(
        "rule", "action", "tier", "pattern"
    ).agg(F.min(F.struct(F.coalesce("__n", F.lit(0)).alias("n"), "__t"))["__t"].alias("__one")).select(
        "rule", "action", "tier", "pattern", F.explode(F.when(F.col("__one").isNotNull(), F.array("__one")).otherwise(
            F.transform(F.sequence(F.lit(0), F.lit(SPREAD - 1)), _mark))).alias("__t"))
    fits = listed.join(broadcast_if_small(filed), "__t").filter(F.expr("rlike(__a, pattern)"))
    rank = F.struct("tier", F.length("rule").alias("size"), (F.col("action") == "block").alias("block"))
    # of equal rules the smallest text: kept by a second key
    best = fits.groupBy("__a").agg(F.max(rank).alias("__top"), F.collect_set(
        F.struct(rank.alias("rank"), "rule", "action")).alias("__all")).select(
        "__a", F.array_min(F.expr("transform(filter(__all, x -> x.rank = __top), x -> struct(x.rule AS rule, x.action AS action))")).alias("__best"),
        F.col("__top.tier").alias("__tier"))
    judged = cut_lineage(addresses.join(best, "__a", "left").select(
        "__a", "__rows", F.when(F.col("__tier") == 1, F.col("__best.rule")).alias("rule"),
        F.coalesce(F.col("__best.action"), F.lit(default)).alias("verdict")))
    # most addresses have one row, so only the hot ones are worth a broadcast
    return join_counted(parsed.withColumn("__a", address), judged, "__a", "__rows", limit=0).drop("__a", "__rows")
