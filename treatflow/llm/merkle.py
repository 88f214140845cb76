"""Merkle manifest of a dataset: one tree per source over its rows, one tree over the sources, and proofs of rows.

Leaves are ranked in a range-partitioned table.  Each level of nodes is one aggregation of at most 16 children and is
written as records of a digest and its children, a store that is addressed by content.  A proof is found by descent: a
request starts at the root, looks up the children of the digest it holds, goes on with the one that the next
base-16 digit of its leaf's rank selects, and keeps the others; reversed, these segments lead from the leaf to the
root.  Requests that share the first digits travel as one row and part only where their digits differ.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from treatflow.session import broadcast_if_small, cut_lineage

BITS = 4
FAN = 1 << BITS
PATH = "array<struct<pos:int,others:array<string>>>"


def digest(*inputs: Column) -> Column:
    """Lowercase hex SHA-256 of the concatenated UTF-8 texts."""
    return F.sha2(F.concat(*inputs).cast("binary"), 256)


def encoded(column: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value as text."""
    value = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(columns: Sequence[Column]) -> Column:
    return digest(*[encoded(c) for c in columns])


def ranked(leaves: DataFrame, order: Sequence[str]) -> DataFrame:
    """``leaves`` with ``rank`` within ``tree`` by ``order``, from 0, and the tree's ``size``.

    The rows are range-partitioned, so a tree of very many rows spans many tasks, as do equal rows; a row's rank is
    its place in its partition on top of the tree's rows in earlier ones.
    """
    sort = ["tree", *order]
    # equal rows are told apart by where they were read, so that they need not meet in one task
    spread = leaves.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(*sort, "__tie")
    placed = cut_lineage(spread.sortWithinPartitions(*sort, "__tie").drop("__tie").withColumns(
        {"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id()}))
    parts = placed.groupBy("tree", "__part").agg(F.min("__at").alias("__from"), F.count(F.lit(1)).alias("__n"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per tree and partition
    offsets = parts.select("tree", "__part", "__from", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
                           F.sum("__n").over(whole).alias("size"))
    joined = placed.join(broadcast_if_small(cut_lineage(offsets)), ["tree", "__part"])
    return joined.withColumn("rank", F.col("__at") - F.col("__from") + F.col("__before")).drop(
        "__part", "__at", "__from", "__before")


def height(size: int) -> int:
    """Levels of nodes above ``size`` leaves."""
    levels = 0
    while size > 1:
        size, levels = -(-size // FAN), levels + 1
    return levels


def _levels(size: Column, highest: int) -> Column:
    """``height`` of a column, for sizes that need at most ``highest`` levels."""
    return sum((F.when(size > F.lit(FAN**k), 1).otherwise(0) for k in range(highest)), F.lit(0))


def grown(leaves: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(roots, records by level) of ranked ``leaves`` (tree, rank, size, digest).

    ``roots`` has (tree, size, digest); a lone leaf is its tree's root.  Records are (digest, children), equal nodes
    once; the list starts with those whose children are leaves.
    """
    largest = leaves.agg(F.max("size")).head()[0] or 0
    nodes = leaves.select("tree", "size", "rank", "digest")
    roots = nodes.filter("size = 1").select("tree", "size", "digest")
    records = []
    for level in range(1, height(largest) + 1):
        runs = nodes.filter(F.col("size") > FAN ** (level - 1)).groupBy(
            "tree", "size", F.shiftright("rank", BITS).alias("rank")).agg(
            F.array_sort(F.collect_list(F.struct("rank", "digest"))).alias("run"))
        grouped = runs.select("tree", "size", "rank", F.col("run.digest").alias("children"))
        nodes = cut_lineage(grouped.withColumn("digest", digest(F.array_join("children", ""))))
        records.append(nodes.groupBy("digest").agg(F.any_value("children").alias("children")))
        top = nodes.filter(F.col("size") <= FAN**level)
        roots = roots.union(top.select("tree", "size", "digest"))
    return roots, [cut_lineage(r) for r in records]


def _children(frontier: DataFrame, records: DataFrame) -> DataFrame:
    stored = broadcast_if_small(records.withColumnsRenamed({"digest": "__digest"}))
    return frontier.join(stored, F.col("digest") == F.col("__digest")).drop("__digest")


def descend(start: DataFrame, records: list[DataFrame], requests: DataFrame) -> DataFrame:
    """Runs of leaves that are requested: (tree, run, children, path).

    ``start`` has (tree, size, digest, path) of the roots and ``requests`` (tree, rank).  ``path`` grows by the position
    and the unselected children at every step down to the run; a tree of one leaf has no children.
    """
    levels = _levels(F.col("size"), len(records))
    waiting = start.select("tree", levels.alias("levels"), F.lit(0).cast("long").alias("run"), "digest", "path")
    none = F.lit(None).cast("array<string>")
    done = waiting.filter("levels = 0").select("tree", "run", none.alias("children"), "path")
    frontier = None
    for level in range(len(records), 0, -1):
        entering = waiting.filter(F.col("levels") == level).select("tree", "run", "digest", "path")
        frontier = entering if frontier is None else frontier.union(entering)
        opened = _children(frontier, records[level - 1])
        if level == 1:
            return done.union(opened.select("tree", "run", "children", "path"))
        others = F.expr("filter(children, (c, i) -> i != pos)")
        stepped = opened.select("tree", "run", "path", "children", F.posexplode("children").alias("pos", "digest")).select(
            "tree", (F.shiftleft("run", BITS) + F.col("pos")).alias("run"), "digest",
            F.array_append("path", F.struct("pos", others.alias("others"))).alias("path"))
        wanted = requests.select("tree", F.shiftright("rank", BITS * (level - 1)).alias("run")).distinct()
        frontier = stepped.join(wanted, ["tree", "run"], "left_semi")
    return done


def proven(requests: DataFrame, runs: DataFrame) -> DataFrame:
    """``requests`` (tree, rank, ...) with ``path`` from the leaf to the root."""
    last = F.expr("if(children is null, path, array_append(path, struct(int(rank & 15) as pos, "
                  "filter(children, (c, i) -> i != int(rank & 15)) as others)))")
    keyed = requests.withColumn("run", F.shiftright("rank", BITS))
    # at most 16 ranks share a run
    return keyed.join(runs, ["tree", "run"]).withColumn("path", F.reverse(last)).drop("run", "children")


def folded(leaf: str) -> Column:
    """The root that a leaf and its ``path`` give."""
    return F.expr(f"aggregate(path, {leaf}, (node, s) -> sha2(binary(concat("
                  "array_join(slice(s.others, 1, s.pos), ''), node, array_join(slice(s.others, s.pos + 1, size(s.others)), ''))), 256))")


@dataclass
class Manifest:
    """The root's digest (None without rows), the sources (tree, rank, size, digest) and the records of both trees."""

    root: str | None
    n_sources: int
    sources: DataFrame
    top: list[DataFrame]
    records: list[DataFrame]


def source_tree(source: str) -> Column:
    """Name of a source's tree; null comes first and differs from every text."""
    return F.coalesce(F.concat(F.lit("1"), F.col(source).cast("string")), F.lit("0"))


def build(leaves: DataFrame) -> Manifest:
    """The manifest over ranked leaves (tree, rank, size, digest)."""
    subroots, records = grown(leaves)
    named = subroots.select(F.col("tree").alias("name"), F.col("size").alias("leaves"), "digest")
    sources = cut_lineage(ranked(named.withColumn("tree", F.lit("all")), ["name"]))
    root, top = grown(sources)
    found = root.head()
    return Manifest(found and found["digest"], found["size"] if found else 0,
                    sources.select(F.col("name").alias("tree"), "rank", F.col("leaves").alias("size"), "digest"), top, records)


def prove(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """``requests`` (tree, rank, ...) with ``subroot``, ``root`` and ``path`` from the leaf to the root."""
    named = manifest.sources.select(F.lit("all").alias("tree"), "rank", F.col("tree").alias("name"), "size", F.col("digest").alias("subroot"))
    wanted = requests.select(F.col("tree").alias("name")).distinct()
    sources = cut_lineage(named.join(broadcast_if_small(wanted), "name", "left_semi"))
    root = F.lit(manifest.root).cast("string")
    start = requests.sparkSession.range(1).select(F.lit("all").alias("tree"), F.lit(manifest.n_sources).cast("long").alias("size"),
                                                  root.alias("digest"), F.array().cast(PATH).alias("path"))
    runs = descend(start, manifest.top, sources.select("tree", "rank"))
    # the path through the tree of sources, again from the root downwards
    reached = cut_lineage(proven(sources, runs).select(
        F.col("name").alias("tree"), "size", F.col("subroot").alias("digest"), F.reverse("path").alias("path")))
    found = proven(requests.drop("size"), descend(reached, manifest.records, requests.select("tree", "rank")))
    return found.join(broadcast_if_small(reached.select("tree", F.col("digest").alias("subroot"))), "tree").withColumn("root", root)


def verify(docs: DataFrame, tampered: Column, columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
           source: str = "source", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, leaf, subroot, root, path, folded_root`` of every row; ``folded_root`` is by the ``tampered`` text.

    A row's leaf is the digest of ``columns``.  Per source, null being one, leaves ascend by ``doc_id``, null first,
    and rows of one id by their digest.  Every row is proven, equal rows each at its own place.  Null and empty values
    differ; other columns take no part, whatever their names.  An empty table gives no rows.
    """
    after = [tampered if c == text else F.col(c) for c in columns]
    leaves = cut_lineage(docs.select(
        source_tree(source).alias("tree"), F.col(doc_id).alias("doc_id"), leaf_digest([F.col(c) for c in columns]).alias("digest"),
        leaf_digest(after).alias("changed")))
    rows = ranked(leaves, ["doc_id", "digest"])
    requests = rows.withColumnRenamed("digest", "leaf")
    found = prove(build(rows), requests)
    return found.select("doc_id", "leaf", "subroot", "root", "path", folded("changed").alias("folded_root"))
