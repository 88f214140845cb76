"""Exact top-k search by inner product over KD-trees, one tree per shard of the vectors."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from treatflow.session import cut_lineage

SHARD_ROWS = 8192
QUERY_ROWS = 1024
LEAF_ROWS = 128
TREE_SCHEMA = "dim int, shard long, ids binary, values binary, boxes binary, nodes binary"
BLOCK_SCHEMA = "dim int, block long, ids binary, values binary"
FOUND_SCHEMA = "dim int, block long, query_id long, vec_id long, score long"


def usable(vector: Column) -> Column:
    """Neither null nor with null or non-finite components."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & F.forall(vector, finite)


def quantized(vectors: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """``id``, ``values`` (floor of ``scale`` times each component) and ``dim`` of usable rows, repeats once."""
    values = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return vectors.filter(F.col(vec_id).isNotNull() & usable(F.col(vector))).select(
        F.col(vec_id).cast("long").alias("id"), values.alias("values"), F.size(vector).alias("dim")).distinct()


def matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and values of rows of one dimension, by id."""
    ids = np.asarray(table.column("id").combine_chunks())
    rows = np.array(table.column("values").to_pylist(), dtype=np.int64).reshape(len(ids), -1)
    order = np.argsort(ids, kind="stable")
    return ids[order], rows[order]


def build_tree(ids: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids, rows, boxes, nodes) of a tree of median splits along the widest side of tight boxes.

    A box is its lower, then its upper corner; a node is (left, right, start, end), with left -1 for a leaf.
    Of equal vectors only the ``k + 1`` smallest ids can be among the best, so a leaf of one point keeps those.
    """
    order = np.arange(len(ids))
    boxes, nodes, kept = [], [], []
    size = 0
    todo = [(order, -1, 0)]
    while todo:
        own, parent, side = todo.pop()
        part = rows[own]
        low, high = part.min(axis=0), part.max(axis=0)
        number = len(nodes)
        if parent >= 0:
            nodes[parent][side] = number
        boxes.append(np.concatenate([low, high]))
        spread = high - low
        if len(own) <= LEAF_ROWS or not spread.any():
            own = np.sort(own)[:None if spread.any() else k + 1]
            nodes.append([-1, -1, size, size + len(own)])
            kept.append(own)
            size += len(own)
            continue
        nodes.append([-1, -1, 0, 0])
        axis = int(spread.argmax())
        half = len(own) // 2
        split = np.argpartition(part[:, axis], half)
        todo += [(own[split[:half]], number, 0), (own[split[half:]], number, 1)]
    kept = np.concatenate(kept)
    return ids[kept], rows[kept], np.array(boxes), np.array(nodes)


def exact_type(*arrays: np.ndarray) -> type:
    """Doubles if every inner product is exact in them, else 64-bit integers (which scores must fit)."""
    tops = [float(np.abs(a).max(initial=0)) for a in arrays]
    dim = arrays[0].shape[1] or 1
    return np.float64 if max(tops) ** 2 * dim < 2**53 else np.int64


def search(tree: tuple, query_ids: np.ndarray, queries: np.ndarray, k: int, bounds: list) -> list[list[tuple[int, int]]]:
    """Best (score, -id) pairs of each query in a tree, best first.

    Nodes are visited in the order of the largest inner product that their box allows, until that is below
    the k-th score; ``bounds`` has a k-th score known from elsewhere, or None.
    """
    ids, rows, boxes, nodes = tree
    kind = exact_type(rows, queries)
    rows, queries, boxes = rows.astype(kind), queries.astype(kind), boxes.astype(kind)
    dim = queries.shape[1]
    reach = np.maximum(queries, 0) @ boxes[:, dim:].T + np.minimum(queries, 0) @ boxes[:, :dim].T
    nodes = nodes.tolist()
    found = []
    for q, query in enumerate(queries):
        far = reach[q].tolist()
        own = int(query_ids[q])
        best: list[tuple[int, int]] = []
        least = bounds[q]
        heap = [(-far[0], 0)]
        while heap:
            top, node = heapq.heappop(heap)
            if least is not None and -top < least:
                break
            left, right, start, end = nodes[node]
            if left >= 0:
                heapq.heappush(heap, (-far[left], left))
                heapq.heappush(heap, (-far[right], right))
                continue
            scores = rows[start:end] @ query
            hits = range(start, end) if least is None else (np.flatnonzero(scores >= least) + start).tolist()
            for i in hits:
                pair = (int(scores[i - start]), -int(ids[i]))
                if -pair[1] == own:
                    continue
                if len(best) < k:
                    heapq.heappush(best, pair)
                elif pair > best[0]:
                    heapq.heapreplace(best, pair)
            if len(best) == k and (least is None or best[0][0] > least):
                least = best[0][0]
        found.append(sorted(best, reverse=True))
    return found


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, vec_id: str = "vec_id",
          vector: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` vectors with the highest integer inner product.

    Every vector but the query's own id takes part; ties go to the smaller id; fewer candidates give fewer
    rows.  Vectors are dealt to shards of about ``shard_rows`` by a hash of id and values, so copies of one vector
    spread over all.  A block of queries is first searched in one shard; its k-th scores then bound the search
    of the others.  Null ids, null vectors and those with null or non-finite components take no part; vectors
    meet those of their own length; repeated rows count once, and of several vectors of one id the best counts.
    """
    valid = quantized(vectors, vec_id, vector, scale)
    shards = max(1, -(-valid.count() // shard_rows))
    dealt = valid.withColumn("shard", F.pmod(F.xxhash64("id", "values"), F.lit(shards)))

    def to_tree(key: tuple, table: pa.Table) -> pa.Table:
        ids, rows, boxes, nodes = build_tree(*matrix(table), k)
        return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()), "shard": pa.array([key[1].as_py()], pa.int64()), **{
            n: [a.astype("<i8").tobytes()] for n, a in (("ids", ids), ("values", rows), ("boxes", boxes), ("nodes", nodes))}})

    trees = cut_lineage(dealt.groupBy("dim", "shard").applyInArrow(to_tree, TREE_SCHEMA))
    asked = quantized(vectors.filter(is_query), vec_id, vector, scale)
    blocks = max(1, -(-asked.count() // QUERY_ROWS))

    def to_block(key: tuple, table: pa.Table) -> pa.Table:
        ids, rows = matrix(table)
        return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()), "block": pa.array([key[1].as_py()], pa.int64()),
                         "ids": [ids.astype("<i8").tobytes()], "values": [rows.astype("<i8").tobytes()]})

    queries = cut_lineage(asked.withColumn("block", F.pmod(F.xxhash64("id", "values"), F.lit(blocks))).groupBy(
        "dim", "block").applyInArrow(to_block, BLOCK_SCHEMA))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = lambda blob: np.frombuffer(blob, dtype="<i8")
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                dim = row["dim"]
                ids = numbers(row["ids"])
                tree = (ids, numbers(row["values"]).reshape(-1, dim), numbers(row["boxes"]).reshape(-1, 2 * dim),
                        numbers(row["nodes"]).reshape(-1, 4)) if dim else (ids, np.zeros((len(ids), 0), np.int64), np.zeros(
                            (1, 0), np.int64), numbers(row["nodes"]).reshape(-1, 4))
                asked_ids = numbers(row["query_ids"])
                known = {}
                for found in row["known"] or []:
                    known.setdefault(found["query_id"], []).append(found["score"])
                bounds = [min(s) if len(s := known.get(q, [])) >= k else None for q in asked_ids.tolist()]
                rows = [(int(q), -v, s) for q, best in zip(asked_ids, search(
                    tree, asked_ids, numbers(row["query_values"]).reshape(len(asked_ids), dim), k, bounds)) for s, v in best]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([dim] * len(rows), pa.int32()), pa.array([row["block"]] * len(rows), pa.int64()),
                     *[pa.array([r[c] for r in rows], pa.int64()) for c in range(3)]],
                    ["dim", "block", "query_id", "vec_id", "score"])

    def searched(asked: DataFrame) -> DataFrame:
        return asked.withColumnsRenamed({"ids": "query_ids", "values": "query_values"}).join(
            trees, ["dim", "shard"]).mapInArrow(run, FOUND_SCHEMA)

    # dimensions may lack some shards; blocks start in different ones of those that their dimension has
    present = trees.groupBy("dim").agg(F.sort_array(F.collect_set("shard")).alias("shards"))
    placed = queries.join(present, "dim").withColumn(
        "home", F.get("shards", F.pmod(F.xxhash64("block"), F.size("shards")).cast("int"))).drop("shards")
    nothing = F.lit(None).cast("array<struct<query_id:bigint,score:bigint>>")
    first = cut_lineage(searched(placed.withColumnRenamed("home", "shard").withColumn("known", nothing)))
    known = first.groupBy("dim", "block").agg(F.collect_list(F.struct("query_id", "score")).alias("known"))
    others = placed.join(known, ["dim", "block"], "left").withColumn(
        "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))).filter("shard != home").drop("home")
    found = first.union(searched(others)).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
