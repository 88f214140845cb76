"""Near-duplicates by SimHash, with candidate keys from the binary Golay code.

The perfect Golay code of 23 bits has a codeword within 3 bits of every word.  A segment's keys are the
codewords of the segment and of all its neighbours at one bit, which are one or six; so two segments that
differ in at most one bit share a key.  A fingerprint of 64 bits is four exact blocks of 16 bits; three
errors leave one block without any, and of the other 48 bits one half with at most one.  A key is the
block, the half and the codeword.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treatflow.llm.common import join_counted, text_chunks
from treatflow.operators.components import components
from treatflow.session import broadcast_if_small, cut_lineage

GENERATOR = 0xAE3  # fixed value: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
SEED = 42
DEEP = 512
SMALL = 8


def syndrome(words: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit words by the generator."""
    rest = words.astype(np.int64)
    for bit in range(22, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - 11)), rest)
    return rest


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Error pattern of every syndrome, and the up to six key masks of every syndrome (repeats fill up)."""
    single = 1 << np.arange(23)
    errors = np.zeros(2048, dtype=np.int64)
    patterns = [np.zeros(1, dtype=np.int64), single]
    patterns.append((single[:, None] ^ single[None, :])[np.triu_indices(23, 1)])
    patterns.append(np.unique(patterns[2][:, None] ^ single[None, :]))
    for pattern in patterns[::-1]:
        errors[syndrome(pattern)] = pattern
    steps = np.concatenate([[0], single])
    masks = steps[None, :] ^ errors[np.arange(2048)[:, None] ^ syndrome(steps)[None, :]]
    six = np.zeros((2048, 6), dtype=np.int64)
    for s in range(2048):
        own = np.unique(masks[s])
        six[s] = np.resize(own, 6)
    return errors, six


ERRORS, MASKS = _tables()


def segment_keys(words: np.ndarray) -> np.ndarray:
    """(n, 6) codeword numbers of 23-bit words; repeats fill the rows of those with one."""
    return (words[:, None] ^ MASKS[syndrome(words)]) >> 11


def fingerprint_keys(prints: np.ndarray) -> np.ndarray:
    """(n, 48) candidate keys of unsigned 64-bit fingerprints."""
    found = []
    full = prints.astype(np.uint64)
    for block in range(4):
        exact = (full >> np.uint64(16 * block) & np.uint64(0xFFFF)).astype(np.int64)
        low = full & np.uint64((1 << 16 * block) - 1)
        high = np.uint64(0) if block == 3 else full >> np.uint64(16 * block + 16)
        rest = low | high << np.uint64(16 * block)
        for half in range(2):
            word = (rest >> np.uint64(24 * half) & np.uint64(0x7FFFFF)).astype(np.int64)
            found.append(((2 * block + half) << 28 | exact << 12)[:, None] | segment_keys(word))
    return np.concatenate(found, axis=1)


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 of the word shingles, repeats included; a shorter text is one shingle."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined = map(b" ".join, zip(*[words[i:] for i in range(size)])) if len(words) >= size else [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(s, SEED) for s in joined], dtype=np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bits that are set in over half of the hashes, as a signed 64-bit number."""
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = np.ascontiguousarray(hashes[i:i + (1 << 16)], dtype="<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, key, fingerprint`` of every row; ``key`` is a hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches, "text", 8 << 20):
            prints = [fingerprint(shingle_hashes(t.as_py(), shingle)) for t in chunk.column("text")]
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), chunk.column("key"), pa.array(prints, pa.int64())], ["doc_id", "key", "fingerprint"])

    columns = [F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), F.col(text).alias("text")]
    return docs.select(*columns).mapInArrow(run, "doc_id long, key long, fingerprint long")


def links_in(prints: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Enough links at ``distance`` bits or fewer to join all that are joined within these fingerprints.

    A search from one fingerprint outward: every one that is reached looks only at those not reached yet.
    """
    left = np.arange(len(prints))
    found = []
    while len(left) > 1:
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            near = np.bitwise_count(prints[front[0]] ^ prints[left]) <= distance
            hit = left[near]
            if len(hit):
                found.append((np.repeat(prints[front[0]], len(hit)), prints[hit]))
            front, left = np.concatenate([front[1:], hit]), left[~near]
    return found


def golay_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 20_000):
            values = np.asarray(batch.column("fingerprint").slice(at, 20_000))
            table = np.sort(fingerprint_keys(values.view(np.uint64)), axis=1)
            new = np.concatenate([np.ones((len(table), 1), bool), table[:, 1:] != table[:, :-1]], axis=1)
            rows = np.repeat(np.arange(len(values)), new.sum(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(table[new]), pa.array(values[rows])], ["key", "fingerprint"])


def block_keys(batches: Iterator[pa.RecordBatch], blocks: int, distance: int) -> Iterator[pa.RecordBatch]:
    """Keys for crowded fingerprints: all blocks of bits but ``distance``, in every choice of those."""
    width = 64 // blocks
    unit = (1 << width) - 1
    for batch in batches:
        values = np.asarray(batch.column("fingerprint")).view(np.uint64)
        for n, left_out in enumerate(combinations(range(blocks), distance)):
            kept = np.uint64((1 << 64) - 1 - sum(unit << (width * b) for b in left_out))
            # mixed with the choice's number; an equal key by chance costs one comparison
            keys = ((values & kept) + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            keys ^= keys >> np.uint64(29)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(values.view(np.int64))], ["key", "fingerprint"])


def compare_runs(batches: Iterator[pa.RecordBatch], distance: int, deep: int | None) -> Iterator[pa.RecordBatch]:
    """Links within the runs of equal keys; a run of over ``deep`` rows is handed back with ``v`` null."""
    keys, values = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    crowded = None
    for batch in batches:
        keys = np.concatenate([keys, np.asarray(batch.column("key"))])
        values = np.concatenate([values, np.asarray(batch.column("fingerprint"))])
        if not len(keys):
            continue
        last = int(np.searchsorted(keys, keys[-1]))
        head = int(np.searchsorted(keys, crowded, side="right")) if crowded is not None else 0
        yield from _link_batches([], [values[:head]])
        if last > head:
            yield from _link_batches(*runs_to_links(keys[head:last], values[head:last], distance, deep))
        start = max(head, last)
        keys, values = keys[start:], values[start:]
        if not len(keys):
            continue
        if deep is not None and len(keys) > deep:
            crowded = keys[-1]
            yield from _link_batches([], [values])
            keys, values = keys[:0], values[:0]
    if len(keys):
        yield from _link_batches(*runs_to_links(keys, values, distance, deep))


def runs_to_links(keys: np.ndarray, values: np.ndarray, distance: int, deep: int | None):
    edges = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]])
    lengths = np.diff(edges)
    prints = values.view(np.uint64)
    links, back = [], []
    for step in range(1, SMALL):
        # all pairs of small runs, which are at most SMALL * (SMALL - 1) / 2 for each
        same = (keys[step:] == keys[:-step]) & np.repeat(lengths <= SMALL, lengths)[step:]
        a, b = prints[:-step][same], prints[step:][same]
        near = np.bitwise_count(a ^ b) <= distance
        links.append((a[near], b[near]))
    for i in np.flatnonzero(lengths > SMALL).tolist():
        run = values[edges[i]:edges[i + 1]]
        if deep is not None and len(run) > deep:
            back.append(run)
        else:
            links += links_in(np.unique(run).view(np.uint64), distance)
    return links, back


def _link_batches(links: list, back: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    u = [a.view(np.int64) for a, _ in links]
    v = [b.view(np.int64) for _, b in links]
    if sum(map(len, u)):
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(u)), pa.array(np.concatenate(v))], ["u", "v"])
    if sum(map(len, back)):
        rows = np.concatenate(back)
        yield pa.RecordBatch.from_arrays([pa.array(rows), pa.nulls(len(rows), pa.int64())], ["u", "v"])


def candidate_links(prints: DataFrame, distance: int = 3) -> DataFrame:
    """Links (``u``, ``v``) among distinct fingerprints that join all within ``distance`` bits (3 at most).

    Rows of one key come together by a shuffle on the key and are read as one sorted stream.  Those of a key
    with more than ``DEEP`` fingerprints are not compared: they come back and get longer keys, of all but
    three of 8 and then of 16 blocks, until the groups are small.
    """
    if distance > 3:
        raise ValueError("the keys cover three bits at most")

    def run_round(keyed: DataFrame, deep: int | None) -> DataFrame:
        parts = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        dealt = keyed.repartition(parts, "key").sortWithinPartitions("key")
        return cut_lineage(dealt.mapInArrow(lambda b: compare_runs(b, distance, deep), "u long, v long"))

    keyed = prints.select("fingerprint").mapInArrow(golay_keys, "key long, fingerprint long")
    links = None
    # of 16 blocks of 4 bits the keys leave 12 bits open, so the last groups hold 4,096 fingerprints at most
    for deep, blocks in ((DEEP, 8), (DEEP, 16), (None, None)):
        found = run_round(keyed, deep)
        new = found.filter("v IS NOT NULL")
        links = new if links is None else links.union(new)
        crowded = found.filter("v IS NULL").select(F.col("u").alias("fingerprint")).distinct()
        if blocks is None or crowded.isEmpty():
            break
        keyed = crowded.mapInArrow(lambda b, n=blocks: block_keys(b, n, distance), "key long, fingerprint long")
    return links.distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """``doc_id, key, fingerprint, component`` of every row; the component is the smallest id of its group.

    Groups are the connected components of fingerprints at ``distance`` bits or fewer.  Copies are one
    fingerprint from the start.  Null and empty texts have fingerprint zero, texts of fewer words one
    shingle.  A null id is never a component unless all ids of the group are null.  Repeated rows share
    their group; other columns are not looked at.
    """
    each = cut_lineage(fingerprints(docs, shingle, doc_id, text))
    prints = cut_lineage(each.groupBy("fingerprint").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")))
    groups = components(candidate_links(prints, distance)).select(F.col("u").alias("fingerprint"), "grp")
    first = groups.join(prints, "fingerprint").groupBy("grp").agg(F.min("first").alias("lowest"))
    linked = groups.join(first, "grp").select("fingerprint", "lowest")
    named = cut_lineage(prints.join(linked, "fingerprint", "left").select("fingerprint", F.coalesce("lowest", "first").alias("component"), "n"))
    return join_counted(each, named, "fingerprint").select("doc_id", "key", "fingerprint", "component")


def keep_one(docs: DataFrame, shingle: int = 3, distance: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group, the one of the smallest id (then of the smallest hash of the text).

    A null id comes last; of equal rows one stays; null and empty texts are one group, and a text is judged by its words
    alone.  All columns stay as they are, an empty table gives an empty one.
    """
    groups = near_duplicates(docs, shingle, distance, doc_id, text)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    group = [F.coalesce("component", "fingerprint").alias("g"), F.col("component").isNull().alias("n")]
    rows = cut_lineage(groups.select(*group, order.alias("row")).groupBy("g", "n", "row").agg(F.count(F.lit(1)).alias("times")))
    best = rows.groupBy("g", "n").agg(F.min("row").alias("best"))
    placed = rows.join(best, ["g", "n"]).select(
        F.col("row.doc_id").alias("__id"), F.col("row.key").alias("__key"), (F.col("row") == F.col("best")).alias("stays"), "times")
    placed = cut_lineage(placed.filter("not stays or times > 1"))
    # what goes is a small table beside the texts, which stay where they are read
    keyed = docs.withColumn("__text_key", F.xxhash64(text))
    same = F.col(doc_id).cast("long").eqNullSafe(F.col("__id")) & (F.col("__text_key") == F.col("__key"))
    kept = keyed.join(broadcast_if_small(placed.select("__id", "__key")), same, "left_anti")
    repeated = placed.filter("stays").select("__id", "__key")
    if not repeated.isEmpty():
        kept = kept.union(keyed.join(broadcast_if_small(repeated), same, "left_semi").dropDuplicates([doc_id, "__text_key"]))
    return kept.drop("__text_key")
