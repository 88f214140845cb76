"""Substring dedup by content-defined chunks, whose borders a gear rolling hash sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treatflow.llm.common import text_chunks, with_row_key, without
from treatflow.session import broadcast_if_small, cut_lineage

# one random 32-bit number for every byte, from a seed
GEAR = np.random.Generator(np.random.PCG64(20)).integers(0, 1 << 32, 256, dtype=np.uint32)
WINDOW = 32
CHUNK_SCHEMA = "__id long, __h long, start int, bytes int, high long, low long"


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """Gear hash after every byte: the sum of GEAR[byte] << age over the last 32 bytes, by doubling."""
    h = GEAR[data]
    age = 1
    while age < WINDOW:
        h[age:] += h[:-age] << np.uint32(age)
        age *= 2
    return h


def chunk_borders(data: np.ndarray, border: np.ndarray, least: int, most: int) -> list[int]:
    """Ends of the chunks of one text; ``border`` are the places after which the hash would cut.

    A chunk has ``least`` to ``most`` bytes, but the last may be shorter, and no character is split.
    """
    ends = []
    start, size = 0, len(data)
    for at in [*border.tolist(), size]:
        while at - start > most:
            end = start + most
            while data[end] & 0xC0 == 0x80:
                end -= 1
            ends.append(end)
            start = end
        if at - start >= least or at == size:
            ends.append(at)
            start = at
    return ends if size and ends[-1] == size else [*ends, size] if size else []


def chunk_texts(docs: DataFrame, bits: int = 4, least: int = 32, most: int = 1024, doc_id: str = "doc_id",
                text: str = "text") -> DataFrame:
    """Chunks of all texts: row key, place in bytes and a digest of 128 bits."""
    shift = np.uint32(32 - bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches, "text", 4 << 20):
            texts = [(t.as_py() or "").encode("utf-8") for t in chunk.column("text")]
            # zeros between texts keep a hash from seeing the text before
            data = np.frombuffer(b"".join(t + bytes(WINDOW) for t in texts), dtype=np.uint8)
            cut = gear_hashes(data) >> shift == 0
            cut[:-1] &= data[1:] & 0xC0 != 0x80
            places = np.flatnonzero(cut) + 1
            row, starts, sizes, digests = [], [], [], []
            at = 0
            for i, t in enumerate(texts):
                a, b = np.searchsorted(places, (at + 1, at + len(t)))
                ends = chunk_borders(data[at:at + len(t)], places[a:b] - at, least, most)
                begin = 0
                for end in ends:
                    row.append(i)
                    starts.append(begin)
                    sizes.append(end - begin)
                    digests.append(xxhash.xxh3_128_digest(t[begin:end]))
                    begin = end
                at += len(t) + WINDOW
            halves = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
            row = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [chunk.column("__id").take(row), chunk.column("__h").take(row), pa.array(starts, pa.int32()), pa.array(sizes, pa.int32()),
                 pa.array(halves[:, 1].copy()), pa.array(halves[:, 0].copy())], ["__id", "__h", "start", "bytes", "high", "low"])

    keyed = with_row_key(docs.select(doc_id, text), doc_id, text)
    return keyed.select("__id", "__h", F.col(text).alias("text")).mapInArrow(run, CHUNK_SCHEMA)


def _chunk_runs() -> str:
    """Chunks that follow one another joined to runs: start, stop, number of chunks and ids of the first occurrences."""
    kind = "array<struct<start:int,stop:int,n:int,sources:array<bigint>>>"
    last = "element_at(acc, -1)"
    begun = "named_struct('start', s.start, 'stop', s.start + s.bytes, 'n', 1, 'sources', array(s.source))"
    longer = (f"named_struct('start', {last}.start, 'stop', s.start + s.bytes, 'n', {last}.n + 1, "
              f"'sources', array_append({last}.sources, s.source))")
    return (f"aggregate(__chunks, cast(array() as {kind}), (acc, s) -> if(size(acc) > 0 and try_element_at(acc, -1).stop = s.start, "
            f"concat(slice(acc, 1, size(acc) - 1), array({longer})), array_append(acc, {begun})))")


def dedup_substrings(docs: DataFrame, bits: int = 4, least: int = 32, most: int = 1024, min_run: int = 112, doc_id: str = "doc_id",
                     text: str = "text") -> DataFrame:
    """All rows, with repeated stretches cut from ``text``; adds ``n_removed``, ``removed_bytes``, ``sources``.

    The first occurrence of a chunk, by id, text and place, stays; later ones are repeated, also within a text.  Repeated
    chunks that follow one another are a stretch, which goes if it has at least ``min_run`` bytes or is the whole text: a
    chunk alone may agree by chance.  ``n_removed`` counts chunks, ``sources`` are the ids of their first occurrences.
    First occurrences are aggregated before the shuffle, and only digests that repeat are joined back.  Null text
    stays null, a null id counts as the smallest id, equal rows are one document and fare alike.  Columns of the
    result's names are replaced, other columns stay.
    """
    each = cut_lineage(chunk_texts(docs, bits, least, most, doc_id, text))
    place = F.struct("__id", "__h", "start")
    first = each.groupBy("high", "low").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter("first != last")
    first = cut_lineage(first.select("high", "low", "first"))
    later = each.join(broadcast_if_small(first), ["high", "low"]).filter(place != F.col("first"))
    spans = later.groupBy(F.col("__id").alias("__cid"), F.col("__h").alias("__ch")).agg(
        F.array_sort(F.collect_set(F.struct("start", "bytes", F.col("first.__id").alias("source")))).alias("__chunks"))
    spans = cut_lineage(spans.select("__cid", "__ch", F.expr(_chunk_runs()).alias("__runs")))
    quoted = "`" + text.replace("`", "``") + "`"
    large = F.expr(f"filter(__runs, r -> r.stop - r.start >= {min_run} or r.stop - r.start = octet_length({quoted}))")
    # the stretches between the runs that go, cut from the bytes and joined
    kept = F.expr(f"""array_join(zip_with(
        array_prepend(transform(__runs, r -> r.stop), 0),
        array_append(transform(__runs, r -> r.start), octet_length({quoted})),
        (a, b) -> cast(substring(cast({quoted} AS binary), a + 1, b - a) AS string)), '')""")
    joined = with_row_key(without(docs, "n_removed", "removed_bytes", "sources"), doc_id, text).join(
        broadcast_if_small(spans), (F.col("__id") == F.col("__cid")) & (F.col("__h") == F.col("__ch")), "left").withColumn("__runs", large)
    return joined.withColumns({
        text: F.when(F.coalesce(F.size("__runs"), F.lit(-1)) <= 0, F.col(text)).otherwise(kept),
        "n_removed": F.coalesce(F.expr("aggregate(__runs, 0, (n, r) -> n + r.n)"), F.lit(0)),
        "removed_bytes": F.coalesce(F.expr("aggregate(__runs, 0, (n, r) -> n + r.stop - r.start)"), F.lit(0)),
        "sources": F.coalesce(F.expr("array_sort(array_distinct(flatten(transform(__runs, r -> r.sources))))"), F.array().cast("array<long>")),
    }).drop("__id", "__h", "__cid", "__ch", "__runs")
