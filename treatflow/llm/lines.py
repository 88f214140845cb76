"""Line dedup: common blocks of lines are found by pairwise alignment and deleted from the later document.

Documents are paired through hashes of short runs of lines: from every line on, and up to every line, the shortest run
that reaches the least size of a block.  Such a run is rarer than its lines, any common block that is large enough is made of such
runs, and each of them names the first document that has it and its place there.  So a run that very many documents share
gives each of them one partner, not all others.  A pair's runs tell the lines they share; patience diff aligns
them, and aligned stretches that follow one another in both documents are the blocks that go.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treatflow.llm.common import join_counted, text_chunks, with_row_key, without
from treatflow.session import broadcast_if_small, cut_lineage

LINED_SCHEMA = "__id long, __h long, at array<int>, hashes array<long>, chars array<int>"
RUN_SCHEMA = "__id long, __h long, start int, size int, hash long"
CUT_SCHEMA = "__id long, __h long, mask binary, n_deleted int, partners array<long>"
CHUNK_BYTES = 4 << 20


def longest_increasing(values: list[int]) -> list[int]:
    """Positions of a longest increasing subsequence, by patience sorting."""
    tops: list[int] = []
    tails: list[int] = []
    before = [-1] * len(values)
    for i, v in enumerate(values):
        pile = bisect_left(tops, v)
        before[i] = tails[pile - 1] if pile else -1
        tops[pile:pile + 1] = [v]
        tails[pile:pile + 1] = [i]
    chain = []
    i = tails[-1] if tails else -1
    while i >= 0:
        chain.append(i)
        i = before[i]
    return chain[::-1]


def patience_align(first: list[tuple[int, int]], later: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Aligned line numbers of two documents, given as (number, hash) of the lines they share, in order.

    Lines that occur once on both sides and whose order agrees are anchors; the stretches between anchors are
    aligned in the same way, after equal lines at their ends.  Work is kept on a list, not on the call stack.
    """
    aligned = []
    todo = [(0, len(first), 0, len(later))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and first[a][1] == later[c][1]:
            aligned.append((first[a][0], later[c][0]))
            a, c = a + 1, c + 1
        while a < b and c < d and first[b - 1][1] == later[d - 1][1]:
            aligned.append((first[b - 1][0], later[d - 1][0]))
            b, d = b - 1, d - 1
        if a == b or c == d:
            continue
        left = Counter(h for _, h in first[a:b])
        right = Counter(h for _, h in later[c:d])
        place = {h: i for i, (_, h) in enumerate(later[c:d], c)}
        once = [(i, place[h]) for i, (_, h) in enumerate(first[a:b], a) if left[h] == 1 and right[h] == 1]
        anchors = [once[i] for i in longest_increasing([j for _, j in once])]
        if anchors:
            for i, j in anchors:
                todo.append((a, i, c, j))
                aligned.append((first[i][0], later[j][0]))
                a, c = i + 1, j + 1
            todo.append((a, b, c, d))
    return aligned


def shortest_runs(chars: list[int], least: int) -> list[tuple[int, int]]:
    """(start, end) of the shortest run of at least ``least`` characters from every line on and up to every line."""
    sums = [0, *accumulate(chars)]
    found = set()
    for i in range(len(chars)):
        end = bisect_left(sums, sums[i] + least)
        if end < len(sums):
            found.add((i, end))
        start = bisect_right(sums, sums[i + 1] - least) - 1
        if start >= 0:
            found.add((start, i + 1))
    return sorted(found)


def blocks_of(aligned: list[tuple[int, int]], chars: list[int], least: int) -> set[int]:
    """Lines of the later document in stretches that follow one another on both sides and reach ``least`` characters."""
    gone: set[int] = set()
    block: list[tuple[int, int]] = []
    for pair in [*sorted(aligned, key=lambda p: p[1]), None]:
        if block and pair != (block[-1][0] + 1, block[-1][1] + 1):
            if sum(chars[line] for _, line in block) >= least:
                gone.update(line for _, line in block)
            block = []
        if pair is not None:
            block.append(pair)
    return gone


def lines_to_delete(hashes: list[int], chars: list[int], runs: list[tuple], least: int) -> tuple[list[int], list[tuple]]:
    """Lines that go from a document, and the partners they were aligned with.

    ``runs`` has (start, size, documents with the run, partner, start in the partner).  Partners come in the order of their
    rarest run; one whose runs have gone by then is not aligned any more.  What the alignment of a whole pair
    leaves of a run, because it was moved or comes again, is aligned on its own.
    """
    by_partner = defaultdict(list)
    for run in sorted(runs):
        by_partner[run[3]].append(run)
    gone: set[int] = set()
    partners = []
    for partner, shared in sorted(by_partner.items(), key=lambda p: (min(r[2] for r in p[1]), p[0])):
        left = [r for r in shared if not gone.issuperset(range(r[0], r[0] + r[1]))]
        if not left:
            continue
        partners.append(partner)
        first = sorted({(r[4] + k, hashes[r[0] + k]) for r in left for k in range(r[1])})
        later = [(i, hashes[i]) for i in sorted({r[0] + k for r in left for k in range(r[1])})]
        gone |= blocks_of(patience_align(first, later), chars, least)
        for start, size, _, _, there in left:
            if not gone.issuperset(range(start, start + size)):
                own = [hashes[start + k] for k in range(size)]
                gone |= blocks_of(patience_align([(there + k, h) for k, h in enumerate(own)], [(start + k, h) for k, h in enumerate(own)]),
                                  chars, least)
    return sorted(gone), partners


def lined_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Number, hash and length of the lines of every text that are not empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches, "text", CHUNK_BYTES):
            at, hashes, chars = [], [], []
            for value in chunk.column("text"):
                lines = [(i, line) for i, line in enumerate((value.as_py() or "").split("\n")) if line]
                at.append([i for i, _ in lines])
                chars.append([len(line) for _, line in lines])
                hashes.append(np.array([xxhash.xxh3_64_intdigest(line.encode("utf-8")) for _, line in lines], dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [chunk.column("__id"), chunk.column("__h"), pa.array(at, pa.list_(pa.int32())), pa.array(hashes, pa.list_(pa.int64())),
                 pa.array(chars, pa.list_(pa.int32()))], ["__id", "__h", "at", "hashes", "chars"])

    keyed = with_row_key(docs.select(doc_id, text), doc_id, text)
    return keyed.select("__id", "__h", F.col(text).alias("text")).mapInArrow(run, LINED_SCHEMA)


def _runs(lined: DataFrame, least: int) -> DataFrame:
    """The shortest runs of all documents with hashes of their lines' hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, starts, sizes, keys = [], [], [], []
            for i, (hashes, chars) in enumerate(zip(batch.column("hashes").to_pylist(), batch.column("chars").to_pylist())):
                data = np.array(hashes, dtype="<i8").tobytes()
                for start, end in shortest_runs(chars, least):
                    row.append(i)
                    starts.append(start)
                    sizes.append(end - start)
                    keys.append(xxhash.xxh3_64_intdigest(data[8 * start:8 * end]))
            row = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("__id").take(row), batch.column("__h").take(row), pa.array(starts, pa.int32()), pa.array(sizes, pa.int32()),
                 pa.array(np.array(keys, dtype=np.uint64).view(np.int64))], ["__id", "__h", "start", "size", "hash"])

    return lined.mapInArrow(run, RUN_SCHEMA)


def _first_holders(each: DataFrame) -> DataFrame:
    """Runs of two or more documents: the first document and place, and the number of runs (``n``)."""
    place, holder = F.struct("__id", "__h", "start"), F.struct("__id", "__h")
    return each.groupBy("hash").agg(
        F.min(place).alias("first"), F.min(holder).alias("low"), F.max(holder).alias("high"), F.count(F.lit(1)).alias("n")
    ).filter("low != high").select("hash", "first", "n")


def repeated_lines(docs: DataFrame, min_chars: int = 60, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``__id, __h, mask, n_deleted, partners`` of each document that repeats earlier ones; a byte 1 of the mask is a line to go.

    Documents are ordered by id and text.  A line goes if it lies in a run of lines of at least ``min_chars`` characters that
    follow one another, empty lines aside, in an earlier document, too.
    """
    lined = cut_lineage(lined_texts(docs, doc_id, text))
    each = cut_lineage(_runs(lined, min_chars))
    first = cut_lineage(_first_holders(each))
    met = join_counted(each, first, "hash").filter((F.col("__id") != F.col("first.__id")) | (F.col("__h") != F.col("first.__h")))
    # a document's own runs, however many others have them
    shared = cut_lineage(met.groupBy("__id", "__h").agg(F.collect_set(F.struct("start", "size", "n", "first")).alias("runs")))
    with_lines = shared.join(lined.distinct(), ["__id", "__h"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                runs = [(r["start"], r["size"], r["n"], (r["first"]["__id"], r["first"]["__h"]), r["first"]["start"]) for r in row["runs"]]
                gone, partners = lines_to_delete(row["hashes"], row["chars"], runs, min_chars)
                if gone:
                    mask = bytearray(row["at"][gone[-1]] + 1)
                    for line in gone:
                        mask[row["at"][line]] = 1
                    out.append((row["__id"], row["__h"], bytes(mask), len(gone), sorted({p[0] for p in partners})))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate(
                    (pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.list_(pa.int64())))],
                ["__id", "__h", "mask", "n_deleted", "partners"])

    return with_lines.mapInArrow(run, CUT_SCHEMA)


def dedup_lines(docs: DataFrame, min_chars: int = 60, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows with the aligned blocks cut from ``text``; adds ``n_deleted`` (lines) and ``partners`` (ids).

    A document whose lines all go keeps an empty text.  Null text has no lines and stays null; empty lines
    are never shared and stay; a null id counts as the smallest id; equal rows are one document and fare
    alike, equal texts of different ids are not.  Columns called ``n_deleted`` or ``partners`` are replaced, other columns
    stay, whatever their names.
    """
    cuts = cut_lineage(repeated_lines(docs, min_chars, doc_id, text)).withColumnsRenamed(
        {"__id": "__cid", "__h": "__ch", "mask": "__mask", "n_deleted": "__n", "partners": "__partners"})
    joined = with_row_key(without(docs, "n_deleted", "partners"), doc_id, text).join(
        broadcast_if_small(cuts), (F.col("__id") == F.col("__cid")) & (F.col("__h") == F.col("__ch")), "left")
    quoted = "`" + text.replace("`", "``") + "`"
    kept = F.expr(f"array_join(filter(split({quoted}, '\\n', -1), (line, i) -> substring(__mask, i + 1, 1) != X'01'), '\\n')")
    return joined.withColumns({
        text: F.when(F.col("__mask").isNull(), F.col(text)).otherwise(kept),
        "n_deleted": F.coalesce("__n", F.lit(0)),
        "partners": F.coalesce("__partners", F.array().cast("array<long>")),
    }).drop("__id", "__h", "__cid", "__ch", "__mask", "__n", "__partners")
