"""Benchmark passages in a corpus, found by a positional inverted index.

The index has one row per block of documents: for every test term its postings, which are word positions
within the block.  Documents lie ``GAP`` positions apart, so that no match runs over a border.  A window of
test words is looked up by intersecting the offset-adjusted postings of its terms, from the rarest in the
block on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treatflow.llm.common import gather, text_blocks
from treatflow.session import cut_lineage

INTS = pa.list_(pa.int32())
# A-Z become a-z, other ASCII characters that are no digits or letters become spaces
TO_WORDS = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
GAP = 64
BLOCK_BYTES = 4 << 20
SLICE_BYTES = 8 << 20
CANDIDATES = 1 << 20      # places that are looked at in one array pass
WINDOWS = 1 << 16
INDEX_SCHEMA = ("doc_ids array<long>, keys array<long>, starts array<int>, n_words array<int>, terms array<int>, sizes array<int>, "
                "postings binary")
MATCH_SCHEMA = "doc_id long, key long, item_id string, start int, length int, kind string"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(TO_WORDS).split()


def build_index(docs: DataFrame, terms: dict[bytes, int], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Postings of ``terms`` in all documents, one row per block of about 4 MB of text.

    ``terms`` comes from one slice of the test items, so its size is bounded.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = vocabulary.value.get
        for block in text_blocks(batches, "text", BLOCK_BYTES):
            found, starts, sizes, at = [], [], [], 0
            for value in block.column("text").to_pylist():
                ids = [get(w, -1) for w in words_of(value)]
                starts.append(at)
                sizes.append(len(ids))
                found.append(np.array(ids, dtype=np.int32))
                found.append(np.full(GAP, -1, dtype=np.int32))
                at += len(ids) + GAP
            ids = np.concatenate(found)
            places = np.flatnonzero(ids >= 0).astype(np.int32)
            order = np.argsort(ids[places], kind="stable")
            used, counts = np.unique(ids[places], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in (
                    (block.column("doc_id").to_pylist(), pa.list_(pa.int64())), (block.column("key").to_pylist(), pa.list_(pa.int64())),
                    (starts, INTS), (sizes, INTS), (used, INTS), (counts, INTS), (places[order].astype("<i4").tobytes(), pa.binary()))],
                ["doc_ids", "keys", "starts", "n_words", "terms", "sizes", "postings"])

    columns = [F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), F.col(text).alias("text")]
    return docs.select(*columns).mapInArrow(run, INDEX_SCHEMA)


@dataclass(frozen=True)
class Windows:
    """Distinct windows of test terms, one a row of ``table``; short ones are filled with ``fill``, the term after the last.

    The items of window w are ``items[owners[first[w]]]`` and the ``counts[w] - 1`` after it.
    """

    table: np.ndarray
    lengths: np.ndarray
    fill: int
    items: list[str]
    owners: np.ndarray
    first: np.ndarray
    counts: np.ndarray


def windows_of(part: list[tuple[str, str | None]], window: int) -> tuple[dict[bytes, int], Windows]:
    """(terms, windows) of items: every ``window`` consecutive words, or all words of a shorter item."""
    terms: dict[bytes, int] = {}
    names: dict[str, int] = {}
    rows, owners = [np.empty((0, window), dtype=np.int32)], [np.empty(0, dtype=np.int64)]
    for item, value in part:
        ids = np.array([terms.setdefault(w, len(terms)) for w in words_of(value)], dtype=np.int32)
        if len(ids):
            short = np.concatenate([ids, np.full(max(0, window - len(ids)), -1, dtype=np.int32)])
            rows.append(np.lib.stride_tricks.sliding_window_view(short, window))
            owners.append(np.full(len(rows[-1]), names.setdefault(item, len(names))))
    table, which = np.unique(np.concatenate(rows), axis=0, return_inverse=True)
    pairs = np.unique(which.reshape(-1) * max(1, len(names)) + np.concatenate(owners))
    counts = np.bincount(pairs // max(1, len(names)), minlength=len(table))
    lengths = (table >= 0).sum(axis=1)
    return terms, Windows(np.where(table < 0, len(terms), table), lengths, len(terms), list(names), pairs % max(1, len(names)),
                          np.cumsum(counts) - counts, counts)


class Block:
    """The postings of one row of the index, ready for look-ups of many windows at once."""

    def __init__(self, row: dict, fill: int, margin: int):
        self.postings = np.frombuffer(row["postings"], dtype="<i4").astype(np.int64)
        self.sizes = np.zeros(fill + 1, dtype=np.int64)
        self.sizes[row["terms"]] = row["sizes"]
        self.first = np.zeros(fill + 1, dtype=np.int64)
        self.first[row["terms"]] = np.cumsum(row["sizes"]) - row["sizes"]
        self.doc_starts = np.array(row["starts"], dtype=np.int64)
        # a list is intersected by looking which term's list holds a position
        self.margin = margin
        self.term_at = np.full(self.doc_starts[-1] + row["n_words"][-1] + 2 * margin + 1, -1, dtype=np.int32)
        self.term_at[self.postings + margin] = np.repeat(row["terms"], row["sizes"])

    def look_up(self, windows: Windows, missing: int, slop: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(window, start, a position in its document) of the places where all but ``missing`` terms stand within ``slop`` words.

        Of the terms that are there, one is among the rarest ``missing + 1``, so those lists give all candidates;
        the other lists are intersected with them from the rarest on, and a candidate goes once too many terms lack.
        """
        exact = not missing and not slop
        for low in range(0, len(windows.table), WINDOWS):
            table, lengths = windows.table[low:low + WINDOWS], windows.lengths[low:low + WINDOWS]
            there = (self.sizes[table] > 0).sum(axis=1)
            chosen = np.flatnonzero((there >= lengths - missing) & (lengths > (0 if exact else missing + 1)))
            # fillers come last
            size = np.where(table[chosen] == windows.fill, np.int64(2**62), self.sizes[table[chosen]])
            rarest = np.argsort(size, axis=1, kind="stable")
            candidates = np.take_along_axis(size, rarest[:, :missing + 1], axis=1).sum(axis=1)
            groups = np.cumsum(candidates) // CANDIDATES
            edges = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), len(chosen)]
            for a, b in zip(edges, edges[1:]):
                if b > a:
                    yield self._intersect(windows, chosen[a:b] + low, rarest[a:b], missing, slop)

    def _intersect(self, windows, chosen, rarest, missing, slop):
        table, lengths = windows.table[chosen], windows.lengths[chosen]
        rows, starts, anchors = [], [], []
        for k in range(missing + 1):
            terms = table[np.arange(len(chosen)), rarest[:, k]]
            places = gather(self.postings, self.first[terms], self.sizes[terms])
            rows.append(np.repeat(np.arange(len(chosen)), self.sizes[terms]))
            starts.append(places - np.repeat(rarest[:, k], self.sizes[terms]))
            anchors.append(places)
        rows, starts, anchors = map(np.concatenate, (rows, starts, anchors))
        if not missing and not slop:
            rows, starts, anchors = self._kept(windows, table, rarest, rows, starts, anchors, 0, 0)
            return chosen[rows], starts, anchors
        # places that hold with double slack, then each start near them
        rows, starts, anchors = self._kept(windows, table, rarest, rows, starts, anchors, missing, 2 * slop)
        shifts = np.arange(-slop, slop + 1)
        rows, anchors = np.repeat(rows, len(shifts)), np.repeat(anchors, len(shifts))
        starts = (starts[:, None] + shifts).reshape(-1)
        _, one = np.unique(rows * len(self.term_at) + starts + self.margin, return_index=True)
        rows, starts, anchors = self._kept(windows, table, rarest, rows[one], starts[one], anchors[one], missing, slop)
        # of starts that follow one another the first
        new = np.ones(len(rows), dtype=bool)
        new[1:] = (rows[1:] != rows[:-1]) | (starts[1:] != starts[:-1] + 1)
        return chosen[rows[new]], starts[new], anchors[new]

    def _kept(self, windows, table, rarest, rows, starts, anchors, missing, slop):
        lacking = np.zeros(len(rows), dtype=np.int64)
        for k in range(table.shape[1]):
            place = rarest[rows, k]
            term = table[rows, place]
            at = starts + place + self.margin
            hit = term == windows.fill
            for d in range(-slop, slop + 1):
                hit |= self.term_at[at + d] == term
            lacking += ~hit
            kept = lacking <= missing
            rows, starts, anchors, lacking = rows[kept], starts[kept], anchors[kept], lacking[kept]
            if not len(rows):
                break
        return rows, starts, anchors


def matches(index: DataFrame, windows: Windows, near: tuple[int, int] | None = None) -> DataFrame:
    """Occurrences of windows: one row per document, item, place and kind (``phrase`` or ``near``).

    ``near`` is (terms that may be missing or misplaced, words of slack); ``None`` leaves such matches out.  Windows of
    more terms than may be missing and one take part.  Of starts that follow one another the first is given; a match that
    lacks its first words may start before its document, at a negative place.
    """
    shared = index.sparkSession.sparkContext.broadcast(windows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        names = pa.array(wanted.items, pa.string())
        missing, slop = near or (0, 0)
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row, wanted.fill, wanted.table.shape[1] + 3 * slop)
                doc_ids, keys = pa.array(row["doc_ids"], pa.int64()), pa.array(row["keys"], pa.int64())
                for kind, *how in [("phrase", 0, 0), ("near", missing, slop)][:2 if near else 1]:
                    for found in block.look_up(wanted, *how):
                        yield from listed(block, doc_ids, keys, wanted, names, kind, *found)

    def listed(block, doc_ids, keys, wanted, names, kind, which, starts, anchors):
        groups = np.cumsum(wanted.counts[which]) // 100_000
        edges = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), len(which)]
        for a, b in zip(edges, edges[1:]):
            w = which[a:b]
            times = wanted.counts[w]
            owner = np.searchsorted(block.doc_starts, anchors[a:b], side="right") - 1
            docs = pa.array(np.repeat(owner, times))
            yield pa.RecordBatch.from_arrays(
                [doc_ids.take(docs), keys.take(docs), names.take(pa.array(gather(wanted.owners, wanted.first[w], times))),
                 pa.array(np.repeat(starts[a:b] - block.doc_starts[owner], times), pa.int32()),
                 pa.array(np.repeat(wanted.lengths[w], times), pa.int32()), pa.array([kind] * int(times.sum()), pa.string())],
                ["doc_id", "row_key", "item_id", "start", "length", "kind"])

    return index.mapInArrow(run, MATCH_SCHEMA)


def slices(items: DataFrame, item_id: str, text: str, slice_bytes: int) -> Iterator[list[tuple]]:
    """The test items in slices of a bounded size, so that what is sent to the tasks has a bound."""
    items = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = int(total // slice_bytes) + 1
    for i in range(count):
        part = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == i) if count > 1 else items
        yield [(r["item"], r["text"]) for r in part.toLocalIterator()]


def find_passages(docs: DataFrame, items: DataFrame, window: int = 10, near: tuple[int, int] | None = None,
                  doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
                  slice_bytes: int = SLICE_BYTES) -> tuple[DataFrame, DataFrame]:
    """(rows, matches): ``doc_id, key, n_words`` of every document row, and all occurrences of test windows.

    A window is ``window`` words of an item; a shorter item is one window.  Null and empty texts have no
    words and no windows; a null item id is the empty text; repeated rows share id and key (a hash of the text) and so
    their matches; equal windows of several items match for each.  Other columns are not looked at.
    """
    if window + 2 * (near[1] if near else 0) >= GAP:
        raise ValueError(f"a window and its slack on both sides must be shorter than {GAP} words")
    found = rows = None
    for part in slices(items, item_id, item_text, slice_bytes):
        terms, windows = windows_of(part, window)
        index = cut_lineage(build_index(docs, terms, doc_id, text))
        one = matches(index, windows, near)
        if rows is None:
            each = index.select(F.explode(F.arrays_zip("doc_ids", "keys", "n_words")).alias("d"))
            rows = each.select(F.col("d.doc_ids").alias("doc_id"), F.col("d.keys").alias("key"),
                               F.col("d.n_words").cast("long").alias("n_words"))
            found = one
        else:
            found = found.union(one)
    return rows, found


def contamination(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """One row per document row: ``doc_id, key, n_words, n_hit, items`` and ``near_items``.

    ``n_hit`` counts the words that lie in an occurrence of a window, ``items`` are the sorted ids with such
    occurrences.  Arguments and edge cases are those of ``find_passages``.
    """
    rows, found = find_passages(docs, items, **options)
    spans = F.expr("array_sort(collect_set(CASE WHEN kind = 'phrase' THEN struct(start AS s, start + length AS e) END))")
    covered = F.expr("""aggregate(spans, struct(0L AS n, 0 AS at), (acc, x) -> struct(
        acc.n + greatest(x.e - greatest(x.s, acc.at), 0) AS n, greatest(acc.at, x.e) AS at), acc -> acc.n)""")
    ids = lambda kind: F.sort_array(F.collect_set(F.when(F.col("kind") == kind, F.col("item_id"))))
    per_doc = found.groupBy("doc_id", "key").agg(
        spans.alias("spans"), ids("phrase").alias("items"), ids("near").alias("near_items")
    ).select(F.col("doc_id").alias("__id"), F.col("key").alias("__key"), covered.alias("n_hit"), "items", "near_items")
    none = F.array().cast("array<string>")
    return rows.join(per_doc, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("key") == F.col("__key")), "left").select(
        "doc_id", "key", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("items", none).alias("items"),
        F.coalesce("near_items", none).alias("near_items"))
