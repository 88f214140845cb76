"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treatflow.session import BROADCAST_LIMIT_BYTES, estimated_bytes

HOT_SHARE = 10_000       # a key with more than this part of all rows is joined apart
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(column: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(column, UPPER, LOWER)


def with_row_key(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Add ``__id`` and ``__h``, which together name a document; repeats of one row share them and fare alike.

    A null id becomes the smallest long, so that keys can be compared and joined.
    """
    return docs.withColumns({
        "__id": F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63))),
        "__h": F.xxhash64(F.coalesce(F.col(text), F.lit(""))),
    })


def remainder(doc_id: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``: the fold of a document (a null id is the empty text)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % divisor


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns whose names differ from one of ``names`` at most in case."""
    low = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in low])


def text_chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each piece holds about ``limit`` bytes of text (one row at least)."""
    for batch in batches:
        lengths = np.asarray(pc.binary_length(batch.column(column)).fill_null(0), dtype=np.int64)
        groups = np.cumsum(lengths) // limit
        edges = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def text_blocks(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.Table]:
    """Gather batches to blocks of about ``limit`` bytes of text."""
    held: list[pa.RecordBatch] = []
    size = 0
    for piece in text_chunks(batches, column, limit):
        held.append(piece)
        size += int(pc.sum(pc.binary_length(piece.column(column))).as_py() or 0)
        if size >= limit:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs values[s : s + n], one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    places = np.repeat(starts - (ends - lengths), lengths)
    places += np.arange(total)
    return values[places]


def join_counted(rows: DataFrame, table: DataFrame, key: str, n: str = "n", limit: int | None = None) -> DataFrame:
    """``rows`` with the row of a written ``table`` that has their key; ``table`` has each key once, with its rows in ``n``.

    No key is hot: a table of at most ``limit`` bytes is broadcast; of a larger one, keys with a fixed part of all rows are
    few, so these are broadcast and the others are joined by shuffle.
    """
    if estimated_bytes(table) <= (BROADCAST_LIMIT_BYTES if limit is None else limit):
        return rows.join(F.broadcast(table), key)
    # at most HOT_SHARE keys hold that part of all rows each
    least = (table.agg(F.sum(n)).head()[0] or 0) // HOT_SHARE + 1
    hot, cold = table.filter(F.col(n) >= least), table.filter(F.col(n) < least)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return rows.join(F.broadcast(hot), key).unionByName(rest.join(cold, key))
