"""Packing of documents into training windows by best-fit decreasing."""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treatflow.llm.common import gather, text_chunks

SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
CHUNK_BYTES = 4 << 20
# fixed value: the white space characters of the tokenizer's word pattern
SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


class CapacityTree:
    """Segment tree over remaining capacities; a leaf holds the open windows with that many places left."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(self.leaves)]

    def add(self, capacity: int, window: int) -> None:
        self.windows[capacity].append(window)
        self._change(capacity, 1)

    def _change(self, capacity: int, by: int) -> None:
        i = self.leaves + capacity
        while i:
            self.count[i] += by
            i >>= 1

    def tightest(self, length: int) -> int | None:
        """Smallest capacity of an open window that holds ``length``."""
        i = self.leaves + length
        if not self.count[i]:
            while i > 1 and (i & 1 or not self.count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        return i - self.leaves

    def take(self, capacity: int) -> int:
        self._change(capacity, -1)
        return self.windows[capacity].pop()


def best_fit_decreasing(lengths: list[int], window: int) -> list[list[int]]:
    """Items of every window, by number; the longest items come first, each into the tightest window that holds it."""
    tree = CapacityTree(window)
    windows: list[list[int]] = []
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        length = lengths[item]
        capacity = tree.tightest(length)
        if capacity is None:
            number, capacity = len(windows), window
            windows.append([])
        else:
            number = tree.take(capacity)
        windows[number].append(item)
        if capacity > length:
            tree.add(capacity - length, number)
    return windows


def plan(totals: list[int], window: int, slack: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length) that hold every token once.

    Full windows are cut from overlong documents, the rest is packed by best fit.  Windows that are left
    with more than ``slack`` free places are then filled up with cuts from the emptiest windows, and the
    last of those is cut at powers of two, which need no padding.
    """
    sequences, rest = [], []
    for doc, total in enumerate(totals):
        full = total - total % window
        sequences += [[(doc, start, window)] for start in range(0, full, window)]
        if total > full:
            rest.append((doc, full, total - full))
    packed = [[rest[i] for i in items] for items in best_fit_decreasing([n for _, _, n in rest], window)]
    filled = [sum(p[2] for p in pieces) for pieces in packed]
    order = sorted(range(len(packed)), key=lambda i: filled[i])
    open_ = [i for i in order if window - filled[i] > slack]
    low, high = 0, len(open_) - 1
    while low < high:
        donor, taker = open_[low], open_[high]
        gap = window - filled[taker]
        if gap == 0:
            high -= 1
            continue
        doc, start, length = packed[donor].pop()
        moved = min(gap, length)
        packed[taker].append((doc, start + length - moved, moved))
        if moved < length:
            packed[donor].append((doc, start, length - moved))
        filled[taker] += moved
        filled[donor] -= moved
        if not packed[donor]:
            low += 1
    sequences += [pieces for i, pieces in enumerate(packed) if pieces and not (open_ and i == open_[high])]
    if open_:
        left = packed[open_[high]]
        while left:
            room = 1 << (sum(p[2] for p in left).bit_length() - 1)
            pieces = []
            while room:
                doc, start, length = left.pop(0)
                used = min(room, length)
                pieces.append((doc, start, used))
                if used < length:
                    left.insert(0, (doc, start + used, length - used))
                room -= used
            sequences.append(pieces)
    return sequences


class Encoder:
    """Ids of texts by the byte-level BPE of a tokenizer file.

    Every word and its leading space is a unit of that tokenizer, so each distinct word of a chunk is encoded
    once.  Texts with white space of more than one character around a space, or with the end marker's
    string, go to the tokenizer whole.
    """

    CACHED = 200_000

    def __init__(self, tokenizer_file: str, ranks_file: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(tokenizer_file)
        ranks = {}
        with open(ranks_file, "rb") as lines:
            for line in lines:
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
        self.words = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.cache: dict[str, bytes] = {}
        special = [re.escape(t.content) for t in self.whole.get_added_tokens_decoder().values()]
        self.odd = "|".join([f"{SPACE} {SPACE}", f"{SPACE} \\z", *special])

    def _word(self, word: str) -> bytes:
        ids = self.cache.get(word)
        if ids is None:
            ids = array("I", self.words.encode_ordinary(word)).tobytes()
            if len(self.cache) < self.CACHED:
                self.cache[word] = ids
        return ids

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and how many each text has."""
        texts = texts.fill_null("")
        odd = np.flatnonzero(np.asarray(pc.match_substring_regex(texts, self.odd)))
        split = pc.split_pattern(texts, " ")
        per_text = np.asarray(split.value_lengths(), dtype=np.int64)
        coded = split.flatten().dictionary_encode()
        which = np.asarray(coded.indices, dtype=np.int64).copy()
        words = coded.dictionary.to_pylist()
        first = np.cumsum(per_text) - per_text
        # the first word of a text has no space before it
        openers = [words[i] for i in which[first]]
        which[first] = len(words) + np.arange(len(first))
        units = [self._word(" " + w) for w in words] + [self._word(w) for w in openers]
        sizes = np.fromiter(map(len, units), dtype=np.int64, count=len(units)) // 4
        ids = gather(np.frombuffer(b"".join(units), dtype="<u4"), np.cumsum(sizes)[which] - sizes[which], sizes[which])
        counts = np.add.reduceat(sizes[which], first)
        if len(odd):
            runs = np.split(ids, np.cumsum(counts)[:-1])
            for i in odd.tolist():
                runs[i] = np.array(self.whole.encode(texts[i].as_py(), add_special_tokens=False).ids, dtype="<u4")
                counts[i] = len(runs[i])
            ids = np.concatenate(runs)
        return ids, counts


def pack(docs: DataFrame, tokenizer_file: str, ranks_file: str, pattern: str, window: int = 2048, end_id: int = 1,
         slack: int = 16, block_tokens: int = 1 << 20, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pack all documents into sequences of at most ``window`` tokens; one row per piece, with its ids.

    A document is its ids and ``end_id``.  Every task packs what it reads, in blocks of about ``block_tokens``
    tokens, so no row is shuffled and a task holds one block; a block wastes at most ``slack`` places a window.
    ``sequence_id`` is made of the partition's number and a counter.  ``ids`` are unsigned 32-bit, little-endian.
    Null text counts as empty, repeated rows are packed as often as they come, a null id stays null, other
    columns are left out, and an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(tokenizer_file, ranks_file, pattern)
        base = TaskContext.get().partitionId() << 33
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        size = 0
        for chunk in text_chunks(batches, "text", CHUNK_BYTES):
            ids, counts = encode(chunk.column("text"))
            ends = np.cumsum(counts)
            ids, counts = np.insert(ids, ends, end_id), counts + 1
            held.append((chunk.column("doc_id"), ids.astype("<u4"), counts))
            size += len(ids)
            if size >= block_tokens:
                base, batch = packed_block(held, base)
                yield batch
                held, size = [], 0
        if held:
            yield packed_block(held, base)[1]

    def packed_block(held, base):
        names = pa.concat_arrays([h[0] for h in held])
        ids = np.concatenate([h[1] for h in held])
        totals = np.concatenate([h[2] for h in held])
        sequences = plan(totals.tolist(), window, slack)
        sizes = np.fromiter(map(len, sequences), dtype=np.int64, count=len(sequences))
        doc, start, length = np.array([p for s in sequences for p in s], dtype=np.int64).reshape(-1, 3).T
        sequence = np.repeat(np.arange(len(sequences)), sizes)
        before = np.cumsum(length) - length
        offset = before - np.repeat(before[np.cumsum(sizes) - sizes], sizes)
        at = (np.cumsum(totals) - totals)[doc] + start
        cut = gather(ids, at, length)
        offsets = np.concatenate([[0], np.cumsum(length) * 4]).astype(np.int32)
        blobs = pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(offsets), pa.py_buffer(cut.tobytes())])
        batch = pa.RecordBatch.from_arrays(
            [names.take(pa.array(doc)), *map(pa.array, (start, length, totals[doc], base + sequence, offset)), blobs],
            ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])
        return base + len(sequences), batch

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, SCHEMA)
