"""Periodic runs of words, found by block convolution.

A text is a row of word numbers.  At every dyadic scale ``b`` it is cut into blocks of ``b`` words; each block is
compared with all places of a window that follows it at once: the sums of squared differences
``sum(x^2) + sum(y^2) - 2 * sum(x * y)`` come from one number-theoretic transform, exactly.  A sum of zero is an
occurrence of the block, and its distance from the block is a period of that stretch, which is then extended
word by word to both sides.

A run of period q has at least 4 * q words, so 3 * q places whose word comes again q words later, and any
2 * b - 1 places in a row hold a whole block.  So the scale with (2 * b - 1) / 3 <= q < (4 * b - 1) / 3 sees every
run of period q; a window of less than 2 * b words holds all distances of a scale, and transforms have size 2 * b.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from treatflow.llm.common import text_chunks, without

# primes k * 2^m + 1 below 2^31, so that products fit 64 bits; sums below their product (over 2^61) are told apart
PRIMES = (2013265921, 1811939329)
LEAST_LENGTH, LEAST_POWER = 6, 4
CHUNK_BYTES = 1 << 20
ROW_ITEMS = 1 << 15      # numbers that one transform handles at once, to stay in a core's cache
RUN_TYPE = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))


@functools.cache
def generator(p: int) -> int:
    """The smallest number whose powers are all numbers but 0 modulo ``p``; p - 1 has no primes but 2, 3 and 5."""
    return next(g for g in range(2, p) if all(pow(g, (p - 1) // f, p) != 1 for f in (2, 3, 5) if (p - 1) % f == 0))


@functools.cache
def twiddles(p: int, size: int, inverse: bool) -> list[np.ndarray]:
    """Powers of the roots of unity for the halves of 2, 4, ... ``size`` numbers."""
    out = []
    half = 1
    while half < size:
        root = pow(generator(p), (p - 1) // (2 * half), p)
        if inverse:
            root = pow(root, -1, p)
        powers = np.ones(half, dtype=np.uint64)
        step, known = root, 1
        while known < half:
            powers[known:2 * known] = powers[:known] * np.uint64(step) % np.uint64(p)
            step, known = step * step % p, 2 * known
        out.append(powers)
        half *= 2
    return out


def _times(a: np.ndarray, b: np.ndarray, p: np.uint64) -> np.ndarray:
    product = a * b
    quotient = product // p
    quotient *= p
    product -= quotient
    return product


def forward(rows: np.ndarray, p: int) -> np.ndarray:
    """Transform of each row, in bit-reversed order (decimation in frequency)."""
    q, size = np.uint64(p), rows.shape[1]
    for w in reversed(twiddles(p, size, False)):
        pairs = rows.reshape(len(rows), -1, 2, len(w))
        out = np.empty_like(pairs)
        u, v = pairs[:, :, 0], pairs[:, :, 1]
        total = u + v
        # a wrapped difference is the larger one, so the minimum is the value reduced by p
        out[:, :, 0] = np.minimum(total, total - q)
        out[:, :, 1] = _times(u + (q - v), w, q)
        rows = out.reshape(len(rows), size)
    return rows


def backward(rows: np.ndarray, p: int) -> np.ndarray:
    """Inverse of ``forward``, without the division by the size (decimation in time)."""
    q, size = np.uint64(p), rows.shape[1]
    for w in twiddles(p, size, True):
        pairs = rows.reshape(len(rows), -1, 2, len(w))
        out = np.empty_like(pairs)
        u, v = pairs[:, :, 0], _times(pairs[:, :, 1], w, q)
        total, rest = u + v, u + (q - v)
        out[:, :, 0] = np.minimum(total, total - q)
        out[:, :, 1] = np.minimum(rest, rest - q)
        rows = out.reshape(len(rows), size)
    return rows


def _matches(blocks: np.ndarray, windows: np.ndarray, lags: int, p: int) -> np.ndarray:
    """Whether the squared differences of block and window sum to zero modulo ``p``, by row and lag."""
    q, b = np.uint64(p), blocks.shape[1]
    size = 2 * b
    x = np.zeros((len(blocks), size), dtype=np.uint64)
    # a reversed block turns the convolution into a correlation: lag k stands at b - 1 + k
    x[:, :b] = blocks[:, ::-1] % q
    y = np.zeros_like(x)
    y[:, :windows.shape[1]] = windows % q
    product = backward(_times(forward(x, p), forward(y, p), q), p)
    cross = _times(product, np.uint64(pow(size, -1, p)), q)
    # places past the end are those of lag 0 and on only while b - 1 + k < 2 * b, which holds for all lags
    cross = cross[:, b - 1:b - 1 + lags]
    own = (x * x % q).sum(axis=1) % q
    sums = np.zeros((len(y), windows.shape[1] + 1), dtype=np.uint64)
    np.cumsum(y[:, :windows.shape[1]] * y[:, :windows.shape[1]] % q, axis=1, out=sums[:, 1:])
    theirs = (sums[:, b:b + lags] - sums[:, :lags]) % q
    return (own[:, None] + theirs) % q == cross * np.uint64(2) % q


def scale_distances(b: int) -> tuple[int, int]:
    """First and last period that the blocks of ``b`` words look for."""
    return -(-(2 * b - 1) // 3), -(-(4 * b - 1) // 3) - 1


def block_occurrences(numbers: np.ndarray, starts: np.ndarray, ends: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place of the block, distance) of every block of ``b`` words that comes again in its window.

    ``numbers`` holds the texts one after another, text t from ``starts[t]`` to ``ends[t]``.
    """
    low, high = scale_distances(b)
    sizes = ends - starts
    lags = high - low + 1
    # whole blocks that have room for the smallest distance, in texts that can hold a run of it
    counts = np.where(sizes >= max(LEAST_LENGTH, LEAST_POWER * low), np.maximum((sizes - low) // b, 0), 0)
    text = np.repeat(np.arange(len(sizes)), counts)
    if not len(text):
        return text, text, text
    place = starts[text] + (np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)) * b
    stranger = np.uint64(int(numbers.max()) + 1)
    # sums of squares must stay below the product of the primes
    assert b * (int(stranger) + 1) ** 2 < PRIMES[0] * PRIMES[1]
    at_block, at_window = np.arange(b), np.arange(low, high + b)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    rows = max(1, ROW_ITEMS // (2 * b))
    for i in range(0, len(place), rows):
        here, of = place[i:i + rows], text[i:i + rows]
        blocks = numbers[here[:, None] + at_block]
        where = here[:, None] + at_window
        windows = np.where(where < ends[of][:, None], numbers[np.minimum(where, len(numbers) - 1)], stranger)
        equal = _matches(blocks, windows, lags, PRIMES[0])
        hit = np.flatnonzero(equal.any(axis=1))
        if len(hit):
            # the second prime for the blocks that the first one lets pass
            row, lag = np.nonzero(equal[hit] & _matches(blocks[hit], windows[hit], lags, PRIMES[1]))
            found.append((of[hit[row]], here[hit[row]], lag + low))
    if not found:
        return text[:0], text[:0], text[:0]
    return tuple(np.concatenate(part) for part in zip(*found))


def _first_difference(x: np.ndarray, at: int, d: int) -> int:
    """The first place from ``at`` on whose number does not come again ``d`` later."""
    step, last = 64, len(x) - d
    while at < last:
        end = min(at + step, last)
        differs = x[at:end] != x[at + d:end + d]
        k = int(differs.argmax())
        if differs[k]:
            return at + k
        at, step = end, min(2 * step, 1 << 16)
    return last


def _last_difference(x: np.ndarray, at: int, d: int) -> int:
    """The place after the last one before ``at`` whose number does not come again ``d`` later; 0 if none."""
    step = 64
    while at > 0:
        begin = max(at - step, 0)
        differs = x[begin:at] != x[begin + d:at + d]
        k = int(differs[::-1].argmax())
        if differs[len(differs) - 1 - k]:
            return at - k
        at, step = begin, min(2 * step, 1 << 16)
    return 0


class TextRuns:
    """Runs of one text, from the distances found at growing scales."""

    def __init__(self, numbers: np.ndarray):
        self.numbers = numbers
        self.found: dict[tuple[int, int], int] = {}

    def _inside_found(self, place: np.ndarray, end: np.ndarray, distance: np.ndarray) -> np.ndarray:
        """Whether a seed's stretch lies in a run whose period divides its distance: it has that period, too."""
        if not self.found:
            return np.zeros(len(place), dtype=bool)
        runs = np.array(sorted((s, e, q) for (s, e), q in self.found.items()))
        # of the runs that begin before a place the one that reaches farthest
        reach = np.maximum.accumulate(runs[:, 1])
        farthest = np.maximum.accumulate(np.where(runs[:, 1] == reach, np.arange(len(runs)), 0))
        before = np.searchsorted(runs[:, 0], place, "right") - 1
        run = runs[farthest[np.maximum(before, 0)]]
        return (before >= 0) & (end <= run[:, 1]) & (run[:, 2] < distance) & (distance % run[:, 2] == 0)

    def extend(self, place: np.ndarray, distance: np.ndarray, b: int) -> None:
        rest = ~self._inside_found(place, place + b + distance, distance)
        last, until = 0, -1
        order = np.lexsort((place[rest], distance[rest]))
        for at, d in zip(place[rest][order].tolist(), distance[rest][order].tolist()):
            if d == last and at < until:
                continue
            begin = _last_difference(self.numbers, at, d)
            last, until = d, _first_difference(self.numbers, at + b, d)
            end = until + d
            if end - begin >= max(LEAST_LENGTH, LEAST_POWER * d):
                # one stretch may be found by multiples of its period: the smallest one counts
                self.found[begin, end] = min(d, self.found.get((begin, end), d))

    def runs(self) -> list[tuple[int, int, int]]:
        return sorted((s, e - s, q) for (s, e), q in self.found.items())


def runs_of(texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of all runs of each text, given as word numbers, by start and period."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    numbers = np.concatenate([*texts, np.zeros(0, dtype=np.int64)]).astype(np.uint64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    found: dict[int, TextRuns] = {}
    b = 2
    while len(texts) and LEAST_POWER * scale_distances(b)[0] <= sizes.max():
        text, place, distance = block_occurrences(numbers, starts, ends, b)
        order = np.argsort(text, kind="stable")
        text, place, distance = text[order], place[order], distance[order]
        edges = [0, *(np.flatnonzero(np.diff(text)) + 1).tolist(), len(text)]
        for lo, hi in zip(edges, edges[1:]):
            if hi > lo:
                t = int(text[lo])
                found.setdefault(t, TextRuns(texts[t])).extend(place[lo:hi] - starts[t], distance[lo:hi], b)
        b *= 2
    return [found[t].runs() if t in found else [] for t in range(len(texts))]


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    steps = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0).tolist()]


def word_numbers(words: list[bytes]) -> np.ndarray:
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), dtype=np.int64, count=len(words))


def find_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """All rows, with ``n_words``, ``runs`` (start, length, period in words) and ``collapsed``.

    Words are what ASCII white space leaves.  A run is a stretch of words with smallest period q, of at least
    6 and 4 * q words, that no neighbouring word extends.  ``collapsed`` is the text without the words
    that a run holds after its first period, joined by single spaces.  Null, empty and blank texts have no words,
    no runs and an empty ``collapsed``; repeated rows fare alike, an empty table gives an empty one.  Columns of
    the result's names are replaced, other columns stay.  A text is handled whole by one task, of which a task
    holds about a megabyte, or one text, at a time.
    """
    kept = without(docs, "n_words", "runs", "collapsed")
    column = next(c for c in kept.columns if c.lower() == text.lower())
    run_type = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches, column, CHUNK_BYTES):
            words = [(t.as_py() or "").encode("utf-8").split() for t in chunk.column(column)]
            found = runs_of([word_numbers(w) for w in words])
            yield pa.RecordBatch.from_arrays(
                [*chunk.columns, pa.array([len(w) for w in words], pa.int64()),
                 pa.array([[{"start": s, "length": n, "period": q} for s, n, q in f] for f in found], run_type),
                 pa.array([b" ".join(kept_words(w, f)).decode("utf-8") for w, f in zip(words, found)], pa.string())],
                [*chunk.schema.names, "n_words", "runs", "collapsed"])

    new = [T.StructField("n_words", T.LongType()), T.StructField("runs", RUN_TYPE), T.StructField("collapsed", T.StringType())]
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *new]))
