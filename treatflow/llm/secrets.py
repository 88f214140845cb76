"""Secret scans: fixed patterns, and strings that a Markov model of random strings explains better than one of identifiers."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from treatflow.llm.common import text_chunks, without

# fixed values: the kinds in their order, and the patterns of the first three with their least lengths
KINDS = ("assign", "access", "hex", "random")
# the ASCII flag keeps letters of other scripts from standing in for ASCII ones
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST = {"assign": 12, "access": 18}
TOKEN = re.compile(r"[A-Za-z0-9_+/-]{12,}={0,2}")
WORD = re.compile(r"[A-Za-z0-9_+/-]{6,}")
# cheap tests by which a text has any of them; wider than the patterns
MAY_HOLD = {"assign": r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]", "access": "AKIA[A-Z0-9]", "hex": "[0-9a-f]{16}"}

# characters of a sample: 1.. in this order; 0 stands before and after a string, the last number for any other one
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
SIZE = len(ALPHABET) + 2
EDGE, OTHER = "\x01", "?"
CODES = np.full(256, SIZE - 1, dtype=np.int64)
CODES[ord(EDGE)] = 0
CODES[np.frombuffer(ALPHABET.encode(), dtype=np.uint8)] = np.arange(1, len(ALPHABET) + 1)
# alphabets of the made random strings
MADE = ("0123456789abcdef", ALPHABET[:26] + "234567", ALPHABET[:62], ALPHABET[:62] + "+/", ALPHABET[:62] + "_-")
# words of the made identifiers, joined in the usual styles
PARTS = ("get set is has to of by add new max min num user name id key list map size count index item value node data file path "
         "time date test run start stop init load save read write open close send call make build parse check update delete create "
         "error event state config option default retry request response handler manager service client server session query "
         "table column row field type class object string buffer").split()
STYLES = (lambda w: w[0] + "".join(x.title() for x in w[1:]), lambda w: "".join(x.title() for x in w), "_".join, "-".join, "/".join,
          lambda w: "_".join(w).upper(), lambda w: "_".join(w) + str(len(w) * 7))
CHUNK_BYTES = 4 << 20
SPAN = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                                 T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType())]))

Span = tuple[int, int, int, str]     # start, number of the kind, end, value


def base_spans(text: str, kinds: tuple[str, ...] = KINDS[:3]) -> list[Span]:
    """Spans of the fixed patterns, leftmost and not overlapping within a kind, by start and kind."""
    found = []
    if "assign" in kinds:
        # a match whose value is too short still uses up its text
        found += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "access" in kinds:
        found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    if "hex" in kinds:
        found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found)


def other_tokens(text: str, base: list[Span], pattern: re.Pattern) -> list[Span]:
    """Tokens that no span of a fixed pattern holds whole."""
    tokens = [(m.start(), 3, m.end(), m[0]) for m in pattern.finditer(text)]
    return [t for t in tokens if not any(b[0] <= t[0] and t[2] <= b[2] for b in base)] if base else tokens


def scanned(texts: pa.Array, pattern: re.Pattern = TOKEN) -> Iterator[tuple[str, list[Span], list[Span]]]:
    """(text, base spans, other tokens) of each text; null is empty."""
    texts = texts.fill_null("")
    may = {k: pc.match_substring_regex(texts, p).to_pylist() for k, p in MAY_HOLD.items()}
    for i, value in enumerate(texts):
        text = value.as_py()
        base = base_spans(text, tuple(k for k in may if may[k][i]))
        yield text, base, other_tokens(text, base, pattern)


@dataclass
class Model:
    """Log-likelihood ratio of each character after the two before it: random string over ordinary identifier."""

    ratios: np.ndarray

    def scores(self, values: list[str]) -> list[float]:
        if not values:
            return []
        # two edges lead into every string, the next one's first edge ends it
        joined = (EDGE * 2 + (EDGE * 2).join(values) + EDGE * 2).encode("ascii", "replace")
        codes = CODES[np.frombuffer(joined, dtype=np.uint8)]
        by_place = self.ratios[codes[:-2], codes[1:-1], codes[2:]]
        lengths = np.array([len(v) for v in values])
        starts = np.cumsum(lengths + 2) - lengths - 2
        sums = np.concatenate([[0.0], np.cumsum(by_place, dtype=np.float64)])
        return (sums[starts + lengths + 1] - sums[starts]).tolist()


def made_strings(n: int, seed: int = 11) -> list[str]:
    """Random strings of 12 to 44 characters over the usual alphabets of keys."""
    rng = np.random.default_rng(seed)
    draws = rng.integers(0, 1 << 30, (n, 44))
    return ["".join(MADE[i % len(MADE)][d % len(MADE[i % len(MADE)])] for d in row[:12 + i // len(MADE) % 33])
            for i, row in enumerate(draws.tolist())]


def made_identifiers(n: int, seed: int = 12) -> list[str]:
    """Two to four words joined as programmers and file systems do."""
    draws = np.random.default_rng(seed).integers(0, len(PARTS), (n, 4)).tolist()
    return [STYLES[i % len(STYLES)]([PARTS[d] for d in row[:2 + i // len(STYLES) % 3]]) for i, row in enumerate(draws)]


def labelled_samples(docs: DataFrame, text: str = "text") -> DataFrame:
    """(``value``, ``label``) from all texts: values of the fixed patterns are random strings (1), other tokens of at
    least six characters are ordinary identifiers (0).  Repeats within a batch are left out at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches, "text", CHUNK_BYTES):
            found: dict[str, int] = {}
            for _, base, tokens in scanned(chunk.column("text"), WORD):
                found.update((t[3], found.get(t[3], 0)) for t in tokens)
                found.update((b[3], 1) for b in base)
            yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int32())], ["value", "label"])

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "value string, label int")


def smoothed(counts: np.ndarray) -> np.ndarray:
    """P(c | a b) of counts by (a, b, c): Witten-Bell interpolation with P(c | b), P(c) and equal shares."""
    p = np.full(SIZE, 1 / SIZE)
    for level in (counts.sum(axis=(0, 1)), counts.sum(axis=0), counts):
        types = (level > 0).sum(axis=-1, keepdims=True)
        types = np.where(types == 0, 1, types)
        p = (level + types * p) / (level.sum(axis=-1, keepdims=True) + types)
    return p


def train(grams: list[tuple[int, str, int]]) -> Model:
    """The model of counted grams (label, three characters, count)."""
    counts = np.zeros((2, SIZE, SIZE, SIZE))
    codes = CODES[np.frombuffer("".join(g for _, g, _ in grams).encode("ascii", "replace"), dtype=np.uint8)].reshape(-1, 3)
    np.add.at(counts, (np.array([y for y, _, _ in grams], dtype=np.int64), *codes.T), [n for _, _, n in grams])
    return Model((np.log(smoothed(counts[1])) - np.log(smoothed(counts[0]))).astype(np.float32))


def fit(samples: DataFrame, made: int = 20_000, value: str = "value", label: str = "label") -> Model:
    """Character models of order two from labelled samples, 1 for random strings and 0 for ordinary identifiers.

    Every distinct value counts once, with its highest label; null values and other labels are left out.  ``made``
    random strings and as many identifiers of common words, from fixed seeds, join them, so that kinds of keys and names that the
    samples lack are known, too.  All samples are counted, in Spark; what comes to the driver are counts of
    three-character grams, at most 2 * 70^3.
    """
    known = samples.filter(F.col(value).isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col(value).alias("v")).agg(
        F.max(label).cast("int").alias("y"))
    everything = f"[^{re.escape(ALPHABET)}]"
    padded = known.select("y", F.concat(F.lit(EDGE * 2), F.regexp_replace("v", everything, OTHER), F.lit(EDGE)).alias("v"))
    grams = padded.select("y", F.explode(F.expr("transform(sequence(1, length(v) - 2), i -> substr(v, i, 3))")).alias("g"))
    counted = [(r["y"], r["g"], r["n"]) for r in grams.groupBy("y", "g").agg(F.count(F.lit(1)).alias("n")).collect()]
    for y, values in ((1, made_strings(made)), (0, made_identifiers(made))):
        strings = [EDGE * 2 + v + EDGE for v in values]
        counted += [(y, gram, n) for gram, n in Counter(v[i:i + 3] for v in strings for i in range(len(v) - 2)).items()]
    return train(counted)


def masked_text(text: str, spans: list[Span]) -> str:
    """The text with every stretch of spans that overlap replaced by ``[secret]``."""
    out, at = [], 0
    for start, _, end, _ in sorted(spans):
        if start >= at or not out:
            out += [text[at:start], "[secret]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def find_secrets(docs: DataFrame, model: Model, odds: float = 1e-4, text: str = "text") -> DataFrame:
    """All rows, with ``secrets`` (kind, start, end, score) by start and kind, and ``masked``.

    The fixed patterns give the kinds ``assign``, ``access`` and ``hex``.  A token of at least 12 characters that
    none of them holds whole is ``random`` if its log-likelihood ratio outweighs the prior ``odds`` of a secret.
    ``score`` is that ratio, of the value for the fixed patterns, whose spans stay whatever it is.  Places are code points, the end is
    exclusive.  In ``masked`` every span is replaced by ``[secret]``.  Null texts have no spans and stay null, empty
    ones have none; repeated rows fare alike, an empty table gives an empty one.  Columns of the result's names are
    replaced, other columns stay.
    """
    kept = without(docs, "secrets", "masked")
    column = next(c for c in kept.columns if c.lower() == text.lower())
    shared = docs.sparkSession.sparkContext.broadcast(model)
    least = -float(np.log(odds))
    span_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches, column, CHUNK_BYTES):
            rows = list(scanned(chunk.column(column)))
            scores = iter(shared.value.scores([s[3] for _, base, tokens in rows for s in (*base, *tokens)]))
            spans, masked = [], []
            for text_value, base, tokens in rows:
                scored = [(s, next(scores)) for s in (*base, *tokens)]
                found = sorted((s, r) for s, r in scored if s[1] < 3 or r > least)
                spans.append([{"kind": KINDS[s[1]], "start": s[0], "end": s[2], "score": r} for s, r in found])
                masked.append(masked_text(text_value, [s for s, _ in found]))
            hidden = pc.if_else(chunk.column(column).is_null(), pa.scalar(None, pa.string()), pa.array(masked, pa.string()))
            yield pa.RecordBatch.from_arrays([*chunk.columns, pa.array(spans, span_type), hidden],
                                             [*chunk.schema.names, "secrets", "masked"])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField("secrets", SPAN), T.StructField("masked", T.StringType())]))
