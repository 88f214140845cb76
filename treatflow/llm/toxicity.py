"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled.

A sentence with known words is toxic with probability ``sigmoid(bias + sum of its words' weights)``; a
sentence without any counts as clean.  A document is clean if its sentences are, each on its own, and a
small leak covers what no sentence explains: ``1 - (1 - leak) * prod(1 - p)``, the noisy-or.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from treatflow.llm.common import text_chunks, without

SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"[^\W\d_]+")


PREFIXES = (5, 6, 7)


def features(word: str) -> list[str]:
    """The word and its longer beginnings, which cover inflected and joined forms."""
    return [word, *("<" + word[:n] for n in PREFIXES if len(word) > n)]


class WordWeights(dict):
    """Sum of the weights of a word's features, or None without any; remembers a bounded number of words."""

    REMEMBERED = 300_000

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float | None:
        known = [self.weights[f] for f in features(word) if f in self.weights]
        value = sum(known) if known else None
        if len(self) < self.REMEMBERED:
            self[word] = value
        return value


@dataclass(frozen=True)
class Model:
    """Weights by feature; its size is bounded by the number of features kept in training."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -4.0
    leak: float = 0.01

    def sentences(self, text: str | None, words: WordWeights) -> list[tuple[int, int, float]]:
        """(start, length, probability) of the sentences that hold known words."""
        text = text or ""
        hits = {w for w in set(WORD.findall(text.lower())) if words[w] is not None}
        if not hits:
            return []
        found = []
        for s in SENTENCE.finditer(text):
            known = hits.intersection(WORD.findall(s.group().lower()))
            if known:
                z = self.bias + sum(words[w] for w in sorted(known))
                found.append((s.start(), s.end() - s.start(), 1 / (1 + math.exp(-max(min(z, 30), -30)))))
        return found

    def score(self, sentences: list[tuple[int, int, float]]) -> float:
        clean = 1 - self.leak
        for _, _, p in sentences:
            clean *= 1 - p
        return float(1 - clean)


def sample_labelled(docs: DataFrame, labels: DataFrame, max_docs: int, max_chars: int, doc_id: str, text: str,
                    label: str) -> list[tuple[str, int]]:
    """Labelled rows in the order of a hash of their id, at most ``max_docs`` of each label.

    Rows with texts over ``max_chars`` are not used for training, so the sample's size is bounded.
    """
    marks = labels.filter(F.col(label).isin(0, 1)).groupBy(F.col(doc_id).alias("id")).agg(F.max(label).alias("y"))
    # chosen by narrow rows; then the texts of a bounded number of rows are fetched without a shuffle
    rows = docs.filter(F.length(text) <= max_chars).select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("key")).join(
        marks, "id").withColumn("__order", F.xxhash64("id")).distinct()
    picked = [rows.filter(F.col("y") == y).orderBy("__order", "key").limit(max_docs).collect() for y in (0, 1)]
    chosen = [(r["id"], r["key"], int(r["y"])) for part in picked for r in part]
    if not chosen:
        return []
    kinds = T.StructType([T.StructField("__label_id", docs.schema[doc_id].dataType), T.StructField("__label_key", T.LongType()),
                          T.StructField("__label", T.IntegerType())])
    wanted = F.broadcast(docs.sparkSession.createDataFrame(chosen, kinds))
    found = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(
        wanted, (F.col("id") == F.col("__label_id")) & (F.xxhash64("text") == F.col("__label_key")))
    once = {(r["id"], r["text"]): r["__label"] for r in found.select("id", "text", "__label").toLocalIterator()}
    return [(value, y) for (_, value), y in sorted(once.items())]


def train(sample: list[tuple[str, int]], vocabulary: int = 2000, least: int = 3, rounds: int = 300, rate: float = 0.1,
          penalty: float = 3e-4) -> Model:
    """Fit word weights, bias and leak to document labels by gradient steps on the noisy-or likelihood.

    Features are taken by how much more often toxic documents hold them than clean ones, a chi-squared score;
    features of fewer than ``least`` documents are left out.  Without both labels the model knows no words, and
    its leak is the share of toxic rows.
    """
    n = Counter(y for _, y in sample)
    share = n[1] / max(1, len(sample))
    if not n[0] or not n[1]:
        return Model({}, -4.0, min(max(share, 0.001), 0.999))
    holds: dict[int, Counter] = {0: Counter(), 1: Counter()}
    for text, y in sample:
        holds[y].update({f for w in set(WORD.findall(text.lower())) for f in features(w)})
    scores = {}
    for word, a in holds[1].items():
        c = holds[0][word]
        if a + c >= least and a * n[0] > c * n[1]:
            b, d = n[1] - a, n[0] - c
            scores[word] = (a * d - b * c) ** 2 / ((a + b) * (c + d) * (a + c) * max(b + d, 1))
    limit = 10.8 / len(sample)  # fixed value: the chi-squared quantile of one in a thousand
    chosen = sorted((w for w in scores if scores[w] > limit), key=lambda w: (-scores[w], w))[:vocabulary]
    number = {w: i for i, w in enumerate(chosen)}
    # entries (sentence, word) and the document of every sentence with known words
    entry_s, entry_w, owner, y = [], [], [], np.array([v for _, v in sample], dtype=float)
    for d, (text, _) in enumerate(sample):
        for s in SENTENCE.findall(text):
            known = [number[f] for w in set(WORD.findall(s.lower())) for f in features(w) if f in number]
            if known:
                entry_s += [len(owner)] * len(known)
                entry_w += known
                owner.append(d)
    entry_s, entry_w, owner = (np.array(x, dtype=np.int64) for x in (entry_s, entry_w, owner))
    w, bias, leak = np.zeros(len(chosen)), -2.0, -3.0
    params = np.concatenate([w, [bias, leak]])
    first, second = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, rounds + 1):
        w, bias, leak = params[:-2], params[-2], params[-1]
        z = bias + np.bincount(entry_s, w[entry_w], len(owner))
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        q = 1 / (1 + np.exp(-leak))
        clean = np.log1p(-np.minimum(p, 1 - 1e-9))
        log_clean = np.bincount(owner, clean, len(sample)) + np.log1p(-q)
        toxic = np.maximum(-np.expm1(log_clean), 1e-9)
        # derivative of the log likelihood by -log_clean
        slope = np.where(y == 1, np.exp(log_clean) / toxic, -1.0)
        by_z = slope[owner] * p
        grad = np.concatenate([np.bincount(entry_w, by_z[entry_s], len(chosen)), [by_z.sum(), (slope * q).sum()]]) / len(sample)
        grad[:-2] -= penalty * np.sign(w)
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        params = params + rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    weights = {word: float(v) for word, v in zip(chosen, params) if abs(v) > 0.05}
    return Model(weights, float(params[-2]), float(1 / (1 + np.exp(-params[-1]))))


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = 4000, max_chars: int = 20_000, doc_id: str = "doc_id",
        text: str = "text", label: str = "toxic") -> Model:
    """Train on a bounded sample of labelled rows: ``max_docs`` of each label, of at most ``max_chars``.

    Null texts, null or other labels and ids without labels are left out, and of several labels of
    one id the highest counts.
    """
    return train([(t or "", y) for t, y in sample_labelled(docs, labels, max_docs, max_chars, doc_id, text, label)])


def score_documents(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``score``, ``predicted`` (score of at least one half) and ``offending`` (start, length, score).

    Offending sentences are those with a probability of at least one half, by character position in the whole
    text.  Null and empty texts get the leak as score.  Columns of these names are replaced, others stay.
    """
    kept = without(docs, "score", "predicted", "offending")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    spans = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("score", pa.float64())]))
    column = next(c for c in kept.columns if c.lower() == text.lower())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        words = WordWeights(m.weights)
        for chunk in text_chunks(batches, column, 8 << 20):
            scores, offending = [], []
            for value in chunk.column(column):
                found = m.sentences(value.as_py(), words)
                scores.append(m.score(found))
                offending.append([{"start": s, "length": n, "score": float(p)} for s, n, p in found if p >= 0.5])
            yield pa.RecordBatch.from_arrays(
                [*chunk.columns, pa.array(scores), pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array(offending, spans)],
                [*chunk.schema.names, "score", "predicted", "offending"])

    offending = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("length", T.IntegerType()),
                                          T.StructField("score", T.DoubleType())]))
    new = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()), T.StructField("offending", offending)]
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *new]))
