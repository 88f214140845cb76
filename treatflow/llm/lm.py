"""Language model scores by a weighted backoff automaton over words.

States are the histories of two words and of one word that training has seen (the start of a text stands for a word),
and the root.  A state has an arc for every word that followed it in training, which carries the log of the smoothed
probability and leads to the longest history that is a state, and a failure arc to the history without its first word, which
carries the weight that smoothing leaves for it; the root has an arc for every word.  Texts are read once from left to
right: each word is met in the state that the words before it led to and takes its arc there, or failure arcs until one is
there.

P(w | h) = (1 - b(h)) * c(h w) / c(h) + b(h) * P(w | h'), and P(w) = (c(w) + 1) / (N + V + 1).  The weight b(h) is
estimated from counts of counts: among the histories that are about as frequent as h (by powers of two), the share of
followers that were seen once, which is how often leaving one out leaves a follower unseen.

The automaton grows with the corpus, so no task holds it whole.  Blocks of documents ask for the arcs that they
can meet: they send the distinct hashes of their words and pairs, with their own training counts, to
buckets of hashes, which add them up and answer every block.  Triples follow in a second round, but only those whose both
pairs occur in other blocks, too: the others are counted where they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treatflow.llm.common import remainder, text_blocks
from treatflow.session import cut_lineage, shared_folder

BLOCK_BYTES = 5 << 20
BUCKET_TOKENS = 2_000_000
END, START = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
CLASSES = 48
BLOCK_SCHEMA = "block long, doc_ids array<long>, held array<boolean>, sizes array<int>, vocabulary binary, words binary"
STATS = "array<struct<level:int,class:int,once:long,tokens:long>>"
ASK_SCHEMA = f"bucket int, block long, hashes array<binary>, counts array<binary>, classes binary, stats {STATS}"
ANSWER_SCHEMA = f"bucket int, block long, totals array<binary>, n_types long, n_tokens long, stats {STATS}"
SCORE_SCHEMA = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
                "score double")


def packed(values: np.ndarray, kind: str) -> bytes:
    """Numbers byte plane by byte plane, of which the upper ones are almost empty, compressed."""
    data = np.ascontiguousarray(values.astype(kind))
    return zstandard.compress(data.view(np.uint8).reshape(-1, data.itemsize).T.tobytes(), 1)


def unpacked(blob: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(blob), dtype=np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def tokenized(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of distinct words, word numbers of all texts, words per text); the last number is the end's.

    Words are what ASCII white space leaves, with A-Z lower-cased; every text has one end.  Frequent words have
    small numbers, which pack well.
    """
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    sizes = np.asarray(split.value_lengths(), dtype=np.int64)
    coded = split.flatten().dictionary_encode()
    words = coded.dictionary.to_pylist()
    numbers = np.asarray(coded.indices, dtype=np.int64)
    hashes = np.array([xxhash.xxh64_intdigest(w.encode("utf-8")) for w in words] + [END], dtype=np.uint64)
    ends = np.cumsum(sizes)
    numbers = np.insert(numbers, ends, len(words))
    owner = np.repeat(np.arange(len(sizes)), sizes + 1)
    if "" in words:
        full = numbers != words.index("")
        numbers, owner = numbers[full], owner[full]
    order = np.append(np.argsort(-np.bincount(numbers, minlength=len(hashes))[:-1], kind="stable"), len(words))
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    return hashes[order], rank[numbers], np.bincount(owner, minlength=len(sizes))


def packed_hashes(sorted_hashes: np.ndarray) -> bytes:
    """Sorted hashes as differences."""
    return packed(np.diff(sorted_hashes, prepend=np.uint64(0)), "<u8")


def unpacked_hashes(blob: bytes) -> np.ndarray:
    return np.cumsum(unpacked(blob, "<u8"), dtype=np.uint64)


def mixed(state: np.ndarray, word: np.ndarray) -> np.ndarray:
    h = (state * np.uint64(0x9FB21C651E98DF25) + word) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ h >> np.uint64(32)


def class_of(counts: np.ndarray) -> np.ndarray:
    """Power of two of a history's count."""
    return np.minimum(np.log2(np.maximum(counts, 1)).astype(np.int64), CLASSES - 1)


def class_stats(level: int, classes: np.ndarray, totals: np.ndarray) -> list[dict]:
    """Followers seen once, and all, by class of their history."""
    once = np.bincount(classes[totals == 1], minlength=CLASSES)
    tokens = np.bincount(classes, weights=totals, minlength=CLASSES).astype(np.int64)
    return [{"level": level, "class": int(c), "once": int(once[c]), "tokens": int(tokens[c])} for c in np.flatnonzero(tokens)]


class Ask:
    """Hashes to ask for, in the order in which buckets get them."""

    def __init__(self, hashes: np.ndarray, own: np.ndarray, chosen: np.ndarray, buckets: int):
        # a block's counts and places fit 32 bits
        self.own, self.chosen, self.hashes = own.astype(np.int32), chosen.astype(np.int32), hashes
        bucket = (hashes[chosen] >> np.uint64(33)).astype(np.int64) % buckets
        order = np.lexsort((hashes[chosen], bucket))
        self.order = self.chosen[order]
        self.edges = np.searchsorted(bucket[order], np.arange(buckets + 1))

    def part(self, bucket: int) -> np.ndarray:
        return self.order[self.edges[bucket]:self.edges[bucket + 1]]

    def totals(self, answers: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(counts over all blocks, whether this block is the first with it); what was not asked for is the block's own."""
        sums, first = self.own.astype(np.int64), self.own > 0
        for bucket, blob in answers.items():
            found = unpacked(blob, "<u8").view(np.int64)
            sums[self.part(bucket)] = found >> 1
            first[self.part(bucket)] = (found & 1).astype(bool)
        return sums, first


class BlockText:
    """A block's words, pairs and triples, each numbered, and how often training has them here."""

    def __init__(self, row: dict, buckets: int):
        self.vocabulary = np.frombuffer(row["vocabulary"], "<u8")
        self.numbers = unpacked(row["words"], "<u4").astype(np.int64)
        self.sizes = np.array(row["sizes"], dtype=np.int64)
        self.width = len(self.vocabulary) + 1
        self.first = np.cumsum(self.sizes) - self.sizes
        self.trained = np.repeat(~np.array(row["held"], dtype=bool), self.sizes)
        self.buckets = buckets
        # the state before a text's first word has the number after the last word
        before = np.empty_like(self.numbers)
        before[1:] = self.numbers[:-1]
        before[self.first] = self.width - 1
        self.pairs, pair = np.unique(before * self.width + self.numbers, return_inverse=True)
        self.pair = pair.astype(np.int32)
        del before, pair
        states = np.append(self.vocabulary, np.uint64(START))
        self.pair_hashes = mixed(states[self.pairs // self.width], states[self.pairs % self.width])
        count = lambda inverse, trained, n: np.bincount(inverse[trained], minlength=n)
        self.words_asked = Ask(self.vocabulary, count(self.numbers, self.trained, len(self.vocabulary)),
                               np.arange(len(self.vocabulary)), buckets)
        self.pairs_asked = Ask(self.pair_hashes, count(self.pair, self.trained, len(self.pairs)), np.arange(len(self.pairs)), buckets)

    def with_triples(self, pair_totals: np.ndarray) -> BlockText:
        """Number the triples (pair, word); ask for those whose both pairs occur elsewhere, too."""
        inner = np.ones(len(self.numbers), dtype=bool)
        inner[self.first] = False
        at = np.flatnonzero(inner)
        self.triples, where, triple = np.unique(
            self.pair[at - 1].astype(np.int64) * self.width + self.numbers[at], return_index=True, return_inverse=True)
        self.last_pair = self.pair[at[where]]
        history = self.triples // self.width
        own = np.bincount(triple[self.trained[at]], minlength=len(self.triples))
        elsewhere = pair_totals > self.pairs_asked.own
        hashes = mixed(self.pair_hashes[history] ^ np.uint64(END), self.vocabulary[self.triples % self.width])
        self.triples_asked = Ask(hashes, own, np.flatnonzero(elsewhere[history] & elsewhere[self.last_pair]), self.buckets)
        return self


class Automaton:
    """The arcs and failure arcs that a block's texts can meet.

    States are numbers of pairs (two words of history) and of words or the start (one word); an arc's key is its state times
    the number of words, plus its word.  Arrays of keys are sorted, a weight of NaN is no arc.
    """

    def __init__(self, block: BlockText, totals: list[np.ndarray], n_tokens: int, n_types: int, n_trained: int, backoff: np.ndarray):
        words, pairs, triples = totals
        self.width, self.pairs, self.triples = block.width, block.pairs, block.triples
        self.root = np.log10((words + 1) / (n_tokens + n_types + 1))
        states = np.append(words, n_trained)
        weight = backoff[0][class_of(states)]
        history, word = self.pairs // self.width, self.pairs % self.width
        self.pair_arcs = self._arcs(pairs, states[history], weight[history], self.root[word])
        self.fail = np.where(states > 0, np.log10(weight), 0.0)
        longer = backoff[1][class_of(pairs)]
        history = self.triples // self.width
        self.triple_arcs = self._arcs(triples, pairs[history], longer[history], self.pair_arcs[block.last_pair])
        self.pair_fail = np.log10(longer)
        self.is_state = pairs > 0

    @staticmethod
    def _arcs(counts: np.ndarray, history: np.ndarray, weight: np.ndarray, lower: np.ndarray) -> np.ndarray:
        share = counts / np.maximum(history, 1)
        return np.where(counts > 0, np.log10((1 - weight) * share + weight * 10.0 ** np.where(counts > 0, lower, 0.0)), np.nan)

    def read(self, numbers: np.ndarray, pair: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Log10 probability of every text, in one pass over the block's words from left to right.

        ``pair`` has the number of (word before, word) at every place, which is the state that the word leads to if training
        has seen it; states are handed on from place to place, and a text begins in the state of its start.
        """
        state = np.empty(len(numbers), dtype=np.int64)
        state[1:] = np.where(self.is_state[pair[:-1]], pair[:-1], -1)
        state[first] = -1
        score = np.full(len(numbers), np.nan)
        deep = np.flatnonzero(state >= 0)
        if len(deep):
            key = state[deep] * self.width + numbers[deep]
            at = np.minimum(np.searchsorted(self.triples, key), len(self.triples) - 1)
            score[deep] = np.where(self.triples[at] == key, self.triple_arcs[at], np.nan)
        # the failure arc of two words of history, then the arc of the last word
        failed = np.flatnonzero(np.isnan(score))
        cost = np.where(state[failed] >= 0, self.pair_fail[state[failed]], 0.0)
        shorter = self.pair_arcs[pair[failed]]
        # the failure arc of one word of history, then the root's arc, which is always there
        last = np.flatnonzero(np.isnan(shorter))
        history = self.pairs[pair[failed[last]]] // self.width
        shorter[last] = self.fail[history] + self.root[numbers[failed[last]]]
        score[failed] = cost + shorter
        return np.add.reduceat(score, first)


def summed(table: pa.Table, kinds: int) -> tuple[list[list[bytes]], list[np.ndarray], list[np.ndarray]]:
    """Totals for every message of a bucket, by kind, and the distinct hashes' sums and classes."""
    answers, sums_by_kind, first_by_kind = [], [], []
    for kind in range(kinds):
        hashes = [unpacked_hashes(h[kind]) for h in table.column("hashes").to_pylist()]
        counts = np.concatenate([unpacked(c[kind], "<u4") for c in table.column("counts").to_pylist()])
        edges = np.cumsum([0, *map(len, hashes)])
        distinct, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
        sums = np.bincount(inverse, weights=counts, minlength=len(distinct)).astype(np.int64)
        # the first message whose block was trained on it
        trained = np.flatnonzero(counts)
        _, place = np.unique(inverse[trained], return_index=True)
        first = np.zeros(len(inverse), dtype=np.int64)
        first[trained[place]] = 1
        found = sums[inverse] * 2 + first
        answers.append([packed(found[a:b], "<u8") for a, b in zip(edges, edges[1:])])
        sums_by_kind.append(sums)
        first_by_kind.append(first)
    return answers, sums_by_kind, first_by_kind


def written_in_buckets(df: DataFrame, key: str) -> DataFrame:
    """A table in the shared folder, bucketed by ``key``: joins and groups on it do not move its rows."""
    spark = df.sparkSession
    name = f"buckets_{uuid.uuid4().hex}"
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(count, key).option("path", f"{shared_folder(spark).rstrip('/')}/{name}").saveAsTable(name)
    return spark.table(name)


def score_texts(docs: DataFrame, folds: int = 7, held_fold: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Scores of every row by a model of the rows outside the held-out fold; see ``SCORE_SCHEMA``.

    ``base_score`` is by single words, ``score`` by the automaton.  Null and empty texts are their end alone, a
    null id is in the fold of the empty text, repeated rows are trained on and scored as often as they come, and
    other columns are left out.
    """

    def to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for block in text_blocks(batches, "text", BLOCK_BYTES):
            hashes, numbers, sizes = tokenized(block.column("text").combine_chunks())
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([block.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                 pa.array([block.column("held").to_pylist()]), pa.array([sizes.tolist()], pa.list_(pa.int32())),
                 pa.array([hashes.astype("<u8").tobytes()]), pa.array([packed(numbers, "<u4")])],
                ["block", "doc_ids", "held", "sizes", "vocabulary", "words"])
            number += 1

    # blocks meet their answers twice, so they are written in buckets and stay where they are
    blocks = written_in_buckets(docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), (remainder(doc_id, folds) == held_fold).alias("held"),
        F.col(text).alias("text")).mapInArrow(to_blocks, BLOCK_SCHEMA), "block")
    known = blocks.select(F.explode(F.arrays_zip("held", "sizes")).alias("d")).agg(
        F.sum("d.sizes").alias("tokens"), F.sum((~F.col("d.held")).cast("long")).alias("trained")).first()
    buckets = int((known["tokens"] or 0) // BUCKET_TOKENS) + 1
    n_trained = known["trained"] or 0
    stats_type = pa.list_(pa.struct([("level", pa.int32()), ("class", pa.int32()), ("once", pa.int64()), ("tokens", pa.int64())]))
    blobs = pa.list_(pa.binary())

    def messages(block: int, asks: list[Ask], classes: np.ndarray | None, stats: list[dict]) -> pa.Table:
        """One row per bucket that is asked; the first row of a block carries its counts of counts."""
        wanted = [b for b in range(buckets) if any(len(a.part(b)) for a in asks)] or [0]
        counted = [[packed(a.own[a.part(b)], "<u4") for a in asks] for b in wanted]
        return pa.table({
            "bucket": pa.array(wanted, pa.int32()), "block": pa.array([block] * len(wanted), pa.int64()),
            "hashes": pa.array([[packed_hashes(a.hashes[a.part(b)]) for a in asks] for b in wanted], blobs), "counts": pa.array(counted, blobs),
            "classes": pa.array([b"" if classes is None else packed(classes[asks[0].part(b)], "u1") for b in wanted], pa.binary()),
            "stats": pa.array([stats, *[[]] * (len(wanted) - 1)], stats_type)})

    def ask_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                text_block = BlockText(row, buckets)
                yield from messages(row["block"], [text_block.words_asked, text_block.pairs_asked], None, []).to_batches()

    def answered(table: pa.Table, answers: list[list[bytes]], n_types: int, n_tokens: int, stats: list[dict]) -> pa.Table:
        n = table.num_rows
        return pa.table({
            "bucket": table.column("bucket"), "block": table.column("block"), "totals": pa.array([list(a) for a in zip(*answers)], blobs),
            "n_types": pa.array([n_types] + [0] * (n - 1), pa.int64()), "n_tokens": pa.array([n_tokens] + [0] * (n - 1), pa.int64()),
            "stats": pa.array([stats, *[[]] * (n - 1)], stats_type)})

    def add_words(table: pa.Table) -> pa.Table:
        answers, sums, _ = summed(table, 2)
        return answered(table, answers, int((sums[0] > 0).sum()), int(sums[0].sum()), [])

    def add_triples(table: pa.Table) -> pa.Table:
        answers, sums, first = summed(table, 1)
        # a triple's history has one class in all messages: the first one with it tells
        classes = np.concatenate([unpacked(c, "u1") for c in table.column("classes").to_pylist()]).astype(np.int64)
        owned = first[0] == 1
        totals = np.concatenate([unpacked(a, "<u8") for a in answers[0]]).astype(np.int64) >> 1
        return answered(table, answers, 0, 0, class_stats(1, classes[owned], totals[owned]))

    asked = blocks.mapInArrow(ask_words, ASK_SCHEMA)
    answers = cut_lineage(asked.groupBy("bucket").applyInArrow(add_words, ANSWER_SCHEMA))
    whole = answers.agg(F.sum("n_types").alias("v"), F.sum("n_tokens").alias("n")).first()
    n_types, n_tokens = whole["v"] or 0, whole["n"] or 0

    def counted(row: dict, rows: list[dict]) -> tuple[BlockText, np.ndarray, np.ndarray, np.ndarray]:
        """The block with its words' and pairs' totals, and the pairs that it is the first to have."""
        text_block = BlockText(row, buckets)
        words, _ = text_block.words_asked.totals({a["bucket"]: a["totals"][0] for a in rows})
        pairs, first = text_block.pairs_asked.totals({a["bucket"]: a["totals"][1] for a in rows})
        return text_block.with_triples(pairs), words, pairs, first

    def ask_triples(own: pa.Table, found: pa.Table) -> pa.Table:
        row = own.to_pylist()[0]
        text_block, words, pairs, first = counted(row, found.to_pylist())
        history = np.append(words, n_trained)[text_block.pairs // text_block.width]
        stats = class_stats(0, class_of(history[first]), pairs[first])
        ask = text_block.triples_asked
        classes = class_of(pairs[text_block.triples // text_block.width])
        local = ask.own > 0
        local[ask.chosen] = False
        stats += class_stats(1, classes[local], ask.own[local])
        return messages(row["block"], [ask], classes, stats)

    more = cut_lineage(blocks.groupBy("block").cogroup(answers.select("bucket", "block", "totals").groupBy("block")).applyInArrow(
        ask_triples, ASK_SCHEMA))
    deeper = cut_lineage(more.groupBy("bucket").applyInArrow(add_triples, ANSWER_SCHEMA))
    # at most two levels of so many classes
    by_class = more.select(F.inline("stats")).unionAll(deeper.select(F.inline("stats"))).groupBy("level", "class").agg(
        F.sum("once").alias("once"), F.sum("tokens").alias("tokens")).collect()
    backoff = np.full((2, CLASSES), 0.5)
    for r in by_class:
        backoff[r["level"], r["class"]] = (r["once"] + 0.5) / (r["tokens"] + 1)

    def score(own: pa.Table, found: pa.Table) -> pa.Table:
        row = own.to_pylist()[0]
        rows = found.to_pylist()
        text_block, words, pairs, _ = counted(row, [a for a in rows if len(a["totals"]) == 2])
        triples, _ = text_block.triples_asked.totals({a["bucket"]: a["totals"][0] for a in rows if len(a["totals"]) == 1})
        automaton = Automaton(text_block, [words, pairs, triples], n_tokens, n_types, n_trained, backoff)
        sizes = text_block.sizes
        by_text = lambda values: np.add.reduceat(values, text_block.first)
        return pa.table({
            "doc_id": pa.array(row["doc_ids"], pa.int64()), "held_out": pa.array(row["held"], pa.bool_()),
            "n_tokens": pa.array(sizes), "n_known": pa.array(by_text((words[text_block.numbers] > 0).astype(np.int64))),
            "train_tokens": pa.array(np.full(len(sizes), n_tokens)), "base_score": pa.array(by_text(automaton.root[text_block.numbers])),
            "score": pa.array(automaton.read(text_block.numbers, text_block.pair, text_block.first))})

    both = answers.select("block", "bucket", "totals").unionAll(deeper.select("block", "bucket", "totals"))
    return blocks.groupBy("block").cogroup(both.groupBy("block")).applyInArrow(score, SCORE_SCHEMA)
