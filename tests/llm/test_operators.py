"""The operators against brute force, and their edge cases."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from tests.compare import connect, difference
from treatflow.llm import chunks, common, decontaminate, licences, lines, lm, packing, queries, simhash, topk, toxicity, urls

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, score string, host string, n_deleted int, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 997} x{i}" for i in range(30_000))
ROWS = [(1, "a b c d e f g h i j k l", "s", "h", 1, "en", "x", 1), (1, "a b c d e f g h i j k l", "s", "h", 1, "en", "x", 1),
        (2, None, None, None, None, None, None, None), (3, "", "s", "h", 1, "en", "x", 0), (None, "null id", "s", "h", 1, "en", "x", 7),
        (4, LONG, "s", "h", 1, "en", "x", len(LONG)), (5, LONG, "s", "h", 1, "en", "x", len(LONG)), (6, "  \n \t ", "s", "h", 1, "en", "x", 5)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_oracle(spark, name):
    assert difference(connect(SF), entry.queries()[name](spark, SF), entry.oracle_sql()[name]) is None


def test_every_operator_has_a_query():
    assert {f"op{n}" for n in range(1, 14)} | {"pipeline"} == {
        k.split("_")[0] for k in entry.queries() if re.match(r"op\d|pipeline", k)}


# packing

def test_best_fit_takes_the_tightest_window():
    rng = random.Random(1)
    for _ in range(50):
        lengths = [rng.randint(1, 64) for _ in range(rng.randint(0, 60))]
        free, want = [], []
        for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
            fits = [f for f in free if f >= lengths[item]]
            if fits:
                free.remove(min(fits))
                free.append(min(fits) - lengths[item])
            else:
                free.append(64 - lengths[item])
        got = packing.best_fit_decreasing(lengths, 64)
        want = sorted(free)
        assert sorted(64 - sum(lengths[i] for i in w) for w in got) == want
        assert sorted(i for w in got for i in w) == list(range(len(lengths)))


def unpacked(pieces):
    found = {}
    for r in sorted(pieces, key=lambda r: (str(r.doc_id), r.start)):
        found.setdefault(r.doc_id, []).append(r)
    return found


def test_packing_is_a_round_trip_with_little_padding(docs):
    pieces = queries.packed(docs).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = unpacked(pieces)
    for row in docs.collect():
        want = [*tokenizer.encode(row.text or "", add_special_tokens=False).ids, 1]
        got = found[row.doc_id]
        assert np.frombuffer(b"".join(p.ids for p in got), "<u4").tolist() == want
        assert [p.start for p in got] == np.cumsum([0, *[p.length for p in got]])[:-1].tolist()
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding < 0.01 * sum(p.length for p in pieces)


def test_encoder_agrees_on_odd_white_space():
    path = public_tokenizers.path
    encode = packing.Encoder(path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    tokenizer = Tokenizer.from_file(path("byte_bpe_50k.json"))
    rng = random.Random(2)
    texts = ["", " ", "  ", "   a", "a   ", " \n b", "a<|endoftext|>b", "x\u00a0 y", *[
        "".join(rng.choice([" ", " ", "\n", "a", "Bc", "é", "'s", "12", ".", "\t", "\u2003"]) for _ in range(30)) for _ in range(300)]]
    import pyarrow as pa

    ids, counts = encode(pa.array(texts))
    got = [r.tolist() for r in np.split(ids, np.cumsum(counts)[:-1])]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_packing_edge_cases(odd, none):
    found = unpacked(queries.packed(odd).collect())
    assert found[2][0].doc_tokens == found[3][0].doc_tokens == 1
    assert sum(p.length for p in found[1]) == 2 * found[1][0].doc_tokens
    assert None in found and found[4][0].doc_tokens == sum(p.length for p in found[4])
    assert queries.packed(none).count() == 0


# exact top-k

def test_top_k_with_ties_copies_and_odd_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-3, 4, 4).astype(float).tolist()) for i in range(600)]
    rows += [(i, [0.5, 0.5, 0.5, 0.5]) for i in range(600, 1000)]
    rows += [(2000, None), (2001, [1.0, None, 0.0, 0.0]), (2002, [float("nan")] * 4), (2100, [float("inf"), 0.0, 0.0, 0.0]),
             (None, [1.0, 1.0, 1.0, 1.0]), (0, rows[0][1]), (3000, [1.0, 2.0]), (3001, [2.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    got = {}
    for r in topk.top_k(df, F.col("vec_id") % 100 == 0, shard_rows=90).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    valid = {i: np.floor(np.array(v) * 1024).astype(int) for i, v in rows if i is not None and v is not None and all(
        x is not None and math.isfinite(x) for x in v)}
    want = {}
    for q in (i for i in valid if i % 100 == 0):
        best = sorted((-int(valid[q] @ v), i) for i, v in valid.items() if i != q and len(v) == len(valid[q]))[:10]
        want[q] = [(n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert {q: sorted(v) for q, v in got.items()} == want
    assert topk.top_k(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


# URL filters

def test_urls(spark):
    rows = [(1, None), (2, "no scheme"), (3, "http://A.Example.COM/en/x?y#z"), (4, "http://www.example.com/en/"), (5, "x://notexample.com/en/"),
            (6, "http://a.net/es/1"), (7, "http://spam.farm.org/"), (8, "http://example.com"), (9, "http://b.net/es"), (3, "http://A.Example.COM/en/x?y#z"),
            (10, "http://a://b/c"), (11, "")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({"host": F.lit("old"), "RULE": F.lit("old")})
    rules = urls.rule_table(spark, [*(urls.host_rule(r, a) for a, r in queries.HOST_RULES), urls.token_rule("spam", "spam"),
                                    ("any", "block", 0, "^b[.]net", [])])
    got = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(pages, rules).drop("RULE_").collect())
    assert [(i, rule, v) for i, _, _, rule, v in got] == [
        (1, None, "allow"), (2, None, "allow"), (3, "example.com/en/", "block"), (3, "example.com/en/", "block"),
        (4, "www.example.com/en/", "allow"), (5, "com/", "allow"), (6, "net/es/", "block"), (7, None, "block"), (8, None, "allow"),
        (9, None, "block"), (10, None, "allow"), (11, None, "allow")]
    assert got[0][1:3] == ("", "") and got[2][1:3] == ("a.example.com", "/en/x") and got[10][1:3] == ("a:", "//b/c")
    assert urls.judge_urls(pages.limit(0), rules).count() == 0
    plan = urls.judge_urls(pages, rules)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("broadcast", [True, False])
def test_large_rule_tables_equal_brute_force(spark, monkeypatch, broadcast):
    rng = np.random.default_rng(3)
    pick = lambda n: "n" + str(rng.integers(n))
    hosts = sorted({f"{pick(40)}.{pick(25)}.{('com', 'net', 'org')[rng.integers(3)]}/{pick(4) + '/' if rng.integers(2) else ''}" for _ in range(1500)})
    actions = {h: ("allow", "block")[int(rng.integers(2))] for h in [*hosts, "com/", "n7.net/"]}
    pages = [(i, f"http://{'www.' if rng.integers(2) else ''}{pick(45)}.{pick(25)}.{('com', 'net')[rng.integers(2)]}/{pick(5)}/x") for i in range(1500)]
    # a third of all rows without a usable URL, a third of one URL
    pages += [(5000 + i, ("", None, "nothing")[i % 3]) for i in range(2000)] + [(9000 + i, "http://a.n7.net/n1/") for i in range(2000)]
    rules = spark.createDataFrame([*(urls.host_rule(h, a) for h, a in actions.items()), ("digits", "block", 0, "[.]n1[0-9][.]", []),
                                   ("none", "block", 0, "^$", [])], urls.RULE_SCHEMA)
    if not broadcast:
        monkeypatch.setattr(urls, "broadcast_if_small", lambda df: df)
        monkeypatch.setattr(common, "BROADCAST_LIMIT_BYTES", 0)
        monkeypatch.setattr(common, "HOT_SHARE", 10)
    got = {r.page_id: (r.rule, r.verdict) for r in urls.judge_urls(spark.createDataFrame(pages, "page_id long, url string"), rules).collect()}

    def plain(url):
        host, _, path = (url or "").partition("://")[2].partition("/")
        path = "/" + path
        fits = [r for r in actions if (host == r.partition("/")[0] or host.endswith("." + r.partition("/")[0])) and path.startswith("/" + r.partition("/")[2])]
        if host and fits:
            best = max(fits, key=lambda r: (len(r), actions[r] == "block", [-ord(c) for c in r]))
            return best, actions[best]
        return None, "block" if not host or re.search("[.]n1[0-9][.]", host + path) else "allow"

    assert got == {i: plain(url) for i, url in pages}
    assert len({r for r, _ in got.values()}) > 100


# toxicity

def plain_toxicity(model, text):
    """The noisy-or from its definition: sentences cut by hand, every feature of every word looked up."""
    clean = 1 - model.leak
    for sentence in re.split(r"[.!?\n]", text or ""):
        words = {"".join(c for c in run if c.isalpha()) for run in re.split(r"[\W\d_]+", sentence.lower())} - {""}
        total, known = model.bias, False
        for word in words:
            for feature in [word] + ["<" + word[:n] for n in (5, 6, 7) if n < len(word)]:
                if feature in model.weights:
                    total, known = total + model.weights[feature], True
        if known:
            clean *= 1 - 1 / (1 + math.exp(-min(max(total, -30), 30)))
    return 1 - clean


def test_toxicity_scores_equal_the_definition(spark, docs, odd):
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert model.weights
    for df in (docs, odd):
        for r in toxicity.score_documents(df, model).collect():
            assert r.score == pytest.approx(plain_toxicity(model, r.text), abs=1e-9) and r.predicted == (r.score >= 0.5)


def test_toxicity_training_reaches_a_maximum():
    """No small step of a weight, the bias or the leak makes the labelled documents clearly likelier."""
    rng = random.Random(3)
    bad, good = ["vile", "awful", "nasty"], ["river", "stone", "walk", "house", "green"]
    sample = []
    for _ in range(200):
        toxic = rng.random() < 0.4
        sentences = [" ".join(rng.choice(good) for _ in range(4)) for _ in range(3)]
        if toxic:
            sentences[rng.randrange(3)] += " " + rng.choice(bad)
        elif rng.random() < 0.2:
            sentences[0] += " vile"
        sample.append((". ".join(sentences), int(toxic)))
    model = toxicity.train(sample, rounds=1500)

    def likelihood(m):
        p = [min(max(plain_toxicity(m, t), 1e-9), 1 - 1e-9) for t, _ in sample]
        return sum(math.log(v if y else 1 - v) for v, (_, y) in zip(p, sample)) / len(sample) - 3e-4 * sum(map(abs, m.weights.values()))

    best = likelihood(model)
    assert set(model.weights) <= set(bad) and model.weights
    for name in model.weights:
        for step in (-0.1, 0.1):
            assert likelihood(toxicity.Model(model.weights | {name: model.weights[name] + step}, model.bias, model.leak)) < best + 2e-3
    for step in (-0.2, 0.2):
        assert likelihood(toxicity.Model(model.weights, model.bias + step, model.leak)) < best + 2e-3


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    scored = entry.queries()["op4_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out")
    rows = scored.select("toxic", "score", "predicted").collect()
    toxic, clean = ([r for r in rows if r.toxic == y] for y in (1, 0))
    assert sum(r.predicted for r in toxic) > 0.8 * len(toxic) and sum(r.predicted for r in clean) < 0.02 * len(clean)


def test_toxicity_locates_sentences_and_edge_cases(spark, odd, none):
    sample = [("A quiet day. You idiot. Fine then.", 1), ("A quiet day. It rained.", 0)] * 20
    model = toxicity.train(sample)
    text = "It rained. What an idiot! A quiet day."
    row = toxicity.score_documents(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    assert row.predicted == 1 and [text[s.start:s.start + s.length].strip() for s in row.offending] == ["What an idiot"]
    got = toxicity.score_documents(odd, model)
    assert got.count() == len(ROWS) and got.columns.count("score") == 1 and got.filter("score < 0 OR score > 1").isEmpty()
    assert toxicity.score_documents(none, toxicity.train([])).count() == 0


# substring dedup

def test_gear_hash_and_shift_resistance(spark):
    rng = random.Random(4)
    data = bytes(rng.randrange(256) for _ in range(400))
    slow, h = [], 0
    for b in data:
        h = ((h << 1) + int(chunks.GEAR[b])) & 0xFFFFFFFF
        slow.append(h)
    assert chunks.gear_hashes(np.frombuffer(data, np.uint8)).tolist() == slow
    words = ["".join(rng.choice("abcdeé") for _ in range(6)) for _ in range(4000)]
    passage, own = " ".join(words[:120]), [" ".join(words[200 * i:200 * i + 150]) for i in range(1, 12)]
    rows = [(i, f"{own[i]} {passage} {own[i + 5]}") for i in range(5)] + [(9, own[10])]
    got = {r.doc_id: r for r in chunks.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0].text == rows[0][1] and got[9].text == rows[5][1]
    for i in range(1, 5):
        assert got[i].sources == [0] and got[i].removed_bytes > 0.7 * len(passage.encode())
        assert got[i].text.startswith(own[i]) and got[i].text.endswith(own[i + 5])


def brute_chunks(rows, bits=4, least=32, most=1024, min_run=112):
    """(text, ids of first occurrences) of every document, byte by byte."""
    first, out = {}, {}
    for key, text in sorted(rows.items()):
        data = text.encode()
        h, start, pieces = 0, 0, []

        def cut(end):
            pieces.append((start, end, first.setdefault(data[start:end], (key, start))))

        for i in range(len(data) + 1):
            # a chunk that grew too long ends before the character that would make it longer
            if i - start > most:
                end = start + most
                while data[end] & 0xC0 == 0x80:
                    end -= 1
                cut(end)
                start = end
            whole = i == len(data) or data[i] & 0xC0 != 0x80
            if i > start and (i == len(data) or (whole and h >> (32 - bits) == 0 and i - start >= least)):
                cut(i)
                start = i
            if i < len(data):
                h = ((h << 1) + int(chunks.GEAR[data[i]])) & 0xFFFFFFFF
        runs = []
        for a, b, place in pieces:
            if place == (key, a):
                continue
            if runs and runs[-1][1] == a:
                runs[-1][1] = b
                runs[-1][2].append(place[0])
            else:
                runs.append([a, b, [place[0]]])
        runs = [r for r in runs if r[1] - r[0] >= min_run or r[1] - r[0] == len(data)]
        kept, at = b"", 0
        for a, b, _ in runs:
            kept, at = kept + data[at:a], b
        out[key] = ((kept + data[at:]).decode(), sorted({i for r in runs for i in r[2]}))
    return out


def test_substring_dedup_equals_brute_force(spark, docs, odd, none):
    texts = {r.doc_id: r.text for r in docs.limit(120).collect()}
    rng = random.Random(9)
    bank = ["".join(rng.choice("abé ") for _ in range(rng.choice([10, 60, 200]))) for _ in range(12)]
    made = {i: "".join(rng.choice(bank) for _ in range(rng.randint(0, 6))) for i in range(80)}
    for rows, most in ((texts, 1024), (made, 1024), (made, 40)):
        df = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
        got = {r.doc_id: (r.text, r.sources) for r in chunks.dedup_substrings(df, most=most).collect()}
        assert got == brute_chunks(rows, most=most)
    found = chunks.dedup_substrings(odd).collect()
    assert len(found) == len(ROWS) and [r.text for r in found if r.doc_id == 2] == [None]
    assert [r.text for r in found if r.doc_id == 5] == [""] and chunks.dedup_substrings(none).count() == 0


# SimHash

def test_simhash_of_hot_fingerprints_without_broadcast(spark, monkeypatch):
    texts = ["the same words in many documents"] * 60 + [f"own words of {i} and {i * i} here" for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    want = sorted(map(tuple, simhash.near_duplicates(docs).collect()))
    monkeypatch.setattr(common, "BROADCAST_LIMIT_BYTES", 0)
    monkeypatch.setattr(common, "HOT_SHARE", 5)
    assert sorted(map(tuple, simhash.near_duplicates(docs).collect())) == want and {w[3] for w in want[:60]} == {0}


def components_of(prints, distance):
    values = np.array(prints, dtype=np.int64).view(np.uint64)
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[i] ^ values) <= distance).tolist():
            a, b = root(i), root(j)
            parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(values))]


def slow_print(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    value = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return value


def test_simhash_equals_brute_force(docs):
    rows = simhash.near_duplicates(docs).orderBy("doc_id").collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.fingerprint & (2**64 - 1) == slow_print(texts[r.doc_id]) for r in rows)
    want = components_of([r.fingerprint for r in rows], 3)
    assert [r.component for r in rows] == [rows[i].doc_id for i in want]


def test_golay_keys_and_crowded_groups(spark, monkeypatch):
    rng = np.random.default_rng(5)
    a = rng.integers(0, 1 << 63, 2000, dtype=np.uint64) << np.uint64(1)
    b = a.copy()
    for _ in range(3):
        b ^= np.uint64(1) << rng.integers(0, 64, 2000, dtype=np.uint64)
    assert all(set(x) & set(y) for x, y in zip(simhash.fingerprint_keys(a).tolist(), simhash.fingerprint_keys(b).tolist()))
    # a crowd around one fingerprint, more than one key may compare
    monkeypatch.setattr(simhash, "DEEP", 20)
    crowd = a[:1] ^ (np.uint64(1) << rng.integers(0, 64, 1500, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 1500, dtype=np.uint64)) \
        ^ (np.uint64(1) << rng.integers(0, 64, 1500, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 1500, dtype=np.uint64))
    prints = np.unique(np.concatenate([crowd, a[:300], b[:300]])).view(np.int64)
    links = simhash.candidate_links(spark.createDataFrame([(int(p),) for p in prints], "fingerprint long")).collect()
    parent = {int(p): int(p) for p in prints}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for r in links:
        assert int(np.bitwise_count(np.uint64((r.u ^ r.v) & (2**64 - 1)))) <= 3
        parent[root(r.u)] = root(r.v)
    groups = {}
    for p, g in zip(prints.tolist(), components_of(prints, 3)):
        groups.setdefault(root(p), set()).add(g)
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(components_of(prints, 3)))


def test_simhash_edge_cases(odd, none):
    rows = simhash.near_duplicates(odd).collect()
    assert {r.component for r in rows if r.doc_id in (2, 3, 6)} == {2} and len(rows) == len(ROWS)
    assert [r.component for r in rows if r.doc_id == 5] == [4]
    assert sorted(r.doc_id or 0 for r in simhash.keep_one(odd).collect()) == [0, 1, 2, 4]
    assert simhash.near_duplicates(none).count() == 0


# decontamination

def words_of(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def hits_of(texts, items):
    windows = {}
    for item, text in items:
        w = words_of(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i:i + 10]), set()).add(str(item))
    found = []
    for text in texts:
        w, hit, ids = words_of(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    ids |= windows[tuple(w[i:i + n])]
                    hit |= set(range(i, i + n))
        found.append((len(w), len(hit), sorted(ids)))
    return found


@pytest.mark.parametrize("slice_bytes", [8 << 20, 1500])
def test_decontamination_equals_brute_force(spark, docs, slice_bytes):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = decontaminate.contamination(docs, items, slice_bytes=slice_bytes).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = dict(zip(texts, hits_of(texts.values(), [(r.item_id, r.text) for r in items.collect()])))
    assert {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in got} == want and any(r.n_hit for r in got)


def near_items(words, items, missing, slop):
    """Ids of items a window of which has all but ``missing`` of its words within ``slop`` words of their places."""
    found = set()
    for item, text in items:
        w = words_of(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            window = w[i:i + 10]
            for start in range(-len(window), len(words)):
                lack = sum(t not in words[max(0, start + k - slop):max(0, start + k + slop + 1)] for k, t in enumerate(window))
                if len(window) > missing + 1 and lack <= missing:
                    found.add(item)
    return found


def test_near_matches_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "CANDIDATES", 40)
    monkeypatch.setattr(decontaminate, "WINDOWS", 7)
    rng = np.random.default_rng(5)
    word = lambda: "w" + str(rng.integers(60))
    items = [("i" + str(k), " ".join(word() for _ in range(n))) for k, n in enumerate((12, 10, 14, 6, 4, 3, 1))]
    rows = []
    for k in range(120):
        w = items[k % len(items)][1].split()
        # words lost (often the first, at the very start of the text), changed or moved
        w = w[int(rng.integers(3)):]
        for _ in range(int(rng.integers(3))):
            if w:
                w[int(rng.integers(len(w)))] = word()
        if len(w) > 3:
            w.insert(int(rng.integers(len(w))), w.pop(int(rng.integers(len(w)))))
        rows.append((k, " ".join([word() for _ in range(int(rng.integers(3)))] + w + [word() for _ in range(int(rng.integers(4)))])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: set(r["near_items"]) for r in decontaminate.contamination(
        docs, spark.createDataFrame(items, "item_id string, text string"), near=(2, 3)).collect()}
    want = {k: near_items(words_of(text), items, 2, 3) for k, text in rows}
    assert got == want and 30 < sum(map(bool, want.values())) < 120


def test_decontamination_edge_cases(spark, odd, none):
    items = spark.createDataFrame([(10, "B c! d"), (9, "b C d"), (3, None), (4, "..."), (5, "a b c d e f g h i j zz"), (6, "null ID")],
                                  "item_id long, text string")
    got = decontaminate.contamination(odd, items, near=(2, 3)).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == len(ROWS) and by_id[1]["items"] == ["10", "5", "9"] and by_id[1].n_hit == 10
    assert by_id[None]["items"] == ["6"] and by_id[2].n_words == by_id[3].n_words == 0
    near = decontaminate.contamination(spark.createDataFrame([(1, "a b c q d e f g h j k")], "doc_id long, text string"), items, near=(2, 3)).first()
    assert near["near_items"] == ["5"] and near["items"] == []
    assert decontaminate.contamination(none, items).count() == 0
    assert decontaminate.contamination(odd, items.limit(0)).filter("n_hit > 0").isEmpty()


def test_decontamination_digest(spark):
    row = entry.queries()["op7_decontamination"](spark, SF).filter("n_items = 0").first()
    assert row.items_sha256 == hashlib.sha256(b"").hexdigest() and row.contaminated is False


# language model

def slow_scores(rows):
    """(doc_id, held, tokens, known, N, base, score) with whole tables of counts and the plain recursion."""
    texts = [(i, (t or "").encode().lower().split() + [None]) for i, t in rows]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    trained = [ws for i, ws in texts if not held(i)]
    count = Counter(w for ws in trained for w in ws)
    total, types = sum(count.values()), len(count)
    follow = Counter(p for ws in trained for p in zip(["<"] + ws, ws))
    third = Counter(p for ws in trained for p in zip(["<"] + ws, ws, ws[1:]))
    state = count | Counter({"<": len(trained)})
    size = lambda n: int(math.log2(n))
    share = {}
    for level, grams, history in ((1, follow, lambda g: state[g[0]]), (2, third, lambda g: follow[g[:2]])):
        once, tokens = Counter(), Counter()
        for g, n in grams.items():
            once[size(history(g))] += n == 1
            tokens[size(history(g))] += n
        share.update({(level, c): (once[c] + 0.5) / (tokens[c] + 1) for c in tokens})

    def p1(w):
        return (count[w] + 1) / (total + types + 1)

    def p2(h, w):
        if not state[h]:
            return p1(w)
        b = share.get((1, size(state[h])), 0.5)
        return (1 - b) * follow[h, w] / state[h] + b * p1(w)

    def p3(g, h, w):
        if not follow[g, h]:
            return p2(h, w)
        b = share.get((2, size(follow[g, h])), 0.5)
        return (1 - b) * third[g, h, w] / follow[g, h] + b * p2(h, w)

    out = []
    for i, ws in texts:
        line = ["<"] + ws
        score = sum(math.log10(p2("<", w) if k == 0 else p3(line[k - 1], line[k], w)) for k, w in enumerate(ws))
        out.append((i is None, i or 0, held(i), len(ws), sum(count[w] > 0 for w in ws), total, round(sum(math.log10(p1(w)) for w in ws), 4), round(score, 4)))
    return sorted(out), (count, p2, p3)


def test_lm_equals_brute_force(spark, docs, odd, none, monkeypatch):
    rng = random.Random(4)
    small = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 30)))) for i in range(300)]
    few = spark.createDataFrame(small + small[:40], "doc_id long, text string").repartition(5)
    for df, size, tokens in ((docs, lm.BLOCK_BYTES, lm.BUCKET_TOKENS), (odd, lm.BLOCK_BYTES, lm.BUCKET_TOKENS), (few, 300, 700)):
        monkeypatch.setattr(lm, "BLOCK_BYTES", size)
        monkeypatch.setattr(lm, "BUCKET_TOKENS", tokens)
        got = sorted((r.doc_id is None, r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4), round(r.score, 4))
                     for r in lm.score_texts(df).collect())
        want, _ = slow_scores([(r.doc_id, r.text) for r in df.collect()])
        assert [g[:6] for g in got] == [w[:6] for w in want]
        assert all(g[6:] == pytest.approx(w[6:], abs=1e-3) for g, w in zip(got, want))
    assert lm.score_texts(none).count() == 0


def test_lm_probabilities_sum_to_one():
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("abcd") for _ in range(rng.randint(0, 12)))) for i in range(60)]
    _, (count, p2, p3) = slow_scores(rows)
    words = [*count, "unknown"]
    for h in ("<", b"a", b"d"):
        assert sum(p2(h, w) for w in words) == pytest.approx(1)
        assert sum(p3(h, b"b", w) for w in words) == pytest.approx(1)


def test_packed_hashes():
    for n in (0, 1, 5000):
        hashes = np.sort(np.random.default_rng(n).integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
        assert (lm.unpacked_hashes(lm.packed_hashes(hashes)) == hashes).all()


# licences

def test_licences(spark, odd, none):
    model = licences.train(["the quick brown fox is under the public terms of trade", "a version of this work is in the house"] * 20)
    texts = ["Intro text here.\nReleased under the MIT License.\nmore", "Licensed under CC BY-NC 4.0.", "A public version of the house.",
             "This work is licensed under the GNU General Public License, version 3.", None, "", "licensed"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in licences.scan_licences(df, model).collect()}
    assert [got[i].licences for i in range(7)] == [["mit"], ["cc-by-nc"], [], ["gpl"], [], [], []]
    span = got[0].licence_spans[0]
    assert texts[0][span.start:span.start + span.length] == "Released under the MIT License."
    assert licences.scan_licences(odd, model).count() == len(ROWS) and licences.scan_licences(none, model).count() == 0


def test_licences_through_line_ends_and_of_other_notices(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = licences.fit(docs)
    notices = [
        ("mit", "Permission is hereby granted, free of charge, to any\nperson obtaining a copy of this software and\nassociated documentation "
                "files (the Software), to deal\nin the Software without restriction"),
        ("mit", "Permission is\nhereby granted, free\nof charge, to any\nperson obtaining\na copy of this\nsoftware and associated files"),
        ("gpl", "This file may be used under the GNU General Public License version 2 only"),
        ("gpl", "it under the terms of version 3 of the\nGNU General Public License as published\nby the Free Software Foundation, either"),
        ("isc", "Permission to use, copy, modify, and distribute this\nsoftware for any purpose with or without fee is\nhereby granted, provided"),
        ("epl", "This program is made available under the\nterms of the Eclipse Public License 2.0 which is at"),
        ("apache", "licensed to you under the Apache License, Version\n2.0 (the License); you may not use this file"),
        ("lgpl", "// SPDX-License-Identifier: LGPL-3.0-or-later"),
        ("bsd", "Redistribution and use in source and binary forms,\nwith or without changes, are permitted if the following conditions are met:"),
    ]
    around = "Some words of the story come first\nand go on in a second line.\n"
    for family, notice in notices:
        text = around + "\n" + notice + "\n\n" + around
        hits = [h for h in model.find(text) if h[5]]
        assert hits and {h[2] for h in hits} == {family}, (family, notice, model.find(text))
        assert all(notice.find(text[h[0]:h[0] + h[1]]) >= 0 for h in hits)
    # a blank line ends a notice; two notices in lines that follow one another are two
    assert not [h for h in model.find("Permission is hereby\n\ngranted free of\n \ncharge to any") if h[5]]
    both = model.find("Released under the MIT License.\nLicensed under the Apache License, Version 2.0.")
    assert [h[2] for h in both if h[5]] == ["mit", "apache"]
    for plain in ("The right of the public to use the land and the forms of the house are permitted by law.", "a" * 100_000, " " * 100_000, around):
        assert not model.find(plain)


def test_background_of_licences_is_distinct(spark, monkeypatch):
    rows = [(i, "a line that a third of all documents hold") for i in range(50)] + [(100 + i, f"another line with number {i}") for i in range(30)]
    seen = []
    monkeypatch.setattr(licences, "train", lambda background: seen.append(background))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    licences.fit(df)
    licences.fit(df, max_paragraphs=5)
    licences.fit(df.limit(0))
    assert len(seen[0]) == len(set(seen[0])) == 31 and seen[1] == seen[0][:5] and seen[2] == []


def test_licences_of_held_out_variants():
    model = licences.train(["river stone valley under the open sky of the old house"] * 50)
    rng = np.random.default_rng(99)
    right = total = 0
    for family, texts in licences.TEMPLATES.items():
        for text in texts:
            for words in licences.variants(text, [["river", "stone", "walk"]], rng, 10):
                found = model.classify(words)
                right += bool(found) and found[0] == family
                total += 1
    assert right >= 0.9 * total


# line dedup

def test_patience_alignment():
    number = lambda text: [(i, c) for i, c in enumerate(text)]
    assert sorted(lines.patience_align(number("abcde"), number("xabyde"))) == [(0, 1), (1, 2), (3, 4), (4, 5)]
    assert sorted(lines.patience_align(number("aab"), number("aaab"))) == [(0, 0), (1, 1), (2, 3)]
    rng = random.Random(6)
    for _ in range(200):
        a, b = (number("".join(rng.choice("abcdef") for _ in range(rng.randint(0, 12)))) for _ in range(2))
        got = sorted(lines.patience_align(a, b))
        assert all(dict(a)[i] == dict(b)[j] for i, j in got)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:]))
    values = [rng.randint(0, 50) for _ in range(80)]
    best = [1] * 80
    for i in range(80):
        best[i] = 1 + max([best[j] for j in range(i) if values[j] < values[i]], default=0)
    assert len(lines.longest_increasing(values)) == max(best)


def brute_lines(rows, min_chars):
    """Every document against every earlier one: lines of runs that follow one another in both, empty lines aside."""
    texts = {key: text.split("\n") for key, text in sorted(rows.items())}
    held = {key: [i for i, line in enumerate(lines) if line] for key, lines in texts.items()}
    out, before = {}, []
    for key, lines in texts.items():
        mine, gone = held[key], set()
        for other in before:
            theirs = [texts[other][i] for i in held[other]]
            places = {}
            for j, line in enumerate(theirs):
                places.setdefault(line, []).append(j)
            length = {}
            for a in range(len(mine) - 1, -1, -1):
                row = {}
                for j in places.get(lines[mine[a]], []):
                    row[j] = 1 + length.get(j + 1, 0)
                    if sum(len(lines[mine[a + k]]) for k in range(row[j])) >= min_chars:
                        gone.update(mine[a:a + row[j]])
                length = row
        out[key] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
        before.append(key)
    return out


def test_blocks_of_other_documents_than_the_first_holder(spark):
    """Lines first seen one by one elsewhere; moved blocks; a block that comes twice; blank lines between."""
    x, y, z = "x" * 40, "y" * 40, "z" * 70
    rows = {1: f"{x}\n{y}", 2: f"{y}\n{x}", 3: f"{y}\n{x}", 4: f"{x}\nown\n{y}", 5: f"{z}\nq\n{x}\n\n{y}", 6: f"{x}\n{y}\n{z}\nr\n{z}", 7: z}
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string").withColumn("mask", F.lit("m")).withColumn("spans", F.lit(1))
    got = lines.dedup_lines(docs).collect()
    texts = {r.doc_id: r.text for r in got}
    assert texts == brute_lines(rows, 60)
    assert texts == {1: rows[1], 2: rows[2], 3: "", 4: rows[4], 5: f"{z}\nq\n", 6: "r", 7: ""}
    assert {r.doc_id: r.partners for r in got}[3] == [2] and all(r["mask"] == "m" and r.spans == 1 for r in got)


def test_line_dedup_of_random_documents(spark, monkeypatch):
    rng = random.Random(12)
    bank = ["".join(rng.choice("abcdef ") for _ in range(rng.choice([1, 5, 20, 35, 61]))) for _ in range(14)] + [""]
    rows = {i: "\n".join(rng.choice(bank) for _ in range(rng.randint(0, 14))) for i in range(160)}
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string").repartition(6)
    want = brute_lines(rows, 60)
    assert {r.doc_id: r.text for r in lines.dedup_lines(docs).collect()} == want
    # too large to broadcast: common runs are joined apart
    monkeypatch.setattr(common, "BROADCAST_LIMIT_BYTES", 0)
    monkeypatch.setattr(common, "HOT_SHARE", 40)
    assert {r.doc_id: r.text for r in lines.dedup_lines(docs).collect()} == want


def test_line_dedup_of_repeated_lines_is_no_square(spark):
    text = "\n".join(["the same line again and again"] * 8000)
    docs = spark.createDataFrame([(1, text), (2, text + "\nlast")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in lines.dedup_lines(docs).collect()} == {1: text, 2: "last"}
    began = time.perf_counter()
    lines.dedup_lines(docs).collect()
    assert time.perf_counter() - began < 20


def test_line_dedup_equals_brute_force(docs, odd, none):
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: r.text for r in lines.dedup_lines(docs).collect()}
    assert got == brute_lines(texts, 60) and got != texts
    rows = lines.dedup_lines(odd).collect()
    assert len(rows) == len(ROWS) and {r.doc_id: r.text for r in rows}[5] == "" and {r.doc_id: r.text for r in rows}[2] is None
    assert {r.doc_id: r.text for r in rows}[1] == ROWS[0][1] and lines.dedup_lines(none).count() == 0


# pipeline

def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    folder = corpus_pipeline.shared_folder(spark)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = kept
        path = f"{folder}/test-{name}-{random.random()}"
        stage(spark, kept, SF).write.parquet(path)
        kept = spark.read.parquet(path)
        assert kept.columns == docs.columns
        rows = {r.doc_id: r.text for r in before.collect()}
        left = {r.doc_id: r.text for r in kept.collect()}
        if name == "toxicity":
            model = toxicity.fit(before.filter(queries.remainder("doc_id", 5) != 0), spark.read.parquet(f"{SF}/labels.parquet"))
            words = toxicity.WordWeights(model.weights)
            assert set(left) == {i for i, t in rows.items() if model.score(model.sentences(t, words)) < 0.5}
        elif name == "line_dedup":
            assert left == brute_lines(rows, 60)
        elif name == "simhash_near_dedup":
            ids = sorted(rows)
            prints = [slow_print(rows[i]) for i in ids]
            want = components_of(np.array(prints, dtype=np.uint64).view(np.int64), 3)
            assert set(left) == {ids[i] for i in want}
        else:
            assert set(left) == {i for i, h in zip(rows, hits_of(rows.values(), items)) if not h[1]}
    total = {r.doc_id: r.n for r in corpus_pipeline.run(spark, SF).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert total == {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in left.items()}


def test_null_item_id_is_the_empty_text(spark):
    docs = spark.createDataFrame([(1, "one two three four")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "two three"), ("b", "three four")], "item_id string, text string")
    row = decontaminate.contamination(docs, items).head()
    assert row.n_hit == 3 and row["items"] == ["", "b"]


def test_pipeline_stages_keep_clashing_columns(spark):
    """Columns that have the names of an operator's results come through every stage with their values."""
    names = ["score", "Predicted", "offending", "n_deleted", "partners", "mask", "spans", "component", "key", "fingerprint", "n_hit", "items"]
    line = "a line of words that two documents share, of more than sixty characters"
    texts = {1: line + "\nfirst of them", 2: "second\n" + line, 3: None, 4: "", 5: "short", 6: "short"}
    rows = [(i, t, "en", "x", None if t is None else len(t), *[f"{n}{i}" for n in names]) for i, t in texts.items()]
    docs = spark.createDataFrame(rows + rows[:1], "doc_id long, text string, lang string, source string, n_chars long, "
                                 + ", ".join(f"{n} string" for n in names))
    kept = docs
    ids = {"toxicity": [1, 1, 2, 3, 4, 5, 6], "line_dedup": [1, 1, 2, 3, 4, 5, 6], "simhash_near_dedup": [1, 2, 3, 5], "decontamination": [1, 2, 3, 5]}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF)
        found = kept.collect()
        assert kept.columns == docs.columns and sorted(r.doc_id for r in found) == ids[name], name
        assert all(r[n] == f"{n}{r.doc_id}" for r in found for n in names)
        want = texts | {2: "second"} if name != "toxicity" else texts
        assert all(r.text == want[r.doc_id] and r.n_chars == (None if r.text is None else len(r.text)) for r in found)
    assert {r.doc_id for r in corpus_pipeline.STAGES[-1][1](spark, kept, SF).collect()} == {1, 2, 3, 5}


def test_pipeline_edge_cases(spark, odd, none, tmp_path):
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for i, df in enumerate((odd, none)):
        df.select(columns).write.parquet(f"{tmp_path}/{i}/documents.parquet")
        for name in ("labels", "benchmark"):
            spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{i}/{name}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/1").count() == 0
    assert {r.doc_id for r in corpus_pipeline.run(spark, f"{tmp_path}/0").collect()} >= {1, 4}
