"""Importing this module registers the queries of this folder's operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treatflow.llm import (
    chunks, decontaminate, licences, lines, lm, merkle, packing, periods, secrets, simhash, topk, toxicity, urls,
)
from treatflow.llm.common import ascii_lower, remainder
from treatflow.llm.registry import ORACLES, QUERIES, query  # noqa: F401

# fixed values: the rules that the URL query judges by
HOST_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"),
              ("block", "net/fr/")]
# fixed values: the method's own rules, host tokens that name unwanted sites
HOST_WORDS = ["adult", "casino", "escort", "payday", "porn", "sex", "spam", "torrent", "viagra", "warez", "xxx"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(docs: DataFrame) -> DataFrame:
    path = public_tokenizers.path
    return packing.pack(docs, path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op1_packing")
def op1_packing(spark, sf_dir):
    pieces = packed(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


TOP_K_SQL = """
    WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
               FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
    FROM s QUALIFY rank <= 10"""


@query("op2_exact_top_k", TOP_K_SQL)
def op2_exact_top_k(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


URL_SQL = f"""
    WITH p AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
    h AS (SELECT page_id, lower(regexp_extract(r, '^[^/?#]*')) AS host, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
    rules(action, rule) AS (VALUES {', '.join(f"('{a}', '{r}')" for a, r in HOST_RULES)}),
    best AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action FROM h JOIN rules
             ON (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
             AND starts_with(path, substr(rule, instr(rule, '/'))) GROUP BY page_id)
    SELECT h.page_id, host, path, rule, coalesce(action, CASE WHEN regexp_matches(host, '(^|[^a-z0-9])({'|'.join(HOST_WORDS)})([^a-z0-9]|$)')
           THEN 'block' ELSE 'allow' END) AS verdict FROM h LEFT JOIN best USING (page_id)"""


@query("op3_url_filters", URL_SQL)
def op3_url_filters(spark, sf_dir):
    rules = urls.rule_table(spark, [*(urls.host_rule(r, a) for a, r in HOST_RULES), *(urls.token_rule(w, w) for w in HOST_WORDS)])
    return urls.judge_urls(table(spark, sf_dir, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")


@query("op4_toxicity")
def op4_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs.filter(remainder("doc_id", 5) != 0), table(spark, sf_dir, "labels"))
    scored = toxicity.score_documents(docs, model)
    return scored.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", "predicted", "offending")


@query("op5_substring_dedup")
def op5_substring_dedup(spark, sf_dir):
    return chunks.dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op6_simhash")
def op6_simhash(spark, sf_dir):
    groups = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return groups.select("doc_id", digits.alias("fingerprint"), F.col("component").alias("component_id"))


@query("op7_decontamination")
def op7_decontamination(spark, sf_dir):
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), near=(2, 3))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), F.size("near_items").cast("long").alias("n_near_items"))


@query("op8_lm_scoring")
def op8_lm_scoring(spark, sf_dir):
    return lm.score_texts(table(spark, sf_dir, "documents"))


@query("op9_licence_scan")
def op9_licence_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licences.scan_licences(docs, licences.fit(docs)).select("doc_id", "licences", "licence_spans")



@query("op10_line_dedup")
def op10_line_dedup(spark, sf_dir):
    return lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op11_secrets")
def op11_secrets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find_secrets(docs, secrets.fit(secrets.labelled_samples(docs)))
    named = "concat_ws(':', s.kind, s.start, s.end)"
    number = lambda kind: F.expr(f"size(filter(secrets, s -> s.kind = '{kind}'))").cast("long").alias(f"n_{kind}")
    base = F.expr(f"array_join(transform(filter(secrets, s -> s.kind != 'random'), s -> {named}), ',')")
    return found.select("doc_id", *[number(k) for k in secrets.KINDS[:3]], F.sha2(base.cast("binary"), 256).alias("base_sha256"),
                        F.expr(f"array_join(transform(secrets, s -> {named}), ',')").alias("spans"), number("random"))


def crc32_sql(doc_id: str) -> str:
    """crc32 of a number's decimal text, bit by bit, in DuckDB."""
    bits = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, (v & 1) * 3988292384))"
    of_bytes = f"list_transform(string_split(coalesce(CAST({doc_id} AS VARCHAR), ''), ''), lambda d: CAST(ascii(d) AS BIGINT))"
    text = f"list_filter({of_bytes}, lambda d: d > 0)"
    return f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {text}), lambda c, b: {bits}), 4294967295)"


def merkle_sql(source_levels: int = 6, top_levels: int = 4) -> str:
    """The manifest with as many levels as told: 16^6 rows a source and 16^4 sources."""
    field = lambda c: f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"
    leaf = lambda text: "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", "n_chars", text))) + ")"
    changed = "CASE WHEN crc % 5 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END"
    parts = [f"""
    WITH d AS (SELECT *, coalesce('1' || source, '0') AS tree, {crc32_sql('doc_id')} AS crc FROM documents),
    l AS (SELECT *, {leaf('text')} AS leaf, {leaf('t2')} AS changed FROM (SELECT *, {changed} AS t2 FROM d)),
    a0 AS (SELECT tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank, leaf AS digest, doc_id, leaf, changed
           FROM l)"""]

    def levels(name: str, count: int) -> None:
        for k in range(1, count + 1):
            parts.append(f"""
    {name}{k} AS (SELECT tree, rank // 16 AS rank, CASE WHEN max(n) > 1 THEN sha256(string_agg(digest, '' ORDER BY rank)) ELSE max(digest) END AS digest
           FROM (SELECT tree, rank, digest, count(*) OVER (PARTITION BY tree) AS n FROM {name}{k - 1}) GROUP BY tree, rank // 16)""")

    levels("a", source_levels)
    parts.append(f"""
    b0 AS (SELECT 'all' AS tree, row_number() OVER (ORDER BY tree) - 1 AS rank, digest, tree AS name FROM a{source_levels})""")
    levels("b", top_levels)

    def proofs(name: str, count: int, rank: str, tree: str, walk: str) -> str:
        for k in range(count):
            # nothing happens on a level that a lone node is on already
            parts.append(f"""
    {walk}{name}{k} AS (SELECT p.doc_id, p.tree, p.rank, p.place, p.leaf, p.proof || coalesce(s.others, '') AS proof,
           CASE WHEN s.n > 1 THEN sha256(coalesce(s.before, '') || p.node || coalesce(s.after, '')) ELSE p.node END AS node
           FROM {walk} p JOIN (SELECT x.tree, x.rank, x.n, string_agg(y.digest, '' ORDER BY y.rank) AS others,
             string_agg(y.digest, '' ORDER BY y.rank) FILTER (y.rank < x.rank) AS before, string_agg(y.digest, '' ORDER BY y.rank) FILTER (y.rank > x.rank) AS after
             FROM (SELECT tree, rank, count(*) OVER (PARTITION BY tree) AS n FROM {name}{k}) x
             LEFT JOIN {name}{k} y ON x.tree = y.tree AND x.rank // 16 = y.rank // 16 AND x.rank <> y.rank
             GROUP BY x.tree, x.rank, x.n) s ON s.tree = {tree} AND s.rank = {rank} // {16**k})""")
            walk = f"{walk}{name}{k}"
        return walk

    parts.append("""
    w AS (SELECT a0.doc_id, a0.tree, a0.rank, b0.rank AS place, a0.leaf, '' AS proof, a0.changed AS node FROM a0 JOIN b0 ON a0.tree = b0.name)""")
    last = proofs("b", top_levels, "p.place", "'all'", proofs("a", source_levels, "p.rank", "p.tree", "w"))
    return ",".join(parts) + f"""
    SELECT p.doc_id, p.leaf, b0.digest AS subroot, r.digest AS root, sha256(p.proof) AS proof_sha256, p.node AS folded_root,
           p.node = r.digest AS verified FROM {last} p JOIN b0 ON p.tree = b0.name, b{top_levels} r"""


@query("op12_merkle", merkle_sql())
def op12_merkle(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    changed = F.when(remainder("doc_id", 5) == 0, ascii_lower(F.col("text"))).otherwise(F.col("text"))
    found = merkle.verify(docs, changed)
    return found.select("doc_id", "leaf", "subroot", "root", merkle.digest(F.array_join(F.flatten("path.others"), "")).alias("proof_sha256"),
                        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


PERIOD_SQL = f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, {crc32_sql('doc_id')} AS h FROM documents),
    e AS (SELECT *, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) ELSE len(w) END AS a, h // 10 AS g FROM d),
    f AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM e),
    t AS (SELECT r, doc_id, n, unnest(list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END])) AS w, unnest(range(n)) AS i FROM f),
    pairs AS (SELECT x.r, y.i - x.i AS q, x.i FROM t x JOIN t y ON x.r = y.r AND x.w = y.w AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
    islands AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM pairs),
    stretches AS (SELECT r, q, min(i) AS start, count(*) + q AS length FROM islands GROUP BY r, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
    runs AS (SELECT r, start, length, min(q) AS period FROM stretches GROUP BY r, start, length),
    summed AS (SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed FROM runs GROUP BY r),
    best AS (SELECT r, start, length, period FROM runs QUALIFY row_number() OVER (PARTITION BY r ORDER BY length DESC, start, period) = 1),
    kept AS (SELECT r, string_agg(w, ' ' ORDER BY i) AS words FROM t WHERE NOT EXISTS
             (SELECT 1 FROM runs u WHERE u.r = t.r AND t.i >= u.start + u.period AND t.i < u.start + u.length) GROUP BY r)
    SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
           sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(words, '')) AS collapsed_sha256
    FROM d LEFT JOIN summed USING (r) LEFT JOIN best USING (r) LEFT JOIN kept USING (r)"""


def made_periodic(text: str = "text", doc_id: str = "doc_id"):
    """The text; one in ten, by the id's crc32, with a tail that repeats its first words, joined by single spaces."""
    words = f"regexp_extract_all(coalesce({text}, ''), '[^\\\\x20\\\\x09-\\\\x0D]+', 0)"
    # each array of one element binds a value that the lambda looks at often
    bound = (f"transform(transform(array({words}), w -> named_struct('w', w, 'n', size(w), 'a', g % size(w))), "
             "s -> named_struct('w', s.w, 'n', s.n, 'a', int(s.a), 'p', int(1 + (s.n - s.a) div (3 + g % 8))))")
    looped = f"transform({bound}, s -> array_join(transform(sequence(0, s.n - 1), i -> s.w[if(i < s.a, i, s.a + (i - s.a) % s.p)]), ' '))"
    chosen = f"h % 10 = 0 and {text} rlike '[^\\\\x20\\\\x09-\\\\x0D]'"
    return F.expr(f"if({chosen}, get({looped}, 0), {text})")


@query("op13_periodic_runs", PERIOD_SQL)
def op13_periodic_runs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("h"))
    looped = docs.withColumn("g", F.expr("h div 10")).select("doc_id", made_periodic().alias("text"))
    found = periods.find_runs(looped)
    listed = F.expr("array_join(transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || '\n'), '')")
    best = F.expr("array_max(transform(runs, r -> named_struct('length', r.length, 'start', -r.start, 'period', -r.period)))")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), "best.length",
        (-F.col("best.period")).alias("period"), F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
