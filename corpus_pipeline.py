"""Five stages that clean a corpus and pack it; each is written as Parquet before the next one reads it."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treatflow.llm import decontaminate, lines, queries, simhash, toxicity
from treatflow.llm.common import remainder
from treatflow.session import broadcast_if_small, cut_lineage, shared_folder


def sheltered(docs: DataFrame, operator: Callable[[DataFrame], DataFrame], names: Sequence[str]) -> DataFrame:
    """The operator's rows with the columns of ``docs``; those that have one of its result ``names`` come through it renamed."""
    low = {n.lower() for n in names}
    aside = {c: f"__aside_{i}" for i, c in enumerate(docs.columns) if c.lower() in low}
    out = operator(docs.withColumnsRenamed(aside))
    return out.select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it is trained as in query op4, without the held-out fold.

    Null and empty texts score the model's leak, so they stay unless most documents are toxic; repeated rows fare alike;
    all columns stay as they are, and an empty table gives an empty one.
    """
    labels = queries.table(spark, sf_dir, "labels")
    model = toxicity.fit(docs.filter(remainder("doc_id", 5) != 0), labels)
    return sheltered(docs, lambda d: toxicity.score_documents(d, model).filter("predicted = 0"), ("score", "predicted", "offending"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of lines of earlier documents are cut from later ones; ``n_chars`` follows.

    All rows stay, a text whose lines all go as an empty one; null texts stay null, repeated rows are one document and fare
    alike; the other columns stay as they are, and an empty table gives an empty one.
    """
    def cut(d: DataFrame) -> DataFrame:
        return lines.dedup_lines(d).withColumn(
            "n_chars", F.when(F.col("n_deleted") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))

    return sheltered(docs, cut, ("n_deleted", "partners"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one of the smallest id.

    Texts without words, null ones among them, are one group, so one of them stays; of repeated rows one stays; columns stay
    as they are, and an empty table gives an empty one.
    """
    return simhash.keep_one(docs).select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go.

    Null and empty texts have none and stay, repeated rows fare alike, columns stay as they are, and an empty table gives an
    empty one.
    """
    found = decontaminate.contamination(docs, queries.table(spark, sf_dir, "benchmark"))
    hit = cut_lineage(found.filter("n_hit > 0").select(F.col("doc_id").alias("__id"), F.col("key").alias("__key")).distinct())
    keyed = docs.withColumn("__text_key", F.xxhash64("text"))
    return keyed.join(broadcast_if_small(hit), F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text_key") == F.col("__key")),
                      "left_anti").select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2,048 tokens, with their ids.

    Null and empty texts are their end token alone, repeated rows are packed as often as they come, and other columns are
    left out; an empty table gives an empty one.
    """
    return queries.packed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_stage), ("line_dedup", line_stage), ("simhash_near_dedup", near_duplicate_stage),
    ("decontamination", decontamination_stage), ("packing", packing_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed corpus; stages between are tables in the shared folder."""
    docs = queries.table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
