"""The corpus pipeline: documents through five stages, each a written table.

Clean documents stay whole in every filtering stage. Null and empty texts are judged like any other
text by each stage's operator; repeated rows are near-duplicates of each other, of which one stays.
Extra columns, whatever their names, go through to the last stage, which returns pieces of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioloom.llm import decontaminate, packing, quality, simhash, toxicity
from folioloom.llm.common import drop, renamed, restored, scope, stored
from folioloom.llm.queries import table, tokenizer_path

#: SQL can't express the learned stages; tests/llm holds the stages against brute-force versions.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at the threshold or above."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    rows, names = renamed(docs)
    scored = quality.score(rows, model, text=names["text"], column="score")
    return restored(scored.where(F.col("score") >= quality.THRESHOLD), docs)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    rows, names = renamed(docs)
    scored = toxicity.score(rows, model, text=names["text"], column="score")
    return restored(scored.where(F.col("score") < toxicity.THRESHOLD), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the smallest doc_id."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences."""
    pieces = packing.tokenize(docs, tokenizer_path("word_bpe_49k.json"))
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


STAGES = [
    ("quality", good_quality),
    ("toxicity", not_toxic),
    ("simhash_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each reading what the one before wrote, which is deleted then."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with scope() as tables:
            docs = tables.keep(stored(stage(spark, docs, sf_dir), name))
        drop(*before)
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
