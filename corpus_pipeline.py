"""A training-corpus pipeline of five stages over ``documents``.

Each stage is ``(name, function)``; a function takes ``(spark, docs, sf_dir)``
and returns a DataFrame, which is written as Parquet and read again as the
next stage's ``docs``. All but the last return the columns of documents.

Rows with a null doc_id pass every stage that compares documents: they are
equal to nothing. A null text is scored and packed as an empty one. Extra
columns go through unchanged up to the packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from overspend.llm import decontamination, line_dedup, near_dedup, packing, quality
from overspend.llm.catalog import tokenizer_path
from overspend.llm.common import free_name, importable, saved, table

THRESHOLD = 0.7


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    model = quality.fit(docs.where(~quality.held_out(F.col("doc_id"))), table(spark, sf_dir, "labels"))
    score = free_name(docs, "score")
    return quality.with_score(docs, model, score).where(F.col(score) >= THRESHOLD).select(*docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents hold go, except in the last of them; ``n_chars`` follows the text."""
    importable(spark)
    out = line_dedup.dedup_lines(docs).select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id stays; rows of one doc_id are judged by their texts."""
    importable(spark)
    judged = near_dedup.near_duplicates_by_text(docs)
    gone = judged.where(~F.col("kept")).select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest")).distinct()
    same = (docs["doc_id"] == gone["__id"]) & (F.xxhash64(docs["text"]) == gone["__digest"])
    return docs.join(gone, same, "left_anti").select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold too much of a benchmark go."""
    judged = decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    gone = judged.where("contaminated").select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest")).distinct()
    same = docs["doc_id"].eqNullSafe(gone["__id"]) & (F.xxhash64(docs["text"]) == gone["__digest"])
    return docs.join(gone, same, "left_anti").select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Power-of-two pieces of every kept document."""
    importable(spark)
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_dedup_stage),
    ("MinHash near-dedup", near_dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("packing", packing_stage),
]

# Tokenizing and the classifier have no SQL form; a test compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = saved(docs, f"stage{k + 1}")
    return docs
