"""From documents to training sequences: language, quality, near duplicates, repeated passages, packing.

A stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the columns of ``docs``, whatever
else these are; each stage's rows are written as Parquet and read again as the next one's ``docs``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.llm import isolation, languages, ngram_join, packing, repeats
from shelfspark.llm.storage import stored

LANGUAGE = languages.Settings()
SIMILARITY = ngram_join.Similarity(n_words=5, at_least=80, of=100)


def _row(docs: DataFrame, without: tuple[str, ...] = ()):
    """The row as it came, so that no column of it is mistaken for one of an operator."""
    return F.struct(*[docs[c] for c in docs.columns if c not in without]).alias("__row")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that are in no known language: no trigram with a letter, or no language that reaches half of the probability."""
    rows = docs.select(_row(docs), "doc_id", "text", F.col("lang").alias("declared"), F.col("source").alias("address"))
    return languages.identified(rows, languages.fitted(rows, LANGUAGE), LANGUAGE).where("accepted").select("__row.*")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that fail the base rules or are anomalous in their rule statistics."""
    forest = isolation.fitted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return isolation.judged(docs.select(_row(docs), "text"), forest).where("kept").select("__row.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least doc_id of each group of near duplicates. Rows that share a doc_id count as one.

    Documents without a doc_id are in no group and stay.
    """
    found = ngram_join.near_duplicates(docs, SIMILARITY)
    kept = found.where("doc_id = component_id").select("doc_id").distinct()
    kept = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.select(*docs.columns).unionByName(docs.where("doc_id is null"))


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that an earlier document holds. A text without any stays as it is; one cut to nothing stays empty."""
    found = repeats.without_repeats(docs.select(_row(docs, without=("text",)), "doc_id", "text"))
    cut = F.col("n_removed") > 0
    columns = {c: F.col("__row").getField(c) for c in docs.columns if c != "text"}
    columns["text"] = F.when(cut, F.col("kept_text")).otherwise(F.col("text"))
    if "n_chars" in columns:
        columns["n_chars"] = F.when(cut, F.length("kept_text")).otherwise(columns["n_chars"]).cast(docs.schema["n_chars"].dataType)
    return found.select(*[columns[c].alias(c) for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences and places."""
    return packing.packed(packing.pieces(docs))


STAGES = [
    ("language_id", language_stage),
    ("quality_rules", quality_stage),
    ("ngram_jaccard", near_duplicate_stage),
    ("substring_dedup", repeats_stage),
    ("best_fit_packing", packing_stage),
]

# The trained stages have no SQL; the tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", os.path.dirname(os.path.abspath(__file__)))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
