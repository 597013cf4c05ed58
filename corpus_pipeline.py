"""A training-data pipeline over ``documents``: five operators of ``signalspark.llm``, each on all that the one before kept.

Every stage lowers the session's rows of an Arrow batch (``small_batches``), takes ``(spark, docs, sf_dir)`` and returns the columns of ``documents``, the last one the packed pieces.  ``run`` writes each
result as Parquet to the shared scratch folder and reads it back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalspark.llm.common import join_ids, read_table, small_batches, stored
from signalspark.llm.decontaminate import benchmark_leaks
from signalspark.llm.jaccard_join import similar_documents
from signalspark.llm.langid import prediction, train
from signalspark.llm.line_dedup import MIN_WORDS, without_runs
from signalspark.llm.packing import pack_documents

#: Words of a shingle and least similarity (in hundredths) of near duplicates.
SHINGLE, SIMILARITY = 5, 80


def _without(docs: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """Rows whose ``doc_id`` is not in ``ids``; rows without an id stay."""
    return join_ids(docs, stored(ids.select("doc_id").where("doc_id is not null").distinct(), name), "doc_id", "left_anti")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter, null ones, and those with fewer common n-grams than texts of the learned languages have go.

    With no label at all nothing but the former go.
    """
    small_batches(spark)
    known = docs.withColumn("__language", prediction(F.col("text"), train(docs), spark)).where("__language.known")
    return known.select(*(F.col(f"`{c}`") for c in docs.columns))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated passages are deleted from the texts; a document of which nothing is left goes."""
    small_batches(spark)
    cut = without_runs(docs, MIN_WORDS, "__n_deleted").where((F.col("__n_deleted") == 0) | (F.trim("text") != ""))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(F.col("__n_deleted") == 0, F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return cut.select(*(F.col(f"`{c}`") for c in docs.columns))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each component of near duplicates stays."""
    small_batches(spark)
    return _without(docs, similar_documents(docs, SHINGLE, SIMILARITY, 100).where("doc_id <> component_id"), "near-copies").select(docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    small_batches(spark)
    return _without(docs, benchmark_leaks(docs, read_table(spark, sf_dir, "benchmark")), "leaks").select(docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents' pieces in sequences."""
    small_batches(spark)
    return pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: SQL can't express the stages; tests compare them with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
