"""From raw documents to packed training sequences.

Stages, in order: toxic documents go; lines that repeat across documents go,
except in one document; of near-duplicates one document stays; what is left is
packed into sequences. Each stage gets what the one before kept, written as
Parquet and read again, so a lost executor costs no earlier stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkretrieve.llm import line_dedup, packing, simhash, toxicity
from sparkretrieve.llm.common import materialise, table
from sparkretrieve.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below 0.5; the model learns from all labels."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    scored = toxicity.score_toxicity(docs, labels, F.lit(True), keep_text=True)
    return scored.filter(F.col("predicted") == 0).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without repeated lines; n_chars follows the text."""
    cut = line_dedup.drop_repeated_lines(docs, min_chars=20, min_docs=3)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each near-duplicate group."""
    return simhash.keep_one_per_group(docs, shingle=3, radius=2)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its place in a sequence."""
    return packing.pack_documents(docs, tokenizer_path(), max_tokens=2048, end_id=0)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("best_fit_packing", pack),
]

# SQL cannot express the toxicity model; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
