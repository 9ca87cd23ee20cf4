"""Adapters from the driver's parquet tables onto the data model.

``documents``  -> canonical documents (C1-shaped; metadata {lang, n_chars})
``documents``  -> one chunk per document (the exact-oracle chunk form)
``embeddings`` -> vector records
``benchmark``  -> a queries table (query_id, query)

All adapters are projections: lazy, column-pruned, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkretrieve.functions.metadata import chunk_record_columns, flatten_document_metadata
from sparkretrieve.functions.text import first_line_title


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


MAX_BALANCED_BYTES = 1 << 30


def balanced(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread a *small* table over the session's cores when its scan yields
    fewer tasks (e.g. one file written as one row group), so that per-row work
    on text uses them all. A table above ``MAX_BALANCED_BYTES`` is never
    shuffled: its scan has splits of its own, and ``spark.sql.files.
    maxPartitionBytes`` makes them smaller where more are wanted."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if size > MAX_BALANCED_BYTES or df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target)


def canonical_documents(raw_documents: DataFrame) -> DataFrame:
    """Driver ``documents`` -> canonical document schema."""
    return raw_documents.select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("document_id"),
        F.col("source"),
        F.col("doc_id").cast("string").alias("source_id"),
        first_line_title("text").alias("title"),
        F.lit("1").alias("version"),
        F.lit("").alias("updated_at"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.create_map(
            F.lit("lang"), F.col("lang"),
            F.lit("n_chars"), F.col("n_chars").cast("string"),
        ).alias("metadata"),
    )


def whole_document_chunks(documents: DataFrame) -> DataFrame:
    """Each canonical document as one chunk (chunk_index 0), metadata flattened.

    This is the chunk form a SQL engine can reproduce exactly; the real
    splitter lives in ``operators.chunking``.
    """
    flat = flatten_document_metadata()
    return documents.select(*chunk_record_columns(flat, F.col("document_id"), F.lit(0), F.col("text")))


def vector_records(raw_embeddings: DataFrame) -> DataFrame:
    """Driver ``embeddings`` -> vector records keyed like chunk records."""
    chunk_id = F.concat(F.lit("doc_"), F.col("vec_id").cast("string"), F.lit("_chunk_0"))
    return raw_embeddings.select(
        chunk_id.alias("record_id"),
        chunk_id.alias("chunk_id"),
        F.concat(F.lit("doc_"), F.col("vec_id").cast("string")).alias("document_id"),
        F.lit("").alias("title"),
        F.col("embedding").cast("array<float>").alias("vector"),
        F.create_map(F.lit("label"), F.col("label").cast("string")).alias("metadata"),
    )


def benchmark_queries(raw_benchmark: DataFrame) -> DataFrame:
    """Driver ``benchmark`` -> queries table."""
    return raw_benchmark.select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
