"""Batch jobs with sinks (B1-B6, E3, G6, ingest).

A sink is a table of records with upserts by id (``sources.sinks``): each run
publishes a new version of it, in which exactly the ids of the run's batch are
replaced or added.

A batch is written once; the table, the counts and the manifest all come from
that copy, so a manifest lists what its run wrote and nothing else.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkretrieve.functions.metadata import chunk_record_columns
from sparkretrieve.operators import chunking, embedding
from sparkretrieve.operators.sizing import broadcast_if_bounded
from sparkretrieve.session import scratch_path
from sparkretrieve.sources import dump
from sparkretrieve.sources.sinks import read_table, upsert_table  # noqa: F401 - part of this module's surface


@dataclass(frozen=True)
class ChunkingSummary:
    documents_processed: int
    chunks_saved: int


def one_per_id(df: DataFrame, id_col: str, order_col: str | None = None) -> DataFrame:
    """Keep one row per id (the one with the largest ``order_col`` if given).
    A partial aggregate, so an id repeated a million times is no hot group."""
    if order_col is None:
        return df.dropDuplicates([id_col])
    cols = [c for c in df.columns if c != id_col]
    best = F.max_by(F.struct(*cols), F.col(order_col))
    return df.groupBy(id_col).agg(best.alias("_r")).select(id_col, "_r.*").select(*df.columns)


def last_written_per_id(batch: DataFrame, id_col: str, order_col: str) -> DataFrame:
    """``one_per_id`` of a written table whose ``order_col`` is never null or
    repeated: only ids and order are shuffled, whole rows stay where they are
    (unless very many ids are repeated)."""
    last = batch.groupBy(F.col(id_col).alias("_id")).agg(F.count(F.lit(1)).alias("_n"), F.max(order_col).alias("_last"))
    repeated = _batch(last.filter("_n > 1").select("_id", "_last"), "repeated")
    if repeated.isEmpty():
        return batch
    side, _ = broadcast_if_bounded(repeated)
    joined = batch.join(side, F.col(id_col).eqNullSafe(F.col("_id")), "left")
    return joined.filter(F.col("_last").isNull() | (F.col("_last") == F.col(order_col))).select(*batch.columns)


def append_manifest(manifest: DataFrame, path: str) -> None:
    """Manifests are append-only JSON lines."""
    manifest.write.mode("append").json(path)


def _batch(df: DataFrame, name: str) -> DataFrame:
    """The run's own rows, written once."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ingest_dump(spark: SparkSession, dump_path: str, output_dir: str, manifest_path: str,
                limit: int | None = None) -> int:
    """Dump -> canonical documents table (+ manifest). Returns pages saved. Of
    several pages with one id the last in dump order (file path, then place in
    the file) stays."""
    pages = dump.read_pages(spark, dump_path, limit, with_position=True)
    batch = _batch(dump.pages_to_documents(pages, "pos"), "ingest")
    upsert_table(last_written_per_id(batch, "document_id", "pos").drop("pos"), output_dir, "document_id", written=True)
    append_manifest(dump.ingest_manifest(batch, output_dir), manifest_path)
    return batch.count()


def chunk_documents_job(documents: DataFrame, output_dir: str, manifest_path: str, *, limit: int | None = None,
                        chunk_size: int = chunking.DEFAULT_CHUNK_SIZE,
                        chunk_overlap: int = chunking.DEFAULT_CHUNK_OVERLAP) -> ChunkingSummary:
    """Documents -> chunk table + manifest; the summary counts documents
    that gave no chunk too (E4)."""
    if limit is not None:
        documents = documents.orderBy("document_id").limit(limit)
    split = _batch(chunking.split_documents(documents, chunk_size, chunk_overlap), "split")
    chunks = split.select("document_id", "flat", F.posexplode("chunks").alias("chunk_index", "text")).select(
        *chunk_record_columns(F.col("flat"), F.col("document_id"), F.col("chunk_index"), F.col("text")))
    upsert_table(one_per_id(chunks, "chunk_id"), output_dir, "chunk_id")
    append_manifest(chunking.chunk_manifest(chunks, output_dir), manifest_path)
    row = chunking.chunk_summary(split).first()
    return ChunkingSummary(int(row["documents_processed"]), int(row["chunks_saved"]))


def embed_chunks_job(chunks: DataFrame, encoder, output_dir: str, manifest_path: str) -> int:
    """Chunks -> embedding records table + manifest; returns records written."""
    batch = _batch(embedding.embed_chunks(chunks, encoder), "embeddings")
    upsert_table(one_per_id(batch, "record_id"), output_dir, "record_id")
    append_manifest(embedding.embedding_manifest(batch, output_dir), manifest_path)
    return batch.count()
