"""Incremental chunking with Structured Streaming (K1).

Canonical-document files that land in a folder are picked up by the file
source. The stream keeps a state per document beside its output: a hash of
the content and the number of its chunks. A micro-batch compares its documents
with that state; those that are as they were emit nothing, new and changed ones
are split (E1) and replace their chunks in the chunk table, and chunks that a
document no longer has are withdrawn. Of several landings of one document in a
batch the last counts (by file time, then path).

The state, like the chunk table, is a versioned table with upserts by id
(``sources.sinks``). The chunk table is published first, then the manifest of
the batch, then the state; a batch that is run again after a failure finds the
old state and does the same once more, or the new one and does nothing.
Manifest rows lie in a folder per stream and batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkretrieve.functions.metadata import chunk_record_columns
from sparkretrieve.operators import chunking
from sparkretrieve.session import path_exists, scratch_path
from sparkretrieve.sources import snapshots
from sparkretrieve.sources.sinks import RecordTable, upsert_table

DOCUMENT_SCHEMA = T.StructType([
    T.StructField("document_id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("source_id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("version", T.StringType()),
    T.StructField("updated_at", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
])


_CONTENT = [f.name for f in DOCUMENT_SCHEMA]


def _content_hash():
    """A hash of everything a document holds; the order of metadata keys is none."""
    fields = [F.array_sort(F.map_entries(c)).alias(c) if c == "metadata" else F.col(c) for c in _CONTENT if c != "document_id"]
    return F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256)


def _last_of_each(docs: DataFrame) -> DataFrame:
    """One row per document; a partial aggregate, so a document that lands a
    million times is no hot group. Rows without an id are dropped."""
    order = F.struct("_time", "_path", F.col("content"))
    return docs.filter("document_id is not null").withColumn("content", _content_hash()).groupBy("document_id") \
        .agg(F.max_by(F.struct(*[c for c in _CONTENT if c != "document_id"], "content"), order).alias("d")).select("document_id", "d.*")


def apply_documents(docs: DataFrame, output_dir: str, chunk_size: int = chunking.DEFAULT_CHUNK_SIZE,
                    chunk_overlap: int = chunking.DEFAULT_CHUNK_OVERLAP, manifest: str | None = None) -> int:
    """Bring the chunk table up to date with ``docs`` (canonical documents with
    _time and _path of their file); returns how many documents were new or
    changed. ``manifest`` names the folder for the rows of their chunks."""
    spark, out = docs.sparkSession, output_dir.rstrip("/")
    chunks_path, states_path = f"{out}/chunks", f"{out}/states"
    latest = _last_of_each(docs)
    if snapshots.versions(spark, states_path):
        states = RecordTable(spark, states_path)
        known = states.rows(with_bucket=True).select("bucket", "document_id", F.col("content").alias("_was"), F.col("n_chunks").alias("_had"))
        # Only the buckets that hold one of the documents are read.
        latest = states.with_bucket(latest, "document_id").join(known, ["bucket", "document_id"], "left").drop("bucket") \
            .filter(~F.col("_was").eqNullSafe(F.col("content")))
    else:
        latest = latest.withColumn("_was", F.lit(None).cast("string")).withColumn("_had", F.lit(0))
    # The one copy of the batch's texts: all that follows is read from it.
    split = _written(chunking.split_documents(latest.drop("_was"), chunk_size, chunk_overlap, keep=("content", "_had")), "stream-split")
    n = split.count()
    if not n:
        return 0
    chunks = split.select("document_id", "flat", F.posexplode("chunks").alias("chunk_index", "text")).select(
        *chunk_record_columns(F.col("flat"), F.col("document_id"), F.col("chunk_index"), F.col("text")))
    states = split.select("document_id", "content", "_had", F.size("chunks").alias("n_chunks"))
    gone = states.filter(F.col("_had") > F.col("n_chunks")).select(F.explode(F.sequence(
        F.col("n_chunks"), F.col("_had") - 1)).alias("k"), "document_id").select(F.concat("document_id", F.lit("_chunk_"), F.col("k").cast("string")).alias("chunk_id"))
    upsert_table(chunks, chunks_path, "chunk_id", remove=None if gone.isEmpty() else gone, written=True)
    if manifest is not None:
        chunking.chunk_manifest(chunks, chunks_path).write.mode("overwrite").parquet(manifest)
    upsert_table(states.select("document_id", "content", "n_chunks"), states_path, "document_id", written=True)
    return n


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def start_chunk_stream(spark: SparkSession, input_dir: str, output_dir: str, *, fmt: str = "parquet",
                       chunk_size: int = chunking.DEFAULT_CHUNK_SIZE,
                       chunk_overlap: int = chunking.DEFAULT_CHUNK_OVERLAP,
                       max_files_per_trigger: int | None = None, checkpoint: str | None = None,
                       available_now: bool = True):
    """Start the stream; returns the ``StreamingQuery``.

    ``output_dir/chunks`` and ``output_dir/states`` are versioned tables;
    ``output_dir/manifest/stream=S/batch_id=N`` holds the rows of batch N.
    """
    reader = spark.readStream.schema(DOCUMENT_SCHEMA).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    docs = reader.load(input_dir).select("*", F.col("_metadata.file_modification_time").alias("_time"),
                                         F.col("_metadata.file_path").alias("_path"))
    out = output_dir.rstrip("/")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        apply_documents(batch, out, chunk_size, chunk_overlap, f"{out}/manifest/stream={stream}/batch_id={batch_id}")

    writer = docs.writeStream.foreachBatch(write_batch).option(
        "checkpointLocation", checkpoint or scratch_path(spark, "stream-ckpt"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def read_stream_output(spark: SparkSession, output_dir: str) -> tuple[DataFrame, DataFrame]:
    """(chunks, manifest) written so far; manifest rows with ``stream`` and ``batch_id``."""
    out = output_dir.rstrip("/")
    if not path_exists(spark, f"{out}/manifest"):
        empty = spark.createDataFrame([], DOCUMENT_SCHEMA)
        chunks = chunking.chunk_documents(empty)
        return chunks, chunking.chunk_manifest(chunks, f"{out}/chunks").withColumn("stream", F.lit("")).withColumn("batch_id", F.lit(0))
    return RecordTable(spark, f"{out}/chunks").rows(), spark.read.parquet(f"{out}/manifest")


def run_chunk_stream(spark: SparkSession, input_dir: str, output_dir: str, **options) -> tuple[DataFrame, DataFrame]:
    """Process everything available now, wait for it, return the output tables."""
    query = start_chunk_stream(spark, input_dir, output_dir, available_now=True, **options)
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return read_stream_output(spark, output_dir)
