"""Record readers (A3, A4, A5) for the JSON record layout and Parquet tables.

The studied layout is one pretty-printed JSON file per record. Those folders
are read with a fixed schema (no inference), recursively, ``*.json`` only;
at scale the same records live in Parquet tables, read with the same
schemas. ``limit`` keeps the first N records in id order, which is the
sorted-file-name order of the JSON layout.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkretrieve.operators import vectors
from sparkretrieve.sources import sinks, snapshots

_S = T.StringType()
_MAP = T.MapType(T.StringType(), T.StringType())

DOCUMENT_SCHEMA = T.StructType([T.StructField(n, _S) for n in (
    "document_id", "source", "source_id", "title", "version", "updated_at", "text")]
    + [T.StructField("metadata", _MAP)])

CHUNK_SCHEMA = T.StructType([T.StructField(n, _S) for n in (
    "chunk_id", "document_id", "source", "source_id", "title")]
    + [T.StructField("chunk_index", T.IntegerType()), T.StructField("text", _S), T.StructField("metadata", _MAP)])

EMBEDDING_SCHEMA = T.StructType([T.StructField(n, _S) for n in (
    "record_id", "chunk_id", "document_id", "title", "provider", "model")]
    + [T.StructField("dimensions", T.IntegerType()), T.StructField("vector", T.ArrayType(T.DoubleType())),
       T.StructField("metadata", _MAP)])


def _read(spark: SparkSession, path: str, schema: T.StructType, fmt: str, missing_message: str) -> DataFrame:
    try:
        if fmt == "json":
            return (spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True)
                    .option("pathGlobFilter", "*.json").json(path))
        if snapshots.versions(spark, path):
            return sinks.RecordTable(spark, path).rows().select(*schema.fieldNames())
        return spark.read.schema(schema).format(fmt).load(path).select(*schema.fieldNames())
    except AnalysisException as exc:
        raise FileNotFoundError(f"{missing_message}: {path}") from exc


def _limit(df: DataFrame, key: str, limit: int | None) -> DataFrame:
    return df if limit is None else df.orderBy(key).limit(limit)


def read_documents(spark: SparkSession, path: str, *, fmt: str = "json", limit: int | None = None,
                   validate: bool = False) -> DataFrame:
    """A3: canonical documents; with ``validate`` every one of the 8 keys must be present."""
    docs = _limit(_read(spark, path, DOCUMENT_SCHEMA, fmt, "Document directory not found"), "document_id", limit)
    if validate:
        missing = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in DOCUMENT_SCHEMA.fieldNames()])
        bad = docs.select(missing.alias("m")).filter(F.col("m") != "").first()
        if bad is not None:
            raise KeyError(bad.m.split(",")[0])
    return docs


def read_chunks(spark: SparkSession, path: str, *, fmt: str = "json", limit: int | None = None) -> DataFrame:
    """A4: chunk records, no validation."""
    return _limit(_read(spark, path, CHUNK_SCHEMA, fmt, "Chunk directory not found"), "chunk_id", limit)


def read_vector_records(spark: SparkSession, path: str, *, fmt: str = "json", limit: int | None = None,
                        strict: bool = True) -> DataFrame:
    """A5 + C6 + D5: embedding records -> validated vector records."""
    recs = _limit(_read(spark, path, EMBEDDING_SCHEMA, fmt, "Embedding directory not found"), "record_id", limit)
    valid, _ = vectors.split_valid(vectors.to_vector_records(recs), strict=strict)
    return valid
