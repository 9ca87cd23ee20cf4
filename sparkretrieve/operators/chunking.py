"""Chunking (E1-E4, C2, C3, B5).

The recursive character split is the one step Spark SQL cannot express (a
recursive, stateful merge), so a small Python helper runs over Arrow batches:
one document per row, whole text, a bounded part of a batch at a time, so that
a worker never holds the chunks of a whole batch. Everything around it (metadata flattening, numbering, ids, summary,
manifest) is native Spark.

Split rule, with separators tried in order:
1. take the first separator that occurs in the text (``""`` always does);
2. cut before every occurrence, so pieces after the first start with it;
3. pieces shorter than ``chunk_size`` are buffered; a longer piece flushes
   the buffer through the merge and is split again with the later
   separators (or kept whole when none is left);
4. merge: add pieces while the total stays within ``chunk_size``; before a
   piece that would overflow, emit the buffer, then drop pieces from its front
   while the total exceeds ``chunk_overlap`` or the new piece still does not
   fit;
5. every emitted chunk is stripped; empty chunks are dropped.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkretrieve.checks import check_chunking
from sparkretrieve.functions.batches import parts_of, release_free_memory
from sparkretrieve.functions.metadata import chunk_record_columns, flatten_document_metadata

# Default chunk size / overlap (characters) and separator order.
DEFAULT_CHUNK_SIZE = 1200
DEFAULT_CHUNK_OVERLAP = 200
DEFAULT_SEPARATORS = ("\n\n", "\n", ". ", " ", "")


def _cut(text: str, sep: str) -> list[str]:
    if not sep:
        return list(text)
    head, *tail = text.split(sep)
    pieces = [head] + [sep + part for part in tail]
    return [p for p in pieces if p]


def _emit(buffer: deque, out: list[str]) -> None:
    chunk = "".join(buffer).strip()
    if chunk:
        out.append(chunk)


def _merge(pieces: list[str], size: int, overlap: int, out: list[str]) -> None:
    window: deque[str] = deque()
    total = 0
    for piece in pieces:
        n = len(piece)
        if total + n > size and window:
            _emit(window, out)
            while total > overlap or (total + n > size and total > 0):
                total -= len(window.popleft())
        window.append(piece)
        total += n
    if window:
        _emit(window, out)


def _split(text: str, separators: tuple[str, ...], size: int, overlap: int, out: list[str]) -> None:
    chosen, rest = separators[-1], ()
    for i, sep in enumerate(separators):
        if sep == "":
            chosen, rest = sep, ()
            break
        if sep in text:
            chosen, rest = sep, separators[i + 1:]
            break
    short: list[str] = []
    for piece in _cut(text, chosen):
        if len(piece) < size:
            short.append(piece)
            continue
        if short:
            _merge(short, size, overlap, out)
            short = []
        if rest:
            _split(piece, rest, size, overlap, out)
        else:
            out.append(piece)
    if short:
        _merge(short, size, overlap, out)


def split_text(text: str | None, chunk_size: int = DEFAULT_CHUNK_SIZE,
               chunk_overlap: int = DEFAULT_CHUNK_OVERLAP,
               separators: tuple[str, ...] = DEFAULT_SEPARATORS) -> list[str]:
    """Chunks of one text, in order (the per-row helper of the UDF)."""
    out: list[str] = []
    if text:
        _split(text, tuple(separators), chunk_size, chunk_overlap, out)
    return out


def split_text_column(text: Column | str, chunk_size: int = DEFAULT_CHUNK_SIZE,
                      chunk_overlap: int = DEFAULT_CHUNK_OVERLAP) -> Column:
    """ARRAY<STRING> of chunks, computed in Arrow batches."""
    check_chunking(chunk_size, chunk_overlap)

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def _split_batch(texts: pa.Array) -> pa.Array:
        return _chunks_of(texts, chunk_size, chunk_overlap)

    return _split_batch(F.col(text) if isinstance(text, str) else text)


def _chunks_of(texts: pa.Array, chunk_size: int, chunk_overlap: int) -> pa.Array:
    return pa.array([split_text(t, chunk_size, chunk_overlap) for t in texts.to_pylist()], pa.list_(pa.string()))


def split_documents(documents: DataFrame, chunk_size: int = DEFAULT_CHUNK_SIZE,
                    chunk_overlap: int = DEFAULT_CHUNK_OVERLAP, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: (document_id, flat metadata, chunks array) and the columns to ``keep``."""
    check_chunking(chunk_size, chunk_overlap)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n in parts_of(batch.column("text")):
                part = batch.slice(first, n)
                yield pa.RecordBatch.from_arrays(
                    [part.column("document_id"), part.column("flat"), _chunks_of(part.column("text"), chunk_size, chunk_overlap),
                     *[part.column(c) for c in keep]], names=["document_id", "flat", "chunks", *keep])
            release_free_memory()

    rows = documents.select("document_id", flatten_document_metadata().alias("flat"), "text", *keep)
    return rows.mapInArrow(split, T.StructType([*rows.schema.fields[:2], T.StructField("chunks", T.ArrayType(T.StringType())), *rows.schema.fields[3:]]))


def chunk_documents(documents: DataFrame, chunk_size: int = DEFAULT_CHUNK_SIZE,
                    chunk_overlap: int = DEFAULT_CHUNK_OVERLAP) -> DataFrame:
    """E1+E2+C3: canonical documents -> chunk records (one row per chunk)."""
    split = split_documents(documents, chunk_size, chunk_overlap)
    # posexplode_outer + filter: a plain posexplode makes the optimizer infer a
    # ``size(chunks) > 0`` filter that would evaluate the splitter a second time.
    exploded = split.select(
        "document_id", "flat", F.posexplode_outer("chunks").alias("chunk_index", "text")
    ).filter(F.col("text").isNotNull())
    return exploded.select(
        *chunk_record_columns(F.col("flat"), F.col("document_id"), F.col("chunk_index"), F.col("text"))
    )


def chunk_summary(split: DataFrame) -> DataFrame:
    """Documents processed (also those giving 0 chunks) and chunks saved,
    counted on the per-document arrays, before any explode."""
    return split.agg(
        F.count(F.lit(1)).cast("bigint").alias("documents_processed"),
        F.coalesce(F.sum(F.size("chunks")), F.lit(0)).cast("bigint").alias("chunks_saved"),
    )


def chunk_manifest(chunks: DataFrame, output_dir: str) -> DataFrame:
    """One manifest row per chunk; ``output_path`` is the logical record path."""
    return chunks.select(
        "document_id", "chunk_id",
        F.concat(F.lit(output_dir.rstrip("/") + "/"), F.col("chunk_id"), F.lit(".json")).alias("output_path"),
        F.lit("saved").alias("status"),
    )
