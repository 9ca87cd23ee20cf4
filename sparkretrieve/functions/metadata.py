"""Metadata map expressions.

``map_concat`` raises on duplicate keys under the default
``spark.sql.mapKeyDedupPolicy``; ``last_wins`` removes the losing keys with
``map_filter`` first, so no global setting is needed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The six document fields that lead the flattened metadata, in order.
CORE_DOCUMENT_FIELDS = ("document_id", "source", "source_id", "title", "version", "updated_at")
# The six chunk columns copied over an embedding request's metadata.
EMBEDDING_OVERRIDE_FIELDS = ("chunk_id", "document_id", "source", "source_id", "title", "chunk_index")


def empty_string_map() -> Column:
    return F.create_map().cast("map<string,string>")


def last_wins(base: Column, override: Column) -> Column:
    """``{**base, **override}``: keys of ``override`` replace those of ``base``."""
    override_keys = F.map_keys(override)
    kept = F.map_filter(base, lambda k, v: ~F.array_contains(override_keys, k))
    return F.map_concat(kept, override)


def string_map(pairs: list[tuple[str, Column]]) -> Column:
    args: list[Column] = []
    for key, value in pairs:
        args += [F.lit(key), value.cast("string")]
    return F.create_map(*args)


def flatten_document_metadata(metadata: Column | str = "metadata") -> Column:
    """Six core fields, then the document's own metadata (last wins)."""
    meta = F.col(metadata) if isinstance(metadata, str) else metadata
    core = string_map([(name, F.col(name)) for name in CORE_DOCUMENT_FIELDS])
    return last_wins(core, F.coalesce(meta, empty_string_map()))


def chunk_id_of(document_id: Column, chunk_index: Column) -> Column:
    """``<document_id>_chunk_<index>``."""
    return F.concat(document_id, F.lit("_chunk_"), chunk_index.cast("string"))


def chunk_record_columns(flat: Column, document_id: Column, chunk_index: Column,
                         text: Column) -> list[Column]:
    """Chunk record from the flattened document metadata.

    chunk_id is built from the real document id; the promoted columns are read
    back from the flattened map, so a metadata key may override them.
    """
    chunk_id = chunk_id_of(document_id, chunk_index)
    metadata = last_wins(flat, string_map([("chunk_index", chunk_index), ("chunk_id", chunk_id)]))
    return [
        chunk_id.alias("chunk_id"),
        F.element_at(flat, F.lit("document_id")).alias("document_id"),
        F.element_at(flat, F.lit("source")).alias("source"),
        F.element_at(flat, F.lit("source_id")).alias("source_id"),
        F.element_at(flat, F.lit("title")).alias("title"),
        chunk_index.cast("int").alias("chunk_index"),
        text.alias("text"),
        metadata.alias("metadata"),
    ]


def embedding_request_metadata(metadata: Column | str = "metadata") -> Column:
    """C4: the chunk's six columns overwrite keys of its metadata."""
    meta = F.col(metadata) if isinstance(metadata, str) else metadata
    override = string_map([(name, F.col(name)) for name in EMBEDDING_OVERRIDE_FIELDS])
    return last_wins(F.coalesce(meta, empty_string_map()), override)
