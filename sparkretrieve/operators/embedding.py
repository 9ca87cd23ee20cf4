"""Embedding.

An *encoder* is a small picklable object with ``info`` and
``encode(list[str]) -> ndarray``. The embedding job runs it in a scalar
``arrow_udf``: Spark hands over Arrow batches of texts, the UDF takes a bounded
part of one at a time and cuts it into ``max_batch_size`` slices (G2), and every
other column stays in the JVM. The model is loaded once per Python worker and reused (G3).

Two encoders ship:

* ``HashingEncoder`` (G8) -- deterministic feature hashing of tokens, needs
  nothing offline: md5 of each token picks a bucket and a sign; counts are
  summed and L2-normalised (G4).
* ``SentenceTransformerEncoder`` (G3) -- the sentence-encoder provider; the
  package and weights are optional and imported only on first use.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkretrieve.checks import check_model_name, require_positive
from sparkretrieve.functions.batches import parts_of, release_free_memory
from sparkretrieve.functions.metadata import embedding_request_metadata, empty_string_map
from sparkretrieve.functions.text import TOKEN_PATTERN, py_strip, safe_record_id

# The sentence-encoder defaults of the studied provider.
DEFAULT_MODEL = "BAAI/bge-small-en-v1.5"
DEFAULT_DIMENSIONS = 384
DEFAULT_MAX_BATCH_SIZE = 32

_TOKEN_RE = re.compile(TOKEN_PATTERN)


def _model_cache() -> dict:
    """Loaded models by spec, kept per Python worker process (workers are
    reused across tasks), whether this module was imported or shipped by value."""
    import sys
    import types

    holder = sys.modules.get("_sparkretrieve_models")
    if holder is None:
        holder = types.ModuleType("_sparkretrieve_models")
        holder.models = {}
        sys.modules["_sparkretrieve_models"] = holder
    return holder.models


@dataclass(frozen=True)
class EncoderInfo:
    provider: str
    model: str
    dimensions: int
    max_batch_size: int


def bucket_and_sign(token: str, dimensions: int) -> tuple[int, int]:
    """G8 hashing rule: bucket = first 8 hex digits of md5 mod D; sign = + when
    the 9th hex digit is even."""
    h = hashlib.md5(token.encode("utf-8")).hexdigest()
    return int(h[:8], 16) % dimensions, (1 if int(h[8], 16) % 2 == 0 else -1)


@dataclass(frozen=True)
class HashingEncoder:
    dimensions: int = DEFAULT_DIMENSIONS
    max_batch_size: int = DEFAULT_MAX_BATCH_SIZE
    normalize: bool = True

    def __post_init__(self) -> None:
        require_positive(self.dimensions, "dimensions")
        require_positive(self.max_batch_size, "max_batch_size")

    @property
    def info(self) -> EncoderInfo:
        return EncoderInfo("hashing", f"md5-bucket-{self.dimensions}", self.dimensions, self.max_batch_size)

    def encode(self, texts: list[str]) -> np.ndarray:
        """Vectorised per batch: each distinct token is hashed once, counts are
        scattered with one ``np.add.at``."""
        n = len(texts)
        out = np.zeros((n, self.dimensions), dtype=np.float64)
        per_text = [[t.lower() for t in _TOKEN_RE.findall(text or "")] for text in texts]
        lengths = np.fromiter((len(ts) for ts in per_text), dtype=np.int64, count=n)
        if lengths.sum():
            flat = [t for ts in per_text for t in ts]
            vocab = {t: i for i, t in enumerate(dict.fromkeys(flat))}
            table = np.array([bucket_and_sign(t, self.dimensions) for t in vocab], dtype=np.int64)
            ids = np.fromiter((vocab[t] for t in flat), dtype=np.int64, count=len(flat))
            rows = np.repeat(np.arange(n), lengths)
            np.add.at(out, (rows, table[ids, 0]), table[ids, 1].astype(np.float64))
        if self.normalize:
            norms = np.sqrt((out * out).sum(axis=1, keepdims=True))
            out = np.divide(out, norms, out=np.zeros_like(out), where=norms > 0)
        return out.astype(np.float32)


@dataclass(frozen=True)
class SentenceTransformerEncoder:
    model_name: str = DEFAULT_MODEL
    dimensions: int = DEFAULT_DIMENSIONS
    max_batch_size: int = DEFAULT_MAX_BATCH_SIZE
    normalize: bool = True
    device: str | None = None
    model_loader: Any = field(default=None, compare=False)
    cache_name: str = ""  # tells loaders apart in a worker's cache

    def __post_init__(self) -> None:
        check_model_name(self.model_name)
        require_positive(self.dimensions, "dimensions")
        require_positive(self.max_batch_size, "max_batch_size")

    @property
    def info(self) -> EncoderInfo:
        return EncoderInfo("huggingface", self.model_name, self.dimensions, self.max_batch_size)

    def _model(self):
        key = ("st", self.model_name, self.device, self.cache_name)
        models = _model_cache()
        if key not in models:
            loader = self.model_loader
            if loader is None:
                try:
                    from sentence_transformers import SentenceTransformer as loader  # type: ignore
                except ImportError as exc:
                    raise RuntimeError(
                        "sentence-transformers is required for SentenceTransformerEncoder"
                    ) from exc
            kwargs = {"device": self.device} if self.device is not None else {}
            try:
                models[key] = loader(self.model_name, **kwargs)
            except Exception as exc:  # noqa: BLE001
                raise RuntimeError(f"could not load embedding model: {self.model_name}") from exc
        return models[key]

    def encode(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros((0, self.dimensions), dtype=np.float32)
        raw = self._model().encode(list(texts), batch_size=min(len(texts), self.max_batch_size),
                                   normalize_embeddings=self.normalize, show_progress_bar=False)
        return np.asarray(raw, dtype=np.float32)


def iter_batches(items: list, batch_size: int):
    """Fixed-size slices, the last one short."""
    require_positive(batch_size, "batch_size")
    for start in range(0, len(items), batch_size):
        yield items[start:start + batch_size]


def encode_checked(encoder, texts: list[str]) -> np.ndarray:
    """One vector per text, each of the declared dimension."""
    info = encoder.info
    parts = []
    for batch in iter_batches(texts, info.max_batch_size):
        vecs = np.asarray(encoder.encode(batch), dtype=np.float32)
        if vecs.ndim != 2 or vecs.shape[0] != len(batch):
            raise ValueError("embedding result count does not match request count")
        if vecs.shape[1] != info.dimensions:
            raise ValueError(f"expected embedding dimension {info.dimensions}, got {vecs.shape[1]}")
        parts.append(vecs)
    if not parts:
        return np.zeros((0, info.dimensions), dtype=np.float32)
    return np.concatenate(parts)


def embed_column(text: Column | str, encoder) -> Column:
    """ARRAY<FLOAT> vector per text, computed in Arrow batches."""

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def _embed(texts: pa.Array) -> pa.Array:
        # A part at a time: the texts of a whole batch are not made Python objects.
        found = [encode_checked(encoder, ["" if t is None else t for t in texts.slice(first, n).to_pylist()])
                 for first, n in parts_of(texts)]
        release_free_memory()
        vecs = np.concatenate(found) if found else np.zeros((0, encoder.info.dimensions), np.float32)
        offsets = np.arange(len(vecs) + 1, dtype=np.int32) * encoder.info.dimensions
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(vecs.reshape(-1)))

    return _embed(F.col(text) if isinstance(text, str) else text)


def embedding_requests(chunks: DataFrame) -> DataFrame:
    """C4: record_id = chunk_id, the chunk's six columns overwrite metadata."""
    return chunks.select(
        F.col("chunk_id").alias("record_id"), "text",
        embedding_request_metadata().alias("metadata"),
    )


def embed_requests(requests: DataFrame, encoder) -> DataFrame:
    """G6 core: requests -> embedding results (record_id, vector, provider,
    model, dimensions, metadata)."""
    info = encoder.info
    return requests.select(
        "record_id",
        embed_column("text", encoder).alias("vector"),
        F.lit(info.provider).alias("provider"),
        F.lit(info.model).alias("model"),
        F.lit(info.dimensions).alias("dimensions"),
        F.coalesce(F.col("metadata"), empty_string_map()).alias("metadata"),
    )


def embedding_records(results: DataFrame) -> DataFrame:
    """Results -> embedding records; chunk_id defaults to record_id only
    when the metadata has no chunk_id key."""
    meta = F.col("metadata")
    chunk_id = F.when(F.map_contains_key(meta, "chunk_id"), F.element_at(meta, F.lit("chunk_id"))).otherwise(
        F.col("record_id"))
    return results.select(
        "record_id", chunk_id.alias("chunk_id"),
        F.element_at(meta, F.lit("document_id")).alias("document_id"),
        F.element_at(meta, F.lit("title")).alias("title"),
        "provider", "model", F.col("dimensions").cast("int").alias("dimensions"), "vector", "metadata",
    )


def embedding_manifest(records: DataFrame, output_dir: str) -> DataFrame:
    """record_id, chunk_id, document_id, provider, model, dimensions,
    output_path (logical path ``<dir>/<safe record id>.json``)."""
    path = F.concat(F.lit(output_dir.rstrip("/") + "/"), safe_record_id("record_id"), F.lit(".json"))
    return records.select("record_id", "chunk_id", "document_id", "provider", "model",
                          "dimensions", path.alias("output_path"))


def embed_chunks(chunks: DataFrame, encoder) -> DataFrame:
    """Chunks -> embedding records."""
    return embedding_records(embed_requests(embedding_requests(chunks), encoder))


def embed_queries(queries: DataFrame, encoder, query_id: str = "query_id",
                  query_col: str = "query") -> DataFrame:
    """Strip each query and embed it; blank queries have nothing to embed
    and are dropped (single-query callers reject them eagerly with
    ``checks.check_query_text``)."""
    stripped = py_strip(query_col)
    return queries.filter(stripped != "").select(
        F.col(query_id).alias("query_id"), embed_column(stripped, encoder).alias("vector"),
    )
