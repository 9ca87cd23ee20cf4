"""Parameter guards (D4) and empty-input checks.

Guards run eagerly while a plan is being built, so a bad parameter fails
before any job starts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# The message texts below and the metrics equal those of the
# studied library, as callers match on them.
SUPPORTED_METRICS = ("cosine", "l2", "ip")


def require_positive(value: int | float, name: str) -> None:
    if value <= 0:
        raise ValueError(f"{name} must be greater than 0")


def check_chunking(chunk_size: int, chunk_overlap: int) -> None:
    if chunk_size <= 0:
        raise ValueError("chunk_size must be greater than 0")
    if chunk_overlap < 0:
        raise ValueError("chunk_overlap cannot be negative")
    if chunk_overlap >= chunk_size:
        raise ValueError("chunk_overlap must be smaller than chunk_size")


def check_metric(metric: str) -> None:
    if metric not in SUPPORTED_METRICS:
        raise ValueError(f"unsupported HNSW metric: {metric}")


def check_fusion(rrf_k: int, bm25_weight: float, semantic_weight: float) -> None:
    require_positive(rrf_k, "rrf_k")
    require_positive(bm25_weight, "bm25_weight")
    require_positive(semantic_weight, "semantic_weight")


def check_query_text(query: str) -> str:
    stripped = (query or "").strip()
    if not stripped:
        raise ValueError("query must be a non-empty string")
    return stripped


def check_model_name(model_name: str) -> None:
    if not model_name.strip():
        raise ValueError("model_name must be a non-empty string")


def require_rows(df: DataFrame, message: str) -> None:
    """An action (``isEmpty`` reads at most one row), so callers opt in."""
    if df.isEmpty():
        raise ValueError(message)
