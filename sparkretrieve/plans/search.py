"""Composed search plans: semantic search (H7) and hybrid search."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkretrieve.checks import check_metric, require_positive
from sparkretrieve.functions.text import is_blank
from sparkretrieve.operators import ivf, knn
from sparkretrieve.operators.embedding import embed_queries
from sparkretrieve.operators.sizing import DEFAULT_MAX_BROADCAST_ROWS, bounded_count


# (embedded queries, k, columns to carry) -> (query_id, rank, record_id, score, *carry)
Searcher = Callable[[DataFrame, int, tuple[str, ...]], DataFrame]


def exact_searcher(vectors: DataFrame, metric: str = "cosine", **options) -> Searcher:
    """Exact kNN over a vector table."""
    check_metric(metric)
    return lambda queries, k, carry: knn.knn_search(vectors, queries, k, metric, carry=carry, **options)


def ivf_searcher(index: ivf.IVFIndex, nprobe: int = ivf.DEFAULT_NPROBE) -> Searcher:
    """Approximate kNN over an IVF index."""
    return lambda queries, k, carry: ivf.ivf_search(index, queries, k, nprobe, carry=carry)


def _searcher(vectors: DataFrame | Searcher, metric: str, encoder, options: dict) -> Searcher:
    """Vectors of a table are as long as the encoder's, so none is looked at for it."""
    if not isinstance(vectors, DataFrame):
        return vectors
    return exact_searcher(vectors, metric, **{"dimensions": encoder.info.dimensions, **options})


def semantic_search(vectors: DataFrame | Searcher, queries: DataFrame, encoder, top_k: int, metric: str = "cosine", *,
                    query_id: str = "query_id", query_col: str = "query", **knn_options) -> DataFrame:
    """H7: embed every query (G7) and search: a vector table exactly (H2), or any
    ``Searcher`` (H3). Returns (query_id, rank, record_id, chunk_id,
    document_id, title, score)."""
    require_positive(top_k, "top_k")
    check_metric(metric)
    qv = embed_queries(queries, encoder, query_id, query_col)
    hits = _searcher(vectors, metric, encoder, knn_options)(qv, top_k, ("chunk_id", "document_id", "title"))
    return hits.select("query_id", "rank", "record_id", "chunk_id", "document_id", "title", "score")


def hybrid_search(chunks: DataFrame, vectors: DataFrame | Searcher, queries: DataFrame, encoder, top_k: int = 5, *,
                  bm25_top_k: int = 50, semantic_top_k: int = 50, rrf_k: int = 60, bm25_weight: float = 1.0,
                  semantic_weight: float = 1.0, metric: str = "cosine", bm25_index=None,
                  query_id: str = "query_id", query_col: str = "query",
                  columns: tuple[str, ...] = ("document_id", "title", "text", "metadata")) -> DataFrame:
    """Both legs for every query, fused by reciprocal rank. ``vectors`` is a
    vector table (exact kNN) or any ``Searcher``.

    Blank queries are dropped (single-query callers reject them with
    ``checks.check_query_text``). The legs are independent subplans; text and
    metadata are fetched only for the final top-k rows.
    """
    from sparkretrieve.checks import check_fusion
    from sparkretrieve.operators import bm25, fusion

    require_positive(top_k, "top_k")
    check_fusion(rrf_k, bm25_weight, semantic_weight)
    q = queries.select(F.col(query_id).alias("query_id"), F.col(query_col).alias("query"))
    q = q.filter(~is_blank("query"))
    if bm25_index is None:
        bm25_index = bm25.build_bm25_index(chunks)
    n_queries = bounded_count(q, DEFAULT_MAX_BROADCAST_ROWS)
    lexical = bm25.bm25_search(chunks, q, bm25_top_k, index=bm25_index, columns=())
    semantic = _searcher(vectors, metric, encoder, {})(embed_queries(q, encoder), semantic_top_k, ("chunk_id",))
    semantic = fusion.drop_unknown_chunks(semantic, chunks, upper_bound=n_queries * semantic_top_k)
    fused = fusion.fuse(lexical, semantic, top_k, rrf_k=rrf_k, bm25_weight=bm25_weight,
                        semantic_weight=semantic_weight)
    if not columns:
        return fused
    return bm25.attach_chunks(fused, chunks, list(columns), upper_bound=n_queries * top_k)


def query_table(spark, query: str, *, reject_blank: bool = True) -> DataFrame:
    """A one-row queries table (query_id 0) for single-query callers; blank
    queries are rejected with the studied message, as semantic and hybrid
    search do."""
    from sparkretrieve.checks import check_query_text

    text = check_query_text(query) if reject_blank else query
    return spark.createDataFrame([(0, text)], "query_id long, query string")


def semantic_search_one(vectors: DataFrame, query: str, encoder, top_k: int, metric: str = "cosine") -> DataFrame:
    """H7 for one query string (the studied call shape)."""
    require_positive(top_k, "top_k")
    return semantic_search(vectors, query_table(vectors.sparkSession, query), encoder, top_k, metric)


def hybrid_search_one(chunks: DataFrame, vectors: DataFrame, query: str, encoder, top_k: int = 5,
                      **options) -> DataFrame:
    """I6 for one query string; results ordered by rank."""
    q = query_table(chunks.sparkSession, query)
    return hybrid_search(chunks, vectors, q, encoder, top_k, **options).orderBy("rank")
