"""Hybrid fusion by reciprocal rank.

Both legs arrive as ranked tables (query_id, chunk_id, rank, score). A leg row
adds ``weight / (rrf_k + rank)``; the rank is the row's position in its leg,
and semantic rows whose chunk is unknown are dropped *after* ranking, so their
position is still used up (D3). Several rows for one chunk add up, and the
last (highest-rank) row gives the reported rank and score.

The merge is a full outer join on (query_id, chunk_id) of two tables that
hold at most ``leg_k`` rows per query, followed by a window top-k whose tie
order reproduces the studied merge: fused score, then BM25 candidates in BM25
order, then semantic-only candidates in semantic order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkretrieve.checks import check_fusion, require_positive
from sparkretrieve.operators.sizing import broadcast_if_bounded

FUSED_RANK_DIGITS = 12


def _leg(ranked: DataFrame, name: str, weight: float, rrf_k: int) -> DataFrame:
    last = F.max_by(F.struct("rank", "score"), "rank")
    return ranked.groupBy("query_id", "chunk_id").agg(
        F.sum(F.lit(weight) / (F.lit(rrf_k) + F.col("rank"))).alias(f"{name}_fused"),
        last["rank"].alias(f"{name}_rank"),
        last["score"].alias(f"{name}_score"),
        F.min("rank").alias(f"{name}_first"),
    )


def drop_unknown_chunks(semantic: DataFrame, chunks: DataFrame, *, upper_bound: int | None = None) -> DataFrame:
    """D3: keep semantic rows whose chunk exists; ranks are left as they were.
    A row is kept once, however often its chunk id occurs in ``chunks``."""
    known = chunks.select("chunk_id")
    side, small = broadcast_if_bounded(semantic, upper_bound=upper_bound)
    if small:
        # Few result rows: semi-join them against the chunk scan without shuffling chunks.
        # (query_id, rank) names a row, so repeated chunk ids do not repeat it.
        return known.join(side, "chunk_id", "inner").dropDuplicates(["query_id", "rank"]).select(*semantic.columns)
    return semantic.join(known, "chunk_id", "left_semi")


def fuse(bm25_ranked: DataFrame, semantic_ranked: DataFrame, top_k: int, *, rrf_k: int = 60,
         bm25_weight: float = 1.0, semantic_weight: float = 1.0) -> DataFrame:
    """(query_id, rank, chunk_id, fused_score, bm25_score, semantic_score,
    bm25_rank, semantic_rank, matched_by)."""
    require_positive(top_k, "top_k")
    check_fusion(rrf_k, bm25_weight, semantic_weight)
    b = _leg(bm25_ranked.select("query_id", "chunk_id", "rank", "score"), "bm25", bm25_weight, rrf_k)
    s = _leg(semantic_ranked.select("query_id", "chunk_id", "rank", "score"), "semantic", semantic_weight, rrf_k)
    merged = b.join(s, ["query_id", "chunk_id"], "full_outer")
    fused = F.coalesce(F.col("bm25_fused"), F.lit(0.0)) + F.coalesce(F.col("semantic_fused"), F.lit(0.0))
    matched_by = F.array_compact(F.array(
        F.when(F.col("bm25_rank").isNotNull(), F.lit("bm25")),
        F.when(F.col("semantic_rank").isNotNull(), F.lit("semantic")),
    ))
    merged = merged.select(
        "query_id", "chunk_id", fused.alias("fused_score"), "bm25_score", "semantic_score",
        "bm25_rank", "semantic_rank", "bm25_first", "semantic_first", matched_by.alias("matched_by"),
    )
    w = Window.partitionBy("query_id").orderBy(
        F.round("fused_score", FUSED_RANK_DIGITS).desc(),
        F.col("bm25_first").asc_nulls_last(),
        F.col("semantic_first").asc_nulls_last(),
    )
    ranked = merged.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top_k)
    return ranked.drop("bm25_first", "semantic_first")


def fusion_candidates(bm25_ranked: DataFrame, semantic_ranked: DataFrame, *, rrf_k: int = 60,
                      bm25_weight: float = 1.0, semantic_weight: float = 1.0) -> DataFrame:
    """Every merged candidate (before the final cut) with its provenance."""
    return fuse(bm25_ranked, semantic_ranked, 1 << 30, rrf_k=rrf_k, bm25_weight=bm25_weight,
                semantic_weight=semantic_weight)
