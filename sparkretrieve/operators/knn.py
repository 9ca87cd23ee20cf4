"""Exact k-nearest-neighbour search (H1, H2) for a whole table of queries.

Scores follow the index metrics: cosine and ip give ``1 - distance`` (cosine
similarity, inner product); l2 gives minus the *squared* euclidean distance.
A zero-norm vector has cosine 0.

Queries are searched in blocks, bounded in bytes and rows. A block is shipped
once to every executor, and the vector table is scanned in place: a task keeps
the best k of every query over *all* its batches and emits only those, at most
k rows per query and task. Products are computed in tiles, so a task's memory
depends on the tile and the block, never on the table.

A tile's matrix product only preselects; its candidates, taken with a margin
for rounding that scales with the vectors' lengths, are scored again pair by
pair. A final ``row_number`` per query, planned as a partial WindowGroupLimit
before the shuffle, picks the global top-k. Ties are broken by ``record_id``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkretrieve.checks import check_metric, require_positive

RANK_DIGITS = 9
# A block of queries: what is shipped to every executor.
MAX_BLOCK_BYTES = 64 << 20
MAX_BLOCK_ROWS = 50_000
# A tile of the score matrix; one tile's work needs about 60 bytes a cell.
TILE_QUERIES, TILE_VECTORS = 512, 4_096
EXACT_PAIRS = 1 << 18


def _matrix(values: Iterable, dim: int | None = None) -> np.ndarray:
    rows = [np.asarray(v, dtype=np.float64) for v in values]
    return np.stack(rows) if rows else np.zeros((0, dim or 0))


def _normalise(m: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norms, out=np.zeros_like(m), where=norms > 0)


def pair_scores(q: np.ndarray, v: np.ndarray, metric: str) -> np.ndarray:
    """H1: score of each row of ``q`` with the same row of ``v`` (for cosine,
    both normalised)."""
    if metric == "l2":
        d = q - v
        return -np.einsum("ij,ij->i", d, d)
    return np.einsum("ij,ij->i", q, v)


class TopK:
    """The best k vectors of each query over any number of batches, ordered like
    the global ranking: score rounded to ``RANK_DIGITS`` (desc), then record_id."""

    def __init__(self, q: np.ndarray, metric: str, k: int, carry: tuple[str, ...] = ()) -> None:
        self.q = _normalise(q) if metric == "cosine" else q
        self.metric, self.k = metric, k
        self.qq = np.einsum("ij,ij->i", self.q, self.q)
        self.columns = ("record_id", *carry)
        none = (np.empty(0), [np.empty(0, object) for _ in self.columns], np.empty(0, np.int64))
        self.best = [none for _ in range(0, len(q), TILE_QUERIES)]

    def add(self, v: np.ndarray, columns: list[np.ndarray], asked: np.ndarray | None = None) -> None:
        """``asked``: which queries these vectors are compared with (default all)."""
        v = _normalise(v) if self.metric == "cosine" else v
        vv = np.einsum("ij,ij->i", v, v)
        for tile in range(len(self.best)):
            rows = np.arange(tile * TILE_QUERIES, min(len(self.q), (tile + 1) * TILE_QUERIES))
            if asked is not None:
                rows = rows[asked[rows]]
            if len(rows):
                for at in range(0, len(v), TILE_VECTORS):
                    part = slice(at, at + TILE_VECTORS)
                    self._tile(tile, rows, v[part], vv[part], [c[part] for c in columns])

    def _tile(self, tile: int, rows: np.ndarray, v: np.ndarray, vv: np.ndarray, columns: list[np.ndarray]) -> None:
        q, qq = self.q[rows], self.qq[rows]
        s = q @ v.T
        if self.metric == "l2":
            s *= 2
            s -= qq[:, None]
            s -= vv[None, :]
        # Rounding of the product, relative to what is added up in it.
        scale = (qq + vv.max() if self.metric == "l2" else np.sqrt(qq * vv.max()))
        margin = 8 * np.finfo(float).eps * (v.shape[1] + 2) * scale + 10.0 ** -RANK_DIGITS
        kk = min(self.k, s.shape[1])
        floor = np.partition(s, s.shape[1] - kk, axis=1)[:, s.shape[1] - kk] - margin
        if kk < self.k:
            floor[:] = -np.inf
        scores, ids, owner = self.best[tile]
        # The k-th score so far, where there are k already.
        local = owner - tile * TILE_QUERIES
        have = np.bincount(local, minlength=TILE_QUERIES)[rows - tile * TILE_QUERIES]
        worst = np.full(TILE_QUERIES, np.inf)
        np.minimum.at(worst, local, scores)
        worst = worst[rows - tile * TILE_QUERIES]
        floor = np.maximum(floor, np.where(have >= self.k, worst - margin, -np.inf))
        at, col = np.nonzero(s >= floor[:, None])
        del s
        exact = np.empty(len(at))
        for k in range(0, len(at), EXACT_PAIRS):
            part = slice(k, k + EXACT_PAIRS)
            exact[part] = pair_scores(q[at[part]], v[col[part]], self.metric)
        scores = np.concatenate([scores, exact])
        owner = np.concatenate([owner, rows[at]])
        ids = [np.concatenate([old, new[col]]) for old, new in zip(ids, columns, strict=True)]
        names, place = np.unique(ids[0].astype(str), return_inverse=True)
        order = np.lexsort((place, -np.round(scores, RANK_DIGITS), owner))
        owner = owner[order]
        order = order[np.arange(len(owner)) - np.searchsorted(owner, owner) < self.k]
        self.best[tile] = scores[order], [c[order] for c in ids], np.concatenate([self.best[tile][2], rows[at]])[order]

    def frames(self, q_ids: np.ndarray) -> Iterator[pd.DataFrame]:
        for scores, ids, owner in self.best:
            if len(scores):
                yield pd.DataFrame({"query_id": q_ids[owner], "record_id": ids[0], "score": scores,
                                    **dict(zip(self.columns[1:], ids[1:], strict=True))})


def query_blocks(queries: DataFrame, query_id: str, query_vector: str, *, dimensions: int | None,
                 max_rows: int = MAX_BLOCK_ROWS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix) of one bounded block after the other; rows stream through
    the driver, which never holds more than a block. Queries without a vector
    have nothing to search for."""
    rows = queries.select(F.col(query_id).alias("query_id"), F.col(query_vector).cast("array<double>").alias("qvec")) \
        .filter(F.col("qvec").isNotNull())
    ids, vecs = [], []
    for row in rows.toLocalIterator(prefetchPartitions=False):
        if dimensions is not None and len(row["qvec"]) != dimensions:
            raise ValueError(f"expected query dimension {dimensions}, got {len(row['qvec'])}")
        ids.append(row["query_id"])
        vecs.append(row["qvec"])
        if len(ids) >= max_rows or len(ids) * len(row["qvec"]) * 8 >= MAX_BLOCK_BYTES:
            yield np.asarray(ids, dtype=object), _matrix(vecs)
            ids, vecs = [], []
    if ids:
        yield np.asarray(ids, dtype=object), _matrix(vecs)


def vector_dimensions(vectors: DataFrame, vector_col: str = "vector") -> int | None:
    """The length of the table's vectors (of its first row); None if it is empty."""
    row = vectors.filter(F.col(vector_col).isNotNull()).select(F.size(vector_col).alias("n")).first()
    return None if row is None else row["n"]


def candidate_schema(queries: DataFrame, query_id: str, vectors: DataFrame, carry: tuple[str, ...]) -> T.StructType:
    return T.StructType([T.StructField("query_id", queries.schema[query_id].dataType),
                         T.StructField("record_id", T.StringType()), T.StructField("score", T.DoubleType()),
                         *[vectors.schema[c] for c in carry]])


def scan_block(vectors: DataFrame, block: tuple[np.ndarray, np.ndarray], metric: str, k: int, schema: T.StructType,
               carry: tuple[str, ...] = ()) -> DataFrame:
    """Candidates of one block of queries from one scan of (record_id, vec, *carry)."""
    shared = vectors.sparkSession.sparkContext.broadcast(block)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, q = shared.value
        top = TopK(q, metric, k, carry)
        for batch in batches:
            # Here and not as a DataFrame filter, which would compute a vector
            # column that is an expression (an encoder) twice.
            batch = batch[batch["vec"].notna()]
            if len(batch):
                top.add(_matrix(batch["vec"]), [batch[c].to_numpy(dtype=object) for c in top.columns])
        yield from top.frames(ids)

    return vectors.mapInPandas(scan, schema)


def rank_candidates(candidates: DataFrame, k: int) -> DataFrame:
    """Global top-k per query over local candidates; rank from 1."""
    w = Window.partitionBy("query_id").orderBy(
        F.round("score", RANK_DIGITS).desc(), F.col("record_id"))
    return candidates.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def knn_search(vectors: DataFrame, queries: DataFrame, top_k: int, metric: str = "cosine", *,
               query_id: str = "query_id", query_vector: str = "vector", vector_col: str = "vector",
               carry: tuple[str, ...] = (), max_block_rows: int = MAX_BLOCK_ROWS,
               dimensions: int | None = None) -> DataFrame:
    """H2: (query_id, rank, record_id, score, *carry) for every query.

    ``carry`` names vector-table columns (e.g. chunk_id) passed through the
    scoring tasks, so no join back to the vector table is needed. ``top_k``
    larger than the index simply returns every record; an empty index returns
    no rows. A query of another length than the vectors (``dimensions``, or
    the length of the first vector) is an error.
    """
    require_positive(top_k, "top_k")
    check_metric(metric)
    v = vectors.select(F.col("record_id").cast("string").alias("record_id"),
                       F.col(vector_col).cast("array<double>").alias("vec"), *carry)
    schema = candidate_schema(queries, query_id, vectors, carry)
    dimensions = dimensions or vector_dimensions(vectors, vector_col)
    found = None
    if dimensions is not None:
        for block in query_blocks(queries, query_id, query_vector, dimensions=dimensions, max_rows=max_block_rows):
            part = scan_block(v, block, metric, top_k, schema, carry)
            found = part if found is None else found.unionByName(part)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], schema)
    return rank_candidates(found, top_k).select("query_id", "rank", "record_id", "score", *carry)
