"""Approximate kNN with an inverted-file (IVF) index (H3, H4).

Stands in for the single-machine graph index: centroids (``pyspark.ml`` KMeans,
or given ones) split the vector table into cells; a query is compared only with the
vectors of its ``nprobe`` nearest cells. With ``nprobe = nlist`` every cell is
probed and the result equals exact search.

The index is one table, written once and partitioned by cell, and its
centroids beside it. A search reads the probed cells only (partition pruning)
and needs no shuffle of vectors: like in ``knn``, a block of queries is shipped
to the tasks, and a task keeps k rows per query. A hot cell is many files, and
so many tasks. The caller chooses ``nlist``; about the square root of the
number of vectors keeps cells and centroids balanced.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkretrieve.checks import check_metric, require_positive
from sparkretrieve.operators import knn
from sparkretrieve.session import scratch_path

DEFAULT_NLIST = 16
DEFAULT_NPROBE = 4


def nearest_cells(q: np.ndarray, centroids: np.ndarray, metric: str, nprobe: int) -> np.ndarray:
    """Indices of the ``nprobe`` best centroids per query row, best first, ties
    to the smaller index; in blocks of rows, one product each."""
    p = min(nprobe, centroids.shape[0])
    if metric == "cosine":
        q = knn._normalise(q)
    half = 0.5 * np.einsum("ij,ij->i", centroids, centroids) if metric == "l2" else 0.0
    out = [np.argsort(half - q[k:k + knn.TILE_QUERIES] @ centroids.T, axis=1, kind="stable")[:, :p]
           for k in range(0, len(q), knn.TILE_QUERIES)]
    return np.concatenate(out) if out else np.zeros((0, p), np.int64)


@dataclass
class IVFIndex:
    path: str
    vectors: DataFrame  # the record columns and cell
    centroids: np.ndarray
    metric: str = "cosine"

    @property
    def nlist(self) -> int:
        return int(self.centroids.shape[0])

    @property
    def dimensions(self) -> int:
        return int(self.centroids.shape[1])

    def add(self, embedding_records: DataFrame, strict: bool = True) -> IVFIndex:
        """H4: validate all records against this index (wrong length, blank or
        known ids), then append them to their cells; the centroids stay."""
        from sparkretrieve.operators import vectors

        checked = vectors.validate_vector_records(embedding_records, self.dimensions, existing=self.vectors)
        valid, _ = vectors.split_valid(checked, strict=strict)
        _write(valid.select(*[c for c in self.vectors.columns if c != "cell"]), self.path, self.centroids,
               self.metric, "append")
        return load_ivf_index(self.vectors.sparkSession, self.path)


def _write(records: DataFrame, path: str, centroids: np.ndarray, metric: str, mode: str) -> None:
    @F.pandas_udf(T.IntegerType())
    def cell(vs: pd.Series) -> pd.Series:
        m = knn._matrix(vs, centroids.shape[1])
        return pd.Series(nearest_cells(m, centroids, metric, 1)[:, 0].astype("int32"))

    records.withColumn("cell", cell(F.col("vector").cast("array<double>"))) \
        .write.mode(mode).partitionBy("cell").parquet(f"{path}/vectors")


def build_ivf_index(vectors: DataFrame, centroids: np.ndarray, metric: str = "cosine",
                    path: str | None = None) -> IVFIndex:
    """Write the index for given centroids (normalised ones for cosine)."""
    check_metric(metric)
    spark = vectors.sparkSession
    path = path or scratch_path(spark, "ivf")
    centroids = np.asarray(centroids, dtype=np.float64)
    _write(vectors, path, centroids, metric, "overwrite")
    spark.createDataFrame([(metric, json.dumps(centroids.tolist()))], "metric string, centroids string") \
        .coalesce(1).write.mode("overwrite").parquet(f"{path}/centroids")
    return load_ivf_index(spark, path)


def load_ivf_index(spark: SparkSession, path: str) -> IVFIndex:
    """Reopen an index written by ``build_ivf_index`` or ``train_ivf``."""
    row = spark.read.parquet(f"{path}/centroids").first()
    return IVFIndex(path, spark.read.parquet(f"{path}/vectors"), np.asarray(json.loads(row["centroids"])), row["metric"])


def train_ivf(vectors: DataFrame, nlist: int = DEFAULT_NLIST, metric: str = "cosine", *, seed: int = 7,
              max_iter: int = 10, path: str | None = None) -> IVFIndex:
    """KMeans cells over all vectors (normalised first for cosine), then the index."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    require_positive(nlist, "nlist")
    check_metric(metric)
    vec = F.col("vector").cast("array<double>")
    if metric == "cosine":
        norm = F.sqrt(F.aggregate(vec, F.lit(0.0), lambda acc, x: acc + x * x))
        vec = F.when(norm > 0, F.transform(vec, lambda x: x / norm)).otherwise(vec)
    train = vectors.select(array_to_vector(vec).alias("features"))
    model = KMeans(k=nlist, seed=seed, maxIter=max_iter, featuresCol="features").fit(train)
    return build_ivf_index(vectors, np.array(list(model.clusterCenters()), dtype=np.float64), metric, path)


def ivf_search(index: IVFIndex, queries: DataFrame, top_k: int, nprobe: int = DEFAULT_NPROBE, *,
               query_id: str = "query_id", query_vector: str = "vector", carry: tuple[str, ...] = (),
               max_block_rows: int = knn.MAX_BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, record_id, score, *carry) over the probed cells."""
    require_positive(top_k, "top_k")
    require_positive(nprobe, "nprobe")
    spark, metric = index.vectors.sparkSession, index.metric
    schema = knn.candidate_schema(queries, query_id, index.vectors, carry)
    v = index.vectors.select(F.col("record_id").cast("string").alias("record_id"),
                             F.col("vector").cast("array<double>").alias("vec"), "cell", *carry)
    found = None
    for ids, q in knn.query_blocks(queries, query_id, query_vector, dimensions=index.dimensions, max_rows=max_block_rows):
        cells = nearest_cells(q, index.centroids, metric, nprobe)
        asked = np.zeros((index.nlist, len(q)), bool)
        asked[cells.ravel(), np.repeat(np.arange(len(q)), cells.shape[1])] = True
        shared = spark.sparkContext.broadcast((ids, q, asked))

        def scan(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            q_ids, qm, by_cell = shared.value
            top = knn.TopK(qm, metric, top_k, carry)
            for batch in batches:
                for cell, part in batch.groupby("cell", sort=False):
                    top.add(knn._matrix(part["vec"]), [part[c].to_numpy(dtype=object) for c in top.columns], by_cell[cell])
            yield from top.frames(q_ids)

        probed = v.filter(F.col("cell").isin([int(c) for c in np.unique(cells)]))
        part = probed.mapInPandas(scan, schema)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], schema)
    return knn.rank_candidates(found, top_k).select("query_id", "rank", "record_id", "score", *carry)
