"""Nearest neighbours by multiprobe p-stable hashing.

Index: every vector gets, for each of ``TABLES`` tables, a bucket: its
projections on some Gaussian directions, shifted and cut into intervals. The
number of directions follows the logarithm of the number of vectors, so that a
bucket holds about ``OCCUPANCY`` of them. The index is one written table, in
range partitions of (table, bucket, identifier): a row packs at most ``CHUNK``
vectors of a bucket, so a large bucket is many rows in many tasks.

Search: each query makes its own sequence of buckets, in the order of their
estimated success, and probes meet the index in an equi-join on (table,
bucket). A neighbour at distance r lies, in every direction, at a normal
deviation of r from the query, so the success of a bucket is the product of
its intervals' probabilities; the sequence ends when they add up to what is
wanted. That is done twice: a first few buckets give every query k candidates,
and the k-th distance is the r of the second search, which also bounds what it
returns. Candidates of all tables and both searches are merged and ranked by
exact distance.

What probing cannot serve is compared with every vector, in blocks: queries
that met fewer than k candidates, and those that would visit more than
``MAX_VISITS`` buckets. Queries never pass through the driver.

Copies: of equal vectors only the k + 1 with the smallest identifiers can be
among anybody's nearest, so the others are left out of the index before the
shuffle, and no group of copies can be large in it; they still are queries.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkretrieve.llm.common import map_batches, materialise, rows_per_arrow_batch

TABLES = 2
WIDTH = 2.0  # of an interval, in units of the root mean square length of vectors
OCCUPANCY = 256  # vectors a bucket
SUCCESS = 0.9
FIRST_SUCCESS = 0.15  # of the search that gives a query its radius
MAX_VISITS = 65_536  # buckets of one table that a query visits
CHUNK = 1024  # vectors a row of the index
QUERY_BLOCK = 256  # queries a row of probes
ROWS_AT_ONCE = 32  # pairs of such rows in one Arrow batch
PAIRS_AT_ONCE = 16_384
FAR = 2.0 ** 50  # cell numbers beyond it are not exact


def valid_vectors(rows: DataFrame, id_col: str, vector_col: str, queries: Column) -> DataFrame:
    """(id, v array<double>, asked): one row per identifier that can take part;
    ``asked``: whether ``queries`` holds for any row of it. Null identifiers,
    null and zero vectors, and vectors with a null or non-finite component have
    no part, nor have those that are not of the most frequent length. Of an
    identifier's different vectors the smallest counts."""
    v = F.col(vector_col).cast("array<double>")
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) \
        & F.exists("v", lambda x: x != 0)
    found = rows.select(F.col(id_col).cast("long").alias("id"), v.alias("v"), F.coalesce(queries, F.lit(False)).alias("asked")) \
        .filter(F.col("id").isNotNull()) \
        .groupBy("id").agg(F.min(F.when(sound, F.col("v"))).alias("v"), F.max("asked").alias("asked")).filter(F.col("v").isNotNull())
    found = materialise(found, "vectors")
    size = found.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("c")) \
        .orderBy(F.desc("c"), "n").first()
    return found if size is None else found.filter(F.size("v") == size["n"])


def projections_for(n: int) -> int:
    """Directions a table: one of them tells about 1.05 bits (the entropy of a
    normal variable cut into intervals of two deviations)."""
    return min(max(round(math.log2(max(n / OCCUPANCY, 1)) / 1.05), 3), 24)


class Hashing:
    """The random directions and shifts, from a seed; the same in every task."""

    def __init__(self, dim: int, projections: int, width: float, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        self.projections, self.width = projections, width
        self.directions = rng.standard_normal((dim, TABLES * projections))
        self.shifts = rng.uniform(0, width, TABLES * projections)
        self.factors = rng.integers(1, 2 ** 62, projections, dtype=np.int64) * 2 + 1

    def positions(self, x: np.ndarray) -> np.ndarray:
        """(rows, tables, projections), in units of an interval."""
        with np.errstate(over="ignore", invalid="ignore"):
            at = np.nan_to_num((x @ self.directions + self.shifts) / self.width, posinf=2 * FAR, neginf=-2 * FAR)
        return np.clip(at, -2 * FAR, 2 * FAR).reshape(len(x), TABLES, self.projections)

    def buckets(self, cells: np.ndarray) -> np.ndarray:
        """A 64-bit number of the last axis: two buckets that share one by
        chance are searched together, which adds candidates and loses none."""
        with np.errstate(over="ignore"):
            return (cells.astype(np.int64) * self.factors).sum(axis=-1)


def _normal_below(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2))


def _intervals(at: float, spread: float) -> list[tuple[float, int]]:
    """(probability, step from the own cell) of the intervals within six
    deviations of a position, the likeliest first. ``spread``: the deviation,
    in intervals."""
    own = math.floor(at)
    low, high = math.floor(at - 6 * spread) - own, math.floor(at + 6 * spread) - own
    edges = [_normal_below((own + j - at) / spread) for j in range(low, high + 2)]
    found = [(edges[j + 1] - edges[j], low + j) for j in range(high - low + 1)]
    return sorted((f for f in found if f[0] > 0), key=lambda f: (-f[0], abs(f[1]), f[1]))


def probe_sequence(position: np.ndarray, spread: float, success: float,
                   most: int) -> list[tuple[float, tuple[int, ...]]] | None:
    """(estimated success, steps from the own bucket) of the buckets to visit,
    the likeliest first, until the successes add up to ``success``. None if
    more than ``most`` buckets were needed.

    Buckets are made lazily from a heap: each one raises one interval's rank at
    or after the last place raised, so every combination has one parent, which
    is at least as likely."""
    if 12 * spread > 256 or np.abs(position).max() > FAR:
        return None
    choices = [_intervals(float(p), spread) for p in position]
    costs = [[-math.log(p) for p, _ in c] for c in choices]
    heap: list[tuple[float, tuple[int, ...], int]] = [(sum(c[0] for c in costs), (0,) * len(costs), 0)]
    found: list[tuple[float, tuple[int, ...]]] = []
    total = 0.0
    while heap and total < success:
        if len(found) == most:
            return None
        cost, ranks, last = heapq.heappop(heap)
        chance = math.exp(-cost)
        found.append((chance, tuple(c[r][1] for c, r in zip(choices, ranks))))
        total += chance
        for i in range(last, len(ranks)):
            r = ranks[i] + 1
            if r < len(costs[i]):
                heapq.heappush(heap, (cost - costs[i][r - 1] + costs[i][r], ranks[:i] + (r,) + ranks[i + 1:], i))
    return found


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype("float64", copy=False).reshape(-1, dim)


_ENTRY = "tbl int, bucket long, id long, v binary, radius double"


def _packed(entries: DataFrame, size: int) -> DataFrame:
    """Rows of at most ``size`` entries of one bucket. Range partitions divide
    a large bucket between tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            tbl, bucket, ids, radius = (batch.column(c).to_numpy(zero_copy_only=False)
                                        for c in ("tbl", "bucket", "id", "radius"))
            if not len(ids):
                continue
            v = batch.column("v").to_pylist()
            change = np.flatnonzero((np.diff(tbl) != 0) | (np.diff(bucket) != 0)) + 1
            runs = np.concatenate([[0], change, [len(ids)]])
            cuts = [c for a, b in zip(runs, runs[1:]) for c in range(a, b, size)] + [len(ids)]
            spans = list(zip(cuts, cuts[1:]))
            yield {"tbl": tbl[cuts[:-1]], "bucket": bucket[cuts[:-1]],
                   "ids": [ids[a:b].astype(np.int64).tobytes() for a, b in spans],
                   "vs": [b"".join(v[a:b]) for a, b in spans],
                   "radii": [radius[a:b].astype(np.float64).tobytes() for a, b in spans]}

    keys = ("tbl", "bucket", "id")
    return map_batches(entries.repartitionByRange(*keys).sortWithinPartitions(*keys),
                       "tbl int, bucket long, ids binary, vs binary, radii binary", run, 64)


def index_vectors(vectors: DataFrame, k: int, hashing: Hashing) -> DataFrame:
    """The written index: (tbl, bucket, ids, vs), packed."""
    dim = len(hashing.directions)
    # Filtering a rank prunes within each task before the shuffle.
    rank = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    reachable = vectors.withColumn("rank", rank).filter(F.col("rank") <= k + 1).drop("rank")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            x = _matrix(batch.column("v"), dim)
            buckets = hashing.buckets(np.floor(hashing.positions(x)))
            raw = [row.tobytes() for row in x]
            for t in range(TABLES):
                yield {"tbl": np.full(len(x), t), "bucket": buckets[:, t], "id": batch.column("id"), "v": raw,
                       "radius": np.full(len(x), np.nan)}

    entries = materialise(map_batches(reachable, _ENTRY, run), "hashed")
    return materialise(_packed(entries, CHUNK).drop("radii"), "index")


def _probes(queries: DataFrame, hashing: Hashing, success: float, guess: float) -> DataFrame:
    """One entry per query and bucket that it visits. ``queries``: (id, v,
    radius), a null radius counts as ``guess``. A query that needs more than
    ``MAX_VISITS`` buckets has one entry with a null bucket instead."""
    dim, most = len(hashing.directions), MAX_VISITS
    one = 1 - (1 - success) ** (1 / TABLES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            x = _matrix(batch.column("v"), dim)
            at = hashing.positions(x)
            own = np.floor(at)
            for i, (q, r) in enumerate(zip(batch.column("id").to_pylist(), batch.column("radius").to_pylist())):
                raw = x[i].tobytes()
                spread = max(guess if r is None else r, 1e-9 * guess) / hashing.width
                visits = [probe_sequence(at[i, t], spread, one, most) for t in range(TABLES)]
                if any(v is None for v in visits):
                    yield {"tbl": [0], "bucket": pa.nulls(1, pa.int64()), "id": [q], "v": [raw],
                           "radius": pa.array([r], pa.float64())}
                    continue
                for t, found in enumerate(visits):
                    steps = np.asarray([s for _, s in found], np.int64)
                    n = len(found)
                    yield {"tbl": np.full(n, t), "bucket": hashing.buckets(own[i, t].astype(np.int64) + steps),
                           "id": np.full(n, q), "v": [raw] * n, "radius": pa.array([r] * n, pa.float64())}

    return map_batches(queries.repartition("id"), _ENTRY, run)


def score_block(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, radii: np.ndarray,
                k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query ids, ids, distances): for each query the k nearest others in the
    block, ties to the smaller id, none beyond its radius (NaN: any).

    Products of matrices only preselect, with a margin for their rounding."""
    with np.errstate(over="ignore", invalid="ignore"):
        xx, qq = (x * x).sum(axis=1), (q * q).sum(axis=1)
        rough = qq[:, None] + xx[None, :] - 2 * (q @ x.T)
        rough[query_ids[:, None] == ids[None, :]] = np.inf
        limit = np.where(np.isnan(radii), np.inf, radii * radii)
        if len(ids) > k:
            limit = np.minimum(limit, np.partition(rough, k - 1, axis=1)[:, k - 1])
        limit = limit + 1e-9 * (qq + xx.max())
        row, col = np.nonzero(~(rough > limit[:, None]))
        other = query_ids[row] != ids[col]
        row, col = row[other], col[other]
        parts = [np.sqrt(((x[col[a:a + PAIRS_AT_ONCE]] - q[row[a:a + PAIRS_AT_ONCE]]) ** 2).sum(axis=1))
                 for a in range(0, len(row), PAIRS_AT_ONCE)]
    d = np.concatenate(parts) if parts else np.empty(0)
    near = ~(d > radii[row])
    row, col, d = row[near], col[near], d[near]
    order = np.lexsort((ids[col], d, row))
    row, col, d = row[order], col[order], d[order]
    best = np.arange(len(row)) - np.searchsorted(row, row) < k
    return query_ids[row[best]], ids[col[best]], d[best]


def _scored(pairs: DataFrame, dim: int, k: int, name: str) -> DataFrame:
    """Candidates of joined rows (ids, vs, query_ids, qs, radii), written."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, query_ids = (np.frombuffer(batch.column(c)[i].as_py(), np.int64) for c in ("ids", "query_ids"))
                x, q = (np.frombuffer(batch.column(c)[i].as_py(), np.float64).reshape(-1, dim) for c in ("vs", "qs"))
                radii = np.frombuffer(batch.column("radii")[i].as_py(), np.float64)
                found, near, d = score_block(ids, x, query_ids, q, radii, k)
                yield {"query_id": found, "vec_id": near, "score": d}

    with rows_per_arrow_batch(pairs.sparkSession, ROWS_AT_ONCE):
        return materialise(map_batches(pairs, "query_id long, vec_id long, score double", run), name)


def _nearest(candidates: DataFrame, k: int) -> DataFrame:
    """The k nearest of each query; a candidate of several tables counts once."""
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    once = candidates.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _as_queries(packed: DataFrame) -> DataFrame:
    return packed.withColumnsRenamed({"ids": "query_ids", "vs": "qs"})


def _never_broadcast(packed: DataFrame) -> DataFrame:
    """Spark takes a written table for as large as its files, in which a vector
    that many probes carry is stored once, and exploded rows for as large as the
    rows before; so it would send tables of any size through the driver."""
    return packed.hint("merge")


def _visited(index: DataFrame, probes: DataFrame, dim: int, k: int, name: str) -> DataFrame:
    packed = _as_queries(_packed(probes.filter("bucket is not null"), QUERY_BLOCK))
    return _scored(index.join(_never_broadcast(packed), ["tbl", "bucket"]), dim, k, name)


def _compared_with_all(index: DataFrame, queries: DataFrame, dim: int, k: int) -> DataFrame:
    """The exact way: blocks of queries against every row of one table, dealt
    over as many keys as the session has shuffle partitions."""
    deals = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    entries = queries.select(F.lit(0).alias("tbl"), F.lit(0).cast("long").alias("bucket"), "id", "v", "radius")
    packed = _as_queries(_packed(entries, QUERY_BLOCK)).drop("tbl", "bucket")
    packed = packed.withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(deals - 1))))
    rows = index.filter("tbl = 0").select("ids", "vs", F.pmod(F.xxhash64("ids"), F.lit(deals)).cast("int").alias("deal"))
    return _scored(rows.join(_never_broadcast(packed), "deal"), dim, k, "compared")


def nearest_neighbours(rows: DataFrame, queries: Column, k: int = 10, id_col: str = "vec_id",
                       vector_col: str = "embedding", success: float = SUCCESS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that ``queries`` holds for,
    the k nearest others found by Euclidean distance, ties to the smaller
    identifier; all others if there are no more than k. ``success`` is the
    estimated chance that a neighbour at the radius is met in some table.

    Rows that have no part (see ``valid_vectors``) are neither queries nor
    candidates. Equal vectors are neighbours at distance 0. Other columns are
    not read. An empty table gives an empty result."""
    spark = rows.sparkSession
    vectors = valid_vectors(rows, id_col, vector_col, queries)
    facts = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dim"), F.avg(F.aggregate(
        "v", F.lit(0.0), lambda a, x: a + x * x)).alias("power")).first()
    if facts["dim"] is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim = facts["dim"]
    scale = math.sqrt(facts["power"]) if 0 < facts["power"] < math.inf else 1.0
    hashing = Hashing(dim, projections_for(facts["n"]), WIDTH * scale)
    index = index_vectors(vectors, k, hashing)
    asked = vectors.filter("asked").select("id", "v")

    first = _probes(asked.withColumn("radius", F.lit(None).cast("double")), hashing, FIRST_SUCCESS, scale)
    early = materialise(_nearest(_visited(index, first, dim, k, "first"), k), "early")
    known = early.filter(F.col("rank") == k) \
        .select(F.col("query_id").alias("id"), F.col("score").alias("radius")).filter(F.col("radius") < math.inf)
    asked = materialise(asked.join(known, "id", "left"), "asked")

    probes = materialise(_probes(asked.filter("radius is not null"), hashing, success, scale), "probes")
    as_bytes = map_batches(asked.filter("radius is null"), "id long, v binary, radius double", _bytes_of(dim))
    rest = probes.filter("bucket is null").select("id", "v", "radius").union(as_bytes)
    found = early.select("query_id", "vec_id", "score").union(_visited(index, probes, dim, k, "visited")) \
        .union(_compared_with_all(index, rest, dim, k))
    return _nearest(found, k) \
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _bytes_of(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            yield {"id": batch.column("id"), "v": [row.tobytes() for row in _matrix(batch.column("v"), dim)],
                   "radius": batch.column("radius")}

    return run
