"""Helpers shared by the training-data operators.

Intermediate tables go to the folder the cluster names in
``spark.checkpoint.dir`` (see ``sparkretrieve.session.scratch_path``), so a
lost executor never takes the only copy of a result with it.
"""

from __future__ import annotations

import contextlib
import sys
import types
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkretrieve.functions.batches import release_free_memory  # noqa: F401 - part of this module's surface
from sparkretrieve.session import scratch_path

# The white space of the contracts: space and \x09-\x0D.
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` as ``materialise`` returns it, and the folder that holds it, for
    ``remove_path`` once nothing reads it any more."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back: cuts the
    lineage, survives lost executors, and is not computed twice."""
    return written(df, name)[0]


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else (``lower`` would change other letters)."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not use yet (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def process_cache(kind: str, key: Any, make: Callable[[], Any]) -> Any:
    """``make()``, kept per Python worker process until another ``key`` of the
    same kind is asked for; workers are reused across tasks, and functions
    shipped by value have no module state."""
    holder = sys.modules.get("_sparkretrieve_llm_cache")
    if holder is None:
        holder = types.ModuleType("_sparkretrieve_llm_cache")
        holder.values = {}
        sys.modules["_sparkretrieve_llm_cache"] = holder
    if holder.values.get(kind, (None,))[0] != key:
        holder.values.pop(kind, None)
        holder.values[kind] = (key, make())
    return holder.values[kind][1]


class Shared:
    """A broadcast value with a name that is the same in every task."""

    def __init__(self, spark: SparkSession, value: Any) -> None:
        self.broadcast, self.id = spark.sparkContext.broadcast(value), uuid.uuid4().hex

    @property
    def value(self) -> Any:
        return self.broadcast.value


def map_batches(df: DataFrame, schema: str, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]],
                rows_per_batch: int = 4096) -> DataFrame:
    """``df.mapInArrow`` for a function that yields dicts of equal-length
    columns; long outputs are cut into batches of ``rows_per_batch`` rows."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType, _parse_datatype_string

    spark_schema: StructType = _parse_datatype_string(schema)
    arrow_schema = to_arrow_schema(spark_schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in fn(batches):
            arrays = [pa.array(out[f.name], type=f.type) if not isinstance(out[f.name], pa.Array)
                      else out[f.name].cast(f.type) for f in arrow_schema]
            whole = pa.RecordBatch.from_arrays(arrays, schema=arrow_schema)
            for i in range(0, whole.num_rows, rows_per_batch):
                yield whole.slice(i, rows_per_batch)

    return df.mapInArrow(run, spark_schema)


@contextlib.contextmanager
def rows_per_arrow_batch(spark: SparkSession, rows: int) -> Iterator[None]:
    """Actions inside send at most ``rows`` rows at once to Python: for tables
    whose rows are megabytes each, so that a worker holds one and not a split."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextlib.contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of an action inside go when it ends, not when the driver
    happens to collect its garbage: for frames that are run once and written."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): every node that has an edge, with the smallest node
    value it reaches. ``edges`` has two columns of one orderable type.

    Alternates large-star and small-star steps on an edge table: each round is
    two aggregations with partial combine and two equi-joins, written to the
    shared folder. No neighbour list, component or edge set is collected; the
    driver sees one row (count, hash) a round. Rounds grow with the logarithm
    of a component's size.
    """
    a, b = edges.columns
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")) \
        .filter("u is not null and v is not null and u != v").distinct()
    now = materialise(now, "edges")
    seen = _signature(now)
    for _ in range(max_rounds):
        if seen[0] == 0:
            break
        # Large star: every larger neighbour of u hangs on u's smallest neighbour.
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u != v").distinct()
        # Small star: u and its smaller neighbours hang on the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .union(least.select("u", F.col("m").alias("v"))).filter("u != v").distinct()
        now = materialise(small, "edges")
        was, seen = seen, _signature(now)
        if was == seen:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.union(roots)
