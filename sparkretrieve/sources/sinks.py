"""Record tables with upserts by id (B1-B3): extendible hashing, published in versions.

A table is a directory of *buckets*. A bucket of depth d holds the ids whose
hash ends with its d bits, in folders of Parquet files that are never changed.
An upsert compares its ids with those of the buckets they fall into. A bucket
that holds none of them gets one more folder with the new rows; one that holds
some is read, loses those ids and is written anew with the new rows, by one
shuffle of its rows, as is one that has many folders once it has doubled. A
bucket that would outgrow ``bucket_bytes`` is split into as many deeper ones as
it needs, so no parameter fixes their number and no task writes more than a
bucket. Then the new directory is published as the table's next version (see
``sources.snapshots``): a reader has the table before or after an upsert,
and a job that dies before it leaves the table as it was. All other
buckets stay where they are.

Every row keeps its size in bytes beside it, so the sizes of the buckets are
exact after replacements.
"""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkretrieve.operators.sizing import broadcast_if_bounded, row_bytes
from sparkretrieve.session import path_exists, remove_path, scratch_path
from sparkretrieve.sources import snapshots

BUCKET_BYTES = 256 << 20
MAX_DEPTH = 24
MAX_RUNS = 16  # folders added to a bucket before it is written anew once it has doubled
_SIZE, _KIND = "_row_bytes", "_kind"
OLD, REMOVED, NEW = range(3)


def _slot(id_col: str, depth: int):
    return F.xxhash64(id_col).bitwiseAND(F.lit((1 << depth) - 1))


class RecordTable:
    """One version of a sink's table (default: the last)."""

    def __init__(self, spark: SparkSession, path: str, version: int | None = None) -> None:
        found = snapshots.read_version(spark, path, version)
        if found is None:
            raise FileNotFoundError(f"record table not found: {path}")
        self.spark, self.path = spark, path
        self.version, self.content = found

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(self.content["schema"])

    @property
    def buckets(self) -> list[dict[str, Any]]:
        """depth, suffix, rows, bytes and folder of each bucket that has rows; the
        folders added to it since (runs), and its bytes before them (base)."""
        return self.content["buckets"]

    @property
    def depth(self) -> int:
        return max((b["depth"] for b in self.buckets), default=0)

    def _read(self, buckets: list[dict[str, Any]]) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField(_SIZE, T.LongType()), T.StructField("batch", T.StringType()),
                               T.StructField("bucket", T.StringType())])
        if not buckets:
            return self.spark.createDataFrame([], schema)
        base = f"{self.path}/data"
        return self.spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/{f}" for b in buckets for f in _folders(b)])

    def rows(self, with_bucket: bool = False) -> DataFrame:
        """The records (and the name of their bucket, by which they can be pruned)."""
        found = self._read(self.buckets).drop(_SIZE, "batch")
        return found if with_bucket else found.drop("bucket")

    def with_bucket(self, df: DataFrame, id_col: str) -> DataFrame:
        """``df`` with the name of the bucket that holds each id (null if none can)."""
        depth = self.depth
        slots = [(b["suffix"] | high << b["depth"], _name(b)) for b in self.buckets for high in range(1 << (depth - b["depth"]))]
        places = self.spark.createDataFrame(slots, "_slot bigint, bucket string")  # 2^depth rows at most
        side, _ = broadcast_if_bounded(places, upper_bound=1 << depth)
        return df.withColumn("_slot", _slot(id_col, depth)).join(side, "_slot", "left").drop("_slot")


def _name(bucket: dict[str, Any]) -> str:
    return f"{bucket['depth']}-{bucket['suffix']}"


def _folders(bucket: dict[str, Any]) -> list[str]:
    return [bucket["folder"], *bucket.get("runs", [])]


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """A sink's records, or None before its first write."""
    return RecordTable(spark, path).rows() if snapshots.versions(spark, path) else None


def _split(suffix: int, depth: int, n_bytes: int, bucket_bytes: int) -> list[tuple[int, int]]:
    """(depth, suffix) of the buckets that take ``n_bytes`` of evenly hashed rows."""
    deeper = depth
    while n_bytes > bucket_bytes << (deeper - depth) and deeper < MAX_DEPTH:
        deeper += 1
    return [(deeper, suffix | high << depth) for high in range(1 << (deeper - depth))]


def upsert_table(batch: DataFrame, path: str, id_col: str, *, bucket_bytes: int | None = None,
                 remove: DataFrame | None = None, written: bool = False) -> int:
    """Replace or add the rows of ``batch`` (one per id), and drop the ids of
    ``remove`` (a table of ids that ``batch`` does not hold); returns the new
    version. ``bucket_bytes`` (default: 256 MB, then the table's own) is the
    size beyond which a bucket is split. The batch's columns must be those of
    the table; nothing is published if anything fails. ``written``: the batch is
    read from a table by cheap steps, so it is not copied first."""
    spark = batch.sparkSession
    old = RecordTable(spark, path) if snapshots.versions(spark, path) else None
    if old is not None and {f.name: f.dataType for f in old.schema} != {f.name: f.dataType for f in batch.schema}:
        raise ValueError("the batch's columns are not those of the table")
    limit = bucket_bytes or (old.content["bucket_bytes"] if old else BUCKET_BYTES)
    new, staged = batch.withColumn(_SIZE, row_bytes(batch.schema)), None
    if not written:  # it is read several times, and its plan may be costly
        staged = scratch_path(spark, "upsert")
        new.write.parquet(staged)
        new = spark.read.schema(T.StructType([*batch.schema.fields, T.StructField(_SIZE, T.LongType())])).parquet(staged)

    # The buckets that are touched, with an upper bound of what they will hold.
    known = {(b["depth"], b["suffix"]): b for b in (old.buckets if old else [])}
    leaves = _leaves(set(known))
    depth = max(d for d, _ in leaves)
    found = new.groupBy(_slot(id_col, depth).alias("slot")).agg(F.sum(_SIZE).alias("b")).collect()  # 2^depth rows at most
    sizes: dict[tuple[int, int], int] = {}
    of_slot = {s | high << d: (d, s) for d, s in leaves for high in range(1 << (depth - d))}
    for r in found:
        sizes[of_slot[r["slot"]]] = sizes.get(of_slot[r["slot"]], 0) + r["b"]
    if remove is not None:
        for r in remove.select(_slot(id_col, depth).alias("slot")).distinct().collect():
            if of_slot[r["slot"]] in known:
                sizes.setdefault(of_slot[r["slot"]], 0)
    touched = [known[k] for k in sizes if k in known]
    added: dict[tuple[int, int], dict[str, Any]] = {}
    if touched:
        ids = new.select(id_col) if remove is None else new.select(id_col).union(remove.select(id_col))
        side, _ = broadcast_if_bounded(ids)
        hit = {r["bucket"] for r in old._read(touched).select(id_col, "bucket").join(side, id_col, "left_semi").select("bucket").distinct().collect()}
        for b in touched:
            k = b["depth"], b["suffix"]
            if _name(b) in hit:
                continue
            if not sizes[k]:  # nothing goes and nothing comes
                del sizes[k]
            elif sizes[k] + b["bytes"] <= limit and (len(b.get("runs", [])) < MAX_RUNS or b["bytes"] < 2 * b.get("base", b["bytes"])):
                added[k] = b
        touched = [b for b in touched if (b["depth"], b["suffix"]) in sizes and (b["depth"], b["suffix"]) not in added]
    merged = new
    if touched:
        before = old._read(touched).select(*new.columns)
        rows = before.withColumn(_KIND, F.lit(OLD)).unionByName(new.withColumn(_KIND, F.lit(NEW)))
        stay = before.select(id_col, _SIZE).join(new.select(id_col), id_col, "left_anti")
        if remove is not None:
            rows = rows.unionByName(remove.select(id_col, F.lit(REMOVED).alias(_KIND)), allowMissingColumns=True)
            stay = stay.join(remove.select(id_col), id_col, "left_anti")
        most = {k: n + known.get(k, {"bytes": 0})["bytes"] for k, n in sizes.items()}
        if max(most.values()) > limit:  # whether a bucket must be split depends on what stays
            for r in stay.groupBy(_slot(id_col, depth).alias("slot")).agg(F.sum(_SIZE).alias("b")).collect():
                sizes[of_slot[r["slot"]]] += r["b"]
        else:
            sizes = most
        merged = rows

    targets = [t for (d, s), n in sizes.items() for t in ([(d, s)] if (d, s) in added else _split(s, d, n, limit))]
    width = max((d for d, _ in targets), default=0)
    names = [(s | high << d, f"{d}-{s}") for d, s in targets for high in range(1 << (width - d))]
    side, _ = broadcast_if_bounded(spark.createDataFrame(names, "_slot bigint, bucket string"), upper_bound=len(names))
    folder = f"batch={uuid.uuid4().hex}"
    # A bucket's rows come to one task, and a bucket is bounded.
    merged = merged.withColumn("_slot", _slot(id_col, width)).join(side, "_slot").drop("_slot").repartition("bucket")
    if touched:  # there the newest rows of an id stay, without another shuffle
        newest = F.max(_KIND).over(Window.partitionBy("bucket", id_col))
        merged = merged.withColumn("_newest", newest).filter(
            (F.col(_KIND) == NEW) | ((F.col(_KIND) == OLD) & ((F.col("_newest") == OLD) | F.col(id_col).isNull()))).drop(_KIND, "_newest")
    (merged.write.partitionBy("bucket").parquet(f"{path}/data/{folder}"))
    buckets = [b for k, b in known.items() if k not in sizes]
    if path_exists(spark, f"{path}/data/{folder}") and sizes:
        written = spark.read.schema(T.StructType([T.StructField(_SIZE, T.LongType()), T.StructField("bucket", T.StringType())])) \
            .parquet(f"{path}/data/{folder}")
        for r in written.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum(_SIZE).alias("b")).collect():
            d, s = map(int, r["bucket"].split("-"))
            entry = {"depth": d, "suffix": s, "rows": r["n"], "bytes": r["b"], "base": r["b"], "folder": f"{folder}/bucket={r['bucket']}", "runs": []}
            b = added.get((d, s))
            if b is not None:
                entry = b | {"rows": b["rows"] + r["n"], "bytes": b["bytes"] + r["b"], "runs": [*b.get("runs", []), entry["folder"]]}
            buckets.append(entry)
    content = {"schema": batch.schema.jsonValue(), "bucket_bytes": limit, "buckets": buckets}
    version = snapshots.publish(spark, path, content, old.version if old else 0)
    if staged is not None:
        remove_path(spark, staged)
    return version


def _leaves(known: set[tuple[int, int]]) -> list[tuple[int, int]]:
    """All buckets of the directory: the known ones and, beside them, those that
    have no rows, as shallow as the known ones allow."""
    leaves, todo = [], [(0, 0)]
    inner = {(d - k, s & ((1 << (d - k)) - 1)) for d, s in known for k in range(1, d + 1)}
    while todo:
        d, s = todo.pop()
        if (d, s) in inner:
            todo += [(d + 1, s), (d + 1, s | 1 << d)]
        else:
            leaves.append((d, s))
    return leaves


def drop_old_versions(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Forget all but the last ``keep`` versions and delete the folders that only
    they used; returns how many folders went. Not while older versions are read."""
    there = snapshots.versions(spark, path)
    used: set[str] = set()
    gone: set[str] = set()
    for n in there:
        folders = {f for b in snapshots.read_version(spark, path, n)[1]["buckets"] for f in _folders(b)}
        if n in there[-keep:]:
            used |= folders
        else:
            gone |= folders
    for n in there[:-keep]:
        remove_path(spark, f"{path}/{snapshots.VERSIONS}/{n:010d}.json")
    for folder in gone - used:
        remove_path(spark, f"{path}/data/{folder}")
    return len(gone - used)
