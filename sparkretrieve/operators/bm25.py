"""Lexical retrieval: BM25 Okapi over an inverted index.

Index. An index is a set of immutable *segments*; what belongs to it is a
version (see ``sources.snapshots``). For a segment the chunks are tokenised
once and counted inside their row; every task packs its chunks into *blocks* of
at most ``BLOCK_CHUNKS`` chunks: one row per (term, block) with the places of
the chunks that hold the term, its frequency and the chunks' lengths there,
and, for pruning, the largest frequency and the smallest length. Rows are
partitioned by a hash bucket of the term, so a search reads the buckets of its
terms only. The ids of a block's chunks are a table of their own.

Updates. ``update_bm25_index`` adds a segment for new and changed chunks, marks
the places of the chunks they replace as dead (tombstones), and corrects the
document frequencies and the statistics; no other segment is touched.
``compact_bm25_index`` rewrites segments without their dead places.

Search. Query terms (bounded blocks of queries, shipped to the tasks) pick
rows. For a top-k, only their heads are read first: they give an upper bound
of a query's score in each block. The blocks with the highest bounds that hold
k matches are scored; a block whose bound is below the k-th score found there
cannot hold a result and is neither read further nor shuffled. The others meet
by block, are scored there, and each block hands on at most k places per query.
Chunk ids are looked up for the places that can still be in the result, in the
blocks that hold them, and are never shuffled.

Skew: a stop word's postings are as long as the corpus, but they are one row
per block, and a block is bounded.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - pa.compute
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkretrieve.checks import require_positive, require_rows
from sparkretrieve.functions.batches import release_free_memory
from sparkretrieve.functions.text import tokenize
from sparkretrieve.operators.sizing import DEFAULT_MAX_BROADCAST_ROWS, bounded_count, broadcast_if_bounded
from sparkretrieve.session import remove_path, scratch_path
from sparkretrieve.sources import snapshots
from sparkretrieve.sources.sinks import RecordTable

# The studied library's BM25 Okapi defaults.
K1 = 1.5
B = 0.75
EPSILON = 0.25

SCORE_RANK_DIGITS = 9
# How far a bound may lie below a score by rounding alone.
BOUND_SLACK = 1e-6
BLOCK_CHUNKS = 4096
DEFAULT_TERM_BUCKETS = 16
MAX_QUERY_TERMS = 500_000  # (query, term) pairs shipped at a time
MAX_BLOCKS_BY_NAME = 10_000  # blocks that are asked for in a filter; more are joined
# A block's number holds its segment's, its task's and its own there.
SEGMENT_SHIFT, TASK_SHIFT = 44, 20


@dataclass
class BM25Index:
    spark: SparkSession
    path: str
    version: int
    content: dict[str, Any]  # segments, tombstones, terms, n_chunks, total_tokens, vocabulary, mean_idf, term_buckets
    k1: float = K1
    b: float = B
    epsilon: float = EPSILON

    @property
    def term_buckets(self) -> int:
        return self.content["term_buckets"]

    @property
    def avgdl(self) -> float | None:
        n = self.content["n_chunks"]
        return self.content["total_tokens"] / n if n else None

    def _segments(self, kind: str, schema: T.StructType, names: list[str] | None = None) -> DataFrame:
        names = [s["name"] for s in self.content["segments"]] if names is None else names
        if not names:
            return self.spark.createDataFrame([], schema)
        base = f"{self.path}/{kind}"
        return self.spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/segment={n}" for n in names])

    @property
    def postings(self) -> DataFrame:
        """term, block, places, tfs, lens, n, max_tf, min_len, segment, term_bucket; dead places included."""
        return self._segments("postings", _POSTINGS_TABLE)

    @property
    def blocks(self) -> DataFrame:
        """block, ids, lengths, segment; dead places included."""
        return self._segments("blocks", _BLOCKS_TABLE)

    @property
    def tombstones(self) -> DataFrame | None:
        """block, dead (places); None if no place is dead."""
        path = self.content["tombstones"]
        return self.spark.read.schema("block bigint, dead array<int>").parquet(f"{self.path}/{path}") if path else None

    @property
    def document_frequencies(self) -> DataFrame:
        return self.spark.read.schema("term string, df bigint, term_bucket int").parquet(f"{self.path}/{self.content['terms']}")

    @property
    def terms(self) -> DataFrame:
        """term, df, term_bucket, raw_idf, idf."""
        return _idf_columns(self.document_frequencies, self.content["n_chunks"], self.content["mean_idf"], self.epsilon)

    @property
    def stats(self) -> DataFrame:
        """One row: n_chunks, total_tokens, avgdl, vocabulary, mean_idf."""
        c = self.content
        return self.spark.range(1).select(
            F.lit(c["n_chunks"]).cast("bigint").alias("n_chunks"), F.lit(c["total_tokens"]).cast("bigint").alias("total_tokens"),
            F.lit(self.avgdl).cast("double").alias("avgdl"), F.lit(c["vocabulary"]).cast("bigint").alias("vocabulary"),
            F.lit(c["mean_idf"]).cast("double").alias("mean_idf"))


def term_bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def chunk_term_rows(chunks: DataFrame, text_col: str = "text") -> DataFrame:
    """(chunk_id, dl, terms ARRAY<STRUCT<term, tf>>): one row per chunk,
    map-side only -- sort the tokens, then run-length encode; no shuffle is
    needed for tf.

    The sorted array and the run starts are separate columns so the lambdas
    only read attributes (an expression inside a lambda would be evaluated
    once per element)."""
    toks = chunks.select("chunk_id", tokenize(text_col).alias("tokens")).withColumn("dl", F.size("tokens"))
    ordered = toks.select("chunk_id", "dl", F.sort_array("tokens").alias("_ord"))
    with_starts = ordered.select(
        "chunk_id", "dl", "_ord",
        F.filter(
            F.sequence(F.lit(1), F.greatest(F.col("dl"), F.lit(1))),
            lambda i: (i <= F.col("dl"))
            & ((i == 1) | (F.element_at(F.col("_ord"), i) != F.try_element_at(F.col("_ord"), i - 1))),
        ).alias("_starts"),
    )
    return with_starts.select(
        "chunk_id", "dl",
        F.transform("_starts", lambda st: F.element_at(F.col("_ord"), st)).alias("terms"),
        F.transform(
            "_starts", lambda st, j: (F.coalesce(F.try_element_at(F.col("_starts"), j + 2), F.col("dl") + 1) - st)
        ).alias("tfs"),
    )


_INTS = T.ArrayType(T.IntegerType())
_PACKED = T.StructType([
    T.StructField("term", T.StringType()), T.StructField("block", T.LongType()), T.StructField("places", _INTS),
    T.StructField("tfs", _INTS), T.StructField("lens", _INTS), T.StructField("n", T.IntegerType()),
    T.StructField("max_tf", T.IntegerType()), T.StructField("min_len", T.IntegerType()),
    T.StructField("ids", T.ArrayType(T.StringType()))])
_PACKED_ARROW = pa.schema([("term", pa.string()), ("block", pa.int64()), ("places", pa.list_(pa.int32())),
                           ("tfs", pa.list_(pa.int32())), ("lens", pa.list_(pa.int32())), ("n", pa.int32()),
                           ("max_tf", pa.int32()), ("min_len", pa.int32()), ("ids", pa.list_(pa.string()))])
_POSTINGS_TABLE = T.StructType([*_PACKED.fields[:-1], T.StructField("segment", T.StringType()), T.StructField("term_bucket", T.IntegerType())])
_BLOCKS_TABLE = T.StructType([T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(T.StringType())),
                              T.StructField("lengths", _INTS), T.StructField("segment", T.StringType())])


def _packer(segment: int, block_chunks: int):
    """Blocks of chunk rows -> one row per (term, block), and the block's own
    (its term is null, its lengths are in lens)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = segment << SEGMENT_SHIFT | TaskContext.get().partitionId() << TASK_SHIFT
        for batch in batches:
            for at in range(0, batch.num_rows, block_chunks):
                part = batch.slice(at, block_chunks)
                # Places follow the order of ids, which is also the order of ties.
                part = part.take(pa.compute.sort_indices(part.column("chunk_id")))
                lengths = part.column("dl").to_numpy(zero_copy_only=False).astype(np.int32)
                n_terms = np.asarray(pa.compute.list_value_length(part.column("terms")).fill_null(0))
                words = pa.compute.list_flatten(part.column("terms")).dictionary_encode()
                codes = words.indices.to_numpy(zero_copy_only=False)
                order = np.argsort(codes, kind="stable")
                places = np.repeat(np.arange(part.num_rows, dtype=np.int32), n_terms)[order]
                tfs = pa.compute.list_flatten(part.column("tfs")).to_numpy(zero_copy_only=False).astype(np.int32)[order]
                lens = lengths[places]
                sizes = np.bincount(codes, minlength=len(words.dictionary)) if len(codes) else np.zeros(0, np.int64)
                starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                offsets, n = pa.array(starts), len(sizes)
                yield pa.RecordBatch.from_arrays([
                    words.dictionary.cast(pa.string()), pa.array(np.full(n, block)),
                    *[pa.ListArray.from_arrays(offsets, pa.array(v)) for v in (places, tfs, lens)], pa.array(sizes.astype(np.int32)),
                    pa.array(np.maximum.reduceat(tfs, starts[:-1]) if n else tfs), pa.array(np.minimum.reduceat(lens, starts[:-1]) if n else lens),
                    pa.nulls(n, pa.list_(pa.string()))], schema=_PACKED_ARROW)
                yield pa.RecordBatch.from_pylist([{"block": block, "lens": lengths, "ids": part.column("chunk_id").to_pylist()}],
                                                 schema=_PACKED_ARROW)
                block += 1
            release_free_memory()

    return pack


def _idf_columns(terms: DataFrame, n_chunks: int, mean_idf: float | None, epsilon: float) -> DataFrame:
    raw = terms.withColumn("raw_idf", F.log(F.lit(n_chunks) - F.col("df") + 0.5) - F.log(F.col("df") + 0.5))
    return raw.withColumn("idf", F.when(F.col("raw_idf") < 0, F.lit(epsilon) * F.lit(mean_idf).cast("double"))
                          .otherwise(F.col("raw_idf")))


def _masks(dead: DataFrame) -> DataFrame:
    """(block, mask): a byte per place of the block up to its last dead place, 1
    where it is dead, so that looking a place up takes the same time however many are dead."""

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks = []
            for places in batch.column("dead").to_pylist():
                marks = np.zeros(max(places, default=-1) + 1, np.uint8)
                marks[places] = 1
                masks.append(marks.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("block"), pa.array(masks, pa.binary())], names=["block", "mask"])

    return dead.select("block", "dead").mapInArrow(mask, "block bigint, mask binary")


def _is_dead(place: Column) -> Column:
    """Whether ``place`` is dead by the column ``mask``; false beyond its end."""
    return F.substring(F.col("mask"), place.cast("int") + 1, 1) == F.lit(b"\x01")


def _write_segment(rows: DataFrame, path: str, number: int, term_buckets: int, block_chunks: int) -> dict[str, Any]:
    """Write ``rows`` (chunk_id, dl, terms, tfs) as a new segment; its entry."""
    name = f"{number}-{uuid.uuid4().hex[:8]}"
    staged = scratch_path(rows.sparkSession, "bm25-packed")
    # Written once, as two tables are made of it.
    rows.mapInArrow(_packer(number, block_chunks), _PACKED).write.parquet(staged)
    packed = rows.sparkSession.read.schema(_PACKED).parquet(staged)
    # Files follow the size of the data: AQE splits large buckets and joins small ones.
    packed.filter("term is not null").drop("ids").withColumn("term_bucket", term_bucket(F.col("term"), term_buckets)) \
        .hint("rebalance", "term_bucket").write.partitionBy("term_bucket").parquet(f"{path}/postings/segment={name}")
    # Sorted by block in small row groups, so that a few blocks are read alone.
    blocks = packed.filter("ids is not null").select("block", "ids", F.col("lens").alias("lengths"))
    blocks.sortWithinPartitions("block").write.option("parquet.block.size", 4 << 20).parquet(f"{path}/blocks/segment={name}")
    remove_path(rows.sparkSession, staged)
    return {"name": name, "number": number}


def _reject_repeated_ids(blocks: DataFrame) -> None:
    """A repeated chunk id is an error. Hashes are counted; only the ids of
    repeated hashes are compared."""
    ids = blocks.select(F.explode("ids").alias("chunk_id"))
    twice = ids.groupBy(F.xxhash64("chunk_id").alias("h")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h")
    if twice.isEmpty():
        return
    same = ids.withColumn("h", F.xxhash64("chunk_id")).join(twice, "h", "left_semi").groupBy("chunk_id").count().filter("count > 1").first()
    if same is not None:
        raise ValueError(f"duplicate chunk_id: {same['chunk_id']}")


def _live_totals(index: BM25Index) -> tuple[int, int, int]:
    """(chunks, tokens) over the live places, and the number of blocks."""
    blocks = index.blocks.select("block", "lengths")
    if index.tombstones is not None:
        blocks = blocks.join(_masks(index.tombstones), "block", "left").select(F.when(F.col("mask").isNull(), F.col("lengths")).otherwise(
            F.filter("lengths", lambda _, k: ~_is_dead(k))).alias("lengths"))
    row = blocks.agg(F.coalesce(F.sum(F.size("lengths")), F.lit(0)).alias("n"), F.coalesce(
        F.sum(F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, x: a + x)), F.lit(0)).alias("total"),
        F.count(F.lit(1)).alias("blocks")).first()
    return int(row["n"]), int(row["total"]), int(row["blocks"])


def _publish(index: BM25Index, frequencies: DataFrame, after: int) -> BM25Index:
    """Write the terms of the new version and its statistics, and publish it."""
    terms = f"terms/{uuid.uuid4().hex}"
    frequencies.hint("rebalance", "term_bucket").write.partitionBy("term_bucket").parquet(f"{index.path}/{terms}")
    n_chunks, total, n_blocks = _live_totals(index)
    index.content |= {"terms": terms, "n_chunks": n_chunks, "total_tokens": total, "n_blocks": n_blocks}
    raw = _idf_columns(index.document_frequencies, n_chunks, None, index.epsilon)
    facts = raw.agg(F.avg("raw_idf").alias("mean_idf"), F.count(F.lit(1)).alias("vocabulary")).first()
    index.content |= {"vocabulary": facts["vocabulary"], "mean_idf": facts["mean_idf"]}
    index.version = snapshots.publish(index.spark, index.path, index.content, after)
    return index


def build_bm25_index(chunks: DataFrame, *, text_col: str = "text", k1: float = K1, b: float = B,
                     epsilon: float = EPSILON, path: str | None = None, term_buckets: int = DEFAULT_TERM_BUCKETS,
                     block_chunks: int = BLOCK_CHUNKS, validate: bool = False) -> BM25Index:
    """an index of one segment under ``path`` (default: the shared scratch
    folder); the version that follows whatever was published there before.

    N counts every chunk, including those without tokens. raw idf below zero
    is replaced by ``epsilon`` times the mean raw idf over the whole
    vocabulary. A chunk id must be unique; a repeated one is an error.

    ``term_buckets`` should grow with the vocabulary: a search for t terms
    reads at most t of them. Statistics are aggregated from the written
    tables, so a task that runs twice counts once.
    """
    if validate:
        require_rows(chunks, "chunk_records cannot be empty")
    spark = chunks.sparkSession
    base = path or scratch_path(spark, "bm25")
    last = snapshots.read_version(spark, base)
    number = max((s["number"] for s in last[1]["segments"]), default=-1) + 1 if last else 0
    segment = _write_segment(chunk_term_rows(chunks, text_col), base, number, term_buckets, block_chunks)
    index = BM25Index(spark, base, 0, {"segments": [segment], "tombstones": None, "term_buckets": term_buckets,
                                       "block_chunks": block_chunks}, k1, b, epsilon)
    _reject_repeated_ids(index.blocks)
    counts = index.postings.groupBy("term_bucket", "term").agg(F.sum("n").cast("bigint").alias("df"))
    return _publish(index, counts, last[0] if last else 0)


def load_bm25_index(spark: SparkSession, path: str, *, version: int | None = None, k1: float = K1, b: float = B,
                    epsilon: float = EPSILON) -> BM25Index:
    """Reopen an index (default: its last version)."""
    found = snapshots.read_version(spark, path, version)
    if found is None:
        raise FileNotFoundError(f"BM25 index not found: {path}")
    return BM25Index(spark, path, found[0], found[1], k1, b, epsilon)


def _by_block(places: DataFrame) -> DataFrame:
    """(block, place) -> (block, dead): at most a block's places in a row."""
    return places.groupBy("block").agg(F.array_sort(F.collect_set("place")).alias("dead"))


def update_bm25_index(index: BM25Index, chunks: DataFrame, *, removed: DataFrame | None = None,
                      text_col: str = "text") -> BM25Index:
    """The index's next version: ``chunks`` (chunk_id, text) added, replacing the
    chunks of the same ids, and the chunks of ``removed`` (chunk_id) withdrawn.

    Only a segment for ``chunks``, the tombstones and the term table are
    written. Ids that are not in the index are no error among ``removed``; a
    repeated id in ``chunks`` is one."""
    spark, old = index.spark, index.content
    number = max((s["number"] for s in old["segments"]), default=-1) + 1
    segment = _write_segment(chunk_term_rows(chunks, text_col), index.path, number, index.term_buckets, old["block_chunks"])
    new = BM25Index(spark, index.path, 0, old | {"segments": [*old["segments"], segment]}, index.k1, index.b, index.epsilon)
    _reject_repeated_ids(new._segments("blocks", _BLOCKS_TABLE, [segment["name"]]))

    gone = chunks.select("chunk_id") if removed is None else chunks.select("chunk_id").union(removed.select("chunk_id"))
    gone, _ = broadcast_if_bounded(_written(gone.distinct(), "bm25-gone"))
    places = index.blocks.select("block", F.posexplode("ids").alias("place", "chunk_id")).join(gone, "chunk_id", "left_semi")
    before = index.tombstones
    if before is not None:
        places = places.join(before.select("block", F.explode("dead").alias("place")), ["block", "place"], "left_anti")
    dead = _written(_by_block(places.select("block", "place")), "bm25-dead")
    added = new._segments("postings", _POSTINGS_TABLE, [segment["name"]]).select("term_bucket", "term", F.col("n").cast("bigint").alias("df"))
    side, _ = broadcast_if_bounded(_written(_masks(dead), "bm25-masks"))
    lost = index.postings.select("term_bucket", "term", "block", "places").join(side, "block") \
        .select("term_bucket", "term", (-F.size(F.filter("places", _is_dead))).cast("bigint").alias("df")).filter("df < 0")
    counts = index.document_frequencies.select("term_bucket", "term", "df").union(added).union(lost) \
        .groupBy("term_bucket", "term").agg(F.sum("df").alias("df")).filter("df > 0")
    all_dead = dead if before is None else _by_block(before.union(dead).select("block", F.explode("dead").alias("place")))
    new.content["tombstones"] = _write_tombstones(index.path, all_dead)
    return _publish(new, counts, index.version)


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _write_tombstones(path: str, dead: DataFrame) -> str:
    name = f"tombstones/{uuid.uuid4().hex}"
    dead.write.parquet(f"{path}/{name}")
    return name


def compact_bm25_index(index: BM25Index, segments: list[str] | None = None) -> BM25Index:
    """The index's next version with ``segments`` (names; default: all) rewritten
    as one, without their dead places. Results do not change."""
    entries = index.content["segments"]
    names = [s["name"] for s in entries] if segments is None else segments
    stay = [s for s in entries if s["name"] not in names]
    number = max(s["number"] for s in entries) + 1
    ids = index._segments("blocks", _BLOCKS_TABLE, names).select(
        "block", F.explode(F.expr("transform(ids, (x, k) -> struct(k as place, x as chunk_id, lengths[k] as dl))")).alias("c")).select("block", "c.*")
    tombs = index.tombstones
    if tombs is not None:
        ids = ids.join(tombs.select("block", F.explode("dead").alias("place")), ["block", "place"], "left_anti")
    each = index._segments("postings", _POSTINGS_TABLE, names).select(
        "term", "block", F.explode(F.arrays_zip("places", "tfs")).alias("p")).select("term", "block", F.col("p.places").alias("place"), "p.tfs")
    # A chunk's terms are a row again, as when it was tokenised.
    rows = ids.join(each, ["block", "place"], "left").groupBy("chunk_id", "dl") \
        .agg(F.sort_array(F.collect_list(F.when(F.col("term").isNotNull(), F.struct("term", "tfs")))).alias("t")) \
        .select("chunk_id", "dl", F.col("t.term").alias("terms"), F.col("t.tfs").alias("tfs"))
    segment = _write_segment(rows, index.path, number, index.term_buckets, index.content["block_chunks"])
    new = BM25Index(index.spark, index.path, 0, index.content | {"segments": [*stay, segment], "tombstones": None},
                    index.k1, index.b, index.epsilon)
    if tombs is not None and stay:
        kept = tombs.filter(F.shiftright("block", SEGMENT_SHIFT).isin([s["number"] for s in stay]))
        new.content["tombstones"] = _write_tombstones(index.path, kept)
    return _publish(new, index.document_frequencies.select("term", "df", "term_bucket"), index.version)


def term_chunks(index: BM25Index) -> DataFrame:
    """(term, chunk_id): the postings one by one."""
    rows = index.postings.select("term", "block", F.explode("places").alias("place"))
    if index.tombstones is not None:
        rows = rows.join(index.tombstones.select("block", F.explode("dead").alias("place")), ["block", "place"], "left_anti")
    return rows.join(index.blocks.select("block", "ids"), "block").select("term", F.get("ids", F.col("place")).alias("chunk_id"))


def query_terms(queries: DataFrame, query_id: str = "query_id", query_col: str = "query") -> DataFrame:
    """(query_id, term, qf): repeated query tokens count repeatedly."""
    return (
        queries.select(F.col(query_id).alias("query_id"), F.explode(tokenize(query_col)).alias("term"))
        .groupBy("query_id", "term")
        .agg(F.count(F.lit(1)).alias("qf"))
    )


def _query_blocks(index: BM25Index, queries: DataFrame, query_id: str, query_col: str) -> Iterator[list]:
    """Bounded lists of (query_id, [(term, weight, bucket)]) with weight = qf * idf."""
    weighted = query_terms(queries, query_id, query_col) \
        .withColumn("term_bucket", term_bucket(F.col("term"), index.term_buckets)) \
        .join(index.terms.select("term_bucket", "term", "idf"), ["term_bucket", "term"]) \
        .groupBy("query_id").agg(F.collect_list(F.struct(
            "term", (F.col("qf") * F.col("idf")).alias("weight"), "term_bucket")).alias("terms"))
    block, size = [], 0
    for row in weighted.toLocalIterator():
        block.append((row["query_id"], [tuple(t) for t in row["terms"]]))
        size += len(row["terms"])
        if size >= MAX_QUERY_TERMS:
            yield block
            block, size = [], 0
    if block:
        yield block


def _scorer(shared, k1: float, b: float, avgdl: float, reduce, names: list[str], pruned: bool):
    """The function that scores one block's postings for a block of queries.
    Its second table names, if ``pruned``, the queries that ask for the block,
    and the block's dead places."""

    def score(postings: pd.DataFrame, control: pd.DataFrame) -> pd.DataFrame:
        out: list[list] = [[] for _ in names]
        wanted = None
        dead = np.zeros(0, np.int64)
        for asked, gone in zip(control["asked"], control["dead"], strict=True):
            if asked is not None:
                wanted = np.asarray(asked, np.int64)
            if gone is not None:
                dead = np.asarray(gone, np.int64)
        parts, by_query, size = [], defaultdict(list), 0
        for term, places, tfs, lens in zip(postings["term"], postings["places"], postings["tfs"], postings["lens"], strict=True):
            if pruned and wanted is None:
                break
            query, weight = shared.value[term]
            if wanted is not None:
                asks = np.isin(query, wanted)
                query, weight = query[asks], weight[asks]
            if not len(query):
                continue
            places, tf, dl = np.asarray(places, np.int64), np.asarray(tfs, np.float64), np.asarray(lens, np.float64)
            size = max(size, int(places[-1]) + 1)
            for q, w in zip(query.tolist(), weight.tolist(), strict=True):
                by_query[q].append((len(parts), w))
            parts.append((places, tf * (k1 + 1.0) / (tf + k1 * (1.0 - b + b * dl / avgdl))))
        block = int(postings["block"].iloc[0]) if len(postings) else 0
        for q, terms in by_query.items():
            scores, overlap = np.zeros(size), np.zeros(size, np.int64)
            for k, w in terms:
                places, part = parts[k]
                scores[places] += w * part
                overlap[places] += 1
            overlap[dead[dead < size]] = 0
            match = np.flatnonzero(overlap)
            if len(match):
                columns = reduce(scores[match], overlap[match], match)
                out[0] += [q] * len(columns[0])
                out[1] += [block] * len(columns[0])
                for k, c in enumerate(columns):
                    out[k + 2] += list(c)
        return pd.DataFrame({n: pd.Series(c, dtype=None if c else object) for n, c in zip(names, out, strict=True)})

    return score


class _QueryBlock:
    """A bounded list of queries on its way through the index."""

    def __init__(self, index: BM25Index, queries: list) -> None:
        self.index, self.spark = index, index.spark
        self.ids = [q for q, _ in queries]
        triples = [(t, q, w, bucket) for q, (_, terms) in enumerate(queries) for t, w, bucket in terms]
        self.buckets = sorted({x[3] for x in triples})
        by_term: dict[str, tuple[list, list]] = {}
        for t, q, w, _ in triples:
            found = by_term.setdefault(t, ([], []))
            found[0].append(q)
            found[1].append(w)
        self.shared = self.spark.sparkContext.broadcast({t: (np.asarray(q, np.int64), np.asarray(w)) for t, (q, w) in by_term.items()})
        # At most MAX_QUERY_TERMS rows, and one query's terms.
        self.weights = F.broadcast(self.spark.createDataFrame(pd.DataFrame(
            {"term": [x[0] for x in triples], "q": [x[1] for x in triples], "weight": [x[2] for x in triples]})))
        self.rows = index.postings.filter(F.col("term_bucket").isin(self.buckets))

    def bounds(self, top_k: int) -> DataFrame:
        """(q, block, bound, seed): the highest score that a chunk of the block can
        have, and whether the block is one of the best that together hold k matches."""
        k1, b, avgdl = self.index.k1, self.index.b, self.index.avgdl
        part = F.col("max_tf") * (k1 + 1.0) / (F.col("max_tf") + k1 * (1.0 - b + b * F.col("min_len") / avgdl))
        found = self.rows.select("term", "block", "n", "max_tf", "min_len").join(self.weights, "term") \
            .groupBy("q", "block").agg(F.sum(F.greatest(F.lit(0.0), F.col("weight") * part)).alias("bound"), F.max("n").alias("n"))
        best = Window.partitionBy("q").orderBy(F.col("bound").desc(), "block").rowsBetween(Window.unboundedPreceding, -1)
        return found.select("q", "block", "bound", (F.coalesce(F.sum("n").over(best), F.lit(0)) < top_k).alias("seed"))

    def score(self, reduce, fields: list[T.StructField], pairs: DataFrame | None = None) -> DataFrame:
        """``reduce(scores, overlap, places)`` of the matches of each query and
        block, for all of them or for ``pairs`` (q, block): q, block and ``fields``."""
        schema = T.StructType([T.StructField("q", T.LongType()), T.StructField("block", T.LongType()), *fields])
        rows = self.rows.join(self.weights.select("term").distinct(), "term", "left_semi").select("block", "term", "places", "tfs", "lens")
        none = F.lit(None).cast("array<int>")
        control = self.spark.createDataFrame([], "block bigint, asked array<bigint>, dead array<int>")
        if pairs is not None:
            asked = pairs.groupBy("block").agg(F.collect_list("q").alias("asked"))  # at most the block of queries
            here, _ = broadcast_if_bounded(pairs.select("block").distinct(), upper_bound=self.index.content["n_blocks"])
            rows = rows.join(here, "block", "left_semi")
            control = asked.select("block", "asked", none.alias("dead"))
        if self.index.tombstones is not None:
            control = control.unionByName(self.index.tombstones.select("block", F.lit(None).cast("array<bigint>").alias("asked"), "dead"))
        fn = _scorer(self.shared, self.index.k1, self.index.b, self.index.avgdl, reduce, schema.names, pairs is not None)
        return rows.groupBy("block").cogroup(control.groupBy("block")).applyInPandas(fn, schema)

    def named(self, rows: DataFrame, kind: T.DataType) -> DataFrame:
        """``rows`` with query_id in place of q."""
        names = self.spark.createDataFrame(list(enumerate(self.ids)), T.StructType([T.StructField("q", T.LongType()), T.StructField("query_id", kind)]))
        return rows.join(F.broadcast(names), "q").drop("q")


_PLACES = [T.StructField("place", T.LongType()), T.StructField("score", T.DoubleType()), T.StructField("overlap", T.LongType())]


def _best_places(top_k: int):
    def best(scores: np.ndarray, overlap: np.ndarray, places: np.ndarray) -> list[np.ndarray]:
        if len(scores) > top_k:
            rounded = np.round(scores, SCORE_RANK_DIGITS)
            floor = np.partition(rounded, len(rounded) - top_k)[len(rounded) - top_k]
            near = np.flatnonzero(rounded >= floor - 2 * 10.0 ** -SCORE_RANK_DIGITS)
            # Places follow the order of ids: a stable sort breaks ties by id.
            order = near[np.lexsort((-overlap[near], -rounded[near]))][:top_k]
            scores, overlap, places = scores[order], overlap[order], places[order]
        return [places, scores, overlap]

    return best


def _pruned(block: _QueryBlock, top_k: int) -> tuple[DataFrame, DataFrame]:
    """(q, block, place, score, overlap) that hold the top k of each query, and
    (q, block, bound, seed, scored) for the blocks that hold any of its terms."""
    bounds = _written(block.bounds(top_k), "bm25-bounds")
    first = _written(block.score(_best_places(top_k), _PLACES, bounds.filter("seed")), "bm25-seeds")
    order = Window.partitionBy("q").orderBy(F.col("score").desc())
    floor = first.withColumn("r", F.row_number().over(order)).filter(F.col("r") == top_k).select("q", F.col("score").alias("floor"))
    decided = bounds.join(floor, "q", "left").select("q", "block", "bound", "seed", (
        F.col("seed") | F.col("floor").isNull() | (F.col("bound") >= F.col("floor") - BOUND_SLACK)).alias("scored"))
    more = block.score(_best_places(top_k), _PLACES, decided.filter("scored and not seed"))
    # Ties stay for now: they are broken by chunk id.
    best = Window.partitionBy("q").orderBy(F.round("score", SCORE_RANK_DIGITS).desc(), F.col("overlap").desc())
    found = first.union(more).withColumn("r", F.rank().over(best)).filter(F.col("r") <= top_k).drop("r")
    return found, decided


def _with_ids(index: BM25Index, found: DataFrame) -> DataFrame:
    """``found`` (a written table with block, place) with chunk_id in their place.
    Few blocks are asked for by number, so that only their ids are read."""
    blocks = found.select("block").distinct().limit(MAX_BLOCKS_BY_NAME + 1).collect()
    ids = index.blocks.select("block", "ids")
    if len(blocks) <= MAX_BLOCKS_BY_NAME:
        ids = ids.filter(F.col("block").isin([r["block"] for r in blocks]))
    side, _ = broadcast_if_bounded(found)
    return ids.join(side, "block").withColumn("chunk_id", F.get("ids", F.col("place").cast("int"))).drop("block", "place", "ids")


def _for_each_block(index: BM25Index, queries: DataFrame, query_id: str, query_col: str, fn, empty: str) -> DataFrame:
    """The union of ``fn``'s rows over blocks of queries, with their query_id.
    All but a single block's rows are written before the next block is begun."""
    kind = queries.schema[query_id].dataType
    parts: list[DataFrame] = []
    blocks = _query_blocks(index, queries, query_id, query_col)
    block = next(blocks, None)
    while block is not None:
        after = next(blocks, None)
        now = _QueryBlock(index, block)
        rows = now.named(fn(now), kind)
        if after is not None or parts:
            rows = _written(rows, "bm25-part")
            now.shared.destroy()
        parts.append(rows)
        block = after
    if not parts:
        return index.spark.createDataFrame([], empty).select(F.lit(None).cast(kind).alias("query_id"), "*")
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    return found


def bm25_matches(index: BM25Index, queries: DataFrame, *, query_id: str = "query_id", query_col: str = "query",
                 top_k: int | None = None) -> DataFrame:
    """(query_id, chunk_id, score, overlap) for every chunk sharing at
    least one distinct token with the query, whatever the sign of its score;
    with ``top_k`` only chunks that can be among the best so many, all of these included."""

    def find(block: _QueryBlock) -> DataFrame:
        if top_k is None:
            rows = block.score(lambda s, o, p: [p, s, o], _PLACES)
            return rows.join(index.blocks.select("block", "ids"), "block") \
                .select("q", F.get("ids", F.col("place").cast("int")).alias("chunk_id"), "score", "overlap")
        return _with_ids(index, _written(_pruned(block, top_k)[0], "bm25-found"))

    return _for_each_block(index, queries, query_id, query_col, find, "chunk_id string, score double, overlap bigint") \
        .select("query_id", "chunk_id", "score", "overlap")


def search_blocks(index: BM25Index, queries: DataFrame, top_k: int, *, query_id: str = "query_id",
                  query_col: str = "query") -> DataFrame:
    """(query_id, block, bound, seed, scored): what a top-k search does with each
    block that holds a term of the query; blocks with ``scored`` false are skipped."""
    return _for_each_block(index, queries, query_id, query_col, lambda block: _pruned(block, top_k)[1],
                           "block bigint, bound double, seed boolean, scored boolean")


def match_summary(index: BM25Index, queries: DataFrame, *, query_id: str = "query_id",
                  query_col: str = "query") -> DataFrame:
    """D2 per query: how many chunks match, their lowest and highest score, and
    the most distinct query terms one of them holds: one row per query and
    block leaves a task."""
    fields = [T.StructField("n", T.LongType()), T.StructField("low", T.DoubleType()),
              T.StructField("high", T.DoubleType()), T.StructField("most", T.LongType())]
    rows = _for_each_block(index, queries, query_id, query_col,
                           lambda block: block.score(lambda s, o, p: [[len(s)], [s.min()], [s.max()], [o.max()]], fields),
                           "n bigint, low double, high double, most bigint")
    return rows.groupBy("query_id").agg(F.sum("n").alias("matches"), F.min("low").alias("lowest"),
                                        F.max("high").alias("highest"), F.max("most").alias("most_overlap"))


def rank_matches(matches: DataFrame, top_k: int) -> DataFrame:
    """order by (score desc, overlap desc), ties in corpus (chunk_id) order.

    ``row_number() <= k`` is planned as a partial WindowGroupLimit before the
    shuffle, so each task sends at most k rows per query even when one query
    matches a third of the corpus.
    """
    w = Window.partitionBy("query_id").orderBy(
        F.round("score", SCORE_RANK_DIGITS).desc(), F.col("overlap").desc(), F.col("chunk_id")
    )
    return matches.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top_k)


def attach_chunks(ranked: DataFrame, chunks: DataFrame | RecordTable, columns: list[str],
                  max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS, *,
                  upper_bound: int | None = None) -> DataFrame:
    """Late materialisation (C9): fetch chunk columns only for the top rows.

    The ranked side is at most |queries| x k rows (``upper_bound``); broadcast
    it when that is small so the chunk table is scanned once, never shuffled.
    Of a sink (``sources.sinks``) only the buckets of the wanted ids are read.
    """
    keys = ["chunk_id"]
    if isinstance(chunks, RecordTable):
        keys = ["bucket", "chunk_id"]
        ranked = chunks.with_bucket(ranked, "chunk_id")
        chunks = chunks.rows(with_bucket=True)
    side, _ = broadcast_if_bounded(ranked, max_broadcast_rows, upper_bound=upper_bound)
    return chunks.select(*keys, *columns).join(side, keys).drop("bucket")


def bm25_search(chunks: DataFrame | RecordTable, queries: DataFrame, top_k: int = 5, *,
                index: BM25Index | None = None, query_id: str = "query_id", query_col: str = "query",
                columns: tuple[str, ...] = ("document_id", "title", "text", "metadata"),
                max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """top-k chunks per query.

    Returns (query_id, rank, chunk_id, score, overlap, *columns). A query
    without tokens has no rows.
    """
    require_positive(top_k, "top_k")
    if index is None:
        index = build_bm25_index(chunks.rows() if isinstance(chunks, RecordTable) else chunks)
    matches = bm25_matches(index, queries, query_id=query_id, query_col=query_col, top_k=top_k)
    ranked = rank_matches(matches, top_k)
    if not columns:
        return ranked.select("query_id", "rank", "chunk_id", "score", "overlap")
    n_queries = bounded_count(queries, max_broadcast_rows)
    out = attach_chunks(ranked, chunks, list(columns), max_broadcast_rows, upper_bound=n_queries * top_k)
    return out.select("query_id", "rank", "chunk_id", "score", "overlap", *columns)
