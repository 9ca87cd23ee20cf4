"""SimHash fingerprints, linked within a Hamming radius by covering hashing.

Fingerprints: each bit is set if it is set in over half the hashes of a
text's shingles. A text's shingles are counted in blocks within its task.

Links: every bit position gets a non-zero code of radius + 1 bits, and every
non-zero vector of as many bits gives a mask, which keeps the positions whose
code has an odd inner product with it. For any ``radius`` positions some
vector is orthogonal to all their codes, so two fingerprints that differ in at
most ``radius`` bits agree under some mask: no pair is missed.

Equal fingerprints are one node, so copies cost nothing beyond one
aggregation. Masked values shared by at most ``PAIR_LIMIT`` different
fingerprints are compared in pairs; for larger buckets, whose pairs would grow
with the square, an exact way of linear size takes over: each member names
all values that differ from it in up to radius / 2 of the positions that the
mask leaves out (half the radius, rounded up, for one side and down for the
other), and members that name the same value are within the radius.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkretrieve.llm.common import connected_components, free_name, map_batches, materialise

BITS = 64
SEED = 42
PAIR_LIMIT = 24
BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The unsigned 64-bit fingerprint of a text: A-Z lower-cased, words
    separated by [\\x20\\x09-\\x0D], shingles of ``shingle`` words with repeats
    (fewer words: the whole sequence; none: 0)."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, BLOCK):
        stop = min(n, at + BLOCK)
        part = words[at:stop + shingle - 1]
        if stop - at == 1:
            joined = [b" ".join(part)]
        else:
            joined = map(b" ".join, zip(*(part[k:] for k in range(shingle)), strict=False))
        hashes = np.fromiter((digest(s, SEED) for s in joined), np.dtype("<u8"), stop - at)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, keys: list[str], text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(keys, fp long): the fingerprint's 64 bits as a signed long, one row per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            values = [fingerprint(t, shingle) for t in batch.column(len(keys)).to_pylist()]
            yield {k: batch.column(i) for i, k in enumerate(keys)} | {
                "fp": pa.array(np.asarray(values, np.uint64).view(np.int64))}

    fields = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys)
    return map_batches(docs.select(*keys, text_col), f"{fields}, fp long", run)


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >= 1 << (BITS - 1) else x


def covering_masks(radius: int) -> list[int]:
    """One mask per non-zero vector of radius + 1 bits; codes are dealt round
    robin, so that the masks keep nearly equal numbers of positions."""
    codes = [1 + i % ((1 << radius + 1) - 1) for i in range(BITS)]
    return [sum(1 << i for i in range(BITS) if (codes[i] & v).bit_count() % 2)
            for v in range(1, 1 << radius + 1)]


def links(nodes: DataFrame, radius: int = 2) -> DataFrame:
    """(a, b) long: links between different fingerprints ``fp`` of ``nodes``
    that connect exactly what pairs within ``radius`` bits connect. Pairs in
    large buckets are linked through their smallest common neighbour."""
    masks = covering_masks(radius)
    table = F.array(*[F.lit(_signed(m)) for m in masks])
    keyed = nodes.select("fp", F.posexplode(table).alias("mask", "bits")) \
        .select("fp", "mask", F.col("fp").bitwiseAND(F.col("bits")).alias("key"))
    sizes = keyed.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = materialise(keyed.join(sizes, ["mask", "key"]), "buckets")

    # Small buckets: pairs within a list of at most PAIR_LIMIT members.
    lists = shared.filter(F.col("n") <= PAIR_LIMIT).groupBy("mask", "key") \
        .agg(F.array_sort(F.collect_list("fp")).alias("members"))
    pairs = lists.select("members", F.posexplode("members").alias("i", "a")) \
        .select("a", F.explode(F.slice("members", F.col("i") + 2, PAIR_LIMIT)).alias("b")) \
        .filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius).distinct()

    # Large buckets: values near a member, in the positions left out by the mask.
    large = shared.filter(F.col("n") > PAIR_LIMIT)
    near, far = radius // 2, radius - radius // 2

    def flips(m: int, size: int) -> list[int]:
        free = [i for i in range(BITS) if not m >> i & 1]
        return [_signed(sum(1 << i for i in c)) for k in range(size + 1) for c in combinations(free, k)]

    def named(size: int) -> DataFrame:
        by_mask = F.array(*[F.array(*[F.lit(x) for x in flips(m, size)]) for m in masks])
        return large.select("fp", "mask", "key", F.explode(F.get(by_mask, "mask")).alias("flip")) \
            .select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("hub"), "mask", "key")

    if near == far:
        # Members around one value are at most radius apart: star around the smallest.
        hubs = named(near).groupBy("mask", "key", "hub").agg(F.array_sort(F.collect_set("fp")).alias("members")) \
            .filter(F.size("members") > 1)
        stars = hubs.select(F.get("members", F.lit(0)).alias("a"),
                            F.explode(F.slice("members", 2, 1 << 20)).alias("b"))
    else:
        one, two = named(near), named(far)
        stars = one.alias("x").join(two.alias("y"), ["mask", "key", "hub"]) \
            .select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b")).filter("a < b")
    return pairs.union(stars.distinct())


def _roots(prints: DataFrame, id_col: str, radius: int) -> DataFrame:
    """(fp, root, least): the smallest fingerprint of each fingerprint's
    component, and the smallest identifier that has the fingerprint."""
    nodes = materialise(prints.groupBy("fp").agg(F.min(id_col).alias("least")), "nodes")
    found = connected_components(links(nodes, radius).select("a", "b"))
    return nodes.join(found.select(F.col("node").alias("fp"), "component"), "fp", "left") \
        .select("fp", F.coalesce("component", "fp").alias("root"), "least")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row per row of ``docs``: id, fingerprint (16 lowercase hex digits)
    and component_id, the smallest identifier reachable over links between
    fingerprints at most ``radius`` bits apart.

    Null, empty and blank texts have the fingerprint zero and are linked like
    any other. Rows with a null identifier take part, but the smallest
    identifier is null only where all are. Repeated rows share a component.
    Other columns are not read. An empty table gives an empty result.
    """
    prints = materialise(fingerprints(docs, [id_col], text_col, shingle), "fingerprints")
    roots = _roots(prints, id_col, radius)
    least = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = roots.join(least, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select(
        id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = 3, radius: int = 2) -> DataFrame:
    """The rows of ``docs`` that stay if of each group of near-duplicates only
    the row with the smallest identifier does (null identifiers last; among
    rows of one identifier, one text is chosen by its hash, and of repeated
    rows one stays). Groups and odd values as in ``near_duplicates``; all
    columns are kept."""
    content = free_name(docs, "_content")
    marked = docs.withColumn(content, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    prints = materialise(fingerprints(marked, [id_col, content], text_col, shingle), "fingerprints")
    roots = _roots(prints, id_col, radius)
    first = F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col(content).alias("c")))
    # One row per fingerprint first, so that a group of copies costs one row a task.
    heads = prints.groupBy("fp").agg(first.alias("head")).join(roots, "fp") \
        .groupBy("root").agg(F.min("head").alias("head")).select("head.id", "head.c")
    kept = marked.join(heads, marked[id_col].eqNullSafe(heads["id"]) & (marked[content] == heads["c"]), "left_semi")
    return kept.dropDuplicates([id_col, content]).select(*docs.columns)
