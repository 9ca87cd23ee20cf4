"""Lines that repeat across documents, by two Bloom filters.

1. Every task hashes the keys of its documents' lines (each key once per
   document) into a filter of *once-seen* and a filter of *twice-seen* hashes.
   Filters of tasks merge block by block: a bit is set in the merged
   twice-seen filter if it is set in either, or once in both.
2. Only keys that the twice-seen filter knows are suspects; only they are
   shuffled, as text, and counted exactly. A filter has false positives, which
   the exact count removes, but no false negatives, so no repeat is lost.
3. For each confirmed key the document that keeps it is chosen, and each
   document gets the digests of the keys it loses.

A key that very many documents hold is joined by broadcast of its digest; the
number of such keys is bounded by the number of partitions.

The filters grow with the number of lines up to ``MAX_BITS`` (64 MB), the
proven bound of what is broadcast. Beyond about 5e7 distinct lines per filter
the filters fill up: more lines become suspects and are shuffled, and the
results stay the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkretrieve.llm.common import SPACES, free_name, map_batches, materialise

MIN_BITS, MAX_BITS = 1 << 20, 1 << 29
BITS_PER_LINE = 16
PROBES = 4
BLOCK_BYTES = 1 << 16
HOT_KEYS = 8  # per shuffle partition


def line_key(line: str) -> bytes:
    """The line without white space ([\\x20\\x09-\\x0D]) at its ends, A-Z lower-cased."""
    return line.strip(SPACES).encode("utf-8").lower()


def long_keys(text: str | None, min_chars: int) -> set[bytes]:
    """The distinct keys of at least ``min_chars`` code points in a text."""
    return {line.encode("utf-8").lower() for line in (x.strip(SPACES) for x in (text or "").split("\n"))
            if len(line) >= min_chars}


def _positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """(n, PROBES) bit positions: double hashing with the halves of the hash."""
    a, b = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
    steps = np.arange(PROBES, dtype=np.uint64)
    return ((a[:, None] * np.uint64(0x9E3779B1) + b[:, None] * steps) & np.uint64(bits - 1)).astype(np.int64)


def _hashes(keys: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), dtype=np.uint64, count=len(keys))


def _known(bloom: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ((bloom[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1)


def _add(bloom: np.ndarray, at: np.ndarray) -> None:
    np.bitwise_or.at(bloom, at.ravel() >> 3, (1 << (at.ravel() & 7)).astype(np.uint8))


def twice_seen_filter(docs: DataFrame, text_col: str, min_chars: int, bits: int) -> bytes:
    """The merged twice-seen filter over all documents: ``bits / 8`` bytes."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        seen = False
        for batch in batches:
            keys = [k for text in batch.column(0).to_pylist() for k in long_keys(text, min_chars)]
            if not keys:
                continue
            seen = True
            unique, n = np.unique(_hashes(keys), return_counts=True)
            at = _positions(unique, bits)
            _add(twice, at[(n > 1) | _known(once, at)])
            _add(once, at)
        if seen:
            size = min(BLOCK_BYTES, bits // 8)
            for k in range(0, bits // 8, size):
                yield {"block": [k // size], "once": [once[k:k + size].tobytes()],
                       "twice": [twice[k:k + size].tobytes()]}

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        # Streams over its blocks' rows: two arrays per block, whatever the number of tasks.
        state: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for block, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                once, twice = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
                if block in state:
                    one, two = state[block]
                    two |= twice | (one & once)
                    one |= once
                else:
                    state[block] = once.copy(), twice.copy()
        for block, (_, two) in state.items():
            yield {"block": [block], "twice": [two.tobytes()]}

    local = map_batches(docs.select(text_col), "block int, once binary, twice binary", build)
    merged = map_batches(local.repartition("block"), "block int, twice binary", merge)
    out = bytearray(bits // 8)
    for row in merged.toLocalIterator():  # at most MAX_BITS / 8 bytes in all
        at = row["block"] * min(BLOCK_BYTES, bits // 8)
        out[at:at + len(row["twice"])] = row["twice"]
    return bytes(out)


def _filter_bits(docs: DataFrame, text_col: str) -> int:
    """A power of two of at least BITS_PER_LINE bits per line, within the bounds."""
    breaks = F.length(text_col) - F.length(F.replace(F.col(text_col), F.lit("\n"), F.lit(""))) + 1
    lines = docs.select(F.sum(breaks).alias("n")).first()["n"] or 1
    return min(MAX_BITS, max(MIN_BITS, 1 << int(lines * BITS_PER_LINE - 1).bit_length()))


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        min_chars: int = 20, min_docs: int = 3, bits: int | None = None) -> DataFrame:
    """``docs`` with the text column cut, and n_lines, n_dropped (long).

    Texts are split at \\n; null and empty texts are one empty line. A key
    (see ``line_key``) of at least ``min_chars`` code points that occurs in at
    least ``min_docs`` documents loses all its lines except in the document
    with the largest identifier that holds it; there, all its lines stay.
    Other lines stay as they are, joined by \\n. A document is an identifier:
    repeated rows with one identifier are one document, and all rows with a
    null identifier are one, smaller than any other. Columns named n_lines or
    n_dropped are replaced. An empty table stays empty.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ("n_lines", "n_dropped")])
    bits = bits or _filter_bits(docs, text_col)
    twice = docs.sparkSession.sparkContext.broadcast(twice_seen_filter(docs, text_col, min_chars, bits))

    def suspect(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        bloom = np.frombuffer(twice.value, np.uint8)
        for batch in batches:
            ids, keys = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                own = long_keys(text, min_chars)
                keys += own
                ids += [i] * len(own)
            if not keys:
                continue
            known = _known(bloom, _positions(_hashes(keys), bits))
            picked = np.flatnonzero(known)
            yield {"id": batch.column(0).take(pa.array(np.asarray(ids, np.int64)[picked])),
                   "key": [keys[k] for k in picked]}

    id_type = docs.schema[id_col].dataType.simpleString()
    suspects = map_batches(docs.select(id_col, text_col), f"id {id_type}, key binary", suspect)
    suspects = materialise(suspects, "suspects")
    # Exact: distinct documents per key, pre-aggregated before each shuffle.
    per_doc = suspects.groupBy("key", "id").agg(F.lit(1).alias("one"))
    confirmed = per_doc.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("keeper")) \
        .filter(F.col("n") >= min_docs)
    confirmed = materialise(confirmed, "confirmed")
    # Keys of very many documents are looked up where their rows are: there are
    # at most HOT_KEYS of them per partition, whatever the data, and only their
    # 128-bit digests are sent. The others meet their rows in a shuffle.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    limit = max(100, suspects.count() // (HOT_KEYS * parts))
    digest = F.unhex(F.substring(F.sha2("key", 256), 1, 32))
    hot = confirmed.filter(F.col("n") > limit).select(digest.alias("digest"), F.col("keeper").alias("hot_keeper"), F.lit(True).alias("hot"))
    marked = suspects.withColumn("digest", digest).join(F.broadcast(hot), "digest", "left")
    cold = marked.filter(F.col("hot").isNull()).select("key", "id", "digest") \
        .join(confirmed.filter(F.col("n") <= limit).select("key", "keeper"), "key")
    losers = marked.filter("hot").select("digest", "id", F.col("hot_keeper").alias("keeper")).unionByName(cold.drop("key")) \
        .filter(~F.col("id").eqNullSafe(F.col("keeper")))
    lost, drop_id = free_name(docs, "_lost"), free_name(docs, "_drop_id")
    # The digests of a document's own lines: bounded by that document.
    drops = losers.groupBy(F.col("id").alias(drop_id)) \
        .agg(F.collect_set("digest").alias(lost))
    joined = docs.join(drops, F.col(f"`{id_col}`").eqNullSafe(F.col(drop_id)), "left").drop(drop_id)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        from hashlib import sha256
        for batch in batches:
            out = {f: batch.column(f) for f in batch.schema.names if f not in (lost, text_col)}
            texts, n_lines, n_dropped = [], [], []
            for text, gone in zip(batch.column(text_col).to_pylist(), batch.column(lost).to_pylist(), strict=True):
                lines = (text or "").split("\n")
                kept = lines
                if gone:
                    gone = set(gone)
                    kept = [x for x in lines if len(x) < min_chars
                            or sha256(line_key(x)).digest()[:16] not in gone]
                texts.append("\n".join(kept) if kept is not lines else text or "")
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(kept))
            yield out | {text_col: texts, "n_lines": n_lines, "n_dropped": n_dropped}

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return map_batches(joined, f"{fields}, n_lines long, n_dropped long", cut)
