"""Packing documents into sequences by fitted length patterns.

1. Every document is tokenised and cut into pieces of at most ``max_tokens``
   ids (only the first piece of a cut document is shorter); the table of
   pieces, without ids, is written once.
2. The histogram of piece lengths (at most ``max_tokens`` rows, whatever the
   size of the corpus) goes to the driver. There, all patterns of up to three
   lengths that fill a sequence exactly are enumerated, their repeat counts
   are fitted to the histogram by non-negative least squares, rounded without
   using a length more often than it occurs, and what is left is packed by
   best fit, longest first, a whole run of equal lengths at a time.
3. The plan says which sequence takes the i-th piece of a length. Spark
   numbers the pieces of each length (salted, so a length that holds a third
   of all pieces is counted in many groups), and each task looks its pieces up
   in the plan, whose size depends on ``max_tokens`` alone.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkretrieve.llm.bpe import WORD_PATTERN, codec
from sparkretrieve.llm.common import free_name, map_batches, materialise, process_cache

MAX_TOKENS = 2048
# From so long a run without a change from white space to other characters on, a
# text goes to the codec of ``bpe``: the library's splitting gives up on it.
LONG_RUN = re.compile(r"\s{65536}|\S{65536}")
END_ID = 0
FIT_STEPS = 150


def _encoder(path: str):
    """Encodes a text to a numpy array of ids; the same ids as ``bpe`` gives, for
    vocabularies whose merged tokens are numbered in the order of their merges."""
    import tiktoken

    def make():
        bpe = codec(path)
        made = [bpe.id_of[a + b] for a, b in bpe.rank]
        if any(a >= b for a, b in zip(made, made[1:], strict=False)):
            raise ValueError("the vocabulary's ids do not follow its merges")
        pattern = WORD_PATTERN.replace(r"\p{White_Space}", r"\s").replace(r"\P{White_Space}", r"\S")
        return tiktoken.Encoding("packing", pat_str=pattern,
                                 mergeable_ranks=bpe.id_of, special_tokens=bpe.special)

    return process_cache("packing", path, make)


def _ids(encoding, path: str, text: str) -> np.ndarray:
    if len(text) >= 65536 and LONG_RUN.search(text):
        return np.asarray(codec(path).encode(text), "<u4")
    return encoding.encode_to_numpy(text, allowed_special="all").astype("<u4")


def token_pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 max_tokens: int = MAX_TOKENS, end_id: int = END_ID) -> DataFrame:
    """(id_col, piece int, start, length, ids_crc32 long): the pieces of each
    document's ids followed by ``end_id``. Null and empty texts are that one
    id. Each row of a repeated identifier is a document of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        encoding = _encoder(path)
        end = np.asarray([end_id], "<u4")
        for batch in batches:
            rows, at, cols = [], 0, ([], [], [], [])
            for text in batch.column(1).to_pylist():
                ids = np.concatenate([_ids(encoding, path, text or ""), end])
                first = len(ids) % max_tokens or max_tokens
                for piece, stop in enumerate(range(first, len(ids) + 1, max_tokens)):
                    start = max(0, stop - max_tokens) if piece else 0
                    rows.append(at)
                    for c, v in zip(cols, (piece, start, stop - start, zlib.crc32(ids[start:stop].tobytes())), strict=True):
                        c.append(v)
                at += 1
            yield dict(zip((id_col, "piece", "start", "length", "ids_crc32"),
                           (batch.column(0).take(pa.array(rows, pa.int64())), *cols), strict=True))

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(id_col, text_col),
                       f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long", run)


def exact_patterns(lengths: np.ndarray, size: int) -> np.ndarray:
    """All multisets of one to three of ``lengths`` (distinct, positive) that sum
    to ``size``: rows of three lengths, descending, padded with zeros."""
    there = np.zeros(size + 1, bool)
    there[lengths] = True
    found = [np.asarray([[size, 0, 0]])] if there[size] else []
    a = np.sort(lengths)
    b = size - a
    two = (b >= 1) & (b <= a)
    two[two] = there[b[two]]
    found.append(np.stack([a[two], b[two], np.zeros(two.sum(), int)], 1))
    for x in a:
        rest = size - x
        if rest < 2:
            continue
        y = a[(a <= x) & (a < rest)]
        z = rest - y
        y, z = y[z <= y], z[z <= y]
        ok = there[z]
        found.append(np.stack([np.full(ok.sum(), x), y[ok], z[ok]], 1))
    return np.concatenate(found).astype(np.int64)


def fit_repeats(patterns: np.ndarray, histogram: np.ndarray, steps: int = FIT_STEPS) -> np.ndarray:
    """Non-negative x that minimises |A x - histogram|^2 by accelerated
    projected gradient steps; A has a pattern's lengths in its column."""
    size = len(histogram)
    used = (patterns > 0).astype(float)

    def forward(x: np.ndarray) -> np.ndarray:
        return sum(np.bincount(patterns[:, j], x * used[:, j], size) for j in range(3))

    def back(r: np.ndarray) -> np.ndarray:
        return sum(r[patterns[:, j]] * used[:, j] for j in range(3))

    # Scale each length to its count, so that rare lengths are fitted as well.
    weight = 1.0 / np.maximum(histogram, 1.0)
    v = np.ones(len(patterns))
    for _ in range(20):  # the largest curvature, by power iteration
        v = back(weight * forward(v))
        top = np.linalg.norm(v)
        v /= max(top, 1e-12)
    x = np.zeros(len(patterns))
    y, t = x.copy(), 1.0
    for _ in range(steps):
        new = np.maximum(0.0, y - back(weight * (forward(y) - histogram)) / max(top * 1.05, 1e-12))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def best_fit(counts: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first, on (length: count): groups of equal sequences."""
    open_groups: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    rooms: list[int] = []
    full: list[tuple[tuple[int, ...], int]] = []

    def put(pattern: tuple[int, ...], n: int) -> None:
        room = size - sum(pattern)
        if not room:
            full.append((pattern, n))
            return
        if not open_groups[room]:
            insort(rooms, room)
        open_groups[room].append((pattern, n))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            k = bisect_left(rooms, length)
            if k < len(rooms):
                room = rooms[k]
                pattern, n = open_groups[room].pop()
                if not open_groups[room]:
                    rooms.pop(k)
                take = min(left, n)
                if take < n:
                    put(pattern, n - take)
                put((*pattern, length), take)
                left -= take
            else:
                each = size // length
                if left >= each:
                    put((length,) * each, left // each)
                if left % each:
                    put((length,) * (left % each), 1)
                left = 0
    return full + [g for room in rooms for g in open_groups[room]]


def packing_plan(histogram: np.ndarray, size: int = MAX_TOKENS) -> list[tuple[tuple[int, ...], int]]:
    """Groups (pattern of lengths, number of sequences) that use each length l
    exactly histogram[l] times; ``histogram`` has size + 1 entries."""
    left = histogram.astype(np.int64).copy()
    groups: list[tuple[tuple[int, ...], int]] = []
    if left[size]:
        groups.append(((size,), int(left[size])))
        left[size] = 0
    lengths = np.flatnonzero(left)
    patterns = exact_patterns(lengths, size) if len(lengths) else np.zeros((0, 3), int)
    if len(patterns):
        x = fit_repeats(patterns, left.astype(float))
        for k in np.argsort(-x, kind="stable"):
            n = int(x[k] + 0.5)
            if not n:
                break
            pattern = tuple(int(p) for p in patterns[k] if p)
            n = min([n, *(int(left[p]) // pattern.count(p) for p in set(pattern))])
            if n:
                groups.append((pattern, n))
                for p in pattern:
                    left[p] -= n
    rest = {int(k): int(left[k]) for k in np.flatnonzero(left)}
    return groups + best_fit(rest, size)


def _runs(groups: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, ...]:
    """The plan by length: run keys (length, first index), and for each run its
    first sequence and the offset in it."""
    next_index: dict[int, int] = defaultdict(int)
    rows, base = [], 0
    for pattern, n in groups:
        offset = 0
        for length in pattern:
            rows.append((length << 40 | next_index[length], base, offset))
            next_index[length] += n
            offset += length
        base += n
    runs = np.asarray(sorted(rows), np.int64).reshape(-1, 3)
    return runs[:, 0].copy(), runs[:, 1].copy(), runs[:, 2].copy()


def pack_pieces(pieces: DataFrame, size: int = MAX_TOKENS) -> DataFrame:
    """``pieces`` (any columns, with length from 1 to ``size``) and
    sequence_id, offset (long): where each piece stands. ``pieces`` should be
    a written table, as it is read several times. Rows that are alike are
    packed one by one; an empty table stays empty; columns named like a result
    are replaced."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in
              pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `size` rows
    if any(k is None or not 1 <= k <= size for k in counts):
        raise ValueError(f"lengths must be from 1 to {size}")
    histogram = np.zeros(size + 1, np.int64)
    for k, n in counts.items():
        histogram[k] = n
    keys, bases, offsets = _runs(packing_plan(histogram, size))

    # The i-th piece of its length: counted in salted groups, shifted by what
    # the groups before hold.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salts = max(parts, int(histogram.sum()) >> 16)
    pieces = pieces.drop(*[c for c in pieces.columns if c.lower() in ("sequence_id", "offset")])
    columns = pieces.columns
    salt, n, shift, place_no = (free_name(pieces, c) for c in ("_salt", "_n", "_shift", "_i"))
    salted = pieces.withColumn(salt, F.pmod(F.xxhash64(*columns), F.lit(salts)).cast("int"))
    shifts = salted.groupBy("length", salt).agg(F.count(F.lit(1)).alias(n)) \
        .withColumn(shift, F.sum(n).over(Window.partitionBy("length").orderBy(salt)) - F.col(n)).drop(n)
    number = F.row_number().over(Window.partitionBy("length", salt).orderBy(*columns))
    numbered = salted.withColumn(place_no, number).join(shifts, ["length", salt]) \
        .select(*columns, (F.col(place_no) - 1 + F.col(shift)).alias(place_no))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            i = batch.column(place_no).to_numpy(zero_copy_only=False).astype(np.int64)
            run = np.searchsorted(keys, length << 40 | i, side="right") - 1
            yield {c: batch.column(c) for c in columns} | {
                "sequence_id": pa.array(bases[run] + i - (keys[run] & ((1 << 40) - 1))),
                "offset": pa.array(offsets[run])}

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return map_batches(numbered, f"{fields}, sequence_id long, offset long", place)


def pack_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                   max_tokens: int = MAX_TOKENS, end_id: int = END_ID) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are one end id; very long ones are cut; repeated rows
    are packed each; other columns of ``docs`` are not read, so their names
    cannot clash. An empty table gives an empty result."""
    pieces = materialise(token_pieces(docs, path, id_col, text_col, max_tokens, end_id), "pieces")
    return pack_pieces(pieces, max_tokens)
