"""Audit of how much each source's words differ from the other sources'.

Terms are runs of ASCII letters and of all characters above them, A-Z
lower-cased. A language keeps the terms that enough of its documents hold;
their number of documents is counted exactly. Then:

1. *Perfect hashes.* The kept terms of a language are dealt into shards by
   hash; each shard gets a minimal perfect hash (hash and displace) with its
   terms stored beside it, slot by slot. A look-up is verified against the
   stored term, so a word that is not kept never counts.
2. *Recount.* The shards are broadcast, in blocks of at most ``BLOCK_BYTES``; a
   second pass over the documents adds each term's occurrences to a dense
   array of slots per (shard, source), held within ``CELL_BYTES`` a task and
   handed on when full. More vocabulary means more blocks and one more pass each.
3. *Merge.* The arrays of one shard meet in one task, one shard at a time: a
   shard has about ``SHARD_TERMS`` slots per source, however frequent a source
   or a term is.
4. *Divergence.* With the groups' totals each shard gives, for each pair of
   sources, its part of the sum, and each source's best terms of the shard.

Probabilities and divergences are integers, computed without rounding.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkretrieve.llm.common import Shared, map_batches, materialise
from sparkretrieve.operators.sizing import broadcast_if_bounded

SHARD_TERMS = 4096
BLOCK_BYTES = 48 << 20
CELL_BYTES = 96 << 20
# A task's counts of distinct words are handed on beyond so many, and texts are
# cut into words so many bytes at a time.
FLUSH_TERMS = 200_000
SLICE = 1 << 20
SCALE = 1_000_000_000

_NOT_A_TERM = [*range(0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_FOLD = bytes(0x20 if b in _NOT_A_TERM else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def terms_of(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a whole text in UTF-8, some at a time."""
    data = (text or "").encode("utf-8").translate(_FOLD)
    at = 0
    while at < len(data):
        stop = data.find(b" ", at + SLICE) if len(data) - at > SLICE else -1
        stop = len(data) if stop < 0 else stop
        yield data[at:stop].split()
        at = stop


def _hash(term: bytes, salt: int = 0) -> int:
    """XXH64 with seed 42, as Spark's ``xxhash64`` has it (another for a salt)."""
    import xxhash

    return xxhash.xxh64_intdigest(term, 42 + salt)


def _mix(hashes: np.ndarray, seed: np.ndarray | int) -> np.ndarray:
    """A second hash of 64-bit hashes, chosen by ``seed`` (splitmix)."""
    with np.errstate(over="ignore"):
        x = hashes + (np.asarray(seed, np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        return x ^ x >> np.uint64(31)


def perfect_hash(keys: list[bytes]) -> tuple[int, np.ndarray, list[bytes]]:
    """(salt, seeds, the keys slot by slot): a minimal perfect hash of distinct
    keys. A bucket's seed displaces its keys to free slots; buckets are settled
    largest first. The salt is zero unless two keys share a 64-bit hash."""
    n = len(keys)
    salt = 0
    while True:
        hashes = np.asarray([_hash(k, salt) for k in keys], np.uint64)
        if len(np.unique(hashes)) == n:
            break
        salt += 1
    buckets = -(-n // 3)
    bucket = (hashes >> np.uint64(32)) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    counts = np.bincount(bucket.astype(np.int64), minlength=buckets)
    stops = np.cumsum(counts)
    seeds, taken, slot = np.zeros(buckets, np.uint32), np.zeros(n, bool), np.zeros(n, np.int64)
    for b in np.argsort(-counts, kind="stable").tolist():
        mine = order[stops[b] - counts[b]:stops[b]]
        seed = 0
        while len(mine):
            # Some seeds at once; the first that gives free and distinct slots is taken.
            tried = np.arange(seed, seed + 64, dtype=np.uint64)[:, None]
            places = (_mix(hashes[mine][None, :], tried) % np.uint64(n)).astype(np.int64)
            free = ~taken[places].any(axis=1)
            if len(mine) > 1:
                ranked = np.sort(places, axis=1)
                free &= (ranked[:, 1:] != ranked[:, :-1]).all(axis=1)
            if free.any():
                k = int(np.argmax(free))
                seeds[b], slot[mine] = seed + k, places[k]
                taken[places[k]] = True
                break
            seed += 64
    stored: list[bytes] = [b""] * n
    for key, place in zip(keys, slot.tolist(), strict=True):
        stored[place] = key
    return salt, seeds, stored


class Vocabulary:
    """The perfect hashes of some shards of one language, laid side by side:
    slots are counted through all of them."""

    def __init__(self, parts: list[tuple[int, int, np.ndarray, list[bytes]]]) -> None:
        """``parts``: (shard, salt, seeds, keys), by shard."""
        self.shard = np.asarray([p[0] for p in parts], np.int64)
        self.salt = np.asarray([p[1] for p in parts], np.int64)
        self.buckets = np.asarray([len(p[2]) for p in parts], np.uint64)
        self.size = np.asarray([len(p[3]) for p in parts], np.uint64)
        self.first_bucket = np.cumsum(self.buckets) - self.buckets
        self.stop = np.cumsum(self.size).astype(np.int64)
        self.start = self.stop - self.size.astype(np.int64)
        self.seeds = np.concatenate([p[2] for p in parts])
        self.keys = [k for p in parts for k in p[3]]

    def slots(self, terms: list[bytes], shards: int) -> np.ndarray:
        """Each term's slot; -1 where its shard is not here or the key that is
        stored in the slot is another."""
        hashes = np.fromiter(map(_hash, terms), np.uint64, len(terms))
        shard = (hashes & np.uint64(shards - 1)).astype(np.int64)
        part = np.minimum(np.searchsorted(self.shard, shard), len(self.shard) - 1)
        here = self.shard[part] == shard
        for i in np.flatnonzero(here & (self.salt[part] > 0)).tolist():
            hashes[i] = _hash(terms[i], int(self.salt[part[i]]))
        bucket = self.first_bucket[part] + (hashes >> np.uint64(32)) % self.buckets[part]
        slot = self.start[part] + (_mix(hashes, self.seeds[bucket.astype(np.int64)]) % self.size[part]).astype(np.int64)
        keys = self.keys
        same = np.fromiter((keys[s] == t for s, t in zip(slot.tolist(), terms, strict=True)), bool, len(terms))
        return np.where(here & same, slot, -1)


def _document_frequencies(docs: DataFrame) -> DataFrame:
    """(lang, term binary, n): partial numbers of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        seen: dict[str, Counter] = {}

        def flush() -> Iterator[dict]:
            for lang, counts in seen.items():
                yield {"lang": [lang] * len(counts), "term": list(counts), "n": list(counts.values())}
            seen.clear()

        for batch in batches:
            langs = batch.column(0).to_pylist()
            for lang, text in zip(langs, batch.column(2), strict=True):
                found = set()
                for words in terms_of(text.as_py()):
                    found.update(words)
                seen.setdefault(lang, Counter()).update(found)
                if sum(map(len, seen.values())) > FLUSH_TERMS:
                    yield from flush()
        yield from flush()

    return map_batches(docs, "lang string, term binary, n long", run, rows_per_batch=20_000)


def _shards(kept: DataFrame) -> DataFrame:
    """(lang, shard, salt, seeds, keys): a perfect hash per language and shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        now, terms = None, []

        def built() -> dict:
            salt, seeds, keys = perfect_hash(terms)
            return {"lang": [now[0]], "shard": [now[1]], "salt": [salt], "seeds": [seeds.tobytes()], "keys": [keys]}

        for batch in batches:
            for lang, shard, term in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now != (lang, shard):
                    if now is not None:
                        yield built()
                    now, terms = (lang, shard), []
                terms.append(term)
        if now is not None:
            yield built()

    dealt = kept.select("lang", "shard", "term").repartition("lang", "shard").sortWithinPartitions("lang", "shard", "term")
    return map_batches(dealt, "lang string, shard long, salt long, seeds binary, keys array<binary>", run)


_PARTIAL = "lang string, shard long, source string, slots binary, counts binary"


def _recount(docs: DataFrame, block: Shared, shards: int) -> DataFrame:
    """(lang, shard, source, slots, counts): occurrences of the block's terms,
    summed over what a task could hold in ``CELL_BYTES``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        parts: dict[str, list] = {}
        for lang, shard, salt, seeds, keys in block.value:
            parts.setdefault(lang, []).append((shard, salt, np.frombuffer(seeds, np.uint32), keys))
        known = {lang: Vocabulary(sorted(p, key=lambda x: x[0])) for lang, p in parts.items()}
        cells: dict[tuple[str, str], np.ndarray] = {}

        def flush() -> Iterator[dict]:
            for (lang, source), counts in cells.items():
                words = known[lang]
                there = np.flatnonzero(counts)
                cut = np.searchsorted(there, words.stop).tolist()
                rows: dict[str, list] = {"lang": [], "shard": [], "source": [], "slots": [], "counts": []}
                at = 0
                for k, stop in enumerate(cut):
                    if stop > at:
                        mine = there[at:stop]
                        for c, v in zip(rows.values(), (lang, words.shard[k], source, (mine - words.start[k]).astype("<u4").tobytes(),
                                                        counts[mine].astype("<i8").tobytes()), strict=True):
                            c.append(v)
                    at = stop
                yield rows
            cells.clear()

        def add(group: tuple[str, str], found: Counter) -> Iterator[dict]:
            words = known[group[0]]
            terms = list(found)
            slot = words.slots(terms, shards)
            if group not in cells:
                if cells and (len(words.keys) + sum(map(len, cells.values()))) * 8 > CELL_BYTES:
                    yield from flush()
                cells[group] = np.zeros(len(words.keys), np.int64)
            n = np.fromiter(found.values(), np.int64, len(terms))
            cells[group][slot[slot >= 0]] += n[slot >= 0]  # terms are distinct, so slots are

        for batch in batches:
            by_group: dict[tuple[str, str], Counter] = {}
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if lang not in known:
                    continue
                counts = by_group.setdefault((lang, source), Counter())
                for words in terms_of(text.as_py()):
                    counts.update(words)
                    if len(counts) > FLUSH_TERMS:
                        yield from add((lang, source), counts)
                        counts.clear()
            for group, counts in by_group.items():
                yield from add(group, counts)
        yield from flush()

    return map_batches(docs, _PARTIAL, run)


def _merge(partials: DataFrame, shards: DataFrame) -> DataFrame:
    """(lang, shard, keys, sources, counts): per shard its terms, the sources
    that have any, and a dense array of counts for each. One pass over rows
    sorted by shard; a task holds one shard's arrays at a time."""
    terms = shards.select("lang", "shard", F.lit(None).cast("string").alias("source"), F.lit(None).cast("binary").alias("slots"),
                          F.lit(None).cast("binary").alias("counts"), "keys")
    rows = partials.withColumn("keys", F.lit(None).cast("array<binary>")).unionByName(terms)
    rows = rows.repartition("lang", "shard").sortWithinPartitions("lang", "shard", F.col("source").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        now, keys, counts = None, [], {}

        def done() -> dict:
            return {"lang": [now[0]], "shard": [now[1]], "keys": [keys], "sources": [list(counts)],
                    "counts": [[c.tobytes() for c in counts.values()]], "totals": [[int(c.sum()) for c in counts.values()]]}

        for batch in batches:
            for lang, shard, source, slots, n, stored in zip(*(batch.column(c) for c in range(6)), strict=True):
                if stored.is_valid:  # the shard's terms come first
                    if now is not None:
                        yield done()
                    now, keys, counts = (lang.as_py(), shard.as_py()), stored.as_py(), {}
                    continue
                cells = counts.setdefault(source.as_py(), np.zeros(len(keys), "<i8"))
                cells[np.frombuffer(slots.as_py(), "<u4")] += np.frombuffer(n.as_py(), "<i8")
        if now is not None:
            yield done()

    return map_batches(rows, "lang string, shard long, keys array<binary>, sources array<string>, counts array<binary>, totals array<long>",
                       run, rows_per_batch=16)


def _share(counts: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / total) in whole numbers; totals below 9e15."""
    left, share = counts + 1, np.zeros_like(counts)
    for _ in range(3):
        left = left * 1000
        share = share * 1000 + left // total
        left = left % total
    return share + 1


def _shard_divergence(merged: DataFrame, ranks: int) -> DataFrame:
    """(lang, part, source, item, value) of joined shard rows: for each pair
    of sources a part of the sum, and each source's best ``ranks`` terms of the shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        sums: dict[str, tuple[list[str], np.ndarray]] = {}

        def pairs() -> Iterator[dict]:
            for lang, (names, matrix) in sums.items():
                for i, name in enumerate(names):
                    others = [k for k in range(len(names)) if k != i]
                    yield {"lang": [lang] * len(others), "part": ["pair"] * len(others), "source": [name] * len(others),
                           "item": [names[k] for k in others], "value": matrix[i, others]}
            sums.clear()

        for batch in batches:
            for row in batch.to_pylist():
                lang, keys, names = row["lang"], row["keys"], [g["source"] for g in row["groups"]]
                totals, kept = [g["total"] for g in row["groups"]], row["kept"]
                counts = np.zeros((len(names), len(keys)), np.int64)
                at = {name: i for i, name in enumerate(names)}
                for name, cells in zip(row["sources"], row["counts"], strict=True):
                    counts[at[name]] = np.frombuffer(cells, "<i8")
                p = np.stack([_share(c, n + kept) for c, n in zip(counts, totals, strict=True)])
                if lang not in sums:
                    if sums and (len(names) ** 2 + sum(m.size for _, m in sums.values())) * 8 > CELL_BYTES:
                        yield from pairs()
                    sums[lang] = (names, np.zeros((len(names), len(names)), np.int64))
                matrix = sums[lang][1]
                for i in range(len(names)):
                    d = p[i] - p
                    matrix[i] += (d * d // p).sum(axis=1)
                q = _share(counts.sum(axis=0), sum(totals) + kept)
                name_rank = np.empty(len(keys), np.int64)
                name_rank[sorted(range(len(keys)), key=keys.__getitem__)] = np.arange(len(keys))
                for i, name in enumerate(names):
                    there = np.flatnonzero((counts[i] > 0) & (p[i] > q))
                    d = (p[i] - q)[there]
                    value = d * d // q[there]
                    best = np.lexsort((name_rank[there], -value))[:ranks]
                    yield {"lang": [lang] * len(best), "part": ["term"] * len(best), "source": [name] * len(best),
                           "item": [keys[k].decode("utf-8") for k in there[best].tolist()], "value": value[best]}
        yield from pairs()

    return map_batches(merged, "lang string, part string, source string, item string, value long", run)


def source_divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                      min_docs: int = 3, ranks: int = 200, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(lang, source, part, item, value long, rank int) for every group of a
    language and a source that occurs.

    Part 'pair': item is each other source of the language, value the sum over
    the language's kept terms of floor((p - q)^2 / q), p the group's share of
    the term in parts of 1e9 (add-one smoothed, plus 1) and q the other's; all
    ranks. Part 'term': item is each kept term that the group has and whose p
    is above the language's q; the first ``ranks`` ranks. Ranks go by value
    descending, then item ascending in UTF-8.

    Null text, language and source count as empty. Each row is a document,
    repeated ones too; other columns are not read. A language without kept
    terms has pairs of value 0; an empty table gives an empty result."""
    spark = docs.sparkSession
    named = docs.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(n)
                          for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    kept = _document_frequencies(named).groupBy("lang", "term").agg(F.sum("n").alias("n")) \
        .filter(F.col("n") >= min_docs).select("lang", "term")
    kept = materialise(kept, "terms")
    n, size = kept.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("term") + 8), F.lit(0))).first()
    shards = 1 << max(0, (-(-n // SHARD_TERMS) - 1).bit_length())
    hashed = materialise(_shards(kept.withColumn("shard", F.xxhash64("term").bitwiseAND(F.lit(shards - 1)))), "hashes")

    blocks = max(1, min(shards, -(-int(size) // block_bytes)))
    partials = None
    for b in range(blocks):
        rows = hashed.filter(F.col("shard") % blocks == b).toArrow()
        block = Shared(spark, list(zip(*(rows.column(c).to_pylist() for c in ("lang", "shard", "salt", "seeds", "keys")), strict=True)))
        counted = _recount(named, block, shards)
        if blocks > 1:  # one block is held at a time
            counted = materialise(counted, "recount")
            block.broadcast.destroy()
        partials = counted if partials is None else partials.union(counted)
    merged = materialise(_merge(partials, hashed), "merged")

    # A language's groups and totals fit one row: the result has their square.
    totals = merged.select("lang", F.explode(F.arrays_zip("sources", "totals")).alias("g")) \
        .groupBy("lang", F.col("g.sources").alias("source")).agg(F.sum("g.totals").alias("total"))
    groups = materialise(named.select("lang", "source").distinct().join(totals, ["lang", "source"], "left")
                         .select("lang", "source", F.coalesce("total", F.lit(0)).cast("long").alias("total")), "groups")
    langs = groups.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", "total"))).alias("groups")) \
        .join(merged.groupBy("lang").agg(F.sum(F.size("keys")).alias("kept")), "lang")
    langs, _ = broadcast_if_bounded(materialise(langs, "langs"))
    parts = materialise(_shard_divergence(merged.select("lang", "keys", "sources", "counts").join(langs, "lang"), ranks), "parts")

    others = groups.select("lang", F.col("source").alias("item"))
    sums = parts.filter("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = groups.select("lang", "source").join(others, "lang").filter("source != item") \
        .join(sums, ["lang", "source", "item"], "left") \
        .select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("long").alias("value"))
    terms = parts.filter("part = 'term'").select("lang", "source", "part", "item", "value")
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    rank = F.row_number().over(order).alias("rank")
    return pairs.select("*", rank).unionByName(terms.select("*", rank).filter(F.col("rank") <= ranks))
