"""Exact dedup, line dedup, SimHash and packing against plain brute force."""

import collections
import itertools
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sparkretrieve.llm import exact_dedup, line_dedup, packing, simhash
from sparkretrieve.llm.common import connected_components
from sparkretrieve.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, kept string, n_lines int, fp string, _t string"


def _rows():
    rng = random.Random(3)
    vocab = ["alpha", "Beta", "gamma", "delta", "é", "ß", "日本", "x1"]
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "One"), (6, "one two"), (7, "w " * 30000)]
    for i in range(8, 60):
        rows.append((i, " ".join(rng.choice(vocab) for _ in range(rng.randint(1, 40)))))
    base = " ".join(rng.choice(vocab) + str(k) for k in range(200))
    rows += [(60 + k, base if k % 2 else base + f" tail{k}") for k in range(20)]
    line = "A line that many documents share, with enough characters"
    rows += [(90 + k, f"{k} first\n  {line.upper() if k % 2 else line}\t\nshort\nshort\nlast {k}") for k in range(6)]
    rows += [(98, line + "\n" + line), (99, "twenty code points é\nx"), (100, "twenty code points é"),
             (101, "TWENTY CODE POINTS é \n"), (8, rows[7][1]), (200, "one"), (200, "one"), (None, "one"), (None, line)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "k", 1, "f", "t") for i, t in _rows()], SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("keep", ["max", "min"])
@pytest.mark.parametrize("share", [0.25, 0.0])
def test_exact_duplicates(docs, keep, share, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HOT_SHARE", share)
    groups = collections.defaultdict(list)
    for i, t in _rows():
        groups[t or ""].append(i)
    best = {t: (max if keep == "max" else min)([i for i in ids if i is not None], default=None)
            for t, ids in groups.items()}
    got = exact_dedup.duplicate_groups(docs, keep=keep).collect()
    assert sorted((str(r.doc_id), r.text or "", r.keep_id, r.group_size) for r in got) == \
        sorted((str(i), t or "", best[t or ""], len(groups[t or ""])) for i, t in _rows())
    assert all(r.keep_id == r.doc_id for r in got if r.kept)
    assert sum(r.kept for r in got) == len(groups)
    assert "n_lines" in got[0] and "_t" in got[0]


def test_exact_duplicates_hot_group(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"),
                                    F.when(F.col("id") % 3 > 0, F.lit("copy")).otherwise(F.col("id").cast("string")).alias("text"))
    got = exact_dedup.duplicate_groups(docs).filter("text = 'copy'").groupBy("keep_id", "group_size") \
        .agg(F.sum(F.col("kept").cast("int")).alias("kept"), F.count("*").alias("n")).collect()
    assert [tuple(r) for r in got] == [(2999, 2000, 1, 2000)]


def test_empty_tables(empty):
    assert exact_dedup.duplicate_groups(empty).count() == 0
    assert line_dedup.drop_repeated_lines(empty).count() == 0
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.keep_one_per_group(empty).count() == 0
    assert packing.pack_documents(empty, tokenizer_path()).count() == 0


WS = " \t\n\x0b\x0c\r"


def _lower(s):
    return re.sub("[A-Z]", lambda m: m.group().lower(), s)


def _cut_lines(rows, min_chars=20, min_docs=3):
    holders = collections.defaultdict(set)
    order = lambda i: (i is not None, i or 0)
    for i, t in rows:
        for x in (t or "").split("\n"):
            holders[_lower(x.strip(WS))].add(i)
    gone = {k: max(v, key=order) for k, v in holders.items() if len(k) >= min_chars and len(v) >= min_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if _lower(x.strip(WS)) not in gone or gone[_lower(x.strip(WS))] == i]
        out.append((str(i), len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


@pytest.mark.parametrize("bits", [None, 64])  # 64 bits are full at once: every line is a suspect
def test_line_dedup(docs, bits):
    got = line_dedup.drop_repeated_lines(docs, bits=bits)
    assert got.columns == [*[c for c in SCHEMA.replace(",", "").split()[::2] if c != "n_lines"], "n_lines", "n_dropped"]
    assert sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.text) for r in got.collect()) == _cut_lines(_rows())


def _fingerprint(t):
    words = re.findall(r"[^\x20\x09-\x0D]+", _lower(t or ""))
    shingles = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def _components(prints, radius):
    """{fingerprint: smallest fingerprint reachable}"""
    nodes = sorted(set(prints))
    root = {p: p for p in nodes}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in itertools.combinations(nodes, 2):
        if (a ^ b).bit_count() <= radius:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {p: find(p) for p in nodes}


def test_fingerprint_blocks(monkeypatch):
    text = " ".join(f"word{k % 77}" for k in range(500))
    monkeypatch.setattr(simhash, "BLOCK", 7)
    assert simhash.fingerprint(text) == _fingerprint(text)
    for t in (None, "", " ", "a", "a B", "a b c", "É é \xa0x"):
        assert simhash.fingerprint(t) == _fingerprint(t)


def test_near_duplicates(docs):
    rows = _rows()
    prints = {k: _fingerprint(t) for k, (_, t) in enumerate(rows)}
    roots = _components(prints.values(), 2)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            r = roots[prints[k]]
            least[r] = min(least.get(r, i), i)
    want = sorted((str(i), f"{prints[k]:016x}", least.get(roots[prints[k]])) for k, (i, _) in enumerate(rows))
    got = simhash.near_duplicates(docs).collect()
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == want
    kept = simhash.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    stay = [least.get(r) for r in {roots[p] for p in prints.values()}]
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, stay))


@pytest.mark.parametrize("radius,limit", [(1, 2), (2, 2), (2, 24), (3, 2)])
def test_links_in_large_buckets(spark, radius, limit, monkeypatch):
    """Pairs, and the way for large buckets, connect the same fingerprints."""
    monkeypatch.setattr(simhash, "PAIR_LIMIT", limit)
    rng = random.Random(radius)
    prints = set()
    for _ in range(4):
        x = rng.getrandbits(64)
        for _ in range(40):
            prints.add(x)
            if rng.random() < 0.8:
                for _ in range(rng.randint(1, 3)):
                    x ^= 1 << rng.randrange(64)
    nodes = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fp long")
    found = connected_components(simhash.links(nodes, radius).select("a", "b")).collect()
    got = {r["node"]: r["component"] for r in found}
    groups = collections.defaultdict(set)
    for p in prints:
        groups[got.get(simhash._signed(p), simhash._signed(p))].add(p)
    want = collections.defaultdict(set)
    for p, r in _components(prints, radius).items():
        want[r].add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_masks_cover_every_pair():
    for radius in (1, 2, 3):
        masks = simhash.covering_masks(radius)
        rng = random.Random(0)
        for _ in range(2000):
            at = [rng.randrange(64) for _ in range(radius)]
            assert any(not any(m >> i & 1 for i in at) for m in masks)


def test_packing(docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    size = 64
    got = packing.pack_documents(docs, tokenizer_path(), max_tokens=size).collect()
    want = []
    for i, t in _rows():
        ids = np.asarray([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        cut = len(ids) % size or size
        at = 0
        for k, stop in enumerate(range(cut, len(ids) + 1, size)):
            want.append((str(i), k, at, stop - at, zlib.crc32(ids[at:stop].tobytes())))
            at = stop
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    total = sum(w[3] for w in want)
    assert len(sequences) <= -(-total // size) * 1.02 + 1


@pytest.mark.parametrize("seed", range(4))
def test_packing_plan_uses_each_length_exactly(seed):
    rng = np.random.default_rng(seed)
    size = [7, 64, 256, 512][seed]
    histogram = np.bincount(rng.integers(1, size + 1, 3000 if seed else 1), minlength=size + 1)
    used = np.zeros(size + 1, int)
    for pattern, n in packing.packing_plan(histogram, size):
        assert n > 0 and sum(pattern) <= size
        for p in pattern:
            used[p] += n
    assert (used == histogram).all()


def test_pack_pieces_rejects_bad_lengths(spark):
    with pytest.raises(ValueError, match="lengths must be"):
        packing.pack_pieces(spark.createDataFrame([(1, 70)], "doc_id long, length long"), 64)


def test_components_of_a_long_chain(spark):
    edges = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = connected_components(edges).groupBy("component").agg(F.count("*").alias("n")).collect()
    assert [tuple(r) for r in got] == [(0, 201)]


