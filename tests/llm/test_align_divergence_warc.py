"""Tokenizer alignment, source divergence and web archives against brute force."""

import gzip
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from sparkretrieve.llm import align, divergence, warc
from sparkretrieve.llm.queries import piece_model_path, tokenizer_path
from sparkretrieve.session import scratch_path

POOL = "ab  \n\t'sreLMé²½ⅧÀß_-\x85\xa0\x1c 　日本𝔸́٣🙂€…▁\x00​﻿ﬁ"


@pytest.fixture(scope="module")
def aligner():
    return align.Aligner(tokenizer_path(), piece_model_path())


def _groups(aligner, text):
    """Ids, groups and links by whole-text encoding and decoded bytes alone."""
    ids = aligner.a.encode(" " + text, add_special_tokens=False).ids, aligner.b.encode(text)
    if not text:
        return [], [], []
    ends = []
    for i, table in zip(ids, (aligner.bytes_a, aligner.bytes_b), strict=True):
        if b"".join(table[k] for k in i) != (" " + text).encode():
            return [], [], []
        ends.append(np.cumsum([len(table[k]) for k in i]).tolist())
    out, i, j, links = [], 0, 0, []
    for e in sorted(set(ends[0]) & set(ends[1])):
        a, b = ends[0].index(e, i) + 1, ends[1].index(e, j) + 1
        out.append(",".join(map(str, ids[0][i:a])) + "|" + ",".join(map(str, ids[1][j:b])))
        links.append((ids[0][a - 1], ids[1][b - 1]))
        i, j = a, b
    return ids, out, links


def _odd_texts():
    rng = random.Random(1)
    texts = ["".join(rng.choice(POOL) for _ in range(rng.randint(0, 14))) for _ in range(1500)]
    return texts + ["", " ", "a  ", " a", "a b", "  a b ", "<|endoftext|> <s> x <0x41>", "x\r\ny z",
                    "the cat sat. " * 400, "é" * 3000, "a" * 5000, "x " + " " * 3000 + " y"]


def test_alignment_equals_brute_force(aligner):
    texts = _odd_texts()
    for text, row in zip(texts, align.align_texts(aligner, texts, spans=True), strict=True):
        ids, groups, links = _groups(aligner, text)
        assert row["groups"] == ";".join(groups), text
        assert (row["n_a"], row["n_b"]) == ((len(ids[0]), len(ids[1])) if ids else (0, 0))
        assert dict(zip(row["pairs"], row["pair_n"], strict=True)) == Counter(a << 32 | b for a, b in links)
        if groups:
            assert row["ends"][-1] == len((" " + text).encode()) and len(row["ends"]) == len(groups)


def test_slices_and_forgotten_segments_change_nothing(aligner, monkeypatch):
    texts = ["some words, and more words; é à la carte " * 60, "no border here" * 3, None]
    whole = str(align.align_texts(aligner, texts))
    monkeypatch.setattr(align, "SLICE", 7)
    monkeypatch.setattr(align, "CACHE_SEGMENTS", 5)
    aligner.known.clear()
    assert str(align.align_texts(aligner, texts)) == whole


def test_coarse_ends_are_refined_where_shared():
    # A letter of two bytes in two tokens: both report the letter's end.
    assert align.token_ends(np.asarray([1, 3, 3]), np.asarray([1, 1, 1])).tolist() == [1, 2, 3]
    # Byte pieces report the letter's begin, but for the last.
    assert align.token_ends(np.asarray([1, 1, 3]), np.asarray([1, 1, 1])).tolist() == [1, 2, 3]


@pytest.mark.parametrize("per_block", [2_000_000, 7])
def test_links_are_counted_over_all_documents(spark, aligner, per_block):
    texts = _odd_texts()[:60] + ["the cat sat", "the cat sat", None, "", "the cat sat on the mat"]
    rows = [(i % 40, t, "x", 7) for i, t in enumerate(texts)] + [(None, "the cat", "x", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pairs string, _row int")
    aligned = align.token_groups(docs, tokenizer_path(), piece_model_path(), spans=True)
    got = align.score_links(aligned, per_block).collect()
    links = [_groups(aligner, t or "")[2] for _, t, _, _ in rows]
    n = Counter(p for found in links for p in found)
    most = defaultdict(int)
    for (_, b), k in n.items():
        most[b] = max(most[b], k)
    want = sorted((str(r[0]), len(found), sum(n[p] == most[p[1]] for p in found), sum(n[p] for p in found))
                  for r, found in zip(rows, links, strict=True))
    assert sorted((str(r.doc_id), r.n_links, r.n_best, r.count_sum) for r in got) == want
    assert {r["_row"] for r in got} == {7}
    assert align.score_links(align.token_groups(docs.limit(0), tokenizer_path(), piece_model_path())).count() == 0


def _divergence(rows, min_docs, ranks):
    import re

    docs = [((lang or ""), (source or ""), [w.translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)}))
             for w in re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for d in mine for t in set(d[2]))
        kept = [t for t, n in df.items() if n >= min_docs]
        counts = {s: Counter(t for d in mine if d[1] == s for t in d[2] if df[t] >= min_docs) for s in {d[1] for d in mine}}
        whole = sum(counts.values(), Counter())

        def share(c):
            total = sum(c.values()) + len(kept)
            return {t: 1 + 10**9 * (c[t] + 1) // total for t in kept}

        p, q = {s: share(c) for s, c in counts.items()}, share(whole)
        for s in counts:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in counts if o != s]
            terms = [(-((p[s][t] - q[t]) ** 2 // q[t]), t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                ranked = sorted(items, key=lambda x: (x[0], x[1].encode()))
                out += [(lang, s, part, i, -v, k) for k, (v, i) in enumerate(ranked, 1) if part == "pair" or k <= ranks]
    return sorted(out)


@pytest.mark.parametrize("small", [False, True])
def test_divergence_equals_brute_force(spark, monkeypatch, small):
    if small:  # many shards, blocks, flushes and slices
        monkeypatch.setattr(divergence, "SHARD_TERMS", 4)
        monkeypatch.setattr(divergence, "CELL_BYTES", 64)
        monkeypatch.setattr(divergence, "FLUSH_TERMS", 3)
        monkeypatch.setattr(divergence, "SLICE", 9)
    rng = random.Random(5)
    words = [w + s for w in ("Alpha", "béta", "日本", "x", "é", "A\x85b") for s in ("", "s", "T", "ß")]
    rows = [(" 1,".join(rng.choice(words[:rng.randint(1, 24)]) for _ in range(rng.randint(0, 30))),
             rng.choice(["en", "de", None]), rng.choice(["a", "a", "b", None, "ç"])) for _ in range(80)]
    rows += [(None, "fr", "only"), ("", "fr", "other"), ("word " * 3000, "en", "a"), ("zz", "en", "b"), ("zz zz", "en", "b")] + rows[:5]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "text string, lang string, source string, value int")
    got = divergence.source_divergence(docs, min_docs=3, ranks=5, block_bytes=40 if small else 1 << 20)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == _divergence(rows, 3, 5)
    if not small:
        assert divergence.source_divergence(docs.limit(0)).count() == 0


def test_perfect_hash_is_minimal_and_verified():
    keys = [f"term{k}".encode() for k in range(5000)]
    salt, seeds, stored = divergence.perfect_hash(keys)
    assert sorted(stored) == sorted(keys)
    words = divergence.Vocabulary([(0, salt, seeds, stored)])
    assert [stored[s] for s in words.slots(keys, 1).tolist()] == keys
    assert set(words.slots([f"other{k}".encode() for k in range(5000)], 1).tolist()) == {-1}


def test_shares_are_exact_for_large_counts():
    counts, total = np.asarray([0, 1, 10**12, 8 * 10**14]), 9 * 10**14 + 7
    assert divergence._share(counts, total).tolist() == [1 + 10**9 * (int(c) + 1) // total for c in counts]


def _pages():
    rng = random.Random(3)
    rows = []
    for i in range(600):
        n = rng.choice([0, 1, 5, 99, 100, 120, 70_000 if i % 50 == 0 else 3])
        payload = bytes(rng.choice(b"\r\n\r\naW\xff\x80") for _ in range(n)) if i % 11 else None
        rows.append((i if i % 97 else None, "http://x/\r\na b%20%0A" if i % 3 else None, payload))
    rows += [rows[5], rows[5]] + [(5000 + k, "u", b"WARC/1.1\r\n\r\n" * 30) for k in range(200)]
    return rows + [(9000, "u", b"x" * 300), (None, "u", b"x" * 300), (8000, "v", b"x" * 300), (None, "n", b"y" * 200), (None, "n", b"y" * 200)]


def _resolved(spark, path):
    found = warc.read_archives(spark, path, payloads=False)
    return warc.resolve_revisits(spark.createDataFrame(found.collect(), found.schema))


@pytest.mark.parametrize("broadcast", [True, False])
def test_archives_are_read_back_and_deduplicated(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(warc, "broadcast_if_bounded", lambda df, *a, **k: (df, False))
    rows = _pages()
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html binary, record_id string").repartition(5)
    plain, small, again = (scratch_path(spark, n) for n in ("w1", "w2", "w3"))
    warc.write_responses(pages, plain)
    read = warc.read_archives(spark, plain).collect()
    assert Counter((r.row_id, bytes(r.payload)) for r in read) == Counter((i, p or b"") for i, _, p in rows)
    assert {r.uri for r in read} == {None, "u", "v", "n", "http://x/%0D%0Aa%20b%20%0A"}

    warc.dedupe_archives(spark, plain, small)
    got = _resolved(spark, small).collect()
    groups = defaultdict(list)
    for i, _, p in rows:
        groups[p or b""].append(i)
    want = Counter()
    for p, ids in groups.items():
        ids = sorted(ids, key=lambda i: (i is None, i or 0))
        for k, i in enumerate(ids):
            copy = k > 0 and len(p) >= 100
            want[(i, len(p), "revisit" if copy else "response", ids[0] if copy else None)] += 1
    assert Counter((r.row_id, r.payload_bytes, r.record_type, r.refers_to) for r in got) == want

    # Deduplicating once more changes ids only; revisits follow their response.
    warc.dedupe_archives(spark, small, again)
    assert Counter((r.row_id, r.payload_bytes, r.record_type, r.refers_to) for r in _resolved(spark, again).collect()) == want


def test_empty_and_broken_archives(spark, tmp_path):
    plain, small = scratch_path(spark, "e1"), scratch_path(spark, "e2")
    warc.write_responses(spark.createDataFrame([], "page_id long, url string, html string"), plain)
    warc.dedupe_archives(spark, plain, small)
    assert _resolved(spark, small).count() == 0
    block = b"HTTP/1.1 200 OK\r\n\r\nbody"
    other = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"
    record = b"WARC/1.0\r\nWARC-Type: response\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: %d\r\n\r\n"
    good = other + record % len(block) + block + b"\r\n\r\n"
    for name, data, fine in (("good", good, True), ("long", good.replace(b"body", b"bodies"), False), ("cut", good[:-9], False),
                             ("digest", good.replace(b"WARC-Type: response", b"WARC-Type: response\r\nWARC-Payload-Digest: sha256:00"), False)):
        (tmp_path / name).mkdir()
        # Archives of other tools hold one gzip member per record.
        (tmp_path / name / "a.warc.gz").write_bytes(gzip.compress(data[:len(other)]) + gzip.compress(data[len(other):]))
        read = warc.read_archives(spark, str(tmp_path / name))
        if fine:
            assert [bytes(r.payload) for r in read.collect()] == [b"body"]
        else:
            with pytest.raises(Exception):  # noqa: B017, PT011 - raised in a task
                read.collect()
