"""URL filter, LM scoring, toxicity and nearest neighbours."""

import collections
import glob
import math
import os
import random
import re
import tempfile
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkretrieve.llm import ann, lm_score, mixing, queries, toxicity, url_filter
from sparkretrieve.llm.common import table
from sparkretrieve.session import checkpoint_root

SF = "/root/testdata/sf0.001"

# --- URL filter ---------------------------------------------------------------

URLS = [
    ("http://A.Example.NET/en/x?q#f", "a.example.net", "/en/x", "example.net/en/", "allow"),
    ("https://example.net/de/x", "example.net", "/de/x", "net/", "block"),
    ("x://badexample.net/en/", "badexample.net", "/en/", "net/", "block"),
    ("http://m.example.com/de/1", "m.example.com", "/de/1", "example.com/de/", "block"),
    ("http://org/fr/", "org", "/fr/", "org/fr/", "allow"),
    ("http://x.org/frx", "x.org", "/frx", None, None),
    ("http://x.net", "x.net", "", None, None),
    ("http://x.net?a/b", "x.net", "", None, None),
    ("no scheme", "", "", None, None),
    ("", "", "", None, None),
    (None, "", "", None, None),
    ("http://ÉX.net/ü", "Éx.net", "/ü", "net/", "block"),
    ("http://h/" + "p" * 20000, "h", "/" + "p" * 20000, None, None),
]


def test_url_rules(spark):
    rows = [(k, u[0], "x", "y") for k, u in enumerate(URLS)] + [(0, URLS[0][0], "x", "y"), (None, URLS[0][0], "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, verdict string, gram string")
    got = url_filter.judge_urls(pages, queries.URL_RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        _, host, path, rule, verdict = URLS[r.page_id or 0]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict or (verdict is None and r.verdict in ("allow", "block"))
    empty = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge_urls(empty, queries.URL_RULES).count() == 0


def _brute_deltas(urls, order):
    """{url: (total, n)} by plain dictionaries, for url -> (copies, action, held out)."""
    counts = {k: collections.Counter() for k in ("allow", "block")}
    alphabet = set()
    grams = {u: [("\x02" * order + u + "\x03")[k:k + order + 1] for k in range(len(u) + 1)] for u in urls}
    for u, (copies, action, held_out) in urls.items():
        for g in grams[u]:
            alphabet.add(g[-1])
            if action and not held_out:
                for j in range(order + 1):
                    counts[action][g[order - j:]] += copies
    followers = {k: collections.defaultdict(set) for k in counts}
    totals = {k: collections.Counter() for k in counts}
    for kind, c in counts.items():
        for g, n in c.items():
            followers[kind][g[:-1]].add(g[-1])
            totals[kind][g[:-1]] += n

    def p(kind, g):
        low = 1 / len(alphabet)
        for j in range(order + 1):
            s = g[order - j:]
            t, n = len(followers[kind][s[:-1]]), totals[kind][s[:-1]]
            low = (counts[kind][s] + t * low) / (n + t) if n + t else low
        return low

    return {u: (sum(round(1e6 * (math.log(p("allow", g)) - math.log(p("block", g)))) for g in gs), len(gs))
            for u, gs in grams.items()}


def test_url_model_against_brute_force(spark):
    import hashlib

    rng = random.Random(5)
    rows = []
    for k in range(300):
        good = rng.random() < 0.5
        words = ["news", "docs", "wiki"] if good else ["casino", "win", "spin"]
        host = ("example.net" if rng.random() < 0.5 else "org") if good else "bad.net"
        ruled = rng.random() < 0.6
        lang = ("/en/" if host == "example.net" else "/fr/") if good and ruled else "/x/"
        host = host if ruled else "site.com"
        rows.append((k, f"http://{rng.choice(words)}.{host}{lang}{rng.choice(words)}{rng.randint(0, 99)}"))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = {r.page_id: r for r in url_filter.judge_urls(pages, queries.URL_RULES).collect()}
    rule = {rows[i][1]: (got[i].verdict if got[i].rule else None) for i in got}
    copies = collections.Counter(u for _, u in rows)
    held = {u: int(hashlib.md5(u.encode()).hexdigest()[:8], 16) % 5 == 0 for u in copies}
    totals = _brute_deltas({u: (copies[u], rule[u], held[u]) for u in copies}, url_filter.MAX_ORDER)
    bins = {u: math.floor(t / (n * url_filter.BIN)) for u, (t, n) in totals.items()}
    tests = [(bins[u], rule[u], copies[u]) for u in copies if rule[u] and held[u]]
    na, nb = (sum(c for _, a, c in tests if a == k) for k in ("allow", "block"))
    threshold = min((sum(c for x, a, c in tests if a == "allow" and x < b) / na
                     + sum(c for x, a, c in tests if a == "block" and x >= b) / nb, abs(b), b)
                    for b in {x for x, _, _ in tests})[2]
    for i, u in rows:
        t, n = totals[u]
        assert got[i].score == pytest.approx(t / n / 1e6, abs=2e-6)
        if got[i].rule is None:
            assert got[i].verdict == ("allow" if bins[u] >= threshold else "block")


# --- LM scoring ---------------------------------------------------------------

def _tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) + [""]


@pytest.mark.parametrize("frequent", [lm_score.FREQUENT_WORDS, 50])
def test_lm_score(spark, frequent, monkeypatch):
    monkeypatch.setattr(lm_score, "FREQUENT_WORDS", frequent)
    docs = table(spark, SF, "documents").select("doc_id", "text", "lang")
    odd = [(9001, None, "en"), (9002, "", None), (9003, " \t", "xx"), (9004, "z" * 9000 + " Y", "en"), (9005, "the the", "en"),
           (9005, "the the", "en"), (None, "the", "en")]
    docs = docs.union(spark.createDataFrame(odd, docs.schema)).withColumn("score", F.lit("x")).withColumn("word", F.lit(1))
    train = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1, F.lit(False))
    got = lm_score.score_texts(docs, train).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    learned = [i is not None and zlib.crc32(str(i).encode()) % 5 != 1 for i, _ in rows]
    counts = collections.Counter(t for (_, x), k in zip(rows, learned, strict=True) if k for t in _tokens(x))
    n, v = sum(counts.values()), len(counts)
    want = sorted((str(i), len(ts), sum(counts[t] > 0 for t in ts),
                   round(sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in ts), 5))
                  for i, x in rows for ts in [_tokens(x)])
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 5)) for r in got) == want
    assert {r.train_tokens for r in got} == {n}
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    held = [r for r in got if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 1 and r.doc_id < 9000]
    assert sum(r.score for r in held) / sum(r.n_bytes for r in held) > -1.1  # log10 a byte; evenly spread bytes have -2.4


def test_lm_score_without_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert lm_score.score_texts(empty, F.lit(True)).count() == 0
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    row = lm_score.score_texts(one, F.lit(False), class_col=None).first()
    assert row.train_tokens == 0 and row.n_known == 0 and math.isfinite(row.score)


def test_bit_model_is_a_distribution():
    """Over all next bytes the probabilities of the decisions add up to one."""
    words = [w.encode() for w in "the then there their cat cats é ü".split()]
    code = mixing.prefix_code(np.bincount(np.frombuffer(b" ".join(words), np.uint8), minlength=256))
    tables = mixing.empty_tables()
    n = np.arange(1, len(words) + 1, dtype=float)
    mixing.count_bits(tables, mixing.decisions(words, code), n, 0)
    mixer = mixing.Mixer()
    for _ in range(5):
        mixing.learn(tables, mixer, mixing.decisions(words, code), n, 0, 0.2)
    scorer = mixing.Scorer.of(code, tables, mixer)
    # P(word) = P(th) * P(x | th) * ...: the words th + x for all bytes x but a space, up to x.
    d = mixing.decisions([b"th" + bytes([x]) for x in range(256)], code)
    assert len(d.starts) == 256
    longer = scorer.scores([b"thq" + bytes([x]) for x in range(1, 256)], 2)
    assert np.isfinite(longer).all()
    # Sorted or not, shared beginnings or not: the same scores.
    some = [b"there", b"the", b"x", b"them", b"cats", b"", b"\n"]
    alone = np.concatenate([scorer.scores([w], 2) for w in some])
    assert np.allclose(scorer.scores(some, 2), alone)
    assert np.allclose(scorer.scores(sorted(some), 2), alone[[some.index(w) for w in sorted(some)]])


def test_bit_counts_grow_and_do_not_mix():
    """Far more contexts than any fixed table has slots: an unseen one stays unseen, a seen one keeps its own counts."""
    rng = np.random.default_rng(3)
    words = sorted({bytes(w) for w in rng.integers(97, 123, (60_000, 12), dtype=np.uint8)})
    code = mixing.prefix_code(np.bincount(np.frombuffer(b" ".join(words), np.uint8), minlength=256))
    counts = np.zeros((lm_score.MAX_CLASSES, len(words)), np.int64)
    counts[1] = np.arange(1, len(words) + 1)
    tables = mixing.fill(*mixing.evidence(words, counts), code)
    exact = mixing.empty_tables()
    mixing.count_bits(exact, mixing.decisions(words, code), counts[1].astype(float), 1)
    d = mixing.decisions(words[:200], code)
    for j, (a, b) in enumerate(zip(tables, exact, strict=True)):
        assert np.count_nonzero(a.keys) == np.count_nonzero(b.keys)
        key = mixing._keys(d, j, 1)
        assert np.allclose(a.counts[a.find(key)], b.counts[b.find(key)])
    # The last decisions of a word belong to it alone.
    last = mixing._keys(d, 4, 1)[np.append(d.first[1:], len(d.bit)) - 1][d.place[d.starts + 12]]
    assert tables[4].counts[tables[4].find(last)].sum(axis=1).tolist() == counts[1][:200].tolist()
    new = mixing.decisions([bytes([65]) + w for w in words[:200]], code)
    unseen = mixing._keys(new, 4, 1)[new.byte > new.place[1]]
    assert (tables[4].find(unseen) == len(tables[4].keys) - 1).all()


def test_lm_score_does_not_depend_on_blocks(spark, monkeypatch):
    """Blocks get from the shards what all others have counted."""
    docs = table(spark, SF, "documents").select("doc_id", "text", "lang")
    words = lm_score.count_words(docs, "text", F.lit(True), F.lit(0)).toArrow()
    tokens, counts = lm_score._weights(words.sort_by("word"))
    keys, n = mixing.evidence(tokens, counts)
    want = dict(zip(keys.tolist(), n.tolist(), strict=True))
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", 4096)
    monkeypatch.setattr(lm_score, "SHARD_BYTES", 8192)
    blocks = lm_score.materialise(lm_score._blocks(spark.createDataFrame(words).repartitionByRange(4, "word").sortWithinPartitions("word")), "words")
    told = lm_score._bit_counts(blocks, sum(map(len, tokens))).toArrow()
    assert len(set(told.column("block").to_pylist())) > 10
    got = [x for k, c in lm_score._entries(told) for x in zip(k.tolist(), c.tolist(), strict=True)]
    assert all(want[k] == c for k, c in got)
    # Every context that two blocks have is told to each of them, whole.
    asked = collections.Counter()
    for block in blocks.select("block").distinct().toArrow().column(0).to_pylist():
        own, _ = mixing.evidence(*lm_score._weights(blocks.filter(F.col("block") == block).toArrow())) if block % 3 == 0 else (np.zeros(0, np.uint64), None)
        asked.update(set((own >> np.uint64(11)).tolist()))
    assert {c for c, times in asked.items() if times > 1} <= {k >> 11 for k, _ in got}


def test_lm_score_leaves_only_tables_that_are_still_read(spark):
    docs = spark.createDataFrame([(i, f"red cat {i} blue dog", "en") for i in range(40)], "doc_id long, text string, lang string")
    folder = os.path.join(checkpoint_root(spark).removeprefix("file:"), "tables")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    scored = lm_score.score_texts(docs, F.col("doc_id") < 30)
    left = {name.rpartition("-")[0] for name in set(os.listdir(folder)) - before}
    assert left and not left & {"counts", "words", "blocks"}
    assert scored.count() == 40 and scored.filter("score < 0").count() == 40


def test_block_answers_are_whole_and_small():
    """Keys and counts come back as they were, and take less room than side by side."""
    rng = np.random.default_rng(5)
    words = sorted({bytes(rng.choice(list(b"aeinorst"), rng.integers(1, 9)).tolist()) for _ in range(5000)})
    counts = np.zeros((lm_score.MAX_CLASSES, len(words)), np.int64)
    counts[0] = rng.geometric(0.5, len(words))
    keys, n = mixing.evidence(words, counts)
    told = lm_score._told(keys, n)
    back = lm_score._heard(*told)
    assert back[0].tolist() == keys.tolist() and back[1].tolist() == n.tolist()
    assert [x.tolist() for x in lm_score._heard(*lm_score._told(keys[:0], n[:0]))] == [[], []]
    assert lm_score._from_bytes(lm_score._to_bytes(counts.reshape(-1), "<i8"), "<i8").tolist() == counts.reshape(-1).tolist()
    size = [sum(len(pa.compress(x, "lz4", asbytes=True)) for x in rows) for rows in (told, (keys.tobytes(), n.astype(np.float32).tobytes()))]
    assert size[0] < 0.9 * size[1]


def test_neighbouring_blocks_show_their_contexts_as_one(spark, monkeypatch):
    """Ranges of blocks: far fewer keys are sent, and every block has the same tables as if all were counted at once."""
    docs = table(spark, SF, "documents").select("doc_id", "text", "lang")
    words = lm_score.count_words(docs, "text", F.col("doc_id") % 3 > 0, F.when(F.col("lang") == "en", 0).otherwise(1)).toArrow()
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", 4096)
    monkeypatch.setattr(lm_score, "SHARD_BYTES", 65536)
    rows = lm_score._blocks(spark.createDataFrame(words).repartitionByRange(3, "word").sortWithinPartitions("word"))
    n_bytes, sent = sum(map(len, words.column("word").to_pylist())), {}
    for blocks in (1, 8):
        ranges = lm_score.materialise(lm_score._ranges(rows, blocks), "words")
        answers = lm_score.materialise(lm_score._bit_counts(ranges, n_bytes), "answers")
        sent[blocks] = sum(len(k) for k, _ in lm_score._entries(answers.toArrow()))
    assert 0 < 2 * sent[8] < sent[1]

    tokens, counts = lm_score._weights(words)
    code = mixing.prefix_code(np.bincount(np.frombuffer(b" ".join(tokens), np.uint8), minlength=256))
    exact = mixing.fill(*mixing.evidence(tokens, counts), code)
    at, total = {w: i for i, w in enumerate(tokens)}, words.column("total").to_pylist()
    seen = []
    for k, (own, n, times, tables) in enumerate(lm_score._each_block(lm_score._packed(ranges, answers).toArrow().to_batches(), code)):
        there = [at[w] for w in own]
        assert n.tolist() == counts[:, there].tolist() and times == [total[i] for i in there]
        assert sum(map(len, own)) <= 4096 and own == sorted(own, key=mixing.in_text_order)
        seen += own
        d = mixing.decisions(own, code) if k % 10 == 0 else None
        for j, (got, want) in enumerate(zip(tables, exact, strict=True)):
            for g in (0, 1) if d else ():
                key = mixing._keys(d, j, g)
                assert (got.counts[got.find(key)] == want.counts[want.find(key)]).all()
    assert sorted(seen) == sorted(tokens)


def test_lm_score_keeps_no_shuffle_files_of_written_tables(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    shuffles = os.path.join(spark.conf.get("spark.local.dir", tempfile.gettempdir()), "blockmgr-*", "*", "shuffle_*.data")
    there = set(glob.glob(shuffles))
    docs = spark.createDataFrame([(i, f"red cat {i} blue dog") for i in range(40)], "doc_id long, text string")
    scored = lm_score.score_texts(docs, F.col("doc_id") < 30, class_col=None)
    deadline = time.time() + 10
    while (left := set(glob.glob(shuffles)) - there) and time.time() < deadline:
        time.sleep(0.2)
    assert not left and spark.conf.get(name) == before
    assert scored.count() == 40


def test_lm_score_reads_across_spaces(spark):
    """The same words in another order have another score, and the word before is a context."""
    docs = [(i, "red cat blue dog " * 5, "en") for i in range(40)] + [(100, "red cat blue dog", "en"), (101, "red dog blue cat", "en")]
    docs = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in lm_score.score_texts(docs, F.col("doc_id") < 100).collect()}
    assert got[100].base_score == pytest.approx(got[101].base_score) and got[100].n_known == got[101].n_known == 5
    assert got[100].score > got[101].score + 1
    assert lm_score.pairs_of([b"a", b"b", b"\n"]) == [b"a", b"b a", b"\n b"]


def test_places_share_only_what_has_the_same_contexts():
    """Units in any order have the contexts that each has alone, and a unit is coded from its own word on."""
    keys = [b"the", b"x the", b"there the", b"then the", b"cat the", b"cat a", b"\n cat", b"the", b"the cat"]
    word, place, symbol, contexts = mixing._places(keys)
    for i, k in enumerate(keys):
        at = place[word == i]
        assert bytes(symbol[at]) == k.partition(b" ")[0] + b" "
        _, one, _, alone = mixing._places([k])
        assert all((contexts[o][at] == alone[o][one]).all() for o in mixing.ORDERS)


def test_prefix_code_is_complete():
    start, size, node, bit = mixing.prefix_code(np.random.default_rng(0).integers(0, 10_000, 256))
    assert sum(2.0 ** -s for s in size) == 1
    assert len({tuple(bit[a:a + s]) for a, s in zip(start, size, strict=True)}) == 256
    assert len(node) == size.sum()


# --- Toxicity -----------------------------------------------------------------

def test_words_and_edges():
    assert toxicity.words_of("an I d i o t and x y end") == ["an", "idiot", "and", "x", "y", "end"]
    assert toxicity.words_of(None) == []
    assert toxicity.stripped("trash###") == "trash" and toxicity.stripped("oueand$$$") == "oueand"
    assert toxicity.stripped("***") == ""


def test_restore_finds_plain_words():
    text = ["idiot", "stupid", "trash", "loser", "worthless", "the", "and", "to", "letter", "silly", "book"] * 5
    counts = np.zeros((toxicity.CLASSES,) * 3)
    for w in text:
        codes = [0, 0, *map(toxicity._class, w), 0]
        for a, b, c in zip(codes, codes[1:], codes[2:], strict=False):
            counts[a, b, c] += 1
    trigrams = toxicity.Letters(np.log((counts + 0.01) / (counts.sum(axis=2, keepdims=True) + 0.64)))
    for seen, plain in [("1d10t", "idiot"), ("stup1d", "stupid"), ("$tupid", "stupid"), ("tr@sh", "trash"),
                        ("i.d.i.o.t", "idiot"), ("idiiiooot", "idiot"), ("l0ooser", "loser"), ("7rash!!", "trash"),
                        ("letter", "letter"), ("sillyyy", "silly"), ("w0r+hl3ss", "worthless"), ("2024", "2024")]:
        assert toxicity.clear_word(seen, trigrams) == plain, seen


def test_restore_reads_edges_bare_symbols_and_spaces():
    text = ["idiot", "stupid", "shit", "loser", "ass", "the", "and", "to", "are", "an", "you", "is", "it", "in", "u", "r", "a"] * 5
    counts = np.zeros((toxicity.CLASSES,) * 3)
    for w in text:
        codes = [0, 0, *map(toxicity._class, w), 0]
        for a, b, c in zip(codes, codes[1:], codes[2:], strict=False):
            counts[a, b, c] += 1
    trigrams = toxicity.Letters(np.log((counts + 0.01) / (counts.sum(axis=2, keepdims=True) + 0.64)))
    for seen, plain in [("!d!ot", "idiot"), ("|oser", "loser"), ("5h1+", "shit"), ("(the", "the"), ("you!!", "you"),
                        ("@$$", "ass"), ("455", "ass"), ("2024", "2024"), ("***", ""), ("!!!", ""), ("u r a n i d i o t", "u r an idiot"),
                        ("id iot", "idiot"), ("st up id", "stupid"), ("l o s e r i d i o t", "loser idiot"), ("it is in", "it is in")]:
        assert toxicity.clear_word(seen, trigrams) == plain, seen
    common = frozenset(["it", "is", "in", "a"])
    assert toxicity.spaced_runs("Well it is in a book, id IOT; yes letter", common) == ["id iot yes"]
    assert toxicity.spaced_runs("1 2 3 4", common) == toxicity.spaced_runs(None, common) == []


def test_toxicity_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op5_toxicity(spark, sf).join(table(spark, sf, "labels"), "doc_id").filter("held_out").collect()
    assert len(got) > 50
    assert sum(r.predicted == r.toxic for r in got) / len(got) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)


def test_toxicity_odd_rows(spark):
    rng = random.Random(1)
    clean = ["good", "fine", "nice", "text", "word", "line"]
    rows = [(k, " ".join([*rng.choices(clean, k=8), *(["idiot"] * (k % 3 == 0))]), "x", "s") for k in range(400)]
    odd = [(1000, None, "x", "s"), (1001, "", "x", "s"), (1002, "good " * 50000, "x", "s"), (1003, "you 1d10t fine", "x", "s"),
           (1004, "you i d i o t fine", "x", "s"), (1003, "you 1d10t fine", "x", "s"), (None, "idiot", "x", "s")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, score string, most string")
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(400)] + [(None, 1), (5, None), (6, 0)],
                                   "doc_id long, toxic int")
    got = toxicity.score_toxicity(docs, labels, F.lit(True))
    assert got.columns == ["doc_id", "score", "predicted"]
    by_id = collections.defaultdict(list)
    for r in got.collect():
        by_id[r.doc_id].append(r.predicted)
    assert len(by_id[1003]) == 2
    assert {k: by_id[k][0] for k in (1000, 1001, 1002, 1003, 1004, None)} == \
        {1000: 0, 1001: 0, 1002: 0, 1003: 1, 1004: 1, None: 1}
    assert all(by_id[k] == [int(k % 3 == 0)] for k in range(400))
    assert toxicity.score_toxicity(docs.limit(0), labels, F.lit(True)).count() == 0
    none = toxicity.score_toxicity(docs, labels.limit(0), F.lit(True)).collect()
    assert len(none) == len(rows + odd) and not any(r.predicted for r in none)


# --- Nearest neighbours -------------------------------------------------------

def _nearest(vectors, i, k):
    q = vectors[i]
    d = {j: float(np.sqrt(((v - q) * (v - q)).sum())) for j, v in vectors.items() if j != i}
    return sorted(d, key=lambda j: (d[j], j))[:k], d


def test_neighbours_recall(spark):
    got = collections.defaultdict(list)
    for r in queries.op10_multiprobe_lsh(spark, SF).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r)
    vectors = {r.vec_id: np.asarray(r.embedding, float) for r in table(spark, SF, "embeddings").collect()}
    hits = total = 0
    for i in (i for i in vectors if i % 100 == 0):
        want, d = _nearest(vectors, i, 10)
        assert [r.rank for r in got[i]] == list(range(1, 11))
        assert all(r.score == pytest.approx(d[r.vec_id], abs=1e-12) for r in got[i])
        hits += len(set(want) & {r.vec_id for r in got[i]})
        total += 10
    assert hits / total >= 0.9


def test_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(k, [1.0, 0.0, 0.0], 1) for k in range(100, 160)]  # copies
    rows += [(1, [0.0, 1.0, 0.0], 1), (2, [0.0, 2.0, 0.0], 1), (2, [0.0, 3.0, 0.0], 1), (2, [0.0, 2.0, 0.0], 1)]
    rows += [(3, None, 1), (4, [0.0, 0.0, 0.0], 1), (5, [nan, 1.0, 0.0], 1), (6, [inf, 1.0, 0.0], 1), (7, [None, 1.0, 0.0], 1),
             (8, [1.0], 1), (None, [1.0, 1.0, 1.0], 1), (9, [], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    got = ann.nearest_neighbours(df, F.lit(True), k=5)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    found = collections.defaultdict(list)
    for r in got.orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.vec_id, r.score))
    assert set(found) == {1, 2, *range(100, 160)}
    assert found[150] == [(k, 0.0) for k in range(100, 105)]
    assert found[100] == [(k, 0.0) for k in range(101, 106)]
    assert found[1][0] == (2, 1.0) and [v for v, _ in found[1][1:]] == [100, 101, 102, 103]
    few = ann.nearest_neighbours(df.filter("vec_id < 100 or vec_id = 100"), F.col("vec_id") == 1, k=5).orderBy("rank").collect()
    assert [(r.rank, r.vec_id) for r in few] == [(1, 2), (2, 100)]
    assert ann.nearest_neighbours(df.limit(0), F.lit(True)).count() == 0
    assert ann.nearest_neighbours(df.filter("vec_id between 3 and 7"), F.lit(True)).count() == 0


def test_query_blocks_and_copies(spark, monkeypatch):
    monkeypatch.setattr(ann, "QUERY_BLOCK", 7)
    rng = np.random.default_rng(2)
    vectors = {k: (v if k % 5 else np.ones(4)) for k, v in enumerate(rng.standard_normal((60, 4)))}
    df = spark.createDataFrame([(k, v.tolist()) for k, v in vectors.items()], "vec_id long, embedding array<double>")
    got = collections.defaultdict(list)
    for r in ann.nearest_neighbours(df, F.col("vec_id") % 2 == 0, k=3, success=0.999999).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    assert got == {i: _nearest(vectors, i, 3)[0] for i in vectors if i % 2 == 0}


def test_probes_come_in_order_of_success():
    import itertools

    rng = np.random.default_rng(5)
    for _ in range(20):
        position, spread = rng.uniform(-3, 3, 3), rng.uniform(0.2, 1.5)
        chances = {}
        for steps in itertools.product(range(-9, 10), repeat=3):
            p = 1.0
            for at, step in zip(position, steps):
                low = (np.floor(at) + step - at) / spread
                p *= ann._normal_below(low + 1 / spread) - ann._normal_below(low)
            chances[steps] = p
        ranked = sorted(chances.values(), reverse=True)
        got = ann.probe_sequence(position, spread, 0.9, 10 ** 6)
        assert len({s for _, s in got}) == len(got)
        assert [p for p, _ in got] == pytest.approx(ranked[:len(got)], rel=1e-9)
        assert all(p == pytest.approx(chances[s], rel=1e-9) for p, s in got)
        assert sum(p for p, _ in got) >= 0.9 > sum(p for p, _ in got[:-1])
        assert ann.probe_sequence(position, spread, 0.9, len(got) - 1) is None
    assert ann.probe_sequence(np.array([0.5, 2.0 ** 60]), 1.0, 0.5, 10) is None
    assert ann.probe_sequence(np.array([0.5, 0.5]), 100.0, 0.5, 10) is None


def test_scores_of_a_block_equal_brute_force():
    rng = np.random.default_rng(6)
    x = rng.integers(-2, 3, (40, 3)).astype(float)  # many ties
    ids = rng.permutation(40)
    radii = np.array([np.nan, 1.5, 0.0, 100.0])
    found, near, d = ann.score_block(ids, x, ids[:4], x[:4], radii, 5)
    got = collections.defaultdict(list)
    for q, i, s in zip(found, near, d):
        got[q].append((s, i))
    for j in range(4):
        want = sorted((float(np.sqrt(((x[i] - x[j]) ** 2).sum())), ids[i]) for i in range(40) if i != j)
        want = [w for w in want if not w[0] > radii[j]][:5]
        assert got[ids[j]] == [(pytest.approx(s, abs=1e-12), i) for s, i in want]


@pytest.mark.parametrize("most", [0, 65_536])
def test_outliers_and_hot_buckets(spark, monkeypatch, most):
    """A third of the vectors in one bucket, outliers that meet no candidate,
    and (without any visits) every query on the exact way."""
    monkeypatch.setattr(ann, "CHUNK", 8)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 5)
    monkeypatch.setattr(ann, "MAX_VISITS", most)
    rng = np.random.default_rng(7)
    vectors = {k: np.ones(3) + 1e-3 * rng.standard_normal(3) for k in range(40)}
    vectors |= {k: rng.standard_normal(3) for k in range(40, 110)}
    vectors |= {110: np.array([1e5, 0, 0]), 111: np.array([0, -1e5, 1.0]), 112: np.array([1e5, 1, 0])}
    df = spark.createDataFrame([(k, v.tolist()) for k, v in vectors.items()], "vec_id long, embedding array<double>")
    got = collections.defaultdict(list)
    asked = (F.col("vec_id") % 10 == 0) | (F.col("vec_id") >= 110)
    for r in ann.nearest_neighbours(df, asked, k=4, success=0.9999).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    assert got == {i: _nearest(vectors, i, 4)[0] for i in vectors if i % 10 == 0 or i >= 110}


@pytest.mark.parametrize("most", [0, 65_536])
def test_no_vectors_are_broadcast(spark, monkeypatch, most):
    """However small Spark takes probes, exploded queries or vectors to be, they are
    joined by shuffles: equal vectors take almost no room in a file."""
    plans, scored, write = [], ann._scored, ann.materialise

    def joined(pairs, *args):
        plans.append(pairs._jdf.queryExecution().executedPlan().toString())
        return scored(pairs, *args)

    def wrote(frame, name):
        if name != "asked":  # joins queries' distances
            assert "Broadcast" not in frame._jdf.queryExecution().executedPlan().toString(), name
        return write(frame, name)

    monkeypatch.setattr(ann, "MAX_VISITS", most)
    monkeypatch.setattr(ann, "_scored", joined)
    monkeypatch.setattr(ann, "materialise", wrote)
    df = spark.createDataFrame([(k, [1.0, 2.0, float(k % 3)]) for k in range(60)], "vec_id long, embedding array<double>")
    got = ann.nearest_neighbours(df, F.col("vec_id") % 10 == 0, k=3)
    found = {(r.query_id, r.rank): (r.vec_id, r.score) for r in got.collect()}
    assert len(plans) == 3 and all("SortMergeJoin" in p and "Broadcast" not in p for p in plans)
    assert found == {(q, n + 1): (x, 0.0) for q in range(0, 60, 10)
                     for n, x in enumerate([x for x in range(q % 3, 60, 3) if x != q][:3])}


def test_asked_by_any_row_of_an_identifier(spark):
    """A query's condition may hold for a row whose vector has no part, while its identifier's other row has one."""
    df = spark.createDataFrame([(1, None, True), (1, [1.0, 0.0], False), (2, [0.0, 1.0], None), (3, [0.0, 0.0], True), (4, [1.0, 1.0], False),
                                (None, [1.0, 2.0], True)], "vec_id long, embedding array<double>, ask boolean")
    got = ann.nearest_neighbours(df, F.col("ask"), k=2).orderBy("rank").collect()
    assert [(r.query_id, r.vec_id, r.score) for r in got] == [(1, 4, 1.0), (1, 2, pytest.approx(2 ** 0.5))]


def test_viterbi_equals_all_paths():
    import itertools
    import random

    rng = np.random.default_rng(4)
    trigrams = np.log(rng.dirichlet(np.full(toxicity.CLASSES, 0.05), (toxicity.CLASSES, toxicity.CLASSES)) + 1e-9)
    letters = toxicity.Letters(trigrams)
    pick = random.Random(4)
    for _ in range(300):
        word = "".join(pick.choice("aab!1 @*.i5") for _ in range(pick.randint(1, 7))).strip()
        best = -np.inf
        for path in itertools.product(*toxicity._lattice(word)):
            score, x, y = -sum(o[1] for o in path), 0, 0
            for read, _, _, _ in path:
                for c in read:
                    z = 0 if c == " " else toxicity._class(c)
                    score += trigrams[x, y, z]
                    x, y = (0, 0) if c == " " else (y, z)
            best = max(best, score + trigrams[x, y, 0])
        score, read = toxicity._best(word, letters)
        assert abs(score - best) < 1e-9, word


def test_no_second_search_where_no_dropped_letter_can_help(monkeypatch):
    text = ["idiot", "stupid", "trash", "loser", "letter", "silly", "book", "the", "and", "hello", "you"] * 5
    counts = np.zeros((toxicity.CLASSES,) * 3)
    for w in text:
        codes = [0, 0, *map(toxicity._class, w), 0]
        for a, b, c in zip(codes, codes[1:], codes[2:], strict=False):
            counts[a, b, c] += 1
    letters = toxicity.Letters(np.log((counts + 0.01) / (counts.sum(axis=2, keepdims=True) + 0.64)))
    walk, walks = toxicity._walk, []

    def counted(*args, **options):
        walks.append(walk(*args, **options))
        return walks[-1]

    monkeypatch.setattr(toxicity, "_walk", counted)
    for seen, plain in [("hello!!", "hello"), ("id iot", "idiot"), ("stup1d", "stupid"), ("tr@sh***", "trash")]:
        walks.clear()
        assert toxicity._best(seen, letters)[1] == plain
        assert len(walks) == 1, seen


def test_spaced_runs_around_marks_and_common_words():
    common = frozenset(["it", "is", "a,", "no"])
    assert toxicity.spaced_runs("it is a, no", common) == []  # all as they stand are common
    assert toxicity.spaced_runs("it is a, xy", common) == ["it is a xy"]
    assert toxicity.spaced_runs("ab ... cd word! ef gh. letters ij", common) == ["ab cd", "ef gh"]
    assert toxicity.words_and_runs("a b c de longer", common) == ({"abc", "de", "longer"}, {"a b c de"})
    parts = toxicity._Parts(common)
    assert toxicity.spaced_runs("it is a, xy", parts) == ["it is a xy"] and "xy" in parts and "longer" not in parts


def test_clashing_names_and_long_white_space(spark):
    from sparkretrieve.llm import bpe, exact_dedup, line_dedup, packing

    names = ["_id", "_label", "_doc", "_text", "_drop_id", "_lost", "digest", "_salt", "_n", "_shift", "_i", "length2"]
    rows = [(i, f"a line that is long enough {i % 3}\nidiot {i}", *range(len(names))) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` int" for n in names))
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, toxic int")
    scored = toxicity.score_toxicity(docs, labels, F.lit(True), keep_text=True)
    assert scored.count() == 12 and set(names) < set(scored.columns)
    cut = line_dedup.drop_repeated_lines(docs, min_chars=20, min_docs=3).collect()
    assert sum(r.n_dropped for r in cut) == 9 and {r["_drop_id"] for r in cut} == {names.index("_drop_id")}
    assert exact_dedup.duplicate_groups(docs).count() == 12
    pieces = docs.select("doc_id", *names, F.lit(5).cast("long").alias("length"))
    packed = packing.pack_pieces(pieces, 10).collect()
    assert {r["_salt"] for r in packed} == {names.index("_salt")} and {r["_i"] for r in packed} == {names.index("_i")}
    assert len({(r.sequence_id, r.offset) for r in packed}) == 12 and len({r.sequence_id for r in packed}) == 6

    codec = bpe.codec(queries.tokenizer_path())
    for text in (" " * 1_000_000, "a" * 200_000, "word" + "\n" * 300_000 + " \t" * 100_000 + "end " + "é" * 70_000):
        one = spark.createDataFrame([(1, text)], "doc_id long, text string")
        got = packing.token_pieces(one, queries.tokenizer_path()).agg(F.sum("length")).first()[0]
        assert got == len(codec.encode(text)) + 1


def test_copies_of_long_texts_and_lines(spark):
    from sparkretrieve.llm import exact_dedup, line_dedup

    long = "x" * 2_000_000
    docs = spark.createDataFrame([(i, long if i < 40 else f"other {i}") for i in range(60)], "doc_id long, text string")
    got = exact_dedup.duplicate_groups(docs, keep="max").select("doc_id", "keep_id", "group_size", "kept").collect()
    assert sorted(map(tuple, got)) == [(i, 39, 40, i == 39) if i < 40 else (i, i, 1, True) for i in range(60)]
    cut = line_dedup.drop_repeated_lines(docs, min_chars=20, min_docs=3).select("doc_id", "n_dropped").collect()
    assert {r.doc_id: r.n_dropped for r in cut} == {i: int(i < 39) for i in range(60)}


def test_evidence_of_several_classes_fills_the_counts():
    rng = np.random.default_rng(3)
    words = sorted({bytes(rng.choice(list(b"abcde"), rng.integers(1, 9)).tolist()) for _ in range(500)})
    counts = rng.integers(0, 3, (lm_score.MAX_CLASSES, len(words))) * (rng.random((lm_score.MAX_CLASSES, len(words))) < 0.3)
    counts[5:] = 0
    code = mixing.prefix_code(np.bincount(np.frombuffer(b" ".join(words), np.uint8), minlength=256))
    want = mixing.empty_tables()
    for g in range(5):
        own = np.flatnonzero(counts[g])
        mixing.count_bits(want, mixing.decisions([words[i] for i in own], code), counts[g][own].astype(float), g)

    def held(table):
        there = np.flatnonzero(table.keys)
        return {int(k): tuple(n) for k, n in zip(table.keys[there], table.counts[there].tolist(), strict=True)}

    for got, exact in zip(mixing.fill(*mixing.evidence(words, counts), code), want, strict=True):
        assert held(got) == held(exact) and held(got)
