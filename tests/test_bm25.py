import pytest
from pyspark.sql import functions as F

from sparkretrieve.functions.text import tokenize
from sparkretrieve.operators import bm25


def _chunks(spark, texts):
    rows = [(f"chunk_{i + 1}", f"doc_{i + 1}", f"T{i + 1}", t, {}) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "chunk_id string, document_id string, title string, text string, "
                                       "metadata map<string,string>")


def _queries(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "query_id long, query string")


def test_tokenizer_golden(spark):
    df = spark.createDataFrame([("Oslo, tag QX-7/b.9: $12 ünöb",)], "t string")
    assert df.select(tokenize("t").alias("x")).first().x == ["oslo", "tag", "qx-7/b.9:", "$12", "n", "b"]


def test_best_of_two(spark):
    chunks = _chunks(spark, ["Harbour lights guide night ferries.", "Maples turn red early up north."])
    res = bm25.bm25_search(chunks, _queries(spark, "night guide"), top_k=1).collect()
    assert [r.chunk_id for r in res] == ["chunk_1"]
    assert res[0].score == pytest.approx(0.0)
    assert res[0].overlap == 2


def _scores(spark, texts, query):
    chunks = _chunks(spark, texts)
    res = bm25.bm25_search(chunks, _queries(spark, query), top_k=10).orderBy("rank").collect()
    return [(r.chunk_id, round(r.score, 5), r.overlap) for r in res]


def test_single_chunk_negative_score_still_returned(spark):
    # One chunk of one word each: raw idf = ln(0.5) - ln(1.5), below zero, so idf
    # is a quarter of the mean, which is the same number; tf part is 1.
    assert _scores(spark, ["lighthouse keeper"], "keeper") == [("chunk_1", -0.27465, 1)]


def test_three_chunks_golden(spark):
    got = _scores(spark, ["a x", "a y", "a z"], "a x")
    assert got == [("chunk_1", 0.48499, 2), ("chunk_2", -0.02584, 1), ("chunk_3", -0.02584, 1)]


def test_repeated_query_terms_and_ties(spark):
    got = _scores(spark, ["red fox jumps", "red dog sleeps", "blue fox", "green bird sings loud"], "red fox fox")
    assert got == [("chunk_1", 0.0, 2), ("chunk_2", 0.0, 1), ("chunk_3", 0.0, 1)]


def test_mean_idf(spark):
    chunks = _chunks(spark, ["a x", "a y", "a z"])
    stats = bm25.build_bm25_index(chunks).stats.first()
    assert stats.mean_idf == pytest.approx(-0.103358, abs=1e-6)
    assert stats.n_chunks == 3 and stats.vocabulary == 4


def test_query_without_tokens_gives_nothing(spark):
    chunks = _chunks(spark, ["a x"])
    assert bm25.bm25_search(chunks, _queries(spark, "!!! ???"), top_k=3).count() == 0


def _rows(index, queries):
    return sorted((r.query_id, r.chunk_id, round(r.score, 9), r.overlap) for r in bm25.bm25_matches(index, queries).collect())


def test_blocks_of_queries_and_chunks_change_nothing(spark, monkeypatch):
    chunks = _chunks(spark, ["a x b", "a y", "a z z", "b b x", "", "q r s a"])
    queries = _queries(spark, "a x", "b z", "x x y", "nothing here")
    one = bm25.build_bm25_index(chunks.coalesce(1))
    many = bm25.build_bm25_index(chunks.repartition(4), term_buckets=3)
    want = _rows(one, queries)
    monkeypatch.setattr(bm25, "MAX_QUERY_TERMS", 2)
    assert _rows(many, queries) == want and len(want) == 11
    summary = {r.query_id: (r.matches, r.most_overlap) for r in bm25.match_summary(many, queries).collect()}
    assert summary == {q: (sum(w[0] == q for w in want), max(w[3] for w in want if w[0] == q)) for q in {w[0] for w in want}}


def test_repeated_chunk_id_is_an_error(spark):
    chunks = _chunks(spark, ["a x", "b"])
    with pytest.raises(ValueError, match="duplicate chunk_id: chunk_1"):
        bm25.build_bm25_index(chunks.unionByName(chunks.limit(1)))


def test_guards(spark):
    chunks = _chunks(spark, ["a"])
    with pytest.raises(ValueError, match="top_k must be greater than 0"):
        bm25.bm25_search(chunks, _queries(spark, "a"), top_k=0)
    with pytest.raises(ValueError, match="chunk_records cannot be empty"):
        bm25.build_bm25_index(chunks.limit(0), validate=True)


def test_search_reads_the_buckets_of_its_terms(spark):
    chunks = _chunks(spark, ["a x b", "a y", "a z z", "b b x", "q r s"])
    index = bm25.build_bm25_index(chunks, term_buckets=40)
    found = bm25.bm25_matches(index, _queries(spark, "q"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(term_bucket" in plan or "PartitionFilters: [(term_bucket" in plan
    assert [(r.chunk_id, r.overlap) for r in found.collect()] == [("chunk_5", 1)]


def test_late_fetch_reads_the_buckets_of_its_ids(spark, tmp_path):
    from sparkretrieve.sources.sinks import RecordTable, upsert_table

    chunks = _chunks(spark, [f"word{i} common" for i in range(30)])
    upsert_table(chunks, str(tmp_path / "chunks"), "chunk_id", bucket_bytes=400)
    table = RecordTable(spark, str(tmp_path / "chunks"))
    assert len(table.buckets) >= 8
    res = bm25.bm25_search(table, _queries(spark, "word7"), top_k=1, index=bm25.build_bm25_index(chunks))
    assert "dynamicpruning" in res._jdf.queryExecution().executedPlan().toString().lower()
    assert [(r.chunk_id, r.text) for r in res.collect()] == [("chunk_8", "word7 common")]


def _brute_force_bm25(chunks, query, k1=1.5, b=0.75, eps=0.25):
    """Plain-Python scorer written from the BM25 Okapi rules, for cross-checking."""
    import math
    import re
    from collections import Counter

    tok = lambda t: [x.lower() for x in re.findall(r"[A-Za-z0-9_.$:/-]+", t)]
    docs = {cid: tok(text) for cid, text in chunks}
    n = len(docs)
    avgdl = sum(len(d) for d in docs.values()) / n
    df = Counter(t for d in docs.values() for t in set(d))
    raw = {t: math.log(n - c + 0.5) - math.log(c + 0.5) for t, c in df.items()}
    mean = sum(raw.values()) / len(raw)
    idf = {t: (eps * mean if v < 0 else v) for t, v in raw.items()}
    q = tok(query)
    out = []
    for cid, d in docs.items():
        tf = Counter(d)
        overlap = len(set(q) & set(d))
        if not overlap:
            continue
        score = sum(idf.get(t, 0.0) * tf[t] * (k1 + 1) / (tf[t] + k1 * (1 - b + b * len(d) / avgdl)) for t in q)
        out.append((cid, score, overlap))
    out.sort(key=lambda r: (-round(r[1], 9), -r[2], r[0]))
    return out


def test_chunk_search_equals_brute_force(spark):
    from tests.conftest import SF001
    from sparkretrieve.operators import chunking
    from sparkretrieve.sources import corpus

    docs = corpus.canonical_documents(corpus.table(spark, SF001, "documents").orderBy("doc_id").limit(40))
    chunks = chunking.chunk_documents(docs, 300, 50).select("chunk_id", "document_id", "title", "text", "metadata")
    local = [(r.chunk_id, r.text) for r in chunks.collect()]
    bench = corpus.table(spark, SF001, "benchmark").orderBy("item_id").limit(5).collect()
    queries = spark.createDataFrame([(r.item_id, r.text) for r in bench], "query_id long, query string")
    got = bm25.bm25_search(chunks, queries, top_k=7).collect()
    for r in bench:
        expect = _brute_force_bm25(local, r.text)[:7]
        mine = sorted((x for x in got if x.query_id == r.item_id), key=lambda x: x.rank)
        assert [x.chunk_id for x in mine] == [e[0] for e in expect]
        assert [round(x.score, 6) for x in mine] == [round(e[1], 6) for e in expect]
        assert [x.overlap for x in mine] == [e[2] for e in expect]


def test_index_saved_once_and_reloaded(spark):
    chunks = _chunks(spark, ["a x b", "a y", "a z z", "b b x", ""])
    queries = _queries(spark, "a x", "b z")
    built = bm25.build_bm25_index(chunks, term_buckets=3)
    loaded = bm25.load_bm25_index(spark, built.path)
    assert loaded.stats.first().asDict() == built.stats.first().asDict()
    assert loaded.term_buckets == 3 and loaded.stats.first().n_chunks == 5
    assert _rows(loaded, queries) == _rows(built, queries)


def _many(spark, n=400):
    words = ["alpha", "beta", "gamma", "delta", "omega"]
    texts = [" ".join(words[:1 + i % 5]) + f" {'filler ' * (i % 7)}" + (" zygote" * (1 + i % 3) if 150 <= i < 165 else "") for i in range(n)]
    return _chunks(spark, texts).select("chunk_id", "text").repartitionByRange(4, F.length("chunk_id"), "chunk_id")


def _top(index, queries, k):
    found = bm25.rank_matches(bm25.bm25_matches(index, queries, top_k=k), k)
    return sorted((r.query_id, r.rank, r.chunk_id, round(r.score, 9), r.overlap) for r in found.collect())


def _top_of_all(index, queries, k):
    found = bm25.rank_matches(bm25.bm25_matches(index, queries), k)
    return sorted((r.query_id, r.rank, r.chunk_id, round(r.score, 9), r.overlap) for r in found.collect())


def test_blocks_that_cannot_hold_a_result_are_skipped(spark):
    index = bm25.build_bm25_index(_many(spark), block_chunks=20)
    queries = _queries(spark, "zygote alpha", "alpha", "omega filler", "zygote", "unknown")
    assert _top(index, queries, 5) == _top_of_all(index, queries, 5)
    seen = bm25.search_blocks(index, queries, 5).collect()
    rare = [r for r in seen if r.query_id == 0]
    assert len(rare) >= 20 and sum(not r.scored for r in rare) > len(rare) / 2
    # A query asks only for blocks that hold one of its terms.
    assert len([r for r in seen if r.query_id == 3]) <= 3 and not [r for r in seen if r.query_id == 4]


def test_ids_are_looked_up_in_the_blocks_of_the_result(spark):
    index = bm25.build_bm25_index(_many(spark), block_chunks=20)
    found = bm25.bm25_matches(index, _queries(spark, "zygote"), top_k=2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    blocks = plan[plan.index("ids#"):]
    assert "In(block" in plan or "EqualTo(block" in plan
    assert "Exchange hashpartitioning(block" not in blocks


def test_updated_index_equals_one_built_anew(spark):
    chunks = _many(spark)
    n = F.regexp_extract("chunk_id", r"(\d+)", 1).cast("int")
    first = chunks.filter(n % 4 != 0).withColumn("text", F.when(n % 3 == 0, F.lit("old words zygote")).otherwise(F.col("text")))
    extra = spark.createDataFrame([("gone_1", "alpha zygote zygote"), ("gone_2", "")], "chunk_id string, text string")
    old = bm25.build_bm25_index(first.union(extra), block_chunks=30)
    queries = _queries(spark, "zygote alpha", "old words", "omega delta beta")
    before = _top(old, queries, 7)
    index = bm25.update_bm25_index(old, chunks.filter((n % 4 == 0) | (n % 3 == 0)), removed=extra.select("chunk_id"))
    fresh = bm25.build_bm25_index(chunks, block_chunks=50)
    assert index.stats.first() == fresh.stats.first()
    terms = lambda i: sorted((r.term, r.df, round(r.idf, 9)) for r in i.terms.collect())
    assert terms(index) == terms(fresh)
    for k in (1, 7, 500):
        assert _top(index, queries, k) == _top(fresh, queries, k)
    assert _rows(index, queries) == _rows(fresh, queries)
    pairs = lambda i: sorted(map(tuple, bm25.term_chunks(i).collect()))
    assert pairs(index) == pairs(fresh)

    # The first segment was not rewritten, and its version can still be read.
    assert index.content["segments"][0] == old.content["segments"][0]
    assert _top(bm25.load_bm25_index(spark, old.path, version=old.version), queries, 7) == before
    again = bm25.update_bm25_index(index, chunks.filter(n == 8))  # a replaced chunk of the second segment
    compact = bm25.compact_bm25_index(again)
    assert len(compact.content["segments"]) == 1 and compact.tombstones is None
    again = bm25.load_bm25_index(spark, old.path)  # versions follow each other
    part = bm25.compact_bm25_index(again, [again.content["segments"][0]["name"]])
    assert len(part.content["segments"]) == 1
    for i in (again, compact, bm25.load_bm25_index(spark, old.path)):
        assert i.stats.first() == fresh.stats.first() and _top(i, queries, 7) == _top(fresh, queries, 7)


def test_dead_places_are_looked_up_in_a_mask(spark):
    """A place's look-up does not go through the dead ones, whose number grows with the block."""
    dead = [(0, [0, 5, 4095]), (1, list(range(0, 4096, 3))), (2, [7])]
    masks = bm25._masks(spark.createDataFrame(dead, "block long, dead array<int>"))
    assert {r.block: len(r.mask) for r in masks.collect()} == {0: 4096, 1: 4096, 2: 8}
    places = masks.select("block", "mask", F.sequence(F.lit(0), F.lit(4999)).alias("p"))
    got = {r.block: r.p for r in places.select("block", F.filter("p", bm25._is_dead).alias("p")).collect()}
    assert got == {b: sorted(p) for b, p in dead}
