import pytest

from sparkretrieve.operators import fusion

LEG = "query_id long, chunk_id string, rank int, score double"


def _leg(spark, rows):
    return spark.createDataFrame(rows, LEG)


def test_fusion_order_and_provenance(spark):
    bm = _leg(spark, [(1, "moon", 1, 2.0)])
    sem = _leg(spark, [(1, "tide", 1, 0.9), (1, "moon", 2, 0.8)])
    rows = fusion.fuse(bm, sem, 5).orderBy("rank").collect()
    assert [r.chunk_id for r in rows] == ["moon", "tide"]
    assert rows[0].matched_by == ["bm25", "semantic"] and rows[1].matched_by == ["semantic"]
    assert rows[0].fused_score == pytest.approx(0.0325224749)
    assert rows[1].fused_score == pytest.approx(0.0163934426)
    assert (rows[0].bm25_rank, rows[0].semantic_rank) == (1, 2)


def test_drop_rule_keeps_rank_gap(spark):
    chunks = spark.createDataFrame([("chunk_a",), ("moon",)], "chunk_id string")
    sem = _leg(spark, [(1, "missing", 1, 0.9), (1, "chunk_a", 2, 0.5)])
    kept = fusion.drop_unknown_chunks(sem, chunks)
    rows = fusion.fuse(_leg(spark, []), kept, 5).collect()
    assert [(r.chunk_id, r.semantic_rank) for r in rows] == [("chunk_a", 2)]
    assert rows[0].fused_score == pytest.approx(1 / 62)


def test_ties_bm25_first_then_semantic_order(spark):
    bm = _leg(spark, [(1, "b1", 1, 3.0), (1, "b2", 2, 2.0)])
    sem = _leg(spark, [(1, "s1", 1, 0.9), (1, "s2", 2, 0.8)])
    rows = fusion.fuse(bm, sem, 10).orderBy("rank").collect()
    assert [r.chunk_id for r in rows] == ["b1", "s1", "b2", "s2"]


def test_duplicates_in_a_leg_add_up_and_last_wins(spark):
    sem = _leg(spark, [(1, "x", 1, 0.9), (1, "x", 3, 0.7)])
    row = fusion.fuse(_leg(spark, []), sem, 5).first()
    assert row.fused_score == pytest.approx(1 / 61 + 1 / 63)
    assert (row.semantic_rank, row.semantic_score) == (3, 0.7)


@pytest.mark.parametrize("kw,msg", [({"rrf_k": 0}, "rrf_k"), ({"bm25_weight": 0}, "bm25_weight"),
                                     ({"semantic_weight": -1}, "semantic_weight")])
def test_guards(spark, kw, msg):
    with pytest.raises(ValueError, match=f"{msg} must be greater than 0"):
        fusion.fuse(_leg(spark, []), _leg(spark, []), 5, **kw)


def test_hybrid_search_end_to_end(spark):
    from sparkretrieve.checks import check_query_text
    from sparkretrieve.operators.embedding import HashingEncoder, embed_chunks
    from sparkretrieve.plans.search import hybrid_search

    chunks = spark.createDataFrame(
        [("c1", "d1", "w", "1", "Moon", 0, "The moon pulls at the sea.", {}),
         ("c2", "d2", "w", "2", "Tide", 0, "High tide follows the moon by an hour.", {}),
         ("c3", "d3", "w", "3", "Rope", 0, "A bowline knot holds under load.", {})],
        "chunk_id string, document_id string, source string, source_id string, title string, "
        "chunk_index int, text string, metadata map<string,string>")
    enc = HashingEncoder(32)
    vecs = embed_chunks(chunks, enc)
    queries = spark.createDataFrame([(1, "moon sea."), (2, "   ")], "query_id long, query string")
    res = hybrid_search(chunks, vecs, queries, enc, top_k=2).collect()
    assert {r.query_id for r in res} == {1}
    assert res and all(r.rank <= 2 for r in res)
    with pytest.raises(ValueError, match="query must be a non-empty string"):
        check_query_text("   ")


def test_drop_unknown_is_the_same_on_both_paths(spark):
    """Repeated chunk ids and repeated result rows: a semi-join whatever the size."""
    chunks = spark.createDataFrame([("a",), ("a",), ("b",)], "chunk_id string")
    sem = _leg(spark, [(1, "a", 1, 0.9), (1, "missing", 2, 0.8), (1, "b", 3, 0.7), (1, "a", 4, 0.6), (2, "a", 1, 0.5)])
    small = fusion.drop_unknown_chunks(sem, chunks)
    large = fusion.drop_unknown_chunks(sem, chunks, upper_bound=1 << 40)
    want = [(1, "a", 1), (1, "a", 4), (1, "b", 3), (2, "a", 1)]
    for kept in (small, large):
        assert sorted((r.query_id, r.chunk_id, r["rank"]) for r in kept.collect()) == want
    fused = [fusion.fuse(_leg(spark, []), kept, 5).orderBy("query_id", "rank").collect() for kept in (small, large)]
    assert fused[0] == fused[1]


def test_broadcast_needs_few_bytes_too(spark):
    from sparkretrieve.operators.sizing import broadcast_if_bounded

    df = spark.createDataFrame([("x" * 1000,)] * 20, "t string")
    assert broadcast_if_bounded(df, 20)[1]
    assert not broadcast_if_bounded(df, 19)[1]
    assert not broadcast_if_bounded(df, 20, max_bytes=10_000)[1]
