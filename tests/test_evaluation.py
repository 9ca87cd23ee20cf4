import json

import pytest

from sparkretrieve.operators import evaluation

CASES = "case_id long, query string, expected_document_id string, expected_chunk_id string"
RESULTS = "query_id long, rank int, chunk_id string, document_id string, title string, score double"


def _cases(spark, rows):
    return spark.createDataFrame(rows, CASES)


def _results(spark, rows):
    return spark.createDataFrame(rows, RESULTS)


def test_hit_miss_and_chunk_match(spark):
    cases = _cases(spark, [(1, "harbour", "doc_a", None), (2, "ferry", "doc_x", None),
                           (3, "maple", "doc_b", "doc_b_chunk_1")])
    results = _results(spark, [(1, 1, "doc_a_chunk_0", "doc_a", "A", 1.0),
                               (2, 1, "doc_a_chunk_0", "doc_a", "A", 0.5),
                               (3, 1, "doc_b_chunk_0", "doc_b", "B", 0.9),
                               (3, 2, "doc_b_chunk_1", "doc_b", "B", 0.8)])
    ev = {r.case_id: r for r in evaluation.evaluate_results(cases, results).collect()}
    assert ev[1].hit and ev[1].matched_chunk_id == "doc_a_chunk_0" and ev[1].matched_rank == 1
    assert not ev[2].hit and ev[2].matched_document_id is None
    assert ev[3].hit and ev[3].matched_chunk_id == "doc_b_chunk_1" and ev[3].matched_rank == 2
    summ = evaluation.summarize(evaluation.evaluate_results(cases, results)).first()
    assert (summ.total_cases, summ.hits, summ.misses) == (3, 2, 1)
    assert summ.hit_rate == pytest.approx(2 / 3)
    rep = evaluation.misses_report(evaluation.evaluate_results(cases, results), results).collect()
    assert [r.case_id for r in rep] == [2]
    assert rep[0].retrieved == "doc_a | doc_a_chunk_0 | A | score=0.5000"


def test_half_hit_rate_and_no_results(spark):
    cases = _cases(spark, [(1, "q", "doc_a", None), (2, "q", "doc_b", None)])
    results = _results(spark, [(1, 1, "doc_a_chunk_0", "doc_a", "A", 1.0)])
    ev = evaluation.evaluate_results(cases, results)
    assert evaluation.summarize(ev).first().hit_rate == 0.5
    rep = evaluation.misses_report(ev, results).collect()
    assert rep[0].retrieved == "no results"


def test_empty_summary(spark):
    s = evaluation.summarize(evaluation.evaluate_results(_cases(spark, []), _results(spark, []))).first()
    assert (s.total_cases, s.hits, s.misses, s.hit_rate) == (0, 0, 0, 0.0)


def test_guard(spark):
    with pytest.raises(ValueError, match="top_k must be greater than 0"):
        evaluation.evaluate(_cases(spark, []), lambda q, k: q, 0)


def _write(tmp_path, lines):
    p = tmp_path / "cases.jsonl"
    p.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(p)


def test_read_cases(spark, tmp_path):
    path = _write(tmp_path, [json.dumps({"query": "harbour", "expected_document_id": "wikipedia_1",
                                         "expected_chunk_id": None}), "",
                             json.dumps({"query": "maple", "expected_document_id": "wikipedia_2",
                                         "expected_chunk_id": "wikipedia_2_chunk_0"})])
    rows = evaluation.read_eval_cases(spark, path).orderBy("case_id").collect()
    assert [(r.query, r.expected_document_id, r.expected_chunk_id) for r in rows] == [
        ("harbour", "wikipedia_1", None), ("maple", "wikipedia_2", "wikipedia_2_chunk_0")]


def test_read_cases_errors(spark, tmp_path):
    path = _write(tmp_path, [json.dumps({"query": "ok", "expected_document_id": "d"}),
                             json.dumps({"expected_document_id": "d"})])
    with pytest.raises(ValueError, match="Line 2: query must be a non-empty string"):
        evaluation.read_eval_cases(spark, path)
    empty = tmp_path / "empty.jsonl"
    empty.write_text("\n  \n", encoding="utf-8")
    with pytest.raises(ValueError, match="No evaluation cases found in"):
        evaluation.read_eval_cases(spark, str(empty))
    with pytest.raises(FileNotFoundError, match="Evaluation dataset not found"):
        evaluation.read_eval_cases(spark, str(tmp_path / "nope.jsonl"))


def test_contained_item_cases(spark):
    from sparkretrieve.operators import bm25

    docs = spark.createDataFrame(
        [("doc_1", "1", "alpha beta gamma delta."), ("doc_2", "2", "xx beta gamma delta yy"),
         ("doc_3", "3", "beta gamma")],
        "document_id string, source_id string, text string")
    items = spark.createDataFrame([(10, "beta gamma delta"), (11, "ta gam"), (12, "zzz qqq rrr"),
                                   (13, "ta"), (14, "amma d"), (15, "q")],
                                  "item_id long, text string")
    index = bm25.build_bm25_index(docs.selectExpr("document_id AS chunk_id", "text"))
    postings = bm25.term_chunks(index).selectExpr("term", "chunk_id AS document_id")
    cases = evaluation.contained_item_cases(items, docs, index.terms, postings)
    got = {(r.case_id, r.expected_document_id) for r in cases.collect()}
    assert got == {(10, "doc_1"), (11, "doc_1"), (13, "doc_1"), (14, "doc_1")}
    no_index = evaluation.contained_item_cases(items, docs)
    assert {(r.case_id, r.expected_document_id) for r in no_index.collect()} == got
