import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkretrieve.operators import knn, vectors

SCHEMA = ("record_id string, chunk_id string, document_id string, title string, "
          "vector array<float>, metadata map<string,string>")


def _records(spark, vecs, ids=None):
    ids = ids or [f"r{i}" for i in range(len(vecs))]
    rows = [(rid, f"c_{rid}", f"d_{rid}", None, v, None) for rid, v in zip(ids, vecs)]
    return spark.createDataFrame(rows, SCHEMA)


def _queries(spark, vecs):
    return spark.createDataFrame([(f"q{i}", v) for i, v in enumerate(vecs)], "query_id string, vector array<float>")


def test_top1_cosine(spark):
    recs = _records(spark, [[1.0, 0.0, 0.0], [0.0, 1.0, 0.0]])
    res = knn.knn_search(recs, _queries(spark, [[1.0, 0.0, 0.0]]), 1).collect()
    assert [(r.record_id, r.rank) for r in res] == [("r0", 1)]
    assert res[0].score == pytest.approx(1.0)


def test_k_capped_and_empty_index(spark):
    recs = _records(spark, [[1.0, 0.0], [0.0, 1.0]])
    assert knn.knn_search(recs, _queries(spark, [[1.0, 1.0]]), 10).count() == 2
    assert knn.knn_search(recs.limit(0), _queries(spark, [[1.0, 1.0]]), 3).count() == 0


@pytest.mark.parametrize("metric", ["cosine", "l2", "ip"])
def test_metrics_match_numpy_and_paths_agree(spark, metric):
    rng = np.random.default_rng(7)
    v = rng.normal(size=(60, 5)).astype(np.float32)
    q = rng.normal(size=(7, 5)).astype(np.float32)
    v[3] = 0.0  # zero-norm vector: cosine 0
    recs = _records(spark, [x.tolist() for x in v])
    qs = _queries(spark, [x.tolist() for x in q])
    k = 4
    a = knn.knn_search(recs, qs, k, metric, max_block_rows=100)
    b = knn.knn_search(recs, qs, k, metric, max_block_rows=3)
    ra = sorted((r.query_id, r.rank, r.record_id, round(r.score, 9)) for r in a.collect())
    rb = sorted((r.query_id, r.rank, r.record_id, round(r.score, 9)) for r in b.collect())
    assert ra == rb
    qd, vd = q.astype(np.float64), v.astype(np.float64)
    for i in range(len(q)):
        if metric == "cosine":
            nv = np.linalg.norm(vd, axis=1)
            s = np.where(nv > 0, vd @ qd[i] / (np.linalg.norm(qd[i]) * np.where(nv > 0, nv, 1)), 0.0)
        elif metric == "ip":
            s = vd @ qd[i]
        else:
            s = -((vd - qd[i]) ** 2).sum(axis=1)
        order = sorted(range(len(v)), key=lambda j: (-round(s[j], 9), f"r{j}"))[:k]
        got = [r for r in ra if r[0] == f"q{i}"]
        assert [g[2] for g in got] == [f"r{j}" for j in order]
        assert [g[3] for g in got] == pytest.approx([s[j] for j in order], abs=1e-7)


def test_ties_broken_by_record_id(spark):
    recs = _records(spark, [[1.0, 0.0]] * 5, ids=["e", "b", "d", "a", "c"])
    res = knn.knn_search(recs, _queries(spark, [[1.0, 0.0]]), 3).orderBy("rank").collect()
    assert [r.record_id for r in res] == ["a", "b", "c"]


def test_guards(spark):
    recs = _records(spark, [[1.0, 0.0]])
    with pytest.raises(ValueError, match="top_k must be greater than 0"):
        knn.knn_search(recs, _queries(spark, [[1.0, 0.0]]), 0)
    with pytest.raises(ValueError, match="unsupported HNSW metric: dot"):
        knn.knn_search(recs, _queries(spark, [[1.0, 0.0]]), 1, "dot")


def test_validation_messages(spark):
    rows = [("a", "c", "d", None, [1.0, 0.0], None), ("b", "c", "d", "", [1.0], None),
            ("a", "c", "d", "t", [0.0, 1.0], None), (" ", "c", "d", "t", [0.0, 1.0], None),
            ("e", "c", "d", "t", [], None)]
    checked = vectors.validate_vector_records(spark.createDataFrame(rows, SCHEMA), 2)
    got = {(r.record_id, r.reject_reason) for r in checked.collect()}
    assert ("b", "expected vector dimension 2, got 1 for record_id=b") in got
    assert ("a", "duplicate vector record_id: a") in got
    assert (" ", "embedding record record_id must be a non-empty string") in got
    assert ("e", "embedding record vector must be a non-empty list") in got
    with pytest.raises(ValueError):
        vectors.split_valid(checked, strict=True)
    valid, rejects = vectors.split_valid(checked, strict=False)
    assert valid.count() == 0 and rejects.count() == 5


def test_index_info_and_add(spark):
    index = vectors.build_vector_index(_records(spark, [[1.0, 0.0], [0.0, 1.0]]), "l2")
    info = index.info().first()
    assert (info.name, info.dimensions, info.metric, info.records_count) == ("exact", 2, "l2", 2)
    with pytest.raises(ValueError, match="duplicate vector record_id: r0"):
        index.add(_records(spark, [[0.5, 0.5]], ids=["r0"]))
    with pytest.raises(ValueError, match="expected vector dimension 2, got 3 for record_id=x"):
        index.add(_records(spark, [[0.5, 0.5, 0.1]], ids=["x"]))
    bigger = index.add(_records(spark, [[0.5, 0.5]], ids=["x"]))
    assert bigger.info().first().records_count == 3
    assert bigger.records.filter(F.col("title") == "").count() == 3


def test_mixed_dimensions_rejected(spark):
    with pytest.raises(ValueError, match="expected vector dimension"):
        vectors.build_vector_index(_records(spark, [[1.0, 0.0], [1.0]]))


def test_topk_keeps_k_rows_even_of_a_huge_tie_group():
    top = knn.TopK(np.array([[1.0, 0.0]]), "cosine", 3)
    v = np.array([[1.0, 0.0]] * 500 + [[0.0, 1.0]])
    for at in (300, 0):  # in two batches, the later ids first
        ids = np.array([f"r{i:04d}" for i in range(at, at + 300)][:501 - at], dtype=object)
        top.add(v[at:at + 300], [ids])
    (out,) = top.frames(np.array(["q"], dtype=object))
    assert list(out["record_id"]) == ["r0000", "r0001", "r0002"]


@pytest.mark.parametrize("size,step", [(1000.0, 1e-5), (10_000.0, 1e-4), (1.0, 1e-9)])
def test_l2_finds_close_neighbours_of_long_vectors(size, step):
    rng = np.random.default_rng(1)
    for _ in range(20):
        q = rng.normal(size=(3, 16)) * size
        v = np.concatenate([q[:1] + rng.normal(size=(40, 16)) * step, rng.normal(size=(40, 16)) * size])
        top = knn.TopK(q, "l2", 5)
        top.add(v, [np.array([f"r{i:02d}" for i in range(80)], dtype=object)])
        (out,) = top.frames(np.arange(3))
        for i in range(3):
            s = np.round(-((v - q[i]) ** 2).sum(axis=1), knn.RANK_DIGITS)
            want = sorted(range(80), key=lambda j: (-s[j], j))[:5]
            assert list(out[out["query_id"] == i]["record_id"]) == [f"r{j:02d}" for j in want]


def test_tiles_are_small():
    """A tile's arrays stay below 512 MB whatever the block and the table."""
    assert knn.TILE_QUERIES * knn.TILE_VECTORS * 60 < 512 << 20
    assert knn.MAX_BLOCK_BYTES < 512 << 20


def test_query_of_wrong_length(spark):
    recs = _records(spark, [[1.0, 0.0], [0.0, 1.0]])
    with pytest.raises(ValueError, match="expected query dimension 2, got 3"):
        knn.knn_search(recs, _queries(spark, [[1.0, 0.0, 0.0]]), 1)


def test_white_space_ids_are_blank(spark):
    recs = spark.createDataFrame([("\t\n", "c", "d", None, [1.0], None), ("\t\n", "c", "d", None, [1.0], None),
                                  (None, "c", "d", None, [1.0], None), ("a", "\u3000", "d", None, [1.0], None)], SCHEMA)
    got = [r.reject_reason for r in vectors.validate_vector_records(recs, 1).collect()]
    assert sorted(got) == ["embedding record chunk_id must be a non-empty string"] \
        + ["embedding record record_id must be a non-empty string"] * 3
