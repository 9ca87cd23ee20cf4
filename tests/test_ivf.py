import numpy as np
import pytest

from sparkretrieve.operators import ivf, knn

SCHEMA = ("record_id string, chunk_id string, document_id string, title string, "
          "vector array<float>, metadata map<string,string>")


def _records(spark, v, prefix="r"):
    return spark.createDataFrame([(f"{prefix}{i:03d}", f"c{i}", f"d{i}", "", x.tolist(), {}) for i, x in enumerate(v)], SCHEMA)


def _rows(df):
    return sorted((r.query_id, r.rank, r.record_id, round(r.score, 9)) for r in df.collect())


@pytest.mark.parametrize("metric", ["cosine", "l2", "ip"])
def test_full_probe_equals_exact(spark, metric):
    rng = np.random.default_rng(3)
    recs = _records(spark, rng.normal(size=(120, 6)).astype(np.float32))
    queries = recs.selectExpr("record_id AS query_id", "vector")
    index = ivf.train_ivf(recs, nlist=4, metric=metric)
    full = ivf.ivf_search(index, queries, 5, nprobe=4, max_block_rows=50)
    assert _rows(full) == _rows(knn.knn_search(recs, queries, 5, metric))
    part = ivf.ivf_search(index, queries, 5, nprobe=1).collect()
    assert part and all(r.rank <= 5 for r in part)


def test_saved_index_and_validated_add(spark, tmp_path):
    rng = np.random.default_rng(4)
    recs = _records(spark, rng.normal(size=(40, 4)).astype(np.float32))
    ivf.train_ivf(recs, nlist=3, metric="l2", path=str(tmp_path / "ivf"))
    index = ivf.load_ivf_index(spark, str(tmp_path / "ivf"))
    assert (index.nlist, index.dimensions, index.metric) == (3, 4, "l2")
    with pytest.raises(ValueError, match="duplicate vector record_id: r000"):
        index.add(recs.limit(1))
    with pytest.raises(ValueError, match="expected vector dimension 4, got 2"):
        index.add(_records(spark, np.ones((1, 2), np.float32), "new"))
    more = _records(spark, rng.normal(size=(5, 4)).astype(np.float32), "new")
    index = index.add(more)
    assert index.vectors.count() == 45
    queries = more.selectExpr("record_id AS query_id", "vector")
    best = ivf.ivf_search(index, queries, 1, nprobe=1).collect()
    assert all(r.query_id == r.record_id for r in best) and len(best) == 5
    with pytest.raises(ValueError, match="expected query dimension 4, got 2"):
        ivf.ivf_search(index, _records(spark, np.ones((1, 2), np.float32)).selectExpr("record_id AS query_id", "vector"), 1)


def test_search_reads_the_probed_cells_only(spark):
    rng = np.random.default_rng(5)
    recs = _records(spark, rng.normal(size=(60, 4)).astype(np.float32))
    index = ivf.train_ivf(recs, nlist=6)
    one = recs.limit(1).selectExpr("record_id AS query_id", "vector")
    plan = ivf.ivf_search(index, one, 3, nprobe=1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cell" in plan or "PartitionFilters: [cell" in plan


def test_partial_probe_recall(spark):
    rng = np.random.default_rng(11)
    centers = rng.normal(size=(6, 8)) * 5
    v = np.concatenate([c + rng.normal(size=(40, 8)) for c in centers]).astype(np.float32)
    recs = _records(spark, v)
    queries = recs.selectExpr("record_id AS query_id", "vector")
    index = ivf.train_ivf(recs, nlist=6, metric="l2")
    approx = {(r.query_id, r.record_id) for r in ivf.ivf_search(index, queries, 10, nprobe=2).collect()}
    exact = {(r.query_id, r.record_id) for r in knn.knn_search(recs, queries, 10, "l2").collect()}
    assert len(approx & exact) / len(exact) >= 0.9
