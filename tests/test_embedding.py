import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkretrieve.functions.text import safe_record_id
from sparkretrieve.operators import embedding


class FakeModel:
    def __init__(self, dims=3, wrong=False):
        self.dims, self.wrong, self.calls = dims, wrong, []

    def encode(self, sentences, *, batch_size, normalize_embeddings, show_progress_bar):
        self.calls.append((list(sentences), batch_size, normalize_embeddings, show_progress_bar))
        n = len(sentences) - (1 if self.wrong else 0)
        return np.ones((n, self.dims))


def test_batches():
    assert [len(b) for b in embedding.iter_batches([1, 2, 3], 2)] == [2, 1]
    with pytest.raises(ValueError, match="batch_size must be greater than 0"):
        list(embedding.iter_batches([1], 0))


def test_sentence_encoder_with_fake_model():
    model = FakeModel(3)
    enc = embedding.SentenceTransformerEncoder("m", dimensions=3, max_batch_size=2, model_loader=lambda name, **kw: model)
    out = embedding.encode_checked(enc, ["a", "b", "c"])
    assert out.shape == (3, 3)
    assert [c[1] for c in model.calls] == [2, 1]
    assert model.calls[0][2] is True and model.calls[0][3] is False


def test_dimension_and_count_checks():
    enc = embedding.SentenceTransformerEncoder("m2", dimensions=3, model_loader=lambda name, **kw: FakeModel(2))
    with pytest.raises(ValueError, match="expected embedding dimension 3, got 2"):
        embedding.encode_checked(enc, ["a"])
    enc = embedding.SentenceTransformerEncoder("m3", dimensions=3, model_loader=lambda name, **kw: FakeModel(3, True))
    with pytest.raises(ValueError, match="embedding result count does not match request count"):
        embedding.encode_checked(enc, ["a", "b"])


def test_provider_guards():
    with pytest.raises(ValueError, match="model_name must be a non-empty string"):
        embedding.SentenceTransformerEncoder("  ")
    with pytest.raises(ValueError, match="dimensions must be greater than 0"):
        embedding.HashingEncoder(0)


def test_hashing_encoder_is_deterministic_and_normalised():
    enc = embedding.HashingEncoder(16)
    v = enc.encode(["Hello hello world", ""])
    assert np.linalg.norm(v[0]) == pytest.approx(1.0, abs=1e-6)
    assert not v[1].any()
    b, s = embedding.bucket_and_sign("hello", 16)
    assert v[0][b] != 0 and np.sign(v[0][b]) in (s, -s)


def _chunks(spark):
    return spark.createDataFrame(
        [("doc_1_chunk_0", "doc_1", "wiki", "1", "Title", 0, "Alpha beta", {"lang": "en", "title": "Meta"})],
        "chunk_id string, document_id string, source string, source_id string, title string, chunk_index int, "
        "text string, metadata map<string,string>")


def test_request_metadata_overrides_and_records(spark):
    req = embedding.embedding_requests(_chunks(spark)).first()
    assert req.record_id == "doc_1_chunk_0"
    assert req.metadata["title"] == "Title" and req.metadata["chunk_index"] == "0" and req.metadata["lang"] == "en"
    recs = embedding.embed_chunks(_chunks(spark), embedding.HashingEncoder(8)).first()
    assert (recs.chunk_id, recs.document_id, recs.title, recs.provider, recs.dimensions) == (
        "doc_1_chunk_0", "doc_1", "Title", "hashing", 8)
    assert len(recs.vector) == 8


def test_chunk_id_defaults_to_record_id(spark):
    res = spark.createDataFrame([("r:1", [1.0], "p", "m", 1, {"document_id": "d"})],
                                "record_id string, vector array<float>, provider string, model string, "
                                "dimensions int, metadata map<string,string>")
    rec = embedding.embedding_records(res).first()
    assert rec.chunk_id == "r:1" and rec.document_id == "d" and rec.title is None
    man = embedding.embedding_manifest(embedding.embedding_records(res), "out").first()
    assert man.output_path == "out/r_1.json"


def test_safe_record_id(spark):
    df = spark.createDataFrame([("wiki:doc/chunk\\1",)], "x string")
    assert df.select(safe_record_id("x").alias("y")).first().y == "wiki_doc_chunk_1"


class _TinyModel:
    def encode(self, sentences, *, batch_size, normalize_embeddings, show_progress_bar):
        return np.array([[float(len(s)), 1.0, 0.0] for s in sentences])


def _tiny_loader(name, **kwargs):
    return _TinyModel()


def test_sentence_encoder_in_spark_with_fake_model(spark):
    enc = embedding.SentenceTransformerEncoder("fake/model", dimensions=3, max_batch_size=2, model_loader=_tiny_loader)
    df = spark.createDataFrame([("a", "xx"), ("b", "yyyy"), ("c", "z")], "record_id string, text string")
    rows = {r.record_id: r for r in embedding.embed_requests(df.withColumn("metadata", F.create_map()), enc).collect()}
    assert rows["b"].vector == [4.0, 1.0, 0.0]
    assert (rows["a"].provider, rows["a"].model, rows["a"].dimensions) == ("huggingface", "fake/model", 3)


def test_single_query_calls(spark):
    from sparkretrieve.plans.search import hybrid_search_one, semantic_search_one

    chunks = _chunks(spark)
    enc = embedding.HashingEncoder(8)
    vecs = embedding.embed_chunks(chunks, enc)
    assert semantic_search_one(vecs, "alpha", enc, 1).first().chunk_id == "doc_1_chunk_0"
    assert hybrid_search_one(chunks, vecs, "alpha beta", enc, 3).first().chunk_id == "doc_1_chunk_0"
    with pytest.raises(ValueError, match="query must be a non-empty string"):
        hybrid_search_one(chunks, vecs, "   ", enc)
