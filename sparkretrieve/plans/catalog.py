"""Registered queries: one Spark plan per operator, over the driver tables.

Each builder takes (spark, sf_dir) and returns a DataFrame whose column names
match the oracle SQL in ``plans.oracles``. Maps and arrays are rendered to
sorted strings, doubles rounded, ranks cast to BIGINT, so two engines can be
compared by value hash.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkretrieve.functions.metadata import flatten_document_metadata
from sparkretrieve.functions.text import WHITESPACE_RE, first_line_title, preview, py_strip, render_map, safe_record_id, tokenize
from sparkretrieve.operators import bm25, chunking, embedding, evaluation, fusion, ivf, knn, vectors
from sparkretrieve.plans import jobs, search
from sparkretrieve.session import scratch_path
from sparkretrieve.sources import corpus, dump, records

TOP_K = 10
SCORE_DIGITS = 6

QueryBuilder = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.canonical_documents(corpus.balanced(corpus.table(spark, sf_dir, "documents")))


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.whole_document_chunks(_documents(spark, sf_dir))


def _queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.benchmark_queries(corpus.table(spark, sf_dir, "benchmark"))


def _round(c: str, digits: int = SCORE_DIGITS):
    return F.round(F.col(c), digits).alias(c)


# --- M0: projections -------------------------------------------------------

def q_canonical_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return docs.select(
        "document_id", "source", "source_id", "title", "version", "updated_at", "text",
        render_map("metadata").alias("metadata"),
    )


# --- M1: lexical retrieval -------------------------------------------------

def q_tokenize_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = _chunks(spark, sf_dir)
    toks = tokenize("text")
    return chunks.select(
        "chunk_id",
        F.size(toks).cast("bigint").alias("n_tokens"),
        F.array_join(toks, " ").alias("tokens"),
    )


def q_bm25_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = bm25.build_bm25_index(_chunks(spark, sf_dir))
    return index.stats.select(
        F.col("n_chunks").cast("bigint").alias("n_chunks"),
        F.col("total_tokens").cast("bigint").alias("total_tokens"),
        _round("avgdl"),
        F.col("vocabulary").cast("bigint").alias("vocabulary"),
        F.round("mean_idf", 9).alias("mean_idf"),
    )


def q_bm25_idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = bm25.build_bm25_index(_chunks(spark, sf_dir))
    return index.terms.select(
        "term", F.col("df").cast("bigint").alias("df"), F.round("idf", 9).alias("idf")
    )


def q_bm25_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per query: the chunks that share a token with it, and their lowest and highest score."""
    index = bm25.build_bm25_index(_chunks(spark, sf_dir))
    return bm25.match_summary(index, _queries(spark, sf_dir)).select(
        "query_id", F.col("matches").cast("bigint").alias("matches"), _round("lowest"), _round("highest"),
        F.col("most_overlap").cast("bigint").alias("most_overlap"))


def q_bm25_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = _chunks(spark, sf_dir)
    res = bm25.bm25_search(chunks, _queries(spark, sf_dir), top_k=TOP_K,
                           columns=("document_id", "title", "text"))
    return res.select(
        "query_id", F.col("rank").cast("bigint").alias("rank"), "chunk_id", "document_id", "title",
        _round("score"), F.col("overlap").cast("bigint").alias("overlap"),
        preview("text").alias("preview"),
    )


# --- M2: chunking ------------------------------------------------------------

def q_chunk_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every chunk of every document at the splitter's defaults (1200/200)."""
    return chunking.chunk_documents(_documents(spark, sf_dir)).select(
        "chunk_id", "document_id", F.col("chunk_index").cast("bigint").alias("chunk_index"), "title",
        F.length("text").cast("bigint").alias("n_chars"), F.md5("text").alias("digest"))


def q_chunk_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.chunk_summary(chunking.split_documents(_documents(spark, sf_dir)))


def q_chunk_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.chunk_manifest(chunking.chunk_documents(_documents(spark, sf_dir)), "chunks")


def _lossless(spark: SparkSession, sf_dir: str, size: int) -> DataFrame:
    """Overlap 0 invariant: the chunks, in order and without whitespace, spell
    the document without whitespace; no chunk is longer than ``size``."""
    split = chunking.split_documents(_documents(spark, sf_dir), size, 0)
    joined = F.regexp_replace(F.array_join("chunks", ""), WHITESPACE_RE, "")
    longest = F.coalesce(F.array_max(F.transform("chunks", lambda c: F.length(c))), F.lit(0))
    return split.select(
        "document_id", F.md5(joined).alias("digest"), (longest <= size).alias("within_size")
    )


def _real_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The splitter's chunks (1200/200), written once as the chunk job does."""
    path = scratch_path(spark, "chunks")
    chunks = chunking.chunk_documents(_documents(spark, sf_dir))
    chunks.write.parquet(path)
    return spark.read.schema(chunks.schema).parquet(path)


def q_bm25_chunk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BM25 top-k over the splitter's chunks."""
    res = bm25.bm25_search(_real_chunks(spark, sf_dir), _queries(spark, sf_dir), top_k=TOP_K, columns=("document_id",))
    return res.select("query_id", F.col("rank").cast("bigint").alias("rank"), "chunk_id", "document_id", _round("score"),
                      F.col("overlap").cast("bigint").alias("overlap"))


def q_bm25_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index of three quarters of the chunks, a third of them with old texts,
    and of some that will go; then the update that replaces the old, adds the
    rest and withdraws what is gone. The search is that of an index built anew."""
    chunks = _chunks(spark, sf_dir).select("chunk_id", "text", F.col("source_id").cast("bigint").alias("k"))
    old = F.when(F.col("k") % 3 == 0, F.substring("text", 1, 300)).otherwise(F.col("text"))
    first = chunks.filter("k % 4 != 3").select("chunk_id", old.alias("text"))
    leaving = chunks.filter("k % 5 = 0").select(F.concat(F.lit("gone_"), "chunk_id").alias("chunk_id"), "text")
    index = bm25.build_bm25_index(first.unionByName(leaving))
    index = bm25.update_bm25_index(index, chunks.filter("k % 4 = 3 or k % 3 = 0").select("chunk_id", "text"),
                                   removed=leaving.select("chunk_id"))
    matches = bm25.bm25_matches(index, _queries(spark, sf_dir), top_k=TOP_K)
    facts = index.stats.select("n_chunks", "vocabulary")
    return bm25.rank_matches(matches, TOP_K).crossJoin(F.broadcast(facts)).select(
        "query_id", F.col("rank").cast("bigint").alias("rank"), "chunk_id", _round("score"),
        F.col("overlap").cast("bigint").alias("overlap"), "n_chunks", "vocabulary")


def q_chunk_lossless(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lossless(spark, sf_dir, chunking.DEFAULT_CHUNK_SIZE)


def q_chunk_lossless_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lossless(spark, sf_dir, 100)


# --- M3/M6: vectors and embeddings -----------------------------------------

HASH_DIMENSIONS = 64
ENCODER = embedding.HashingEncoder(dimensions=HASH_DIMENSIONS)


def q_metadata_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return docs.select("document_id", render_map(flatten_document_metadata()).alias("metadata"))


def q_embedding_request(spark: SparkSession, sf_dir: str) -> DataFrame:
    req = embedding.embedding_requests(_chunks(spark, sf_dir))
    return req.select("record_id", "text", render_map("metadata").alias("metadata"))


def q_safe_record_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = corpus.table(spark, sf_dir, "pages")
    return pages.select("page_id", "url", safe_record_id("url").alias("safe_id"))


def _doc_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding.embed_chunks(_chunks(spark, sf_dir), ENCODER)


def q_hash_embed(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = _doc_vectors(spark, sf_dir)
    # posexplode_outer: a plain posexplode would infer a size(vector) > 0 filter
    # and run the encoder twice.
    cells = recs.select("record_id", F.posexplode_outer("vector").alias("dim", "value"))
    return cells.filter(F.col("value") != 0).select(
        "record_id", F.col("dim").cast("bigint").alias("dim"),
        F.round(F.col("value").cast("double"), SCORE_DIGITS).alias("value"),
    )


def q_embedding_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = embedding.embedding_manifest(_doc_vectors(spark, sf_dir), "embeddings")
    return manifest.withColumn("dimensions", F.col("dimensions").cast("bigint"))


def _embedding_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.vector_records(corpus.balanced(corpus.table(spark, sf_dir, "embeddings")))


def q_vector_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = vectors.validate_vector_records(_embedding_vectors(spark, sf_dir), HASH_DIMENSIONS)
    return checked.select(
        "record_id", F.size("vector").cast("bigint").alias("n_dims"),
        F.coalesce(F.col("reject_reason"), F.lit("valid")).alias("status"),
    )


def q_vector_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation of embeddings of which most are spoilt, by the last digit of the id."""
    digit = F.col("vec_id") % 10
    record = F.concat(F.lit("rec_"), F.col("vec_id"))
    rows = corpus.table(spark, sf_dir, "embeddings").select(
        F.when(digit == 2, F.lit("\t")).when(digit == 6, F.concat(F.lit("dup_"), F.floor(F.col("vec_id") / 20)))
        .otherwise(record).alias("record_id"),
        F.when(digit == 3, F.lit(" \n")).otherwise(record).alias("chunk_id"),
        F.when(digit != 4, record).alias("document_id"), F.lit(None).cast("string").alias("title"),
        F.when(digit == 1, F.array().cast("array<float>")).when(digit == 5, F.slice("embedding", 1, HASH_DIMENSIONS - 1))
        .otherwise(F.col("embedding")).alias("vector"),
        F.lit(None).cast("map<string,string>").alias("metadata"))
    checked = vectors.validate_vector_records(rows, HASH_DIMENSIONS)
    return checked.select("record_id", F.size("vector").cast("bigint").alias("n_dims"),
                          F.coalesce("reject_reason", F.lit("valid")).alias("status"))


def q_index_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = vectors.build_vector_index(_embedding_vectors(spark, sf_dir), "cosine")
    return index.info()


def _query_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark texts as 64-dimensional queries."""
    return embedding.embed_queries(_queries(spark, sf_dir), ENCODER)


def _knn(spark: SparkSession, sf_dir: str, metric: str) -> DataFrame:
    """Every benchmark text against all embeddings."""
    hits = knn.knn_search(_embedding_vectors(spark, sf_dir), _query_vectors(spark, sf_dir), TOP_K, metric)
    return hits.select(F.col("query_id").cast("bigint").alias("query_id"), F.col("rank").cast("bigint").alias("rank"),
                       "record_id", _round("score"))


def q_knn_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _knn(spark, sf_dir, "cosine")


def q_knn_l2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _knn(spark, sf_dir, "l2")


def q_knn_ip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _knn(spark, sf_dir, "ip")


def q_semantic_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    res = search.semantic_search(_doc_vectors(spark, sf_dir), _queries(spark, sf_dir), ENCODER, TOP_K)
    return res.select(
        F.col("query_id").cast("bigint").alias("query_id"), F.col("rank").cast("bigint").alias("rank"),
        "chunk_id", "document_id", _round("score"),
    )


# --- M4: hybrid fusion -------------------------------------------------------

LEG_K = 50
EVAL_K = 5


def _hybrid(spark: SparkSession, sf_dir: str, queries: DataFrame, top_k: int,
            columns: tuple[str, ...] = ("document_id",)) -> DataFrame:
    chunks = _chunks(spark, sf_dir)
    return search.hybrid_search(chunks, _doc_vectors(spark, sf_dir), queries, ENCODER, top_k,
                                bm25_top_k=LEG_K, semantic_top_k=LEG_K, columns=columns)


def q_hybrid_rrf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hybrid_rows(_hybrid(spark, sf_dir, _queries(spark, sf_dir), TOP_K))


def q_hybrid_matched_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fused candidate (up to 2 x 50 per query) with its provenance."""
    chunks = _chunks(spark, sf_dir)
    queries = _queries(spark, sf_dir)
    lexical = bm25.bm25_search(chunks, queries, LEG_K, columns=())
    hits = knn.knn_search(_doc_vectors(spark, sf_dir), embedding.embed_queries(queries, ENCODER), LEG_K)
    semantic = hits.withColumnRenamed("record_id", "chunk_id")
    cands = fusion.fusion_candidates(lexical, semantic)
    return cands.select(
        F.col("query_id").cast("bigint").alias("query_id"), "chunk_id",
        F.round("fused_score", 9).alias("fused_score"), F.array_join("matched_by", ",").alias("matched_by"),
    )


def _hybrid_rows(res: DataFrame) -> DataFrame:
    return res.select(
        F.col("query_id").cast("bigint").alias("query_id"), F.col("rank").cast("bigint").alias("rank"),
        "chunk_id", "document_id", F.round("fused_score", 9).alias("fused_score"),
        _round("bm25_score"), _round("semantic_score"),
        F.col("bm25_rank").cast("bigint").alias("bm25_rank"),
        F.col("semantic_rank").cast("bigint").alias("semantic_rank"),
        F.array_join("matched_by", ",").alias("matched_by"),
    )


def q_hybrid_drop_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hybrid search over vectors whose chunk ids (three times the vector's id)
    partly do not exist: those rows go, after they were ranked."""
    other = F.concat(F.lit("doc_"), F.col("vec_id") * 3, F.lit("_chunk_0"))
    vecs = corpus.table(spark, sf_dir, "embeddings").select(
        other.alias("record_id"), other.alias("chunk_id"), F.col("embedding").alias("vector"))
    return _hybrid_rows(search.hybrid_search(
        _chunks(spark, sf_dir), vecs, _queries(spark, sf_dir), ENCODER, TOP_K, bm25_top_k=LEG_K, semantic_top_k=LEG_K,
        columns=("document_id",)))


def q_hybrid_ivf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hybrid search with the IVF index as its semantic searcher, every cell probed."""
    recs = _doc_vectors(spark, sf_dir).select("record_id", "chunk_id", "document_id", "title", "vector")
    index = ivf.build_ivf_index(recs, _fixed_centroids(recs))
    return _hybrid_rows(search.hybrid_search(
        _chunks(spark, sf_dir), search.ivf_searcher(index, NLIST), _queries(spark, sf_dir), ENCODER, TOP_K,
        bm25_top_k=LEG_K, semantic_top_k=LEG_K, columns=("document_id",)))


# --- M5: evaluation -----------------------------------------------------------

def _eval_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    items = corpus.table(spark, sf_dir, "benchmark")
    return evaluation.contained_item_cases(items, docs)


def _bm25_retriever(spark: SparkSession, sf_dir: str):
    chunks = _chunks(spark, sf_dir)
    index = bm25.build_bm25_index(chunks)
    return lambda q, k: bm25.bm25_search(chunks, q, k, index=index, columns=("document_id", "title"))


def _evaluated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.evaluate(_eval_cases(spark, sf_dir), _bm25_retriever(spark, sf_dir), EVAL_K)


def _eval_rows(ev: DataFrame) -> DataFrame:
    return ev.select(
        F.col("case_id").cast("bigint").alias("case_id"), "hit", "matched_document_id", "matched_chunk_id",
        F.col("matched_rank").cast("bigint").alias("matched_rank"), "n_results",
    )


def q_eval_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _eval_cases(spark, sf_dir).select("case_id", "query", "expected_document_id")


def q_eval_hit_at_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _eval_rows(_evaluated(spark, sf_dir))


def q_eval_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summ = evaluation.summarize(_evaluated(spark, sf_dir))
    return summ.select("total_cases", "hits", "misses", _round("hit_rate"))


def q_eval_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases, results = evaluation.run_cases(_eval_cases(spark, sf_dir), _bm25_retriever(spark, sf_dir), EVAL_K)
    rep = evaluation.misses_report(evaluation.evaluate_results(cases, results), results)
    return rep.select(F.col("case_id").cast("bigint").alias("case_id"), "expected_document_id", "retrieved")


def q_eval_real_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunk, embed, hybrid search and evaluation over the splitter's chunks."""
    chunks = _real_chunks(spark, sf_dir)
    vecs = embedding.embed_chunks(chunks, ENCODER)
    index = bm25.build_bm25_index(chunks)

    def retriever(q: DataFrame, k: int) -> DataFrame:
        return search.hybrid_search(chunks, vecs, q, ENCODER, k, bm25_top_k=LEG_K, semantic_top_k=LEG_K,
                                    bm25_index=index, columns=("document_id",))

    return _eval_rows(evaluation.evaluate(_eval_cases(spark, sf_dir), retriever, EVAL_K))


def q_eval_hybrid(spark: SparkSession, sf_dir: str) -> DataFrame:
    def retriever(q: DataFrame, k: int) -> DataFrame:
        return _hybrid(spark, sf_dir, q, k, columns=("document_id",))

    return _eval_rows(evaluation.evaluate(_eval_cases(spark, sf_dir), retriever, EVAL_K))


# --- M7: dump ingest -----------------------------------------------------------

DUMP_TIMESTAMP = "2024-04-15T14:38:04Z"


def _write_dump(spark: SparkSession, xml: DataFrame) -> str:
    path = scratch_path(spark, "dump")
    xml.write.option("compression", "bzip2").text(path)
    return path


def _dump_xml(raw: DataFrame, revision) -> DataFrame:
    """Driver documents as pages: title = first line, page id = doc_id."""
    return raw.select(dump.page_xml(
        first_line_title("text"), F.col("doc_id").cast("string"), revision.cast("string"),
        F.lit(DUMP_TIMESTAMP), F.col("text")).alias("value"))


def _derived_dump(spark: SparkSession, sf_dir: str) -> str:
    """The driver documents as a bz2 MediaWiki-style dump (a Spark job);
    returns its folder. Revision id = n_chars."""
    raw = corpus.balanced(corpus.table(spark, sf_dir, "documents"))
    return _write_dump(spark, _dump_xml(raw, F.col("n_chars")))


def q_page_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of pages without a revision (every fifth), without a title (every fifth)
    and whole ones, only the last are parsed."""
    raw = corpus.balanced(corpus.table(spark, sf_dir, "documents"))
    xml = _dump_xml(raw.filter("doc_id % 5 > 1"), F.col("n_chars"))
    bare = raw.filter("doc_id % 5 = 0").select(F.concat(
        F.lit("<page><title>t</title><id>"), F.col("doc_id"), F.lit("</id></page>")).alias("value"))
    untitled = raw.filter("doc_id % 5 = 1").select(dump.page_xml(
        F.lit(""), F.col("doc_id").cast("string"), F.lit("1"), F.lit(DUMP_TIMESTAMP), F.lit("x")).alias("value"))
    pages = dump.read_pages(spark, _write_dump(spark, xml.unionByName(bare).unionByName(untitled)))
    return pages.select("title", "page_id", "revision_id", "timestamp", "text")


def q_ingest_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two dumps ingested in turn: even ids and every tenth from 1, then odd ids
    and every tenth from 2 with the next revision. Ids of both dumps hold the
    second's page, all others what they had."""
    raw = corpus.balanced(corpus.table(spark, sf_dir, "documents"))
    table, manifest = scratch_path(spark, "canonical"), scratch_path(spark, "manifest")
    for rows, step in ((raw.filter("doc_id % 2 = 0 or doc_id % 10 = 1"), 0), (raw.filter("doc_id % 2 = 1 or doc_id % 10 = 2"), 1)):
        jobs.ingest_dump(spark, _write_dump(spark, _dump_xml(rows, F.col("n_chars") + step)), table, manifest)
    logged = spark.read.json(manifest).groupBy("document_id").agg(F.count(F.lit(1)).alias("n_manifest"))
    docs = records.read_documents(spark, table, fmt="parquet")
    return docs.join(logged, "document_id").select("document_id", "title", "version", F.md5("text").alias("digest"), "n_manifest")


def q_dump_page_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dump.read_pages(spark, _derived_dump(spark, sf_dir))


def q_ingest_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = dump.pages_to_documents(dump.read_pages(spark, _derived_dump(spark, sf_dir)))
    return dump.ingest_manifest(docs, "canonical/wikipedia")


# --- M8: approximate kNN -------------------------------------------------------

NLIST, NPROBE = 8, 7  # the narrowest width whose recall reaches 0.9
RECALL_WIDTHS = (1, 2, 4, NPROBE, NLIST)


def _fixed_centroids(vecs: DataFrame) -> np.ndarray:
    """The vectors of the ``NLIST`` smallest identifiers, normalised: centroids
    that SQL can name too, so that a partial probe has an exact oracle."""
    rows = vecs.orderBy(F.length("document_id"), "document_id").limit(NLIST).select("vector").collect()
    return knn._normalise(knn._matrix([r["vector"] for r in rows]))


def _ann(index: ivf.IVFIndex, queries: DataFrame, nprobe: int) -> DataFrame:
    hits = ivf.ivf_search(index, queries, TOP_K, nprobe)
    return hits.select(F.col("query_id").cast("bigint").alias("query_id"), F.col("rank").cast("bigint").alias("rank"),
                       "record_id", _round("score"))


def q_ann_full_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IVF over trained cells, probing every cell: must equal exact cosine kNN."""
    index = ivf.train_ivf(_embedding_vectors(spark, sf_dir), NLIST, "cosine")
    return _ann(index, _query_vectors(spark, sf_dir), NLIST)


def q_ann_ivf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IVF over fixed cells, probing 7 of 8."""
    vecs = _embedding_vectors(spark, sf_dir)
    index = ivf.build_ivf_index(vecs, _fixed_centroids(vecs))
    return _ann(index, _query_vectors(spark, sf_dir), NPROBE)


def q_ann_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of the exact neighbours each probe width finds."""
    vecs = _embedding_vectors(spark, sf_dir)
    index = ivf.build_ivf_index(vecs, _fixed_centroids(vecs))
    queries = _query_vectors(spark, sf_dir)
    exact = _knn(spark, sf_dir, "cosine").select("query_id", "record_id")
    found = [_ann(index, queries, n).select("query_id", "record_id").join(exact, ["query_id", "record_id"], "left_semi")
             .agg(F.count(F.lit(1)).alias("found")).select(F.lit(n).cast("bigint").alias("nprobe"), "found")
             for n in RECALL_WIDTHS]
    return functools.reduce(DataFrame.unionByName, found)


# --- K1: streaming -------------------------------------------------------------

def q_stream_chunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents land as the files their scan gives; the stream takes several of
    them per micro-batch, chunks at overlap 0, and the lossless digest per document is rebuilt from
    the streamed chunks (same oracle as chunk_lossless)."""
    from sparkretrieve.streaming.ingest import run_chunk_stream

    landing = scratch_path(spark, "landing")
    _documents(spark, sf_dir).write.parquet(landing)
    chunks, _ = run_chunk_stream(spark, landing, scratch_path(spark, "stream-out"),
                                 chunk_size=chunking.DEFAULT_CHUNK_SIZE, chunk_overlap=0,
                                 max_files_per_trigger=4)
    per_doc = chunks.groupBy("document_id").agg(
        F.array_sort(F.collect_list(F.struct("chunk_index", "text"))).alias("parts"),
        F.max(F.length("text")).alias("longest"))
    joined = F.array_join(F.transform("parts", lambda p: p["text"]), "")
    streamed = per_doc.select("document_id", F.md5(F.regexp_replace(joined, WHITESPACE_RE, "")).alias("digest"),
                              (F.col("longest") <= chunking.DEFAULT_CHUNK_SIZE).alias("within_size"))
    # Documents without any chunk (blank text) still have a digest (of "").
    all_docs = _documents(spark, sf_dir).select("document_id")
    return all_docs.join(streamed, "document_id", "left").select(
        "document_id", F.coalesce("digest", F.md5(F.lit(""))).alias("digest"),
        F.coalesce("within_size", F.lit(True)).alias("within_size"))


def q_stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some documents land, then all of them, every third with a shorter text;
    one stream takes both landings in turn. Per document: the digest of its
    chunks now, and in how many batches it was emitted."""
    from sparkretrieve.streaming.ingest import run_chunk_stream

    landing, out, checkpoint = (scratch_path(spark, n) for n in ("landing", "stream-out", "stream-ckpt"))
    docs = _documents(spark, sf_dir).withColumn("k", F.col("source_id").cast("bigint"))
    shorter = F.when(F.col("k") % 3 == 0, F.substring("text", F.lit(1), F.floor(F.length("text") / 2).cast("int"))).otherwise(F.col("text"))
    for rows in (docs.filter("k % 2 = 0 or k % 10 = 1"), docs.withColumn("text", shorter)):
        rows.drop("k").write.mode("append").parquet(landing)
        chunks, manifest = run_chunk_stream(spark, landing, out, chunk_overlap=0, checkpoint=checkpoint)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_index", "text"))), lambda p: p["text"]), "")
    now = chunks.groupBy("document_id").agg(F.md5(F.regexp_replace(joined, WHITESPACE_RE, "")).alias("digest"))
    emitted = manifest.select("document_id", "stream", "batch_id").distinct().groupBy("document_id").agg(F.count(F.lit(1)).alias("emitted"))
    return now.join(emitted, "document_id")


QUERIES: dict[str, QueryBuilder] = {
    "canonical_documents": q_canonical_documents,
    "tokenize_terms": q_tokenize_terms,
    "bm25_stats": q_bm25_stats,
    "bm25_idf": q_bm25_idf,
    "bm25_match": q_bm25_match,
    "bm25_topk": q_bm25_topk,
    "chunk_documents": q_chunk_documents,
    "chunk_summary": q_chunk_summary,
    "chunk_manifest": q_chunk_manifest,
    "chunk_lossless": q_chunk_lossless,
    "bm25_chunk_search": q_bm25_chunk_search,
    "chunk_lossless_small": q_chunk_lossless_small,
    "metadata_flatten": q_metadata_flatten,
    "embedding_request": q_embedding_request,
    "safe_record_id": q_safe_record_id,
    "hash_embed": q_hash_embed,
    "embedding_manifest": q_embedding_manifest,
    "vector_validate": q_vector_validate,
    "vector_reject": q_vector_reject,
    "index_info": q_index_info,
    "knn_cosine": q_knn_cosine,
    "knn_l2": q_knn_l2,
    "knn_ip": q_knn_ip,
    "semantic_search": q_semantic_search,
    "hybrid_rrf": q_hybrid_rrf,
    "hybrid_matched_by": q_hybrid_matched_by,
    "hybrid_drop_unknown": q_hybrid_drop_unknown,
    "hybrid_ivf": q_hybrid_ivf,
    "eval_cases": q_eval_cases,
    "eval_hit_at_k": q_eval_hit_at_k,
    "eval_summary": q_eval_summary,
    "eval_misses": q_eval_misses,
    "eval_hybrid": q_eval_hybrid,
    "eval_real_chunks": q_eval_real_chunks,
    "dump_page_parse": q_dump_page_parse,
    "ingest_manifest": q_ingest_manifest,
    "page_validity": q_page_validity,
    "ingest_upsert": q_ingest_upsert,
    "ann_full_probe": q_ann_full_probe,
    "ann_ivf": q_ann_ivf,
    "ann_recall": q_ann_recall,
    "stream_chunk": q_stream_chunk,
    "stream_upsert": q_stream_upsert,
    "bm25_update": q_bm25_update,
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hybrid search (BM25 + vector kNN, reciprocal rank fusion) for every benchmark query."""
    return q_hybrid_rrf(spark, sf_dir)
