"""Registered queries of the training-data operators: each applies one
operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkretrieve.llm import align, ann, bpe, divergence, exact_dedup, line_dedup, lm_score, packing, sharding, simhash, toxicity, url_filter, warc
from sparkretrieve.llm.common import materialise, table
from sparkretrieve.session import scratch_path

SHARDS = [f"shard-{k:03d}" for k in range(64)]
SLOTS = 16_381

# Fixed values of the URL filter's contract.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def tokenizer_path() -> str:
    """The vocabulary file of the public byte-level tokenizer."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_model_path() -> str:
    """The model file of the public tokenizer of pieces with byte fallback."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _sha256(text: str) -> Column:
    return F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=2)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)


def _fold(folds: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    train = F.coalesce(_fold(5) != 1, F.lit(False))
    scored = lm_score.score_texts(docs, train)
    return scored.withColumn("held_out", F.coalesce(_fold(5) == 1, F.lit(False)))


def op4_maglev_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return sharding.assign_shards(docs, F.col("doc_id"), SHARDS, SLOTS)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    held_out = F.coalesce(_fold(5) == 0, F.lit(False))
    return toxicity.score_toxicity(docs, labels, ~held_out).withColumn("held_out", held_out)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip_digests(docs, tokenizer_path())


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    groups = exact_dedup.duplicate_groups(docs, keep="max")
    return groups.select("doc_id", "keep_id", "group_size", "kept", _sha256("text").alias("text_sha256"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = line_dedup.drop_repeated_lines(docs, min_chars=20, min_docs=3)
    return cut.select("doc_id", "n_lines", "n_dropped", _sha256("text").alias("kept_sha256"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack_documents(docs, tokenizer_path(), max_tokens=2048, end_id=0)


def op10_multiprobe_lsh(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.nearest_neighbours(vectors, F.col("vec_id") % 100 == 0, k=10)


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    aligned = align.token_groups(docs, tokenizer_path(), piece_model_path())
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(_sha256("groups"))
    return align.score_links(aligned.withColumn("groups_sha256", digest).drop("groups"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("text", "lang", "source")
    return divergence.source_divergence(docs, min_docs=3, ranks=200)


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    plain, deduplicated = scratch_path(spark, "warc"), scratch_path(spark, "warc_deduplicated")
    warc.write_responses(pages, plain)
    warc.dedupe_archives(spark, plain, deduplicated, min_bytes=100)
    back = materialise(warc.read_archives(spark, deduplicated, payloads=False), "warc_back")
    return warc.resolve_revisits(back).select(F.col("row_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_simhash, op2_url_filter, op3_lm_score, op4_maglev_sharding, op5_toxicity, op6_bpe, op7_exact_dedup, op8_line_dedup, op9_packing,
        op10_multiprobe_lsh, op11_tokenizer_alignment, op12_source_divergence, op13_warc)
}
