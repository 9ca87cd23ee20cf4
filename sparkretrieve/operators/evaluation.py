"""Retrieval evaluation.

Cases are a DataFrame keyed by ``case_id`` (never by query text: equal
queries are separate cases). A retriever is any function
``(queries_df, top_k) -> results_df`` with (query_id, rank, chunk_id,
document_id, ...) -- BM25, semantic or hybrid search all fit (J4).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkretrieve.checks import require_positive
from sparkretrieve.functions.text import TOKEN_PATTERN, is_blank, py_strip, tokenize
from sparkretrieve.operators.sizing import broadcast_if_bounded, bounded_count

Retriever = Callable[[DataFrame, int], DataFrame]

MAX_GRAMS = 1000  # more different grams are matched in the join instead of within each text

CASE_SCHEMA = "case_id bigint, query string, expected_document_id string, expected_chunk_id string"


# --- A6 / D8: JSONL cases -----------------------------------------------------

def _type_of(v, path: str):
    return F.schema_of_variant(F.try_variant_get(v, path, "variant"))


def read_eval_cases(spark: SparkSession, path: str, *, validate: bool = True) -> DataFrame:
    """JSONL -> cases. Blank lines are skipped; a malformed line fails with its
    1-based line number; a file without cases fails.

    Line numbers come from ``monotonically_increasing_id`` order, which is
    file order for a single file; they are computed only when a line is bad.
    """
    try:
        lines = spark.read.text(path)
    except AnalysisException as exc:
        raise FileNotFoundError(f"Evaluation dataset not found: {path}") from exc
    lines = lines.withColumn("_pos", F.monotonically_increasing_id())
    rows = lines.filter(~is_blank("value"))
    v = F.try_parse_json(py_strip("value"))
    qt, dt, ct = _type_of(v, "$.query"), _type_of(v, "$.expected_document_id"), _type_of(v, "$.expected_chunk_id")
    q = F.try_variant_get(v, "$.query", "string")
    d = F.try_variant_get(v, "$.expected_document_id", "string")
    reason = (
        F.when(v.isNull(), F.lit("invalid JSON"))
        .when((qt != "STRING") | qt.isNull() | is_blank(q), F.lit("query must be a non-empty string"))
        .when((dt != "STRING") | dt.isNull() | is_blank(d),
              F.lit("expected_document_id must be a non-empty string"))
        .when(ct.isNotNull() & ~ct.isin("STRING", "VOID"), F.lit("expected_chunk_id must be a string or null"))
    )
    parsed = rows.select(
        "_pos", q.alias("query"), d.alias("expected_document_id"),
        F.try_variant_get(v, "$.expected_chunk_id", "string").alias("expected_chunk_id"),
        reason.alias("_reason"),
    )
    if validate:
        bad = parsed.filter(F.col("_reason").isNotNull()).orderBy("_pos").select("_pos", "_reason").first()
        if bad is not None:
            line_no = lines.filter(F.col("_pos") <= bad["_pos"]).count()
            raise ValueError(f"Line {line_no}: {bad['_reason']}")
        if parsed.isEmpty():
            raise ValueError(f"No evaluation cases found in: {path}")
    return parsed.filter(F.col("_reason").isNull()).select(
        F.col("_pos").alias("case_id"), "query", "expected_document_id", "expected_chunk_id")


# --- Cases from a corpus ------------------------------------------------------

def contained_item_cases(items: DataFrame, documents: DataFrame, term_df: DataFrame | None = None,
                         postings: DataFrame | None = None, *, item_id: str = "item_id",
                         item_text: str = "text") -> DataFrame:
    """Cases = (item, smallest document whose text contains the item).

    Containment is found with an equi-join, not a cross product: an item's
    *interior* tokens (those not touching its first or last character) are
    whole tokens of any text containing it, so one interior token per item
    (the anchor) is joined with document tokens to get candidates, which are
    then checked with ``contains``. With an index (``postings`` (term,
    document_id) and ``term_df`` (term, df)) the rarest interior token is the
    anchor; without one, the longest (ties: smallest) and the documents are
    tokenised in the same pass. Items without an interior token (at most two
    tokens) are anchored on their first characters instead (``_ngram_matches``).
    Empty items are not cases (a case needs a non-empty query).
    """
    tok_char = f"^{TOKEN_PATTERN[:-1]}"  # one token character
    text = F.col(item_text)
    toks = tokenize(text)
    n = F.size(toks)
    start = F.when(text.rlike(tok_char), 1).otherwise(0)
    end = F.when(F.reverse(text).rlike(tok_char), 1).otherwise(0)
    it = items.select(
        F.col(item_id).alias("case_id"), text.alias("query"),
        F.slice(toks, start + 1, F.greatest(n - start - end, F.lit(0))).alias("interior"),
    )
    anchored = it.filter(F.size("interior") > 0)
    cand_terms = anchored.select("case_id", F.explode(F.array_distinct("interior")).alias("term"))
    if term_df is not None and postings is not None:
        terms_side, _ = broadcast_if_bounded(cand_terms)
        anchors = (term_df.select("term", "df").join(terms_side, "term")
                   .groupBy("case_id").agg(F.min_by("term", F.struct("df", "term")).alias("term")))
        doc_terms = postings.select("term", "document_id")
    else:
        anchors = cand_terms.groupBy("case_id").agg(
            F.min_by("term", F.struct(-F.length("term"), F.col("term"))).alias("term"))
        # explode_outer + filter: a plain explode would tokenise twice (inferred filter).
        doc_terms = (documents.select("document_id", F.explode_outer(F.array_distinct(tokenize("text"))).alias("term"))
                     .filter(F.col("term").isNotNull()))
    anchor_side, _ = broadcast_if_bounded(anchors)
    candidates = doc_terms.join(anchor_side, "term").select("case_id", "document_id")
    docs = documents.select("document_id", F.struct(F.col("source_id").try_cast("bigint").alias("n"), F.col("source_id").alias("s")).alias("_doc_key"), "text")
    queries = it.select("case_id", "query")
    q_side, _ = broadcast_if_bounded(queries)
    # Candidate pairs are few (postings of one anchor per item). They are
    # written once (the corpus is tokenised once), counted from that table and
    # broadcast, so the document texts are checked where they are scanned.
    cand_side, _ = broadcast_if_bounded(_written(candidates.join(q_side, "case_id"), "eval-candidates"))
    checked = docs.join(cand_side, "document_id").filter(F.col("text").contains(F.col("query")))
    found = checked.select("case_id", "query", "_doc_key", "document_id")

    unanchored = it.filter((F.size("interior") == 0) & (F.length("query") > 0)).select("case_id", "query")
    if bounded_count(unanchored, 0) > 0:
        found = found.unionByName(_ngram_matches(unanchored, docs))

    best = found.groupBy("case_id", "query").agg(
        F.min_by("document_id", F.struct("_doc_key", "document_id")).alias("expected_document_id"))
    return best.select(
        F.col("case_id"), "query", "expected_document_id",
        F.lit(None).cast("string").alias("expected_chunk_id"),
    )


def _written(df: DataFrame, name: str) -> DataFrame:
    """Write a small intermediate table to the shared checkpoint folder and
    read it back (cuts lineage; counting it no longer re-runs its plan)."""
    from sparkretrieve.session import scratch_path

    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _ngram_matches(items: DataFrame, docs: DataFrame, n_max: int = 3) -> DataFrame:
    """Exact containment for items without an interior token, still as an
    equi-join: a text containing the item contains its first ``n`` characters
    (n = min(len, n_max)). Documents are cut into character n-grams of only
    the lengths needed, semi-joined with the broadcast item n-grams, and the
    few candidates checked with ``contains``. Runs only when such items exist."""
    ua = items.withColumn("n", F.least(F.length("query"), F.lit(n_max))).withColumn(
        "gram", F.expr("substring(query, 1, n)"))
    lengths = sorted({r.n for r in ua.select("n").distinct().collect()})  # at most n_max values
    ua_side, _ = broadcast_if_bounded(ua.select("n", "gram", "case_id", "query"))
    wanted = {n: [r.gram for r in ua.filter(F.col("n") == n).select("gram").distinct().limit(MAX_GRAMS + 1).collect()]
              for n in lengths}
    grams = None
    for n in lengths:
        cut = F.transform(
            F.sequence(F.lit(1), F.greatest(F.length("text") - n + 1, F.lit(1))),
            lambda i: F.substring(F.col("text"), i, n))
        if len(wanted[n]) <= MAX_GRAMS:
            # Few grams are asked for: everything else is dropped inside the array.
            cut = F.array_intersect(F.array(*[F.lit(g) for g in wanted[n]]), cut)
        else:
            cut = F.array_distinct(cut)
        part = (docs.select("document_id", F.lit(n).alias("n"), F.explode_outer(cut).alias("gram"))
                .filter(F.length("gram") == n))
        grams = part if grams is None else grams.unionByName(part)
    candidates = grams.join(ua_side, ["n", "gram"]).select("case_id", "query", "document_id").distinct()
    cand_side, _ = broadcast_if_bounded(_written(candidates, "eval-ngram-candidates"))
    return (docs.join(cand_side, "document_id").filter(F.col("text").contains(F.col("query")))
            .select("case_id", "query", "_doc_key", "document_id"))


# --- J1-J3, J5, D10 -------------------------------------------------------------

def evaluate(cases: DataFrame, retriever: Retriever, top_k: int) -> DataFrame:
    """One row per case with hit, matched ids, matched rank and result count.

    The match is the first result (lowest rank) whose document equals the
    expected document and, when an expected chunk is given, whose chunk does
    too. Cases and results are written once: whatever the retriever does with
    its queries, neither is computed again.
    """
    cases, results = run_cases(cases, retriever, top_k)
    return evaluate_results(cases, results)


def run_cases(cases: DataFrame, retriever: Retriever, top_k: int) -> tuple[DataFrame, DataFrame]:
    """(cases, results), both as written tables: at most ``top_k`` rows a case."""
    require_positive(top_k, "top_k")
    cases = _written(cases, "eval-cases")
    results = retriever(cases.select(F.col("case_id").alias("query_id"), "query"), top_k)
    return cases, _written(results, "eval-results")


def evaluate_results(cases: DataFrame, results: DataFrame) -> DataFrame:
    res = results.select(F.col("query_id").alias("case_id"), "rank", "chunk_id", "document_id")
    joined = cases.join(res, "case_id", "left")
    matches = (F.col("document_id") == F.col("expected_document_id")) & (
        F.col("expected_chunk_id").isNull() | (F.col("chunk_id") == F.col("expected_chunk_id")))
    first = F.min_by(F.struct("document_id", "chunk_id", "rank"), F.when(matches, F.col("rank")))
    agg = joined.groupBy("case_id", "query", "expected_document_id", "expected_chunk_id").agg(
        first.alias("m"), F.count("rank").alias("n_results"))
    return agg.select(
        "case_id", "query", "expected_document_id", "expected_chunk_id",
        F.col("m.document_id").isNotNull().alias("hit"),
        F.col("m.document_id").alias("matched_document_id"),
        F.col("m.chunk_id").alias("matched_chunk_id"),
        F.col("m.rank").alias("matched_rank"),
        F.col("n_results").cast("bigint").alias("n_results"),
    )


def summarize(evaluated: DataFrame) -> DataFrame:
    """Total, hits, misses, hit_rate (0.0 without cases)."""
    total = F.count(F.lit(1))
    hits = F.count_if(F.col("hit"))
    return evaluated.agg(total.alias("total_cases"), hits.alias("hits")).select(
        F.col("total_cases").cast("bigint").alias("total_cases"), F.col("hits").cast("bigint").alias("hits"),
        (F.col("total_cases") - F.col("hits")).cast("bigint").alias("misses"),
        F.when(F.col("total_cases") > 0, F.col("hits") / F.col("total_cases")).otherwise(F.lit(0.0)).alias("hit_rate"),
    )


def misses_report(evaluated: DataFrame, results: DataFrame, n: int = 3) -> DataFrame:
    """Each missed case with its first ``n`` results, or "no results"."""
    misses = evaluated.filter(~F.col("hit")).select("case_id", "query", "expected_document_id", "expected_chunk_id")
    top = results.filter(F.col("rank") <= n).select(
        F.col("query_id").alias("case_id"), "rank", "document_id", "chunk_id", "title", "score")
    grouped = top.groupBy("case_id").agg(F.array_sort(F.collect_list(F.struct(
        "rank", "document_id", "chunk_id", "title", "score"))).alias("top"))
    out = misses.join(grouped, "case_id", "left")
    line = F.transform("top", lambda r: F.format_string(
        "%s | %s | %s | score=%.4f", r["document_id"], r["chunk_id"], r["title"], r["score"]))
    return out.select(
        "case_id", "query", "expected_document_id", "expected_chunk_id",
        F.coalesce(F.array_join(line, "\n"), F.lit("no results")).alias("retrieved"),
    )
