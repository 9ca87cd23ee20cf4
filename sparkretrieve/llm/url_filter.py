"""URL filter: rules first, then a character language-model ratio (native).

Rules decide what they fit. The URLs they decide are also the training data:
two variable-order Markov models of characters, one of accepted and one of
rejected URLs, smoothed by interpolating every order with the next lower one
(each context's weight is its number of distinct followers, so unseen contexts
back off entirely). An undecided URL is judged by the difference of its two
log-likelihoods, normalised by its length, against a threshold calibrated on
labelled URLs that were held out of the counts.

All in DataFrame operations: distinct URLs are counted once, then distinct
character n-grams; lower orders are aggregated from these, never from the
URLs. Scores of n-grams are rounded to millionths and summed as integers, so
the result does not depend on the order of rows or the engine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkretrieve.llm.common import ascii_lower, materialise

MAX_ORDER = 4
HELD_OUT_FOLDS = 5
BIN = 10_000  # calibration steps, in millionths of a nat per character
START, END = "\x02", "\x03"


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path). Host: after the first :// up to /, ?, # or the end, A-Z
    lower-cased. Path: from there up to ?, # or the end. Both are empty for
    null or without ://."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls. ``rules``:
    (verdict, 'host/path'); a rule fits its host and all subdomains where the
    path starts with the rule's. Of equally long rules the last wins."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, text in sorted(rules, key=lambda r: len(r[1])):  # the longest is asked first
        if action not in ("allow", "block") or "/" not in text:
            raise ValueError("a rule is ('allow' or 'block', 'host/path')")
        at = text.index("/")
        name, start = text[:at], text[at:]
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(action)).otherwise(verdict)
    return rule, verdict


def _grams(urls: DataFrame, order: int) -> DataFrame:
    """One row per character (and the end) of each URL, with the ``order``
    characters before it."""
    chars = F.split(F.concat(F.lit(START * order), F.col("url"), F.lit(END)), "")
    return urls.withColumn("chars", chars).select(
        *urls.columns,
        F.explode(F.transform(F.sequence(F.lit(1), F.size("chars") - order),
                              lambda i: F.array_join(F.slice("chars", i, order + 1), ""))).alias("gram"))


def gram_scores(counts: DataFrame, order: int) -> DataFrame:
    """(gram, delta long): ln P(last | before) of the accepted model minus that
    of the rejected one, in millionths. ``counts``: (gram, a, r)."""
    lower: DataFrame | None = None
    for j in range(order + 1):
        level = counts.groupBy(F.substring("gram", order + 1 - j, j + 1).alias("g")) \
            .agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
        # A context has at most as many followers as the alphabet has letters.
        context = Window.partitionBy(F.substring("g", 1, j))
        for c in ("a", "r"):
            level = level.withColumn(f"n{c}", F.sum(c).over(context).cast("double")) \
                .withColumn(f"t{c}", F.sum((F.col(c) > 0).cast("int")).over(context).cast("double"))
        if lower is None:
            size = F.count(F.lit(1)).over(context).cast("double")
            level = level.withColumn("la", 1.0 / size).withColumn("lr", 1.0 / size)
        else:
            level = level.withColumn("tail", F.substring("g", 2, j)).join(
                lower.select(F.col("g").alias("tail"), F.col("pa").alias("la"), F.col("pr").alias("lr")), "tail")
        for c in ("a", "r"):
            n, t, low = F.col(f"n{c}"), F.col(f"t{c}"), F.col(f"l{c}")
            level = level.withColumn(f"p{c}", F.when(n + t > 0, (F.col(c) + t * low) / (n + t)).otherwise(low))
        lower = level.select("g", "pa", "pr")
    return lower.select(F.col("g").alias("gram"),
                        F.round((F.log("pa") - F.log("pr")) * 1e6).cast("long").alias("delta"))


def _threshold(scored: DataFrame) -> int | None:
    """The calibrated bin: the lowest balanced error on held-out labelled URLs,
    of equals the nearest to zero. None without held-out URLs of both kinds."""
    bins = scored.filter("action is not null and held_out").groupBy("bin").agg(
        F.sum(F.when(F.col("action") == "allow", F.col("copies")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("action") == "block", F.col("copies")).otherwise(0)).alias("r"))
    # Log-probabilities are bounded, and so is the number of bins: some thousands.
    upto, everything = Window.orderBy("bin"), Window.partitionBy()
    steps = bins.select("bin", (F.sum("a").over(upto) - F.col("a")).alias("lost"),
                        (F.sum("r").over(everything) - F.sum("r").over(upto) + F.col("r")).alias("let"),
                        F.sum("a").over(everything).alias("na"), F.sum("r").over(everything).alias("nr"))
    best = steps.filter("na > 0 and nr > 0") \
        .select("bin", (F.col("lost") / F.col("na") + F.col("let") / F.col("nr")).alias("error")) \
        .orderBy("error", F.abs("bin"), "bin").first()
    return None if best is None else best["bin"]


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]], id_col: str = "page_id",
               url_col: str = "url", order: int = MAX_ORDER) -> DataFrame:
    """(id, host, path, rule, verdict, score) for every row of ``pages``.

    ``verdict`` is the rule's or, where no rule fits, the model's: allow if
    ``score`` (mean log-likelihood difference per character, accepted minus
    rejected) reaches the calibrated threshold. Without labelled URLs of both
    kinds there is nothing to learn, and undecided URLs are allowed. Null URLs
    count as empty and are judged by the model; copies of a URL get one
    verdict; repeated rows stay; other columns are not read. An empty table
    gives an empty result.
    """
    url = F.coalesce(F.col(url_col), F.lit(""))
    host, path = url_parts(F.col("url"))
    rule, action = longest_rule(host, path, rules)
    fold = F.conv(F.substring(F.md5(F.col("url").cast("binary")), 1, 8), 16, 10).cast("long") % HELD_OUT_FOLDS
    urls = pages.groupBy(url.alias("url")).agg(F.count(F.lit(1)).alias("copies")) \
        .withColumn("action", action).withColumn("held_out", fold == 0)
    urls = materialise(urls, "urls")

    def counted(kind: str) -> Column:
        return F.sum(F.when((F.col("action") == kind) & ~F.col("held_out"), F.col("copies")).otherwise(0))

    counts = _grams(urls, order).groupBy("gram").agg(counted("allow").alias("a"), counted("block").alias("r"))
    deltas = gram_scores(materialise(counts, "grams"), order)
    scored = _grams(urls, order).join(deltas, "gram").groupBy("url", "action", "held_out", "copies") \
        .agg(F.sum("delta").alias("total"), F.count(F.lit(1)).alias("n")) \
        .withColumn("bin", F.floor(F.col("total") / (F.col("n") * BIN)).cast("long"))
    scored = materialise(scored, "scores")
    threshold = _threshold(scored)
    judged = F.lit("allow") if threshold is None else \
        F.when(F.col("bin") >= threshold, F.lit("allow")).otherwise(F.lit("block"))
    by_url = scored.select("url", "action", (F.col("total") / F.col("n") / 1e6).alias("score"), judged.alias("judged"))
    return pages.select(F.col(id_col), url.alias("url")).join(by_url, "url").select(
        id_col, host.alias("host"), path.alias("path"), rule.alias("rule"),
        F.coalesce("action", "judged").alias("verdict"), "score")
