"""Exact duplicates by content sort (native DataFrame operators only).

Texts are dealt by *sampled range splitters*, sorted externally by Spark
within each range, and neighbouring rows are compared in full: a window whose
partition key is the whole text opens a new group exactly where two
neighbours differ. The splitters are taken from a short key (the first
characters and a 64-bit hash) so that the driver's sample holds no whole
texts; the comparison itself is always on whole texts.

Skew: a text that alone would overfill a range is *hot*. Hot hashes are found
by a pre-aggregated count; their rows get a salt, which is part of the range
key, so their copies are sorted and compared in several ranges. What holds
over all runs of a hot text (which identifier stays, how many copies) comes
from an aggregation on the text's SHA-256 digest with partial combine. At most
``partitions / HOT_SHARE`` texts can be hot, which bounds both tables that are
broadcast, in bytes as well: they hold hashes and digests, no texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkretrieve.llm.common import free_name

SPLITTER_CHARS = 32
# A text is hot if its copies fill more than this share of an even partition.
HOT_SHARE = 0.25


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     keep: str = "max") -> DataFrame:
    """One row per row of ``docs``: all its columns and keep_id, group_size, kept.

    Texts are equal when identical; a null text counts as empty. ``keep`` is
    'min' or 'max': the identifier that stays. A null identifier loses against
    any other. If several rows carry the identifier that stays (repeated
    rows), exactly one of them has ``kept`` true. An empty table gives an
    empty result. Columns named like a result column are replaced by it.
    """
    if keep not in ("min", "max"):
        raise ValueError("keep must be 'min' or 'max'")
    results = {"keep_id", "group_size", "kept"}
    if {id_col.lower(), text_col.lower()} & results:
        raise ValueError("id and text columns must not be named like a result")
    docs = docs.drop(*[c for c in docs.columns if c.lower() in results])
    t, p, h, s, salts, run_keep, run_n, run_rn, all_keep, all_n, all_t = (
        free_name(docs, k) for k in ("_t", "_prefix", "_hash", "_salt", "_salts", "_run_keep", "_run_n",
                                     "_run_rn", "_all_keep", "_all_n", "_all_t"))
    hashed = docs.withColumn(t, F.coalesce(F.col(text_col), F.lit(""))) \
        .withColumn(h, F.xxhash64(t)).withColumn(p, F.substring(t, 1, SPLITTER_CHARS))

    # Hot texts, by hash (a hash collision only salts a text needlessly).
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = docs.select(F.count(F.lit(1)).alias("n")).first()["n"]
    limit = max(16, int(HOT_SHARE * total / max(1, parts)))
    hot = hashed.groupBy(h).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > limit) \
        .select(h, F.ceil(F.col("n") / limit).cast("int").alias(salts))
    salted = hashed.join(F.broadcast(hot), h, "left") \
        .withColumn(s, F.coalesce(F.pmod(F.xxhash64(id_col), F.col(salts).cast("long")), F.lit(0).cast("long")))

    # Sort by content and compare neighbours: the window's key holds every
    # range column, so it keeps the range partitioning and there is one shuffle.
    pick = F.max if keep == "max" else F.min
    order = F.col(id_col).desc_nulls_last() if keep == "max" else F.col(id_col).asc_nulls_last()
    same = Window.partitionBy(p, h, s, t)
    runs = salted.repartitionByRange(F.col(p), F.col(h), F.col(s)) \
        .withColumn(run_rn, F.row_number().over(same.orderBy(order))) \
        .withColumn(run_keep, F.first(id_col).over(same.orderBy(order))) \
        .withColumn(run_n, F.count(F.lit(1)).over(same))

    # Hot texts over all their runs: compared in full within each run, and over
    # the runs by a 256-bit digest, computed on texts with a hot hash only. One
    # row per hot text and no text in it, so bounded like `hot`.
    digest = F.when(F.col(salts).isNotNull(), F.sha2(F.col(t).cast("binary"), 256))
    whole = salted.filter(F.col(salts).isNotNull()).groupBy(digest.alias(all_t)) \
        .agg(pick(id_col).alias(all_keep), F.count(F.lit(1)).alias(all_n))
    keep_id = F.when(F.col(all_n).isNull(), F.col(run_keep)).otherwise(F.col(all_keep))
    return runs.join(F.broadcast(whole), digest == F.col(all_t), "left").select(
        *docs.columns,
        keep_id.alias("keep_id"),
        F.coalesce(F.col(all_n), F.col(run_n)).alias("group_size"),
        ((F.col(run_rn) == 1) & F.col(run_keep).eqNullSafe(keep_id)
         & (F.col(s) == F.coalesce(F.pmod(F.xxhash64(keep_id), F.col(salts).cast("long")),
                                   F.lit(0).cast("long")))).alias("kept"),
    )
