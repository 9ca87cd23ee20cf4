"""Vector records: load (C6), validate (D5-D7), describe (H5, H6), append (H4).

Validation produces a ``reject_reason`` column with the same message texts
as the studied loader; ``strict`` mode fails the job on the first reject,
lenient mode returns valid rows and rejects separately.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkretrieve.checks import check_metric, require_positive
from sparkretrieve.functions.metadata import empty_string_map
from sparkretrieve.functions.text import is_blank
from sparkretrieve.operators.sizing import broadcast_if_bounded

VECTOR_COLUMNS = ("record_id", "chunk_id", "document_id", "title", "vector", "metadata")


def to_vector_records(embedding_records: DataFrame) -> DataFrame:
    """Embedding record -> vector record columns (title null/empty -> "",
    elements cast to float, missing metadata -> {}), plus ``reject_reason``
    for D5."""
    vec = F.col("vector")
    reason = (
        F.when(vec.isNull() | (F.size(vec) <= 0), F.lit("embedding record vector must be a non-empty list"))
        .when(is_blank(F.col("record_id")), F.lit("embedding record record_id must be a non-empty string"))
        .when(is_blank(F.col("chunk_id")), F.lit("embedding record chunk_id must be a non-empty string"))
        .when(is_blank(F.col("document_id")), F.lit("embedding record document_id must be a non-empty string"))
    )
    return embedding_records.select(
        "record_id", "chunk_id", "document_id",
        F.coalesce(F.col("title"), F.lit("")).alias("title"),
        vec.cast("array<float>").alias("vector"),
        F.coalesce(F.col("metadata"), empty_string_map()).alias("metadata"),
        reason.alias("reject_reason"),
    )


def with_dimension_check(records: DataFrame, dimensions: int) -> DataFrame:
    """Every record must have ``dimensions`` elements."""
    require_positive(dimensions, "dimensions")
    n = F.size("vector")
    msg = F.concat(F.lit(f"expected vector dimension {dimensions}, got "), n.cast("string"),
                   F.lit(" for record_id="), F.col("record_id"))
    return records.withColumn(
        "reject_reason",
        F.coalesce(F.col("reject_reason"), F.when(n != dimensions, msg)),
    )


def with_duplicate_check(records: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """A record_id already in ``existing`` or repeated within the batch is
    rejected (the batch rule is stricter than the studied index, on purpose).

    Duplicate ids are found by an aggregate (partial counts, no hot group) and
    joined back; the id list is broadcast only when measured small.
    """
    # Blank ids are rejected for being blank; they never meet in one group.
    records = records.withColumn("_key", F.when(~is_blank("record_id"), F.col("record_id")))
    keyed = records.filter(F.col("_key").isNotNull()).select(F.col("_key"))
    dup = keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_key")
    if existing is not None:
        dup = dup.unionByName(existing.select(F.col("record_id").alias("_key")).join(keyed, "_key", "left_semi"))
    dup = dup.distinct().withColumn("_dup", F.lit(True))
    # The duplicate-id list is small; written once, its size check does not
    # aggregate the whole vector table a second time.
    from sparkretrieve.session import scratch_path

    path = scratch_path(records.sparkSession, "dup-ids")
    dup.write.parquet(path)
    dup_side, _ = broadcast_if_bounded(records.sparkSession.read.parquet(path))
    hit = records.filter(F.col("_key").isNotNull()).join(dup_side, "_key", "left")
    out = hit.unionByName(records.filter(F.col("_key").isNull()).withColumn("_dup", F.lit(None).cast("boolean")))
    msg = F.concat(F.lit("duplicate vector record_id: "), F.col("record_id"))
    return out.withColumn(
        "reject_reason", F.coalesce(F.col("reject_reason"), F.when(F.col("_dup"), msg))
    ).drop("_dup", "_key")


def validate_vector_records(embedding_records: DataFrame, dimensions: int, *,
                            existing: DataFrame | None = None) -> DataFrame:
    """C6 + D5 + D6 + D7: all rows with their ``reject_reason`` (null = valid)."""
    recs = to_vector_records(embedding_records)
    recs = with_dimension_check(recs, dimensions)
    return with_duplicate_check(recs, existing)


def split_valid(checked: DataFrame, strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """(valid, rejects). In strict mode the first reject raises (an action)."""
    rejects = checked.filter(F.col("reject_reason").isNotNull())
    if strict:
        first = rejects.select("reject_reason").first()
        if first is not None:
            raise ValueError(first.reject_reason)
    valid = checked.filter(F.col("reject_reason").isNull()).select(*VECTOR_COLUMNS)
    return valid, rejects


@dataclass
class VectorIndex:
    """A vector table plus its contract: dimensions and metric."""

    records: DataFrame
    dimensions: int
    metric: str = "cosine"
    name: str = "exact"

    def info(self) -> DataFrame:
        """H5: one row (name, dimensions, metric, records_count)."""
        return self.records.agg(F.count(F.lit(1)).cast("bigint").alias("records_count")).select(
            F.lit(self.name).alias("name"), F.lit(self.dimensions).cast("bigint").alias("dimensions"),
            F.lit(self.metric).alias("metric"), "records_count",
        )

    def add(self, embedding_records: DataFrame, strict: bool = True) -> "VectorIndex":
        """H4: validate all, then append (all-or-nothing in strict mode)."""
        checked = validate_vector_records(embedding_records, self.dimensions, existing=self.records)
        valid, _ = split_valid(checked, strict=strict)
        return VectorIndex(self.records.unionByName(valid), self.dimensions, self.metric, self.name)


def infer_dimensions(records: DataFrame) -> DataFrame:
    """H6: one row (min_dim, max_dim, records); a single index needs min = max."""
    n = F.size("vector")
    return records.agg(F.min(n).alias("min_dim"), F.max(n).alias("max_dim"),
                       F.count(F.lit(1)).alias("records"))


def build_vector_index(records: DataFrame, metric: str = "cosine", *, validate: bool = True,
                       strict: bool = True) -> VectorIndex:
    """H6: dimensions from the records (all must agree), then D5-D7."""
    check_metric(metric)
    dims = infer_dimensions(records).first()
    if dims is None or not dims.records:
        raise ValueError("records cannot be empty")
    if dims.min_dim != dims.max_dim:
        raise ValueError(f"expected vector dimension {dims.max_dim}, got {dims.min_dim}")
    index = VectorIndex(records.select(*VECTOR_COLUMNS), int(dims.max_dim), metric)
    if validate:
        checked = validate_vector_records(records, index.dimensions)
        valid, _ = split_valid(checked, strict=strict)
        index = VectorIndex(valid, index.dimensions, metric)
    return index
