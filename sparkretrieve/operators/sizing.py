"""Size checks that stand in front of every broadcast.

A side is broadcast only after its rows and bytes have been measured against
bounds; beyond either the caller takes a shuffle path instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows of a narrow key table (ids, a term, a few numbers), and bytes of any
# table, that are safe to ship to every executor; Spark's own limit is 8 GB.
DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
DEFAULT_MAX_BROADCAST_BYTES = 256 << 20


def bounded_count(df: DataFrame, bound: int) -> int:
    """Count rows, but stop reading once ``bound + 1`` rows were seen."""
    return df.limit(bound + 1).count()


def _field_bytes(name: str, kind: T.DataType) -> Column:
    c = F.col(f"`{name}`")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 16
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.octet_length(F.to_json(F.struct(c))) + 16
    return F.lit(8)


def row_bytes(schema: T.StructType) -> Column:
    """About how many bytes a row has."""
    return sum((_field_bytes(f.name, f.dataType) for f in schema), F.lit(16)).cast("bigint")


def bounded_size(df: DataFrame, max_rows: int) -> tuple[int, int]:
    """(rows, bytes) of at most ``max_rows + 1`` rows."""
    row = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(row_bytes(df.schema)), F.lit(0)).alias("b")).first()
    return int(row["n"]), int(row["b"])


def broadcast_if_bounded(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS, *,
                         upper_bound: int | None = None,
                         max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """(``broadcast(df)``, True) when ``df`` has at most ``max_rows`` rows and
    ``max_bytes`` bytes, else (``df``, False) so the caller can plan a shuffle join.

    ``upper_bound`` is a proven bound on the row count of narrow rows (e.g.
    queries x k for a top-k result); when given, the frame is not measured,
    which would run its whole plan a second time."""
    if upper_bound is not None:
        small = upper_bound <= max_rows
    else:
        n, size = bounded_size(df, max_rows)
        small = n <= max_rows and size <= max_bytes
    return (F.broadcast(df), True) if small else (df, False)
