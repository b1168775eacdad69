"""Join strategies whose choice is backed by a size check, never by hope."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest side to broadcast. It is built on the driver and copied to every
# executor, so rows and bytes are hard bounds, whatever the other side holds.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 64 << 20
ROW_OVERHEAD = 16


def size_of(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of a written or persisted table, by one aggregate with a
    partial sum per task. Strings count with their length, the rest by width."""
    width = F.lit(ROW_OVERHEAD)
    for name, kind in df.dtypes:
        if kind == "string":
            width = width + F.coalesce(F.octet_length(F.col(name)), F.lit(0)) + 8
        elif kind.startswith("array"):
            width = width + F.coalesce(F.size(F.col(name)), F.lit(0)) * 8 + 8
        else:
            width = width + 8
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width.cast("bigint")).alias("b")).first()
    return int(r["n"]), int(r["b"] or 0)


def is_bounded(df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> bool:
    rows, size = size_of(df)
    return (rows <= (BROADCAST_MAX_ROWS if max_rows is None else max_rows)
            and size <= (BROADCAST_MAX_BYTES if max_bytes is None else max_bytes))
