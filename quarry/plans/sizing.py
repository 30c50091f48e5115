"""Size-checked broadcasting.

A side is broadcast only after a measured bound: one small job reads at most
``max_rows + 1`` rows of it and sums their byte width.  If it is within both
limits the side is wrapped in ``F.broadcast``; otherwise it is returned as is and
the join is planned as a shuffle join, where AQE's skew-join split and runtime
coalescing take over.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_MAX_ROWS = 2_000_000
DEFAULT_MAX_BYTES = 64 * 1024 * 1024


def _width(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    dt = field.dataType
    if isinstance(dt, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + F.lit(16)
    if isinstance(dt, T.ArrayType):
        inner = dt.elementType
        if isinstance(inner, T.StringType):
            return F.coalesce(F.aggregate(c, F.lit(0), lambda a, x: a + F.octet_length(x) + 16),
                              F.lit(0)) + F.lit(16)
        return F.coalesce(F.size(c), F.lit(0)) * F.lit(8) + F.lit(16)
    if isinstance(dt, (T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)) + F.lit(16)
    return F.lit(8)


def byte_width(df: DataFrame) -> Column:
    total = F.lit(0)
    for field in df.schema.fields:
        total = total + _width(field)
    return total


@dataclass(frozen=True)
class SideSize:
    rows: int
    bytes: int
    exceeded: bool


def measure(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS) -> SideSize:
    """Rows and bytes of ``df``, reading at most ``max_rows + 1`` rows."""
    probe = df.limit(max_rows + 1)
    row = probe.agg(F.count(F.lit(1)).alias("n"),
                    F.coalesce(F.sum(byte_width(probe)), F.lit(0)).alias("b")).first()
    n, b = int(row["n"]), int(row["b"])
    return SideSize(rows=n, bytes=b, exceeded=n > max_rows)


def fits(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS,
         max_bytes: int = DEFAULT_MAX_BYTES) -> bool:
    size = measure(df, max_rows)
    return (not size.exceeded) and size.bytes <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS,
                       max_bytes: int = DEFAULT_MAX_BYTES) -> DataFrame:
    """``F.broadcast(df)`` when its measured size is within the bound, else ``df``."""
    return F.broadcast(df) if fits(df, max_rows, max_bytes) else df
