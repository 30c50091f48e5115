"""Vector column expressions over ``array<float|double>`` columns.

These are Spark higher-order functions: fine for per-row normalization, too slow
for exhaustive similarity search (see ``operators.dense`` for the matmul form).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double_array(vec) -> Column:
    return _col(vec).cast("array<double>")


def l2_norm(vec) -> Column:
    v = to_double_array(vec)
    return F.sqrt(F.aggregate(v, F.lit(0.0).cast("double"), lambda acc, x: acc + x * x))


def l2_normalize(vec) -> Column:
    """Divide by the L2 norm; a zero vector stays zero, null stays null."""
    v = to_double_array(vec)
    # The norm goes through an array of one: named in the inner function it would be summed again for every element.
    scaled = F.transform(F.array(l2_norm(v)), lambda norm: F.when(norm > 0, F.transform(v, lambda x: x / norm)).otherwise(v))
    return F.element_at(scaled, 1)


def dot(a, b) -> Column:
    prod = F.zip_with(to_double_array(a), to_double_array(b), lambda x, y: x * y)
    return F.aggregate(prod, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def _md5_prefix(token) -> Column:
    # First 32 bits of md5(token) as a non-negative integer.
    return F.conv(F.substring(F.md5(_col(token)), 1, 8), 16, 10).cast("bigint")


def hash_bucket(token, dim: int = 128) -> Column:
    """Feature-hashing bucket of a token (test encoder, SQL-reproducible)."""
    return F.pmod(_md5_prefix(token), F.lit(dim)).cast("int")


def hash_sign(token, dim: int = 128) -> Column:
    """+1 / -1 from the md5 bit just above the bucket bits."""
    bit = F.floor(_md5_prefix(token) / F.lit(dim)) % 2
    return (F.lit(1) - F.lit(2) * bit).cast("double")
