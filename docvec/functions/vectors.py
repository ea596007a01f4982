"""Vector columns in the JVM. For scoring many rows see ``operators.search``."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    pairs = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(pairs, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors, 0 if one has no length."""
    lengths = norm(a) * norm(b)
    return F.when(lengths > 0, dot(a, b) / lengths).otherwise(F.lit(0.0))


def has_size(a: Column, dim: int) -> Column:
    """The vector itself, after a check of its size."""
    message = F.concat(F.lit(f"vector must have {dim} values, has "), F.size(a))
    return F.when(F.size(a) == dim, a).otherwise(F.raise_error(message))
