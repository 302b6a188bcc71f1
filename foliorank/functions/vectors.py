"""Dense vectors as ``array<double>`` columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_doubles(vector: str | Column) -> Column:
    """An array of any number type as ``array<double>``."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    return vector.cast("array<double>")


def dot(u: str | Column, v: str | Column) -> Column:
    products = F.zip_with(u, v, lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(v: str | Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda total, x: total + x * x))


def cosine_similarity(u: str | Column, v: str | Column) -> Column:
    """Cosine of two vectors; null when either has no length."""
    return F.try_divide(dot(u, v), norm(u) * norm(v))


def add(u: str | Column, v: str | Column) -> Column:
    return F.zip_with(u, v, lambda a, b: a + b)


def subtract(u: str | Column, v: str | Column) -> Column:
    return F.zip_with(u, v, lambda a, b: a - b)
