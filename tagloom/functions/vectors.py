"""Vector functions as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_vector(col: Column | str) -> Column:
    """Vector from its text form `[a, b]`; NULL when it is not one."""
    return F.from_json(_col(col), "array<double>")


def vector_length(col: Column | str) -> Column:
    return F.size(_col(col))


def dot(a: Column | str, b: Column | str) -> Column:
    """Dot product of two vectors that share a row."""
    products = F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def norm(a: Column | str) -> Column:
    return F.sqrt(dot(a, a))


def cosine_similarity(a: Column | str, b: Column | str) -> Column:
    """Cosine of the angle between two vectors; NULL when one has no length."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))
