"""Vector columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity in double precision; zero when either vector has no length."""
    norms = F.sqrt(dot(a, a) * dot(b, b))
    return F.when(norms > 0, dot(a, b) / norms).otherwise(F.lit(0.0))


def has_dims(vector: Column, dims: int) -> Column:
    """True when the vector has exactly the configured length."""
    return F.coalesce(F.size(vector) == dims, F.lit(False))
