"""Vectors are arrays of floats; sums run in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Inner product; for unit vectors this is the cosine."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def normalize(v: Column) -> Column:
    """Unit vector; null for the zero vector, which has no direction."""
    length = norm(v)
    return F.when(length > 0, F.transform(v, lambda x: x.cast("double") / length))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors of any length, null if one of them is zero."""
    scale = norm(a) * norm(b)
    return F.when(scale > 0, dot(a, b) / scale)


def to_text(v: Column) -> Column:
    """`[x,y,...]` with eight decimals."""
    items = F.transform(v, lambda x: F.format_string("%.8f", x))
    return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))


def from_text(col: Column) -> Column:
    inner = F.btrim(col, F.lit("[]"))
    return F.transform(F.split(inner, ","), lambda x: x.try_cast("float"))
