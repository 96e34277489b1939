"""Vector arithmetic on array columns, without Python functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def dot(x: Column, y: Column) -> Column:
    return _sum(F.zip_with(x, y, lambda a, b: a.cast("double") * b.cast("double")))


def l2_norm(x: Column) -> Column:
    return F.sqrt(dot(x, x))


def normalize(x: Column) -> Column:
    """x / |x|; nulls for the zero vector."""
    norm = l2_norm(x)
    return F.transform(x, lambda a: F.try_divide(a.cast("double"), norm))


def cosine(x: Column, y: Column) -> Column:
    """Null if either is the zero vector."""
    return F.try_divide(dot(x, y), l2_norm(x) * l2_norm(y))


def euclid_of_unit(x: Column, y: Column) -> Column:
    """The distance of the two vectors after normalising: sqrt(2 - 2 cos); null if either is zero."""
    c = cosine(x, y)
    return F.when(c.isNotNull(), F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * c)))


def euclid(x: Column, y: Column) -> Column:
    return F.sqrt(_sum(F.zip_with(x, y, lambda a, b: (a.cast("double") - b.cast("double")) * (a.cast("double") - b.cast("double")))))


def rises(x: Column) -> Column:
    """For each element, whether it is at least the one before (0 before the first)."""
    before = F.concat(F.array(F.lit(0.0)), F.transform(F.slice(x, 1, F.greatest(F.size(x) - 1, F.lit(0))), lambda a: a.cast("double")))
    return F.zip_with(x, before, lambda a, b: a.cast("double") >= b)


def shape_mismatch(x: Column, y: Column) -> Column:
    """In how many slots the two curves move in different directions."""
    return F.size(F.filter(F.zip_with(rises(x), rises(y), lambda a, b: a != b), lambda d: d))
