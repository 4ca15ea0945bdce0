"""Vectors as arrays of doubles, and set and weight measures on arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def unit(v: Column) -> Column:
    """The vector at length one; one of length zero stays as it is."""
    doubles = v.cast("array<double>")
    # the norm is bound once by an array of one, else it would be taken anew for each value
    norms = F.array(F.sqrt(dot(doubles, doubles)))
    return F.transform(norms, lambda n: F.transform(doubles, lambda x: F.when(n > 0, x / n).otherwise(x)))[0]


def parsed(text: Column) -> Column:
    """The vector written as ``[x, y, ...]``."""
    return F.from_json(text, "array<double>")


def usable(v: Column, dimensions: Column) -> Column:
    return v.isNotNull() & (F.size(v) == dimensions) & F.forall(v, lambda x: ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)


def jaccard(a: Column, b: Column) -> Column:
    """0.0 where both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / union)
