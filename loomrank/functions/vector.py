"""Dense vectors as arrays of floats; sums are taken in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def normalized(v: Column) -> Column:
    """The unit vector; a vector of zeros stays."""
    return F.when(norm(v) > 0, F.transform(v, lambda x: x.cast("double") / norm(v))).otherwise(F.transform(v, lambda x: x.cast("double")))
