"""Vector functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def euclidean(a: Column, b: Column) -> Column:
    """Distance of two vectors; different lengths are an error."""
    squares = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    total = F.aggregate(squares, F.lit(0.0), lambda acc, s: acc + s)
    mismatch = F.raise_error(F.lit("vectors differ in length")).cast("double")
    return F.when(F.size(a) != F.size(b), mismatch).otherwise(F.sqrt(total))
