"""Vector expressions on plain array columns; all of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F


def as_vector(value) -> Column:
    """Column of doubles from a column, a name or a plain list of numbers."""
    if isinstance(value, Column):
        return value.cast("array<double>")
    if isinstance(value, str):
        return F.col(value).cast("array<double>")
    return F.array(*[F.lit(float(x)) for x in value])


def dot(left, right) -> Column:
    products = F.zip_with(as_vector(left), as_vector(right), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def squared_distance(left, right) -> Column:
    gaps = F.zip_with(as_vector(left), as_vector(right), lambda x, y: x - y)
    return F.aggregate(gaps, F.lit(0.0), lambda total, gap: total + gap * gap)


def unit_vector(vector) -> Column:
    """Scale to length one; the zero vector stays as it is."""
    values = as_vector(vector)
    length = F.sqrt(F.aggregate(values, F.lit(0.0), lambda total, x: total + x * x))
    return F.when(length > 0, F.transform(values, lambda x: x / length)).otherwise(values)


def vector_mean(df: DataFrame, by: Sequence[str], vector: str, name: str = "mean") -> DataFrame:
    """Element-wise mean per group, summed up in the JVM before the shuffle."""
    mean = Summarizer.mean(array_to_vector(as_vector(vector)))
    return df.groupBy(*by).agg(vector_to_array(mean).alias(name))
