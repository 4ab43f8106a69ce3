"""Dense-vector arithmetic on ARRAY<DOUBLE> columns with higher-order functions."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double_array(c) -> Column:
    return _c(c).cast("array<double>")


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def dot(a, b) -> Column:
    return _sum(F.zip_with(_c(a), _c(b), lambda x, y: x * y))


def l2_norm(a) -> Column:
    return F.sqrt(_sum(F.transform(_c(a), lambda x: x * x)))


def euclidean(a, b) -> Column:
    return F.sqrt(_sum(F.zip_with(_c(a), _c(b), lambda x, y: (x - y) * (x - y))))


def cosine_sim(a, b) -> Column:
    return dot(a, b) / (l2_norm(a) * l2_norm(b))


def normalize(a) -> Column:
    n = l2_norm(a)
    return F.transform(_c(a), lambda x: F.when(n > 0, x / n).otherwise(F.lit(0.0)))
