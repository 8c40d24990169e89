"""Set and threshold expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def jaccard(a: Column, b: Column) -> Column:
    """|A ∩ B| / |A ∪ B| on the distinct elements of two arrays.

    Two empty sets give NaN (0.0 / 0.0), as a double division does in Java;
    written with an explicit branch because ANSI mode raises on x / 0.
    """
    inter = F.size(F.array_intersect(a, b)).cast("double")
    union = F.size(F.array_union(a, b)).cast("double")
    return F.when(union == 0, F.lit(float("nan"))).otherwise(inter / union)


def support_threshold(s: float, n_baskets: int) -> int:
    """Minimum count for support ``s``: ceil(s * N) in double arithmetic."""
    return int(math.ceil(float(s) * float(n_baskets)))
