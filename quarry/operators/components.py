"""Connected components of an edge DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def components(edges: DataFrame, keep: Callable[[DataFrame], DataFrame] = cut_lineage) -> DataFrame:
    """(node, component) of the undirected ``edges`` (a, b), each component
    named by its smallest node; nodes without an edge to another are absent.

    Alternates large-star and small-star steps until no edge changes; each is
    a grouped minimum and a join, materialized with ``keep``. Whole components
    never meet in a task, and nothing but two sums reaches the driver.
    """
    e = keep(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct())
    mark = _mark(e)
    while mark[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = keep(large.distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
        e = keep(small.union(least.select("u", F.col("m").alias("v"))).distinct())
        was, mark = mark, _mark(e)
        if was == mark:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()


def _mark(e: DataFrame) -> tuple:
    """Count and order-free hash of the edges."""
    h = F.xxhash64("u", "v")
    return tuple(e.agg(F.count("*"), F.sum(F.shiftright(h, 16)), F.sum(h.bitwiseAND(F.lit(0xFFFF)))).first())
