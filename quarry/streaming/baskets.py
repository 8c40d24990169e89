"""Structured Streaming form of basket parsing and item counting (A1, A3-A5).

New basket files dropped into a folder are parsed as they arrive; item
counts are a stateful streaming aggregation (state = one row per item),
so a long-running job never rescans old files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sets import support_threshold
from ..sources.parse import parse_baskets


def basket_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming (value, items, ok) rows from text files of ``{1, 2}`` lines."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return parse_baskets(reader.load(path))


def item_counts(baskets: DataFrame) -> DataFrame:
    """Running (item, n) over the accepted baskets; repeats counted, as A3-A4."""
    good = baskets.filter(F.col("ok"))
    return good.select(F.explode("items").alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("n"))


def basket_total(baskets: DataFrame) -> DataFrame:
    """Running number of accepted baskets (one-row state)."""
    return baskets.filter(F.col("ok")).groupBy().agg(F.count(F.lit(1)).alias("baskets"))


def frequent_items_batch(counts: DataFrame, n_baskets: int, support: float) -> DataFrame:
    """A5 on one micro-batch of the complete-mode counts (e.g. in foreachBatch)."""
    return counts.filter(F.col("n") >= F.lit(support_threshold(support, n_baskets)))
