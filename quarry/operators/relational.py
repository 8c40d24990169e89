"""Lattices of groupings, mergeable sketches, top-k and total order, differences of snapshots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut_lineage

# ------------------------------------------------------------------ grouping sets


def cube(rows: DataFrame, dims: list[str], distinct: str, sums: dict[str, Column]) -> DataFrame:
    """All groupings of ``dims`` in one pass: dims (null: over all), ``grouping_id``, ``n``, ``n_distinct`` and the ``sums``.

    Rows are first added up for each value of dims and ``distinct``, so what is expanded into the 2^d groupings is that
    table and not the rows, and a distinct count is a count of its groups (with a
    second step for those that several groupings share).
    """
    cells = rows.groupBy(*dims, distinct).agg(F.count("*").alias("n"), *[F.sum(c).alias(name) for name, c in sums.items()])
    total = [F.sum("n").alias("n"), F.countDistinct(distinct).alias("n_distinct"), *[F.sum(name).alias(name) for name in sums]]
    return cells.cube(*dims).agg(F.grouping_id().alias("grouping_id"), *total)


# ------------------------------------------------------------------ sketches


def sketches(rows: DataFrame, keys: list[str], distinct: str, value: str, lg: int = 13, k: int = 800) -> DataFrame:
    """keys, ``ids`` (HyperLogLog of ``distinct``), ``values`` (KLL sketch of ``value``), ``n``: small rows that can be kept and merged later."""
    return rows.groupBy(*keys).agg(F.hll_sketch_agg(distinct, lg).alias("ids"), F.kll_sketch_agg_double(F.col(value), F.lit(k)).alias("values"), F.count("*").alias("n"))


def merged(kept: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of coarser ``keys`` from kept ones, without the rows."""
    return kept.groupBy(*keys).agg(F.hll_union_agg("ids").alias("ids"), F.kll_merge_agg_double("values").alias("values"), F.sum("n").alias("n"))


def estimates(kept: DataFrame, quantile: float) -> DataFrame:
    return kept.withColumn("n_distinct", F.hll_sketch_estimate("ids")).withColumn("quantile", F.kll_sketch_get_quantile_double("values", F.lit(quantile)))


# ------------------------------------------------------------------ top-k and total order


def top_k(rows: DataFrame, group: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group in ``order`` (name enough columns to break all ties), numbered from 1.

    The limit on the row number lets Spark keep only each task's first k of a group before
    they meet: a hot group costs k rows for each task.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def positions(rows: DataFrame, order: list[Column], out: str = "position") -> DataFrame:
    """Every row's position in the total order, from 1: range partitions sorted apart, with the rows before each added."""
    d = cut_lineage(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    begin = d.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_begin"))
    d = d.withColumn("_inside", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    return d.join(begin, "_part").withColumn(out, F.col("_begin") + F.col("_inside")).drop("_part", "_begin", "_inside")


# ------------------------------------------------------------------ differences


def _fields(df: DataFrame, columns: list[str]) -> Column:
    return F.struct(*[F.col(c) for c in columns])


def snapshot_diff(old: DataFrame, new: DataFrame, key: list[str], alike: bool = False) -> DataFrame:
    """key, ``change`` (added, removed, changed, and with ``alike`` same) and ``columns``, those that differ (comma-separated), of two states.

    Nulls are values: a null key matches a null key, a null that stays null has not changed. ``key`` must be unique in each state.
    """
    rest = [c for c in old.columns if c not in key]
    a = old.select(*[F.col(c).alias(f"_a{i}") for i, c in enumerate(key)], _fields(old, rest).alias("_old"))
    b = new.select(*[F.col(c).alias(f"_b{i}") for i, c in enumerate(key)], _fields(new, rest).alias("_new"))
    on = reduce(lambda x, y: x & y, [F.col(f"_a{i}").eqNullSafe(F.col(f"_b{i}")) for i in range(len(key))])
    d = a.join(b, on, "full_outer")
    differ = F.array_compact(F.array(*[F.when(~F.col("_old").getField(c).eqNullSafe(F.col("_new").getField(c)), F.lit(c)) for c in rest]))
    change = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").when(F.size(differ) > 0, "changed").otherwise("same")
    names = F.when(change == "changed", F.array_join(differ, ",")).otherwise(F.lit(""))
    d = d.select(*[F.when(F.col("_old").isNull(), F.col(f"_b{i}")).otherwise(F.col(f"_a{i}")).alias(c) for i, c in enumerate(key)], change.alias("change"), names.alias("columns"))
    return d if alike else d.filter("change <> 'same'")


def multiset(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of both tables with ``n_a`` and ``n_b``, how often each has them: nulls are equal, one shuffle, copies added up before it."""
    both = a.withColumn("_a", F.lit(1)).unionByName(b.withColumn("_a", F.lit(0)))
    return both.groupBy(*a.columns).agg(F.sum("_a").alias("n_a"), F.sum(1 - F.col("_a")).alias("n_b"))


def except_all(a: DataFrame, b: DataFrame) -> DataFrame:
    """EXCEPT ALL with the copies as a number: rows of ``a`` and ``n``, how many are left when those of ``b`` are taken away."""
    return multiset(a, b).withColumn("n", F.col("n_a") - F.col("n_b")).filter("n > 0").drop("n_a", "n_b")


def intersect_all(a: DataFrame, b: DataFrame) -> DataFrame:
    """INTERSECT ALL with the copies as a number."""
    return multiset(a, b).withColumn("n", F.least("n_a", "n_b")).filter("n > 0").drop("n_a", "n_b")
