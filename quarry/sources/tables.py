"""Inputs derived from the TESTDATA parquet tables.

Every input is a plain projection / join / distinct over the given tables,
so its size grows with them. Column selection happens before joins, so the
parquet scans read only the columns used (see ``ReadSchema`` in explain).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lineitem(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    """The fact table, pruned to ``cols``. Not spread: the per-row work on
    it is a projection feeding a partial aggregation, cheaper than a shuffle."""
    return table(spark, sf_dir, "lineitem").select(*cols)


def _line_parts(spark: SparkSession, sf_dir: str, attr: str) -> DataFrame:
    li = lineitem(spark, sf_dir, "l_orderkey", "l_partkey")
    part = table(spark, sf_dir, "part").select("p_partkey", F.col(attr).alias("item"))
    # part is a dimension table: Spark broadcasts it only when its measured
    # size is under autoBroadcastJoinThreshold (AQE re-checks at runtime);
    # otherwise a sort-merge join with AQE skew splitting on hot part keys.
    return li.join(part, li.l_partkey == part.p_partkey).select(
        F.col("l_orderkey").alias("basket"), "item")


def raw_baskets(spark: SparkSession, sf_dir: str, attr: str = "p_brand") -> DataFrame:
    """One row per lineitem: (basket=order, item=part attribute); repeats kept."""
    return _line_parts(spark, sf_dir, attr)


def baskets(spark: SparkSession, sf_dir: str, attr: str = "p_brand") -> DataFrame:
    """Distinct (basket, item): each order is a basket of the brands/types it holds."""
    return _line_parts(spark, sf_dir, attr).distinct()


def supply_edges(spark: SparkSession, sf_dir: str, closed: bool = True) -> DataFrame:
    """Directed link graph from whole tables.

    Every lineitem row links part -> supplier and supplier -> part: a closed
    graph, which keeps its rank. The leaky graph also has customer -> part for
    every line of the customer's orders (nobody links to a customer: these
    pages vanish) and supplier -> nation (sinks, where rank is lost).
    """
    li = lineitem(spark, sf_dir, "l_orderkey", "l_partkey", "l_suppkey")
    name = lambda prefix, col: F.concat(F.lit(prefix), F.col(col).cast("string"))
    p, s = name("p", "l_partkey"), name("s", "l_suppkey")
    edges = li.select(p.alias("src"), s.alias("dst")).unionByName(li.select(s.alias("src"), p.alias("dst")))
    if closed:
        return edges
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    bought = li.join(orders, li.l_orderkey == orders.o_orderkey).select(name("c", "o_custkey").alias("src"), p.alias("dst"))
    home = table(spark, sf_dir, "supplier").select(name("s", "s_suppkey").alias("src"), name("n", "s_nationkey").alias("dst"))
    return edges.unionByName(bought).unionByName(home)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-partition ``df`` by ``key`` into as many parts as the caller states in
    ``quarry.input.partitions``; unset, the input's own splits are used.

    For tables that lie in few row groups but cost much per row; large tables
    come in many splits and need no shuffle."""
    parts = df.sparkSession.conf.get("quarry.input.partitions", None)
    return df.repartition(int(parts), key) if parts else df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents joined with labels.quality: (doc_id, label, text)."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return documents(spark, sf_dir).join(labels, "doc_id")
