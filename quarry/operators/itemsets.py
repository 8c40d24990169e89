"""Frequent items, frequent pairs (A-priori) and FP-growth with rules.

Baskets are kept in long form ``(basket, item)``: nothing is grouped into
lists before the first pass has pruned infrequent items, so a basket with
a huge number of lines never becomes one giant row.

Scale notes
-----------
* Item and pair counts are ``groupBy().agg(count)``: partial aggregation
  runs map-side, so a hot item costs one row per map task in the shuffle.
* The only values reaching the driver are scalars (N, the threshold) —
  never item lists. No join is forced: Spark picks it by measured bytes.
* An accepted basket without items is a row with a NULL item: it counts in
  N, and in nothing else.
* Candidate pairs come from a self-join on the basket restricted to
  frequent items. With threshold ``t = ceil(s*N)`` there are at most
  ``occurrences / t`` frequent items (each has >= t occurrences), so a
  basket — however many lines it has — yields at most ``F*(F-1)/2`` pairs
  after the per-basket distinct, where ``F`` is that proven bound.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sets import support_threshold


def basket_total(baskets: DataFrame, basket_col: str = "basket") -> int:
    """A2: N, the distinct baskets, empty ones too."""
    return int(baskets.agg(F.count_distinct(basket_col)).first()[0])


def item_counts(baskets: DataFrame, item_col: str = "item", basket_col: str = "basket",
                mode: str = "occurrence", sort: bool = False) -> DataFrame:
    """A3+A4: (item, n). ``occurrence`` counts repeats inside a basket, as
    the reference does; ``basket`` counts each basket once. ``sort`` orders
    the result by item (a range-partitioned sort, as the reference's
    sortByKey)."""
    src = baskets.filter(F.col(item_col).isNotNull())
    if mode == "basket":
        src = src.select(basket_col, item_col).distinct()
    elif mode != "occurrence":
        raise ValueError(f"unknown count mode {mode!r}")
    out = src.groupBy(F.col(item_col).alias("item")).agg(F.count(F.lit(1)).alias("n"))
    return out.orderBy("item") if sort else out


def frequent_items(counts: DataFrame, threshold: int) -> DataFrame:
    """A5: items with n >= threshold."""
    return counts.filter(F.col("n") >= F.lit(threshold))


def item_table(counts: DataFrame, threshold: int) -> DataFrame:
    """Every item with its count if frequent, else 0."""
    return counts.select("item", F.when(F.col("n") >= F.lit(threshold), F.col("n"))
                         .otherwise(F.lit(0).cast("bigint")).alias("n"))


def candidate_pair_counts(baskets: DataFrame, frequent: DataFrame,
                          item_col: str = "item", basket_col: str = "basket") -> DataFrame:
    """(item_a, item_b, n) for item_a < item_b, both frequent, n =
    baskets holding both."""
    b = baskets.select(F.col(basket_col).alias("basket"), F.col(item_col).alias("item")).distinct()
    b = b.join(frequent.select("item"), "item", "left_semi")
    x, y = b.alias("x"), b.alias("y")
    pairs = x.join(y, (F.col("x.basket") == F.col("y.basket")) & (F.col("x.item") < F.col("y.item")))
    return pairs.groupBy(F.col("x.item").alias("item_a"), F.col("y.item").alias("item_b")) \
        .agg(F.count(F.lit(1)).alias("n"))


def frequent_pairs(pair_counts: DataFrame, threshold: int) -> DataFrame:
    """Pairs with n >= threshold."""
    return pair_counts.filter(F.col("n") >= F.lit(threshold))


@dataclass
class Apriori:
    """Both A-priori passes over long-form baskets, lazily.

    Only the scalars ``n_baskets`` and ``threshold`` are computed eagerly (one aggregation job, which also fills the persisted
    basket table both passes read; ``unpersist()`` releases it)."""

    baskets: DataFrame
    support: float = 0.5
    item_col: str = "item"
    basket_col: str = "basket"
    count_mode: str = "occurrence"
    persist: bool = True

    def __post_init__(self):
        # both passes (and the statistics) read the baskets: keep the narrow
        # long table (spills to disk when large; recomputed if an executor is lost)
        if self.persist:
            self.baskets = self.baskets.select(self.basket_col, self.item_col).persist()
        self.n_baskets = basket_total(self.baskets, self.basket_col)
        self.threshold = support_threshold(self.support, self.n_baskets)

    def unpersist(self) -> None:
        self.baskets.unpersist()

    @property
    def item_counts(self) -> DataFrame:
        return item_counts(self.baskets, self.item_col, self.basket_col, self.count_mode)

    @property
    def frequent_items(self) -> DataFrame:
        return frequent_items(self.item_counts, self.threshold)

    @property
    def item_table(self) -> DataFrame:
        return item_table(self.item_counts, self.threshold)

    @property
    def candidate_pairs(self) -> DataFrame:
        return candidate_pair_counts(self.baskets, self.frequent_items, self.item_col, self.basket_col)

    @property
    def frequent_pairs(self) -> DataFrame:
        return frequent_pairs(self.candidate_pairs, self.threshold)


def transactions(baskets: DataFrame, threshold: int | None = None, item_col: str = "item",
                 basket_col: str = "basket") -> DataFrame:
    """(basket, items array) with distinct items per basket.

    With ``threshold`` set, items in fewer baskets are dropped first (they
    cannot be in any frequent itemset), so every array is bounded by the
    number of frequent items; baskets left empty stay as empty arrays so the
    basket total — and therefore FP-growth's own threshold — is unchanged.
    """
    b = baskets.select(F.col(basket_col).alias("basket"), F.col(item_col).alias("item")).distinct()
    item = F.col("item")
    if threshold is not None:
        freq = b.groupBy("item").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= threshold).select(
            "item", F.lit(True).alias("keep"))
        b = b.join(freq, "item", "left")
        item = F.when(F.col("keep"), F.col("item"))
    return b.groupBy("basket").agg(F.collect_set(item).alias("items"))


@dataclass
class FrequentSets:
    """Spark ML FP-growth over pruned transactions, fitted when made.

    ``itemsets``: items, freq; ``rules``: antecedent, consequent, confidence,
    lift, support. ``unpersist()`` releases the tables its jobs share."""

    baskets: DataFrame
    min_support: float = 0.2
    min_confidence: float = 0.8
    num_partitions: int | None = 10
    item_col: str = "item"
    basket_col: str = "basket"

    def __post_init__(self):
        from pyspark.ml.fpm import FPGrowth

        # the statistics, the pruning and FP-growth's own jobs (count, items,
        # trees) read these: kept instead of derived again
        self.baskets = self.baskets.select(self.basket_col, self.item_col).persist()
        threshold = support_threshold(self.min_support, basket_total(self.baskets, self.basket_col))
        self.transactions = transactions(self.baskets, threshold, self.item_col, self.basket_col).persist()
        fp = FPGrowth(itemsCol="items", minSupport=self.min_support, minConfidence=self.min_confidence)
        if self.num_partitions:
            fp = fp.setNumPartitions(self.num_partitions)
        self.model = fp.fit(self.transactions)

    @property
    def itemsets(self) -> DataFrame:
        return self.model.freqItemsets

    @property
    def rules(self) -> DataFrame:
        return self.model.associationRules

    def unpersist(self) -> None:
        self.transactions.unpersist()
        self.baskets.unpersist()


def sorted_joined(col: str, sep: str = ",") -> F.Column:
    """Array as a stable string: sorted elements joined by ``sep``."""
    return F.array_join(F.array_sort(F.col(col)), sep)
