"""Matrix factorisation by alternating least squares, in native expressions.

Ratings (user, item, rating) are approximated by products of two factor vectors. With one
side fixed, each row of the other is a ridge regression: its normal equations are grouped
sums of outer products of the fixed factors (partial sums on the map side, so a hot item
or user costs one row for each task) and are solved by Cholesky decomposition in column
expressions. Nothing is gathered on the driver; factors are rows.

Factors begin with a hash of the item's id, so results do not depend on the cluster. Rows
with a null in any column are left out; repeated (user, item) rows count each time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import cut_lineage


def seed(ident: Column, k: int) -> Column:
    """The first value of factor ``k``, in [0, 1): 24 bits of a hash of the id."""
    digest = F.md5(F.concat(ident.cast("string"), F.lit(f":{k}")))
    return F.conv(F.substring(digest, 1, 6), 16, 10).cast("double") / float(1 << 24)


def _solve(sums: DataFrame, side: str, rank: int) -> DataFrame:
    """Factors x of A x = b for each row, from the columns a{i}_{j} (i >= j) and b{i}."""
    d = sums
    for j in range(rank):  # A = L L'
        rest = sum((F.col(f"l{j}_{m}") ** 2 for m in range(j)), F.lit(0.0))
        d = d.withColumn(f"l{j}_{j}", F.sqrt(F.col(f"a{j}_{j}") - rest))
        for i in range(j + 1, rank):
            rest = sum((F.col(f"l{i}_{m}") * F.col(f"l{j}_{m}") for m in range(j)), F.lit(0.0))
            d = d.withColumn(f"l{i}_{j}", (F.col(f"a{i}_{j}") - rest) / F.col(f"l{j}_{j}"))
    for i in range(rank):  # L y = b
        rest = sum((F.col(f"l{i}_{m}") * F.col(f"y{m}") for m in range(i)), F.lit(0.0))
        d = d.withColumn(f"y{i}", (F.col(f"b{i}") - rest) / F.col(f"l{i}_{i}"))
    for i in reversed(range(rank)):  # L' x = y
        rest = sum((F.col(f"l{m}_{i}") * F.col(f"x{m}") for m in range(i + 1, rank)), F.lit(0.0))
        d = d.withColumn(f"x{i}", (F.col(f"y{i}") - rest) / F.col(f"l{i}_{i}"))
    return d.select(side, *[F.col(f"x{i}").alias(f"f{i}") for i in range(rank)])


def half_sweep(ratings: DataFrame, fixed: DataFrame, side: str, other: str, rank: int, reg: float) -> DataFrame:
    """The factors of ``side`` that fit ``ratings`` best to the ``fixed`` factors of ``other``."""
    d = ratings.join(fixed, other)
    products = [F.sum(F.col(f"f{i}") * F.col(f"f{j}")).alias(f"p{i}_{j}") for i in range(rank) for j in range(i + 1)]
    sums = d.groupBy(side).agg(*products, *[F.sum(F.col("rating") * F.col(f"f{i}")).alias(f"b{i}") for i in range(rank)])
    a = [(F.col(f"p{i}_{j}") + (reg if i == j else 0.0)).alias(f"a{i}_{j}") for i in range(rank) for j in range(i + 1)]
    return _solve(sums.select(side, *a, *[f"b{i}" for i in range(rank)]), side, rank)


class Factors:
    """``users`` (user, f0, ...) and ``items`` (item, f0, ...) fitted to ``ratings``; every half sweep is written to the checkpoint folder."""

    def __init__(self, ratings: DataFrame, rank: int = 10, sweeps: int = 10, reg: float = 0.1):
        if rank < 1 or sweeps < 1 or reg <= 0:
            raise ValueError("rank and sweeps must be at least 1, reg above 0")
        self.rank = rank
        self.ratings = cut_lineage(ratings.select("user", "item", F.col("rating").cast("double").alias("rating")).dropna())
        items = self.ratings.select("item").distinct()
        self.items = items.select("item", *[seed(F.col("item"), k).alias(f"f{k}") for k in range(rank)])
        for _ in range(sweeps):
            self.users = cut_lineage(half_sweep(self.ratings, self.items, "user", "item", rank, reg))
            self.items = cut_lineage(half_sweep(self.ratings, self.users, "item", "user", rank, reg))

    def scores(self, pairs: DataFrame) -> DataFrame:
        """``pairs`` with ``score``; pairs of an unknown user or item are left out."""
        u = self.users.select("user", *[F.col(f"f{k}").alias(f"_u{k}") for k in range(self.rank)])
        v = self.items.select("item", *[F.col(f"f{k}").alias(f"_v{k}") for k in range(self.rank)])
        d = pairs.join(u, "user").join(v, "item")
        score = sum((F.col(f"_u{k}") * F.col(f"_v{k}") for k in range(self.rank)), F.lit(0.0))
        return d.withColumn("score", score).drop(*[f"_{s}{k}" for s in "uv" for k in range(self.rank)])

    def error(self) -> DataFrame:
        """n and rmse of the ratings."""
        return self.scores(self.ratings).agg(F.count("*").alias("n"), F.sqrt(F.avg((F.col("rating") - F.col("score")) ** 2)).alias("rmse"))

    def popular(self, n: int) -> list:
        """The ``n`` items with the most ratings (ties: the smaller id): candidates, a list of fixed length."""
        counts = self.ratings.groupBy("item").agg(F.count("*").alias("n"))
        return [r.item for r in counts.orderBy(F.desc("n"), "item").limit(n).collect()]

    def recommend(self, candidates: list, top: int) -> DataFrame:
        """user, rank, item, score: for each user the ``top`` of the ``candidates`` (a bounded list) that the user has not rated.

        Scores are compared to six places, equal ones by item."""
        pairs = self.users.select("user", F.explode(F.array(*map(F.lit, candidates)).cast(T.ArrayType(self.items.schema["item"].dataType))).alias("item"))
        new = self.scores(pairs.join(self.ratings.select("user", "item"), ["user", "item"], "left_anti")).withColumn("score", F.round("score", 6))
        best = Window.partitionBy("user").orderBy(F.desc("score"), "item")  # at most the candidates of one user
        return new.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top).select("user", "rank", "item", "score")
