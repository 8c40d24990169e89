import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import recommend as rc


def some_ratings(seed=1, users=30, items=20):
    g = np.random.default_rng(seed)
    u, v = g.normal(size=(users, 3)), g.normal(size=(items, 3))
    return [(int(a), int(b), float(u[a] @ v[b])) for a in range(users) for b in range(items) if g.random() < 0.5]


def plain(ratings, seeds, rank, sweeps, reg):
    """Ridge regressions by numpy, one side after the other."""
    users, items = {}, dict(seeds)

    def fit(fixed, mine, other):
        out = {}
        for k in {r[mine] for r in ratings}:
            x = np.array([fixed[r[other]] for r in ratings if r[mine] == k])
            y = np.array([r[2] for r in ratings if r[mine] == k])
            out[k] = np.linalg.solve(x.T @ x + reg * np.eye(rank), x.T @ y)
        return out

    for _ in range(sweeps):
        users = fit(items, 0, 1)
        items = fit(users, 1, 0)
    return users, items


@pytest.mark.parametrize("rank", [1, 2, 4])
def test_factors_equal_plain_ridge_regressions(spark, rank):
    rows = some_ratings()
    df = spark.createDataFrame([*rows, (None, 1, 2.0), (1, 2, None)], "user long, item long, rating double")
    seeds = {r.item: np.array([r[f"s{k}"] for k in range(rank)]) for r in spark.range(20).withColumnRenamed("id", "item").select(
        "item", *[rc.seed(F.col("item"), k).alias(f"s{k}") for k in range(rank)]).collect()}
    f = rc.Factors(df, rank, 2, 0.1)
    users, items = plain(rows, seeds, rank, 2, 0.1)
    for got, want in ((f.users, users), (f.items, items)):
        got = {r[0]: np.array(r[1:]) for r in got.collect()}
        assert got.keys() == want.keys() and all(np.allclose(got[k], want[k], atol=1e-6) for k in want)
    error = np.sqrt(np.mean([(r - users[a] @ items[b]) ** 2 for a, b, r in rows]))
    assert f.error().first().rmse == pytest.approx(error, abs=1e-6)


def test_more_sweeps_fit_better_and_recommendations_are_new(spark):
    rows = some_ratings(2)
    df = spark.createDataFrame(rows, "user long, item long, rating double")
    few, many = (rc.Factors(df, 3, n, 0.01) for n in (1, 6))
    assert many.error().first().rmse < few.error().first().rmse
    best = many.recommend(many.popular(10), 3).collect()
    rated = {(a, b) for a, b, _ in rows}
    assert best and all((r.user, r.item) not in rated and 1 <= r.rank <= 3 for r in best)
    with pytest.raises(ValueError):
        rc.Factors(df, 0)


def test_a_hot_item_is_added_up_before_the_shuffle(spark):
    rows = spark.range(20_000).select(F.col("id").alias("user"), F.lit(1).alias("item"), F.lit(1.0).alias("rating"))
    fixed = rows.select("user", F.lit(0.5).alias("f0"), F.lit(0.25).alias("f1"))
    d = rc.half_sweep(rows, fixed, "item", "user", 2, 0.1)
    d.collect()
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and d.count() == 1


def test_no_ratings(spark):
    f = rc.Factors(spark.createDataFrame([], "user long, item long, rating double"), 2, 1)
    assert f.users.count() == 0 and f.error().first().n == 0
