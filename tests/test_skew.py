"""Hot keys: results stay whole and exact, and no step pairs up a hot group."""

import pytest
from pyspark.sql import functions as F

from quarry.operators import itemsets as its
from quarry.operators import rank as rk
from quarry.operators import similarity as sim


def test_hot_copy_group_is_collapsed(spark):
    base = " ".join(f"w{i}" for i in range(60))
    near = " ".join(f"w{i}" for i in range(58)) + " x y"
    other = [" ".join(f"o{j}_{i}" for i in range(20)) for j in range(10)]
    texts = [base] * 300 + [near] + other          # 300 copies: most of the corpus
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = sim.shingle_sets(df)
    reps = sim.representatives(sim.hashed_sets(sets))
    assert reps.count() == 12                        # 300 copies -> one row
    cands = sim.prefix_candidates(reps, 0.8).count()
    assert cands <= 1                                # not 300*299/2
    pairs = {(r["doc_a"], r["doc_b"]) for r in sim.similar_pairs(sets, 0.8).collect()}
    assert pairs == {(0, 300)}                       # representative 0 vs the near copy
    members = sim.copy_members(sim.hashed_sets(sets))
    assert members.count() == 300 and members.select("rep_id").distinct().count() == 1


def test_hub_page_salted_equals_unsalted(spark):
    edges = [("hub", f"n{i}") for i in range(1000)] + [(f"n{i}", "hub") for i in range(1000)] \
        + [("n1", "n2"), ("n2", "n3")]
    e = rk.distinct_edges(spark.createDataFrame(edges, "src string, dst string"))
    salted = rk.LinkGraph(e, edges_per_slice=10)    # hub gets 100 salts
    assert {r["src"]: r["n_salt"] for r in salted.hubs.collect()} == {"hub": 100}
    plain = rk.LinkGraph(e, edges_per_slice=10_000_000)
    a = {r["id"]: r["rank"] for r in salted.run(4).collect()}
    b = {r["id"]: r["rank"] for r in plain.run(4).collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k], abs=1e-15)


def test_hot_basket_pairs_bounded(spark):
    rows = [(0, f"i{j % 5}") for j in range(5000)] + [(b, f"i{b % 5}") for b in range(1, 200)] \
        + [(1, "rare")]                                # below the threshold of 2: pruned
    baskets = spark.createDataFrame(rows, "basket long, item string")
    ap = its.Apriori(baskets, support=0.01)
    # the 5000-line basket holds 5 distinct frequent items: 10 pairs, not 5000^2
    hot = ap.candidate_pairs.agg(F.sum("n")).first()[0]
    assert hot == 10
    assert {r["item"] for r in ap.frequent_items.collect()} >= {"i0", "i1", "i2", "i3", "i4"}
