from pyspark.sql import functions as F

from quarry.operators import itemsets as its
from quarry.sources import tables as tb


def long_baskets(spark, baskets):
    rows = [(i, x) for i, b in enumerate(baskets) for x in b]
    return spark.createDataFrame(rows, "basket long, item string")


def test_apriori_hand_fixture(spark):
    b = long_baskets(spark, [["1", "2", "3"], ["1", "2"], ["2", "3"], ["1", "2", "2"]])
    ap = its.Apriori(b, support=0.5)
    assert (ap.n_baskets, ap.threshold) == (4, 2)
    occ = {r["item"]: r["n"] for r in ap.item_counts.collect()}
    assert occ == {"1": 3, "2": 5, "3": 2}
    ordered = [r["item"] for r in its.item_counts(b, sort=True).collect()]
    assert ordered == ["1", "2", "3"]
    basket_mode = {r["item"]: r["n"] for r in its.item_counts(b, mode="basket").collect()}
    assert basket_mode["2"] == 4
    pairs = {(r["item_a"], r["item_b"]): r["n"] for r in ap.frequent_pairs.collect()}
    assert pairs == {("1", "2"): 3, ("2", "3"): 2}
    cands = {(r["item_a"], r["item_b"]): r["n"] for r in ap.candidate_pairs.collect()}
    assert cands[("1", "3")] == 1


def test_item_table_zero_for_infrequent(spark):
    b = long_baskets(spark, [["a"], ["a"], ["b"]])
    ap = its.Apriori(b, support=0.5)
    assert {r["item"]: r["n"] for r in ap.item_table.collect()} == {"a": 2, "b": 0}


def test_fpgrowth_and_rules_fixture(spark):
    b = long_baskets(spark, [["a", "b"], ["a", "b", "c"], ["a"], ["b", "c"], ["a", "b", "c"]])
    model = its.FrequentSets(b, min_support=0.5, min_confidence=0.7)
    sets = {tuple(sorted(r["items"])): r["freq"] for r in model.itemsets.collect()}
    assert sets == {("a",): 4, ("b",): 4, ("c",): 3, ("a", "b"): 3, ("b", "c"): 3}
    rules = {(tuple(r["antecedent"]), tuple(r["consequent"])): round(r["confidence"], 6)
             for r in model.rules.collect()}
    assert rules == {(("a",), ("b",)): 0.75, (("b",), ("a",)): 0.75, (("b",), ("c",)): 0.75,
                     (("c",), ("b",)): 1.0}


def test_apriori_pairs_equal_fpgrowth_pairs(spark, small_dir):
    b = tb.baskets(spark, small_dir, "p_brand")
    ap = its.Apriori(b, support=0.02)
    pairs = {(r["item_a"], r["item_b"], r["n"]) for r in ap.frequent_pairs.collect()}
    model = its.FrequentSets(b, min_support=0.02)
    fp = {(*sorted(r["items"]), r["freq"]) for r in model.itemsets.filter(F.size("items") == 2).collect()}
    assert pairs == fp and len(pairs) > 0
