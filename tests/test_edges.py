"""Edge cases of the operators."""

import pytest
from pyspark.sql import functions as F

from quarry.operators import bayes as nb
from quarry.operators import itemsets as its
from quarry.operators import rank as rk
from quarry.operators import similarity as sim


def test_cv_fold_without_a_class(spark):
    rows = [(i, 0, "red apple fruit") for i in range(8)] + [(100, 1, "blue car engine")]
    d = spark.createDataFrame(rows, "doc_id long, label int, text string") \
        .withColumn("fold", F.pmod("doc_id", F.lit(2)).cast("int"))
    cv = {r["doc_id"]: r["prediction"] for r in nb.cross_validate(d, 2).collect()}
    assert len(cv) == 9
    # doc 100 is the only class-1 document; its model never saw class 1
    assert cv[100] == 0


def test_empty_text_is_a_document(spark):
    d = spark.createDataFrame([(1, 0, ""), (2, 1, "word word")], "doc_id long, label int, text string")
    m = nb.fit(d)
    assert {r["label"]: r["n_docs"] for r in m.priors.collect()} == {0: 1, 1: 1}
    # the empty string is a token, as with Spark ML's Tokenizer
    assert {r["term"] for r in m.vocabulary.collect()} == {"", "word"}


def test_zero_support_and_zero_rounds(spark):
    b = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "basket long, item string")
    ap = its.Apriori(b, support=0.0)
    assert ap.threshold == 0 and ap.frequent_items.count() == 2
    e = spark.createDataFrame([("A", "B"), ("B", "A")], "src string, dst string")
    assert {r["id"]: r["rank"] for r in rk.pagerank(e, 0).collect()} == pytest.approx({"A": 0.5, "B": 0.5})


def test_threshold_one_finds_only_equal_sets(spark):
    d = spark.createDataFrame([(1, "a b c d"), (2, "a b c d e"), (3, "x y z"), (4, "x y z")],
                              "doc_id long, text string")
    sets = sim.shingle_sets(d, k=2)
    assert sim.similar_pairs(sets, 1.0).count() == 0          # 3 and 4 are one copy group
    assert sim.copy_members(sim.hashed_sets(sets)).count() == 2
    with pytest.raises(ValueError):
        sim.similar_pairs(sets, 0.0)
