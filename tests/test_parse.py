from pyspark.sql import functions as F

from quarry.operators import itemsets as its
from quarry.sources import parse as ps


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_basket_parse(spark):
    df = ps.parse_baskets(lines(spark, ["{1, 2,3}", "{}", "{1,z}", "{4,4}", "{0, 12}", "{5,6,}", "{,}", "{7, }"]))
    got = {r["value"]: (r["items"], r["ok"]) for r in df.collect()}
    assert got["{1, 2,3}"] == ([1, 2, 3], True)
    assert got["{}"][1] is False
    assert got["{1,z}"] == ([1, None], False)
    assert got["{4,4}"] == ([4, 4], True)          # duplicates kept, as the reference does
    assert got["{0, 12}"] == ([0, 12], True)       # id 0 and sparse ids are fine
    assert got["{5,6,}"] == ([5, 6], True)         # trailing empty token dropped, as Java's split
    assert got["{,}"] == ([], True)                # only separators: an empty basket
    assert got["{7, }"] == ([7, None], False)      # a blank (not empty) token is not a number
    good, bad = ps.split_rejects(df)
    assert good.count() == 5 and bad.count() == 3


def test_transaction_parse(spark):
    df = ps.parse_transactions(lines(spark, ["r z h k p", "a  b", "x x y", ""]))
    got = {r["value"]: (sorted(r["items"]), r["ok"]) for r in df.collect()}
    assert got["r z h k p"] == (["h", "k", "p", "r", "z"], True)
    assert got["a  b"] == (["", "a", "b"], True)     # inner empty tokens are items, as Java's split leaves them
    assert got["x x y"] == (["x", "y"], True)        # repeated item removed
    assert got[""] == ([""], True)                   # "".split(" ") has one empty token
    trailing = ps.parse_transactions(lines(spark, [" a ", "  "])).collect()
    assert {r["value"]: r["items"] for r in trailing} == {" a ": ["", "a"], "  ": []}
    kept, rejects = ps.transaction_table(lines(spark, ["a b", "  "]))
    assert rejects.count() == 0 and its.basket_total(kept) == 2


def test_empty_baskets_count_in_the_total(spark):
    kept, rejects = ps.basket_table(lines(spark, ["{1,2}", "{1,2}", "{,}", "{,}", "{,}"]))
    ap = its.Apriori(kept, support=0.5)
    assert rejects.count() == 0 and (ap.n_baskets, ap.threshold) == (5, 3)
    assert ap.frequent_items.count() == 0 and {r["item"]: r["n"] for r in ap.item_counts.collect()} == {1: 2, 2: 2}
    ap.unpersist()


def test_category_and_labelled_parse(spark):
    cats = ps.parse_categories(lines(spark, ["sport   1", "politics 7", "bad"]))
    good, bad = ps.split_rejects(cats)
    assert sorted((r["category"], r["label"]) for r in good.collect()) == [("politics", 7), ("sport", 1)]
    assert bad.count() == 1
    docs = spark.createDataFrame(
        [(1, "sport|a b|c"), (2, "nolabel text"), (3, "weather|x"), (4, ""), (5, "politics| lead")],
        "doc_id int, text string")
    p = {r["doc_id"]: r for r in ps.parse_labelled_docs(docs, good).collect()}
    assert (p[1]["label"], p[1]["content"], p[1]["ok"]) == (1, "a b|c", True)   # second '|' stays in content
    assert p[2]["ok"] is False and p[3]["ok"] is False and p[4]["ok"] is False
    assert p[5]["content"] == " lead"                                          # not trimmed


def test_link_parse(spark):
    df = ps.parse_links(lines(spark, ["A B", "A C extra", "lonely", "trailing ", "E F "]))
    got = [(r["src"], r["dst"], r["ok"]) for r in df.orderBy("value").collect()]
    assert got == [("A", "B", True), ("A", "C", True), ("E", "F", True), ("lonely", None, False), ("trailing", None, False)]


def test_repeated_category_name_does_not_duplicate_documents(spark):
    cats = ps.parse_categories(spark.createDataFrame([("sport 9",), ("sport 4",)], "value string").coalesce(1))
    docs = spark.createDataFrame([(1, "sport|x")], "doc_id int, text string")
    rows = ps.parse_labelled_docs(docs, cats).collect()
    assert len(rows) == 1 and rows[0]["label"] == 4   # the last line's


def test_documents_of_one_category_are_dealt_over_the_tasks(spark):
    from pyspark.sql import functions as F

    cats = ps.parse_categories(lines(spark, ["sport 1"]))
    docs = spark.range(400).select("id", F.concat(F.lit("sport|"), F.col("id").cast("string")).alias("text"))
    was = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        rows = ps.parse_labelled_docs(docs, cats).withColumn("task", F.spark_partition_id()).collect()
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    assert len(rows) == 400 and all(r["label"] == 1 and r["ok"] and r["content"] == str(r["id"]) for r in rows)
    assert len({r["task"] for r in rows}) > 1
