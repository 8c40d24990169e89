import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import CountVectorizer, StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from quarry.functions.text import ENGLISH_STOP_WORDS, remove_stop_words, tokenize
from quarry.operators import bayes as nb
from quarry.sources import tables as tb


def test_stop_word_list_is_spark_default(spark):
    assert ENGLISH_STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")


def test_tokenizer_matches_ml(spark):
    texts = [" A  b\tThe c ", "x", "", "   ", "Hello\nWorld  ", "\tlead"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    ml = Tokenizer(inputCol="text", outputCol="w").transform(df)
    ml = StopWordsRemover(inputCol="w", outputCol="f").transform(ml)
    ours = ml.select("text", "w", "f", tokenize(F.col("text")).alias("w2"),
                     remove_stop_words(tokenize(F.col("text"))).alias("f2")).collect()
    for r in ours:
        assert r["w"] == r["w2"], r["text"]
        assert r["f"] == r["f2"], r["text"]
    first = [r for r in ours if r["text"] == " A  b\tThe c "][0]
    assert first["w2"] == ["", "a", "", "b", "the", "c"] and first["f2"] == ["", "", "b", "c"]


def test_hand_fixture(spark):
    d = spark.createDataFrame([(1, 1, "x x y"), (2, 1, "y z"), (3, 3, "z z q")], "doc_id int, label int, text string")
    m = nb.fit(d)
    pri = {r["label"]: round(r["log_prior"], 6) for r in m.priors.collect()}
    assert pri == {1: -0.510826, 3: -0.916291}
    th = {(r["label"], r["term"]): round(r["log_theta"], 6) for r in m.theta.collect()}
    assert th[(1, "z")] == -1.504077 and th[(1, "x")] == -1.098612 and th[(3, "z")] == -0.847298
    unseen = {r["label"]: round(-r["log_denom"], 6) for r in m.priors.collect()}   # ln(1) - denom
    assert unseen == {1: -2.197225, 3: -1.945910}
    pred = {r["doc_id"]: r["prediction"] for r in nb.predict(m, d).collect()}
    assert pred == {1: 1, 2: 1, 3: 3}                 # labels kept, not class positions


def test_predictions_match_spark_ml(spark, small_dir):
    d = tb.labelled_documents(spark, small_dir)
    train = d.filter(F.col("doc_id") % 5 != 0)
    test = tb.documents(spark, small_dir)
    pipe = Pipeline(stages=[Tokenizer(inputCol="text", outputCol="w"),
                            StopWordsRemover(inputCol="w", outputCol="f"),
                            CountVectorizer(inputCol="f", outputCol="features"),
                            NaiveBayes(labelCol="label")])
    ml = pipe.fit(train.withColumn("label", F.col("label").cast("double")))
    rows = ml.transform(test).select("doc_id", "prediction", "probability").collect()
    mlp = {r["doc_id"]: int(r["prediction"]) for r in rows}
    mlprob = {r["doc_id"]: float(max(r["probability"])) for r in rows}
    got = nb.predict(nb.fit(train), test).collect()
    assert {r["doc_id"]: r["prediction"] for r in got} == mlp
    for r in got:
        assert abs(r["probability"] - mlprob[r["doc_id"]]) < 1e-9
        assert 0.5 - 1e-12 <= r["probability"] <= 1.0     # two classes: argmax has at least 1/2


@pytest.mark.parametrize("smoothing", [0.1, 0.5, 1.0, 2.0])
def test_all_class_probabilities_match_spark_ml(spark, smoothing):
    rows = [(1, 0, "a b c a"), (2, 0, "a d"), (3, 1, "c d d e"), (4, 2, "e f a a a")]
    train = spark.createDataFrame(rows, "doc_id int, label int, text string")
    test = spark.createDataFrame([(9, "a d z"), (10, "e e f"), (11, ""), (12, "q")], "doc_id int, text string")
    stages = [Tokenizer(inputCol="text", outputCol="f"), CountVectorizer(inputCol="f", outputCol="features"),
              NaiveBayes(labelCol="label", smoothing=smoothing)]
    ml = Pipeline(stages=stages).fit(train.withColumn("label", F.col("label").cast("double")))
    train = train.withColumn("text", F.regexp_replace("text", r"\ba\b", "a"))
    want = {r["doc_id"]: list(r["probability"]) for r in ml.transform(test).collect()}
    model = nb.fit(train.withColumn("text", F.regexp_replace("text", r"\ba\b", "A1")), smoothing=smoothing)
    got = {}
    for r in nb.predict_all(model, test.withColumn("text", F.regexp_replace("text", r"\ba\b", "A1"))).collect():
        got.setdefault(r["doc_id"], {})[r["label"]] = r["probability"]
    for d, p in want.items():
        assert [got[d][k] for k in range(3)] == pytest.approx(p, abs=1e-9)


def test_labels_of_text_and_ties(spark):
    train = spark.createDataFrame([(1, "spam", "buy"), (2, "ham", "meet")], "doc_id int, label string, text string")
    test = spark.createDataFrame([(7, "buy"), (8, "meet"), (9, "other")], "doc_id int, text string")
    assert {r["doc_id"]: r["prediction"] for r in nb.predict(nb.fit(train), test).collect()} == {7: "spam", 8: "ham", 9: "ham"}


def test_cross_validation_covers_every_labelled_doc(spark, small_dir):
    d = tb.labelled_documents(spark, small_dir).withColumn("fold", F.pmod("doc_id", F.lit(5)).cast("int"))
    cv = nb.cross_validate(d, 5)
    assert cv.count() == d.count()
    acc = nb.accuracy(cv).first()
    assert 0.0 <= acc["accuracy"] <= 1.0 and acc["n"] == d.count()


def test_terms_are_counted_where_the_texts_are_dealt(spark):
    """One shuffle, of texts: no row for each term of a document is sent to be counted."""
    rows = [(1, "The x x\ty  \x0b\f\r\n"), (2, None), (3, " \t "), (None, "Y and z"), (1, "x ON")]
    tf = nb.term_frequencies(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"])
    plan = tf._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(doc_id" in plan and "lambda" not in plan
    assert {(r.doc_id, r.term): r.tf for r in tf.collect()} == {(1, "x"): 3, (1, "y"): 1, (None, "y"): 1, (None, "z"): 1}
