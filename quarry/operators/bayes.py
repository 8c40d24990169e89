"""Multinomial Naive Bayes text classification on DataFrames.

Same model as Spark ML's Tokenizer -> StopWordsRemover -> CountVectorizer
-> NaiveBayes (multinomial, smoothing 1):

    log_prior(c)   = ln(n_docs(c) + l) - ln(N + K*l)
    log_theta(c,t) = ln(count(c,t) + l) - ln(total(c) + V*l)
    score(d,c)     = log_prior(c) + sum_t tf(d,t) * log_theta(c,t)

over the training vocabulary (V terms; unknown test terms are ignored).
Here the vocabulary is never collected: counts stay in DataFrames, and
the score is evaluated sparsely as

    score(d,c) = log_prior(c) + n(d)*(ln(l) - ln(total(c)+V*l))
                 + sum_t tf(d,t)*(ln(count(c,t)+l) - ln(l))

summing only over observed (class, term) pairs; n(d) is the number of
vocabulary tokens of d. Spark ML's CountVectorizer keeps at most 2^18
terms by default; this model keeps all of them (identical whenever the
vocabulary fits that default). Labels may be of any orderable type.

An optional ``model`` column fits many independent models in the same
jobs (one per key) — used for k-fold cross-validation.

Scale: training counts tokens by (class, term) with partial aggregation;
prediction deals texts by document, counts terms there and is one shuffle join of document terms with a per-term table
(one row per term holding its class counts; skew on hot terms is split by
AQE) and one grouping per document, which yields n(d) and the observed
class sums together. The priors, one row per class, travel as one array.
No table of documents x classes is made unless all scores are asked for.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import ENGLISH_STOP_WORDS, remove_stop_words, tokenize


def tokenize_only(text: F.Column) -> F.Column:
    """Tokenizer semantics (lower-case, split on single whitespace)."""
    return tokenize(text)


def filtered_tokens(text: F.Column) -> F.Column:
    """N5+N6: lower-case, split on single whitespace, default stop words out."""
    return remove_stop_words(tokenize(text))


def _tokens(docs: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """(keys..., term), one row per filtered token."""
    t = docs.select(*keys, tokenize(F.col(text_col)).alias("_f"))
    # stop words go from the rows: a compiled filter in place of a lambda over each array (tokens are lower-case already)
    return t.select(*keys, F.explode_outer("_f").alias("term")).filter(F.col("term").isNotNull() & ~F.col("term").isin(ENGLISH_STOP_WORDS))


def term_frequencies(docs: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """(keys..., term, tf) from each document's filtered tokens.

    Texts are dealt by the keys, so that a document's tokens are counted where
    they are made: a text is sent, not a row for each of its terms."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = docs.select(*keys, text_col).repartition(parts, *keys)
    return _tokens(dealt, keys, text_col).groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("tf"))


@dataclass
class NaiveBayesModel:
    priors: DataFrame      # (model.., label, n_docs, total_terms, num_features, log_prior, log_denom)
    theta: DataFrame       # (model.., label, term, count, log_theta) observed pairs
    vocabulary: DataFrame  # (model.., term, count)
    model_cols: list
    smoothing: float
    counts: DataFrame      # persisted (model.., label, term, count)

    def unpersist(self) -> None:
        self.counts.unpersist()


def fit(docs: DataFrame, label_col: str = "label", text_col: str = "text",
        model_col: str | None = None, smoothing: float = 1.0) -> NaiveBayesModel:
    """N7+N9: train on (label, text[, model]) rows."""
    m = [model_col] if model_col else []
    d = docs.select(*m, F.col(label_col).alias("label"), F.col(text_col).alias("text"))
    ct = _tokens(d, m + ["label"], "text").groupBy(*m, "label", "term").agg(F.count(F.lit(1)).alias("count"))
    ndocs = d.groupBy(*m, "label").agg(F.count(F.lit(1)).alias("n_docs"))
    return fit_counts(ct, ndocs, m, smoothing)


def fit_counts(ct: DataFrame, ndocs: DataFrame, m: list, smoothing: float = 1.0) -> NaiveBayesModel:
    """Model from aggregated counts: ``ct`` (model.., label, term, count) and
    ``ndocs`` (model.., label, n_docs)."""
    lam = float(smoothing)
    if not lam > 0:
        raise ValueError("smoothing must be above 0")
    # the count table is the model (classes x vocabulary rows, much smaller
    # than the corpus); every model table below reads it, so keep it
    ct = ct.persist()
    vocab = ct.groupBy(*m, "term").agg(F.sum("count").alias("count"))
    v_size = vocab.groupBy(*m).agg(F.count(F.lit(1)).alias("V"))
    totals = ct.groupBy(*m, "label").agg(F.sum("count").alias("total_terms"))
    per_model = ndocs.groupBy(*m).agg(F.sum("n_docs").alias("N"), F.count(F.lit(1)).alias("K"))
    on = m + ["label"]
    pri = ndocs.join(totals, on, "left")
    if m:
        pri = pri.join(per_model, m, "left").join(v_size, m, "left")
    else:  # a single model: N, K and V are scalar subqueries (no action, no join)
        pri = pri.select("*", per_model.select("N").scalar().alias("N"), per_model.select("K").scalar().alias("K"),
                         v_size.select("V").scalar().alias("V"))
    priors = pri.select(
        *m, "label", "n_docs", F.coalesce("total_terms", F.lit(0)).cast("bigint").alias("total_terms"),
        (F.log(F.col("n_docs") + lam) - F.log(F.col("N") + F.col("K") * lam)).alias("log_prior"),
        F.log(F.coalesce("total_terms", F.lit(0)) + F.coalesce("V", F.lit(0)) * lam).alias("log_denom"),
        F.coalesce("V", F.lit(0)).cast("bigint").alias("num_features"))
    theta = ct.join(priors.select(*on, "log_denom"), on).select(
        *m, "label", "term", "count", (F.log(F.col("count") + lam) - F.col("log_denom")).alias("log_theta"))
    return NaiveBayesModel(priors, theta, vocab, m, lam, ct)


def predict(model: NaiveBayesModel, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(model.., id, prediction, probability) for every input document;
    ties go to the smallest label, as Spark ML's argmax does; probability
    is that of the predicted class."""
    return winners(model, _class_scores(model, *_with_tf(model, docs, id_col, text_col), id_col), id_col)


def predict_all(model: NaiveBayesModel, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """N11 in full: (model.., id, label, score, probability), a row per document
    and class — Spark ML's rawPrediction and probability vectors in long form."""
    s = _class_scores(model, *_with_tf(model, docs, id_col, text_col), id_col)
    s = s.select(*model.model_cols, id_col, "scores", F.array_max(F.transform("scores", lambda x: x["score"])).alias("top"))
    s = s.withColumn("norm", F.aggregate("scores", F.lit(0.0), lambda acc, x: acc + F.exp(x["score"] - F.col("top"))))
    s = s.select(*model.model_cols, id_col, "top", "norm", F.explode("scores").alias("s"))
    return s.select(*model.model_cols, id_col, "s.label", "s.score",
                    (F.exp(F.col("s.score") - F.col("top")) / F.col("norm")).alias("probability"))


def _with_tf(model, docs, id_col, text_col):
    d = docs.select(*model.model_cols, id_col, text_col)
    return term_frequencies(d, model.model_cols + [id_col], text_col), d.select(*model.model_cols, id_col)


def _class_scores(model: NaiveBayesModel, tf: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """(model.., id, scores): for each of ``ids`` an array of (label, score) in
    label order, from term frequencies ``tf`` (model.., id, term, tf)."""
    m, lam = model.model_cols, model.smoothing
    key = m + [id_col]
    none = F.struct(F.lit(None).cast(model.counts.schema["label"].dataType).alias("label"), F.lit(1.0).alias("w"))
    of_term = F.struct("label", (F.log(F.col("count") + lam) - F.log(F.lit(lam))).alias("w"))
    per_term = model.counts.groupBy(*m, "term").agg(F.collect_list(of_term).alias("cl"))
    # the entry without a label counts the vocabulary tokens in the same grouping
    hit = tf.join(per_term, m + ["term"]).select(*key, "tf", F.explode(F.concat("cl", F.array(none))).alias("c"))
    sums = hit.groupBy(*key, F.col("c.label").alias("label")).agg(F.sum(F.col("tf") * F.col("c.w")).alias("s"))
    per_doc = sums.groupBy(*key).agg(F.max(F.when(F.col("label").isNull(), F.col("s"))).alias("n"),
                                     F.collect_list(F.when(F.col("label").isNotNull(), F.struct("label", "s"))).alias("seen"))
    classes = F.array_sort(F.collect_list(F.struct("label", "log_prior", "log_denom"))).alias("classes")
    d = ids.join(per_doc, key, "left")
    if m:
        d = d.join(model.priors.groupBy(*m).agg(classes), m)
    else:
        d = d.select("*", model.priors.agg(classes).select("classes").scalar().alias("classes"))
    got = F.map_from_entries(F.coalesce("seen", F.array().cast("array<struct<label:" + model.counts.schema["label"].dataType.simpleString() + ",s:double>>")))
    d = d.withColumn("got", got)
    score = lambda c: (c["log_prior"] + F.coalesce("n", F.lit(0.0)) * (F.log(F.lit(lam)) - c["log_denom"])
                       + F.coalesce(F.element_at("got", c["label"]), F.lit(0.0)))
    return d.select(*key, F.transform("classes", lambda c: F.struct(c["label"].alias("label"), score(c).alias("score"))).alias("scores"))


def winners(model: NaiveBayesModel, scores: DataFrame, id_col: str) -> DataFrame:
    """The best class of each document (the first in label order of equal ones)."""
    s = scores.withColumn("top", F.array_max(F.transform("scores", lambda x: x["score"])))
    best = F.get(F.filter("scores", lambda x: x["score"] == F.col("top")), 0)["label"]
    # softmax of the class scores, as Spark ML's probability column
    norm = F.aggregate("scores", F.lit(0.0), lambda acc, x: acc + F.exp(x["score"] - F.col("top")))
    return s.select(*model.model_cols, id_col, best.alias("prediction"), (F.lit(1.0) / norm).alias("probability"))


def cross_validate(docs: DataFrame, folds: int = 5, fold_col: str = "fold", label_col: str = "label",
                   id_col: str = "doc_id", text_col: str = "text", smoothing: float = 1.0) -> DataFrame:
    """k-fold cross-validation in one pass; returns (id, fold, label, prediction).

    Every document is tokenized once. Counts are aggregated per (fold,
    class, term); model h (trained without fold h) gets the sum over the
    other folds, obtained by copying each aggregated count row to the k-1
    models it belongs to — the copies are of counts, not of documents. All
    k models are fitted together (model key = held-out fold) and each
    document is scored by the model that did not see it."""
    d = docs.select(id_col, F.col(fold_col).cast("int").alias("fold"), F.col(label_col).alias("label"), text_col)
    others = F.filter(F.sequence(F.lit(0), F.lit(folds - 1)), lambda h: h != F.col("fold"))
    tf = term_frequencies(d, [id_col, "fold", "label"], text_col)
    ct = tf.groupBy("fold", "label", "term").agg(F.sum("tf").alias("count")) \
        .select(F.explode(others).alias("model"), "label", "term", "count") \
        .groupBy("model", "label", "term").agg(F.sum("count").alias("count"))
    nd = d.groupBy("fold", "label").agg(F.count(F.lit(1)).alias("n_docs")) \
        .select(F.explode(others).alias("model"), "label", "n_docs") \
        .groupBy("model", "label").agg(F.sum("n_docs").alias("n_docs"))
    model = fit_counts(ct, nd, ["model"], smoothing)
    test_tf = tf.select(F.col("fold").alias("model"), id_col, "term", "tf")
    scores = _class_scores(model, test_tf, d.select(F.col("fold").alias("model"), id_col), id_col)
    pred = winners(model, scores, id_col)
    return pred.join(d.select(id_col, "label"), id_col).select(
        id_col, F.col("model").alias(fold_col), "label", "prediction")


def accuracy(predictions: DataFrame, label_col: str = "label", pred_col: str = "prediction") -> DataFrame:
    """(n, correct, accuracy) as a one-row DataFrame."""
    return predictions.agg(F.count(F.lit(1)).alias("n"),
                           F.sum(F.when(F.col(label_col) == F.col(pred_col), 1).otherwise(0)).cast("bigint")
                           .alias("correct")) \
        .withColumn("accuracy", F.col("correct") / F.col("n"))
