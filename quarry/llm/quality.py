"""Quality by the perplexity of a Kneser-Ney model of trusted text.

The model is trained on trusted documents (labelled good and not toxic): on all whole
texts (but nulls) of one half of them, chosen by a hash of doc_id. The n-grams of
all documents are joined with its counts shard by shard (see ``countjoin``), so every
whole text is scored.
The other half of the trusted documents gives each language its threshold, the
``QUANTILE`` of their perplexity (exact to a thousandth of its logarithm, counted in
bins over all of them); a language with fewer than ``LEAST`` of them takes
the quantile of all languages.

Defined results: a null text is an empty text; a null lang is a language of its own;
without labels there is no threshold and everything is kept; a document
labelled twice is trusted if all its labels are good; a null doc_id has no
label; repeated rows give repeated results; a text of any length is trained on and scored whole; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import countjoin
from .common import keep

QUANTILE, LEAST = 0.995, 50
#: Trusted documents whose ids are sent to every task (32 MB); beyond, the texts are dealt by id to meet them.
SENT_IDS = 4_000_000
_BINS = 1000


def _threshold(counts: DataFrame, quantile: float, keys: list[str]) -> DataFrame:
    """The bin in which ``quantile`` of each group's rows is reached, and the group's size."""
    w = Window.partitionBy(*keys)
    c = counts.groupBy(*keys, "bin").agg(F.sum("n").alias("n")).withColumn("total", F.sum("n").over(w))
    c = c.withColumn("up_to", F.sum("n").over(w.orderBy("bin")))
    return c.filter(F.col("up_to") >= F.lit(quantile) * F.col("total")).groupBy(*keys).agg(F.min("bin").alias("bin"), F.max("total").alias("total"))


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """doc_id, lang, n_tokens, perplexity, threshold, kept."""
    good = F.coalesce((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), F.lit(False))
    trusted = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(good.cast("int")).alias("good")).filter("good = 1").select("doc_id")
    half = F.pmod(F.xxhash64(F.lit(2), "doc_id"), F.lit(2))
    learned = keep(trusted.filter(half == 0))
    texts = docs.filter("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = countjoin.fit(texts.join(F.broadcast(learned) if learned.count() <= SENT_IDS else learned, "doc_id", "left_semi"))
    s = countjoin.score(docs, model, [F.col("doc_id").cast("long").alias("doc_id"), F.col("lang")])
    s = keep(s.withColumn("bits", -F.col("score") / F.col("n_tokens")).select("doc_id", "lang", "n_tokens", "bits"))
    bins = s.join(trusted.filter(half == 1), "doc_id", "left_semi").groupBy("lang", F.floor(F.col("bits") * _BINS).alias("bin")).agg(F.count("*").alias("n"))
    bins = keep(bins)
    overall = _threshold(bins.withColumn("every", F.lit(1)), quantile, ["every"]).first()
    own = _threshold(bins, quantile, ["lang"]).filter(F.col("total") >= LEAST).select(F.col("lang").alias("_lang"), F.col("bin").alias("_bin"))
    s = s.join(own, F.col("lang").eqNullSafe(F.col("_lang")), "left")
    limit = (F.coalesce("_bin", F.lit(overall["bin"] if overall else None).cast("long")) + 1) / _BINS
    ten = F.lit(10.0)
    return s.select("doc_id", "lang", "n_tokens", F.pow(ten, "bits").alias("perplexity"), F.pow(ten, limit).alias("threshold"),
                    F.coalesce(F.col("bits") <= limit, F.lit(True)).alias("kept"))
