import math
import random
import re

import pytest
from pyspark.sql import functions as F
from quarry.llm import quality


def test_junk_goes_and_clean_text_stays(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    out = quality.classify(docs, labels).join(labels, "doc_id", "left").toPandas()
    assert len(out) == docs.count()
    assert out[out.quality == 1].kept.mean() > 0.97
    assert out[out.quality == 0].kept.mean() < 0.6
    assert (out.kept == (out.perplexity <= out.threshold * (1 + 1e-12))).all()


def test_perplexity_is_that_of_the_scores(spark, small_dir):
    from quarry.llm import ngram

    docs, labels = spark.read.parquet(f"{small_dir}/documents.parquet"), spark.read.parquet(f"{small_dir}/labels.parquet")
    h = F.xxhash64(F.lit(2), F.col("doc_id"))
    ids = labels.filter("quality = 1 and toxic = 0").filter(F.pmod(h, F.lit(2)) == 0).select("doc_id")
    s = ngram.score(docs, ngram.fit(docs.join(ids, "doc_id", "left_semi")), [F.col("doc_id")]).toPandas().set_index("doc_id")
    out = quality.classify(docs, labels).toPandas().set_index("doc_id")
    want = 10 ** (-s.score / s.n_tokens)
    assert ((out.perplexity / want - 1).abs() < 1e-6).all()


def test_nulls_empties_repeats_and_no_labels(spark):
    rows = [(1, None, None, 0.5), (2, "", "en", 0.5), (None, "a b", "en", 0.5), (2, "", "en", 0.5), (3, "word " * 250_000, "de", 0.1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, threshold double")
    labels = spark.createDataFrame([(1, 1, None), (2, None, 0), (None, 1, 0), (3, 1, 1), (3, 1, 0)], "doc_id long, quality int, toxic int")
    for lab in (labels, labels.limit(0)):
        out = quality.classify(docs, lab)
        assert out.count() == 5 and out.filter("perplexity is null or kept is null").count() == 0
    assert out.filter("not kept").count() == 0
    assert quality.classify(docs.limit(0), labels).count() == 0


def _brute(train, texts):
    """log10 probability of each text by the definition, on dictionaries."""
    from collections import Counter, defaultdict
    from math import log10

    from quarry.llm.ngram import _discounts

    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    pairs = Counter(p for t in train for w in [words(t)] for p in zip(["<s>", *w], [*w, "</s>"]))
    before, after = defaultdict(int), defaultdict(list)
    for (v, w), n in pairs.items():
        before[w] += 1
        after[v].append(n)
    cc = lambda c: _discounts([sum(x == k for x in c) for k in (1, 2, 3, 4)])
    d, low_d = cc(pairs.values()), cc(before.values())
    cut = lambda n, d: d[min(n, 3) - 1] if n else 0.0
    rest = sum(cut(n, low_d) for n in before.values()) / len(pairs) if pairs else 1.0

    def p(v, w):
        low = max(before.get(w, 0) - cut(before.get(w, 0), low_d), 0) / max(1, len(pairs)) + rest / (len(before) + 1)
        if v not in after:
            return min(low, 1.0)
        n, c = pairs.get((v, w), 0), sum(after[v])
        return min(max(n - cut(n, d), 0) / c + sum(cut(x, d) for x in after[v]) / c * low, 1.0)

    return [sum(log10(p(v, w)) for x in [words(t)] for v, w in zip(["<s>", *x], [*x, "</s>"])) for t in texts]


@pytest.mark.parametrize("small", [False, True])
def test_count_join_is_the_definition(spark, monkeypatch, small):
    """Also with many batches, blocks and salts: what a task meets does not change a score."""
    from quarry.llm import countjoin

    if small:
        for name, value in (("BATCH_TOKENS", 50), ("BATCH_DOCS", 3), ("BLOCK_KEYS", 5), ("SHARDS", 2)):
            monkeypatch.setattr(countjoin, name, value)
    rnd = random.Random(3)
    word = lambda: rnd.choice("the the the a of to and cat Dog sat on mat 漢字 é x1 y2 z3".split())
    train = [" ".join(word() for _ in range(rnd.randrange(0, 30))) for _ in range(60)]
    texts = [*(" ".join(word() for _ in range(rnd.randrange(0, 40))) for _ in range(40)), "", None, "unknown words only", "the " * 5000, "\t\n", "THE cat", train[0], train[0]]
    model = countjoin.fit(spark.createDataFrame([(t,) for t in train], "text string"))
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    out = countjoin.score(docs, model, [F.col("id"), F.lit("x").alias("batch")]).toPandas().set_index("id")
    assert len(out) == len(texts) and set(out.batch) == {"x"}
    for i, want in enumerate(_brute(train, texts)):
        assert out.score[i] == pytest.approx(want, rel=1e-9, abs=1e-9), texts[i]
    assert [out.n_tokens[40 + k] for k in range(4)] == [1, 1, 4, 5001]
    assert countjoin.score(docs.limit(0), model, [F.col("id")]).count() == 0
    none = countjoin.fit(docs.limit(0).select("text"))
    assert set(countjoin.score(docs, none, [F.col("id")]).toPandas().score) == {0.0}


def test_thresholds_are_the_quantiles_of_each_language(spark, small_dir):
    """Recomputed from the perplexities of the half that was not learned from."""
    docs, labels = spark.read.parquet(f"{small_dir}/documents.parquet"), spark.read.parquet(f"{small_dir}/labels.parquet")
    out = quality.classify(docs, labels).toPandas()
    h = F.xxhash64(F.lit(2), F.col("doc_id"))
    held = {r.doc_id for r in labels.groupBy("doc_id").agg(F.min((F.coalesce(F.col("quality") == 1, F.lit(False)) & (F.coalesce("toxic", F.lit(0)) == 0)).cast("int")).alias("g"))
            .filter("g = 1").filter(F.pmod(h, F.lit(2)) == 1).collect()}
    bins = lambda d: sorted(math.floor(math.log10(x) * 1000 + 1e-9) for x in d.perplexity)
    at = lambda b: b[max(0, math.ceil(quality.QUANTILE * len(b)) - 1)] + 1
    trusted = out[out.doc_id.isin(held)]
    for lang, rows in out.groupby("lang"):
        own = trusted[trusted.lang == lang]
        want = at(bins(own if len(own) >= quality.LEAST else trusted))
        assert rows.threshold.nunique() == 1
        assert math.log10(rows.threshold.iloc[0]) * 1000 == pytest.approx(want, abs=1e-6)


def test_all_trusted_texts_are_counted_whole(spark, monkeypatch):
    """Also a long one, and in as many shards as the model needs; the other half is not learned from."""
    from quarry.llm import countjoin

    monkeypatch.setattr(countjoin, "SHARDS", 1)
    monkeypatch.setattr(countjoin, "SHARD_KEYS", 4)
    fitted = []
    fit = countjoin.fit
    monkeypatch.setattr(countjoin, "fit", lambda texts: fitted.append(fit(texts)) or fitted[-1])
    texts = ["a bc d " * 40_000, *(f"good text number {i} of these" for i in range(40)), None]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(len(texts))], "doc_id long, quality int, toxic int")
    half = {r.doc_id for r in labels.filter(F.pmod(F.xxhash64(F.lit(2), "doc_id"), F.lit(2)) == 0).collect()}
    if 0 not in half:  # the long text is to be learned from
        texts[0], texts[min(half)] = texts[min(half)], texts[0]
        docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    out = quality.classify(docs, labels).toPandas().set_index("doc_id")
    assert fitted[0].tokens == sum(len(texts[i].split()) + 1 for i in half if texts[i] is not None) > 120_000
    assert fitted[0].shards > 8
    for i, want in zip(range(len(texts)), _brute([texts[i] for i in sorted(half) if texts[i] is not None], texts)):
        assert out.perplexity[i] == pytest.approx(10 ** (-want / out.n_tokens[i]), rel=1e-6)


def test_disk_holds_one_round_and_no_table_that_only_served_the_fit(spark, monkeypatch):
    """The counts of pairs and words are given back, a large table is not copied for salts, shuffle files go with their round."""
    from quarry.llm import countjoin

    kept, keep = [], countjoin.keep
    monkeypatch.setattr(countjoin, "keep", lambda df, **how: kept.append((keep(df, **how), how)) or kept[-1][0])
    monkeypatch.setattr(countjoin, "SHARDS", 2)
    train = [f"a{i % 7} b{i % 5} c{i % 3} d{i}" for i in range(200)]
    model = countjoin.fit(spark.createDataFrame([(t,) for t in train], "text string"))
    rows = lambda df: spark.read.parquet(*{f.rpartition("/")[0] for f in df.inputFiles()}).count()
    assert [rows(df) for df, _ in kept[:2]] == [0, 0] and rows(model.table) > 0
    pairs = {p for t in train for w in [t.split()] for p in zip(["<s>", *w], [*w, "</s>"])}
    assert model.keys == len(pairs) + len({w for _, w in pairs}) == model.table.agg(F.sum("keys")).first()[0]
    docs = spark.createDataFrame(list(enumerate([*train, "b1 c1 x", None, ""])), "id long, text string")
    once = {}
    for copies in (1 << 23, 0):
        monkeypatch.setattr(countjoin, "SALT_KEYS", copies)
        del kept[:]
        once[copies] = {r.id: r.score for r in countjoin.score(docs, model, [F.col("id")]).collect()}
        assert len(kept) == countjoin.ROUNDS and all(how == {"clean": True} for _, how in kept)
    for i, want in enumerate(_brute(train, [r.text for r in docs.orderBy("id").collect()])):
        assert once[0][i] == pytest.approx(want, rel=1e-9) and once[1 << 23][i] == pytest.approx(want, rel=1e-9)
