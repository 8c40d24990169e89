import zlib

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F
from quarry.llm import langid
from quarry.llm.common import text_bytes


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = langid.identify(docs).join(docs.select("doc_id", "lang", "text"), "doc_id").toPandas()
    assert len(out) == docs.count() and out.score.between(0, 1).all()
    assert (out.held_out == out.doc_id.map(lambda d: zlib.crc32(str(d).encode()) % 4 == 2)).all()
    held = out[out.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.98
    assert (out.lang_pred.eq("und") == out.text.map(lambda t: not regex.search(r"\p{L}", t))).all()


def test_gradients_match_finite_differences():
    g = np.random.default_rng(0)
    h, x = 3, g.integers(0, 256, (5, 4))
    tables, loop, target = g.normal(0, 0.5, (256, 3 * h)), g.normal(0, 0.5, (h, 3 * h)), g.normal(size=(5, 4, h))

    def loss(t, u):
        return (langid._read(t, u, x)[0] * target).sum()

    d_table, d_loop = langid._unroll(loop, langid._read(tables, loop, x)[1], x, target)
    for _ in range(20):
        i, j = g.integers(h), g.integers(3 * h)
        e = np.zeros_like(loop)
        e[i, j] = 1e-6
        assert d_loop[i, j] == pytest.approx((loss(tables, loop + e) - loss(tables, loop - e)) / 2e-6, abs=1e-6)
        e = np.zeros_like(tables)
        e[x[i % 5, i], j] = 1e-6
        assert d_table[x[i % 5, i], j] == pytest.approx((loss(tables + e, loop) - loss(tables - e, loop)) / 2e-6, abs=1e-6)


def test_reader_is_the_network_over_every_window():
    import pyarrow as pa

    net = langid.Network.fresh(["a", "b", "c"], langid.HIDDEN, 1)
    texts = ["x" * 63 + "é" * 80, None, "", "short", "ab c" * 100]
    data, offs = text_bytes(pa.array(texts))
    got = langid.Reader(net).documents(data, offs, most=3)
    h = langid.HIDDEN
    for t, p in zip(texts, got):
        raw, total = np.frombuffer((t or "").encode(), np.uint8), np.zeros(3)
        for a in range(0, len(raw), langid.WINDOW):
            w = np.zeros(langid.WINDOW, np.uint8)
            w[: len(raw[a : a + langid.WINDOW])] = raw[a : a + langid.WINDOW]
            f = langid._read(net.tables[0], net.loops[0], w[:, None])[0][:, 0]
            b = langid._read(net.tables[1], net.loops[1], w[::-1, None])[0][::-1, 0]
            z = f @ net.out[:h] + b @ net.out[h:] + net.bias
            e = np.exp(z - z.max(axis=1, keepdims=True))
            total += (e / e.sum(axis=1, keepdims=True))[: len(raw) - a].sum(axis=0)
        assert p == pytest.approx(total / max(1, len(raw)), abs=1e-4)


def test_lang_source_and_id_are_no_inputs(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    net = langid.fit(docs, ~langid.held_out(F.col("doc_id"), 4, 2))
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None)).withColumn("key", F.col("doc_id"))
    a = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs, net, [F.col("doc_id")]).collect()}
    b = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(other, net, [F.col("doc_id")]).collect()}
    assert a == b


def test_nulls_empties_repeats_long_texts_and_clashing_columns(spark):
    rows = [(1, None, "en", 0.0), (2, "", "en", 0.0), (3, "12 34", "de", 0.0), (None, "the cat and the hat", "en", 0.0), (4, "the dog and the log", "en", 0.0),
            (4, "the dog and the log", "en", 0.0), (5, "der Hund und die Katze", "de", 0.0), (8, "la vie", None, 0.0), (9, "und der " * 100_000, "de", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    got = langid.identify(docs).collect()
    assert len(got) == len(rows) and {r.lang_pred for r in got if r.doc_id in (1, 2, 3)} == {"und"}
    assert {r.lang_pred for r in got} <= {"en", "de", "und"} and all(0 <= r.score <= 1 for r in got)
    assert {(r.lang_pred, r.score) for r in langid.identify(docs.filter("doc_id = 8")).collect()} == {("und", 0.0)}
    assert langid.identify(docs.limit(0)).count() == 0


def test_the_judge_learns_from_every_window(spark, monkeypatch):
    """Not from the sample's windows alone: it only says where the network starts."""
    g, rows = np.random.default_rng(3), []
    for i in range(90):
        letters = ["abcde ", "nopqr ", "vwxyz "][i % 3]
        rows.append((i, "ABC"[i % 3], "".join(g.choice(list(letters), 64 * (5 + i % 9)))))
    rows += [(90, None, "abc " * 50), (91, "A", None), (92, "A", "")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(3)
    refine, got = langid.refine, []
    monkeypatch.setattr(langid, "SAMPLE_WINDOWS", 60)
    monkeypatch.setattr(langid, "refine", lambda net, d, other: got.extend([net, *refine(net, d, other)]) or got[1:])
    learn = F.col("doc_id") % 4 != 2
    judge = langid.fit_judge(docs, learn)
    begun, net, windows = got
    assert windows == sum(-(-len(t) // langid.WINDOW) for i, lang, t in rows if lang and t and i % 4 != 2)
    assert judge.net is net and all(np.isfinite(w).all() and (w != b).any() for w, b in zip(net.weights(), begun.weights()))
    named = langid.predict(docs.filter(~learn & F.col("text").isNotNull()), net, [F.col("lang")]).filter("lang is not null").collect()
    assert sum(r.lang == r.lang_pred for r in named) / len(named) > 0.9
    assert 0 < judge.least <= 0.3 and 0.5 <= judge.most_other <= 1.0001


def test_training_goes_over_rows_of_a_whole_batch():
    """numpy goes over rows of a few units many times slower: each unit's numbers of a batch lie one after the other."""
    net = langid.Network.fresh(["a", "b"], langid.HIDDEN, 1)
    x = np.random.default_rng(2).integers(0, 256, (langid.WINDOW, 50)).astype(np.uint8)
    states, kept = langid._read(net.tables[0], net.loops[0], x)
    assert states.shape == (langid.WINDOW, 50, langid.HIDDEN) and states.strides[1] == states.itemsize
    assert all(a.shape == (langid.HIDDEN, 50) and a.strides[1] == a.itemsize for step in kept for a in step)
    y, lengths = np.arange(50) % 2, np.arange(50) + 1
    changed = np.where(np.arange(langid.WINDOW)[:, None] < lengths, x, 0)
    grads = langid._gradients(net, changed, lengths, y)
    assert all(np.isfinite(g).all() and g.any() for g in grads)
    doubled = langid._gradients(net, changed, lengths, y, np.full(50, 2.0))
    assert all(b == pytest.approx(2 * a, abs=1e-12) for a, b in zip(grads, doubled))
