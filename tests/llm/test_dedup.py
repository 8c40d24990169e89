import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from quarry.llm import common, dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(rows):
    sets = [(d, shingles(t)) for d, t in rows]
    parent = {d: d for d, _ in sets if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if a is not None and b is not None and s and t and 100 * len(s & t) >= 75 * len(s | t):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return sorted(((d, len(s), None if d is None else root(d), d is None or root(d) == d) for d, s in sets), key=str)


def got(docs):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in dedup.near_duplicates(docs).collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, component_id string, n int")


def test_copies_near_copies_chains_and_look_alikes(spark):
    g = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    text = lambda n: [g.choice(words) for _ in range(n)]
    rows, passage = [], text(60)
    for _ in range(25):  # texts that share a passage, some of them too little to link
        rows.append(passage + text(g.choice([5, 12, 20, 40, 90])))
    base = text(120)
    for _ in range(60):  # a large group of near copies, each with a change of its own
        t = list(base)
        t[g.randrange(120)] = "edit" + str(g.random())
        rows.append(t)
    chain = text(100)
    for _ in range(8):  # a chain: neighbours link, the ends do not
        chain = chain[7:] + text(7)
        rows.append(chain)
    rows += [base, base, text(3)] + [text(n) for n in range(1, 30)]
    g.shuffle(rows)
    rows = [(i, " ".join(w)) for i, w in enumerate(rows)]
    assert got(frame(spark, rows)) == brute(rows)


def test_nulls_empties_repeats_case_and_long_texts(spark):
    long = " ".join(str(i * i % 99991) for i in range(200_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "A b"), (5, "a B"), (6, "a b c"), (None, "a b"), (None, None), (7, "É b"), (8, "é b"),
            (9, long), (10, long + " more"), (11, "one two three four five"), (11, "one two three four five"), (12, "x" * 3_000_000), (13, "a\x0bb")]
    assert got(frame(spark, rows)) == brute(rows)
    assert dedup.near_duplicates(frame(spark, rows).limit(0)).count() == 0


def test_blocks_of_a_mixed_bucket_find_all_links(spark, monkeypatch):
    monkeypatch.setattr(dedup, "BLOCK", 3)
    monkeypatch.setattr(dedup, "SIGNATURE_BLOCK", 4)
    texts = [" ".join(f"{k}w{i}" for i in range(30)) for k in range(3)]
    docs = spark.createDataFrame([(n, texts[n % 3] + f" end{n}") for n in range(1, 9)], "doc_id long, text string")
    f = dedup.features(docs)
    f = f.withColumn("node", F.col("doc_id"))
    members = f.select(F.lit(7).cast("long").alias("key"), "node")
    none = spark.createDataFrame([(1, 1)], "node long, component long")
    links = dedup.across_components(members, none, f.select("node", "planes", "n_shingles"), dedup.Texts(docs, f))
    got = {(r.node, r.component) for r in common.components(links).collect()}
    assert got == {(1, 1), (4, 1), (7, 1), (2, 2), (5, 2), (8, 2), (3, 3), (6, 3)}


def test_texts_that_share_a_passage_stay_apart_in_linear_rows(spark):
    g = random.Random(5)
    passage = [f"p{i}" for i in range(70)]
    rows = [(i, " ".join(passage + [f"w{g.randrange(10**6)}" for _ in range(25)])) for i in range(400)]
    assert got(frame(spark, rows)) == brute(rows)


def test_estimate_is_corrected_for_collisions(spark):
    g = np.random.default_rng(2)
    a, b = (g.integers(0, 1 << 63, (1, dedup.PERMUTATIONS), dtype=np.uint64) for _ in range(2))
    b[0, :64] = a[0, :64]
    df = spark.createDataFrame([(dedup.planes(a)[0].tolist(), dedup.planes(b)[0].tolist())], "a array<long>, b array<long>")
    r = df.select(dedup.differing("a", "b").alias("d"), dedup.estimate(dedup.differing("a", "b")).alias("j")).first()
    assert 50 <= r.d <= 64 and r.j == pytest.approx(0.5, abs=0.1)


def test_components_against_a_plain_search(spark):
    g = random.Random(4)
    edges = [(g.randrange(300), g.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    parent = {}
    find = lambda x: x if parent.setdefault(x, x) == x else find(parent[x])
    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    df = common.components(spark.createDataFrame(edges, "a long, b long"))
    assert sorted(map(tuple, df.collect())) == sorted((n, find(n)) for n in list(parent))


def test_words_do_not_depend_on_the_window():
    import pyarrow as pa

    col = pa.array(["a bb\tccc", None, "", "dd" * 50, " x y  z ", "é É"], pa.string()).slice(0, 6)
    data, offs = common.text_bytes(col)
    whole = common.word_hashes(data, offs)
    for window in (1, 2, 3, 7, 20):
        h, p = common.word_hashes(data, offs, window)
        assert (h == whole[0]).all() and (p == whole[1]).all()
    assert np.diff(whole[1]).tolist() == [3, 0, 0, 1, 3, 2]


def test_sizes_match_spark_words(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    n = docs.select("doc_id", F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).alias("w"))
    f = dedup.features(docs).join(n, "doc_id")
    assert f.filter("n_shingles > greatest(1, w - 4)").count() == 0


def test_a_doc_id_on_several_texts_loses_none(spark):
    words = [f"w{i}" for i in range(40)]
    a, unique, other = " ".join(words), " ".join(f"u{i}" for i in range(40)), " ".join(f"c{i}" for i in range(40))
    rows = [(1, a), (2, a + " more"), (2, unique), (3, other), (5, unique + " x"), (5, unique + " x"), (6, other), (6, other + " y")]
    df = frame(spark, rows).select("doc_id", "text")
    out = dedup.groups(df).join(df.withColumn("text_key", F.xxhash64("text")).distinct(), ["doc_id", "text_key"]).collect()
    got = sorted({(r.doc_id, r.text, r.component_id, r.stays) for r in out})
    assert got == sorted({(1, a, 1, True), (2, a + " more", 1, False), (2, unique, 2, True), (3, other, 3, True),
                          (5, unique + " x", 2, False), (6, other, 3, False), (6, other + " y", 3, False)})
    assert len(out) == len(rows)


def test_a_mixed_bucket_of_one_large_component_makes_linear_rows(spark):
    n = 3000  # near copies in one component, and a stray member
    m = spark.range(n).select(F.lit(7).cast("long").alias("key"), F.col("id").alias("node"), F.when(F.col("id") < n - 1, 0).otherwise(9).cast("long").alias("component"),
                              F.lit(100).alias("n_shingles"))
    rows = dedup._blocked(m, 100)
    assert rows.count() <= n + 40
    pairs = rows.groupBy("key", "x", "y").agg(F.countDistinct("component").alias("c"))
    assert pairs.filter("c > 1").count() == -(-(n - 1) // 100)  # the stray member meets every block
    every = spark.range(300).select(F.lit(7).cast("long").alias("key"), F.col("id").alias("node"), F.col("id").alias("component"), F.lit(100).alias("n_shingles"))
    met = dedup._blocked(every, 100).select("x", "y", "block", "node")
    met = met.alias("a").join(met.alias("b"), F.expr("a.x = b.x and a.y = b.y and a.node < b.node and (a.block = a.x and b.block = b.y or a.block = a.y and b.block = b.x)"))
    assert met.select("a.node", "b.node").distinct().count() == 300 * 299 // 2
