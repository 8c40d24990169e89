import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from quarry.llm import phrases

SCHEMA = "lang string, text string, key string, n int"


def brute(rows, least, top=2000):
    f = defaultdict(Counter)
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, 6):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        n = sum(v for p, v in c.items() if len(p) == 1)
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        drop = set()
        for p, a in cand.items():
            for k in range(2, len(p)):
                drop |= {p[i : i + k] for i in range(len(p) - k + 1) if 100 * a >= 100 * c[p[i : i + k]]}
        rows_ = []
        for p, a in cand.items():
            if p not in drop:
                score, k = min((1000 * a * n // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                rows_.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        rows_.sort()
        out += [(lang, i + 1, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(rows_[:top])]
    return sorted(out)


def got(df):
    return sorted(map(tuple, df.collect()))


def some_rows(seed, n=300):
    g = random.Random(seed)
    words = ["the", "The", "of", "é", "a", "ab", "ab\x01c", "b", "x" * 200, "of\x1f"] + [f"w{i}" for i in range(12)]
    ends = [" ", "  ", "\t", " . ", ",", "\n", "\x0b", " "]
    fixed = "new york city hall is open".split()
    rows = []
    for _ in range(n):
        t = []
        for _ in range(g.randrange(30)):
            t += fixed[g.randrange(3) :] if g.random() < 0.1 else [g.choice(words[: g.randrange(1, len(words))])]
        rows.append((g.choice(["en", "fr", None, "und", "", "e n"]), "".join(w + g.choice(ends) for w in t)))
    return rows + [(None, None), ("en", ""), ("xx", " . \n"), ("en", "same words here " * 400), ("fr", "word " * 3000)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_a_plain_count(spark, seed):
    rows = some_rows(seed)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    assert got(phrases.collocations(df, least=5)) == brute(rows, 5)
    assert got(phrases.collocations(df, least=5, top=3)) == brute(rows, 5, 3)


def test_streams_cut_anywhere_give_the_same(spark, monkeypatch):
    rows = some_rows(3)
    monkeypatch.setattr(phrases, "WINDOW_BYTES", 20_000)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(5)
    found = phrases.candidates(df, least=4, per=25)
    want = {(r[2], r[0], *r[3:]) for r in brute(rows, 4, 10**9)}
    assert {(r.key.split(" ", 1)[1][:-1], bytes.fromhex(r.key.split(" ", 1)[0]).decode(), r.a, r.l, r.r, r.n, r.score) for r in found.collect()} == want


def test_an_empty_table_and_extra_columns(spark):
    df = spark.createDataFrame([("en", "a b", "k", 1)], SCHEMA)
    assert phrases.collocations(df.limit(0)).count() == 0
    assert phrases.collocations(df).count() == 0
    assert [tuple(r) for r in phrases.collocations(df, least=1).collect()] == [("en", 1, "a b", 1, 1, 1, 2, 2000)]


def test_exact_beyond_64_bits():
    run = phrases._left_parts([[]])
    big = 10**17
    rows = [("00 ", 9 * big, None), ("00 a ", 7 * big + 1, []), ("00 a b ", 5 * big + 3, [6 * big + 7])]
    cols = [pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows]), pa.array([r[2] for r in rows], pa.list_(pa.int64())), pa.array([0] * 3, pa.int32())]
    out = pa.Table.from_batches(list(run([pa.RecordBatch.from_arrays(cols, names=["key", "f", "along", "part"])]))).to_pylist()
    assert out[-1]["score"] == 1000 * (5 * big + 3) * 9 * big // ((7 * big + 1) * (6 * big + 7))


def test_common_bytes_of_neighbours():
    g = random.Random(5)
    keys = sorted("".join(g.choice("ab ") for _ in range(g.randrange(0, 300))).encode() for _ in range(200)) + [b"a" * 500, b"a" * 500 + b"b"]
    data, offs = phrases.text_bytes(pa.array([k.decode() for k in keys]))
    want = [0] + [next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))) for a, b in zip(keys, keys[1:])]
    assert np.array_equal(phrases._shared_bytes(data, offs, 16), want)


def test_documents_of_the_tables(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert got(phrases.collocations(docs, least=20)) == brute(rows, 20)
    assert phrases.collocations(docs.withColumn("lang", F.lit("x")), least=20).count()


def test_languages_of_any_name_in_short_keys(spark):
    """Names of a to z stand in the sorted keys as they are (hexadecimal before: twice as long); all others come back whole too."""
    langs = ["en", "", "EN", "%656e", "a b", "é", "656e", None, "en\n"]
    docs = spark.createDataFrame([(lang, "one two three. " * (3 + i)) for i, lang in enumerate(langs)], "lang string, text string")
    keys = {r.key for r in phrases.counts(docs, least=3).collect()}
    assert "en one two three " in keys and "und " in keys and "%454E one " in keys
    got = {r.lang: (r.phrase, r.a) for r in phrases.collocations(docs, least=3).collect()}
    assert got == {"und" if lang is None else lang: ("one two three", 3 + i) for i, lang in enumerate(langs)}
