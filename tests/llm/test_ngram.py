import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from quarry.llm import ngram

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*WORD.findall(low), None]


def brute(train, texts):
    """The model's definition, on dictionaries."""
    uni, bi = Counter(), Counter()
    for t in train:
        ts = tokens(t)
        uni.update(ts)
        bi.update(zip(["<s>", *ts[:-1]], ts))
    n, v = sum(uni.values()), len(uni)
    context, seen, before = Counter(), defaultdict(Counter), Counter()
    for (a, b), c in bi.items():
        context[a] += c
        seen[a][min(c, 3)] += 1
        before[b] += 1
    d2 = [0, *ngram._discounts([sum(c == k for c in bi.values()) for k in range(1, 5)])]
    d1 = [0, *ngram._discounts([sum(c == k for c in before.values()) for k in range(1, 5)])]
    left1 = sum(d1[min(c, 3)] for c in before.values()) / max(1, len(bi)) if bi else 1.0

    def low(w):
        return max(before[w] - d1[min(before[w], 3)], 0) / max(1, len(bi)) + left1 / (v + 1)

    def p(a, w):
        if not context[a]:
            return low(w)
        c = bi[a, w]
        left = sum(d2[k] * x for k, x in seen[a].items()) / context[a]
        return max(c - d2[min(c, 3)], 0) / context[a] + left * low(w)

    for a in ("<s>", "the", "unseen"):  # a distribution over the vocabulary and one unknown word
        assert sum(p(a, w) for w in uni) + p(a, "never seen") == pytest.approx(1) if uni else True
    out = []
    for t in texts:
        ts = tokens(t)
        out.append((len(ts), sum(uni[w] > 0 for w in ts), n, sum(math.log10((uni[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ts),
                    sum(math.log10(p(a, w)) for a, w in zip(["<s>", *ts[:-1]], ts))))
    return out


def check(docs):
    rows = docs.collect()
    held = [zlib.crc32(str(r.doc_id).encode()) % 5 == 1 if r.doc_id is not None else False for r in rows]
    want = brute([r.text for r, h in zip(rows, held) if not h], [r.text for r in rows])
    got = sorted(((r.doc_id is not None, r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in ngram.language_model(docs).collect()), key=str)
    exp = sorted(((r.doc_id is not None, r.doc_id, h, *w) for r, h, w in zip(rows, held, want)), key=str)
    assert len(got) == len(exp)
    for g, e in zip(got, exp):
        assert g[:6] == e[:6]
        assert g[6:] == pytest.approx(e[6:], rel=1e-5)
    return got


def test_scores_match_the_definition_and_beat_the_base(spark, small_dir):
    got = check(spark.read.parquet(f"{small_dir}/documents.parquet"))
    assert sum(g[7] for g in got if g[2]) > sum(g[6] for g in got if g[2])


def test_counts_of_255_and_more(spark):
    check(spark.createDataFrame([(i, "the end " * (i % 3 + 1) * 40) for i in range(30)], "doc_id long, text string"))


def test_nulls_empties_repeats_long_texts_and_clashing_columns(spark):
    rows = [(1, None, 1.0), (2, "", 2.0), (None, "a b a", 1.0), (2, "", 2.0), (7, "A b\x0bc d\té É", 0.0), (8, "long " * 300_000, 1.0), (9, "x" * 3_000_000 + " y", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    check(docs)
    assert ngram.language_model(docs.limit(0)).count() == 0
    assert [r.score for r in ngram.language_model(docs.filter("doc_id = 1").withColumn("doc_id", docs.doc_id * 0 + 4)).collect()][0] <= 0
