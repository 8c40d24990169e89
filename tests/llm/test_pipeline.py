import importlib.util
import sys

import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as cp
from quarry.llm import mixing, secrets
from quarry.llm.common import keep

sys.path.insert(0, __file__.rsplit("/", 1)[0])
from test_dedup import brute  # noqa: E402


@pytest.fixture(scope="module")
def steps(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    out = [docs]
    for _, stage in cp.STAGES:
        out.append(keep(stage(spark, out[-1], small_dir)))
    return out


def test_all_but_the_last_return_documents(steps):
    for df in steps[1:-1]:
        assert df.schema == steps[0].schema
    assert steps[-1].columns == ["doc_id", "ids", "decoded"]


def test_language_id_drops_only_what_it_rejects(steps):
    before, after = steps[0].toPandas(), steps[1].toPandas()
    gone = set(before.doc_id) - set(after.doc_id)
    assert len(gone) <= 0.02 * len(before)
    letters = before[before.text.map(lambda t: bool(regex.search(r"\p{L}", t)) and len(t) > 200)]
    assert not gone & set(letters.doc_id)


def test_one_document_of_each_group_stays(steps):
    rows = [(r.doc_id, r.text) for r in steps[1].select("doc_id", "text").collect()]
    assert {r.doc_id for r in steps[2].collect()} == {d for d, _, _, kept in brute(rows) if kept}
    assert steps[2].count() == steps[2].select("doc_id").distinct().count()


def test_secrets_are_masked_and_nothing_else(steps):
    values = {}
    for r in secrets.scored(steps[2]).filter("is_secret").collect():
        values.setdefault(r.doc_id, set()).add(r.value)
    after = {r.doc_id: r.text for r in steps[3].collect()}
    for r in steps[2].collect():
        text = r.text
        for v in sorted(values.get(r.doc_id, ()), key=len, reverse=True):
            text = text.replace(v, secrets.MASK)
        assert after[r.doc_id] == text


def test_sources_meet_their_targets(steps):
    plan = mixing.plan(steps[3]).join(steps[3].select("doc_id", "source"), "doc_id").toPandas()
    got = steps[4].withColumn("size", mixing.n_words()).groupBy("source").agg(F.sum("size").alias("size")).toPandas().set_index("source")["size"]
    for source, rows in plan.groupby("source"):
        assert got.get(source, 0) == rows.taken.sum() and abs(rows.taken.sum() - rows.target.iloc[0]) <= 1


def test_tokens_are_those_of_the_library(steps):
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    key = lambda r: (r[0], r[1])
    got = sorted(((r.doc_id, list(r.ids)) for r in steps[5].collect()), key=key)
    assert got == sorted(((r.doc_id, lib.encode(r.text, add_special_tokens=False).ids) for r in steps[4].collect()), key=key)


def test_odd_rows_pass_all_stages(spark):
    rows = [(1, None, "en", "a", 0), (2, "", None, None, 0), (None, "some words of text here again", "en", "a", 29), (None, "some words of text here again", "en", "a", 29),
            (3, "12345 67890", "en", "b", 11), (4, "the same text twice over and over", "en", "a", 33), (4, "the same text twice over and over", "en", "a", 33),
            (5, "the password=9c1f6c02f845bf3028d here", "en", "b", 37), (6, "long text " * 50_000, "en", "a", 500_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("size", F.lit(1)).withColumn("_row", F.lit("x"))
    for df in (docs, docs.limit(0)):
        for name, stage in cp.STAGES:
            df = keep(stage(spark, df, None))
            if name == "near_dedup" and df.count():
                assert sorted((r.doc_id is None, r.doc_id or 0) for r in df.collect()) == [(False, 4), (False, 5), (False, 6), (True, 0), (True, 0)]
    assert df.count() == 0


def rows_of(spark, rows):
    return spark.createDataFrame([(*r, "en", "a", len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")


def test_no_unique_text_goes_with_a_doc_id_that_stands_twice(spark):
    a, unique, other = (" ".join(f"{k}{i}" for i in range(40)) for k in "auc")
    docs = rows_of(spark, [(1, a), (2, a + " more"), (2, unique), (3, other), (3, other)])
    assert sorted((r.doc_id, r.text) for r in cp.near_dedup(spark, docs, None).collect()) == [(1, a), (2, unique), (3, other)]


@pytest.mark.parametrize("names", [["_text", "_id", "_key", "_doc", "_row"], ["text_key", "node", "stays", "component", "key", "least"],
                                   ["_rest", "lang_pred", "score", "other", "_text_key", "_values", "_clean"], ["size", "place", "cut", "taken", "_taken", "_s", "_part", "ids"]])
def test_extra_columns_of_any_name_pass(spark, names):
    docs = rows_of(spark, [(1, "the same text twice over and over"), (2, "the same text twice over and over"), (3, "password=9c1f6c02f845bf3028d here")])
    docs = docs.select("*", *[F.lit(c).alias(c) for c in names])
    for name, stage in cp.STAGES[:-1]:
        out = keep(stage(spark, docs, None))
        assert out.columns == docs.columns, name
        assert all(r[c] == c for r in out.collect() for c in names), name
    assert [r.doc_id for r in cp.near_dedup(spark, docs, None).orderBy("doc_id").collect()] == [1, 3]
    assert cp.tokens(spark, docs, None).columns == ["doc_id", "ids", "decoded"]


def test_without_any_lang_texts_with_letters_pass(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").withColumn("lang", F.lit(None).cast("string"))
    want = {r.doc_id for r in docs.collect() if r.text and regex.search(r"\p{L}", r.text)}
    assert {r.doc_id for r in cp.language_id(spark, docs, None).collect()} == want


def test_foreign_scripts_go_and_labelled_languages_stay(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    foreign = ["Это предложение написано на русском языке и должно быть отклонено", "これは日本語の文章です。短いですが明らかに日本語です。",
               "Αυτή είναι μια ελληνική πρόταση", "هذه جملة مكتوبة باللغة العربية", "xqzv kjwp qqxz vbnm wrtp lkjh zxcv"]
    more = spark.createDataFrame([(10**9 + i, t, None, "x", len(t)) for i, t in enumerate(foreign)], docs.schema)
    left = {r.doc_id for r in cp.language_id(spark, docs.union(more), None).collect()}
    assert not left & {10**9 + i for i in range(len(foreign))}
    clean = {r.doc_id for r in docs.collect() if r.text and regex.search(r"\p{L}", r.text)}
    assert len(clean - left) <= 0.005 * len(clean)


def test_entry_has_the_pipeline():
    path = importlib.util.find_spec("corpus_pipeline").origin.rsplit("/", 1)[0]
    spec = importlib.util.spec_from_file_location("entry", f"{path}/__spark_entry__.py")
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    assert "pipeline" in entry.queries() and sum(q.startswith("op") and q[2].isdigit() for q in entry.queries()) == 13
