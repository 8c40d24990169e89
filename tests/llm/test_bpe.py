import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from quarry.llm import bpe
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")
OURS, THEIRS = bpe.WordBpe.from_file(PATH), Tokenizer.from_file(PATH)

HARD = ["", " ", "a", "aaaa aaaaaaa aaa", "Hello, world's BEST!!", "it's they're I'LL", "été Été ÉCOLE", "ΣΑΣ ΟΔΟΣ",
        "<|endoftext|>", "x<|startoftext|>y <|endoftext|><|", "１２３ ٣٤ 12345", "日本語 テキスト", "é Å", "\x1c\x85 \xa0\x0b",
        "banana " * 50, "İstanbul", "👩‍👩‍👧 ok", "\x00\x01", "ﬁ ǅ ß ẞ"]


def same(texts):
    for text, ids in zip(texts, OURS.encode(texts)):
        want = THEIRS.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want, text
        assert OURS.decode(ids) == THEIRS.decode(want, skip_special_tokens=False)


def test_hard_texts_match_the_library():
    same(HARD)
    same([" ".join(HARD) * 20])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8", max_codepoint=0x2FFF, exclude_categories=["Cn", "Cs"]), max_size=40), max_size=5))
def test_any_texts_match_the_library(texts):
    same(texts)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("aeinrst", max_size=60), min_size=1, max_size=8))
def test_overlapping_pairs_match_the_library(texts):
    same(texts)


def test_query_digests_match_the_library(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    rows = {r.doc_id: r for r in bpe.round_trip(docs, PATH).collect()}
    for d in docs.collect():
        ids = THEIRS.encode(d.text, add_special_tokens=False).ids
        assert rows[d.doc_id].n_tokens == len(ids)
        assert rows[d.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert rows[d.doc_id].decoded_sha256 == hashlib.sha256(THEIRS.decode(ids, skip_special_tokens=False).encode()).hexdigest()


@pytest.fixture
def odd(spark):
    return spark.createDataFrame([(1, None, 1), (2, "", 2), (None, "a b", 3), (2, "", 2), (5, "word " * 100_000, 4)], "doc_id long, text string, ids int")


def test_nulls_empties_repeats_long_texts_and_clashing_columns(odd):
    rows = bpe.round_trip(odd, PATH).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in rows) == [(0, 2), (1, 0), (2, 0), (2, 0), (5, 100_000)]
    assert {r.ids_sha256 for r in rows if not r.n_tokens} == {empty} == {r.decoded_sha256 for r in rows if not r.n_tokens}
    both = bpe.decode(bpe.encode(odd, PATH), PATH).collect()
    assert sorted((r.doc_id or 0, len(r.ids), r.decoded.count("</w>")) for r in both) == [(0, 2, 2), (1, 0, 0), (2, 0, 0), (2, 0, 0), (5, 100_000, 100_000)]
    assert bpe.round_trip(odd.limit(0), PATH).count() == 0
