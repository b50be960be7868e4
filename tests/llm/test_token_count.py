import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tributary.llm.packing import UnitEncoder
from tributary.llm.token_count import ChunkCounter, count_tokens, prove_whole_tokens

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "It's  DON'T we'LL\n\n x", "<|endoftext|> a<|startoftext|>b", "naïve Straße ÜBER", "日本語 テキスト", "a\x1cb\x85c d", "İstanbul ﬁ", "👍🏽 é", "1234 5,6.7", "'s''t'", "x" * 3000, "\x00\x07 tab\tcr\r\n", "ǅ ʼn ß"]


@pytest.fixture(scope="module")
def counter():
    return ChunkCounter(WORD, prove_whole_tokens(WORD), memo_entries=50)


@pytest.fixture(scope="module")
def encoder():
    return UnitEncoder(BYTE, memo_entries=50)


WORDS, BYTES = Tokenizer.from_file(WORD), Tokenizer.from_file(BYTE)


def check(texts, counter, encoder):
    assert counter.count(texts) == [len(WORDS.encode(t, add_special_tokens=False).ids) for t in texts]
    import numpy as np

    assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)] == [BYTES.encode(t, add_special_tokens=False).ids for t in texts]


def test_odd_texts(counter, encoder):
    check(ODD, counter, encoder)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("abzAZ 'stlérßÜ\n\t.,!<|>0१ 日  ") | st.characters(exclude_categories=["Cs"]), max_size=25), max_size=4))
def test_any_text(counter, encoder, texts):
    check(texts, counter, encoder)


def test_rows(spark):
    rows = spark.createDataFrame([(1, None, 5), (2, "", 6), (3, "hello world", 7), (3, "hello world", 7)], "doc_id long, text string, n_tokens int")
    got = sorted(map(tuple, count_tokens(rows, WORD, limit=1).collect()))
    assert got == [(1, 0, 0, False), (2, 0, 0, False), (3, 11, 2, True), (3, 11, 2, True)]
    assert count_tokens(rows.limit(0), WORD).count() == 0
