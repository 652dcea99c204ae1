import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from bazaarlens.llm import bpe

TEXTS = [
    "", " ", "Hello world, it's 2024!", "a<|endoftext|>b", "<|endoftext|><|endoftext|>",
    "  \n\n  x\t y ", "é中文\U0001f600 don't we'll", "aaaa" * 300, "​　x",
]


@pytest.fixture(scope="module")
def own():
    vocabulary = bpe.read_vocabulary(bpe.vocabulary_path())
    return bpe.encoder(vocabulary, remembered=50), bpe.decoder(vocabulary)


@pytest.fixture(scope="module")
def theirs():
    return Tokenizer.from_file(bpe.vocabulary_path())


def ids_of(packed):
    return np.frombuffer(packed, "<u4").tolist()


@pytest.mark.parametrize("text", TEXTS)
def test_same_ids_as_the_library(own, theirs, text):
    encode, decode = own
    expected = theirs.encode(text, add_special_tokens=False).ids
    assert ids_of(encode(text)) == expected
    assert decode(encode(text)) == theirs.decode(expected, skip_special_tokens=False)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_any_text(own, theirs, text):
    encode, decode = own
    assert ids_of(encode(text)) == theirs.encode(text, add_special_tokens=False).ids
    assert decode(encode(text)) == text


def test_a_word_of_equal_letters_skips_stale_pairs(own, theirs):
    for n in range(1, 60):
        word = "a" * n
        assert ids_of(own[0](word)) == theirs.encode(word, add_special_tokens=False).ids


def test_odd_rows(odd, theirs):
    got = bpe.decode(bpe.encode(odd)).collect()
    assert len(got) == odd.count()
    for row in got:
        text = row["text"] or ""
        assert row["decoded"] == text
        assert ids_of(row["ids"]) == theirs.encode(text, add_special_tokens=False).ids
        assert row["n_tokens"] == len(row["ids"]) // 4
        assert row["more"] in ("x", None)
    columns = [c.lower() for c in bpe.encode(odd).columns]
    assert columns.count("n_tokens") == 1 and "more" in columns


def test_empty_table(odd):
    assert bpe.round_trip(odd.limit(0)).count() == 0


def test_null_ids_decode_to_nothing(spark):
    df = spark.createDataFrame([(1, None), (2, b"")], "i long, ids binary")
    assert {r["decoded"] for r in bpe.decode(df).collect()} == {""}


def test_decoding_in_the_same_pass_gives_the_same(odd):
    at_once, apart = bpe.encode(odd, decoded=True), bpe.decode(bpe.encode(odd))
    assert at_once.columns == apart.columns and at_once.dtypes == apart.dtypes
    assert at_once.exceptAll(apart).count() == apart.exceptAll(at_once).count() == 0
    assert at_once.count() == odd.count() and bpe.encode(odd.limit(0), decoded=True).count() == 0
