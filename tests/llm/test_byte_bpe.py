import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from star_marts.llm import byte_bpe
from star_marts.llm.byte_bpe import Prefixes, text_encoder


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=text_encoder().encoder.ranks, special_tokens={}
    )


@settings(max_examples=300, deadline=None)
@given(text=st.text(max_size=60))
def test_equals_library(library, text):
    assert text_encoder().encode(text) == library.encode_ordinary(text)


@pytest.mark.parametrize("text", ["", " ", "a" * 3000, "\n \t " * 200, "<|endoftext|>", "naïve Straße 12345 don't", "日本語テキスト", "a b"])
def test_equals_library_on_odd_texts(library, text):
    assert text_encoder().encode(text) == library.encode_ordinary(text)
    assert text_encoder().encoder.decode(text_encoder().encode(text)) == text.encode()


def test_append_and_edit_equal_a_new_encoding():
    encoder, rng = text_encoder().encoder, random.Random(3)
    text = bytes(rng.choice(b"thereanding on ") for _ in range(400))
    table = Prefixes(encoder)
    for i in range(0, len(text), 7):
        table.append(text[i : i + 7])
    assert table.ids() == encoder.encode(text) == encoder.merged(text)
    for _ in range(20):
        a = rng.randrange(len(text))
        b = min(len(text), a + rng.randrange(5))
        text = text[:a] + b"ing" + text[b:]
        table.edit(a, b, b"ing")
        assert bytes(table.data) == text
        assert table.last == Prefixes(encoder, text).last
    assert table.ids() == encoder.merged(text)


def test_an_edit_leaves_far_prefixes_alone():
    table = Prefixes(text_encoder().encoder, b"thereandin" * 300)
    assert table.edit(5, 6, b"x") < 1000


def test_rows(spark, library):
    rows = [(1, "the theme"), (2, None), (2, None), (None, "ab"), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "1 AS n_tokens", "2 AS ids")
    out = byte_bpe.digests(docs).collect()
    assert sorted(str(r.doc_id) for r in out) == ["1", "2", "2", "3", "None"]
    for r in out:
        text = dict(rows)[r.doc_id] or ""
        ids = library.encode_ordinary(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    back = byte_bpe.decode(byte_bpe.encode(docs)).collect()
    assert sorted(bytes(r.data) for r in back) == [b"", b"", b"", b"ab", b"the theme"]
    assert byte_bpe.digests(docs.limit(0)).count() == 0
