import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rastro.llm.tokenize import TOKENIZERS, Encoder, encode_corpus, load_ranks

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def own():
    return Encoder(load_ranks())


@pytest.fixture(scope="module")
def other():
    t = tokenizers.Tokenizer.from_file(f"{TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return t


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_equals_the_library(own, other, text):
    assert own.encode(text) == other.encode(text, add_special_tokens=False).ids


def test_long_pieces_and_marks(own, other):
    rng = random.Random(1)
    for text in ("a" * 5000, "很" * 3000, "".join(rng.choice("abcdefgh") for _ in range(4000)), "<|endoftext|> x", "it's we'll 123456 ...!!  \n\n \t x  "):
        assert own.encode(text) == other.encode(text, add_special_tokens=False).ids


def test_corpus(spark, own):
    rows = [(1, "Hola, ¿qué tal?"), (2, None), (3, ""), (4, " "), (1, "Hola, ¿qué tal?"), (5, "x" * 200_000)]
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], "doc_id bigint, text string, ids string, n_tokens int")
    got = encode_corpus(df).collect()
    assert sorted((r.doc_id, r.ids) for r in got) == sorted((d, own.encode(t)) for d, t in rows)
    assert sorted((r.doc_id, r.n_tokens) for r in encode_corpus(df, lengths=True).collect()) == sorted((d, len(own.encode(t))) for d, t in rows)
    assert encode_corpus(df.limit(0)).collect() == []
