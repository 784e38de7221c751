import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from assetboard.llm import token_counts as tc

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, n_tokens string, lang string"


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(PATH)


def odd_texts():
    rng = random.Random(7)
    pool = ["the", "Haus,", "éau", "  ", "\n", "\n\n ", " ", "　x", "don't", "<|endoftext|>", "12345", "\t", "😀",
            "\u0085", "á", "%%%", "\r\n", "'ll", " 's", "字字", "\x1c", "_"]
    texts = ["", " ", "   ", None, "one", "one two", "x" * 5000, " " * 3000, "ab " * 4000, "    a"]
    texts += ["".join(rng.choice(pool) + rng.choice([" ", "", " ", "\n"]) for _ in range(rng.randint(1, 900)))
              for _ in range(60)]
    return texts


@pytest.mark.parametrize("chunk,overlap", [(64, 8), (500, 40), (32_768, 512)])
def test_counts_equal_the_library(spark, plain, chunk, overlap):
    texts = odd_texts()
    docs = spark.createDataFrame([(i, t, "clash", None) for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: r for r in tc.token_counts(docs, chunk_bytes=chunk, overlap_bytes=overlap, limit=20,
                                                slice_bytes=3000).collect()}
    for i, text in enumerate(texts):
        n = len(plain.encode(text or "", add_special_tokens=False).ids)
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len((text or "").encode()), n > 20), text


def test_widens_until_a_stable_position(plain):
    enc = tc.Encoder(PATH)
    text = "a b " + "x" * 700 + " tail of words" * 30
    assert tc.count_by_chunks(enc, text, 40, 4) == len(plain.encode(text).ids)


def test_empty_table_and_repeated_rows(spark):
    assert tc.token_counts(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = tc.token_counts(spark.createDataFrame([(1, "a b", "", ""), (1, "a b", "", "")], SCHEMA)).collect()
    assert [(r.doc_id, r.n_tokens) for r in rows] == [(1, 2), (1, 2)]
