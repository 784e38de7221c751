"""The packing encoder keeps the ids of parts in a table of fixed size, and every id stays that of the tokenizer."""

import sys
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from fixtures import texts  # noqa: E402

from assetboard.llm import packing  # noqa: E402


def numbered(start, n):
    """A text of ``n`` distinct words."""
    return " ".join(f"w{start + i}" for i in range(n))


def test_an_encoder_does_not_grow_with_the_words_it_met():
    enc = packing.IdEncoder(packing.default_tokenizer())
    tracemalloc.start()
    try:
        enc.encode(pa.array([numbered(0, 5000)]))
        before = tracemalloc.get_traced_memory()[0]
        for k in range(1, 25):
            enc.encode(pa.array([numbered(5000 * k, 5000)]))
        grown = tracemalloc.get_traced_memory()[0] - before
    finally:
        tracemalloc.stop()
    assert grown < 2_000_000


@pytest.mark.parametrize("slots", [None, 1, 7])
def test_ids_are_those_of_the_tokenizer_whatever_the_table_forgets(slots):
    enc = packing.IdEncoder(packing.default_tokenizer(), **({} if slots is None else {"slots": slots}))
    some = texts() + ["a", "a\x00", "a\x00 a", "a" * 31 + " " + "a" * 32 + " " + "a" * 33, "été مرحبا " * 3,
                      "1234567 12345678 123456789", "​  x", "<|endoftext|> x<|endoftext|>"]
    for _ in range(2):  # the second time from the table, as far as it goes
        ids, counts = enc.encode(pa.array(some))
        expected = [enc.tokenizer.encode(t or "", add_special_tokens=False).ids for t in some]
        assert counts.tolist() == [len(e) for e in expected]
        assert ids.tolist() == [i for e in expected for i in e]
    assert enc.encode(pa.array([], pa.string()))[0].tolist() == []
    assert np.asarray(enc.encode(pa.array(["", None]))[1]).tolist() == [0, 0]
