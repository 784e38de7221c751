import random
import re
from collections import Counter

import pytest

import fixtures
import oracle
from assetboard.llm import collocations, queries

SCHEMA = "lang string, text string, phrase string, n string, words string, rank string"


def plain_collocations(rows, longest=3, least=10, share=50, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", fixtures.fold(text)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    f[lang, tuple(words[i: i + m])] += 1
    cands = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    covered = set()
    for (lang, words), a in cands.items():
        for m in range(2, len(words)):
            for i in range(len(words) - m + 1):
                if 100 * a >= share * f[lang, words[i: i + m]]:
                    covered.add((lang, words[i: i + m]))
    out = []
    for lang in n:
        best = []
        for (of, words), a in cands.items():
            if of == lang and (of, words) not in covered:
                score, k = min((1_000_000 * a * a // (f[of, words[:k]] * f[of, words[k:]]), k) for k in range(1, len(words)))
                best.append((score, a, " ".join(words), f[of, words[:k]], f[of, words[k:]]))
        best.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, i + 1, p, a, le, r, n[lang], s) for i, (s, a, p, le, r) in enumerate(best[:top])]
    return sorted(out)


def odd_rows(seed=4):
    rng = random.Random(seed)
    pool = ["New", "york", "éa", "of", "the", "x" * 300, "字", "a_b", "the\x1cof", "ÀB"] + [f"r{i}" for i in range(300)]
    rows = []
    for i in range(150):
        words = rng.choices(pool, weights=[30] * 10 + [1] * 300, k=rng.randint(0, 60))
        rows.append((rng.choice(["en", "fr", None, "und", ""]), "".join(w + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n"]) for w in words)))
    return rows + [("en", None), (None, ""), ("en", "solo"), ("de", "no pair here often"), rows[0], rows[0]]


@pytest.mark.parametrize("longest,least,share,top", [(3, 10, 50, 2000), (2, 3, 50, 7), (4, 2, 90, 50)])
def test_equals_plain_counts(spark, longest, least, share, top):
    rows = odd_rows()
    docs = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], SCHEMA)
    got = collocations.collocations(docs, longest, least, share, top).collect()
    assert sorted(map(tuple, got)) == plain_collocations(rows, longest, least, share, top)


def test_words_beyond_the_common_ones_and_full_filters(spark, monkeypatch):
    monkeypatch.setattr(collocations, "COMMON", 3)
    monkeypatch.setattr(collocations, "SLICE_BYTES", 500)
    monkeypatch.setattr(collocations, "bloom_of_hashes", lambda *a: __import__("numpy").full(8, 0xFFFFFFFF, "uint32"))
    rows = odd_rows(9)
    docs = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], SCHEMA)
    got = collocations.collocations(docs).collect()
    assert sorted(map(tuple, got)) == plain_collocations(rows)


def test_hashes_that_two_words_share_are_made_anew(spark, monkeypatch):
    true = collocations.hashed
    monkeypatch.setattr(collocations, "hashed", lambda words, lang, seed: true(words, lang, seed) % (7 if seed == 0 else 1 << 63))
    docs = spark.createDataFrame([("en", "a b c d e f g h i")], "lang string, text string")
    words, seed = collocations.word_table(docs)
    assert seed == 1 and words.count() == 9


def test_counts_beyond_64_bits_of_product(spark):
    a = 5_000_000_000_000
    phrases = spark.createDataFrame([(b"ab", [b"a", b"b"], 2, a), (b"a", [b"a"], 1, a + 1), (b"b", [b"b"], 1, a + 3)],
                                    "phrase binary, words array<binary>, size int, n long")
    assert [r.score for r in collocations.score_phrases(phrases, 3).collect()] == [1_000_000 * a * a // ((a + 1) * (a + 3))]


def test_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    for name in ("op11_warc", "op13_collocations"):
        assert oracle.compare(queries.QUERIES[name](spark, folder), oracle.connect(folder), queries.ORACLES[name]) == []


def test_empty_table(spark):
    assert collocations.collocations(spark.createDataFrame([], SCHEMA)).collect() == []
