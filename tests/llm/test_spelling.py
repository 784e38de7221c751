import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import fixtures
from assetboard.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
SCHEMA = "doc_id long, text string, word string, n string, key string"


def distance_one(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(rows, modulus=97, least_length=5, least_count=3):
    counts = Counter()
    for identity, text in rows:
        for run in RUN.findall(text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if identity is None else identity}:{run}".encode())
            if h % modulus == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= least_length and c >= least_count}
    near = {w: [v for v in n if distance_one(w, v)] for w in n}
    form = {}
    for w, some in near.items():
        best = min(some, key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= 2 * n[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n}


def odd_rows(seed=1):
    rng = random.Random(seed)
    base = ["straße", "colour", "aaaaa", "aaaaaa", "abcabc", "éclairs", "ÀÉÎÕÜ", "x" * 90, "zzzzz" * 300]
    words = list(base)
    for w in base[:7] * 6:
        i = rng.randrange(len(w))
        words.append(rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice("abéz") + w[i:], w[:i] + rng.choice("abéz") + w[i + 1:]]))
    words += ["x" * 91, "zzzzz" * 300 + "z"]
    rows = [(i, " ".join(w if rng.random() < .8 else w.upper() for w in rng.choices(words, weights=range(len(words), 0, -1), k=60)))
            for i in range(40)]
    return rows + [(40, None), (41, ""), (None, "colour colour Colour"), (None, "12 x×÷y_z—colours"), rows[3], rows[3]]


@pytest.mark.parametrize("modulus,symbols", [(97, 4), (2, 2), (5, 8)])
def test_equals_all_pairs(spark, modulus, symbols):
    rows = odd_rows()
    docs = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA)
    got = spelling.spelling_variants(docs, symbols=symbols, drop_modulus=modulus).collect()
    want = plain_variants(rows, modulus)
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert sum(r.form is not None for r in got) > 5


def test_documents_of_the_other_operators(spark):
    got = spelling.spelling_variants(fixtures.documents(spark)).collect()
    assert {tuple(r) for r in got} == plain_variants([r[:2] for r in fixtures.rows()])


def test_chains_are_followed_to_the_last(spark):
    names = ["w%05d" % i for i in range(40)]
    forms = spark.createDataFrame(list(zip(names, names[1:])), "word string, form string")
    assert {r.word: r.root for r in spelling.roots(forms).collect()} == dict.fromkeys(names[:-1], names[-1])


def test_checksums_put_together():
    rng = random.Random(2)
    words = [bytes(rng.randrange(97, 123) for _ in range(rng.choice([1, 5, 63, 64, 65, 400]))) for _ in range(50)]
    prefixes = [f"{i}:".encode() for i in (0, -5, 10 ** 15)]
    at, rows = np.arange(150) // 3, np.arange(150) % 3
    assert spelling.checksums(prefixes, words, at, rows).tolist() == [zlib.crc32(prefixes[r] + words[a]) for a, r in zip(at, rows)]


def test_empty_table(spark):
    assert spelling.spelling_variants(spark.createDataFrame([], SCHEMA)).collect() == []


def test_no_side_of_a_join_is_sized_by_a_guess(spark):
    words = spark.createDataFrame([(w, 5) for w in ("colour", "colours", "honour")], "word string, n long")
    near = spelling.near_words(words)
    assert "Broadcast" not in near._jdf.queryExecution().executedPlan().toString()
    assert {(r.word, r.near) for r in near.collect()} == {("colour", "colours"), ("colours", "colour")}
    found = spelling.spelling_variants(spark.createDataFrame([(1, "colour colours " * 6 + "colour " * 9)], "doc_id long, text string"))
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString() and found.count() == 2
