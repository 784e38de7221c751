"""Operators on vectors against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from assetboard.llm import cap_links, vector_search
from assetboard.llm.components import components

SCHEMA = "vec_id long, embedding array<float>, label int, id string, score string, vector string"


def rows():
    rng = np.random.default_rng(3)
    base = rng.standard_normal((220, 16)).astype(np.float32)
    near = (base[:8].repeat(12, axis=0) + 0.12 * rng.standard_normal((96, 16))).astype(np.float32)
    vectors = [*base, *near, *base[:5], *(2 * base[:3])]
    out = [(i, v.tolist(), None if i % 11 == 0 else i % 12 % 2 if i >= 220 else i % 3 % 2, "x", "y", "z")
           for i, v in enumerate(vectors)]
    odd = [None, [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [1.0, 2.0], [], [None] + [1.0] * 15]
    return out + [(1000 + i, v, 1, "x", "y", "z") for i, v in enumerate(odd)] + [out[7]]


def usable(v):
    return v is not None and len(v) == 16 and all(x is not None and np.isfinite(x) for x in v) and any(v)


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame(rows(), SCHEMA).cache()


def test_search_finds_nearest_in_order(vectors):
    got = vector_search.search(vectors, F.col("vec_id") % 5 == 0, k=5, leaf_sample=10, block=32, recall=0.95).toPandas()
    good = {r[0]: np.array(r[1], float) for r in rows() if usable(r[1])}
    ids = np.array(sorted(good))
    x = np.stack([good[i] for i in ids])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    found = total = 0
    for q in ids[ids % 5 == 0]:
        score = x @ x[np.searchsorted(ids, q)]
        score[ids == q] = -9
        best = ids[np.lexsort((ids, -score.round(12)))[:5]]
        own = got[got.query_id == q].sort_values("rank")
        assert list(own["rank"]) == [1, 2, 3, 4, 5] and q not in set(own.vec_id)
        for r in own.itertuples():
            assert r.score == pytest.approx(score[np.searchsorted(ids, r.vec_id)], abs=1e-12)
        assert (np.diff(own.score) <= 0).all()
        found, total = found + len(set(best) & set(own.vec_id)), total + 5
    assert found / total >= 0.9
    assert set(got.query_id) == set(ids[ids % 5 == 0].tolist())


def test_fewer_rows_than_neighbours(spark):
    some = spark.createDataFrame([(0, [1.0, 0.0]), (5, [1.0, 0.0]), (7, [0.0, 1.0])], "vec_id long, embedding array<float>")
    got = vector_search.search(some, F.col("vec_id") % 5 == 0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in got) == [
        (0, 1, 5, 1.0), (0, 2, 7, 0.0), (5, 1, 0, 1.0), (5, 2, 7, 0.0)]


def test_visits_are_widened_to_every_leaf_when_needed():
    rng = np.random.default_rng(1)
    tree = vector_search.Tree(vector_search.unit(rng.standard_normal((400, 8))), 4, 10)
    q = vector_search.unit(rng.standard_normal((1, 8)))[0]
    assert sorted(tree.visits(q, tree.leaves)) == list(range(tree.leaves))
    assert tree.visits(q, 3) == tree.visits(q, tree.leaves)[:3]
    ones = np.ones(tree.leaves, np.int64)
    assert tree.visits(q, 3, ones, 6) == tree.visits(q, tree.leaves)[:6]  # goes on until enough rows were met


@pytest.mark.parametrize("block", [512, 6])
def test_cap_links_equal_brute_force(vectors, block):
    got = cap_links.cap_links(vectors, 0.95, tables=4, words=16, cap=1.6, block=block).toPandas()
    some = rows()
    links, name = [0] * len(some), list(range(len(some)))

    def find(x):
        while name[x] != x:
            x = name[x]
        return x

    for i, a in enumerate(some):
        for j, b in enumerate(some):
            if i != j and a[2] is not None and a[2] == b[2] and usable(a[1]) and usable(b[1]):
                u, v = np.array(a[1], float), np.array(b[1], float)
                if u @ v / np.linalg.norm(u) / np.linalg.norm(v) >= 0.95:
                    links[i] += 1
                    p, q = find(i), find(j)
                    name[max(p, q, key=lambda k: some[k][0])] = min(p, q, key=lambda k: some[k][0])
    expected = sorted((r[0], links[i], some[find(i)][0]) for i, r in enumerate(some))
    assert sorted(zip(got.vec_id, got.n_links, got.component_id)) == expected
    assert (got.kept == (got.vec_id == got.component_id)).all()


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert vector_search.search(none, F.col("vec_id") % 5 == 0).count() == 0
    assert cap_links.cap_links(none).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(159, 7)] + [(300, 301), (302, 301)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in [*range(41), *range(100, 160)]}, 300: 300, 301: 300, 302: 300}
