"""The toxicity network and the pipeline's stages."""

import random
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from fixtures import SCHEMA, documents, sentence  # noqa: E402

import corpus_pipeline  # noqa: E402
from assetboard.llm import toxicity  # noqa: E402


def labelled(n=700, seed=3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        w = sentence(rng, rng.randint(3, 120)).split()
        toxic = int(i % 3 == 0)
        for _ in range(3 * toxic):
            w.insert(rng.randrange(len(w)), rng.choice(["vile", "rotten", "awful" + rng.choice("abcdef")]))
        out.append((i, " ".join(w), "en", "s", 1, "a", "b", "c", "d", "e", toxic))
    return out


def test_scores_separate_held_out_documents(spark):
    some = labelled()
    docs = documents(spark, [r[:10] for r in some])
    labels = spark.createDataFrame([(r[0], r[10]) for r in some], "doc_id long, toxic int")
    got = toxicity.score_toxicity(docs, labels).toPandas().merge(labels.toPandas(), on="doc_id")
    held = got[got.held_out]
    assert ((held.score >= 0.7).astype(int) == held.predicted).all() and held.score.between(0, 1).all()
    assert held[held.toxic == 1].predicted.mean() > 0.9 and held[held.toxic == 0].predicted.mean() < 0.05
    left = toxicity.drop_toxic(docs, labels)
    assert left.columns == docs.columns
    assert left.count() == (got.predicted == 0).sum()


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    net = toxicity.Network({b"aa": 1, b"bb": 2}, rng.standard_normal((3, 4)) * 0.5,
                           rng.standard_normal((toxicity.GRAM_BUCKETS, 4)) * 0.5, 3, 1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    vectors = net.vectors([b"aa", b"bb", b"ccd", b"eee"])[0].astype(np.float64)
    ids, labels = np.array([[1, 2, 3, 4, 0], [2, 2, 1, 0, 0], [4, 3, 2, 1, 3]]), np.array([1, 0, 1.0])

    def loss():
        p = toxicity.sigmoid(net.forward(net.inputs(vectors), ids))
        return -(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean()

    gradients, of_vectors = net.gradients(ids, vectors, labels)
    for value, gradient in [*((net.p[k], gradients[k]) for k in gradients), (vectors, of_vectors)]:
        at = tuple(0 for _ in value.shape)
        start = value[at]
        value[at] = start + 1e-3
        high = loss()
        value[at] = start - 1e-3
        low = loss()
        value[at] = start
        assert (high - low) / 2e-3 == pytest.approx(gradient[at], rel=0.02, abs=1e-5)


def test_windows_cover_every_word_and_overlap():
    first, size, row = toxicity.window_places(np.array([0, 1, 32, 33, 100]))
    covered = [set() for _ in range(5)]
    begin = [0, 0, 1, 33, 66]
    for f, s, r in zip(first, size, row):
        covered[r] |= set(range(f - begin[r], f - begin[r] + s))
    assert [len(c) for c in covered] == [0, 1, 32, 33, 100]


def test_odd_texts_and_missing_labels(spark):
    docs = documents(spark)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score_toxicity(docs, none).where("score <> 0").count() == 0
    one = spark.createDataFrame([(i, int(i % 2)) for i in range(60)], "doc_id long, toxic int")
    got = toxicity.score_toxicity(docs, one, rounds=1).toPandas()
    assert len(got) == docs.count() and got.score.between(0, 1).all()
    assert toxicity.score_toxicity(spark.createDataFrame([], SCHEMA), one).count() == 0


def test_pipeline_stages_keep_their_promises(spark, tmp_path):
    from test_documents import brute_components

    rng = random.Random(9)
    some = [r[:5] for r in labelled(300)]
    passage = sentence(rng, 60)
    extra = [passage + " " + sentence(rng, 30) for _ in range(3)] + [some[4][1].replace(" ", "  ", 1)] + [some[1][1]]
    some += [(1000 + i, t, "en", f"s{i % 2}", 1) for i, t in enumerate(extra)]
    docs = spark.createDataFrame(some, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(r[0], r[10]) for r in labelled(300)], "doc_id long, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    out = docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path)).cache()
        seen[name] = out.toPandas()
        if name != "packing":
            assert out.schema.simpleString() == docs.schema.simpleString()
        docs = out
    assert seen["toxicity"].doc_id.isin(range(0, 300, 3)).sum() < 10
    text = seen["line_dedup"].set_index("doc_id").text
    assert sum(passage in t for t in text) == 1
    assert (seen["line_dedup"].n_chars == seen["line_dedup"].text.str.len()).all()
    _, component = brute_components(list(zip(seen["line_dedup"].doc_id, seen["line_dedup"].text)), 5, 80)
    assert sorted(seen["near_dedup"].doc_id) == sorted(set(component.values()))
    assert set(seen["packing"].doc_id) == set(seen["mixing"].doc_id)
    assert seen["packing"][seen["packing"].start == 0].shape[0] == len(seen["mixing"])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(seen["packing"])
