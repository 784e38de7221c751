"""Operators on documents against brute force, on nulls, empty and very long texts, ties and repeated rows."""

import collections
import math
import sys
import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
from fixtures import CLASH, SCHEMA, documents, rows, words  # noqa: E402

from assetboard.llm import line_dedup, mixing, near_dedup, packing, sharding, suffix_lm  # noqa: E402


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


# --- 3 -------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("frequent", [1 << 18, 20])
def test_suffix_lm_base_equals_brute_force(docs, frequent):
    got = suffix_lm.score_documents(docs, depth=3, frequent=frequent).collect()
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    counts = collections.Counter()
    for r in rows():
        if not held(r[0]):
            counts.update([*words(r[1]), None])
    n, v = sum(counts.values()), len(counts)
    text = {r[0]: r[1] for r in rows()}
    assert len(got) == len(rows())
    for r in got:
        tokens = [*words(text[r.doc_id]), None]
        assert r.held_out == held(r.doc_id)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(counts[t] > 0 for t in tokens), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens))
        assert -math.inf < r.score < 0


def test_suffix_tree_probabilities_sum_to_one_and_follow_the_longest_suffix(docs):
    import numpy as np
    import pyarrow as pa

    stream = suffix_lm.code_points(pa.array([r[1] for r in rows()], pa.large_string()))
    assert bytes(stream[:3].astype(np.uint8)).decode() == rows()[0][1][:3]
    symbols = np.full(suffix_lm.CODE_POINTS, suffix_lm.OTHER, np.uint8)
    symbols[10], symbols[32] = suffix_lm.END, suffix_lm.SPACE
    symbols[[ord(c) for c in "abcd0123"]] = np.arange(4, 12)
    coded = symbols[stream]
    codes, n = np.unique(suffix_lm.context_codes(coded, 2), return_counts=True)
    level, code, count = [], [], []
    for k in range(3):
        own = codes if k == 0 else codes[(codes >> (7 * k)) & 127 > 0]
        m = n if k == 0 else n[(codes >> (7 * k)) & 127 > 0]
        u, w = np.unique(own & ((1 << (7 * (k + 1))) - 1), return_inverse=True)
        level.append(np.full(len(u), k)), code.append(u), count.append(np.bincount(w, m).astype(int))
    tree = suffix_lm.Tree(*(np.concatenate(x) for x in (level, code, count)), 2, 4.0, 1)
    table = 10.0 ** tree.log.reshape(-1, tree.width)[:, 1:].astype(float)
    assert np.allclose(table.sum(axis=1), 1, atol=1e-5)
    scores = tree.score(coded, lane=64)
    for at in np.random.default_rng(0).integers(2, len(coded), 60):
        past = [] if coded[at - 1] == 1 else [coded[at - 2]]
        past = [*past, coded[at - 1]]
        state = next(s for s in ((1 << (7 * len(p))) | sum(int(x) << (7 * (len(p) - 1 - j)) for j, x in enumerate(p))
                                 for p in (past, past[1:], [])) if s in tree.states)
        row = np.searchsorted(tree.states, state)
        assert scores[at] == pytest.approx(tree.log.reshape(-1, tree.width)[row, coded[at]], abs=1e-5)


def brute_tree(texts, symbols, depth, least_count, divergence):
    """(level, code, n) of the root and of the contexts that stay, context by context."""
    import numpy as np
    import pyarrow as pa

    count = [collections.defaultdict(collections.Counter) for _ in range(depth + 1)]
    for t in texts:
        own = [suffix_lm.END, *symbols[suffix_lm.code_points(pa.array([t or ""], pa.large_string()))].tolist()]
        for i in range(1, len(own)):
            for k in range(min(depth, i) + 1):
                if suffix_lm.END not in own[i - k + 1: i]:  # an end may only be the oldest symbol
                    count[k][tuple(own[i - k: i])][own[i]] += 1
    out = []
    for k, level in enumerate(count):
        for past, following in level.items():
            total = sum(following.values())
            if k:
                short = count[k - 1][past[1:]]
                short_total = sum(short.values())
                gain = sum(n * math.log(n * short_total / (total * short[s])) for s, n in following.items())
            if k == 0 or total >= least_count and 2 * gain > divergence * len(following):
                code = sum(int(x) << (7 * (k - j)) for j, x in enumerate(past))
                out += [(k, code | int(s), n) for s, n in following.items()]
    return (np.array(x) for x in zip(*out))


@pytest.mark.parametrize("frequent_contexts", [1 << 21, 50])
def test_suffix_tree_scores_equal_brute_force_and_the_automaton(spark, docs, frequent_contexts):
    import numpy as np
    import pyarrow as pa

    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    train = docs.where(~suffix_lm.held_out("doc_id"))
    symbols = suffix_lm.symbol_table(suffix_lm.count_words_and_characters(train))
    level, code, n = brute_tree([r[1] for r in rows() if not held(r[0])], symbols, 4, 8, 2.0)
    tree = suffix_lm.Tree(level, code, n, 4, 40.0, suffix_lm.CODE_POINTS - int((symbols != suffix_lm.OTHER).sum()))
    got = suffix_lm.score_documents(docs, depth=4, frequent_contexts=frequent_contexts).collect()
    text = {r[0]: r[1] for r in rows()}
    contexts = len(set(zip(level.tolist(), (code >> 7).tolist())))
    for r in got:
        stream = symbols[suffix_lm.code_points(pa.array([text[r.doc_id] or ""], pa.large_string()))]
        assert r.score == pytest.approx(float(tree.score(stream).astype(np.float64).sum()), rel=1e-4)
        assert r.n_states == contexts


def test_a_context_that_a_small_corpus_keeps_stays_in_a_large_one(spark):
    """A rare word among 300 times more text: its contexts occur 20 times in both, below 4e-6 of the larger one."""
    import random

    rng = random.Random(3)
    rare = [(i, "zqxjk " * 4) for i in range(5)]
    filler = lambda n: [(100 + i, " ".join(rng.choice(["oak", "elm", "fir", "ash"]) for _ in range(500)))
                        for i in range(n)]
    made = []
    for some in (rare + filler(10), rare + filler(3000)):
        frame = spark.createDataFrame(some, "doc_id long, text string")
        scored = suffix_lm.score_documents(frame).where("doc_id < 5").toPandas()
        made.append(-scored["score"].sum() / scored["n_tokens"].sum())
    assert made[1] < 1.5 * made[0]


# --- 4 -------------------------------------------------------------------------------------------------

def test_shards_are_balanced_and_slots_gapless(docs):
    got = sharding.assign_shards(docs, shards=4, units_per_part=16).toPandas()
    text = {r[0]: r[1] for r in rows()}
    assert len(got) == len(rows())
    for r in got.itertuples():
        raw = (text[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.n_tokens) == (len(raw) + 1, zlib.crc32(raw), len(words(text[r.doc_id])))
    for _, shard in got.groupby("shard"):
        assert sorted(shard.slot) == list(range(len(shard)))
    sizes = got.groupby("shard")["size"].sum()
    assert sizes.max() - sizes.min() <= got["size"].max()


def test_a_hot_group_is_split(spark):
    some = spark.createDataFrame([(i, "same text here" if i % 2 else f"text {i}") for i in range(4000)], "doc_id long, text string")
    got = sharding.assign_shards(some, units_per_part=256).toPandas().merge(some.toPandas(), on="doc_id")
    assert got[got.text == "same text here"].shard.nunique() == 8
    sizes = got.groupby("shard")["size"].sum()
    assert sizes.max() < 1.05 * sizes.min()


# --- 6 -------------------------------------------------------------------------------------------------

def test_repeated_passages_leave_and_first_ones_stay(docs):
    got = line_dedup.dedup_lines(docs).toPandas()
    text = {r[0]: r[1] for r in rows()}
    spans = {r.doc_id: [(s["start"], s["length"]) for s in r.spans] for r in got.itertuples()}
    first, missed, extra = {}, 0, 0
    for i in sorted(text):
        w = words(text[i])
        repeated = set()
        for k in range(len(w) - 49):
            window = tuple(w[k: k + 50])
            repeated |= set(range(k, k + 50)) if window in first else set()
            first.setdefault(window, (i, k))
        gone = {k for a, n in spans[i] for k in range(a, a + n)} if i in spans else set(range(len(w)))
        missed, extra = missed + len(repeated - gone), extra + len(gone - repeated)
        if i in spans and i != 3:
            left = [x for k, x in enumerate(w) if k not in gone]
            assert words(got.set_index("doc_id").text[i]) == left
    assert missed == 0 and extra <= 60  # runs of different firsts may join to fifty words
    assert set(docs.columns) < set(got.columns)
    assert got.set_index("doc_id").text[63 + 0] is not None


@pytest.mark.parametrize("between", [False, True])
def test_a_passage_leaves_whose_fingerprints_a_short_quote_holds_first(spark, between):
    """B and C share 56 words; every fingerprint of C in them lies in a sentence that A, and maybe D, quote too."""
    import random

    import numpy as np

    def hashes(own):
        from assetboard.llm.suffix_lm import word_hashes
        import pyarrow as pa

        h, at, _ = word_hashes(pa.array([" ".join(own)], pa.large_string()))
        return line_dedup.line_hashes(h.view(np.uint64)[at], 24, line_dedup.powers(line_dedup._BASE, 4096),
                                      line_dedup.powers(line_dedup._INVERSE, 4096))

    rng, tried = random.Random(7), 0
    new = lambda n: [f"w{rng.randrange(10 ** 9)}" for _ in range(n)]
    while True:
        tried += 1
        assert tried < 5000
        passage, left, right = new(56), new(60), new(60)
        marks = line_dedup.fingerprints(hashes(left + passage + right), 27) - 60
        inside = [m for m in marks if 0 <= m <= 32]
        if inside and min(inside) >= 10 and max(inside) + 24 <= 45:
            break
    quote = passage[10:45]
    texts = {0: new(60) + quote + new(60), 1: new(60) + passage + new(60), 3: left + passage + right}
    if between:
        texts[2] = new(60) + quote + new(60)
    some = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string")
    got = {r.doc_id: [(s.start, s.length) for s in r.spans] for r in line_dedup.dedup_lines(some).collect()}
    assert got == {i: [(60, 56)] if i == 3 else [] for i in texts}


def test_exactly_the_words_of_repeated_passages_leave(docs):
    got = {r.doc_id: {k for s in r.spans for k in range(s.start, s.start + s.length)}
           for r in line_dedup.dedup_lines(docs).collect()}
    first = {}
    for i, t in sorted((r[0], r[1]) for r in {r[0]: r for r in rows()}.values()):
        w, repeated = words(t), set()
        for k in range(len(w) - 49):
            if first.setdefault(tuple(w[k: k + 50]), (i, k)) != (i, k):
                repeated |= set(range(k, k + 50))
        assert got.get(i, set(range(len(w)))) == repeated


def test_winnowing_finds_every_shared_run_of_fifty_words():
    import numpy as np

    rng = np.random.default_rng(2)
    for _ in range(40):
        shared = rng.integers(1, 1 << 62, 50).astype(np.uint64)
        marks = []
        for _ in range(2):
            before = rng.integers(1, 1 << 62, rng.integers(0, 60)).astype(np.uint64)
            w = np.concatenate([before, shared, rng.integers(1, 1 << 62, rng.integers(0, 60)).astype(np.uint64)])
            h = line_dedup.line_hashes(w, 24, line_dedup.powers(line_dedup._BASE, 4096),
                                       line_dedup.powers(line_dedup._INVERSE, 4096))
            marks.append(set(h[line_dedup.fingerprints(h, 27)].tolist()))
        assert marks[0] & marks[1]


def test_copies_cost_no_row_for_each_word(spark, monkeypatch):
    """Inside copies fingerprints have equal surroundings; only around an edit are passages hashed one by one."""
    import random

    rng, landed = random.Random(5), {}
    text = [f"w{rng.randrange(10 ** 9)}" for _ in range(3000)]
    edited = [*text[:1500], "edited", *text[1501:]]
    land = line_dedup.land
    monkeypatch.setattr(line_dedup, "land", lambda df, label: landed.setdefault(label, land(df, label)))
    for last, most in ((text, 0), (edited, 1000)):
        landed.clear()
        some = spark.createDataFrame([(i, " ".join(text)) for i in range(20)] + [(20, " ".join(last))], "doc_id long, text string")
        got = {r.doc_id: [(s.start, s.length) for s in r.spans] for r in line_dedup.dedup_lines(some).collect()}
        assert got == ({0: []} if last is text else {0: [], 20: [(0, 1500), (1501, 1499)]})
        assert landed["passages"].count() <= most


@pytest.mark.parametrize("line_words, window, least_words", [(4, 5, 8), (4, 5, 11), (6, 2, 7)])
def test_pieces_of_common_texts_in_any_order_equal_brute_force(spark, line_words, window, least_words):
    import random

    rng = random.Random(least_words)
    pool = [[f"w{rng.randrange(10 ** 6)}" for _ in range(rng.randint(3, 30))] for _ in range(12)] + [["x"] * 15]
    texts = [[w for p in rng.choices(pool, k=rng.randint(0, 6)) for w in p[rng.randint(0, 3): len(p) - rng.randint(0, 3)]]
             for _ in range(150)]
    some = [(i - 1 if i else None, " ".join(w)) for i, w in enumerate(texts)]
    got = line_dedup.dedup_lines(spark.createDataFrame(some + some[:5] * 3, "doc_id long, text string").repartition(5),
                                 line_words, window, least_words).collect()
    spans = {r.doc_id: {k for s in r.spans for k in range(s.start, s.start + s.length)} for r in got}
    first, n_left = {}, 0
    for (i, _), w in zip(some, texts):
        gone = set()
        for k in range(len(w) - least_words + 1):
            if first.setdefault(tuple(w[k: k + least_words]), (i, k)) != (i, k):
                gone |= set(range(k, k + least_words))
        assert spans.get(i, set(range(len(w)))) == gone
        n_left += len(w) > len(gone) or not w
    assert len(spans) == n_left


def test_word_hashes_are_those_of_xxhash():
    import random

    import pyarrow as pa
    import xxhash

    rng = random.Random(4)
    some = pa.array([bytes(rng.randrange(256) for _ in range(n % 70)) for n in range(700)], pa.large_binary())
    for own in (some, some.slice(33, 500), some.slice(3, 0)):
        assert suffix_lm.xxh64(own).tolist() == [xxhash.xxh64_intdigest(w.as_py()) for w in own]


def test_filter_bits_do_not_reach_the_driver_as_rows(spark):
    """Half a million words of bits: as rows they took over 100 MB of the driver's Python."""
    import tracemalloc

    import numpy as np

    from assetboard.llm.common import bloom, bloom_of_hashes, in_bits

    values = spark.range(3_000_000).select("id", F.xxhash64("id").alias("hash"))
    made = []
    tracemalloc.start()
    try:
        made = [bloom(values, "id"), bloom_of_hashes(values, "hash")]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert np.array_equal(*made) and peak < 50e6
    hashes = values.limit(1000).select("hash").toPandas()["hash"].to_numpy()
    assert in_bits(hashes, made[1]).all() and not in_bits(hashes + 1, made[1]).all()


# --- 7 -------------------------------------------------------------------------------------------------

def test_pieces_hold_all_ids_once_within_the_limits(docs):
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = packing.pack_documents(docs, length=512, most_segments=6).toPandas() if False else packing.pack(
        packing.pieces_of(docs, length=512), length=512, most_segments=6, pieces_per_part=32).toPandas()
    text = {r[0]: r[1] for r in rows()}
    for i, own in got.groupby("doc_id"):
        ids = np.array([*plain.encode(text[i] or "", add_special_tokens=False).ids, 2], "<u4")
        pieces = own.drop_duplicates("start").sort_values("start")
        assert pieces.length.sum() == len(ids) == own.doc_tokens.iloc[0]
        for p in pieces.itertuples():
            assert p.ids_crc32 == zlib.crc32(ids[p.start: p.start + p.length])
    assert len(got[got.doc_id == 3]) == 3 * (got[got.doc_id == 3].start.nunique())
    for _, sequence in got.groupby("sequence_id"):
        sequence = sequence.sort_values("offset")
        assert list(sequence.offset) == [0, *sequence.length.cumsum()[:-1]]
        assert sequence.length.sum() <= 512 and len(sequence) <= 6
    assert sorted(got.sequence_id.unique()) == list(range(got.sequence_id.nunique()))


def test_no_sequence_is_over_a_limit_on_loss_bearing_tokens(docs):
    got = packing.pack_documents(docs, length=512, most_loss=100).toPandas()
    loss = (got.length - 1).groupby(got.sequence_id).sum()
    assert loss.max() <= 100 and got.groupby("sequence_id").length.sum().max() <= 512
    pieces = got.drop_duplicates(["doc_id", "start"])
    assert (pieces.groupby("doc_id").length.sum() == pieces.groupby("doc_id").doc_tokens.first()).all()


def test_fill_respects_every_limit():
    import numpy as np

    rng = np.random.default_rng(4)
    demand = np.stack([rng.integers(1, 90, 300), np.ones(300, int), rng.integers(0, 40, 300)], axis=1)
    limits = np.array([100, 5, 60])
    bins, offsets = packing.fill(demand, limits)
    for b in np.unique(bins):
        own = np.flatnonzero(bins == b)
        assert (demand[own].sum(axis=0) <= limits).all()
        own = own[np.argsort(offsets[own])]
        assert list(offsets[own]) == [0, *np.cumsum(demand[own, 0])[:-1]]


# --- 8 -------------------------------------------------------------------------------------------------

def brute_targets(sizes, most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    target, open_, rest = {}, set(names), sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if rest * weight[s] / total > most * sizes[s]}
        if not over:
            return target | {s: rest * weight[s] / total for s in open_}
        target |= {s: float(most * sizes[s]) for s in over}
        rest -= sum(most * sizes[s] for s in over)
        open_ -= over
    return target


def test_mix_meets_targets_and_repeats_no_text_too_often(docs):
    sized, schedule = mixing.mix(docs, block_tokens=8)
    got = mixing.taken_words(sized, schedule).toPandas()
    source, size = {r[0]: r[3] for r in rows()}, {r[0]: len(words(r[1])) for r in rows()}
    totals = collections.Counter()
    for r in rows():
        totals[source[r[0]]] += size[r[0]]
    targets = brute_targets(totals)
    taken = collections.Counter()
    for r in got.itertuples():
        assert r.size == size[r.doc_id] and r.taken <= 3 * r.size
        assert r.source_size == totals[source[r.doc_id]]
        assert r.target == pytest.approx(targets[source[r.doc_id]])
        taken[source[r.doc_id]] += r.taken
    for s, t in targets.items():
        assert abs(taken[s] - t) <= 40
    again = mixing.taken_words(*mixing.mix(docs, block_tokens=8)).toPandas()
    key = ["doc_id", "taken"]
    assert sorted(map(tuple, got[key].to_numpy())) == sorted(map(tuple, again[key].to_numpy()))


def test_targets_that_stop_share_the_excess(spark):
    sizes = {"a": 10, "b": 1000, "c": 5, "d": 400, None: 1}
    got = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(
        list(sizes.items()), "source string, source_size long")).collect()}
    assert got == pytest.approx(brute_targets(sizes))


# --- 9 -------------------------------------------------------------------------------------------------

def brute_components(some, width, similarity):
    sets = {}
    for r in some:
        w = words(r[1])
        span = min(width, len(w))
        sets[r[0]] = {tuple(w[k: k + span]) for k in range(len(w) - span + 1)} if w else set()
    name = {i: i for i in sets}

    def find(x):
        while name[x] != x:
            x = name[x]
        return x

    for i in sets:
        for j in sets:
            shared = len(sets[i] & sets[j])
            if i < j and shared and 100 * shared >= similarity * (len(sets[i]) + len(sets[j]) - shared):
                a, b = sorted((find(i), find(j)))
                name[b] = a
    return sets, {i: find(i) for i in sets}


@pytest.mark.parametrize("width,similarity", [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(docs, width, similarity):
    sets, component = brute_components(rows(), width, similarity)
    got = near_dedup.near_duplicates(docs, width=width, similarity=similarity, block=4).collect()
    assert len(got) == len(rows())
    for r in got:
        assert (r.n_shingles, r.component_id, r.kept) == (
            len(sets[r.doc_id]), component[r.doc_id], component[r.doc_id] == r.doc_id)
    left = near_dedup.drop_near_duplicates(docs, width=width, similarity=similarity)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted({i for i, c in component.items() if i == c})


def test_bands_follow_the_similarity():
    import corpus_pipeline

    assert near_dedup.banding(near_dedup.SIMILARITY / 100) == (20, 6)
    assert near_dedup.banding(corpus_pipeline.NEAR_SIMILARITY / 100) == (24, 5)
    for similarity in (0.6, 0.7, 0.8, 0.82, 0.85, 0.9):
        bands, rows = near_dedup.banding(similarity)
        assert bands * rows == 120 and near_dedup.no_band(bands, rows, similarity) <= near_dedup.NO_BAND


def test_links_through_heavily_edited_copies_in_one_bucket(spark):
    """Copies of one text with so many edits that most pairs do not link."""
    import random

    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    some = []
    for i in range(60):
        w = list(base)
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(120)] = f"e{rng.randrange(9)}"
        some.append((i, " ".join(w)))
    _, component = brute_components(some, 3, 85)
    got = near_dedup.near_duplicates(spark.createDataFrame(some, "doc_id long, text string"), block=16).collect()
    assert {r.doc_id: r.component_id for r in got} == component


def test_bayesian_test_needs_few_matches_only_for_dissimilar_pairs():
    needed = near_dedup.needed_matches(120, 24, 0.85, 1e-5)
    assert needed == sorted(needed) and 0 < needed[0] < 24 and needed[-1] < 0.85 * 120


# --- all -----------------------------------------------------------------------------------------------

def test_empty_tables(none):
    assert suffix_lm.score_documents(none).count() == 0
    assert sharding.assign_shards(none).count() == 0
    assert line_dedup.dedup_lines(none).count() == 0
    assert packing.pack_documents(none).count() == 0
    assert mixing.taken_words(*mixing.mix(none)).count() == 0
    assert near_dedup.near_duplicates(none).count() == 0


def test_null_ids(spark):
    some = spark.createDataFrame([(None, "a b c d e"), (None, "a b c d e"), (4, "a b c d e"), (None, None)],
                                 "doc_id long, text string").withColumn("source", F.lit("s"))
    assert suffix_lm.score_documents(some).count() == 4
    assert sharding.assign_shards(some).count() == 4
    assert line_dedup.dedup_lines(some).count() == 4
    assert packing.pack_documents(some).count() == 4
    assert mixing.taken_words(*mixing.mix(some)).count() == 4
    got = near_dedup.near_duplicates(some).collect()
    assert sorted((r.component_id or 0, r.kept) for r in got) == [(0, True), (4, False), (4, False), (4, True)]


# --- small sources, whole groups, clashing names ----------------------------------------------------------

def test_sources_smaller_than_a_block_come_near_their_targets(spark):
    rows = [(i, "w " * 10, "en", "a big one", 20, *CLASH) for i in range(1000)]
    rows += [(2000 + n, "w " * n, "en", f"small {n}", 2 * n, *CLASH) for n in (10, 30, 65)]
    got = mixing.taken_words(*mixing.mix(documents(spark, rows))).toPandas()
    for n in (10, 30, 65):
        row = got[got["doc_id"] == 2000 + n].iloc[0]
        assert row["target"] == 3 * n and abs(row["taken"] - row["target"]) <= min(n, mixing.BLOCK_TOKENS), n
    big = got[got["doc_id"] < 1000]
    assert abs(big["taken"].sum() - big["target"].iloc[0]) <= 2 * mixing.BLOCK_TOKENS


def test_equal_texts_stay_in_one_shard_below_a_share_of_it(spark):
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 100 == 0, F.lit("copied text")).otherwise(
            F.concat(F.lit("text "), "id", F.repeat(F.lit(" x"), (F.col("id") % 7).cast("int")))).alias("text"))
    got = sharding.assign_shards(docs).withColumn("copied", F.col("doc_id") % 100 == 0).toPandas()
    assert got[got["copied"]]["shard"].nunique() == 1
    sizes = got.groupby("shard")["size"].sum()
    assert len(sizes) == 8 and sizes.max() < 1.02 * sizes.mean()


def test_names_of_helper_columns_survive(spark):
    names = ["_key", "_copies", "_copy", "_rows", "_kept", "_starts"]
    docs = documents(spark).select("*", *[F.concat(F.lit(n), "doc_id").alias(n) for n in names])
    for out in (line_dedup.dedup_lines(docs, report=False), near_dedup.drop_near_duplicates(docs), mixing.mix_documents(docs)):
        assert out.columns == docs.columns
        assert out.where(" or ".join(f"`{n}` <> concat('{n}', doc_id)" for n in names)).isEmpty() and not out.isEmpty()
