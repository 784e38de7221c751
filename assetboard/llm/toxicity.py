"""Toxicity by a bidirectional gated recurrent network with attention pooling, over word and character inputs.

A word's vector is its own embedding (words seen in several sampled documents) plus the mean of its hashed
character n-grams (3 to 5 bytes with word edges). A window of ``window`` words runs through two gated
recurrent layers, one per direction; attention over their states gives one logit. Windows start every
``stride`` words, so they overlap and cover the whole text; a document's logit is its highest, and a
logistic curve fitted on documents turns it into the score. Training is multiple-instance: each round, a
document teaches through its highest window, and a clean one through a random window as well. The n-gram
and word embeddings start from the log odds of their documents.

The network is trained in numpy on a bounded sample: about ``sample_docs`` documents of each label, from
the rows whose crc32(id) mod 3 is not 1. Everything else reads all rows. Only the text is an input.

Null and empty texts have one window of no words and a score like others. Null ids, repeated rows and
extra columns are kept out of the score. Without documents of both labels every score is 0. An empty table
gives an empty result. Labels other than 0 and 1 are ignored; of several for an id, the highest counts.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetboard.llm.common import bounds_at, claim, give_back, is_gap, slices, utf8_buffer

WINDOW, STRIDE = 32, 16
GRAMS = (3, 4, 5)
GRAM_BUCKETS = 1 << 16
SAMPLE_DOCS = 800
SLICE_BYTES = 1_000_000
CACHE_WORDS = 50_000
THRESHOLD = 0.7
_EDGES = ".,;:!?\"'()[]{}"


def held_out(id_column: str) -> Column:
    text = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    return F.crc32(F.encode(text, "UTF-8")) % 3 == 1


def split_words(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct raw words, the word at each place, and places per row."""
    raw, starts = utf8_buffer(texts)
    if not len(raw):
        return [], np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    gap = is_gap(raw)
    bounds = bounds_at(len(raw), starts, np.flatnonzero(gap[1:] != gap[:-1]) + 1)
    runs = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(raw)])
    is_word = ~gap[bounds[:-1]]
    words = runs.filter(pa.array(is_word)).dictionary_encode()
    rows = np.searchsorted(starts, bounds[:-1][is_word], side="right") - 1
    return words.dictionary.to_pylist(), np.asarray(words.indices), np.bincount(rows, minlength=len(texts))


def plain(word: bytes) -> bytes:
    return word.decode("utf-8", "replace").lower().strip(_EDGES).encode()


def gram_buckets(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of every word's n-grams, one word after the other, and their number per word."""
    marked = b"".join(b"\x01" + w + b"\x02" for w in words)
    raw = np.frombuffer(marked, np.uint8).astype(np.uint32)
    sizes = np.array([len(w) + 2 for w in words], np.int64)
    stops = np.cumsum(sizes)
    room = np.repeat(stops, sizes) - np.arange(len(raw))  # bytes up to the word's end
    place, bucket = [], []
    for n in GRAMS:
        at = np.flatnonzero(room >= n)
        code = np.full(len(at), n, np.uint32)
        for k in range(n):
            code = (code ^ raw[at + k]) * np.uint32(16777619)
        bucket.append(((code ^ (code >> np.uint32(15))) & np.uint32(GRAM_BUCKETS - 1)).astype(np.int64))
        place.append(at)
    place, bucket = np.concatenate(place), np.concatenate(bucket).astype(np.int64)
    word = np.searchsorted(stops, place, side="right")
    order = np.argsort(word, kind="stable")
    return bucket[order], np.bincount(word, minlength=len(words))


def window_places(per_row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First place of every window, words in it, and the row it belongs to; each row has one at least."""
    count = np.maximum(1, -(-(per_row - WINDOW) // STRIDE) + 1)
    row = np.repeat(np.arange(len(per_row)), count)
    inside = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    first = (np.cumsum(per_row) - per_row)[row] + inside * STRIDE
    return first, np.minimum(per_row[row] - inside * STRIDE, WINDOW), row


def window_ids(places: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Word numbers (from 1) of every window, 0 where it has no word."""
    steps = np.arange(WINDOW)
    at = np.minimum(first[:, None] + steps, max(len(places) - 1, 0))
    numbers = places[at] + 1 if len(places) else np.zeros(at.shape, np.int64)
    return np.where(steps < size[:, None], numbers, 0).astype(np.int32)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Parameters, a forward pass over windows, and the gradients of a pass."""

    def __init__(self, vocabulary: dict[bytes, int], words: np.ndarray, grams: np.ndarray, hidden: int, seed: int):
        rng = np.random.default_rng(seed)
        d, h = words.shape[1], hidden
        draw = lambda *s: (rng.standard_normal(s) / np.sqrt(s[-2])).astype(np.float32)
        self.vocabulary, self.hidden = vocabulary, h
        self.p = {
            "words": words.astype(np.float32), "grams": grams.astype(np.float32), "wx": draw(2, d, 3 * h),
            "bx": np.zeros((2, 3 * h), np.float32), "u": draw(2, h, 3 * h), "v": draw(2 * h, 1)[:, 0],
            "w": draw(2 * h, 1)[:, 0], "b": np.zeros(1, np.float32),
        }
        self.curve = (1.0, 0.0)

    def vectors(self, words: list[bytes]):
        """Vector of each word, with the number in the vocabulary and the n-grams it comes from."""
        plains = [plain(w) for w in words]
        own = np.fromiter((self.vocabulary.get(w, 0) for w in plains), np.int64, len(words))
        buckets, per_word = gram_buckets(plains)
        starts = np.cumsum(per_word) - per_word
        sums = np.zeros((len(words), self.p["grams"].shape[1]), np.float32)
        some = per_word > 0
        if some.any():
            sums[some] = np.add.reduceat(self.p["grams"][buckets], starts[some], axis=0)
        sums /= np.maximum(per_word, 1)[:, None].astype(np.float32)
        sums += self.p["words"][own]
        return sums, own, buckets, per_word

    def all_vectors(self, words: list[bytes], some: int = 20_000) -> np.ndarray:
        """Vectors of many words, some at a time."""
        return np.concatenate([self.vectors(words[i: i + some])[0] for i in range(0, max(len(words), 1), some)])

    def inputs(self, vectors: np.ndarray) -> np.ndarray:
        """What each word adds to the gates, by direction; number 0 is no word and leaves the state alone."""
        h = self.hidden
        out = np.zeros((2, len(vectors) + 1, 3 * h), np.float32)
        out[:, 1:] = np.matmul(vectors[None], self.p["wx"]) + self.p["bx"][:, None]
        out[:, 0, :h] = 30
        return out

    def forward(self, table: np.ndarray, ids: np.ndarray, keep: bool = False):
        """Logit of every window; ``keep`` returns what the gradients need."""
        h, (n, steps) = self.hidden, ids.shape
        u = self.p["u"]
        states = np.zeros((steps + 1, 2, n, h), np.float32)
        kept = []
        for t in range(steps):
            x = np.stack([table[0].take(ids[:, t], axis=0), table[1].take(ids[:, steps - 1 - t], axis=0)])
            a = np.matmul(states[t], u)
            gates = x[:, :, : 2 * h] + a[:, :, : 2 * h]
            np.exp(-gates, out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            z, r = gates[:, :, :h], gates[:, :, h:]
            new = np.tanh(x[:, :, 2 * h:] + r * a[:, :, 2 * h:])
            states[t + 1] = new + z * (states[t] - new)
            if keep:
                kept.append((z, r, new, a[:, :, 2 * h:]))
        both = np.concatenate([states[1:, 0], states[:0:-1, 1]], axis=2)
        attention = both @ self.p["v"]
        attention = np.where(ids.T > 0, attention, -1e4)
        attention = np.exp(attention - attention.max(axis=0))
        attention /= attention.sum(axis=0)
        pooled = (attention[:, :, None] * both).sum(axis=0)
        pooled[ids[:, 0] == 0] = 0
        logits = pooled @ self.p["w"] + self.p["b"][0]
        return (logits, states, kept, both, attention, pooled) if keep else logits

    def gradients(self, ids: np.ndarray, vectors: np.ndarray, labels: np.ndarray):
        """Gradients of the mean log loss of windows; those of the words' vectors come last."""
        h, (n, steps), p = self.hidden, ids.shape, self.p
        table = self.inputs(vectors)
        logits, states, kept, both, attention, pooled = self.forward(table, ids, keep=True)
        d_logit = ((sigmoid(logits) - labels) / n).astype(np.float32)
        g = {"b": np.array([d_logit.sum()], np.float32), "w": pooled.T @ d_logit}
        d_pooled = d_logit[:, None] * p["w"]
        d_pooled[ids[:, 0] == 0] = 0
        d_attention = (both * d_pooled).sum(axis=2)
        d_score = attention * (d_attention - (attention * d_attention).sum(axis=0))
        g["v"] = np.einsum("tnk,tn->k", both, d_score)
        d_both = attention[:, :, None] * d_pooled + d_score[:, :, None] * p["v"]
        d_state = np.zeros((2, n, h), np.float32)
        g["u"], d_table = np.zeros_like(p["u"]), np.zeros_like(table)
        for t in range(steps - 1, -1, -1):
            z, r, new, a_new = kept[t]
            d_state[0] += d_both[t, :, :h]
            d_state[1] += d_both[steps - 1 - t, :, h:]
            d_new = d_state * (1 - z) * (1 - new * new)
            d_z = d_state * (states[t] - new) * z * (1 - z)
            d_r = d_new * a_new * r * (1 - r)
            d_a = np.concatenate([d_z, d_r, d_new * r], axis=2)
            d_x = np.concatenate([d_z, d_r, d_new], axis=2)
            g["u"] += np.matmul(states[t].transpose(0, 2, 1), d_a)
            for side, at in ((0, t), (1, steps - 1 - t)):
                order = np.argsort(ids[:, at], kind="stable")
                some, first = np.unique(ids[order, at], return_index=True)
                d_table[side, some] += np.add.reduceat(d_x[side][order], first, axis=0)
            d_state = d_state * z + np.matmul(d_a, p["u"].transpose(0, 2, 1))
        d_table = d_table[:, 1:]
        g["wx"] = np.matmul(vectors.T[None], d_table)
        g["bx"] = d_table.sum(axis=1)
        return g, np.matmul(d_table, p["wx"].transpose(0, 2, 1)).sum(axis=0)


class Trainer:
    """Adam on all parameters; embeddings move where a batch touches them."""

    def __init__(self, net: Network, rate: float):
        self.net, self.rate, self.step = net, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in net.p.items()}
        self.s = {k: np.zeros_like(v) for k, v in net.p.items()}

    def move(self, name: str, gradient: np.ndarray, at=slice(None)) -> None:
        m, s, p = self.m[name], self.s[name], self.net.p[name]
        m[at] = 0.9 * m[at] + 0.1 * gradient
        s[at] = 0.99 * s[at] + 0.01 * gradient * gradient
        scale = np.sqrt(1 - 0.99 ** self.step) / (1 - 0.9 ** self.step)
        p[at] -= self.rate * scale * m[at] / (np.sqrt(s[at]) + 1e-6)

    def train(self, words: list[bytes], ids: np.ndarray, labels: np.ndarray) -> None:
        self.step += 1
        used, local = np.unique(ids, return_inverse=True)
        local = local.reshape(ids.shape)
        if used[0] != 0:
            used, local = np.concatenate([[0], used]), local + 1
        vectors, own, buckets, per_word = self.net.vectors([words[i - 1] for i in used[1:]])
        g, d_vectors = self.net.gradients(local, vectors, labels)
        for name, gradient in g.items():
            self.move(name, gradient)
        for name, rows, d in (("words", own, d_vectors), (
                "grams", buckets, np.repeat(d_vectors / np.maximum(per_word, 1)[:, None], per_word, axis=0))):
            order = np.argsort(rows, kind="stable")
            some, first = np.unique(rows[order], return_index=True)
            self.move(name, np.add.reduceat(d[order], first, axis=0), some)


def gram_log_odds(places: np.ndarray, per_row: np.ndarray, buckets: np.ndarray, per_word: np.ndarray,
                  labels: np.ndarray, most_words: int = 50_000) -> np.ndarray:
    """Smoothed log odds of n-gram buckets by the documents that hold them, some documents at a time."""
    toxic, all_of = np.zeros(GRAM_BUCKETS), np.zeros(GRAM_BUCKETS)
    starts, stops = np.cumsum(per_word) - per_word, np.cumsum(per_row)
    run = stops // most_words
    for low, high in zip(*(lambda c: ([0, *c], [*c, len(per_row)]))((np.flatnonzero(np.diff(run)) + 1).tolist())):
        words = places[stops[low] - per_row[low]: stops[high - 1]] if high > low else places[:0]
        rows = np.repeat(np.arange(low, high), per_row[low:high])
        pairs = np.unique(rows * len(per_word) + words)
        rows, words = pairs // len(per_word), pairs % len(per_word)
        repeat = per_word[words]
        at = np.repeat(starts[words] - (np.cumsum(repeat) - repeat), repeat) + np.arange(repeat.sum())
        pairs = np.unique(np.repeat(rows, repeat) * GRAM_BUCKETS + buckets[at])
        toxic += np.bincount(pairs % GRAM_BUCKETS, labels[pairs // GRAM_BUCKETS], GRAM_BUCKETS)
        all_of += np.bincount(pairs % GRAM_BUCKETS, minlength=GRAM_BUCKETS)
    n1, n0 = max(labels.sum(), 1), max(len(labels) - labels.sum(), 1)
    return np.log((toxic + 0.5) / (n1 + 1)) - np.log((all_of - toxic + 0.5) / (n0 + 1))


def log_odds(rows: np.ndarray, keys: np.ndarray, size: int, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smoothed log odds of each key by the documents that hold it, and its number of documents."""
    pairs = np.unique(rows.astype(np.int64) * size + keys)
    row, key = pairs // size, pairs % size
    toxic = np.bincount(key, labels[row], size)
    all_of = np.bincount(key, minlength=size)
    n1, n0 = max(labels.sum(), 1), max(len(labels) - labels.sum(), 1)
    return np.log((toxic + 0.5) / (n1 + 1)) - np.log((all_of - toxic + 0.5) / (n0 + 1)), all_of


def fit(texts: list[str | None], labels: list[int], width: int = 12, hidden: int = 8, rounds: int = 8,
        most_batch: int = 200, rate: float = 0.01, least_docs: int = 3, seed: int = 5) -> Network:
    """Train on a sample of documents."""
    labels = np.asarray(labels, np.float64)
    batch = min(most_batch, max(16, len(texts) // 8))  # a small sample still gets a hundred steps
    words, places, per_row = split_words(pa.array(texts, pa.large_string()))
    rng = np.random.default_rng(seed)
    row_of = np.repeat(np.arange(len(texts)), per_row)
    plains = [plain(w) for w in words]
    known = {w: i for i, w in enumerate(dict.fromkeys(plains))}
    number = np.array([known[w] for w in plains], np.int64)
    odds, docs_of = log_odds(row_of, number[places], max(len(known), 1), labels)
    chosen = [w for w, i in known.items() if docs_of[i] >= least_docs and w]
    vocabulary = {w: i + 1 for i, w in enumerate(chosen)}
    word_table = rng.standard_normal((len(chosen) + 1, width)) * 0.05
    word_table[1:, 0] += np.clip(odds[[known[w] for w in chosen]], -1, 5) / 5
    word_table[0] = 0
    buckets, per_word = gram_buckets(plains)
    gram_table = rng.standard_normal((GRAM_BUCKETS, width)) * 0.05
    gram_odds = gram_log_odds(places, per_row, buckets, per_word, labels)
    gram_table[:, 0] += np.clip(gram_odds, -1, 5) / 2
    net = Network(vocabulary, word_table, gram_table, hidden, seed)
    trainer = Trainer(net, rate)

    first, size, row = window_places(per_row)
    ids = np.concatenate([window_ids(places, first[i: i + 8192], size[i: i + 8192])
                          for i in range(0, len(first), 8192)])
    begins = np.searchsorted(row, np.arange(len(texts)))
    vectors = net.all_vectors(words)
    # Before the first round the highest window is the one with the word of the highest first component.
    strength = np.concatenate([[-9.0], vectors[:, 0]])
    highest = np.concatenate([strength[ids[i: i + 8192]].max(axis=1) for i in range(0, len(ids), 8192)])
    del buckets, per_word, vectors, plains
    for _ in range(rounds):
        best = np.array([b + int(np.argmax(highest[b:e])) for b, e in zip(begins, [*begins[1:], len(row)])])
        clean = np.flatnonzero(labels == 0)
        spread = (begins + (rng.random(len(texts)) * np.diff([*begins, len(row)])).astype(np.int64))[clean]
        picked = np.concatenate([best, spread])
        picked = picked[rng.permutation(len(picked))]
        for at in range(0, len(picked), batch):
            some = picked[at: at + batch]
            trainer.train(words, ids[some], labels[row[some]])
        table = net.inputs(net.all_vectors(words))
        highest = np.concatenate([net.forward(table, ids[i: i + 4096]) for i in range(0, len(ids), 4096)])
    net.curve = logistic_curve(np.maximum.reduceat(highest, begins), labels)
    return net


def logistic_curve(x: np.ndarray, labels: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and shift of a logistic curve, by Newton steps with a weak pull to slope 1."""
    a, b = 1.0, 0.0
    for _ in range(steps):
        q = sigmoid(a * x + b)
        weight = q * (1 - q) + 1e-6
        g = np.array([((q - labels) * x).sum() + (a - 1), (q - labels).sum()])
        hessian = np.array([[(weight * x * x).sum() + 1, (weight * x).sum()], [(weight * x).sum(), weight.sum()]])
        move = np.linalg.solve(hessian, g)
        a, b = a - float(np.clip(move[0], -1, 1)), b - float(np.clip(move[1], -2, 2))
    return max(a, 1e-3), b


class Scorer:
    """A worker's network with what recent words add to the gates."""

    def __init__(self, net: Network, cache_words: int = CACHE_WORDS):
        self.net, self.most = net, cache_words
        self.forget()

    def forget(self) -> None:
        self.cache: dict[bytes, int] = {}
        self.table = self.net.inputs(np.zeros((0, self.net.p["grams"].shape[1]), np.float32))
        self.used = 1

    def numbers(self, words: list[bytes]) -> np.ndarray:
        new = [w for w in words if w not in self.cache]
        if len(self.cache) + len(new) > self.most:
            self.forget()
            new = words
        if new:
            gates = self.net.inputs(self.net.vectors(new)[0])[:, 1:]
            need = self.used + len(new)
            if need > self.table.shape[1]:
                grown = np.zeros((2, max(need, 2 * self.table.shape[1]), self.table.shape[2]), np.float32)
                grown[:, : self.used] = self.table[:, : self.used]
                self.table = grown
            self.table[:, self.used: need] = gates
            self.cache.update(zip(new, range(self.used - 1, need - 1)))
            self.used = need
        return np.fromiter((self.cache[w] for w in words), np.int64, len(words))

    def scores(self, texts: pa.Array, lanes: int = 2048) -> tuple[np.ndarray, np.ndarray]:
        """Score of each text and its number of windows."""
        words, places, per_row = split_words(texts)
        numbers = self.numbers(words)
        places = numbers[places] if len(places) else places
        first, size, row = window_places(per_row)
        logits = np.concatenate([
            self.net.forward(self.table, window_ids(places, first[i: i + lanes], size[i: i + lanes]))
            for i in range(0, len(first), lanes)])
        begins = np.searchsorted(row, np.arange(len(per_row)))
        a, b = self.net.curve
        return sigmoid(a * np.maximum.reduceat(logits, begins).astype(np.float64) + b), np.bincount(row)


_SCORERS: dict[str, Scorer] = {}


def training_sample(docs: DataFrame, labels: DataFrame, sample_docs: int, id_column: str,
                    text_column: str) -> tuple[list, list]:
    """Texts and labels of about ``sample_docs`` rows of each label that are not held out."""
    labels = labels.select(F.col(id_column).alias("id"), F.col("toxic").cast("int").alias("toxic")).where(
        "toxic in (0, 1) and id is not null").groupBy("id").agg(F.max("toxic").alias("toxic")).where(~held_out("id"))
    sizes = {r["toxic"]: r["count"] for r in labels.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return [], []
    grid = 1 << 30
    share = F.when(F.col("toxic") == 1, F.lit(int(grid * sample_docs / sizes[1]))).otherwise(
        F.lit(int(grid * sample_docs / sizes[0])))
    chosen = labels.where(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(grid)) < share)
    # The sample is bounded by its parameter, so it may go to every task; all documents of an id are read.
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).join(
        F.broadcast(chosen), "id").toPandas().sort_values(["id", "text"], kind="stable", ignore_index=True)
    return rows["text"].tolist(), rows["toxic"].tolist()


def worker_scorer(shared, name: str) -> Scorer | None:
    """The worker's scorer of a broadcast network; tasks of one worker share its cache."""
    claim("toxicity", _SCORERS.clear)
    if shared.value is None:
        return None
    if name not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[name] = Scorer(shared.value)
    return _SCORERS[name]


def fitted(docs: DataFrame, labels: DataFrame, sample_docs: int, id_column: str, text_column: str, **options):
    """A broadcast of the network trained on the sample (none without both labels), and a name for it."""
    texts, toxic = training_sample(docs, labels, sample_docs, id_column, text_column)
    net = fit(texts, toxic, **options) if len(set(toxic)) > 1 else None
    del texts, toxic
    give_back()  # what training on the driver took
    return docs.sparkSession.sparkContext.broadcast(net), uuid.uuid4().hex


def done() -> None:
    """At a task's end nothing stays in its worker, which lives on through other stages."""
    _SCORERS.clear()
    give_back()


def scored_slices(scorer: Scorer | None, column: pa.Array):
    """(start, stop, scores, windows) of runs of rows."""
    texts = pa.compute.fill_null(column, "")
    for start, stop in slices(texts, SLICE_BYTES):
        if scorer is None:
            yield start, stop, np.zeros(stop - start), np.ones(stop - start, np.int64)
        else:
            yield start, stop, *scorer.scores(texts.slice(start, stop - start))


def score_toxicity(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, threshold: float = THRESHOLD,
                   id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """(id, held_out, score, predicted, n_windows) of every row."""
    shared, name = fitted(docs, labels, sample_docs, id_column, text_column, **options)

    def run(batches):
        scorer = worker_scorer(shared, name)
        for batch in batches:
            for start, stop, score, windows in scored_slices(scorer, batch.column(1)):
                kept = [batch.column(i).slice(start, stop - start) for i in (0, 2)]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(score), pa.array((score >= threshold).astype(np.int32)),
                     pa.array(windows.astype(np.int64))],
                    names=[id_column, "held_out", "score", "predicted", "n_windows"])
        done()

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, text_column, held_out(id_column).alias("held_out")).mapInArrow(
        run, f"`{id_column}` {kind}, held_out boolean, score double, predicted int, n_windows long")


def drop_toxic(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, threshold: float = THRESHOLD,
               id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """All columns of the rows whose score is below the threshold."""
    shared, name = fitted(docs, labels, sample_docs, id_column, text_column, **options)

    def run(batches):
        scorer = worker_scorer(shared, name)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text_column))
            for start, stop, score, _ in scored_slices(scorer, column):
                yield batch.slice(start, stop - start).filter(pa.array(score < threshold))
        done()

    return docs.mapInArrow(run, docs.schema)
