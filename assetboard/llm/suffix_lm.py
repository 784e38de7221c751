"""Language-model scores by a probabilistic suffix tree over characters, beside a unigram base over words.

Text is read as its words (A-Z in lower case) with one space between, then an end. Symbols are the end, the
space, the most frequent characters of the training texts, and one class for all others, which spells a
member by an equal share. The tree's contexts have 1 to ``depth`` symbols and never reach back over an end.
A context stays when it occurs at least ``least_count`` times in training, and its next-symbol counts diverge
from those its next shorter context predicts: a likelihood-ratio test, 2 n KL > ``divergence`` times the
symbols seen. Both are absolute, so the tree grows with the corpus. The distribution of a context adds
``prior`` observations spread as the longest shorter context that stays says. A symbol is scored by the
longest context of its past that the tree holds.

The tree is a table of every symbol with its past that occurs in any text, beside its probability. Levels up to
``LOW`` symbols, which the alphabet bounds, are made on the driver; the deeper ones in tasks that each hold all
rows of some newest three symbols. Scores are joined: rows with the highest training counts (a bounded number)
are looked up in the tasks, occurrences of all others are counted per text and joined with the table.

Counting and the words' table cover all training rows. Words are scored in the same way: frequent ones looked
up, occurrences of all others joined with their counts.

Null texts count as empty (one token: the end). A null id counts as the text ''. Repeated rows are scored
one by one. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetboard.llm.common import blocks_for, bounds_at, is_gap, slices, utf8_buffer
from assetboard.session import land

BITS = 7
PAD, END, SPACE, OTHER, FIRST = 0, 1, 2, 3, 4
CODE_POINTS = 0x110000
SLICE_BYTES = 2_000_000
FREQUENT_WORDS = 1 << 18
FREQUENT_CODES = 1 << 21
#: Contexts of so many symbols are made on the driver: at most 2 ** (BITS * (LOW + 1)) rows.
LOW = 2
CODES_PER_PART = 2_000_000


def held_out(id_column: str, modulus: int = 7, remainder: int = 2) -> Column:
    text = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    return F.crc32(F.encode(text, "UTF-8")) % modulus == remainder


# --- reading texts -------------------------------------------------------------------------------------

def folded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with A-Z in lower case, row starts, and which bytes are gaps."""
    raw, starts = utf8_buffer(texts)
    raw = raw.copy()
    raw[(raw >= 65) & (raw <= 90)] += 32
    return raw, starts, is_gap(raw)


def xxh64(words: pa.LargeBinaryArray) -> np.ndarray:
    """``xxhash.xxh64_intdigest`` of every word: those under 32 bytes all at once, longer ones one by one."""
    starts = np.frombuffer(words.buffers()[1], np.int64)[words.offset: words.offset + len(words) + 1]
    sizes = np.diff(starts)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    data = np.concatenate([data[starts[0]: starts[-1]], np.zeros(8, np.uint8)])
    at = starts[:-1] - starts[0]
    eights = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    p1, p2, p3, p4, p5 = (np.uint64(p) for p in (
        0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))

    def turned(x: np.ndarray, n: int) -> np.ndarray:
        return (x << np.uint64(n)) | (x >> np.uint64(64 - n))

    out = p5 + sizes.astype(np.uint64)
    short = sizes < 32
    for k in range(3):
        some = np.flatnonzero(short & (sizes >= 8 * k + 8))
        out[some] = turned(out[some] ^ turned(eights[at[some] + 8 * k] * p2, 31) * p1, 27) * p1 + p4
    some = np.flatnonzero(short & (sizes & 4 > 0))
    four = eights[at[some] + (sizes[some] & 24)] & np.uint64(0xFFFFFFFF)
    out[some] = turned(out[some] ^ four * p1, 23) * p2 + p3
    for k in range(3):
        some = np.flatnonzero(short & (sizes & 3 > k))
        out[some] = turned(out[some] ^ data[at[some] + (sizes[some] & 28) + k] * p5, 11) * p1
    out = (out ^ (out >> np.uint64(33))) * p2
    out = (out ^ (out >> np.uint64(29))) * p3
    out ^= out >> np.uint64(32)
    for i in np.flatnonzero(~short):
        out[i] = xxhash.xxh64_intdigest(words[i].as_py())
    return out


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each distinct word, the word of each place, and the row of each place."""
    raw, starts, gap = folded(texts)
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    bounds = bounds_at(len(raw), starts, np.flatnonzero(gap[1:] != gap[:-1]) + 1)
    runs = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(raw)])
    is_word = ~gap[bounds[:-1]]
    words = runs.filter(pa.array(is_word)).dictionary_encode()
    rows = np.searchsorted(starts, bounds[:-1][is_word], side="right") - 1
    return xxh64(words.dictionary).view(np.int64), np.asarray(words.indices), rows


def code_points(texts: pa.Array) -> np.ndarray:
    """Characters of all texts: words with one space between, and a line feed after each text."""
    raw, starts, gap = folded(texts)
    raw[gap] = 32
    # Ends go in after each row; then gaps at a row's start, at its end and after another gap leave.
    stream = np.insert(raw, starts[1:], 10)
    blank = np.insert(gap, starts[1:], False)
    ends = np.zeros(len(stream), bool)
    ends[starts[1:] + np.arange(len(starts) - 1)] = True
    before = np.concatenate([[True], blank[:-1] | ends[:-1]])
    after = np.concatenate([ends[1:], [True]])
    keep = ~blank | ~before
    # A run of gaps before an end keeps only its first byte, and that one leaves as well.
    stream, blank, ends = stream[keep], blank[keep], ends[keep]
    after = np.concatenate([ends[1:], [True]])
    stream = stream[~(blank & after)]
    return np.frombuffer(stream.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)


def context_codes(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Each symbol with the ``depth`` before it, none from before an end, as one number."""
    codes = symbols.astype(np.int64)
    alive = np.ones(len(symbols), bool)
    for back in range(1, depth + 1):
        past = np.zeros(len(symbols), np.int64)
        past[back:] = symbols[:-back] if back < len(symbols) else 0
        if back > 1:
            newer = np.zeros(len(symbols), np.int64)
            newer[back - 1:] = symbols[:-(back - 1)] if back - 1 < len(symbols) else 0
            alive &= newer != END
        codes |= np.where(alive, past, 0) << (BITS * back)
    return codes


def stream_codes(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Codes of a stream of whole texts; its first symbol follows an end, as every other first symbol does."""
    return context_codes(np.concatenate([np.full(1, END, symbols.dtype), symbols]), depth)[1:]


class Tally:
    """Counts of numbers, merged when many wait."""

    def __init__(self, most_waiting: int = 4_000_000):
        self.keys, self.counts, self.waiting, self.most = [], [], 0, most_waiting

    def add(self, keys: np.ndarray, counts: np.ndarray | None = None) -> None:
        if counts is None:
            keys, counts = np.unique(keys, return_counts=True)
        self.keys.append(keys)
        self.counts.append(counts)
        self.waiting += len(keys)
        if self.waiting > self.most:
            self.merge()
            self.most = max(self.most, 2 * self.waiting)

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.keys:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys, where = np.unique(np.concatenate(self.keys), return_inverse=True)
        counts = np.bincount(where, np.concatenate(self.counts), len(keys)).astype(np.int64)
        self.keys, self.counts, self.waiting = [keys], [counts], len(keys)
        return keys, counts


# --- learning ------------------------------------------------------------------------------------------

def count_words_and_characters(train: DataFrame) -> DataFrame:
    """(kind, key, n): occurrences of word hashes ('w') and code points ('c') in all training texts."""
    def run(batches):
        words, chars = Tally(), np.zeros(CODE_POINTS, np.int64)
        for batch in batches:
            texts = pa.compute.fill_null(batch.column(0), "")
            for start, stop in slices(texts, SLICE_BYTES):
                part = texts.slice(start, stop - start)
                hashes, places, _ = word_hashes(part)
                words.add(hashes, np.bincount(places, minlength=len(hashes)))
                chars += np.bincount(code_points(part), minlength=CODE_POINTS)
        keys, counts = words.merge()
        seen = np.flatnonzero(chars)
        yield from _rows(["w", "c"], [keys, seen], [counts, chars[seen]])

    return train.select("text").mapInArrow(run, "kind string, key long, n long").groupBy("kind", "key").agg(
        F.sum("n").alias("n"))


def _rows(kinds, keys, counts, size: int = 200_000):
    for kind, key, count in zip(kinds, keys, counts):
        for at in range(0, len(key), size):
            some = key[at: at + size]
            yield pa.RecordBatch.from_arrays(
                [pa.array([kind] * len(some)), pa.array(some, pa.int64()), pa.array(count[at: at + size], pa.int64())],
                names=["kind", "key", "n"])


def symbol_table(counts: DataFrame) -> np.ndarray:
    """Symbol of every code point: the most frequent characters have their own."""
    own = (1 << BITS) - FIRST
    top = counts.where("kind = 'c' and key not in (10, 32)").orderBy(F.desc("n"), "key").limit(own).collect()
    symbols = np.full(CODE_POINTS, OTHER, np.uint8)
    symbols[10], symbols[32] = END, SPACE
    for i, row in enumerate(top):
        symbols[row["key"]] = FIRST + i
    return symbols


def count_contexts(docs: DataFrame, symbols: np.ndarray, depth: int) -> DataFrame:
    """(code, n) of every symbol with its past in any text; n counts training texts. A code may have several rows."""
    shared = docs.sparkSession.sparkContext.broadcast(symbols)

    def run(batches):
        tally = Tally()
        for batch in batches:
            texts, held = pa.compute.fill_null(batch.column(0), ""), batch.column(1)
            for mine, weight in ((texts.filter(pa.compute.invert(held)), 1), (texts.filter(held), 0)):
                for start, stop in slices(mine, SLICE_BYTES):
                    codes = stream_codes(shared.value[code_points(mine.slice(start, stop - start))], depth)
                    keys, counts = np.unique(codes, return_counts=True)
                    tally.add(keys, weight * counts)
        keys, counts = tally.merge()
        for at in range(0, len(keys), 200_000):
            yield pa.RecordBatch.from_arrays([pa.array(keys[at: at + 200_000]), pa.array(counts[at: at + 200_000])],
                                             names=["code", "n"])

    return docs.select("text", "held_out").mapInArrow(run, "code long, n long")


class Level(NamedTuple):
    """Symbols with at most so many before them, in order: counts, counts of their contexts, probabilities."""

    code: np.ndarray
    n: np.ndarray
    total: np.ndarray
    p: np.ndarray


class Rules(NamedTuple):
    least_count: int
    divergence: float
    prior: float


def summed(codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, where = np.unique(codes, return_inverse=True)
    return keys, np.bincount(where, n, len(keys)).astype(np.int64)


def root(codes: np.ndarray, n: np.ndarray) -> Level:
    """Probabilities of the symbols alone: each has one occurrence more than counted."""
    code, n = summed(codes & ((1 << BITS) - 1), n)
    total, live = n.sum(), max(int(code[n > 0].max(initial=0)), FIRST)
    return Level(code, n, np.full(len(code), total), (n + 1) / (total + live))


def grown(codes: np.ndarray, n: np.ndarray, k: int, shorter: Level, rules: Rules) -> tuple[Level, int]:
    """The level with ``k`` symbols before each, from the one with one less, and how many of its contexts stay.

    All rows of a context must be there. Where an end cuts the past, a row says what its shorter one says.
    """
    code, n = summed(codes & ((1 << (BITS * (k + 1))) - 1), n)
    if not len(code):
        return Level(code, n, n, np.zeros(0)), 0
    context = code >> BITS
    starts = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
    sizes = np.diff(np.append(starts, len(code)))
    totals = np.add.reduceat(n, starts)
    total = np.repeat(totals, sizes)
    at = np.searchsorted(shorter.code, code & ((1 << (BITS * k)) - 1))
    seen = n > 0
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(seen, n * np.log(n * (shorter.total[at] / total) / shorter.n[at]), 0.0)
    whole = (context[starts] >> (BITS * (k - 1))) != PAD
    stays = whole & (totals >= rules.least_count) & (
        2 * np.add.reduceat(gain, starts) > rules.divergence * np.add.reduceat(seen.astype(np.int64), starts))
    p = np.where(np.repeat(stays, sizes), (n + rules.prior * shorter.p[at]) / (total + rules.prior), shorter.p[at])
    return Level(code, n, total, p), int(stays.sum())


def code_scores(codes: DataFrame, depth: int, rules: Rules, other_members: int,
                per_part: int = CODES_PER_PART) -> DataFrame:
    """(code, n, log, states): log10 probability of every code; rows without a code count contexts that stay."""
    spark, low = codes.sparkSession, min(LOW, depth)
    short = F.col("code").bitwiseAND((1 << (BITS * (low + 1))) - 1)
    few = codes.groupBy(short.alias("code")).agg(F.sum("n").alias("n")).toArrow()
    few_codes, few_n = few["code"].to_numpy(), few["n"].to_numpy()
    level, stay = root(few_codes, few_n), 1
    for k in range(1, low + 1):
        level, more = grown(few_codes, few_n, k, level, rules)
        stay += more
    shared = spark.sparkContext.broadcast(level)
    spell = np.log10(max(other_members, 1))

    def run(batches):
        parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
        if not parts:
            return
        codes, n = summed(*(np.concatenate(x) for x in zip(*parts)))
        del parts
        level, states = shared.value, 0
        for k in range(low + 1, depth + 1):
            level, more = grown(codes, n, k, level, rules)
            states += more
        p = level.p[np.searchsorted(level.code, codes)]
        log = np.log10(p) - np.where(codes & ((1 << BITS) - 1) == OTHER, spell, 0.0)
        for at in range(0, len(codes), 200_000):
            some = slice(at, at + 200_000)
            size = len(codes[some])
            yield pa.RecordBatch.from_arrays(
                [pa.array(codes[some]), pa.array(n[some]), pa.array(log[some]), pa.nulls(size, pa.int64())],
                names=["code", "n", "log", "states"])
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.float64()), pa.array([states])],
            names=["code", "n", "log", "states"])

    newest = F.shiftright("code", BITS).bitwiseAND((1 << (BITS * (LOW + 1))) - 1)
    dealt = codes.repartition(blocks_for(codes.count(), per_part), newest)
    schema = "code long, n long, log double, states long"
    return dealt.mapInArrow(run, schema).union(
        spark.createDataFrame([(None, None, None, stay)], schema))


class Tree:
    """The automaton of a suffix tree that fits one process: log10 probability and next state by state and symbol.

    Tests hold the table of ``code_scores`` against it.
    """

    def __init__(self, level: np.ndarray, code: np.ndarray, n: np.ndarray, depth: int, prior: float,
                 other_members: int):
        width = 1 << BITS
        self.depth = depth
        # A context is its symbols, newest lowest, under a leading one that marks its length.
        context = np.where(level > 0, code >> BITS | np.left_shift(1, BITS * level), 1)
        states = [np.unique(np.concatenate([[1], context]))]
        while states[-1].max() > 1:  # a state is reached through the states of its first symbols
            states.append(np.unique(np.maximum(states[-1] >> BITS, 1)))
        self.states = np.unique(np.concatenate(states))
        lengths = np.searchsorted(np.left_shift(1, BITS * np.arange(depth + 2)), self.states, side="right") - 1
        symbol = code & (width - 1)
        width = self.width = int(max(symbol.max(initial=0), FIRST)) + 1
        # Counts turn into probabilities, then into logarithms, in one table: the driver holds it once.
        table = np.zeros((len(self.states), width), np.float32)
        np.add.at(table, (np.searchsorted(self.states, context), symbol), n)
        totals = table.sum(axis=1, keepdims=True, dtype=np.float64).astype(np.float32)
        live = np.arange(width) != PAD
        root = np.flatnonzero(lengths == 0)
        table[root] = live * (table[root] + 1) / (totals[root] + live.sum())
        for k in range(1, depth + 1):
            own = np.flatnonzero(lengths == k)
            shorter = table[self._longest(self.states[own], np.full(len(own), k - 1))]
            # A state that only leads to others has no counts and says what its shorter context says.
            table[own] = (table[own] + np.float32(prior) * shorter) / (totals[own] + np.float32(prior))
        np.log10(table, out=table, where=live)
        table[:, OTHER] -= np.float32(np.log10(max(other_members, 1)))
        self.log = table.ravel()
        most = np.minimum(lengths + 1, depth)
        following = np.empty((len(self.states), width), np.int32)
        for c in range(width):
            grown = (self.states ^ np.left_shift(1, BITS * lengths)) << BITS | c
            following[:, c] = self._longest(grown, most) * width
        self.next = following.ravel()

    def _longest(self, contexts: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Place of the longest state that is a suffix of each context, of at most so many symbols."""
        found = np.zeros(len(contexts), np.int64)
        for k in range(1, self.depth + 1):
            suffix = contexts & ((1 << (BITS * k)) - 1) | (1 << (BITS * k))
            at = np.minimum(np.searchsorted(self.states, suffix), len(self.states) - 1)
            found = np.where((self.states[at] == suffix) & (k <= most), at, found)
        return found

    def score(self, symbols: np.ndarray, lane: int = 512) -> np.ndarray:
        """log10 probability of each symbol of a stream."""
        n, warm = len(symbols), self.depth
        lanes = -(-n // lane) if n else 0
        # Row t of the grid holds the t-th symbol of every lane; lanes begin with the symbols before them.
        padded = np.concatenate([np.full(warm, END, np.uint8), symbols, np.full(lanes * lane - n, END, np.uint8)])
        grid = np.lib.stride_tricks.sliding_window_view(padded, lane + warm)[::lane].T.astype(np.int32)
        state = np.zeros(lanes, np.int32)
        out = np.empty((lane, lanes), np.float32)
        for t in range(lane + warm):
            at = state + grid[t]
            if t >= warm:
                out[t - warm] = self.log[at]
            state = self.next[at]
        return out.T.ravel()[:n]


# --- scoring -------------------------------------------------------------------------------------------

def least_of_frequent(counts: DataFrame, most: int) -> int:
    """The least count such that ``most`` rows at most have it or more."""
    bucket = F.floor(F.log2("n") * 4).cast("int")
    sizes = {r["b"]: r["c"] for r in counts.groupBy(bucket.alias("b")).agg(F.count("*").alias("c")).collect()}
    room, low = most, max(sizes, default=0) + 1
    while low - 1 in sizes and sizes[low - 1] <= room or low > 0 and low - 1 not in sizes:
        room -= sizes.get(low - 1, 0)
        low -= 1
    return int(np.ceil(2 ** (low / 4))) if low > 0 else 1


def frequent_words(words: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Hashes (sorted) and counts of the words with at least some count, ``most`` at most, and that count."""
    least = least_of_frequent(words, most)
    top = words.where(F.col("n") >= least).select("key", "n").toPandas()
    order = np.argsort(top["key"].to_numpy(np.int64))
    return top["key"].to_numpy(np.int64)[order], top["n"].to_numpy(np.int64)[order], least


def frequent_codes(scores: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Codes (sorted) and log10 probabilities of those with at least some count, ``most`` at most, and that count."""
    least = least_of_frequent(scores.where("n > 0"), most)
    top = scores.where(F.col("n") >= least).select("code", F.col("log").cast("float").alias("log")).toArrow()
    codes = top["code"].to_numpy()
    order = np.argsort(codes)
    return codes[order], top["log"].to_numpy()[order], least


def looked_up(codes: np.ndarray, keys: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores of the codes that are among the keys, zero for others, and which ones are."""
    order = np.argsort(codes)
    ranked = codes[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    distinct = ranked[new]
    at = np.minimum(np.searchsorted(keys, distinct), max(len(keys) - 1, 0))
    hit = keys[at] == distinct if len(keys) else np.zeros(len(distinct), bool)
    value = np.where(hit, logs[at], 0.0) if len(keys) else np.zeros(len(distinct))
    place = np.cumsum(new) - 1
    score, known = np.empty(len(codes)), np.empty(len(codes), bool)
    score[order], known[order] = value[place], hit[place]
    return score, known


def counted_per_row(rows: np.ndarray, codes: np.ndarray, size: int) -> pa.Array:
    """A list of (code, times) for each of ``size`` rows; ``rows`` ascend."""
    order = np.lexsort((codes, rows))
    rows, codes = rows[order], codes[order]
    first = np.flatnonzero(np.concatenate(
        [np.ones(min(len(rows), 1), bool), (rows[1:] != rows[:-1]) | (codes[1:] != codes[:-1])]))
    times = np.diff(np.append(first, len(rows)))
    cuts = np.searchsorted(rows[first], np.arange(size + 1))
    pairs = pa.StructArray.from_arrays([pa.array(codes[first], pa.int64()), pa.array(times, pa.int64())],
                                       names=["code", "times"])
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pairs)


def score_documents(docs: DataFrame, depth: int = 6, least_count: int = 8, divergence: float = 2.0,
                    prior: float = 40.0, frequent: int = FREQUENT_WORDS, frequent_contexts: int = FREQUENT_CODES,
                    modulus: int = 7, remainder: int = 2, id_column: str = "doc_id",
                    text_column: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_states) of every row."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"),
                       held_out(id_column, modulus, remainder).alias("held_out"))
    train = docs.where(~F.col("held_out"))
    counts = land(count_words_and_characters(train), "lm-counts")
    words = counts.where("kind = 'w'")
    totals = words.agg(F.count("*").alias("v"), F.sum("n").alias("n")).first()
    n_train = counts.where("kind = 'c' and key = 10").agg(F.sum("n")).first()[0] or 0
    n_words, n_all = totals["n"] or 0, (totals["n"] or 0) + n_train
    scale = float(np.log10(n_all + totals["v"] + (n_train > 0) + 1))
    symbols = symbol_table(counts)
    codes = land(count_contexts(docs, symbols, depth), "lm-contexts")
    table = land(code_scores(codes, depth, Rules(least_count, divergence, prior),
                             CODE_POINTS - int((symbols != OTHER).sum())), "lm-tree")
    n_states = table.agg(F.sum("states")).first()[0]
    scores = table.where("code is not null").select("code", "n", "log")
    code_keys, code_logs, least_code = frequent_codes(scores, frequent_contexts)
    top_keys, top_counts, least = frequent_words(words, frequent)
    top_logs = np.log10(top_counts + 1.0)
    shared = spark.sparkContext.broadcast((symbols, code_keys, code_logs, top_keys, top_logs))

    def run(batches):
        symbols, code_keys, code_logs, keys, logs = shared.value
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            texts = pa.compute.fill_null(batch.column(1), "")
            for start, stop in slices(texts, SLICE_BYTES):
                part = texts.slice(start, stop - start)
                size = len(part)
                stream = symbols[code_points(part)]
                ends = np.flatnonzero(stream == END)
                codes = stream_codes(stream, depth)
                value, found = looked_up(codes, code_keys, code_logs)
                score = np.add.reduceat(value, np.concatenate([[0], ends[:-1] + 1]))
                missing = np.flatnonzero(~found)
                cold = counted_per_row(np.searchsorted(ends, missing), codes[missing], size)
                hashes, places, rows = word_hashes(part)
                at = np.minimum(np.searchsorted(keys, hashes), max(len(keys) - 1, 0))
                hit = keys[at] == hashes if len(keys) else np.zeros(len(hashes), bool)
                log = np.where(hit, logs[at], 0.0) if len(keys) else np.zeros(len(hashes))
                known = hit[places]
                rare_row, rare_word = rows[~known], hashes[places[~known]]
                cuts = np.searchsorted(rare_row, np.arange(size + 1))
                yield pa.RecordBatch.from_arrays([
                    pa.array(row + np.arange(size)), batch.column(0).slice(start, size),
                    batch.column(2).slice(start, size),
                    pa.array(np.bincount(rows, minlength=size)), pa.array(np.bincount(rows[known], minlength=size)),
                    pa.array(np.bincount(rows, log[places], size).astype(np.float64)), pa.array(score),
                    pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(rare_word)), cold,
                ], names=["row", "id", "held_out", "n_words", "n_top", "top_log", "top_score", "rare", "cold"])
                row += size

    kind = docs.schema["id"].dataType.simpleString()
    scored = land(docs.select("id", "text", "held_out").mapInArrow(
        run, f"row long, id {kind}, held_out boolean, n_words long, n_top long, top_log double, top_score double, "
             "rare array<long>, cold array<struct<code:bigint,times:bigint>>"), "lm-scored")
    rare = scored.select("row", F.explode("rare").alias("key")).join(
        words.where(F.col("n") < least).select("key", "n"), "key").select(
        "row", F.lit(1).alias("n_rare"), F.log10(F.col("n") + 1.0).alias("rare_log"), F.lit(0.0).alias("cold_log"))
    cold = scored.select("row", F.inline("cold")).join(
        scores.where(F.col("n") < least_code), "code").select(
        "row", F.lit(0).alias("n_rare"), F.lit(0.0).alias("rare_log"), (F.col("times") * F.col("log")).alias("cold_log"))
    joined = rare.union(cold).groupBy("row").agg(*[F.sum(c).alias(c) for c in ("n_rare", "rare_log", "cold_log")])
    filled = lambda c: F.coalesce(c, F.lit(0))
    n_tokens = F.col("n_words") + 1
    return scored.drop("rare", "cold").join(joined, "row", "left").select(
        F.col("id").alias(id_column), "held_out", n_tokens.alias("n_tokens"),
        (F.col("n_top") + filled("n_rare") + int(n_train > 0)).cast("long").alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("top_log") + filled("rare_log") + float(np.log10(n_train + 1)) - n_tokens * scale).alias("base_score"),
        (F.col("top_score") + filled("cold_log")).alias("score"), F.lit(n_states).cast("long").alias("n_states"))
