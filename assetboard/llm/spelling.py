"""Spelling variants: words one edit apart, by neighbourhoods over a reduced alphabet.

Words are runs of letters (A-Z, a-z and U+00C0 to U+00FF), A-Z in lower case. One run in ``drop_modulus``, by a
checksum of id and run, loses a letter before it is counted. Words of at least ``least_length`` code points with
at least ``least_count`` occurrences are compared.

Every letter is hashed to one of ``symbols``, which makes reduced words with few possible neighbours: all
reduced words one insertion, deletion or replacement away, and the reduced word itself, where a replacement was
hidden. These neighbours are joined with the reduced words of the vocabulary, and what meets is verified on the
original strings. An edit leaves one half of the other word as it is, so the join also asks for the original
letters of that half: a reduced word that many words share is not compared with all its neighbours. Keys are
hashes; a wrong meeting does not pass verification. A Bloom filter of fixed size keeps back neighbours that no
word has; when it fills up more rows are joined, with the same result.

A word's form is its near word with most occurrences (ties: least in code-point order) where those are at least
``factor`` times its own. Counts grow along forms, so chains end; roots are found by doubling, one join a round,
with as many rounds as the logarithm of the longest chain.

Null texts have no words, null ids count as empty text in the checksum, repeated rows count each. An empty
table gives no rows. Columns besides id and text are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetboard.llm.common import bloom_of_hashes, in_bits, slices, utf8_buffer
from assetboard.session import land

SYMBOLS, LEAST_LENGTH, LEAST_COUNT, DROP_MODULUS, FACTOR = 4, 5, 3, 97, 2
SLICE_BYTES = 8_000_000
#: Checksums of runs up to so many bytes are put together from those of id and run, longer ones made anew.
SHORT_BYTES = 64
KEYS_AT_ONCE = 2_000_000
_CRC = np.array([zlib.crc32(bytes([i])) for i in range(256)], np.uint32)
_ZERO = _CRC ^ np.uint32(0xFFFFFFFF) ^ (np.uint32(0xFFFFFFFF) >> np.uint32(8))
_ZERO = _ZERO[(np.arange(256) ^ 0xFF)]  # the table of the checksum's bytes, without its start and end values


def letter_runs(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct runs of letters, the run at each place and the row of each place."""
    raw, starts = utf8_buffer(texts)
    lower = raw.copy()
    upper = (raw >= 65) & (raw <= 90)
    lower[upper] += 32
    inside = (lower >= 97) & (lower <= 122)
    wide = raw == 0xC3  # U+00C0 to U+00FF are C3 and one byte more, and C3 starts nothing else
    inside |= wide
    inside[1:] |= wide[:-1]
    edge = np.zeros(len(raw) + 1, bool)
    edge[starts] = True
    change = np.flatnonzero(edge[:-1] | np.concatenate([[True], inside[1:] != inside[:-1]])) if len(raw) else np.zeros(0, np.int64)
    bounds = np.append(change, len(raw)).astype(np.int64)
    runs = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(change), [None, pa.py_buffer(bounds), pa.py_buffer(lower)])
    is_run = inside[change] if len(raw) else np.zeros(0, bool)
    words = runs.filter(pa.array(is_run)).dictionary_encode()
    rows = np.searchsorted(starts, change[is_run], side="right") - 1
    return words.dictionary, np.asarray(words.indices), rows


def checksums(prefixes: list[bytes], words: list[bytes], at: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """crc32 of each place's prefix and word, one after the other."""
    of_word = np.fromiter((zlib.crc32(w) for w in words), np.uint32, len(words))
    size = np.fromiter(map(len, words), np.int64, len(words))
    state = np.fromiter((zlib.crc32(p) for p in prefixes), np.uint32, len(prefixes))
    # Row k: the checksums of the prefixes followed by k bytes, without what those bytes add.
    moved = np.empty((min(int(size.max(initial=0)), SHORT_BYTES) + 1, len(prefixes)), np.uint32)
    moved[0] = state
    for k in range(1, len(moved)):
        moved[k] = _ZERO[moved[k - 1] & 0xFF] ^ (moved[k - 1] >> np.uint32(8))
    short = size[at] <= SHORT_BYTES
    out = np.zeros(len(at), np.uint32)
    out[short] = moved[size[at[short]], rows[short]] ^ of_word[at[short]]
    for i in np.flatnonzero(~short):
        out[i] = zlib.crc32(words[at[i]], int(state[rows[i]]))
    return out


def count_runs(docs: DataFrame, least_length: int, drop_modulus: int) -> DataFrame:
    """(word, n) of rows (id as text, text)."""
    def run(batches):
        for batch in batches:
            ids, texts = pa.compute.fill_null(batch.column(0), ""), batch.column(1)
            for start, stop in slices(texts, SLICE_BYTES):
                runs, at, rows = letter_runs(texts.slice(start, stop - start))
                if not len(at):
                    continue
                words = runs.to_pylist()
                sums = checksums([f"{x}:".encode() for x in ids.slice(start, stop - start).to_pylist()], words, at, rows)
                hit = np.flatnonzero(sums % np.uint32(drop_modulus) == 0)
                n = np.bincount(at, minlength=len(words)) - np.bincount(at[hit], minlength=len(words))
                shortened: dict[str, int] = {}
                for i in hit.tolist():
                    whole = words[at[i]].decode()
                    gone = int(sums[i]) % len(whole)
                    whole = whole[:gone] + whole[gone + 1:]
                    if len(whole) >= least_length:
                        shortened[whole] = shortened.get(whole, 0) + 1
                texts_of = runs.cast(pa.string())
                keep = pa.array((n > 0) & (np.asarray(pa.compute.utf8_length(texts_of)) >= least_length))
                yield pa.RecordBatch.from_arrays([texts_of.filter(keep), pa.array(n).filter(keep)], names=["word", "n"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(shortened), pa.string()), pa.array(list(shortened.values()), pa.int64())], names=["word", "n"])

    return docs.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` odd numbers of 64 bits; the first ones are the same for every n."""
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def reduced(chars: np.ndarray, symbols: int) -> np.ndarray:
    """Symbol of each code point, from 1."""
    return ((chars.astype(np.uint64) * np.uint64(0x9E3779B1)) >> np.uint64(16)) % np.uint64(symbols) + np.uint64(1)


class Neighbourhood:
    """Keys of words with one length: rows of code points."""

    def __init__(self, chars: np.ndarray, symbols: int):
        m, size = chars.shape
        self.size, self.symbols = size, symbols
        self.place, side = constants(size + 2, 1), constants(size + 2, 2)
        self.r = reduced(chars, symbols)
        zero = np.zeros((m, 1), np.uint64)
        c = chars.astype(np.uint64)
        self.first = np.hstack([zero, np.cumsum(c * side[:size], axis=1)])
        self.last = np.hstack([zero, np.cumsum(c[:, ::-1] * side[:size], axis=1)])
        self.own = self.r * self.place[:size]
        self.before = np.hstack([zero, np.cumsum(self.own, axis=1)])

    def key(self, word: np.ndarray, size: int, at: int | None, side: int = 0) -> np.ndarray:
        """Key of reduced words of a length, given where the edit is or which half stays (0 first, 1 last)."""
        half = size // 2
        if at is not None:
            side = 0 if at >= half else 1
        kept = self.first[:, half] if side == 0 else self.last[:, size - half]
        kept = mixed(kept + np.uint64(2 * size + side))
        return mixed(word + kept[:, None] if word.ndim > 1 else word + kept)

    def keys(self) -> np.ndarray:
        """The two keys under which a word is found."""
        whole = self.before[:, -1]
        return np.stack([self.key(whole, self.size, None, 0), self.key(whole, self.size, None, 1)], axis=1)

    def around(self, least_length: int) -> np.ndarray:
        """Keys of the whole neighbourhood, with the reduced word itself."""
        size, s, place = self.size, np.uint64(self.symbols), self.place
        whole, out = self.before[:, -1], [self.keys()]
        after_cut = self._after(self.r[:, 1:] * place[: size - 1])
        after_gap = self._after(self.r * place[1: size + 1])
        steps = np.arange(1, self.symbols, dtype=np.uint64)
        every = np.arange(1, self.symbols + 1, dtype=np.uint64)
        for p in range(size):
            others = (self.r[:, p: p + 1] - np.uint64(1) + steps) % s + np.uint64(1)
            out.append(self.key((whole - self.own[:, p])[:, None] + others * place[p], size, p))
            if size > least_length:
                out.append(self.key(self.before[:, p] + after_cut[:, p], size - 1, p)[:, None])
        for p in range(size + 1):
            out.append(self.key((self.before[:, p] + after_gap[:, p])[:, None] + every * place[p], size + 1, p))
        return np.hstack(out)

    @staticmethod
    def _after(terms: np.ndarray) -> np.ndarray:
        """Sums of the terms from each place on, and 0 past the last."""
        sums = np.cumsum(terms[:, ::-1], axis=1)[:, ::-1]
        return np.hstack([sums, np.zeros((len(terms), 1), np.uint64)])


def by_length(words: list[str]):
    """(places, code points) of words of one length, in runs of bounded size."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    start = np.cumsum(size) - size
    for length in np.unique(size):
        some = np.flatnonzero(size == length)
        step = max(1, KEYS_AT_ONCE // (10 * int(length)))
        for low in range(0, len(some), step):
            part = some[low: low + step]
            yield part, flat[start[part][:, None] + np.arange(length)]


def vocabulary_keys(words: DataFrame, symbols: int) -> DataFrame:
    """(key, near, near_n): two rows per word."""
    def run(batches):
        for batch in batches:
            for part, chars in by_length(batch.column(0).to_pylist()):
                keys, rows = Neighbourhood(chars, symbols).keys(), pa.array(np.repeat(part, 2))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel().view(np.int64)), batch.column(0).take(rows), batch.column(1).take(rows)],
                    names=["key", "near", "near_n"])

    return words.select("word", "n").mapInArrow(run, "key long, near string, near_n long")


def neighbour_keys(words: DataFrame, symbols: int, least_length: int, bits: np.ndarray) -> DataFrame:
    """(key, word) of those neighbours of each word that the vocabulary may have."""
    shared = words.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        for batch in batches:
            for part, chars in by_length(batch.column(0).to_pylist()):
                keys = Neighbourhood(chars, symbols).around(least_length)
                row, column = np.nonzero(in_bits(keys.ravel(), shared.value).reshape(keys.shape))
                keys = keys[row, column]
                order = np.lexsort((keys, row))
                row, keys = row[order], keys[order]
                fresh = np.ones(len(row), bool)
                fresh[1:] = (row[1:] != row[:-1]) | (keys[1:] != keys[:-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[fresh].view(np.int64)), batch.column(0).take(pa.array(part[row[fresh]]))], names=["key", "word"])

    return words.select("word").mapInArrow(run, "key long, word string")


def near_words(words: DataFrame, symbols: int = SYMBOLS, least_length: int = LEAST_LENGTH) -> DataFrame:
    """(word, near, near_n): every ordered pair of words one edit apart, once."""
    have = land(vocabulary_keys(words, symbols), "reduced-words")
    asked = neighbour_keys(words, symbols, least_length, bloom_of_hashes(have, "key"))
    # Plans size neighbours by the words they come from, and written tables by their compressed files: both may be
    # taken for small enough to broadcast when they are not, so these joins are by shuffles.
    met = asked.join(have.hint("merge"), "key").where((F.col("word") != F.col("near")) & (F.expr("levenshtein(word, near, 1)") == 1))
    return met.select("word", "near", "near_n").repartition("word").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form (word, form): forms followed to the last."""
    state = land(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        state = land(state.join(further.hint("merge"), "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if state.where("moved").isEmpty():
            return state.select("word", "root")
        state = state.select("word", "root")


def spelling_variants(docs: DataFrame, symbols: int = SYMBOLS, least_length: int = LEAST_LENGTH,
                      least_count: int = LEAST_COUNT, drop_modulus: int = DROP_MODULUS, factor: int = FACTOR,
                      id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word that is frequent enough."""
    plain = docs.select(F.col(id_column).cast("string").alias("id"), F.col(text_column).cast("string").alias("text"))
    words = land(count_runs(plain, least_length, drop_modulus).where(F.col("n") >= least_count), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("near")))
    near = near_words(words, symbols, least_length).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    found = words.join(near.hint("merge"), "word", "left").withColumn("most", -F.col("best.n"))
    has = F.col("most") >= factor * F.col("n")
    found = land(found.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                              F.when(has, F.col("best.near")).alias("form"), F.when(has, F.col("most")).alias("form_n")), "forms")
    ends = roots(found.where("form is not null"))
    return found.join(ends.hint("merge"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
