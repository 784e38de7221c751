"""Phrases of two or more words that are more than their parts, from counts of the longest windows alone.

Texts are cut into pieces, pieces into words, A-Z in lower case. A window of ``longest`` words starts at every
word of a piece, padded beyond its end; its columns are the words that lead it. Only such windows are counted.
Sums over shorter and shorter prefixes of the window columns, by ROLLUP, give the counts of all shorter
phrases, since each occurrence of a phrase starts exactly one window.

Words travel as codes. A first pass counts the words of every language, which gives each its text, its number
and its code: the ``COMMON`` most frequent have two bytes, others nine with their hash. A word that is surely
rarer than ``least_count`` cannot be in a phrase and stands in windows as one byte, which leaves far fewer
different windows; windows that start with one are not counted. Whether a word is rare is asked of a Bloom
filter of fixed size, and when that fills up more windows are counted, with the same result. Two words with one
hash are looked for in the word table; if there are any, hashes are made anew with another seed.

A candidate occurs at least ``least_count`` times. Its score is the least over its cuts in two of
floor(1000000 * a * a / (l * r)), in decimals of 38 digits, exact for counts below 10 ** 13; ties of cuts go to
the shortest first part. Candidates within a longer one that occurs at least half as often leave.

Null texts are empty, the null language is ``und``, repeated rows count each. An empty table gives no rows.
Columns besides text and language are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assetboard.llm.common import bloom_of_hashes, in_bits, slices, utf8_buffer
from assetboard.session import land, scratch_path

#: Codes of two bytes: their first byte is below 0xF8.
COMMON = 0xF800
PAD, RARE, OTHER = b"\xfd", b"\xfe", b"\xff"
SLICE_BYTES = 2_500_000
#: Different words that a task counts before it passes them on.
WORDS_AT_ONCE = 100_000
SCALE = 1_000_000
_ENDS = np.frombuffer(b".,;:!?\n\x0b\x0c\r", np.uint8)


def words_in_pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, the word at each place, and the piece of each place."""
    raw, starts = utf8_buffer(texts)
    lower = raw.copy()
    upper = (raw >= 65) & (raw <= 90)
    lower[upper] += 32
    kind = np.zeros(256, np.uint8)
    kind[[32, 9]] = 1
    kind[_ENDS] = 2
    kinds = kind[lower]
    outside = kinds > 0
    first = np.zeros(len(raw) + 1, bool)
    first[starts[:-1]] = True  # a text may start where the one before ends without a gap
    first = first[:-1]
    begins = ~outside
    begins[1:] &= outside[:-1] | first[1:]
    at = np.flatnonzero(begins)
    stops = np.flatnonzero(outside | first)
    stop = np.append(stops, len(raw))[np.searchsorted(stops, at, side="right")]
    # Pieces change at the marks and where a row starts.
    piece = np.cumsum((kinds == 2) | first)[at] if len(raw) else np.zeros(0, np.int64)
    bounds = np.empty(2 * len(at) + 1, np.int64)
    bounds[0:-1:2], bounds[1::2] = at, stop
    bounds[-1] = len(raw)
    runs = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(lower)])
    words = runs.take(pa.array(np.arange(0, 2 * len(at), 2))).dictionary_encode()
    return words.dictionary, np.asarray(words.indices), piece


def hashed(words: pa.Array, lang: str, seed: int) -> np.ndarray:
    """64-bit hash of each word of a language."""
    digest, salt = xxhash.xxh64_intdigest, xxhash.xxh64_intdigest(lang.encode(), seed)
    return np.fromiter((digest(w, salt) for w in words.to_pylist()), np.uint64, len(words))


def by_language(batches):
    """(language, texts) of runs of rows with bounded bytes."""
    for batch in batches:
        langs = pa.compute.fill_null(batch.column(0).cast(pa.string()), "und")
        for start, stop in slices(batch.column(1), SLICE_BYTES):
            of, texts = langs.slice(start, stop - start), batch.column(1).slice(start, stop - start)
            for lang in pa.compute.unique(of).to_pylist():
                yield lang, texts.filter(pa.compute.equal(of, lang))


def count_words(docs: DataFrame, seed: int) -> DataFrame:
    """(hash, lang, word, n) of all words."""
    def passed_on(counts: dict[str, dict[bytes, int]]):
        for lang, of in counts.items():
            words = pa.array(of.keys(), pa.large_binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashed(words, lang, seed).view(np.int64)), pa.array([lang] * len(words), pa.string()),
                 words.cast(pa.string()), pa.array(of.values(), pa.int64())], names=["hash", "lang", "word", "n"])

    def run(batches):
        counts: dict[str, dict[bytes, int]] = {}
        for lang, texts in by_language(batches):
            words, at, _ = words_in_pieces(texts)
            of = counts.setdefault(lang, {})
            for word, n in zip(words.to_pylist(), np.bincount(at, minlength=len(words)).tolist()):
                of[word] = of.get(word, 0) + n
            if sum(map(len, counts.values())) > WORDS_AT_ONCE:
                yield from passed_on(counts)
                counts = {}
        yield from passed_on(counts)

    rows = docs.mapInArrow(run, "hash long, lang string, word string, n long")
    return rows.groupBy("hash", "lang", "word").agg(F.sum("n").alias("n"))


def word_table(docs: DataFrame, seeds=range(8)) -> tuple[DataFrame, int]:
    """The words with hashes of their own, and the seed that gave them."""
    for seed in seeds:
        words = land(count_words(docs, seed), "words")
        if words.groupBy("hash").count().where("count > 1").isEmpty():
            return words, seed
    raise RuntimeError("two words share a hash under every seed")


def word_codes(hashes: np.ndarray, common: np.ndarray, order: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Number of each word: 0 for rare, from 1 for common ones in order, beyond for others by their place."""
    number = np.arange(len(hashes)) + len(common) + 1
    if len(common):
        at = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
        known = common[at] == hashes
        number[known] = order[at[known]] + 1
    else:
        known = np.zeros(len(hashes), bool)
    number[~known & ~in_bits(hashes, bits)] = 0
    return number


def encoded(columns: list[np.ndarray], hashes: np.ndarray, n_common: int) -> pa.Array:
    """The windows as bytes, one after the other; a column holds numbers of words, or -1 for padding."""
    n = len(columns[0])
    # Per number of a word: its bytes, as a row of nine and a length.
    size = np.full(n_common + 2 + len(hashes), 9, np.int64)
    code = np.zeros((len(size), 9), np.uint8)
    size[: 2] = 1
    code[0, 0], code[1, 0] = PAD[0], RARE[0]
    size[2: n_common + 2] = 2
    code[2: n_common + 2, 0], code[2: n_common + 2, 1] = np.arange(n_common) >> 8, np.arange(n_common) & 255
    code[n_common + 2:, 0] = OTHER[0]
    code[n_common + 2:, 1:] = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
    lengths = [size[c + 1] for c in columns]
    bounds = np.concatenate([[0], np.cumsum(sum(lengths))]).astype(np.int64)
    out, start = np.empty(bounds[-1], np.uint8), bounds[:-1].copy()
    for c, length in zip(columns, lengths):
        for j in range(9):
            some = np.flatnonzero(length > j)
            if not len(some):
                break
            out[start[some] + j] = code[c[some] + 1, j]
        start += length
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(bounds), pa.py_buffer(out)])


def count_windows(docs: DataFrame, words: DataFrame, seed: int, longest: int, least_count: int) -> DataFrame:
    """(window, n): the windows of ``longest`` words, each as bytes, that start with a word that may be frequent."""
    frequent = words.where(F.col("n") >= least_count)
    top = common_words(words, least_count).toPandas()
    common, order = top["hash"].to_numpy(np.int64).view(np.uint64), top["code"].to_numpy(np.int64)
    by_hash = np.argsort(common)
    shared = docs.sparkSession.sparkContext.broadcast((common[by_hash], order[by_hash], bloom_of_hashes(frequent, "hash")))

    def run(batches):
        known, ranks, bits = shared.value
        for lang, texts in by_language(batches):
            words, at, piece = words_in_pieces(texts)
            if not len(at):
                continue
            hashes = hashed(words, lang, seed)
            numbers = word_codes(hashes, known, ranks, bits)
            # Windows as local numbers: 0 pads, 1 is rare, others follow; so many bits hold one.
            local = np.where(numbers == 0, 0, np.arange(len(words)) + 1)
            width = int(len(words) + 2).bit_length()
            lead, past = local[at] + 1, np.zeros(len(at), bool)
            parts = [lead]
            for k in range(1, longest):
                same = np.zeros(len(at), bool)
                same[:-k] = piece[k:] == piece[:-k]
                following = np.zeros(len(at), np.int64)
                following[:-k] = lead[k:]
                past |= parts[-1] == 1  # after a rare word no phrase goes on
                parts.append(np.where(same & ~past, following, 0))
            starts = parts[0] > 1
            parts = [p[starts] for p in parts]
            if not len(parts[0]):
                continue
            if width * longest < 64:
                key = np.zeros(len(parts[0]), np.int64)
                for p in parts:
                    key = (key << width) | p
                found, n = np.unique(key, return_counts=True)
                some = [(found >> (width * (longest - 1 - k))) & ((1 << width) - 1) for k in range(longest)]
            else:
                frame = pd.DataFrame(dict(enumerate(parts))).value_counts(sort=False)
                some, n = [frame.index.get_level_values(k).to_numpy() for k in range(longest)], frame.to_numpy()
            of_local = np.concatenate([[-1, 0], numbers])
            coded, n = encoded([of_local[s] for s in some], hashes, len(known)), n.astype(np.int64)
            for low in range(0, len(n), 200_000):
                yield pa.RecordBatch.from_arrays([coded.slice(low, 200_000).cast(pa.binary()), pa.array(n[low: low + 200_000])],
                                                 names=["window", "n"])

    return docs.mapInArrow(run, "window binary, n long").groupBy("window").agg(F.sum("n").alias("n"))


def common_words(words: DataFrame, least_count: int) -> DataFrame:
    """(hash, code) of the most frequent words, ``COMMON`` at most."""
    top = words.where(F.col("n") >= least_count).orderBy(F.desc("n"), "hash").limit(COMMON).select("hash", "n")
    return top.select("hash", (F.row_number().over(Window.orderBy(F.desc("n"), "hash")) - 1).alias("code"))


def with_prefixes(windows: DataFrame, longest: int) -> DataFrame:
    """(p1, ..., n): the prefixes of each window, null from the first padded or rare word on. One step a word."""
    out = windows.withColumn("upto", F.lit(0))
    for k in range(1, longest + 1):
        head = F.expr("substring(window, upto + 1, 1)")
        out = out.withColumn("size", F.when(head == F.lit(OTHER), 9).when(head.isin(PAD, RARE), 1).otherwise(2))
        out = out.withColumn("upto", F.col("upto") + F.col("size"))
        out = out.withColumn(f"p{k}", F.when(F.col("size") > 1, F.expr("substring(window, 1, upto)")))
    return out.select(*[f"p{k}" for k in range(1, longest + 1)], "n")


def split_phrase(rows: DataFrame, phrase: str, words: int) -> DataFrame:
    """``rows`` with the codes of ``phrase``, which has so many words, in an array. One step a word, so none is done twice."""
    out = rows.withColumn("rest", F.col(phrase))
    for k in range(words):
        size = F.when(F.expr("substring(rest, 1, 1)") == F.lit(OTHER), 9).otherwise(2)
        out = out.withColumn("size", size).withColumn(f"code{k}", F.expr("substring(rest, 1, size)"))
        out = out.withColumn("rest", F.expr("substring(rest, size + 1)"))
    return out.select(*rows.columns, F.array(*[f"code{k}" for k in range(words)]).alias("words"))


def count_phrases(windows: DataFrame, longest: int, least_count: int) -> DataFrame:
    """(phrase, words, size, n) of all phrases of one to ``longest`` words that occur often enough; words as codes.

    ROLLUP sums over the prefixes of windows, from the second longest to the first word.
    """
    names, windows = [f"p{k}" for k in range(1, longest + 1)], with_prefixes(windows, longest)
    often = F.col("n") >= least_count
    sums = windows.rollup(*names[:-1]).agg(F.sum("n").alias("n"), F.grouping_id().alias("level")).where(often)
    out = None
    for k in range(1, longest + 1):
        # With k words the last longest - 1 - k columns are summed over, and the longest windows are counted as they are.
        of_level = windows.where(often) if k == longest else sums.where(F.col("level") == (1 << (longest - 1 - k)) - 1)
        part = of_level.where(F.col(names[k - 1]).isNotNull()).select(F.col(names[k - 1]).alias("phrase"), "n")
        part = split_phrase(part, "phrase", k).select("phrase", "words", F.lit(k).alias("size"), "n")
        out = part if out is None else out.union(part)
    return out


def phrase_key(words: Column) -> Column:
    """One binary for the words; codes are prefix-free, so no two phrases share one."""
    return F.aggregate(words, F.lit(b"").cast("binary"), lambda a, b: F.concat(a, b))


def score_phrases(phrases: DataFrame, longest: int) -> DataFrame:
    """(phrase, words, size, a, l, r, score): each phrase of two words or more at its lowest-scoring cut."""
    counts = phrases.select(F.col("phrase").alias("part"), F.col("n").alias("part_n"))
    cuts = phrases.where("size > 1").select("phrase", "words", "size", "n", F.explode(
        F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("*", phrase_key(F.slice("words", 1, F.col("k"))).alias("first"),
                       phrase_key(F.slice("words", F.col("k") + 1, F.col("size") - F.col("k"))).alias("rest"))
    cuts = cuts.join(counts.withColumnRenamed("part", "first").withColumnRenamed("part_n", "l"), "first")
    cuts = cuts.join(counts.withColumnRenamed("part", "rest").withColumnRenamed("part_n", "r"), "rest")
    # Decimals of 7 + 13 + 13 and 13 + 13 digits.
    exact = (f"(cast({SCALE} as decimal(7,0)) * cast(n as decimal(13,0)) * cast(n as decimal(13,0)))"
             " div (cast(l as decimal(13,0)) * cast(r as decimal(13,0)))")
    cuts = cuts.withColumn("score", F.expr(exact).cast("long"))
    best = cuts.groupBy("phrase").agg(F.min(F.struct("score", "k", "l", "r", "words", "size", "n")).alias("b"))
    return best.select("phrase", "b.words", "b.size", F.col("b.n").alias("a"), "b.l", "b.r", "b.score")


def without_covered(scored: DataFrame, share: int) -> DataFrame:
    """Candidates without those inside a longer one that occurs at least ``share`` percent as often."""
    inside = scored.where("size > 2").select("a", F.explode(F.expr(
        "flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1), i -> slice(words, i, m))))")).alias("words"))
    longer = inside.groupBy(phrase_key(F.col("words")).alias("phrase")).agg(F.max("a").alias("longer"))
    return scored.join(longer, "phrase", "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a"))).drop("longer")


def collocations(docs: DataFrame, longest: int = 3, least_count: int = 10, share: int = 50, top: int = 2000,
                 text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the ``top`` phrases of every language."""
    plain = docs.select(F.col(lang_column).cast("string").alias("lang"), F.col(text_column).cast("string").alias("text"))
    words, seed = word_table(plain)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    # Written, since the whole windows and the sums of their prefixes both read them.
    path = scratch_path(docs.sparkSession, "windows")
    count_windows(plain, words, seed, longest, least_count).write.option("compression", "zstd").parquet(path)
    windows = docs.sparkSession.read.schema("window binary, n long").parquet(path)
    phrases = land(count_phrases(windows, longest, least_count), "phrases")
    kept = without_covered(land(score_phrases(phrases, longest), "scored"), share)

    # Codes back to words; all words of a phrase have one language.
    codes = common_words(words, least_count).select("hash", F.unhex(F.lpad(F.hex("code"), 4, "0")).alias("code"))
    names = words.where(F.col("n") >= least_count).join(codes, "hash", "left").select(
        F.coalesce("code", F.concat(F.lit(OTHER), F.unhex(F.lpad(F.hex("hash"), 16, "0")))).alias("code"), "lang", "word")
    spelt = kept.select("phrase", "a", "l", "r", "score", F.posexplode("words").alias("i", "code")).join(names, "code")
    spelt = spelt.groupBy("phrase", "a", "l", "r", "score", "lang").agg(
        F.array_sort(F.collect_list(F.struct("i", "word"))).alias("words"))
    spelt = spelt.select("lang", F.array_join("words.word", " ").alias("phrase"), "a", "l", "r", "score")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = spelt.withColumn("rank", rank).where(F.col("rank") <= top).withColumn("rank", F.col("rank").cast("long"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
