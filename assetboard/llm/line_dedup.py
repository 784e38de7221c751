"""Repeated passages deleted by winnowing over hashes of lines.

A line is ``line_words`` consecutive words (A-Z in lower case), from any word on, so that it does not depend
on how a page was wrapped. Of every ``window`` consecutive lines the one with the least hash is a
fingerprint; two texts that share at least line_words + window - 1 words in a row (50) share a fingerprint
in them. Each passage of ``least_words`` words that has an earlier occurrence, anywhere, in order of ids and
places, leaves. So every repeated passage is found whichever texts share it, and nothing else leaves: the
union of all passages of ``least_words`` words that occur earlier. The first occurrence always stays.

Each fingerprint carries a hash of its surroundings, the words of all passages that hold it. Of places with
equal surroundings all passages leave but at the first. A fingerprint with one kind of surroundings is then
done; of one with several, the passages around the first place of each kind are hashed and compared with one
another, since an equal passage may lie in other surroundings. So the inside of a copy costs a row for each
fingerprint, and only where copies begin, end or differ does it cost one for each word. Occurrences are compared
by hash with the first one alone, which loses nothing since equal passages are equal to their first. Texts are
moved only where a fixed-size Bloom filter says they take part.

Texts without words, null texts and texts shorter than a passage stay as they are. A text whose words all
leave is dropped, which is what happens to later copies of a whole text. Rows with the same id and text
count as one document. Null ids come first in order. All columns are returned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetboard.llm.common import bloom, claim, fresh, is_gap, maybe_in, slices, utf8_buffer
from assetboard.llm.suffix_lm import word_hashes
from assetboard.session import land

LINE_WORDS, WINDOW, LEAST_WORDS = 24, 27, 50
SLICE_BYTES = 2_000_000
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1), modulo 2 ** 64."""
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), 1 << 64))])
    return out[:n]


def mixed(code: np.ndarray) -> np.ndarray:
    """Sums of powers as hashes whose order says nothing."""
    code = (code ^ (code >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return code ^ (code >> np.uint64(29))


def line_hashes(words: np.ndarray, line_words: int, up: np.ndarray, down: np.ndarray) -> np.ndarray:
    """Hash of the line that starts at each word."""
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * up[: len(words)])])
    return mixed((prefix[line_words:] - prefix[:-line_words]) * down[: len(words) - line_words + 1])


def sliding(x: np.ndarray, width: int, what) -> np.ndarray:
    """Least or highest value of every ``width`` consecutive ones, by doubling."""
    size, out = 1, x
    while 2 * size <= width:
        out = what(out[:-size], out[size:])
        size *= 2
    return what(out[: len(x) - width + 1], out[width - size:]) if size < width else out


def fingerprints(hashes: np.ndarray, window: int) -> np.ndarray:
    """Places whose hash is the least of some window."""
    if len(hashes) <= window:
        return np.flatnonzero(hashes == hashes.min())[:1] if len(hashes) else np.zeros(0, np.int64)
    least = sliding(hashes, window, np.minimum)
    padded = np.concatenate([np.zeros(window - 1, np.uint64), least, np.zeros(window - 1, np.uint64)])
    return np.flatnonzero(sliding(padded, window, np.maximum) == hashes)


def words_of(batches, column: int | str = 1):
    """Word hashes of every slice of every batch: (batch, first row, hashes, where each row starts and the last ends)."""
    claim("line_dedup")
    for batch in batches:
        texts = pa.compute.fill_null(batch.column(column), "")
        for start, stop in slices(texts, SLICE_BYTES):
            hashes, places, rows = word_hashes(texts.slice(start, stop - start))
            yield batch, start, hashes.view(np.uint64)[places], np.searchsorted(rows, np.arange(stop - start + 1))


def texts_of(batches, column: int | str = 1):
    """Word hashes of every row of every batch: (batch, row, hashes)."""
    for batch, start, words, cuts in words_of(batches, column):
        yield batch, start, [words[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def marks_of(words: np.ndarray, cuts: np.ndarray, line_words: int, window: int, width: int, up: np.ndarray,
             down: np.ndarray) -> tuple[np.ndarray, ...]:
    """Fingerprints of rows of at least ``width`` words: row, place in it, hash, words and hash of the surroundings."""
    full = line_words + window - 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * up[: len(words)])])
    lines = mixed((sums[line_words:] - sums[:-line_words]) * down[: max(len(words) - line_words + 1, 0)])
    sizes = np.diff(cuts)
    places = [np.zeros(0, np.int64)]
    if len(words) >= full:
        least = sliding(lines, window, np.minimum)
        row = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        least[row[: len(least)] != row[full - 1:]] = 0  # not all in one text
        edge = np.zeros(window - 1, np.uint64)
        places.append(np.flatnonzero(sliding(np.concatenate([edge, least, edge]), window, np.maximum) == lines))
    for i in np.flatnonzero((sizes >= width) & (sizes < full)):  # no full window
        places.append(cuts[i] + fingerprints(lines[cuts[i]: cuts[i + 1] - line_words + 1], window))
    at = np.concatenate(places)
    row = np.searchsorted(cuts, at, side="right") - 1
    long = sizes[row] >= width
    at, row = at[long], row[long]
    first, stop = np.maximum(at + line_words - width, cuts[row]), np.minimum(at + width, cuts[row + 1])
    around = mixed((sums[stop] - sums[first]) * down[first] + (at - first).astype(np.uint64) * np.uint64(_INVERSE))
    return row, at - cuts[row], lines[at], stop - first, around


def marked(docs: DataFrame, line_words: int, window: int, width: int) -> DataFrame:
    """(hash, around, id, key, place, size) of all fingerprints of texts that may hold a passage.

    ``around`` is the hash of the ``size`` words that the passages of ``width`` words with the fingerprint cover.
    """
    def run(batches):
        up, down = powers(_BASE, 1 << 12), powers(_INVERSE, 1 << 12)
        for batch, start, words, cuts in words_of(batches, 2):
            if len(words) >= len(up):
                up, down = powers(_BASE, 2 * len(words)), powers(_INVERSE, 2 * len(words))
            row, place, code, size, around = marks_of(words, cuts, line_words, window, width, up, down)
            row = pa.array(start + row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(code.view(np.int64)), pa.array(around.view(np.int64)), batch.column(0).take(row),
                 batch.column(1).take(row), pa.array(place.astype(np.int32)), pa.array(size.astype(np.int32))],
                names=["hash", "around", "id", "key", "place", "size"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "key", "text").mapInArrow(
        run, f"hash long, around long, id {kind}, key long, place int, size int")


def passages(texts: DataFrame, line_words: int, width: int) -> DataFrame:
    """(hash, id, key, place) of all passages of ``width`` words that hold a line at one of the text's ``places``."""
    def run(batches):
        up, down = powers(_BASE, 1 << 12), powers(_INVERSE, 1 << 12)
        for batch, start, some in texts_of(batches, 2):
            row, place, code = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
            marks = batch.column(3).slice(start, len(some))
            cuts, marks = np.asarray(marks.offsets) - marks.offsets[0].as_py(), marks.flatten().to_numpy()
            for i, words in enumerate(some):
                if len(words) > len(up):
                    up, down = powers(_BASE, 2 * len(words)), powers(_INVERSE, 2 * len(words))
                at = marks[cuts[i]: cuts[i + 1]]
                near = np.zeros(len(words) + 2, np.int64)
                np.add.at(near, np.maximum(at + line_words - width, 0), 1)
                np.add.at(near, at + 1, -1)
                starts = np.flatnonzero(np.cumsum(near)[: len(words) - width + 1] > 0)
                row.append(np.full(len(starts), start + i))
                place.append(starts)
                code.append(line_hashes(words, width, up, down)[starts])
            rows = pa.array(np.concatenate(row))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(code).view(np.int64)), batch.column(0).take(rows), batch.column(1).take(rows),
                 pa.array(np.concatenate(place).astype(np.int32))], names=["hash", "id", "key", "place"])

    kind = texts.schema["id"].dataType.simpleString()
    return texts.select("id", "key", "text", "places").mapInArrow(run, f"hash long, id {kind}, key long, place int")


def first_of_repeated(rows: DataFrame) -> DataFrame:
    """(hash, first) of the hashes with several places."""
    place = F.struct("id", "key", "place")
    return rows.groupBy("hash").agg(F.min(place).alias("first"), F.max(place).alias("last")).where(
        "first <> last").select("hash", "first")


def later_passages(plain: DataFrame, line_words: int, window: int, width: int) -> DataFrame:
    """(key, start, size) of stretches that cover, text by text, the passages of ``width`` words that occur earlier."""
    marks = land(marked(plain, line_words, window, width), "fingerprints")
    shared = land(marks.groupBy("hash").count().where("count > 1").select("hash"), "repeated")
    # A first pass drops most fingerprints that occur once, before they are shuffled for the join.
    may = maybe_in(marks, "hash", bloom(shared, "hash"))
    near = land(marks.where(may).join(shared, "hash"), "near")
    place = F.struct("id", "key", "place")
    kinds = land(near.groupBy("around").agg(
        F.min("hash").alias("hash"), F.min(place).alias("first"), F.max(place).alias("last")), "surroundings")
    start = F.greatest(F.col("place") + (line_words - width), F.lit(0)).alias("start")
    copies = near.join(kinds.where("first <> last").select("around", "first"), "around").where(
        place != F.col("first")).select("key", start, "size")

    asked = kinds
    if width >= line_words + window - 1:  # equal passages then share a fingerprint: one kind holds no others
        several = land(kinds.groupBy("hash").count().where("count > 1").select("hash"), "several")  # a hot one is split
        asked = kinds.join(several, "hash")
    asked = land(asked.groupBy(F.col("first.key").alias("key")).agg(F.collect_set("first.place").alias("places")), "asked")
    whole = plain.where(maybe_in(plain, "key", bloom(asked, "key"))).join(asked, "key")
    found = land(passages(whole, line_words, width), "passages")
    firsts = land(first_of_repeated(found), "first-passages")
    may = maybe_in(found, "hash", bloom(firsts, "hash"))
    return copies.union(found.where(may).join(firsts, "hash").where(place != F.col("first")).select(
        "key", F.col("place").alias("start"), F.lit(width).alias("size")))


def removed_spans(size: int, starts: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int]]:
    """Stretches that the given ones cover."""
    cover = np.zeros(size + 2, np.int64)
    np.add.at(cover, starts + 1, 1)
    np.add.at(cover, starts + sizes + 1, -1)
    inside = np.concatenate([[0], (np.cumsum(cover)[1:-1] > 0).astype(np.int8), [0]])
    edges = np.flatnonzero(np.diff(inside))
    return [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2])]


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words in the spans, and without the white space after them."""
    raw, _ = utf8_buffer(pa.array([text], pa.large_string()))
    gap = is_gap(raw)
    starts = np.flatnonzero(~gap & np.concatenate([[True], gap[:-1]]))
    starts = np.append(starts, len(raw))
    keep = np.ones(len(raw), bool)
    for a, b in spans:
        keep[starts[a]: starts[b]] = False
    return raw[keep].tobytes().decode()


def dedup_lines(docs: DataFrame, line_words: int = LINE_WORDS, window: int = WINDOW, least_words: int = LEAST_WORDS,
                id_column: str = "doc_id", text_column: str = "text", report: bool = True) -> DataFrame:
    """All columns of the rows that keep words or had none, with the text cut, then ``spans`` and ``n_removed``.

    ``spans`` lists (start, length) in words of the original text. Without ``report`` the two are left out.
    """
    key, later = fresh(docs, "_key", "_later")
    keyed = docs.withColumn(key, F.xxhash64(id_column, text_column))
    plain = keyed.select(F.col(id_column).alias("id"), F.col(key).alias("key"), F.col(text_column).alias("text"))
    stretches = later_passages(plain, line_words, window, max(line_words, least_words))
    code = F.shiftleft(F.col("start").cast("long"), 32) + F.col("size")
    per_text = land(stretches.groupBy("key").agg(F.collect_set(code).alias(later)), "later")
    may_run = maybe_in(keyed, key, bloom(per_text, "key"))

    touched = keyed.where(may_run).join(per_text.withColumnRenamed("key", key), key, "left")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    extra = ", spans array<struct<start:int,length:int>>, n_removed long" if report else ""
    cut = touched.select(*docs.columns, later).mapInArrow(
        lambda batches: _cut(batches, text_column, report), f"{fields}{extra}")
    none = [F.expr("cast(array() as array<struct<start:int,length:int>>)").alias("spans"),
            F.lit(0).cast("long").alias("n_removed")]
    return keyed.where(~may_run).select(*docs.columns, *(none if report else [])).union(cut)


def _cut(batches, text_column: str, report: bool):
    """Rows with their repeated words deleted; the last column holds starts and sizes of repeated stretches."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))
    for batch, first, texts in texts_of(batches, text_column):
        n = len(texts)
        later = batch.column(batch.num_columns - 1).slice(first, n)
        cuts, later = np.asarray(later.offsets) - later.offsets[0].as_py(), later.flatten().to_numpy()
        column = batch.column(batch.schema.get_field_index(text_column)).slice(first, n)
        out, spans, removed, keep = [], [], [], []
        for i, words in enumerate(texts):
            text, at = column[i].as_py(), later[cuts[i]: cuts[i + 1]]
            gone = removed_spans(len(words), at >> 32, at & 0xFFFFFFFF) if len(at) else []
            count = sum(b - a for a, b in gone)
            out.append(without(text, gone) if gone else text)
            spans.append([{"start": a, "length": b - a} for a, b in gone])
            removed.append(count)
            keep.append(count < len(words) or count == 0)
        columns = [batch.column(k).slice(first, n) for k in range(batch.num_columns - 1)]
        columns[batch.schema.get_field_index(text_column)] = pa.array(out, column.type)
        made = pa.RecordBatch.from_arrays(
            [*columns, *([pa.array(spans, kind), pa.array(removed, pa.int64())] if report else [])],
            names=[*batch.schema.names[:-1], *(["spans", "n_removed"] if report else [])])
        yield made.filter(pa.array(keep))
