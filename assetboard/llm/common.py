"""Helpers shared by the operators: reading, one numbering in range-free blocks, and cutting text."""

from __future__ import annotations

import ctypes
import gc

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of a Bloom filter, whatever the input; it is the most that a filter can broadcast (2 MB).
BLOOM_BITS = 1 << 24
WORD = r"[^\x20\x09-\x0D]+"


_KEEPERS: dict[str, object] = {}


def give_back() -> None:
    """Give memory that Python, Arrow and the C library hold without need back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the GNU library has it
    if trim is not None:
        trim(0)


def claim(owner: str, forget=lambda: None) -> None:
    """Free what other operators keep in this worker, which lives on from stage to stage; ``forget`` frees the owner's."""
    others = [k for k in _KEEPERS if k != owner]
    for other in others:
        _KEEPERS.pop(other)()
    if others:
        give_back()
    _KEEPERS[owner] = forget


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that the table does not have."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column | str) -> Column:
    """Words of a text, in order; none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({WORD})"), 1)


def text_bytes(text: Column | str) -> Column:
    return F.octet_length(F.encode(text, "UTF-8"))


def blocks_for(rows: int, per_block: int) -> int:
    """Number of blocks that hold about ``per_block`` rows each."""
    return max(1, -(-int(rows) // per_block))


def slices(column: pa.Array, most_bytes: int):
    """Cut a text column into runs of rows with about ``most_bytes`` bytes each; every row is in one run."""
    lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(column), 0), dtype=np.int64)
    run = np.cumsum(lengths) // most_bytes
    cuts = np.flatnonzero(np.diff(run)) + 1
    for start, stop in zip([0, *cuts], [*cuts, len(column)]):
        if stop > start:
            yield int(start), int(stop)


def utf8_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a column's rows, one after the other, and where each row starts (one more at the end)."""
    column = pa.compute.fill_null(column.cast(pa.large_string()), "")
    if column.offset or len(column) == 0:
        column = pa.concat_arrays([column, pa.array([""], pa.large_string())]).slice(0, len(column))
    starts = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[starts[0]: starts[-1]], starts - starts[0]


def is_gap(raw: np.ndarray) -> np.ndarray:
    """Which bytes are white space of ASCII."""
    return (raw == 32) | ((raw >= 9) & (raw <= 13))


def safe_cuts(raw: np.ndarray) -> np.ndarray:
    """Byte positions where white space of ASCII follows a character that is surely none.

    No token of a tokenizer that splits words from white space crosses such a position, and what lies
    right of it is split without regard to the left: a text may be encoded in parts there.
    """
    gap = is_gap(raw)
    at = np.flatnonzero(gap[1:] & ~gap[:-1]) + 1
    before = raw[at - 1]
    lead2 = raw[np.maximum(at - 2, 0)]
    lead3 = raw[np.maximum(at - 3, 0)]
    # U+0085 and U+00A0 start with C2; the other white space beyond ASCII with E1, E2 or E3.
    doubtful = (before >= 0x80) & ((lead2 == 0xC2) | ((lead3 >= 0xE1) & (lead3 <= 0xE3) & (lead2 >= 0x80)))
    return at[(before > 32) & (before != 127) & ~doubtful]


def bounds_at(size: int, *places: np.ndarray) -> np.ndarray:
    """All given places in a buffer of ``size`` bytes, once each and in order."""
    flags = np.zeros(size + 1, bool)
    for some in places:
        flags[some] = True
    return np.flatnonzero(flags)


def cut_texts(column: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Every text cut at its safe positions: the parts, by a dictionary of distinct ones, and parts per row."""
    raw, starts = utf8_buffer(column)
    bounds = bounds_at(len(raw), starts, safe_cuts(raw))
    parts = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(raw)])
    per_row = np.diff(np.searchsorted(bounds, starts))
    return parts.dictionary_encode(), per_row


def sums_per_row(values: np.ndarray, per_row: np.ndarray) -> np.ndarray:
    """Sums of consecutive values, ``per_row[i]`` of them for row ``i``."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(per_row)
    return total[ends] - total[ends - per_row]


def bloom(values: DataFrame, column: str, bits: int = BLOOM_BITS) -> np.ndarray:
    """A filter of fixed size: bits set for every value. When it fills up it passes more, never less."""
    return set_bits(values, F.xxhash64(column), bits)


def set_bits(values: DataFrame, hashes: Column, bits: int) -> np.ndarray:
    """Bits set at every hash, as 32-bit words; they come to the driver as Arrow batches, not as rows."""
    at = F.pmod(hashes, F.lit(bits))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (at % 32).cast("int"))
    words = values.select(F.floor(at / 32).cast("int").alias("word"), bit.alias("bit")).groupBy("word").agg(
        F.bit_or("bit").alias("bit")).toArrow()
    out = np.zeros(bits // 32, np.uint32)
    out[words["word"].to_numpy()] = words["bit"].to_numpy().astype(np.uint32)
    return out


def maybe_in(rows: DataFrame, column: str, words: np.ndarray) -> Column:
    """Whether a row's value may be in a filter."""
    shared, bits = rows.sparkSession.sparkContext.broadcast(words), 32 * len(words)

    @F.pandas_udf("boolean")
    def member(position: pd.Series) -> pd.Series:
        p = position.to_numpy(np.int64)
        return pd.Series((shared.value[p >> 5] >> (p & 31).astype(np.uint32)) & np.uint32(1) == 1)

    return member(F.pmod(F.xxhash64(column), F.lit(bits)))


def bloom_of_hashes(values: DataFrame, column: str, bits: int = BLOOM_BITS) -> np.ndarray:
    """Like ``bloom`` for a column that holds hashes already, so that tasks can ask it with ``in_bits``."""
    return set_bits(values, F.col(column), bits)


def in_bits(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Which 64-bit hashes may be in a filter of ``bloom_of_hashes``."""
    position = hashes.view(np.int64) % (32 * len(words))
    return (words[position >> 5] >> (position & 31).astype(np.uint32)) & np.uint32(1) == 1
