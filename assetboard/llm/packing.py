"""Documents packed into training sequences under limits on tokens, segments and loss-bearing tokens.

A document's ids are those of the tokenizer plus an end id. A document is cut every ``length`` ids; full
pieces are sequences of their own, the rest is packed by vector bin packing: a sequence is opened, and as
long as a piece fits all limits, the one whose demand has the highest dot product with the sequence's
residual capacity joins it. Pieces are dealt by hash into parts of about ``pieces_per_part``, which are
packed apart; a part leaves at most a few sequences short. The loss-bearing tokens of a piece are all
but its first, which nothing in the sequence predicts.

Null texts count as empty: one piece with the end id. Repeated rows are packed one by one. An empty table
gives an empty result. Other columns are ignored. A sequence is padded to ``length``, unless its tokens
are a power of two. Ids are made once, in one pass over the texts; what travels further is a row a piece.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assetboard.llm.common import blocks_for, claim, cut_texts, give_back, slices, sums_per_row
from assetboard.session import land

LENGTH = 4096
MOST_SEGMENTS = 512
PIECES_PER_PART = 4096
#: Parts whose ids a worker keeps, with bytes and ids of one at most: 38 MB, whatever it meets.
CACHE_SLOTS, KEY_BYTES, KEY_IDS = 1 << 19, 32, 8
SLICE_BYTES = 1_000_000
_ENCODERS: dict[str, "IdEncoder"] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class IdEncoder:
    """One tokenizer of a worker, and a table of fixed size with the ids of parts it met; newer parts replace older ones.

    A part has one slot, by a hash of its bytes, and is known only if all its bytes stand there. Parts over
    ``KEY_BYTES`` bytes or ``KEY_IDS`` ids are encoded wherever a slice has them.
    """

    def __init__(self, path: str, slots: int = CACHE_SLOTS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.keys = np.zeros((slots, KEY_BYTES // 8), np.uint64)
        self.sizes = np.zeros(slots, np.int8)  # 0 where a slot is empty: a part has a byte at least
        self.counts = np.zeros(slots, np.int8)
        self.ids = np.zeros((slots, KEY_IDS), np.int32)

    def tokens(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts and the number of each, by the tokenizer.

        A thousand are encoded at a time, joined by spaces: white space ends a token, so ids stay the same.
        """
        ids, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for at in range(0, len(parts), 1000):
            texts = [p.decode() for p in parts.slice(at, 1000).to_pylist()]
            encoded = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
            stops = np.cumsum([len(t) + 1 for t in texts])
            starts = np.array([s for s, _ in encoded.offsets], dtype=np.int64)
            counts.append(np.bincount(np.searchsorted(stops, starts, side="right"), minlength=len(texts)))
            ids.append(np.array(encoded.ids, dtype=np.int32))
        return np.concatenate(ids), np.concatenate(counts)

    def ids_of(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all distinct parts and the number of each; those that are not in the table go into it."""
        keys, sizes = padded(parts)
        slot = slots_of(keys, sizes, len(self.sizes))
        short = sizes <= KEY_BYTES
        known = short & (self.sizes[slot] == sizes) & (self.keys[slot] == keys).all(axis=1)
        new = np.flatnonzero(~known)
        made, counts_made = self.tokens(parts.take(pa.array(new)))
        counts = self.counts[slot].astype(np.int64)
        counts[new] = counts_made
        ids = np.zeros(counts.sum() + KEY_IDS, np.int32)  # so much longer that KEY_IDS can be read from any start
        old = np.repeat(known, counts)
        ids[:len(old)][~old] = made
        ids[:len(old)][old] = self.ids[slot[known]][np.arange(KEY_IDS) < counts[known][:, None]]
        kept = new[short[new] & (counts_made <= KEY_IDS)]
        kept = kept[np.unique(slot[kept], return_index=True)[1]]
        at, first = slot[kept], (np.cumsum(counts) - counts)[kept]
        self.keys[at], self.sizes[at], self.counts[at] = keys[kept], sizes[kept], counts[kept]
        self.ids[at] = ids[first[:, None] + np.arange(KEY_IDS)]
        return ids, counts

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one text after the other, and the number of ids of each."""
        parts, per_row = cut_texts(texts)
        ids, counts = self.ids_of(parts.dictionary)
        starts = np.cumsum(counts) - counts
        places = np.asarray(parts.indices)
        lengths = counts[places]
        # Position among the parts' ids of every id: a run of consecutive places for each part.
        at = np.repeat(starts[places] - (np.cumsum(lengths) - lengths), lengths)
        at += np.arange(len(at))
        return ids[at], sums_per_row(lengths, per_row)


def padded(parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The first ``KEY_BYTES`` bytes of every part as 64-bit words, zeros after its end, and its bytes."""
    bounds = np.frombuffer(parts.buffers()[1], dtype=np.int64)[parts.offset: parts.offset + len(parts) + 1]
    sizes = np.diff(bounds)
    data = parts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    raw = np.concatenate([raw, np.zeros(KEY_BYTES, np.uint8)])
    block = np.lib.stride_tricks.sliding_window_view(raw, KEY_BYTES)[bounds[:-1]]
    block[np.arange(KEY_BYTES) >= sizes[:, None]] = 0
    return block.view(np.uint64), sizes


def slots_of(keys: np.ndarray, sizes: np.ndarray, slots: int) -> np.ndarray:
    h = sizes.astype(np.uint64)
    for word in keys.T:
        h = (h ^ word) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h % np.uint64(slots)).astype(np.int64)


def encoder(path: str) -> IdEncoder:
    claim("packing", _ENCODERS.clear)
    if path not in _ENCODERS:
        _ENCODERS[path] = IdEncoder(path)
    return _ENCODERS[path]


def pieces_of(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, end_id: int = 2,
              id_column: str = "doc_id", text_column: str = "text", slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens) of every piece of every row."""
    path = tokenizer or default_tokenizer()

    def run(batches):
        enc = encoder(path)
        for batch in batches:
            for start, stop in slices(batch.column(1), slice_bytes):
                ids, counts = enc.encode(batch.column(1).slice(start, stop - start))
                stops = np.cumsum(counts)
                row, first, size, crc, tokens = [], [], [], [], []
                for i, (end, count) in enumerate(zip(stops.tolist(), counts.tolist())):
                    own = np.append(ids[end - count: end], end_id).astype("<u4")
                    for cut in range(0, count + 1, length):
                        piece = own[cut: cut + length]
                        row.append(start + i)
                        first.append(cut)
                        size.append(len(piece))
                        crc.append(zlib.crc32(piece))
                        tokens.append(count + 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row, pa.int64())),
                     *(pa.array(x, pa.int64()) for x in (first, size, crc, tokens))],
                    names=[id_column, "start", "length", "ids_crc32", "doc_tokens"])
        give_back()  # the worker lives on through other stages

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, text_column).mapInArrow(
        run, f"{id_column} {kind}, start long, length long, ids_crc32 long, doc_tokens long")


def fill(demand: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bin and place in it of every item; ``demand`` holds tokens first, then the other limited amounts."""
    order = np.argsort(-demand[:, 0], kind="stable")
    whole = np.ascontiguousarray(demand[order], dtype=np.float64)
    need = whole / limits
    others = [np.ascontiguousarray(x) for x in whole[:, 1:].T]
    smaller = -whole[:, 0]  # ascending, so the items that fit in tokens are a tail
    free = np.ones(len(order), bool)
    bins = np.zeros(len(order), dtype=np.int64)
    offsets = np.zeros(len(order), dtype=np.int64)
    number, waiting = 0, len(order)
    while waiting:
        residual = limits.astype(np.float64)
        start = int(np.argmax(free))
        while start < len(order):
            fits = free[start:].copy()
            for amount, left in zip(others, residual[1:]):
                fits &= amount[start:] <= left
            value = np.where(fits, need[start:] @ (residual / limits), -1.0)
            best = int(np.argmax(value))
            if value[best] < 0:
                break
            item = start + best
            bins[order[item]], offsets[order[item]] = number, limits[0] - residual[0]
            residual -= whole[item]
            free[item] = False
            waiting -= 1
            start = int(np.searchsorted(smaller, -residual[0], side="left"))
        number += 1
    return bins, offsets


def pack(pieces: DataFrame, length: int = LENGTH, most_segments: int = MOST_SEGMENTS, most_loss: int | None = None,
         id_column: str = "doc_id", pieces_per_part: int = PIECES_PER_PART) -> DataFrame:
    """Pieces with their ``sequence_id`` and ``offset``; ids of sequences are gapless from 0."""
    limits = np.array([length, most_segments, most_loss or length])
    parts = blocks_for(pieces.count(), pieces_per_part)
    dealt = pieces.withColumn("part", F.pmod(F.xxhash64(id_column, "start", "ids_crc32"), F.lit(parts)).cast("int"))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["length", "ids_crc32", "start", id_column], kind="stable", ignore_index=True)
        tokens = part["length"].to_numpy()
        loss = np.maximum(tokens - 1, 0)
        if (tokens > limits[0]).any() or (loss > limits[2]).any():
            raise ValueError("a piece is over a limit of its sequence")
        part["local"], part["offset"] = fill(np.stack([tokens, np.ones_like(tokens), loss], axis=1), limits)
        return part

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema)
    packed = land(dealt.groupBy("part").applyInPandas(run, f"{fields}, local long, offset long"), "packed")
    sizes = packed.groupBy("part").agg((F.max("local") + 1).alias("n"))
    starts = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    return packed.join(starts, "part").withColumn("sequence_id", F.col("before") + F.col("local")).drop(
        "part", "local", "before")


def pack_documents(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, most_loss: int | None = None,
                   **options) -> DataFrame:
    """Pieces of all documents, placed in sequences; a piece is cut where it would pass the lower of both limits."""
    cut = length if most_loss is None else min(length, most_loss + 1)
    return pack(land(pieces_of(docs, tokenizer, cut), "pieces"), length=length, most_loss=most_loss, **options)
