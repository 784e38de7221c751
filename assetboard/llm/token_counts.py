"""Token counts of whole texts; huge documents by overlapping chunks that are spliced where both agree.

A text of at most ``chunk_bytes`` is encoded at once. A longer one is encoded in chunks that overlap. Two
neighbours are spliced at a position inside their overlap where both have a token boundary and which is
stable: white space follows a character that is none, so no token crosses it and nothing left of it can
change what lies right. When the overlap holds no such position it is doubled, up to the rest of the text,
and the left chunk is encoded again. Counts therefore equal those of the whole text.

Null texts count as empty (0 bytes, 0 tokens). Repeated rows stay. Columns other than the id and the text
are ignored. Each task keeps a bounded cache of parts it has seen, as most words return.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from assetboard.llm.common import claim, cut_texts, slices, sums_per_row

CHUNK_BYTES = 32_768
OVERLAP_BYTES = 512
CACHE_PARTS = 600_000
SLICE_BYTES = 4_000_000
_ENCODERS: dict[str, "Encoder"] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """One tokenizer of a worker, with the token ends of the parts it met last."""

    def __init__(self, path: str, cache_parts: int = CACHE_PARTS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.cache: dict[bytes, int] = {}
        self.cache_parts = cache_parts

    def part_counts(self, parts: list[bytes]) -> np.ndarray:
        cache = self.cache
        new = [p for p in parts if p not in cache]
        if len(cache) + len(new) > self.cache_parts:
            cache.clear()
            new = parts
        encoded = self.tokenizer.encode_batch_fast([p.decode() for p in new], add_special_tokens=False)
        cache.update(zip(new, (len(e) for e in encoded)))
        return np.fromiter((cache[p] for p in parts), dtype=np.int64, count=len(parts))

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text."""
        parts, per_row = cut_texts(texts)
        if len(parts) == 0:
            return np.zeros(len(texts), np.int64)
        each = self.part_counts(parts.dictionary.to_pylist())[np.asarray(parts.indices)]
        return sums_per_row(each, per_row)

    def boundaries(self, text: str) -> np.ndarray:
        """Character positions where the text's tokens end."""
        encoded = self.tokenizer.encode(text, add_special_tokens=False)
        return np.array([end for _, end in encoded.offsets], dtype=np.int64)


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file; tasks of one worker share its cache."""
    claim("token_counts", _ENCODERS.clear)
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def stable(text: str, at: int) -> bool:
    """Whether tokens left and right of ``at`` are split without regard to each other."""
    return 0 < at < len(text) and text[at] in " \t\n\v\f\r" and not text[at - 1].isspace() and text[at - 1] > " "


def count_by_chunks(enc: Encoder, text: str, chunk: int = CHUNK_BYTES, overlap: int = OVERLAP_BYTES) -> int:
    """Tokens of one long text, by overlapping chunks (sizes in characters)."""
    size, total, start, spliced, width = len(text), 0, 0, 0, overlap
    stop = min(size, chunk + overlap)
    ends = enc.boundaries(text[:stop])
    while stop < size:
        low = start + chunk
        right_stop = min(size, low + chunk + overlap)
        right = enc.boundaries(text[low:right_stop]) + low
        shared = np.intersect1d(ends, right)
        splice = next((int(p) for p in shared if low < p < stop and stable(text, int(p))), None)
        while splice is None and stop < size:
            width *= 2
            stop = min(size, low + width)
            ends = enc.boundaries(text[start:stop]) + start
            ends = ends[ends > spliced]
            if stop > right_stop:
                right_stop = min(size, stop + chunk)
                right = enc.boundaries(text[low:right_stop]) + low
            shared = np.intersect1d(ends, right)
            splice = next((int(p) for p in shared if low < p < stop and stable(text, int(p))), None)
        if splice is None:
            break
        total += int(np.searchsorted(ends, splice, side="right"))
        ends, start, stop, spliced, width = right[right > splice], low, right_stop, splice, overlap
    return total + len(ends)


def token_counts(docs: DataFrame, tokenizer: str | None = None, limit: int = 512, id_column: str = "doc_id",
                 text_column: str = "text", chunk_bytes: int = CHUNK_BYTES, overlap_bytes: int = OVERLAP_BYTES,
                 slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row."""
    path = tokenizer or default_tokenizer()

    def run(batches):
        enc = encoder(path)
        for batch in batches:
            ids, texts = batch.column(0), pa.compute.fill_null(batch.column(1), "")
            for start, stop in slices(texts, slice_bytes):
                part = texts.slice(start, stop - start)
                sizes = np.asarray(pa.compute.binary_length(part), dtype=np.int64)
                long = sizes > chunk_bytes
                counts = np.zeros(len(part), np.int64)
                counts[~long] = enc.counts(part.filter(pa.array(~long)))
                for i in np.flatnonzero(long):
                    counts[i] = count_by_chunks(enc, part[int(i)].as_py(), chunk_bytes, overlap_bytes)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(start, stop - start), pa.array(sizes), pa.array(counts), pa.array(counts > limit)],
                    names=[id_column, "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, text_column).mapInArrow(
        run, f"{id_column} {kind}, n_bytes long, n_tokens long, over_limit boolean")
