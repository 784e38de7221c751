"""A feed-forward network for two classes, trained by mini-batches whose gradients are summed where the rows are.

Hidden layers are rectified and thinned by dropout, the output is a sigmoid, the loss the weighted cross-entropy.
An epoch has ``steps`` mini-batches; a hash of row and epoch deals every row to one of them. The rows are dealt once
an epoch, inside their partitions and in order of the mini-batches, into a cached table whose scan passes over what
a mini-batch does not need; so an epoch reads every row about once, not once per mini-batch. Tasks add up the
gradients of their rows of a mini-batch, the driver adds those sums, as large as the network, and takes an Adam
step. Dropout is drawn from the same hashes, so a run repeats itself whatever the partitioning, but for the order
of sums. After every epoch the area under the curve of the validation rows decides whether to go on; the best
epoch's network is returned.
"""

from __future__ import annotations

import pickle
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from assetboard.operators.metrics import roc_auc
from assetboard.session import land

# Layers, shares dropped, step size.
HIDDEN, DROPOUT, RATE = (32, 16), (0.2, 0.1), 0.001


def uniform(row: np.ndarray, width: int, draw: int) -> np.ndarray:
    """Numbers from 0 to 1 for each row and unit, from hashes."""
    unit = np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(draw * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF)
    x = row.astype(np.int64).view(np.uint64)[:, None] ^ unit
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) / 2.0 ** 53


@dataclass
class Network:
    """Weights and offsets of every layer, in order."""

    layers: list[tuple[np.ndarray, np.ndarray]]

    @classmethod
    def start(cls, width: int, hidden: Sequence[int], seed: int) -> "Network":
        rng, sizes = np.random.default_rng(seed), [width, *hidden, 1]
        return cls([(rng.uniform(-1, 1, (a, b)) * np.sqrt(6 / (a + b)), np.zeros(b)) for a, b in zip(sizes, sizes[1:])])

    def forward(self, x: np.ndarray) -> np.ndarray:
        """Probability of each row."""
        for w, b in self.layers[:-1]:
            x = np.maximum(x @ w + b, 0)
        w, b = self.layers[-1]
        return 1 / (1 + np.exp(-np.clip((x @ w + b)[:, 0], -500, 500)))

    def gradients(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, masks: Sequence[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Sums of the weighted loss's slopes; ``masks`` multiply the hidden layers."""
        seen = [x]
        for (w, b), mask in zip(self.layers[:-1], masks):
            seen.append(np.maximum(seen[-1] @ w + b, 0) * mask)
        w, b = self.layers[-1]
        back = ((1 / (1 + np.exp(-np.clip((seen[-1] @ w + b)[:, 0], -500, 500))) - y) * weight)[:, None]
        out = []
        for k in range(len(self.layers) - 1, -1, -1):
            out.append((seen[k].T @ back, back.sum(axis=0)))
            if k:
                back = (back @ self.layers[k][0].T) * masks[k - 1] * (seen[k] > 0)
        return out[::-1]

    def score(self, df: DataFrame, features: str = "features", out: str = "score") -> DataFrame:
        """``df`` without its feature vector and with each row's probability."""
        rest = [c for c in df.columns if c != features]
        model = df.sparkSession.sparkContext.broadcast(self)

        def run(batches):
            for batch in batches:
                x = rows_of(batch.column(batch.num_columns - 1))
                p = model.value.forward(x) if len(x) else np.zeros(0)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(p)], names=[*rest, out])

        wide = df.select(*rest, values_of(df, features).alias(out))
        fields = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in rest), f"`{out}` double"])
        return wide.mapInArrow(run, fields)


def rows_of(lists: pa.Array) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1) if len(lists) else np.zeros((0, 0))


def values_of(df: DataFrame, features: str) -> Column:
    """The features as an array, which they may be already."""
    return F.col(features) if isinstance(df.schema[features].dataType, ArrayType) else vector_to_array(features)


def packed(table: np.ndarray, h: np.ndarray) -> bytes:
    """Rows and their hashes as bytes; columns of zeros and ones take a byte a value."""
    flags = ((table == 0) | (table == 1)).all(axis=0)
    return pickle.dumps((flags, table[:, flags].astype(np.uint8), table[:, ~flags], h), protocol=5)


def unpacked(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    flags, ones, numbers, h = pickle.loads(block)
    table = np.empty((len(h), len(flags)))
    table[:, flags], table[:, ~flags] = ones, numbers
    return table, h


def blocks_of(rows: DataFrame) -> DataFrame:
    """(width, block) of (x, y, w, h): many rows a block, their features, label and weight side by side."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = rows_of(batch.column(0))
                block = packed(np.column_stack([x, *(batch.column(i).to_numpy() for i in (1, 2))]), batch.column(3).to_numpy())
                yield pa.RecordBatch.from_arrays([pa.array([x.shape[1]], pa.int32()), pa.array([block], pa.binary())], names=["width", "block"])

    return rows.mapInArrow(run, "width int, block binary")


def dealt(blocks: DataFrame, draw: int, steps: int) -> DataFrame:
    """(step, block) of every row, in order of the mini-batches within a partition."""
    def run(batches):
        for batch in batches:
            for block in batch.column(0):
                table, h = unpacked(block.as_py())
                step = (uniform(h, 1, draw)[:, 0] * steps).astype(np.int32)
                order = np.argsort(step, kind="stable")
                found, first = np.unique(step[order], return_index=True)
                parts = [packed(table[some], h[some]) for some in np.split(order, first[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(parts, pa.binary())], names=["step", "block"])

    return blocks.select("block").mapInArrow(run, "step int, block binary").sortWithinPartitions("step")


def fit_network(train: DataFrame, validation: DataFrame, label: str, ids: Sequence[str], weight: str | None = None, features: str = "features",
                hidden: Sequence[int] = HIDDEN, dropout: Sequence[float] = DROPOUT, rate: float = RATE, epochs: int = 10, steps: int = 40,
                patience: int = 2, seed: int = 0) -> tuple[Network | None, float]:
    """The best epoch's network and its validation AUC; none without training rows.

    The training rows are written in blocks; the validation rows are read every epoch and should come from a written table.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    blocks = land(blocks_of(train.select(values_of(train, features).alias("x"), F.col(label).cast("double").alias("y"), w.alias("w"),
                                         F.xxhash64(*ids).alias("h"))), "blocks")
    width = next((r["width"] for r in blocks.select("width").take(1)), None)
    if width is None:
        return None, 0.0
    net = Network.start(width, hidden, seed)
    flat = lambda layers: [p for pair in layers for p in pair]
    mean = [np.zeros_like(p) for p in flat(net.layers)]
    square = [np.zeros_like(p) for p in mean]
    best, best_auc, waited, taken = net, -1.0, 0, 0
    for epoch in range(epochs):
        draw = seed + 7919 * epoch
        rows = dealt(blocks, draw, steps).persist()
        for step in range(steps):
            sums, n = None, 0
            run = lambda batches, m=net, d=draw: summed(batches, m, d, dropout)
            for r in rows.where(F.col("step") == step).select("block").mapInArrow(run, "sums binary").collect():
                part, count = pickle.loads(r["sums"])
                sums = part if sums is None else [a + b for a, b in zip(sums, part)]
                n += count
            if not n:
                continue
            taken += 1
            new = []
            for i, (p, g) in enumerate(zip(flat(net.layers), sums)):
                g = g / n
                mean[i] = 0.9 * mean[i] + 0.1 * g
                square[i] = 0.999 * square[i] + 0.001 * g * g
                new.append(p - rate * (mean[i] / (1 - 0.9 ** taken)) / (np.sqrt(square[i] / (1 - 0.999 ** taken)) + 1e-7))
            net = Network(list(zip(new[::2], new[1::2])))
        rows.unpersist()
        auc = roc_auc(net.score(validation.select(label, features), features), label, "score").first()[0] or 0.0
        if auc > best_auc:
            best, best_auc, waited = net, auc, 0
        else:
            waited += 1
            if waited >= patience:
                break
    return best, best_auc


def summed(batches, net: Network, draw: int, dropout: Sequence[float]):
    """One partition's sums of gradients over its rows of a mini-batch, and their number."""
    total, n = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        tables, hashes = zip(*(unpacked(block.as_py()) for block in batch.column(0)))
        table, h = np.concatenate(tables), np.concatenate(hashes)
        masks = [(uniform(h, len(b), draw + 104729 * (k + 1)) >= share) / (1 - share)
                 for k, ((_, b), share) in enumerate(zip(net.layers, dropout))]
        part = [p for pair in net.gradients(table[:, :-2], table[:, -2], table[:, -1], masks) for p in pair]
        total, n = part if total is None else [a + b for a, b in zip(total, part)], n + len(h)
    if n:
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((total, n), protocol=5)], pa.binary())], names=["sums"])
