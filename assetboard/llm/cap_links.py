"""Near-duplicate vectors by spherical-cap filters from structured random product codes.

Filter directions are sums of two code words, one per half of a randomly rotated vector, so ``words`` code
words per half give words ** 2 filters. A vector is list-decoded to every filter whose direction it exceeds a
threshold on: ``cap`` standard deviations of a random vector's score, or its own best filter less ``slack``,
whichever is lower, so that each vector meets some filters in each of ``tables`` codes. Vectors of one label
that share a filter are compared exactly, in the first filter they share. At cosine 0.98 in 64 dimensions
the chance to share none was under 1 in 20,000 as measured.

Equal vectors of one label are one class, weighed by its rows. Small buckets are gathered into tasks by
hash; a bucket with more than ``block`` classes is compared in pairs of blocks, spread over tasks. No pairs
are put out: a block gives link counts per class and the components it sees, as (class, least class).

Vectors that are null, zero or hold null or non-finite components, those of other lengths than the most
frequent, and rows with a null label link with nothing. A repeated row is a vector like others.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetboard.llm.common import blocks_for
from assetboard.llm.components import components
from assetboard.llm.vectors import cosines, matrix, one_length, unit, usable
from assetboard.session import land

TABLES, WORDS, CAP, SLACK, BLOCK = 3, 32, 2.8, 0.4, 512


class ProductCodes:
    """Random rotations and code words; filters are numbered over all tables."""

    def __init__(self, dimension: int, tables: int, words: int, seed: int = 9):
        rng = np.random.default_rng(seed)
        self.words, self.half = words, (dimension + 1) // 2
        self.rotations = [np.linalg.qr(rng.standard_normal((2 * self.half, 2 * self.half)))[0][:dimension]
                          for _ in range(tables)]
        self.codes = [unit(rng.standard_normal((2 * words, self.half))) for _ in range(tables)]

    def decode(self, rows: np.ndarray, cap: float, slack: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) of every filter that a unit vector exceeds."""
        out_row, out_filter = [], []
        for t, (rotation, code) in enumerate(zip(self.rotations, self.codes)):
            turned = rows @ rotation
            first = turned[:, : self.half] @ code[: self.words].T
            second = turned[:, self.half:] @ code[self.words:].T
            score = (first[:, :, None] + second[:, None, :]).reshape(len(rows), -1) * np.sqrt(self.half)
            limit = np.minimum(cap, score.max(axis=1) - slack)
            row, direction = np.nonzero(score >= limit[:, None])
            out_row.append(row)
            out_filter.append(direction + t * self.words ** 2)
        row, direction = np.concatenate(out_row), np.concatenate(out_filter)
        order = np.lexsort((direction, row))
        return row[order], direction[order]


def linked(vectors_a: np.ndarray, vectors_b: np.ndarray, least: float) -> np.ndarray:
    """Which pairs reach the cosine; pairs close to the limit are taken again in one fixed order of sums."""
    scores = unit(vectors_a) @ unit(vectors_b).T
    out = scores >= least
    i, j = np.nonzero(np.abs(scores - least) < 1e-9)
    if len(i):
        out[i, j] = cosines(vectors_a[i], vectors_b[j]) >= least
    return out


def shares_earlier(filters_a: list, filters_b: list, this: int) -> np.ndarray:
    """Which pairs also share a filter of a smaller number."""
    earlier = np.unique(np.concatenate([np.zeros(0, np.int64), *[f[f < this] for f in filters_a]]))
    if not len(earlier):
        return np.zeros((len(filters_a), len(filters_b)), bool)

    def held(filters):
        out = np.zeros((len(filters), len(earlier)), np.float32)
        for i, f in enumerate(filters):
            at = np.searchsorted(earlier, f[f < this])
            some = at < len(earlier)
            at, own = at[some], f[f < this][some]
            out[i, at[earlier[at] == own]] = 1
        return out

    return held(filters_a) @ held(filters_b).T > 0


def least_linked(link: np.ndarray) -> np.ndarray:
    """Least member of the component of each member, by a symmetric matrix of links."""
    label = np.arange(len(link))
    while True:
        near = np.where(link, label[None, :], len(link)).min(axis=1, initial=len(link))
        new = np.minimum(label, near)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def compare_bucket(bucket: int, node: np.ndarray, weight: np.ndarray, vectors: np.ndarray, filters: list,
                   side: np.ndarray | None, least: float):
    """(class, links, least class) of the classes that have links in one bucket, or between two of its blocks."""
    link = linked(vectors, vectors, least)
    np.fill_diagonal(link, False)
    if side is not None:
        link &= side[:, None] != side[None, :]
    has = np.flatnonzero(link.any(axis=1))
    if not len(has):
        return None
    link = link[np.ix_(has, has)]
    some = [filters[i] for i in has]
    link &= ~shares_earlier(some, some, bucket)
    links = link @ weight[has]
    keep = links > 0
    if not keep.any():
        return None
    order = np.argsort(node[has], kind="stable")  # the least class of a component comes first
    label = least_linked(link[np.ix_(order, order)])
    root = np.zeros(len(has), np.int64)
    root[order] = node[has][order][label]
    return node[has][keep], links[keep], root[keep]


def cap_links(vectors: DataFrame, least: float = 0.98, tables: int = TABLES, words: int = WORDS, cap: float = CAP,
              slack: float = SLACK, block: int = BLOCK, id_column: str = "vec_id", vector_column: str = "embedding",
              label_column: str = "label") -> DataFrame:
    """(id, n_links, component_id, kept) of every row."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).alias("vector"),
                          F.col(label_column).alias("label"))
    part = one_length(rows.where(usable(F.col("vector")) & F.col("label").isNotNull()), "vector")
    classes = land(part.groupBy("label", "vector").agg(
        F.count("*").alias("weight"), F.min("id").alias("least")).withColumn(
        "class", F.monotonically_increasing_id()), "vector-classes")
    first = classes.select("vector").first()
    if first is None:
        return rows.select(F.col("id").alias(id_column), F.lit(0).cast("long").alias("n_links"),
                           F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    codes = spark.sparkContext.broadcast(ProductCodes(len(first["vector"]), tables, words))

    def decode(batches):
        for batch in batches:
            for at in range(0, len(batch), 1024):
                some = batch.slice(at, 1024)
                row, direction = codes.value.decode(unit(matrix(some.column(1))), cap, slack)
                cuts = np.searchsorted(row, np.arange(len(some) + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(cuts), pa.array(direction.astype(np.int64)))
                yield pa.RecordBatch.from_arrays([some.column(0), lists], names=["class", "filters"])

    decoded = land(classes.select("class", "vector").mapInArrow(decode, "class long, filters array<bigint>"), "filters")
    met = classes.select("class", "label", "vector", "weight").join(decoded, "class").withColumn(
        "filter", F.explode("filters"))
    sizes = met.select("label", "filter").groupBy("label", "filter").count().where("count > 1")
    total = land(sizes, "bucket-sizes")
    tasks = blocks_for(total.agg(F.sum("count")).first()[0] or 1, 8 * block)
    total = total.withColumn("blocks", F.ceil(F.col("count") / block))
    placed = met.join(total, ["label", "filter"]).withColumn("own", F.pmod(F.xxhash64("class"), "blocks"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    placed = placed.select(
        # Small buckets share tasks by hash; a pair of blocks has a key of its own.
        F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("label", "filter"), F.lit(tasks))).otherwise(
            F.xxhash64("label", "filter", low, high)).alias("task"),
        F.col("label").cast("string").alias("label"), "filter", low.alias("low"), high.alias("high"), "own", "class",
        "weight", "vector", "filters")

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (_, bucket, low, high), some in part.groupby(["label", "filter", "low", "high"], sort=False):
            if len(some) < 2:
                continue
            side = some["own"].to_numpy() if low != high else None
            found = compare_bucket(int(bucket), some["class"].to_numpy(), some["weight"].to_numpy(),
                                   np.stack(some["vector"].to_numpy()).astype(np.float64),
                                   list(some["filters"].to_numpy()), side, least)
            if found is not None:
                out.append(pd.DataFrame(dict(zip(("class", "links", "root"), found))))
        return pd.concat(out) if out else pd.DataFrame({"class": [], "links": [], "root": []}).astype("int64")

    found = land(placed.groupBy("task").applyInPandas(compare, "class long, links long, root long"), "links")
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("class").alias("a"), F.col("root").alias("b")))
    named = classes.join(links, "class", "left").join(groups.withColumnRenamed("node", "class"), "class", "left")
    named = named.withColumn("component", F.coalesce("component", "class"))
    least_id = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = land(named.join(least_id, "component").select(
        "label", "vector", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id"), "named")
    out = rows.join(named, ["label", "vector"], "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_column), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))
