"""Nearest vectors by a hierarchical k-means tree with best-bin-first traversal.

The tree is fitted on a bounded sample (``sample`` vectors, by hash): nodes are split into ``branches``
k-means clusters until they hold ``leaf_sample`` sampled vectors or fewer. Every vector goes to one leaf by
descending to the nearest centre. A query visits leaves in best-bin-first order: a priority queue holds the
branches not taken by their centre's distance, and the next best bin is opened until enough leaves are
visited. How many that is gets calibrated: exact neighbours of ``probes`` queries are found by brute force
over all vectors, and the visits are widened (doubled, then refined) until ``recall`` of them lie in visited
leaves; at worst all leaves are visited, which is exact.

Equal vectors form one class that carries its smallest ids, as many as an answer can need. Leaves are searched
in blocks of rows and queries, so that neither a hot leaf nor a hot query region meets in one task. Vectors
that are null, zero or hold null or non-finite components take no part, nor do vectors of other lengths
than the most frequent. Rows with the same id and vector count once. Ties go to the smaller id.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assetboard.llm.vectors import cosines, matrix, one_length, unit, usable
from assetboard.session import land

SAMPLE, BRANCHES, LEAF_SAMPLE, PROBES, RECALL = 20_000, 8, 48, 96, 0.97
BLOCK = 2048


class Tree:
    """Centres of a hierarchical k-means tree over unit vectors; leaves are numbered from 0."""

    def __init__(self, sample: np.ndarray, branches: int, leaf_sample: int, seed: int = 3):
        self.centres: list[np.ndarray] = []
        self.children: list[np.ndarray] = []  # node numbers, or -1 - leaf
        self.leaves = 0
        self._rng = np.random.default_rng(seed)
        self.root = self._grow(sample, branches, leaf_sample)

    def _grow(self, rows: np.ndarray, branches: int, leaf_sample: int) -> int:
        groups = self._split(rows, branches) if len(rows) > leaf_sample else None
        if groups is None:
            self.leaves += 1
            return -self.leaves
        number = len(self.centres)
        self.centres.append(np.stack([unit(rows[g].mean(axis=0, keepdims=True) + 1e-12)[0] for g in groups]))
        self.children.append(np.zeros(len(groups), np.int64))
        for i, g in enumerate(groups):
            self.children[number][i] = self._grow(rows[g], branches, leaf_sample)
        return number

    def _split(self, rows: np.ndarray, branches: int, rounds: int = 8) -> list[np.ndarray] | None:
        centres = rows[self._rng.choice(len(rows), min(branches, len(rows)), replace=False)]
        for _ in range(rounds):
            own = np.argmax(rows @ centres.T, axis=1)
            centres = np.stack([unit(rows[own == k].mean(axis=0, keepdims=True) + 1e-12)[0] if (own == k).any()
                                else centres[k] for k in range(len(centres))])
        own = np.argmax(rows @ centres.T, axis=1)
        groups = [g for g in (np.flatnonzero(own == k) for k in range(len(centres))) if len(g)]
        return groups if len(groups) > 1 else None

    def leaf_of(self, rows: np.ndarray) -> np.ndarray:
        """Leaf of each row, by the nearest centre on every level."""
        out = np.zeros(len(rows), np.int64)
        waiting = [(self.root, np.arange(len(rows)))]
        while waiting:
            node, at = waiting.pop()
            if node < 0:
                out[at] = -node - 1
                continue
            own = np.argmax(rows[at] @ self.centres[node].T, axis=1)
            waiting += [(int(child), at[own == i]) for i, child in enumerate(self.children[node]) if (own == i).any()]
        return out

    def visits(self, query: np.ndarray, most: int, sizes: np.ndarray | None = None, least: int = 0) -> list[int]:
        """The first leaves that a query visits, best bin first: ``most``, or as many more as hold ``least`` rows."""
        out: list[int] = []
        queue = [(0.0, 0, self.root)]
        pushed, held = 1, 0
        while queue and (len(out) < most or held < least):
            _, _, node = heapq.heappop(queue)
            if node < 0:
                out.append(-node - 1)
                held += int(sizes[-node - 1]) if sizes is not None else least
                continue
            for near, child in zip((self.centres[node] @ query).tolist(), self.children[node].tolist()):
                heapq.heappush(queue, (-near, pushed, child))
                pushed += 1
        return out


def classes_of(rows: DataFrame, ids: int) -> DataFrame:
    """(class, vector, ids): distinct vectors and their smallest ids."""
    order = Window.partitionBy("vector").orderBy("id")
    return rows.withColumn("place", F.dense_rank().over(order)).where(F.col("place") <= ids).groupBy("vector").agg(
        F.array_sort(F.collect_set("id")).alias("ids")).withColumn("class", F.monotonically_increasing_id())


def best_rows(found: DataFrame, key: str, most: int) -> DataFrame:
    """The ``most`` nearest (score, id) of each key, ties to smaller ids."""
    order = Window.partitionBy(key).orderBy(F.desc("score"), "id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most).drop("place")


def top(scores: np.ndarray, most: int) -> np.ndarray:
    """Columns of the highest scores of each row and of those that tie with the last, with the row."""
    if scores.shape[1] <= most:
        return np.ones(scores.shape, bool)
    last = np.partition(scores, -most, axis=1)[:, -most]
    return scores >= last[:, None] - 1e-9


def search(vectors: DataFrame, is_query: Column, k: int = 5, sample: int = SAMPLE, branches: int = BRANCHES,
           leaf_sample: int = LEAF_SAMPLE, probes: int = PROBES, recall: float = RECALL, id_column: str = "vec_id",
           vector_column: str = "embedding", block: int = BLOCK) -> DataFrame:
    """(query_id, rank, id, score) of the ``k`` nearest other rows of every row that ``is_query`` holds for."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).alias("vector"),
                          is_query.alias("is_query")).where(usable(F.col("vector")) & F.col("id").isNotNull())
    rows = one_length(rows, "vector")
    classes = land(classes_of(rows, k + 1), "vector-classes")
    n = classes.count()
    # The sample is bounded by its parameter; a hash picks it, alike at every size.
    share = F.lit(min(1 << 30, (1 << 30) * sample // max(n, 1)))
    picked = classes.where(F.pmod(F.xxhash64("class", F.lit(1)), F.lit(1 << 30)) < share).orderBy("class").select("vector")
    fitted = matrix(picked.toArrow()["vector"])
    tree = Tree(unit(fitted) if len(fitted) else fitted, branches, leaf_sample)
    shared = spark.sparkContext.broadcast(tree)

    def to_leaf(batches):
        for batch in batches:
            leaf = shared.value.leaf_of(unit(matrix(batch.column(1)))) if len(batch) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=[*batch.schema.names, "leaf"])

    kind = classes.schema["vector"].dataType.simpleString()
    id_kind = classes.schema["ids"].dataType.elementType.simpleString()
    placed = land(classes.select("class", "vector", "ids").mapInArrow(
        to_leaf, f"class long, vector {kind}, ids array<{id_kind}>, leaf long"), "leaves")
    wanted = rows.where("is_query").select("id", "vector").distinct()
    wanted = land(wanted.join(placed.select("vector", "class"), "vector").select("id", "class", "vector"), "queries")
    queries = wanted.dropDuplicates(["class"]).select("class", "vector")
    visits = calibrated(placed, queries, tree, k, probes, recall)
    # Classes by leaf, at most one number for each vector of the sample; a query goes on until it has met enough.
    by_leaf = placed.groupBy("leaf").count().toPandas()
    held = np.zeros(max(tree.leaves, 1), np.int64)
    held[by_leaf["leaf"].to_numpy(np.int64)] = by_leaf["count"].to_numpy(np.int64)
    leaf_sizes = spark.sparkContext.broadcast(held)

    def route(batches):
        for batch in batches:
            units = unit(matrix(batch.column(1))) if len(batch) else []
            leaves = [shared.value.visits(q, visits, leaf_sizes.value, k + 1) for q in units]
            repeat = pa.array(np.repeat(np.arange(len(leaves)), [len(x) for x in leaves]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(repeat), batch.column(1).take(repeat),
                 pa.array(np.concatenate(leaves) if leaves else [], pa.int64())], names=["query", "sought", "leaf"])

    routed = queries.mapInArrow(route, f"query long, sought {kind}, leaf long")
    row_blocks = placed.groupBy("leaf").agg(F.ceil(F.count("*") / block).alias("row_blocks"))
    query_blocks = routed.groupBy("leaf").agg(F.ceil(F.count("*") / block).alias("query_blocks"))
    sizes = land(row_blocks.join(query_blocks, "leaf"), "leaf-blocks")
    spread = lambda b: F.explode(F.sequence(F.lit(0).cast("long"), F.col(b) - 1))
    left = placed.join(sizes, "leaf").withColumn("r", F.pmod(F.xxhash64("class"), "row_blocks")).withColumn(
        "q", spread("query_blocks")).select("leaf", "r", "q", "ids", "vector")
    right = routed.join(sizes, "leaf").withColumn("q", F.pmod(F.xxhash64("query"), "query_blocks")).withColumn(
        "r", spread("row_blocks")).select("leaf", "r", "q", "query", "sought")

    def compare(rows: pd.DataFrame, sought: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(sought):
            return pd.DataFrame({"query": [], "ids": [], "score": []}).astype({"query": "int64"})
        a = np.stack(sought["sought"].to_numpy()).astype(np.float64)
        b = np.stack(rows["vector"].to_numpy()).astype(np.float64)
        q, r = np.nonzero(top(unit(a) @ unit(b).T, k + 1))
        return pd.DataFrame({"query": sought["query"].to_numpy()[q], "ids": rows["ids"].to_numpy()[r],
                             "score": cosines(a[q], b[r])})

    found = left.groupBy("leaf", "r", "q").cogroup(right.groupBy("leaf", "r", "q")).applyInPandas(
        compare, f"query long, ids array<{id_kind}>, score double")
    nearest = land(best_rows(found.select("query", "score", F.explode("ids").alias("id")), "query", k + 1), "nearest")
    answers = wanted.select(F.col("id").alias("query_id"), F.col("class").alias("query")).join(nearest, "query").where(
        F.col("id") != F.col("query_id"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return answers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", F.col("id").alias(id_column), "score", F.lit(visits).alias("leaves_visited"),
        F.lit(tree.leaves).alias("leaves"))


def calibrated(placed: DataFrame, queries: DataFrame, tree: Tree, k: int, probes: int, recall: float) -> int:
    """Leaf visits at which ``recall`` of the probes' exact neighbours lie in visited leaves."""
    picked = queries.orderBy(F.xxhash64("class", F.lit(2)), "class").limit(probes).toArrow()
    if not len(picked):
        return 1
    sought, number = matrix(picked["vector"]), picked["class"].to_numpy()
    shared = placed.sparkSession.sparkContext.broadcast((sought, number))

    def brute(batches):
        sought, number = shared.value
        for batch in batches:
            rows = matrix(batch.column(0))
            hit = top(unit(sought) @ unit(rows).T, k + 1) if len(rows) else np.zeros((0, 0), bool)
            q, r = np.nonzero(hit)
            yield pa.RecordBatch.from_arrays(
                [pa.array(number[q]), batch.column(1).take(pa.array(r)), pa.array(cosines(sought[q], rows[r])),
                 batch.column(2).take(pa.array(r))], names=["query", "leaf", "score", "id"])

    exact = placed.select("vector", "leaf", F.col("class").alias("id")).mapInArrow(
        brute, "query long, leaf long, score double, id long")
    # A query's own class is its first neighbour and lies in the first leaf visited, or in one all agree on.
    exact = best_rows(exact, "query", k + 1).where(F.col("query") != F.col("id")).toPandas()
    order = {int(c): {leaf: i for i, leaf in enumerate(tree.visits(q, tree.leaves))}
             for c, q in zip(number, unit(sought))}
    places = np.array([order[int(q)][int(leaf)] for q, leaf in zip(exact["query"], exact["leaf"])])
    if not len(places):
        return tree.leaves
    visits = 1
    while visits < tree.leaves and (places < visits).mean() < recall:  # widen
        visits = min(2 * visits, tree.leaves)
    low = visits // 2
    while visits - low > max(1, low // 16):  # and refine
        middle = (visits + low) // 2
        low, visits = (middle, visits) if (places < middle).mean() < recall else (low, middle)
    return visits
