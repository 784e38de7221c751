"""Near duplicates by MinHash bands, a sequential Bayesian test, and an exact check of what passes it.

Documents with equal shingle sets form one class. A class has ``bands`` x ``rows`` MinHash values; classes
that share a band are candidates. Candidates are compared batch by batch: given m equal values of n, the
similarity has a Beta(m + 1, n - m + 1) posterior, and a pair leaves when the chance of a similarity at the
limit or above falls under ``miss``. Pairs that stay are checked on their whole shingle sets.

Only links between different components matter, so two passes suffice. First every band bucket compares
its members with one of them, drawn per band: as many pairs as rows, however large the bucket. The
components found are known before the second pass, in which buckets that still hold several components
compare all pairs across them inside tasks, in blocks, each pair in the first band it shares; what comes out
is one link per pair of components joined. No bucket emits all its pairs, and none is capped.

A pair at the limit shares no band with a chance of at most ``NO_BAND``: 0.008% at 0.85 (20 bands of 6 values),
0.007% at 0.80 (24 of 5). Such a pair is linked only through others, so this chance, and not ``miss``, which is
that of the Bayesian test alone, is what bounds the misses; it falls fast above the limit.

Texts without words, and null texts, have an empty set and link with nothing. Texts with fewer than
``width`` words have their whole sequence as one shingle. Repeated rows share a class. A null id never names
a component unless all its ids are null. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetboard.llm.common import bloom, claim, fresh, maybe_in, slices
from assetboard.llm.components import components
from assetboard.llm.suffix_lm import word_hashes
from assetboard.session import land

WIDTH, SIMILARITY = 3, 85
VALUES, BATCH = 120, 24
MISS, NO_BAND = 1e-5, 1e-4
SLICE_BYTES = 2_000_000
BLOCK = 2048


def no_band(bands: int, rows: int, similarity: float) -> float:
    """The chance that a pair of this similarity shares no band."""
    return (1 - similarity ** rows) ** bands


def banding(similarity: float, values: int = VALUES, most: float = NO_BAND) -> tuple[int, int]:
    """Bands and values in each: the longest bands that leave at most such a chance, and one value a band at worst."""
    fits = [r for r in range(1, values + 1) if values % r == 0 and no_band(values // r, r, similarity) <= most]
    rows = max(fits, default=1)
    return values // rows, rows


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers, mixed."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(33))


def shingles(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text as sorted 64-bit numbers, text after text, and their number."""
    hashes, places, rows = word_hashes(texts)
    per_row = np.bincount(rows, minlength=len(texts))
    words = hashes.view(np.uint64)[places]
    stops = np.cumsum(per_row)
    out, sizes = [], np.zeros(len(texts), np.int64)
    for i, (stop, n) in enumerate(zip(stops.tolist(), per_row.tolist())):
        if not n:
            continue
        own, span = words[stop - n: stop], min(width, n)
        code = np.full(n - span + 1, span, np.uint64)
        for k in range(span):
            code = mixed(code * np.uint64(0x9E3779B97F4A7C15) + own[k: n - span + 1 + k])
        code.sort()
        code = code[np.concatenate([[True], code[1:] != code[:-1]])]
        out.append(code)
        sizes[i] = len(code)
    return np.concatenate(out) if out else np.zeros(0, np.uint64), sizes


def signatures(codes: np.ndarray, sizes: np.ndarray, values: int, seed: int = 11) -> np.ndarray:
    """MinHash values of each set that has members, of which 16 bits are kept: enough to tell values apart."""
    rng = np.random.default_rng(seed)
    factors = rng.integers(0, 1 << 63, values, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    some = sizes[sizes > 0]
    starts = np.cumsum(some) - some
    out = np.zeros((len(some), values), np.int16)
    for i, factor in enumerate(factors):
        out[:, i] = mixed(np.minimum.reduceat(codes * factor, starts)).astype(np.uint16).view(np.int16)
    return out


def sketch(docs: DataFrame, width: int, values: int, id_column: str, text_column: str) -> DataFrame:
    """(id, key, n_shingles, set_a, set_b, signature) of every row; sets are null where empty."""
    def run(batches):
        claim("near_dedup")
        for batch in batches:
            texts = pa.compute.fill_null(batch.column(2), "")
            for start, stop in slices(texts, SLICE_BYTES):
                part = texts.slice(start, stop - start)
                codes, sizes = shingles(part, width)
                some = sizes > 0
                filled = np.cumsum(some) - 1
                signs = signatures(codes, sizes, values) if some.any() else np.zeros((0, values), np.int16)
                starts = (np.cumsum(sizes) - sizes)[some]
                sums = [np.add.reduceat(codes, starts), np.add.reduceat(mixed(codes * np.uint64(5)), starts)] \
                    if some.any() else [np.zeros(0, np.uint64)] * 2
                pick = pa.array(filled, pa.int64(), mask=~some)
                width_of = np.arange(0, (len(signs) + 1) * values, values, dtype=np.int32)
                lists = pa.ListArray.from_arrays(pa.array(width_of), pa.array(signs.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(start, stop - start) for i in (0, 1)), pa.array(sizes),
                     *(pa.array(s.view(np.int64)).take(pick) for s in sums), lists.take(pick)],
                    names=["id", "key", "n_shingles", "set_a", "set_b", "signature"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, F.xxhash64(id_column, text_column), text_column).mapInArrow(
        run, f"id {kind}, key long, n_shingles long, set_a long, set_b long, signature array<smallint>")


def needed_matches(values: int, batch: int, similarity: float, miss: float) -> list[int]:
    """Fewest equal values after each batch that leave a chance of ``miss`` for ``similarity`` or above."""
    needed = []
    for n in range(batch, values + 1, batch):
        def chance(m):  # of a similarity at the limit or above: a Beta tail, as a sum of binomial terms
            return sum(comb(n + 1, k) * similarity ** k * (1 - similarity) ** (n + 1 - k) for k in range(m + 1))

        needed.append(next(m for m in range(n + 1) if chance(m) >= miss))
    return needed


def surviving(left: np.ndarray, right: np.ndarray, needed: list[int], batch: int) -> np.ndarray:
    """Which pairs of signature rows pass every batch of the Bayesian test."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), np.int64)
    for i, least in enumerate(needed):
        span = slice(i * batch, (i + 1) * batch)
        matches[alive] += (left[alive, span] == right[alive, span]).sum(axis=1)
        alive = alive[matches[alive] >= least]
    return alive


def verified(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Pairs (a, b) whose whole sets reach the similarity, in exact integers."""
    a = sets.select(F.col("class").alias("a"), F.col("shingles").alias("set_of_a"))
    b = sets.select(F.col("class").alias("b"), F.col("shingles").alias("set_of_b"))
    shared = F.size(F.array_intersect("set_of_a", "set_of_b"))
    both = pairs.join(a, "a").join(b, "b")
    return both.where(100 * shared >= similarity * (F.size("set_of_a") + F.size("set_of_b") - shared)).select("a", "b")


def classified(docs: DataFrame, width: int = WIDTH, similarity: int = SIMILARITY, bands: int | None = None,
                    rows: int | None = None, batch: int = BATCH, miss: float = MISS, id_column: str = "doc_id",
                    text_column: str = "text", block: int = BLOCK) -> DataFrame:
    """(id, key, n_shingles, component_id, kept) of every row; ``key`` hashes id and text.

    Without ``bands`` and ``rows`` both follow from the similarity.
    """
    if bands is None or rows is None:
        bands, rows = banding(similarity / 100)
    values = bands * rows
    needed = needed_matches(values, batch, similarity / 100, miss)
    sketches = land(sketch(docs, width, values, id_column, text_column), "sketches")
    # The first id of a class stands for it; ids in one class have the same set.
    classes = land(sketches.where("set_a is not null").groupBy("set_a", "set_b", "n_shingles").agg(
        F.min("id").alias("least"), F.min_by("signature", F.xxhash64("id")).alias("signature"),
    ).withColumn("class", F.monotonically_increasing_id()), "classes")

    keys = F.array(*[F.xxhash64(F.slice("signature", k * rows + 1, rows), F.lit(k)) for k in range(bands)])
    banded = classes.select("class", F.posexplode(keys).alias("band", "key"))
    sizes = banded.groupBy("band", "key").agg(
        F.count("*").alias("members"), F.min_by("class", F.xxhash64("class", "band")).alias("centre"))
    banded = land(banded.join(sizes.where("members > 1"), ["band", "key"]), "banded")
    involved = banded.select("class").distinct()

    # Whole sets of the classes that share a band with another.
    wanted = land(classes.join(involved, "class").select("class", "least", "set_a"), "wanted")
    repeated = not sketches.groupBy("id").count().where("count > 1").isEmpty()
    sets = land(shingle_sets(docs, wanted, width, repeated, id_column, text_column), "shingle-sets")
    signs = land(classes.join(involved, "class").select("class", "signature"), "signatures")

    stars = banded.where("class <> centre").select(
        F.least("class", "centre").alias("a"), F.greatest("class", "centre").alias("b")).distinct()
    first = land(verified(tested(stars, signs, needed, batch), sets, similarity), "links-1")
    found = components(first)

    split = banded.join(found.withColumnRenamed("node", "class"), "class", "left").withColumn(
        "component", F.coalesce("component", "class"))
    several = split.groupBy("band", "key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    open_rows = split.join(several.where("low < high").select("band", "key"), ["band", "key"])
    # Half of each shingle's bits is enough to choose the links, which are then checked on whole sets.
    halves = sets.select("class", F.transform("shingles", lambda x: F.shiftright(x, 32).cast("int")).alias("shingles"))
    open_rows = open_rows.join(signs.join(halves, "class"), "class")
    across = land(across_components(open_rows, needed, batch, rows, block, similarity), "across")
    second = verified(across.distinct(), sets, similarity)
    merged = components(first.union(second))

    named = classes.join(merged.withColumnRenamed("node", "class"), "class", "left").withColumn(
        "component", F.coalesce("component", "class")).select("set_a", "set_b", "n_shingles", "least", "component")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = land(named.join(least, "component").select("set_a", "set_b", "n_shingles", "component_id"), "named")
    out = sketches.select("id", "key", "n_shingles", "set_a", "set_b").join(named, ["set_a", "set_b", "n_shingles"], "left")
    component = F.when(F.col("set_a").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select("id", "key", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.col("id").isNull() & component.isNull()).alias("kept"))


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row; ``similarity`` is in hundredths."""
    return classified(docs, id_column=id_column, **options).select(
        F.col("id").alias(id_column), "n_shingles", "component_id", "kept")


def drop_near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """All columns of one row of each group: the one with the least id. Repeated rows of it leave as well.

    Only rows that a fixed-size Bloom filter can't clear are shuffled.
    """
    found = classified(docs, id_column=id_column, text_column=text_column, **options)
    by_key = found.groupBy("key").agg(F.bool_and("kept").alias("kept"), F.count("*").alias("rows"))
    odd = land(by_key.where("not kept or rows > 1"), "dropped")
    key, stays = fresh(docs, "_key", "_kept")
    keyed = docs.withColumn(key, F.xxhash64(id_column, text_column))
    may = maybe_in(keyed, key, bloom(odd, "key"))
    doubtful = keyed.where(may).join(odd.select(F.col("key").alias(key), F.col("kept").alias(stays)), key, "left")
    once = doubtful.where(F.col(stays).isNull())
    again = doubtful.where(F.col(stays)).dropDuplicates([key])
    return keyed.where(~may).select(docs.columns).union(once.select(docs.columns)).union(again.select(docs.columns))


def shingle_sets(docs: DataFrame, wanted: DataFrame, width: int, repeated: bool, id_column: str,
                 text_column: str) -> DataFrame:
    """(class, shingles) from the texts of the ids in ``wanted`` (class, least, set_a); ids may be ``repeated``."""
    def run(batches):
        for batch in batches:
            texts = pa.compute.fill_null(batch.column(1), "")
            for start, stop in slices(texts, SLICE_BYTES):
                codes, sizes = shingles(texts.slice(start, stop - start), width)
                cuts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                # Of an id's texts, only the one with the class's set is meant.
                own = np.flatnonzero(sizes > 0)
                sums = np.zeros(len(sizes), np.uint64)
                if len(own):
                    sums[own] = np.add.reduceat(codes, cuts[own])
                meant = batch.column(2).slice(start, stop - start).to_numpy() == sums.view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, stop - start),
                     pa.ListArray.from_arrays(pa.array(cuts), pa.array(codes.view(np.int64)))],
                    names=["class", "shingles"]).filter(pa.array(meant))

    texts = docs.select(F.col(id_column).alias("least"), F.col(text_column).alias("text"))
    texts = texts.where(maybe_in(texts, "least", bloom(wanted, "least")))  # only these are shuffled
    chosen = wanted.join(texts, wanted["least"].eqNullSafe(texts["least"])).select("class", "text", "set_a")
    made = chosen.mapInArrow(run, "class long, shingles array<long>")
    return made.dropDuplicates(["class"]) if repeated else made


def tested(pairs: DataFrame, signs: DataFrame, needed: list[int], batch: int) -> DataFrame:
    """Pairs (a, b) that pass the Bayesian test."""
    a = signs.select(F.col("class").alias("a"), F.col("signature").alias("sign_a"))
    b = signs.select(F.col("class").alias("b"), F.col("signature").alias("sign_b"))

    def run(batches):
        for rows in batches:
            left, right = (np.stack(rows.column(i).flatten().to_numpy().reshape(len(rows), -1))
                           if len(rows) else np.zeros((0, batch)) for i in (2, 3))
            alive = pa.array(surviving(left, right, needed, batch))
            yield pa.RecordBatch.from_arrays([rows.column(0).take(alive), rows.column(1).take(alive)], names=["a", "b"])

    both = pairs.join(a, "a").join(b, "b").select("a", "b", "sign_a", "sign_b")
    return both.mapInArrow(run, "a long, b long")


def across_components(members: DataFrame, needed: list[int], batch: int, rows: int, block: int,
                      similarity: int) -> DataFrame:
    """Links (a, b) between components that share a bucket, block by block.

    All pairs across components are tested inside the task; what comes out is one link for each pair of
    components that the block joins, so at most as many rows as members.
    """
    sizes = members.groupBy("band", "key").agg(F.ceil(F.count("*") / block).alias("blocks"))
    placed = members.join(sizes, ["band", "key"]).withColumn("own", F.pmod(F.xxhash64("class"), F.col("blocks")))
    # A member goes to every pair of blocks that holds its own: as often as the bucket has blocks.
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "band", "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "class",
        "component", "signature", "shingles")

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        low, high, band = part["low"].iloc[0], part["high"].iloc[0], int(part["band"].iloc[0])
        part = part.sort_values("class", ignore_index=True)
        node, label = part["class"].to_numpy(), part["component"].to_numpy().copy()
        signs = np.stack(part["signature"].to_numpy())
        sets = [np.sort(x) for x in part["shingles"]]
        own = part["own"].to_numpy()
        left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
        links = []
        for i in left:
            some = right[label[right] != label[i]]
            if low == high:
                some = some[some > i]
            # A pair is tested in the first band that both share.
            for k in range(band):
                if not len(some):
                    break
                some = some[(signs[some, k * rows: (k + 1) * rows] != signs[i, k * rows: (k + 1) * rows]).any(axis=1)]
            if len(some):
                some = some[surviving(np.broadcast_to(signs[i], (len(some), signs.shape[1])), signs[some], needed, batch)]
            if len(some):
                some = some[reaching(sets[i], [sets[j] for j in some], similarity)]
            for j in some:
                if label[j] != label[i]:
                    links.append((min(node[i], node[j]), max(node[i], node[j])))
                    label[label == label[j]] = label[i]
        return pd.DataFrame(links, columns=["a", "b"]).astype("int64")

    return placed.groupBy("band", "key", "low", "high").applyInPandas(compare, "a long, b long")


def reaching(own: np.ndarray, others: list[np.ndarray], similarity: int) -> np.ndarray:
    """Which sorted sets reach the similarity with one."""
    sizes = np.array([len(x) for x in others])
    members = np.concatenate(others)
    at = np.minimum(np.searchsorted(own, members), len(own) - 1)
    shared = np.add.reduceat((own[at] == members).astype(np.int64), np.cumsum(sizes) - sizes)
    return 100 * shared >= similarity * (len(own) + sizes - shared)
