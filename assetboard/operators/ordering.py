"""Order-based operators that never put one group into one task.

A group (a board, a label, a feature) may hold a large share of all rows, so a plain
``Window.partitionBy(group)`` would sort that share in one task. Ranks, running totals and exact
quantiles are built from a range-partitioned sort plus small per-partition offsets instead.
Top-k per group is left to a ranked filter, which Spark cuts to k rows per map task.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from assetboard.functions.numeric import lerp
from assetboard.session import land

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the partition above and the row below this bit


def _tagged_sort(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Rows in global (keys, order) order with their partition and place, written once."""
    tagged = df.orderBy(*[F.col(k) for k in keys], *order).withColumn(
        "_tag", F.monotonically_increasing_id()
    )
    return land(
        tagged.withColumn("_part", F.shiftright("_tag", _LOCAL_BITS).cast("int"))
        .withColumn("_place", F.col("_tag") - F.shiftleft(F.shiftright("_tag", _LOCAL_BITS), _LOCAL_BITS))
        .drop("_tag"),
        "ordered",
    )


def _matches(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe key equality; the keys of a group may be null."""
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(right[f"_k_{k}"])
    return condition


def _attach(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    renamed = right.select(*[F.col(k).alias(f"_k_{k}") for k in keys],
                           *[c for c in right.columns if c not in keys])
    return left.join(renamed, _matches(left, renamed, keys), how).drop(*[f"_k_{k}" for k in keys])


def _offsets(pieces: DataFrame, keys: Sequence[str], sums: Mapping[str, str], kept: Sequence[str]) -> DataFrame:
    """Totals before each (group, range partition) and of the whole group.

    A group spans consecutive partitions, so there are at most groups + partitions rows. They are
    written, which gives the planner their true size: it broadcasts them only below its threshold.
    """
    group = Window.partitionBy(*keys)
    earlier = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return land(pieces.select(
        *keys, "_part", *kept,
        *[F.coalesce(F.sum(src).over(earlier), F.lit(0)).alias(f"_off_{out}") for out, src in sums.items()],
        *[F.sum(src).over(group).alias(f"_total_{out}") for out, src in sums.items()],
    ), "offsets")


def row_positions(df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str = "position",
                  size: str | None = None) -> DataFrame:
    """0-based place of each row inside its group, optionally with the group's row count.

    ``order`` must be total within the group.
    """
    keys = list(keys)
    rows = _tagged_sort(df, keys, order)
    pieces = rows.groupBy(*keys, "_part").agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
    joined = _attach(rows, _offsets(pieces, keys, {"n": "_n"}, ["_first"]), [*keys, "_part"])
    return joined.select(
        *df.columns,
        (F.col("_off_n") + F.col("_place") - F.col("_first")).alias(out),
        *([F.col("_total_n").alias(size)] if size else []),
    )


def prefix_sums(df: DataFrame, keys: Sequence[str], order: Sequence[Column], measures: Mapping[str, str],
                totals: Mapping[str, str] | None = None) -> DataFrame:
    """Totals of all earlier rows of the group, and group totals.

    ``measures`` maps a new column to the column summed before each row; ``totals`` maps a new
    column to one of those new columns, for its sum over the whole group.
    """
    keys = list(keys)
    rows = _tagged_sort(df, keys, order)
    pieces = rows.groupBy(*keys, "_part").agg(
        *[F.sum(src).alias(f"_sum_{out}") for out, src in measures.items()]
    )
    offsets = _offsets(pieces, keys, {out: f"_sum_{out}" for out in measures}, [])
    inside = Window.partitionBy(*keys, "_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    local = rows.select(
        "*", *[F.sum(src).over(inside).alias(f"_in_{out}") for out, src in measures.items()]
    )
    joined = _attach(local, offsets, [*keys, "_part"])
    return joined.select(
        *df.columns,
        *[(F.col(f"_off_{out}") + F.coalesce(F.col(f"_in_{out}"), F.lit(0))).alias(out) for out in measures],
        *[F.col(f"_total_{of}").alias(name) for name, of in (totals or {}).items()],
    )


def value_levels(df: DataFrame, keys: Sequence[str], value: str, extra: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per distinct non-null value of a group with its count; combines map-side."""
    aggs = [F.count("*").alias("n"), *[c.alias(name) for name, c in (extra or {}).items()]]
    return df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(*aggs)


def average_rank(df: DataFrame, keys: Sequence[str], value: str, rank: str = "avg_rank",
                 percentile: str | None = None) -> DataFrame:
    """Average-tie rank of ``value`` in its group, optionally as a share of the non-null rows.

    Ranks are computed on distinct values, then joined back; nulls get null.
    """
    keys = list(keys)
    levels = value_levels(df.select(*keys, value), keys, value)
    placed = prefix_sums(levels, keys, [F.col(value)], {"_below": "n"}, {"_total": "_below"})
    place = F.col("_below") + (F.col("n") + 1) / 2.0
    ranks = placed.select(*keys, value, place.alias(rank),
                          *([(place / F.col("_total")).alias(percentile)] if percentile else []))
    renamed = ranks.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col(value).alias("_v"),
                           rank, *([percentile] if percentile else []))
    condition = _matches(df, renamed, keys) & (df[value] == renamed["_v"])
    return df.join(renamed, condition, "left").drop("_v", *[f"_k_{k}" for k in keys])


BRACKET_ACCURACY = 10_000  # the sketch's rank error is at most rows / accuracy


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float]) -> DataFrame:
    """Linear-interpolation quantiles per group, exact at any group size.

    A sketch brackets each quantile; the rows below the bracket are only counted, and only the
    distinct values inside it are ordered. If a bracket should miss its place, all distinct values
    are ordered instead.
    """
    if not keys:
        return exact_quantiles(df.withColumn("_all", F.lit(0)), ["_all"], value, probs).drop("_all")
    keys = list(keys)
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    slack = 4.0 / BRACKET_ACCURACY
    edges = [min(max(p + side * slack, 0.0), 1.0) for p in probs.values() for side in (-1, 1)]
    sketch = F.percentile_approx("_v", F.array(*[F.lit(e) for e in edges]), F.lit(BRACKET_ACCURACY))
    brackets = land(rows.groupBy(*keys).agg(sketch.alias("_edges")), "brackets")
    marked = _attach(rows, brackets, keys)
    edge = lambda i, side: F.get("_edges", F.lit(2 * i + side))
    names = list(probs)
    counts = marked.groupBy(*keys).agg(
        F.count("*").alias("_total"),
        *[F.count_if(F.col("_v") < edge(i, 0)).alias(f"_under{i}") for i in range(len(names))],
    )
    hits = F.filter(
        F.array(*[F.when(F.col("_v").between(edge(i, 0), edge(i, 1)), F.lit(i)) for i in range(len(names))]),
        lambda i: i.isNotNull(),
    )
    levels = marked.select(*keys, "_v", F.explode(hits).alias("_q")).groupBy(*keys, "_q", "_v").agg(F.count("*").alias("n"))
    placed = prefix_sums(levels, [*keys, "_q"], [F.col("_v")], {"_below": "n"})
    placed = _attach(land(counts, "counts"), placed, keys, "left")  # a group without hits must show as missing
    under = F.get(F.array(*[F.col(f"_under{i}") for i in range(len(names))]), F.col("_q"))
    found = _pick_quantiles(placed.withColumn("_below", F.col("_below") + under), keys, names, probs, by_index=True)
    found = land(found, "quantiles")
    if found.where(F.array_contains(F.array(*[F.col(n).isNull() for n in names]), True)).isEmpty():
        return found
    levels = value_levels(rows, keys, "_v")
    placed = prefix_sums(levels, keys, [F.col("_v")], {"_below": "n"}, {"_total": "_below"})
    return _pick_quantiles(placed, keys, names, probs, by_index=False)


def column_quantiles(df: DataFrame, columns: Sequence[str], p: float) -> dict[str, float | None]:
    """The exact ``p`` quantile of several columns; null for a column without values.

    As ``exact_quantiles``, but all columns share one sketch pass and one counting pass, and only the
    values inside the brackets become rows.
    """
    values = [F.col(c).cast("double") for c in columns]
    slack = 4.0 / BRACKET_ACCURACY
    edges = F.array(F.lit(max(p - slack, 0.0)), F.lit(min(p + slack, 1.0)))
    seen = df.agg(
        *[F.count(v).alias(f"_n{i}") for i, v in enumerate(values)],
        *[F.percentile_approx(v, edges, F.lit(BRACKET_ACCURACY)).alias(f"_e{i}") for i, v in enumerate(values)],
    ).first()
    totals = [seen[f"_n{i}"] for i in range(len(columns))]
    brackets = [tuple(seen[f"_e{i}"] or (0.0, 0.0)) for i in range(len(columns))]
    under = list(df.agg(*[F.count_if(v < F.lit(lo)) for v, (lo, _) in zip(values, brackets)]).first())
    cells = F.filter(
        F.array(*[F.when(v.between(lo, hi), F.struct(F.lit(i).alias("_c"), v.alias("_v")))
                  for i, (v, (lo, hi)) in enumerate(zip(values, brackets))]),
        lambda cell: cell.isNotNull(),
    )
    levels = df.select(F.inline(cells)).groupBy("_c", "_v").agg(F.count("*").alias("n"))
    per_column = lambda numbers: F.get(F.array(*[F.lit(n).cast("bigint") for n in numbers]), F.col("_c"))
    placed = prefix_sums(levels, ["_c"], [F.col("_v")], {"_below": "n"}).withColumn(
        "_below", F.col("_below") + per_column(under)).withColumn("_total", per_column(totals))
    found = {r["_c"]: r["q"] for r in _pick_quantiles(placed, ["_c"], ["q"], {"q": p}, by_index=False).collect()}
    result = {c: found.get(i) for i, c in enumerate(columns)}
    for i, c in enumerate(columns):
        if totals[i] and result[c] is None:  # the bracket missed
            result[c] = exact_quantiles(df, [], c, {"q": p}).first()[0]
    return result


def _pick_quantiles(placed: DataFrame, keys: Sequence[str], names: Sequence[str], probs: Mapping[str, float], by_index: bool) -> DataFrame:
    """Interpolate between the two values around each quantile's place."""
    upto = F.col("_below") + F.col("n")
    last = F.col("_total") - 1
    picks = []
    for i, name in enumerate(names):
        at = last * F.lit(float(probs[name]))
        mine = (F.col("_q") == i) if by_index else F.lit(True)
        for side, place in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            picks.append(F.max(F.when(mine & (F.col("_below") <= place) & (place < upto), F.col("_v"))).alias(f"_{side}{i}"))
    picked = placed.groupBy(*keys).agg(F.max("_total").alias("_total"), *picks)
    fraction = lambda p: last * F.lit(float(p)) - F.floor(last * F.lit(float(p)))
    return picked.select(
        *keys, *[lerp(F.col(f"_lo{i}"), F.col(f"_hi{i}"), fraction(probs[name])).alias(name) for i, name in enumerate(names)]
    )


def hash_positions(df: DataFrame, keys: Sequence[str], ids: Sequence[str], seed: int,
                   out: str = "position", size_out: str = "group_size", bits: int = 14) -> DataFrame:
    """Seeded shuffle: 0-based place of each row in the order of a hash of its id, and its group size.

    The hash is uniform, so its top ``bits`` bits cut every group into even slices: slice counts give
    the offsets and only one slice is ever sorted in a task. The same on every run. The offsets are
    written, at most 2^bits rows per group, so that the planner knows their size.
    """
    keys = list(keys)
    hashed, offsets = _hash_slices(df, keys, ids, seed, size_out, bits)
    inside = Window.partitionBy(*keys, "_slice").orderBy("_hash", *ids)
    local = hashed.withColumn("_rank", F.row_number().over(inside) - 1)
    joined = _attach(local, offsets, [*keys, "_slice"])
    return joined.withColumn(out, F.col("_offset") + F.col("_rank")).drop("_hash", "_slice", "_rank", "_offset", "_n")


def hash_parts(df: DataFrame, keys: Sequence[str], ids: Sequence[str], seed: int, part: Callable[[Column, Column], Column],
               out: str = "part", bits: int = 14) -> DataFrame:
    """``part(position, group size)`` of each row in the seeded shuffle of ``hash_positions``, for parts that are stretches of it.

    A slice whose first and last position lie in one part goes there as a whole; only slices that a border cuts
    are ranked, a few per group, so no other row is shuffled. ``df`` is read three times, so it should be a written table.
    """
    keys = list(keys)
    hashed, offsets = _hash_slices(df, keys, ids, seed, "_size", bits)
    first, last = part(F.col("_offset"), F.col("_size")), part(F.col("_offset") + F.col("_n") - 1, F.col("_size"))
    joined = _attach(hashed, offsets.withColumn(out, F.when(first == last, first)), [*keys, "_slice"])
    inside = Window.partitionBy(*keys, "_slice").orderBy("_hash", *ids)
    cut = joined.where(F.col(out).isNull()).withColumn("_rank", F.row_number().over(inside) - 1)
    cut = cut.withColumn(out, part(F.col("_offset") + F.col("_rank"), F.col("_size")))
    return joined.where(F.col(out).isNotNull()).select(*df.columns, out).union(cut.select(*df.columns, out))


def _hash_slices(df: DataFrame, keys: list[str], ids: Sequence[str], seed: int, size_out: str, bits: int) -> tuple[DataFrame, DataFrame]:
    """The rows with hash and slice, and per group and slice its first position, rows, and the group's size."""
    hashed = df.withColumn("_hash", F.xxhash64(*[F.col(c) for c in ids], F.lit(seed))).withColumn(
        "_slice", F.shiftright("_hash", 64 - bits).cast("int")
    )
    counts = hashed.groupBy(*keys, "_slice").agg(F.count("*").alias("_n"))
    by_group = Window.partitionBy(*keys)
    earlier = by_group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    return hashed, land(counts.select(
        *keys, "_slice", "_n",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_n").over(by_group).alias(size_out),
    ), "slices")


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str | None = None) -> DataFrame:
    """The first ``k`` rows of each group; ``order`` must be total.

    Written as a ranked filter so that Spark limits each map task to k rows per group before the
    shuffle (WindowGroupLimit); k is a report size, not a share of the data.
    """
    name = rank or "_rank"
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = ranked.where(F.col(name) <= k)
    return kept if rank else kept.drop(name)


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in a total order (keep-last is the reversed order)."""
    return top_per_group(df, keys, order, 1)
