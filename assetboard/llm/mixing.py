"""Sources mixed to target weights by a low-discrepancy schedule of equal-token blocks.

Every source's documents are shuffled by a hash of their ids, laid end to end and cut into blocks of
``block_tokens`` words. Slot i of the schedule has the golden-ratio point frac((i + 0.5) * phi), which the
cumulative targets map to a source; the r-th slot of a source takes its block r mod B, where B is the
source's number of blocks, so that any stretch of the schedule holds the sources near their shares. A
source that reached ``most_repeats`` passes gives no more.

Targets: sources in order of code points, null last, weigh 1, 2, 3, repeating, and share all words; a
target stops at ``most_repeats`` times its source's size and the excess is shared by weight. This is one
water level, found by one ordered pass over the table of sources (a row each).

No row holds a source whole: positions within a source come from sums per hash block plus the sums
before it. Null texts have size 0 and are never taken; null is a source of its own. Repeated rows are laid
out one by one. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assetboard.llm.common import WORD, blocks_for, fresh
from assetboard.session import land

PHI = 0.6180339887498949
BLOCK_TOKENS = 64
CELLS = 1024


def source_targets(sizes: DataFrame, most_repeats: int = 3, cycle: int = 3, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(source, source_size, target, n_blocks, slots, low, high) from (source, source_size).

    A source is cut into ``n_blocks`` equal blocks of at most ``block_tokens`` words and wants ``slots`` of them; low
    and high are its cumulative shares of all slots.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = sizes.withColumn("weight", 1 + (F.row_number().over(by_name) - 1) % cycle).withColumn(
        "cap", (most_repeats * F.col("source_size")).cast("double"))
    # In order of cap per weight, sources up to some place are full and the rest share what is left.
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    past = fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    levels = weighed.withColumn(
        "level", (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(past), F.lit(0.0)))
        / F.sum("weight").over(rest))
    # The level of the first source that is not full; every later one would read the same or less.
    levels = levels.withColumn("level", F.min(F.when(
        F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "level"))).over(
        whole)["level"])
    targets = levels.withColumn("target", F.coalesce(
        F.least(F.col("level") * F.col("weight"), F.col("cap")), F.col("cap")))
    targets = targets.withColumn("n_blocks", F.ceil(F.col("source_size") / block_tokens)).withColumn(
        "slots", F.when(F.col("source_size") > 0, F.col("target") * F.col("n_blocks") / F.col("source_size")).otherwise(0.0))
    upto = F.sum("slots").over(by_name.rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("slots").over(whole)
    return targets.select(
        "source", "source_size", "target", "n_blocks", "slots",
        F.when(total > 0, (upto - F.col("slots")) / total).otherwise(F.lit(0.0)).alias("low"),
        F.when(total > 0, upto / total).otherwise(F.lit(0.0)).alias("high"))


def golden_point(i: Column) -> Column:
    """frac((i + 0.5) * phi), in two parts so that large i lose no digits."""
    high, low = F.floor(i / 1048576.0), i % 1048576
    point = high * (PHI * 1048576 % 1) + (low + 0.5) * PHI
    return point - F.floor(point)


def ranked(rows: DataFrame, keys: list[str], block: str, order: list[str], amount: Column, name: str) -> DataFrame:
    """Add the sum of ``amount`` before each row within its key, in order of (block, order)."""
    rows = rows.withColumn("_amount", amount)
    sums = rows.groupBy(*keys, block).agg(F.sum("_amount").alias("_sum"))
    starts = sums.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(block).alias("_block"), (
        F.sum("_sum").over(Window.partitionBy(*keys).orderBy(block)) - F.col("_sum")).alias("_start"))
    inside = F.sum("_amount").over(Window.partitionBy(*keys, block).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0)) - F.col("_amount")
    on = (F.col(block) == F.col("_block"))
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return rows.withColumn("_inside", inside).join(starts, on).withColumn(
        name, F.col("_inside") + F.col("_start")).drop(
        "_amount", "_inside", "_start", "_block", *[f"_{k}" for k in keys])


def mix(docs: DataFrame, block_tokens: int = BLOCK_TOKENS, most_repeats: int = 3, id_column: str = "doc_id",
        text_column: str = "text", source_column: str = "source") -> tuple[DataFrame, DataFrame]:
    """The rows with size and target, and the schedule: (slot, epoch, row, word_start, n_words).

    ``row`` names a document row in the first result; ``word_start`` is the first word taken from it.
    """
    spark = docs.sparkSession
    rows = land(docs.select(
        F.col(id_column).alias("id"), F.xxhash64(id_column, text_column).alias("key"),
        F.col(source_column).alias("source"),
        F.coalesce(F.regexp_count(text_column, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    ), "mix-rows")
    n = rows.count()
    sources = land(source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), most_repeats,
                                  block_tokens=block_tokens), "mix-sources")
    keyed = rows.withColumn("shuffle", F.xxhash64("id", F.lit(17))).withColumn(
        "hash_block", F.pmod("shuffle", F.lit(blocks_for(n, 4096))))
    laid = land(ranked(keyed, ["source"], "hash_block", ["shuffle", "id", "size"], F.col("size"), "start").withColumn(
        "row", F.monotonically_increasing_id()), "mix-laid")

    bounds = sources.where("high > low").select("source", "n_blocks", "low", "high")
    bounds = bounds.withColumn("cell", F.explode(F.sequence(
        F.floor(F.col("low") * CELLS), F.least(F.floor(F.col("high") * CELLS), F.lit(CELLS - 1).cast("long")))))
    n_slots = math.ceil(sources.agg(F.sum("slots")).first()[0] or 0.0)
    slots = spark.range(n_slots).select(F.col("id").alias("slot"), golden_point(F.col("id")).alias("point")).withColumn(
        "cell", F.least(F.floor(F.col("point") * CELLS), F.lit(CELLS - 1).cast("long")))
    slots = slots.join(bounds, "cell").where("point >= low and point < high").select(
        "slot", "source", "n_blocks", F.floor(F.col("slot") / 4096).alias("stretch"))
    slots = ranked(slots, ["source"], "stretch", ["slot"], F.lit(1), "rank")
    slots = slots.select("slot", "source", (F.col("rank") % F.col("n_blocks")).alias("block"),
                         F.floor(F.col("rank") / F.col("n_blocks")).alias("epoch")).where(F.col("epoch") < most_repeats)

    # The pieces of every block, from the documents that lie in it. The first ``_longer`` blocks of a source have a word
    # more than the others, which have ``_least``.
    cut = sources.where("n_blocks > 0").select(
        F.col("source").alias("_source"), F.expr("source_size div n_blocks").alias("_least"), F.expr("source_size % n_blocks").alias("_longer"))
    cut = cut.withColumn("_head", F.col("_longer") * (F.col("_least") + 1))

    def block_at(word: str) -> Column:
        return F.expr(f"case when {word} < _head then ({word}) div (_least + 1) else _longer + ({word} - _head) div _least end")

    def start_of(block: Column) -> Column:
        return F.when(block <= F.col("_longer"), block * (F.col("_least") + 1)).otherwise(
            F.col("_head") + (block - F.col("_longer")) * F.col("_least"))

    pieces = laid.where("size > 0").join(cut, F.col("source").eqNullSafe(F.col("_source"))).select(
        "_source", "row", "start", "size", "_least", "_longer", "_head",
        F.explode(F.sequence(block_at("start"), block_at("start + size - 1"))).alias("_block"))
    low = F.greatest(start_of(F.col("_block")), F.col("start"))
    high = F.least(start_of(F.col("_block") + 1), F.col("start") + F.col("size"))
    pieces = pieces.select("_source", "_block", "row", (low - F.col("start")).alias("word_start"),
                           (high - low).alias("n_words"))
    schedule = slots.join(pieces, F.col("source").eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block")))
    sized = laid.join(sources.select(F.col("source").alias("_source"), "source_size", "target"),
                      F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    return sized.select("row", "key", F.col("id").alias(id_column), "size", "source_size", "target"), schedule.select(
        "slot", "epoch", "row", "word_start", "n_words")


def taken_words(sized: DataFrame, schedule: DataFrame) -> DataFrame:
    """Add ``taken``: the words of each row that the schedule takes, repeats counted."""
    taken = schedule.groupBy("row").agg(F.sum("n_words").alias("taken"))
    return sized.join(taken, "row", "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))


def mix_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """All columns of every row, as often as the mix takes its words, to the nearest whole number.

    A row that the mix takes less than half of leaves, as does one without words.
    """
    sized, schedule = mix(docs, id_column=id_column, text_column=text_column, **options)
    key, times, copy = fresh(docs, "_key", "_copies", "_copy")
    copies = taken_words(sized, schedule).where("size > 0").groupBy(F.col("key").alias(key)).agg(
        F.round(F.sum("taken") / F.sum("size")).cast("int").alias(times)).where(F.col(times) > 0)
    keyed = docs.withColumn(key, F.xxhash64(id_column, text_column)).join(copies, key)
    return keyed.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times)))).select(docs.columns)
