"""Shards balanced jointly in bytes, tokens and rows, by vector bin packing.

Rows with equal texts form a group, which is placed whole where the dot product of its demand with a
shard's residual capacity is highest; groups are taken largest first. A group that outweighs a part's
fair share (in bytes or rows) is split into units by a hash of its ids, so that no group, however large,
lands in one task or one shard. The units are dealt by hash into parts of about ``units_per_part``; each
part packs its own share of every shard's capacity, so parts are independent and the shards' sums stay
near equal. ``slot`` numbers a shard's rows from 0 without gaps.

Null texts have size 1 (0 bytes plus 1), no tokens, and form one group. Null ids are rows like others.
An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assetboard.llm.common import WORD, blocks_for, text_bytes
from assetboard.session import land

UNITS_PER_PART = 4096
#: Bytes are the law that must hold; tokens and rows are balanced beside it.
WEIGHTS = np.array([16.0, 1.0, 1.0])


def place(demand: np.ndarray, shards: int, taken: np.ndarray | None = None) -> np.ndarray:
    """Shard of each unit; ``demand`` holds bytes, tokens and rows per unit, ``taken`` what shards hold already."""
    taken = np.zeros((shards, demand.shape[1])) if taken is None else taken
    share = np.maximum((demand.sum(axis=0) + taken.sum(axis=0)) / shards, 1)
    need = demand / share
    residual = 1 - taken / share
    chosen = np.zeros(len(need), dtype=np.int64)
    for i in np.argsort(-(need @ WEIGHTS), kind="stable"):
        best = int(np.argmax(residual @ (need[i] * WEIGHTS)))
        chosen[i] = best
        residual[best] -= need[i]
    return chosen


def assign_shards(docs: DataFrame, shards: int = 8, id_column: str = "doc_id", text_column: str = "text",
                  units_per_part: int = UNITS_PER_PART) -> DataFrame:
    """(id, size, text_crc32, n_tokens, shard, slot) of every row."""
    text = F.col(text_column)
    rows = land(docs.select(
        F.col(id_column).alias("id"),
        (F.coalesce(text_bytes(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8")).alias("text_crc32"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("n_tokens"),
        F.coalesce(F.md5(F.encode(text, "UTF-8")), F.lit("")).alias("group"),
    ), "shard-rows")
    totals = rows.agg(F.count("*").alias("n"), F.sum("size").alias("size")).first()
    n, total = totals["n"], totals["size"] or 0
    parts = blocks_for(n, units_per_part)
    # Equal texts stay together unless they outweigh a quarter of a shard.
    most_bytes, most_rows = max(1, total // (shards * 4)), max(1, n // (shards * 4))

    # A group's number of units, at the row: hot groups are summed before the shuffle.
    groups = rows.groupBy("group").agg(F.sum("size").alias("b"), F.count("*").alias("r"))
    splits = groups.select("group", F.greatest(
        F.ceil(F.col("b") / most_bytes), F.ceil(F.col("r") / most_rows)).alias("splits")).where("splits > 1")
    salted = rows.join(splits, "group", "left").withColumn(
        "salt", F.pmod(F.xxhash64("id"), F.coalesce("splits", F.lit(1))))
    salted = salted.withColumn("unit", F.xxhash64("group", "salt"))
    units = land(salted.groupBy("group", "salt").agg(
        F.sum("size").alias("b"), F.sum("n_tokens").alias("t"), F.count("*").alias("r")), "shard-units")
    # What is large for a part is packed among its like and first; the parts then fill what it leaves in each shard.
    large = (F.col("b") > most_bytes / parts) | (F.col("r") > most_rows / parts)
    draw = F.xxhash64("group", "salt", F.lit(1))

    def packed(some: DataFrame, of: int, taken: np.ndarray | None) -> DataFrame:
        def pack(part: pd.DataFrame) -> pd.DataFrame:
            part = part.sort_values(["group", "salt"], kind="stable")
            first = int(part["part"].iloc[0]) % shards
            held = None if taken is None else np.roll(taken, -first, axis=0)
            chosen = place(part[["b", "t", "r"]].to_numpy(dtype=np.float64), shards, held)
            return pd.DataFrame({"group": part["group"], "salt": part["salt"], "shard": (chosen + first) % shards})

        return some.withColumn("part", F.pmod(draw, F.lit(of))).groupBy("part").applyInPandas(pack, "group string, salt long, shard int")

    heavy = units.where(large)
    placed = land(packed(heavy, blocks_for(heavy.count(), units_per_part), None), "shard-large")
    taken = np.zeros((shards, 3))
    for r in heavy.join(placed, ["group", "salt"]).groupBy("shard").agg(F.sum("b"), F.sum("t"), F.sum("r")).collect():
        taken[r[0]] = r[1:]
    placed = placed.union(packed(units.where(~large), parts, taken / parts))
    sharded = land(salted.drop("unit", "splits").join(placed, ["group", "salt"]), "shard-placed")
    return number_rows(sharded, "shard", n).select(
        F.col("id").alias(id_column), "size", "text_crc32", "n_tokens", "shard", "slot")


def number_rows(rows: DataFrame, key: str, n: int, per_block: int = 4096) -> DataFrame:
    """Add ``slot``: 0, 1, ... within each key, where a key may hold most rows.

    Rows are numbered within (key, block of ids); each block then starts where the ones before it end.
    """
    blocked = rows.withColumn("block", F.pmod(F.xxhash64("id", F.lit(2)), F.lit(blocks_for(n, per_block))))
    before = blocked.groupBy(key, "block").count().select(
        key, "block", (F.sum("count").over(Window.partitionBy(key).orderBy("block")) - F.col("count")).alias("start"))
    within = F.row_number().over(Window.partitionBy(key, "block").orderBy("id"))
    return blocked.withColumn("slot", within - 1).join(before, [key, "block"]).withColumn(
        "slot", (F.col("slot") + F.col("start")).cast("long")).drop("block", "start")
