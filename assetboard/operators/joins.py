"""Lookup joins against keyed tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

NULL_SALTS = 256


def lookup_join(left: DataFrame, right: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Left join to a table that is unique on its key, without a hot null key.

    ``on`` maps left columns to right columns; the right key columns are dropped. Rows whose key is
    null cannot match, so they are spread over salts instead of meeting in one shuffle partition.
    Hot non-null keys are left to AQE, which splits the left side of the join.
    """
    nullable = [key for key in on if left.schema[key].nullable]
    salted, keyed = left, right
    if nullable:
        missing = reduce(lambda a, b: a | b, [left[key].isNull() for key in nullable])
        salted = left.withColumn(
            "_salt",
            F.when(missing, F.pmod(F.xxhash64(*left.columns), F.lit(NULL_SALTS)) + 1).otherwise(F.lit(0)).cast("int"),
        )
        # Always 0, but from a generator: a literal would be folded out of the join key.
        keyed = right.select("*", F.explode(F.array(F.lit(0))).alias("_rsalt"))
    renamed = keyed.select(
        *[F.col(r).alias(f"_r_{r}") for r in on.values()],
        *[c for c in keyed.columns if c not in on.values()],
    )
    condition = salted["_salt"] == renamed["_rsalt"] if nullable else F.lit(True)
    for l, r in on.items():
        condition = condition & (salted[l] == renamed[f"_r_{r}"])
    return salted.join(renamed, condition, "left").drop("_salt", "_rsalt", *[f"_r_{r}" for r in on.values()])


def safe_left_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join that keeps the row count: a repeated right key fails the job.

    The right side is reduced by key, map-side first, before it meets the left side.
    """
    values = [c for c in right.columns if c not in keys]
    checked = right.groupBy(*keys).agg(
        F.count("*").alias("_copies"), F.first(F.struct(*values)).alias("_row")
    )
    unique = checked.select(
        *keys,
        F.when(F.col("_copies") == 1, F.col("_row"))
        .otherwise(F.raise_error(F.concat(F.lit("repeated key on the right side: "),
                                          F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]))))
        .alias("_row"),
    ).select(*keys, "_row.*")
    return lookup_join(left, unique, {k: k for k in keys})


def keep_matching(df: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    return df.join(ids.select(on).distinct(), on, "left_semi")


def keep_unmatched(df: DataFrame, ids: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows without a partner, null keys included."""
    keys = ids.select(*[F.col(r).alias(f"_k_{r}") for r in on.values()]).distinct()
    condition = F.lit(True)
    for l, r in on.items():
        condition = condition & (df[l] == keys[f"_k_{r}"])
    return df.join(keys, condition, "left_anti")
