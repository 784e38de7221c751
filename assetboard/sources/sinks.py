"""Writers: raw copies, partitioned marts, CSV exports, published boards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from assetboard.functions.numeric import null_if_nan


def raw_copy(df: DataFrame, path: str) -> DataFrame:
    """Replace the raw layer by the source as it is, and read it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitioned_mart(df: DataFrame, path: str, by: Sequence[str]) -> DataFrame:
    """Write partitioned by columns.

    Rows are rebalanced by the partition columns first, so each date gets few files and a hot date
    is split over several tasks.
    """
    df.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by).parquet(path)
    fields = [f for f in df.schema if f.name not in by] + [df.schema[c] for c in by]
    return df.sparkSession.read.schema(type(df.schema)(fields)).parquet(path)


def export_csv(df: DataFrame, path: str, encoding: str = "UTF-8") -> None:
    df.write.mode("overwrite").csv(path, header=True, encoding=encoding, escape='"')


def write_boards(board: DataFrame, path: str, boards: Sequence[str] = ("format", "team_size")) -> None:
    """One JSON document set per board; NaN is written as null and nulls are kept as members."""
    clean = board.select(*[
        null_if_nan(F.col(c)).alias(c) if kind in ("double", "float") else F.col(c) for c, kind in board.dtypes
    ])
    clean.hint("rebalance", *boards).write.mode("overwrite").partitionBy(*boards).option("ignoreNullFields", "false").json(path)


def write_snapshot(board: DataFrame, path: str, snapshot_date: str, boards: Sequence[str] = ("format", "team_size")) -> None:
    """Dated CSV copy of every board for movement tracking; a rerun of a date replaces that date only."""
    dated = board.withColumn("snapshot_date", F.lit(snapshot_date))
    dated.hint("rebalance", *boards).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "snapshot_date", *boards
    ).csv(path, header=True)
