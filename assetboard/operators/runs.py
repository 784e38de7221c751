"""Stored runs: what a later session needs to price changed features with the models of a run.

A run is a folder of tables (features, targets, picks, names, board, models). Its manifest is written last, so
a run that broke off is never seen; versions are never overwritten.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetboard.operators.learning import BoardFits
from assetboard.session import is_absent

TABLES = ("features", "targets", "picks", "names", "board")


@dataclass
class StoredRun:
    """One version of a run, as read back."""

    version: str
    features: DataFrame
    targets: DataFrame
    picks: DataFrame
    names: DataFrame
    board: DataFrame
    fits: BoardFits


def save_run(folder: str, version: str, fits: BoardFits, **tables: DataFrame) -> str:
    """Write a run under ``folder``; the tables are those of ``TABLES``. A version that exists is refused."""
    if set(tables) != set(TABLES):
        raise ValueError(f"a run holds {', '.join(TABLES)}")
    spark = tables["features"].sparkSession
    if not is_absent(spark, f"{folder}/manifest/version={version}"):
        raise ValueError(f"version {version} exists")
    path = f"{folder}/runs/{version}"
    for name, table in tables.items():
        # What an attempt that broke off has left under this version is replaced.
        table.write.mode("overwrite").parquet(f"{path}/{name}")
    fits.save(f"{path}/models", spark)
    rows = [(name, spark.read.parquet(f"{path}/{name}").count()) for name in TABLES]
    spark.createDataFrame(rows, "table string, n_rows long").withColumn("generated_at", F.current_timestamp()).coalesce(1).write.parquet(
        f"{folder}/manifest/version={version}")
    return path


def versions(spark: SparkSession, folder: str) -> DataFrame:
    """(version, generated_at) of the whole runs of a folder, latest first."""
    found = spark.read.option("basePath", f"{folder}/manifest").schema(
        "table string, n_rows long, generated_at timestamp, version string").parquet(f"{folder}/manifest")
    return found.groupBy("version").agg(F.max("generated_at").alias("generated_at")).orderBy(F.desc("generated_at"), F.desc("version"))


def load_run(spark: SparkSession, folder: str, version: str | None = None) -> StoredRun:
    """The given version of a run, or the latest whole one."""
    if version is None:
        version = versions(spark, folder).first()["version"]
    elif is_absent(spark, f"{folder}/manifest/version={version}"):
        raise ValueError(f"no whole run {version}")
    path = f"{folder}/runs/{version}"
    tables = {name: spark.read.parquet(f"{path}/{name}") for name in TABLES}
    return StoredRun(version, **tables, fits=BoardFits.load(f"{path}/models", spark))
