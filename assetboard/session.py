"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key on the fact side of a lookup is split even when that costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app_name: str = "assetboard", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; ``conf`` entries win."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(cores: int | str = 8, **conf: str) -> SparkSession:
    """The session used by tests and the bench."""
    return build_session(
        master=f"local[{cores}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.host": "127.0.0.1",
            "spark.driver.bindAddress": "127.0.0.1",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": "8",
            **conf,
        },
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to storage that all executors share")
    folder = tempfile.mkdtemp(prefix="assetboard-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def land(df: DataFrame, label: str = "landed") -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    The result has fixed content and row tags, so a lost executor re-reads it instead of re-running
    a sort whose range bounds could differ.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_absent(spark: SparkSession, path: str) -> bool:
    """True when ``path`` does not exist on the file system that owns it."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return not fs.exists(jpath)


def env_cores(default: int = 8) -> int:
    return int(os.environ.get("BENCH_CPUS", default))
