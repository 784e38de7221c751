"""Names of queries and their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from assetboard.sources.stand_ins import Inputs, oracle_text

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register ``fn(inputs) -> DataFrame`` under a name."""

    def register(fn: Callable[[Inputs], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(Inputs(spark, folder))
        if oracle is not None:
            ORACLES[name] = oracle_text(oracle)
        return fn

    return register


def r(expression: str, digits: int = 6) -> str:
    """SQL text of ``grid_round``."""
    scale = f"1e{digits}"
    return f"(floor(({expression}) * {scale} + 0.5) / {scale})"
