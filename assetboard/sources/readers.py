"""Scans: delimited files, nested JSON, JSON inside HTML, parallel arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from assetboard.functions.text import lenient_number
from assetboard.session import is_absent

# The fields read from the price payloads.
PRICE_ITEM = ("array<struct<player:struct<name:string,position:string,mflId:string,sleeperId:string,espnId:string>,"
              "value:double,overallRank:int>>")
RANKING_ITEM = ("array<struct<playerName:string,position:string,playerID:bigint,"
                "oneQBValues:struct<value:double>,superflexValues:struct<value:double>>>")


def read_delimited(spark: SparkSession, path: str, schema: StructType | str, encoding: str = "ISO-8859-1") -> DataFrame:
    """Header CSV with a declared schema; no inference pass over the data."""
    return spark.read.csv(path, schema=schema, header=True, encoding=encoding, escape='"')


def price_rows(payloads: DataFrame, payload: str, keep: Sequence[str] = ()) -> DataFrame:
    """Nested price documents to flat rows; optional members become null, ids become numbers."""
    items = payloads.select(*keep, F.explode(F.from_json(payload, PRICE_ITEM)).alias("d"))
    return items.select(
        *keep,
        F.col("d.player.name").alias("name"),
        F.col("d.player.position").alias("position"),
        lenient_number(F.col("d.player.mflId"), "bigint").alias("mfl_id"),
        F.col("d.player.sleeperId").alias("sleeper_id"),
        lenient_number(F.col("d.player.espnId"), "bigint").alias("espn_id"),
        F.col("d.value").alias("value"),
        F.col("d.overallRank").alias("overall_rank"),
    )


def embedded_array(html: Column, variable: str = "playersArray") -> Column:
    """Text of the JSON array assigned to a script variable; a page without it fails the job."""
    text = F.regexp_extract(html, rf"(?s){variable}\s*=\s*(\[.*?\]);", 1)
    return F.when(text != "", text).otherwise(F.raise_error(F.lit(f"{variable} not found in page")))


def ranking_rows(pages: DataFrame, html: str, keep: Sequence[str] = (), positions: Sequence[str] | None = None) -> DataFrame:
    """Player rows of ranking pages."""
    items = pages.select(*keep, F.explode(F.from_json(embedded_array(F.col(html)), RANKING_ITEM)).alias("d"))
    rows = items.select(
        *keep,
        F.col("d.playerName").alias("name"), F.col("d.position").alias("position"), F.col("d.playerID").alias("player_id"),
        F.col("d.oneQBValues.value").alias("oneqb_value"), F.col("d.superflexValues.value").alias("sf_value"),
    )
    return rows.where(F.col("position").isin(*positions)) if positions else rows


def parallel_arrays(df: DataFrame, arrays: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Arrays of equal length to rows."""
    return df.select(*keep, F.inline(F.arrays_zip(*[F.col(a) for a in arrays])))


def read_board(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A published board; an absent path is an empty board."""
    if is_absent(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)
