"""Weather readings: append ingest by event date and daily averages kept up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

READING = "event_timestamp timestamp_ntz, temperature_c double, wind_speed_kph double, relative_humidity double, is_day boolean"
DAY = ("weather_date date, avg_daily_temperature_c double, avg_daily_wind_speed_kph double, "
       "avg_daily_relative_humidity double, day_proportion double")
FILES_PER_DATE = 4


def read_files(spark: SparkSession, folder: str, schema: StructType | str, glob: str = "*.parquet",
               files_per_batch: int = 1000) -> DataFrame:
    """Parquet files of a folder as a stream with a declared schema."""
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    )


def ingest(readings: DataFrame, table: str, checkpoint: str) -> None:
    """Append all available readings to a table partitioned by event date.

    The file sink commits whole batches and the checkpoint remembers the files read, so a restart
    or a retried task adds nothing twice.
    """
    dated = readings.withColumn("event_date", F.to_date("event_timestamp"))
    # A date is written by at most FILES_PER_DATE tasks of a batch, not by every task that read some of it.
    spread = F.pmod(F.xxhash64("event_timestamp"), F.lit(FILES_PER_DATE))
    query = (
        dated.repartition("event_date", spread)
        .writeStream.format("parquet").partitionBy("event_date")
        .option("path", table).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()


def daily_averages(readings: DataFrame) -> DataFrame:
    """Daily means as a streaming aggregate; the state is one row per calendar day.

    No watermark: a late reading still changes its day, as in the batch mart.
    """
    days = readings.groupBy(F.window("event_timestamp", "1 day")).agg(
        F.avg("temperature_c").alias("avg_daily_temperature_c"),
        F.avg("wind_speed_kph").alias("avg_daily_wind_speed_kph"),
        F.avg("relative_humidity").alias("avg_daily_relative_humidity"),
        F.avg(F.when(F.col("is_day"), 1.0).otherwise(0.0)).alias("day_proportion"),
    )
    return days.select(
        F.to_date("window.start").alias("weather_date"), "avg_daily_temperature_c", "avg_daily_wind_speed_kph",
        "avg_daily_relative_humidity", "day_proportion",
    )


def run_daily(readings: DataFrame, table: str, checkpoint: str) -> DataFrame:
    """Run the daily aggregate over all available files and return its current result.

    Each batch writes the complete result, a row per calendar day, to a folder of its own under ``table``;
    a retried batch overwrites its folder, and readers take the latest one.
    """
    done: list[int] = []

    def store(result: DataFrame, batch: int) -> None:
        result.write.mode("overwrite").parquet(f"{table}/batch={batch}")
        done.append(batch)

    averages = daily_averages(readings)
    query = (
        averages.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
        .outputMode("complete").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    spark = readings.sparkSession
    stored = spark.read.schema(f"{DAY}, batch bigint").parquet(table)
    latest = max(done) if done else stored.agg(F.max("batch")).first()[0]
    return stored.where(F.col("batch") == latest).drop("batch")
