"""Streaming ingest and the daily aggregate kept up to date."""

from pyspark.sql import functions as F

from assetboard.functions.numeric import grid_round
from assetboard.operators.marts import is_day
from assetboard.plans.registry import query, r
from assetboard.session import scratch_path
from assetboard.sources.stand_ins import Inputs
from assetboard.streaming import weather

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def readings(t: Inputs):
    """The events as a stream of weather readings."""
    events = weather.read_files(t.spark, t.folder, EVENTS, glob="events.parquet")
    return events.select(
        F.col("ts").alias("event_timestamp"), F.col("value").alias("temperature_c"), (F.col("event_id") % 37).cast("double").alias("wind_speed_kph"),
        (F.col("event_id") % 101).cast("double").alias("relative_humidity"), is_day(F.col("ts")).alias("is_day"))


@query("stream_ingest", """
    select event_timestamp, temperature_c, wind_speed_kph, relative_humidity, is_day, cast(event_timestamp as date) as event_date from @weather""")
def stream_ingest(t: Inputs):
    table, checkpoint = scratch_path(t.spark, "weather-table"), scratch_path(t.spark, "weather-checkpoint")
    for _ in range(2):  # the second run is a restart and must add nothing
        weather.ingest(readings(t), table, checkpoint)
    return t.spark.read.schema(f"{weather.READING}, event_date date").parquet(table)


@query("stream_daily", f"""
    select cast(event_timestamp as date) as weather_date, {r('avg(temperature_c)')} as avg_daily_temperature_c,
           {r('avg(wind_speed_kph)')} as avg_daily_wind_speed_kph, {r('avg(relative_humidity)')} as avg_daily_relative_humidity,
           {r('sum(case when is_day then 1 else 0 end) / count(*)')} as day_proportion
    from @weather group by 1""")
def stream_daily(t: Inputs):
    d = weather.run_daily(readings(t), scratch_path(t.spark, "daily"), scratch_path(t.spark, "daily-checkpoint"))
    return d.select("weather_date", *[grid_round(F.col(c)).alias(c) for c in d.columns if c != "weather_date"])
