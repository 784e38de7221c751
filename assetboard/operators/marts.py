"""Member and weather marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from assetboard.operators.joins import lookup_join

DAY_HOURS = (6, 18)  # fixed values: both ends count as day


def is_day(ts: Column) -> Column:
    return F.hour(ts).between(*DAY_HOURS)


def curated_members(raw: DataFrame) -> DataFrame:
    """Tenure in days and a 0/1 churn label; an unknown churn counts as 0."""
    return raw.select(
        "*",
        F.date_diff("last_visit_date", "join_date").alias("tenure_days"),
        F.when(F.col("churn"), 1).otherwise(0).alias("churn_label"),
    )


def weather_daily(readings: DataFrame) -> DataFrame:
    """Daily means and the share of daytime readings."""
    return readings.groupBy(F.to_date("event_timestamp").alias("weather_date")).agg(
        F.avg("temperature_c").alias("avg_daily_temperature_c"),
        F.avg("wind_speed_kph").alias("avg_daily_wind_speed_kph"),
        F.avg("relative_humidity").alias("avg_daily_relative_humidity"),
        F.avg(F.when(F.col("is_day"), 1.0).otherwise(0.0)).alias("day_proportion"),
    )


def weather_monthly(readings: DataFrame) -> DataFrame:
    return readings.groupBy(F.year("event_timestamp").alias("year"), F.month("event_timestamp").alias("month")).agg(
        F.avg("temperature_c").alias("avg_temperature_c"),
        F.avg("wind_speed_kph").alias("avg_wind_speed_kph"),
        F.avg("relative_humidity").alias("avg_relative_humidity"),
    ).orderBy("year", "month")


def member_weather(members: DataFrame, readings: DataFrame) -> DataFrame:
    """Curated members with the weather of their last visit day; members without weather stay.

    Readings are reduced to one row per day before the join. The label is never null, so the label
    filter keeps every row.
    """
    joined = lookup_join(members, weather_daily(readings), {"last_visit_date": "weather_date"})
    return joined.where(F.col("churn_label").isNotNull()).select(
        "member_id", "churn_label", "tenure_days", "age", "gender", "membership_type",
        "avg_daily_temperature_c", "avg_daily_wind_speed_kph", "avg_daily_relative_humidity", "day_proportion",
    )
