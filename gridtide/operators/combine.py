"""Joins between generation, load, forecast and weather.

``event_date`` is the UTC date of the time column in every table, so it joins
along with the time.  That costs nothing and lets a filter on one day prune the
partitions of both sides.  Each right side is reduced to the columns it gives
before the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtide.functions.labels import technology_family
from gridtide.reference_data import ACTUAL_LOAD, WEATHER_DRIVEN

HOUR_KEY = ["event_date", "area_code", "timestamp_utc"]


def actual_load(load: DataFrame) -> DataFrame:
    """Actual load per area and time.  The fact key allows one row for each."""
    actual = load.where(F.col("dataset") == ACTUAL_LOAD)
    return actual.select(*HOUR_KEY, F.col("quantity_mw").alias("load_mw"))


def with_actual_load(generation: DataFrame, load: DataFrame) -> DataFrame:
    """Inner join of rows per area and time with the actual load of that hour."""
    return generation.join(actual_load(load), HOUR_KEY)


def daily_with(left: DataFrame, right: DataFrame, how: str = "left", **columns: str) -> DataFrame:
    """Join daily rows to another daily table on country, day and zone.

    ``columns`` names what the right side gives (new name = its column).  Zone
    is ``bidding_zone`` in weather tables and ``area_name`` in generation
    tables, never the area code.
    """
    left_zone = "bidding_zone" if "bidding_zone" in left.columns else "area_name"
    right_zone = "bidding_zone" if "bidding_zone" in right.columns else "area_name"
    given = right.select(
        "country_code",
        "event_date",
        F.col(right_zone).alias(left_zone),
        *[F.col(source).alias(name) for name, source in columns.items()],
    )
    return left.join(given, ["country_code", "event_date", left_zone], how)


def hourly_with_generation(
    weather: DataFrame, generation: DataFrame, technologies: Sequence[str], how: str = "left"
) -> DataFrame:
    """Weather observations with the generation of the same zone and exact time."""
    given = generation.where(F.col("technology").isin(list(technologies))).select(
        "event_date",
        F.col("area_name").alias("bidding_zone"),
        F.col("timestamp_utc").alias("observation_timestamp_utc"),
        F.col("quantity_mw").alias("generation_mw"),
    )
    return weather.join(given, ["event_date", "bidding_zone", "observation_timestamp_utc"], how)


def mix_with_weather(mix: DataFrame, zones: DataFrame, *measures: str) -> DataFrame:
    """Daily mix of weather-driven technologies, left-joined to weather of their family."""
    left = mix.where(F.col("technology").isin(WEATHER_DRIVEN)).withColumn(
        "family", technology_family("technology")
    )
    right = zones.select(
        "country_code",
        "event_date",
        F.col("bidding_zone").alias("area_name"),
        technology_family("technology").alias("family"),
        *measures,
    )
    right = right.where(F.col("family").isNotNull())
    return left.join(right, ["country_code", "event_date", "area_name", "family"], "left")


def actual_with_forecast(generation: DataFrame, forecast: DataFrame) -> DataFrame:
    """Actual readings with every forecast of the same area, time and technology."""

    def known(df: DataFrame) -> DataFrame:
        return df.where(F.col("quantity_mw").isNotNull())

    actual = known(generation).where(F.col("technology").isin(WEATHER_DRIVEN))
    given = known(forecast).select(
        *HOUR_KEY, "technology", F.col("quantity_mw").alias("forecast_mw")
    )
    joined = actual.withColumnRenamed("quantity_mw", "actual_mw").join(
        given, [*HOUR_KEY, "technology"]
    )
    return joined.withColumn("error_mw", F.col("actual_mw") - F.col("forecast_mw"))


def with_hourly_weather(readings: DataFrame, weather: DataFrame, *measures: str) -> DataFrame:
    """Readings with the weather of their zone, time and technology family."""
    given = weather.select(
        "event_date",
        F.col("bidding_zone").alias("area_name"),
        F.col("observation_timestamp_utc").alias("timestamp_utc"),
        technology_family("technology").alias("family"),
        *measures,
    ).where(F.col("family").isNotNull())
    left = readings.withColumn("family", technology_family("technology"))
    return left.join(given, ["event_date", "area_name", "timestamp_utc", "family"])
