"""Weather fact and the daily weather aggregate per bidding zone."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtide.functions.labels import is_member, technology_group
from gridtide.functions.numeric import round_half_up, within
from gridtide.operators.keep_last import keep_last_of_day
from gridtide.reference_data import RENEWABLE_WEATHER, WEATHER_LIMITS
from gridtide.schemas import AGG_DAILY_BIDDING_ZONE, FACT_HOURLY_WEATHER, conform

# With the limits of wind speed this bounds the distinct speeds of the percentile.
WIND_SPEED_DIGITS = 3

WEATHER_FACT_KEY = ["observation_timestamp_utc", "cluster_name"]

ZONE_GROUP = [
    "event_date",
    "country_code",
    "country",
    "bidding_zone",
    "technology",
    "technology_group",
    "is_renewable",
]


def null_outside_limits(
    df: DataFrame, limits: Mapping[str, tuple[float, float]] = WEATHER_LIMITS
) -> DataFrame:
    """Turn implausible measures into null; columns the frame lacks are skipped."""
    checked = {
        name: within(name, low, high)
        for name, (low, high) in limits.items()
        if name in df.columns
    }
    return df.withColumns(checked)


def fact_hourly_weather(
    observations: DataFrame,
    key: Sequence[str] = WEATHER_FACT_KEY,
    limits: Mapping[str, tuple[float, float]] = WEATHER_LIMITS,
    renewable: Iterable[str] = RENEWABLE_WEATHER,
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """One observation per time and site, measures checked, technology labelled."""
    latest = null_outside_limits(keep_last_of_day(observations, key, tiebreak=tiebreak), limits)
    labelled = latest.withColumns(
        {
            "wind_speed_100m": round_half_up("wind_speed_100m", WIND_SPEED_DIGITS),
            "technology_group": technology_group("technology"),
            "is_renewable": is_member("technology", renewable),
        }
    )
    return conform(labelled, FACT_HOURLY_WEATHER)


_MEANS = {
    "temperature_2m_avg": "temperature_2m",
    "relative_humidity_avg": "relative_humidity_2m",
    "surface_pressure_avg": "surface_pressure",
    "cloud_cover_avg": "cloud_cover",
    "shortwave_radiation_avg": "shortwave_radiation",
    "direct_radiation_avg": "direct_radiation",
    "diffuse_radiation_avg": "diffuse_radiation",
    "gti_avg": "global_tilted_irradiance",
    "wind_speed_100m_avg": "wind_speed_100m",
}
_LOWEST = {"temperature_2m_min": "temperature_2m"}
_HIGHEST = {
    "temperature_2m_max": "temperature_2m",
    "wind_speed_100m_max": "wind_speed_100m",
    "wind_gusts_10m_max": "wind_gusts_10m",
}


def kwh_per_m2(total: Column) -> Column:
    """Sum of hourly W/m² to kWh/m²; null when nothing was observed."""
    return round_half_up(total / 1000, 3)


def daily_bidding_zone(weather: DataFrame) -> DataFrame:
    """Daily weather per zone and technology, with the exact 90th wind percentile.

    One grouping, combined before the shuffle.  The percentile counts readings
    per distinct wind speed; the fact holds speeds of 0 to 120 with three
    decimals, so a zone has at most 120 001 counts however many readings it has,
    and one partial count per task crosses the shuffle for a hot zone.
    Where the percentile is not asked for, it is not computed.
    """
    final = {name: F.avg(source) for name, source in _MEANS.items()}
    final |= {name: F.min(source) for name, source in _LOWEST.items()}
    final |= {name: F.max(source) for name, source in _HIGHEST.items()}
    final["precipitation_sum_mm"] = F.coalesce(F.sum("precipitation"), F.lit(0.0))
    speed = round_half_up("wind_speed_100m", WIND_SPEED_DIGITS)
    final["wind_speed_100m_p90"] = F.percentile(speed, 0.9)
    rounded = {name: round_half_up(value, 3) for name, value in final.items()}
    rounded["shortwave_daily_kwh_m2"] = kwh_per_m2(F.sum("shortwave_radiation"))
    rounded["gti_daily_kwh_m2"] = kwh_per_m2(F.sum("global_tilted_irradiance"))
    rounded["observation_count"] = F.count("observation_timestamp_utc")
    daily = weather.groupBy(*ZONE_GROUP).agg(*[v.alias(k) for k, v in rounded.items()])
    return conform(daily, AGG_DAILY_BIDDING_ZONE)
