"""The five named views.

Views that compare generation with something else aggregate generation to the
join key first: partial sums form before the shuffle and the join sees one
generation row per key.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtide.functions.numeric import exact_sum, round_half_up, safe_ratio, sum_where
from gridtide.operators.combine import HOUR_KEY, daily_with, with_actual_load
from gridtide.reference_data import GENERATION_WIND, SOLAR, WEATHER_WIND

Tables = Mapping[str, DataFrame]

AREA_HOUR = [*HOUR_KEY, "area_name", "country_code", "country"]


def supply_demand(tables: Tables) -> DataFrame:
    """Hourly generation against load per area."""
    hourly = tables["fact_generation"].groupBy(*AREA_HOUR).agg(
        F.sum("quantity_mw").alias("total_generation_mw"),
        sum_where(F.col("is_renewable"), "quantity_mw").alias("renewable_mw"),
    )
    return with_actual_load(hourly, tables["fact_load"]).select(
        "event_date",
        "area_code",
        "area_name",
        "country_code",
        "country",
        "timestamp_utc",
        "total_generation_mw",
        "renewable_mw",
        F.col("load_mw").alias("total_load_mw"),
        (F.col("total_generation_mw") - F.col("load_mw")).alias("surplus_mw"),
    )


def daily_renewable_share(tables: Tables) -> DataFrame:
    """Daily energy and renewable share per area."""
    mix = tables["agg_daily_generation_mix"]
    renewable = F.when(F.col("is_renewable"), F.col("total_mwh"))
    return mix.groupBy("event_date", "country_code", "area_code").agg(
        exact_sum("total_mwh").alias("total_mwh"),
        exact_sum(renewable).alias("renewable_mwh"),
        F.max("area_renewable_share_pct").alias("renewable_share_pct"),
    )


def _performance(
    tables: Tables, weather_labels: list[str], labels: list[str], columns: list[str]
) -> DataFrame:
    zones = tables["agg_daily_bidding_zone"].where(F.col("technology").isin(weather_labels))
    generation = tables["fact_generation"].where(F.col("technology").isin(labels))
    generated = generation.groupBy("country_code", "event_date", "area_name").agg(
        F.sum("quantity_mw").alias("total_mw"), F.max("quantity_mw").alias("peak_mw")
    )
    joined = daily_with(zones.select(*columns), generated, total_mw="total_mw", peak_mw="peak_mw")
    return joined.groupBy(*columns).agg(
        F.sum("total_mw").alias("total_mw"), F.max("peak_mw").alias("peak_mw")
    )


def solar_performance(tables: Tables) -> DataFrame:
    """Daily solar generation against irradiance.

    ``total_solar_mwh`` adds MW readings as they are; the daily mix is the
    table that converts to energy.
    """
    columns = [
        "event_date",
        "country_code",
        "bidding_zone",
        "shortwave_daily_kwh_m2",
        "gti_daily_kwh_m2",
        "cloud_cover_avg",
        "shortwave_radiation_avg",
    ]
    performance = _performance(tables, [SOLAR], [SOLAR], columns)
    per_irradiance = round_half_up(safe_ratio("peak_mw", "shortwave_radiation_avg"), 4)
    return performance.select(
        *columns,
        F.col("total_mw").alias("total_solar_mwh"),
        F.col("peak_mw").alias("peak_solar_mw"),
        per_irradiance.alias("peak_mw_per_avg_wm2"),
    )


def wind_performance(tables: Tables) -> DataFrame:
    """Daily wind generation against wind speed.

    A zone with both wind technologies shows all its wind generation beside
    each of them, as generation and weather are matched by zone here.
    """
    columns = [
        "event_date",
        "country_code",
        "bidding_zone",
        "technology",
        "wind_speed_100m_avg",
        "wind_speed_100m_max",
        "wind_speed_100m_p90",
    ]
    performance = _performance(tables, WEATHER_WIND, GENERATION_WIND, columns)
    return performance.select(
        *columns,
        F.col("total_mw").alias("total_wind_mwh"),
        F.col("peak_mw").alias("peak_wind_mw"),
    )


def area_lookup(tables: Tables) -> DataFrame:
    """Distinct areas with their names."""
    areas = ["area_code", "area_name", "country_code", "country"]
    return tables["fact_generation"].select(*areas).distinct()


VIEWS = {
    "v_supply_demand": supply_demand,
    "v_daily_renewable_share": daily_renewable_share,
    "v_solar_performance": solar_performance,
    "v_wind_performance": wind_performance,
    "v_area_lookup": area_lookup,
}


def register_views(tables: Tables) -> None:
    """Make tables and views available to ``spark.sql``."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
    for name, view in VIEWS.items():
        view(tables).createOrReplaceTempView(name)
