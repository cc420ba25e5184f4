"""Reports over the analysis tables.

Each report takes the tables by name and returns an ordered frame.  ``ordered``
appends every other column to the sort keys: the order is then the same on
every run, and many rows with one sort value still spread over all range
partitions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtide.functions.labels import irradiance_bucket, wind_bucket
from gridtide.functions.numeric import (
    correlation,
    exact_mean,
    exact_sum,
    round_half_up,
    safe_ratio,
    sum_where,
)
from gridtide.functions.temporal import month_floor
from gridtide.operators.combine import (
    actual_with_forecast,
    daily_with,
    hourly_with_generation,
    mix_with_weather,
    with_actual_load,
    with_hourly_weather,
)
from gridtide.operators.market import safe_efficiency
from gridtide.plans.views import AREA_HOUR, Tables
from gridtide.reference_data import GENERATION_WIND, SOLAR, WEATHER_DRIVEN, WEATHER_WIND

MIN_HOURS = 10
MIN_WIND_SPEED = 5


def ordered(df: DataFrame, *first: Column) -> DataFrame:
    """Sort by the given columns, then by all columns."""
    return df.orderBy(*first, *[F.col(name).asc_nulls_last() for name in df.columns])


def up(name: str) -> Column:
    return F.col(name).asc_nulls_last()


def down(name: str) -> Column:
    return F.col(name).desc_nulls_last()


def on_day(df: DataFrame, day: str) -> DataFrame:
    return df.where(F.col("event_date") == F.lit(day).cast("date"))


def with_label(df: DataFrame, labels: list[str] | str) -> DataFrame:
    return df.where(F.col("technology").isin([labels] if isinstance(labels, str) else labels))


# --- checks -------------------------------------------------------------------


def table_row_counts(tables: Tables) -> DataFrame:
    """Rows of every table, one line per table."""
    counts = [
        table.agg(F.count("*").alias("rows")).select(F.lit(name).alias("tbl"), "rows")
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def average_daily_share(tables: Tables, since: str) -> DataFrame:
    """Mean renewable share per day and country."""
    mix = tables["agg_daily_generation_mix"]
    recent = mix.where(F.col("event_date") >= F.lit(since).cast("date"))
    mean = round_half_up(F.avg("area_renewable_share_pct"), 1)
    daily = recent.groupBy("event_date", "country").agg(mean.alias("renewable_share_pct"))
    return ordered(daily, up("event_date"), down("renewable_share_pct"))


# --- solar --------------------------------------------------------------------


def hourly_solar(tables: Tables, day: str) -> DataFrame:
    """Irradiance and solar generation, hour by hour, on one day."""
    sites = on_day(with_label(tables["fact_hourly_weather"], SOLAR), day)
    hours = hourly_with_generation(sites, tables["fact_generation"], [SOLAR]).select(
        "event_date",
        "bidding_zone",
        "cluster_name",
        "observation_timestamp_utc",
        F.col("global_tilted_irradiance").alias("gti_wm2"),
        "shortwave_radiation",
        "cloud_cover",
        F.col("generation_mw").alias("solar_mw"),
    )
    return ordered(hours, up("bidding_zone"), up("observation_timestamp_utc"))


def daily_solar_conversion(tables: Tables) -> DataFrame:
    """Energy per irradiation, best zones first."""
    zones = with_label(tables["agg_daily_bidding_zone"], SOLAR)
    mix = with_label(tables["agg_daily_generation_mix"], SOLAR)
    joined = daily_with(zones, mix, solar_total_mwh="total_mwh", solar_peak_mw="peak_mw")
    conversion = joined.select(
        "event_date",
        "country_code",
        "bidding_zone",
        "gti_daily_kwh_m2",
        "shortwave_daily_kwh_m2",
        "cloud_cover_avg",
        "solar_total_mwh",
        "solar_peak_mw",
        safe_efficiency("solar_total_mwh", "gti_daily_kwh_m2", 4).alias("mwh_per_kwh_m2"),
    )
    return ordered(conversion, down("mwh_per_kwh_m2"))


def solar_correlation(tables: Tables, min_hours: int = MIN_HOURS) -> DataFrame:
    """Correlation of solar generation with irradiance and clouds per zone."""
    sites = with_label(tables["fact_hourly_weather"], SOLAR)
    sites = sites.where(F.col("global_tilted_irradiance").isNotNull())
    hours = hourly_with_generation(sites, tables["fact_generation"], [SOLAR])
    measured = hours.where(F.col("generation_mw").isNotNull())

    def against(measure: str) -> Column:
        return round_half_up(correlation(measure, "generation_mw"), 4)

    zones = measured.groupBy("bidding_zone").agg(
        F.count("*").alias("hours"),
        against("global_tilted_irradiance").alias("corr_gti"),
        against("shortwave_radiation").alias("corr_shortwave"),
        against("cloud_cover").alias("corr_cloud_cover"),
    )
    return ordered(zones.where(F.col("hours") >= min_hours), down("corr_gti"))


def irradiance_buckets(tables: Tables) -> DataFrame:
    """Solar generation per irradiance bucket."""
    sites = with_label(tables["fact_hourly_weather"], SOLAR)
    sites = sites.where(F.col("global_tilted_irradiance").isNotNull())
    hours = hourly_with_generation(sites, tables["fact_generation"], [SOLAR])
    label = irradiance_bucket("global_tilted_irradiance").alias("irradiance_bucket")
    buckets = hours.groupBy("bidding_zone", label).agg(
        F.count("*").alias("hours"),
        round_half_up(F.avg("generation_mw"), 2).alias("avg_mw"),
        round_half_up(F.max("generation_mw"), 2).alias("peak_mw"),
    )
    return ordered(buckets, up("bidding_zone"), up("irradiance_bucket"))


# --- wind ---------------------------------------------------------------------


def hourly_wind(tables: Tables, day: str) -> DataFrame:
    """Wind and wind generation, hour by hour, on one day."""
    sites = on_day(with_label(tables["fact_hourly_weather"], WEATHER_WIND), day)
    hours = hourly_with_generation(sites, tables["fact_generation"], GENERATION_WIND).select(
        "event_date",
        "bidding_zone",
        "technology",
        "observation_timestamp_utc",
        "wind_speed_100m",
        "wind_gusts_10m",
        "wind_direction_100m",
        F.col("generation_mw").alias("wind_mw"),
    )
    return ordered(hours, up("bidding_zone"), up("observation_timestamp_utc"))


def wind_correlation(tables: Tables, min_hours: int = MIN_HOURS) -> DataFrame:
    """Correlation of wind generation with speed and gusts per zone and technology."""
    sites = with_label(tables["fact_hourly_weather"], WEATHER_WIND)
    sites = sites.where(F.col("wind_speed_100m").isNotNull())
    hours = hourly_with_generation(sites, tables["fact_generation"], GENERATION_WIND)
    measured = hours.where(F.col("generation_mw").isNotNull())
    zones = measured.groupBy("bidding_zone", "technology").agg(
        F.count("*").alias("hours"),
        round_half_up(correlation("wind_speed_100m", "generation_mw"), 4).alias("corr_wind_speed"),
        round_half_up(correlation("wind_gusts_10m", "generation_mw"), 4).alias("corr_gusts"),
        round_half_up(F.avg("wind_speed_100m"), 2).alias("avg_wind_speed"),
        round_half_up(F.avg("generation_mw"), 2).alias("avg_generation_mw"),
    )
    return ordered(zones.where(F.col("hours") >= min_hours), down("corr_wind_speed"))


def wind_buckets(tables: Tables) -> DataFrame:
    """Wind generation per wind-speed bucket."""
    sites = with_label(tables["fact_hourly_weather"], WEATHER_WIND)
    sites = sites.where(F.col("wind_speed_100m").isNotNull())
    hours = hourly_with_generation(sites, tables["fact_generation"], GENERATION_WIND)
    label = wind_bucket("wind_speed_100m").alias("wind_bucket")
    buckets = hours.groupBy("bidding_zone", "technology", label).agg(
        F.count("*").alias("hours"),
        round_half_up(F.avg("generation_mw"), 2).alias("avg_mw"),
        round_half_up(F.max("generation_mw"), 2).alias("peak_mw"),
        round_half_up(F.min("generation_mw"), 2).alias("min_mw"),
    )
    return ordered(buckets, up("bidding_zone"), up("wind_bucket"))


# --- benchmarks ---------------------------------------------------------------


def normalized_peak(tables: Tables) -> DataFrame:
    """Daily mean and peak relative to the highest peak of the area and technology.

    The window holds one row per day of one area, and the peak is computed once.
    """
    mix = with_label(tables["agg_daily_generation_mix"], WEATHER_DRIVEN)
    history = Window.partitionBy("area_code", "technology")
    days = mix.select(
        "event_date",
        "area_code",
        "country_code",
        "technology",
        "avg_mw",
        "peak_mw",
        F.max("peak_mw").over(history).alias("zone_hist_peak"),
    )
    normalized = days.withColumns(
        {
            "normalized_avg": safe_efficiency("avg_mw", "zone_hist_peak", 4),
            "normalized_peak": safe_efficiency("peak_mw", "zone_hist_peak", 4),
        }
    )
    return ordered(normalized, up("event_date"), up("area_code"), up("technology"))


def weather_score(tables: Tables) -> DataFrame:
    """Daily energy per unit of the weather behind it."""
    joined = mix_with_weather(
        tables["agg_daily_generation_mix"],
        tables["agg_daily_bidding_zone"],
        "gti_daily_kwh_m2",
        "wind_speed_100m_avg",
        "wind_speed_100m_p90",
    )
    score = F.when(
        F.col("technology") == SOLAR, safe_efficiency("total_mwh", "gti_daily_kwh_m2", 3)
    ).otherwise(safe_efficiency("total_mwh", "wind_speed_100m_avg", 3))
    scored = joined.select(
        "event_date",
        "country_code",
        "technology",
        "total_mwh",
        "area_renewable_share_pct",
        "gti_daily_kwh_m2",
        "wind_speed_100m_avg",
        "wind_speed_100m_p90",
        score.alias("weather_adjusted_score"),
    )
    return ordered(scored, down("weather_adjusted_score"))


def monthly_benchmark(tables: Tables) -> DataFrame:
    """Monthly energy, power and weather score per country and technology."""
    gti, wind = "gti_daily_kwh_m2", "wind_speed_100m_avg"
    joined = mix_with_weather(
        tables["agg_daily_generation_mix"], tables["agg_daily_bidding_zone"], gti, wind
    )
    is_solar = F.col("technology") == SOLAR
    driver = F.when(is_solar, F.col(gti)).otherwise(F.col(wind))
    score = safe_ratio(exact_sum("total_mwh"), exact_sum("driver"))
    months = (
        joined.withColumns({"month": month_floor("event_date"), "driver": driver})
        .groupBy("month", "country_code", "technology")
        .agg(
            exact_sum("total_mwh").alias("total_mwh"),
            round_half_up(exact_mean("avg_mw"), 2).alias("avg_mw"),
            round_half_up(exact_mean("driver"), 3).alias("avg_weather_intensity"),
            round_half_up(score, 4).alias("monthly_performance_score"),
        )
    )
    return ordered(months, up("month"), down("monthly_performance_score"))


# --- forecast -----------------------------------------------------------------


def forecast_error(tables: Tables, day: str) -> DataFrame:
    """Actual generation against forecast, hour by hour, on one day."""
    pairs = actual_with_forecast(
        on_day(tables["fact_generation"], day), tables["fact_generation_forecast"]
    )
    share = safe_ratio(F.abs("error_mw"), "actual_mw") * 100
    errors = pairs.select(
        "event_date",
        "area_code",
        "country_code",
        "technology",
        "timestamp_utc",
        "actual_mw",
        "forecast_mw",
        "error_mw",
        round_half_up(share, 2).alias("abs_pct_error"),
    )
    return ordered(errors, down("abs_pct_error"))


def error_against_weather(tables: Tables) -> DataFrame:
    """Forecast errors beside the weather of their hour."""
    pairs = actual_with_forecast(tables["fact_generation"], tables["fact_generation_forecast"])
    measures = ["wind_speed_100m", "wind_gusts_10m", "cloud_cover", "global_tilted_irradiance"]
    joined = with_hourly_weather(pairs, tables["fact_hourly_weather"], *measures)
    errors = joined.select(
        "area_code",
        "technology",
        *measures,
        "error_mw",
        F.abs("error_mw").alias("abs_error_mw"),
    )
    return ordered(errors, down("abs_error_mw"))


# --- load ---------------------------------------------------------------------


def load_coverage(tables: Tables, day: str) -> DataFrame:
    """Share of the load that wind, sun and all renewables cover, on one day."""
    hourly = on_day(tables["fact_generation"], day).groupBy(*AREA_HOUR).agg(
        F.sum("quantity_mw").alias("total_generation_mw"),
        sum_where(F.col("technology").isin(WEATHER_DRIVEN), "quantity_mw").alias("wind_solar_mw"),
        sum_where(F.col("is_renewable"), "quantity_mw").alias("total_renewable_mw"),
    )

    def coverage(supply: str) -> Column:
        return round_half_up(safe_ratio(supply, "load_mw") * 100, 2)

    covered = with_actual_load(hourly, tables["fact_load"]).select(
        "event_date",
        "area_code",
        "area_name",
        "country_code",
        "timestamp_utc",
        "total_generation_mw",
        "wind_solar_mw",
        "total_renewable_mw",
        "load_mw",
        coverage("wind_solar_mw").alias("wind_solar_coverage_pct"),
        coverage("total_renewable_mw").alias("renewable_coverage_pct"),
    )
    return ordered(covered, up("area_code"), up("timestamp_utc"))


# --- unusual days -------------------------------------------------------------


def solar_efficiency(tables: Tables) -> DataFrame:
    """Daily solar energy per irradiation against the mean of the country."""
    mix = with_label(tables["agg_daily_generation_mix"], SOLAR)
    zones = with_label(tables["agg_daily_bidding_zone"], SOLAR)
    zones = zones.where(F.col("gti_daily_kwh_m2") > 0)
    joined = daily_with(mix, zones, "inner", gti="gti_daily_kwh_m2")
    days = joined.groupBy("event_date", "country_code").agg(
        exact_sum("total_mwh").alias("solar_mwh"), exact_mean("gti").alias("avg_gti")
    )
    days = days.withColumn("efficiency", safe_efficiency("solar_mwh", "avg_gti", 4))
    mean = F.avg("efficiency").over(Window.partitionBy("country_code"))
    compared = days.withColumn("mean", mean).select(
        "event_date",
        "country_code",
        "solar_mwh",
        "avg_gti",
        "efficiency",
        round_half_up("mean", 4).alias("country_avg_efficiency"),
        round_half_up(F.col("efficiency") - F.col("mean"), 4).alias("vs_avg"),
    )
    return ordered(compared, up("vs_avg"))


def wind_underperformance(tables: Tables, above: float = MIN_WIND_SPEED) -> DataFrame:
    """Windy days with little wind energy, against the mean of the country."""
    mix = with_label(tables["agg_daily_generation_mix"], GENERATION_WIND)
    zones = with_label(tables["agg_daily_bidding_zone"], WEATHER_WIND)
    zones = zones.where(F.col("wind_speed_100m_avg") > above)
    joined = daily_with(
        mix, zones, "inner", speed="wind_speed_100m_avg", p90="wind_speed_100m_p90"
    )
    days = joined.groupBy("event_date", "country_code").agg(
        exact_sum("total_mwh").alias("wind_mwh"),
        exact_mean("speed").alias("avg_wind_speed"),
        exact_mean("p90").alias("p90_wind_speed"),
    )
    days = days.withColumn("mwh_per_ms", safe_efficiency("wind_mwh", "avg_wind_speed", 4))
    mean = F.avg("mwh_per_ms").over(Window.partitionBy("country_code"))
    compared = days.withColumn("mean", mean).select(
        "event_date",
        "country_code",
        "wind_mwh",
        "avg_wind_speed",
        "p90_wind_speed",
        "mwh_per_ms",
        round_half_up("mean", 4).alias("avg_mwh_per_ms"),
        round_half_up(safe_ratio("mwh_per_ms", "mean") - 1, 4).alias("performance_vs_avg"),
    )
    return ordered(compared, up("performance_vs_avg"))
