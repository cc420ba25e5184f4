"""Market facts and the daily generation mix."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtide.functions.labels import is_member
from gridtide.functions.numeric import (
    not_negative,
    positive,
    round_half_up,
    safe_ratio,
    sum_where,
)
from gridtide.functions.temporal import resolution_hours
from gridtide.operators.keep_last import keep_last_of_day
from gridtide.reference_data import RENEWABLE_GENERATION
from gridtide.schemas import (
    AGG_DAILY_GENERATION_MIX,
    FACT_GENERATION,
    FACT_GENERATION_FORECAST,
    FACT_LOAD,
    FACT_PRICES,
    conform,
)

GENERATION_KEY = ["timestamp_utc", "area_code", "psr_type"]
LOAD_KEY = ["timestamp_utc", "area_code", "dataset"]
PRICE_KEY = ["timestamp_utc", "area_code"]
FORECAST_KEY = ["timestamp_utc", "area_code", "psr_type", "business_type_label", "dataset"]

MIX_GROUP = [
    "event_date",
    "country_code",
    "country",
    "area_code",
    "area_name",
    "technology",
    "psr_type",
    "is_renewable",
]


def fact_generation(
    readings: DataFrame,
    key: Sequence[str] = GENERATION_KEY,
    renewable: Iterable[str] = RENEWABLE_GENERATION,
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """Actual generation, one row per key; a negative reading becomes null."""
    latest = keep_last_of_day(readings, key, tiebreak=tiebreak)
    flagged = latest.withColumns(
        {
            "quantity_mw": not_negative("quantity_mw"),
            "is_renewable": is_member("technology", renewable),
        }
    )
    return conform(flagged, FACT_GENERATION)


def fact_load(
    readings: DataFrame, key: Sequence[str] = LOAD_KEY, tiebreak: Sequence[str] | None = None
) -> DataFrame:
    """Actual and forecast load; zero counts as missing here, unlike generation."""
    latest = keep_last_of_day(readings, key, tiebreak=tiebreak)
    return conform(latest.withColumn("quantity_mw", positive("quantity_mw")), FACT_LOAD)


def fact_prices(
    readings: DataFrame, key: Sequence[str] = PRICE_KEY, tiebreak: Sequence[str] | None = None
) -> DataFrame:
    """Day-ahead prices.  The null test follows keep-last: a null latest price removes the key."""
    latest = keep_last_of_day(readings, key, tiebreak=tiebreak)
    return conform(latest.where(F.col("price_amount").isNotNull()), FACT_PRICES)


def fact_generation_forecast(
    readings: DataFrame,
    key: Sequence[str] = FORECAST_KEY,
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    present = [name for name in key if name in readings.columns]
    latest = keep_last_of_day(readings, present, tiebreak=tiebreak)
    return conform(
        latest.withColumn("quantity_mw", not_negative("quantity_mw")), FACT_GENERATION_FORECAST
    )


def energy_mwh(power: str = "quantity_mw", resolution: str = "resolution") -> Column:
    return F.col(power) * resolution_hours(resolution)


def mix_totals(generation: DataFrame, group: Sequence[str] = MIX_GROUP) -> DataFrame:
    """Unrounded totals per group over rows with a reading; null group keys are kept."""
    measured = generation.where(F.col("quantity_mw").isNotNull())
    return measured.groupBy(*group).agg(
        F.sum(energy_mwh()).alias("total_mwh"),
        F.avg("quantity_mw").alias("avg_mw"),
        F.max("quantity_mw").alias("peak_mw"),
        F.min("quantity_mw").alias("min_mw"),
        F.count("quantity_mw").alias("observation_count"),
    )


def renewable_share(total: str = "total_mwh") -> Column:
    """Renewable percentage of a day and area, from rows of the daily mix.

    Null for a null area, for a total that is not positive, and for an area
    without any renewable row.  The window runs over daily totals: one
    partition holds the technologies of one area and day, however many
    readings stand behind them.
    """
    area_day = Window.partitionBy("event_date", "area_code")
    whole = F.sum(total).over(area_day)
    renewable = sum_where(F.col("is_renewable"), total).over(area_day)
    share = round_half_up(renewable / F.nullif(whole, F.lit(0.0)) * 100, 2)
    return F.when(F.col("area_code").isNotNull() & (whole > 0), share)


def daily_generation_mix(generation: DataFrame) -> DataFrame:
    """Daily energy per area and technology, with the renewable share of the area."""
    shared = mix_totals(generation).withColumn("area_renewable_share_pct", renewable_share())
    rounded = {
        name: round_half_up(name, 3) for name in ["total_mwh", "avg_mw", "peak_mw", "min_mw"]
    }
    return conform(shared.withColumns(rounded), AGG_DAILY_GENERATION_MIX)


def safe_efficiency(energy: str, driver: str, digits: int) -> Column:
    """Energy per unit of the weather that drives it."""
    return round_half_up(safe_ratio(energy, driver), digits)
