"""Landed records to cleaned records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtide.functions.labels import blank_to_null, label_of
from gridtide.functions.numeric import round_half_up, to_number
from gridtide.functions.temporal import utc_from_text
from gridtide.operators.keep_last import keep_last
from gridtide.reference_data import PROCESS_TYPES, SOLAR, STATUS_OK, WEATHER_WIND
from gridtide.schemas import (
    MARKET_CLEAN,
    SOLAR_MEASURES,
    WEATHER_CLEAN,
    WEATHER_MEASURES,
    WIND_MEASURES,
    conform,
)

SOURCE_FILE = "source_file"

MARKET_KEY = ["timestamp_utc", "area_code", "psr_type", "business_type_label"]
WEATHER_KEY = [
    "observation_timestamp_utc",
    "country_code",
    "bidding_zone",
    "technology",
    "cluster_name",
]

_BLANKABLE = [
    "document_type",
    "process_type",
    "period_start",
    "period_end",
    "resolution",
    "business_type_label",
    "psr_type",
    "technology",
    "in_domain",
    "out_domain",
    "value_type",
    "unit",
    "currency_unit",
    "price_measure_unit",
]


def _rounded(name: str, digits: int) -> Column:
    return round_half_up(to_number(name), digits)


def _with_file(columns: list[Column], df: DataFrame) -> list[Column]:
    return [*columns, F.col(SOURCE_FILE)] if SOURCE_FILE in df.columns else columns


def project_market(records: DataFrame) -> DataFrame:
    """Valid market readings with the columns of ``MARKET_CLEAN``.

    Keeps rows with status ``ok`` and a readable time.
    """
    time = utc_from_text("timestamp_utc")
    readings = records.where(F.col("status") == STATUS_OK).withColumn("timestamp_utc", time)
    readings = readings.where(F.col("timestamp_utc").isNotNull())
    made = {
        "event_date": F.to_date("timestamp_utc").cast("string"),
        "ingested_at": utc_from_text("ingested_at"),
        "process_type_label": label_of("process_type", PROCESS_TYPES),
        "quantity_mw": _rounded("quantity_mw", 3),
        "price_amount": _rounded("price_amount", 4),
        **{name: blank_to_null(name) for name in _BLANKABLE},
    }
    columns = [made.get(name, F.col(name)).alias(name) for name in MARKET_CLEAN.names]
    return readings.select(*_with_file(columns, records))


def measures_by_technology(technology: str = "technology") -> dict[str, Column]:
    """Solar sites keep sky measures, wind sites keep wind measures, others keep both."""
    is_solar = F.coalesce(F.col(technology) == SOLAR, F.lit(False))
    is_wind = F.coalesce(F.col(technology).isin(WEATHER_WIND), F.lit(False))
    kept = {name: F.when(~is_wind, F.col(name)) for name in SOLAR_MEASURES}
    kept |= {name: F.when(~is_solar, F.col(name)) for name in WIND_MEASURES}
    return kept


def project_weather(records: DataFrame) -> DataFrame:
    """Weather observations with the columns of ``WEATHER_CLEAN``.

    Unreadable times become null; the partitioned sink leaves such rows out.
    """
    observed = records.withColumn("observation_timestamp_utc", utc_from_text("current_time"))
    measures = {name: F.col(name) for name in WEATHER_MEASURES} | measures_by_technology()
    made = {
        "event_date": F.to_date("observation_timestamp_utc").cast("string"),
        "ingested_at": utc_from_text("ingested_at"),
        **{name: round_half_up(to_number(value), 3) for name, value in measures.items()},
    }
    columns = [made.get(name, F.col(name)).alias(name) for name in WEATHER_CLEAN.names]
    return observed.select(*_with_file(columns, records))


def _scope(df: DataFrame, keys: list[str], extra: list[str]) -> list[str]:
    """Key columns plus those that tell datasets and landed files apart."""
    return [*keys, *[name for name in extra if name in df.columns]]


def clean_market(records: DataFrame) -> DataFrame:
    """Cleaned market readings, the latest per key within each landed file.

    Dataset and file belong to the key: many files are cleaned in one job, and
    a forecast must not replace an actual value of the same hour.
    """
    rows = project_market(records)
    rows = keep_last(rows, _scope(rows, MARKET_KEY, ["dataset", SOURCE_FILE]))
    return conform(rows, MARKET_CLEAN)


def clean_weather(records: DataFrame) -> DataFrame:
    rows = project_weather(records)
    rows = keep_last(rows, _scope(rows, WEATHER_KEY, [SOURCE_FILE]))
    return conform(rows, WEATHER_CLEAN)
