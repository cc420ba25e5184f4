"""Declared schemas of every layer, and conformance of a frame to one of them.

``*_TIME`` columns are TIMESTAMP_NTZ in UTC.  All columns are nullable.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtide.functions.numeric import as_column
from gridtide.functions.temporal import utc_from_instant, utc_from_text

_KINDS = {
    "text": T.StringType(),
    "time": T.TimestampNTZType(),
    "date": T.DateType(),
    "real": T.DoubleType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "flag": T.BooleanType(),
}


def _schema(*parts: tuple[str, str]) -> T.StructType:
    """Build a schema from (kind, "name name ...") parts, in order."""
    return T.StructType(
        [T.StructField(name, _KINDS[kind]) for kind, names in parts for name in names.split()]
    )


_SITE_MEASURES = "response_lat response_lon"
_AIR = "temperature_2m relative_humidity_2m precipitation surface_pressure"
_SKY = (
    "cloud_cover shortwave_radiation direct_radiation diffuse_radiation global_tilted_irradiance"
)
_WIND = "wind_speed_100m wind_direction_100m wind_gusts_10m"

SOLAR_MEASURES = _SKY.split()
WIND_MEASURES = _WIND.split()
WEATHER_MEASURES = f"{_SITE_MEASURES} {_AIR} {_SKY} {_WIND}".split()

# --- landed records (one JSON object per line) ------------------------------

MARKET_RECORD = _schema(
    ("text", "ingested_at source dataset country_code country area_code area_name"),
    ("text", "timestamp_utc document_mrid revision_number document_type process_type"),
    ("text", "created_datetime document_time_start document_time_end"),
    ("text", "request_period_start request_period_end timeseries_mrid"),
    ("text", "business_type business_type_label object_aggregation in_domain out_domain"),
    ("text", "period_start period_end resolution"),
    ("int", "position"),
    ("real", "value"),
    ("text", "value_type"),
    ("real", "quantity_mw price_amount"),
    ("text", "unit currency_unit price_measure_unit psr_type technology status"),
    ("text", "response_type reason_code reason_text raw_xml_preview raw_xml error"),
)

WEATHER_RECORD = _schema(
    ("text", "ingested_at source dataset country_code country bidding_zone technology"),
    ("text", "cluster_name"),
    ("real", "requested_lat requested_lon response_lat response_lon elevation"),
    ("int", "utc_offset_seconds"),
    ("text", "current_time"),
    ("real", "temperature_2m relative_humidity_2m precipitation cloud_cover"),
    ("real", "shortwave_radiation direct_radiation diffuse_radiation global_tilted_irradiance"),
    ("real", "wind_speed_100m wind_direction_100m wind_gusts_10m surface_pressure"),
)

# --- cleaned records --------------------------------------------------------

MARKET_CLEAN = _schema(
    ("text", "event_date"),
    ("time", "timestamp_utc ingested_at"),
    ("text", "source dataset country_code country area_code area_name document_type"),
    ("text", "process_type process_type_label period_start period_end resolution"),
    ("text", "business_type_label psr_type technology in_domain out_domain value_type"),
    ("real", "quantity_mw price_amount"),
    ("text", "unit currency_unit price_measure_unit"),
)

WEATHER_CLEAN = _schema(
    ("time", "observation_timestamp_utc"),
    ("text", "event_date"),
    ("time", "ingested_at"),
    ("text", "source dataset country_code country bidding_zone technology cluster_name"),
    ("real", " ".join(WEATHER_MEASURES)),
)

# --- analysis tables --------------------------------------------------------

_AREA = "country_code country area_code area_name"

FACT_GENERATION = _schema(
    ("date", "event_date"),
    ("time", "timestamp_utc"),
    ("text", f"{_AREA} technology psr_type"),
    ("flag", "is_renewable"),
    ("text", "process_type_label business_type_label"),
    ("time", "period_start period_end"),
    ("text", "resolution"),
    ("real", "quantity_mw"),
    ("text", "unit source"),
    ("time", "ingested_at"),
)

FACT_LOAD = _schema(
    ("date", "event_date"),
    ("time", "timestamp_utc"),
    ("text", f"{_AREA} dataset process_type_label"),
    ("time", "period_start period_end"),
    ("text", "resolution"),
    ("real", "quantity_mw"),
    ("text", "unit source"),
    ("time", "ingested_at"),
)

FACT_PRICES = _schema(
    ("date", "event_date"),
    ("time", "timestamp_utc"),
    ("text", _AREA),
    ("time", "period_start period_end"),
    ("text", "resolution"),
    ("real", "price_amount"),
    ("text", "currency_unit price_measure_unit source"),
    ("time", "ingested_at"),
)

FACT_GENERATION_FORECAST = _schema(
    ("date", "event_date"),
    ("time", "timestamp_utc"),
    ("text", f"{_AREA} dataset technology psr_type business_type_label process_type_label"),
    ("time", "period_start period_end"),
    ("text", "resolution"),
    ("real", "quantity_mw"),
    ("text", "unit source"),
    ("time", "ingested_at"),
)

AGG_DAILY_GENERATION_MIX = _schema(
    ("date", "event_date"),
    ("text", f"{_AREA} technology psr_type"),
    ("flag", "is_renewable"),
    ("real", "total_mwh avg_mw peak_mw min_mw"),
    ("long", "observation_count"),
    ("real", "area_renewable_share_pct"),
)

FACT_HOURLY_WEATHER = _schema(
    ("date", "event_date"),
    ("time", "observation_timestamp_utc"),
    ("text", "country_code country bidding_zone technology technology_group"),
    ("flag", "is_renewable"),
    ("text", "cluster_name"),
    ("real", " ".join(WEATHER_MEASURES)),
    ("text", "source"),
    ("time", "ingested_at"),
)

AGG_DAILY_BIDDING_ZONE = _schema(
    ("date", "event_date"),
    ("text", "country_code country bidding_zone technology technology_group"),
    ("flag", "is_renewable"),
    ("long", "observation_count"),
    ("real", "temperature_2m_avg temperature_2m_min temperature_2m_max"),
    ("real", "relative_humidity_avg precipitation_sum_mm surface_pressure_avg cloud_cover_avg"),
    ("real", "shortwave_radiation_avg direct_radiation_avg diffuse_radiation_avg gti_avg"),
    ("real", "wind_speed_100m_avg wind_speed_100m_max wind_gusts_10m_max"),
    ("real", "shortwave_daily_kwh_m2 gti_daily_kwh_m2 wind_speed_100m_p90"),
)

TABLES = {
    "fact_generation": FACT_GENERATION,
    "fact_load": FACT_LOAD,
    "fact_prices": FACT_PRICES,
    "fact_generation_forecast": FACT_GENERATION_FORECAST,
    "agg_daily_generation_mix": AGG_DAILY_GENERATION_MIX,
    "fact_hourly_weather": FACT_HOURLY_WEATHER,
    "agg_daily_bidding_zone": AGG_DAILY_BIDDING_ZONE,
}


# --- beside the cleaned tables ---------------------------------------------

INGEST_COUNTS = _schema(
    ("text", "dataset"),
    ("long", "lines_read lines_lost lines_noted rows_written"),
)

QUARANTINE = _schema(
    ("text", "ingested_at dataset source_file problem"),
    ("flag", "lost"),
    ("text", "raw_line line_id"),
)

REPAIRED = _schema(("text", "line_id"))


def _as_type(name: str, have: T.DataType, want: T.DataType) -> Column | str:
    if have == want:
        return name
    column = F.col(f"`{name}`")
    if isinstance(want, T.TimestampNTZType) and isinstance(have, T.StringType):
        return utc_from_text(column)
    if isinstance(want, T.TimestampNTZType) and isinstance(have, T.TimestampType):
        return utc_from_instant(column)
    if isinstance(have, T.NullType):
        return column.cast(want)
    return column.try_cast(want)


def conform(
    df: DataFrame, schema: T.StructType, former_names: Mapping[str, str] | None = None
) -> DataFrame:
    """Give a frame exactly the declared columns, in order and type.

    Missing columns become typed nulls, extra ones are dropped.  ``former_names``
    maps a declared name to the name older data used for it.
    """
    have = {field.name: field.dataType for field in df.schema.fields}
    former_names = former_names or {}
    columns: list[Column | str] = []
    for field in schema.fields:
        name = field.name if field.name in have else former_names.get(field.name, field.name)
        if name not in have:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        value = _as_type(name, have[name], field.dataType)
        plain = isinstance(value, str) and value == field.name
        columns.append(value if plain else as_column(value).alias(field.name))
    return df.select(*columns)
