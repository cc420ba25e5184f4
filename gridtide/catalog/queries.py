"""Registered queries: name to a function of (session, folder of the given tables)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridtide.catalog import inputs
from gridtide.functions.labels import (
    blank_to_null,
    irradiance_bucket,
    is_member,
    label_of,
    technology_group,
    wind_bucket,
)
from gridtide.functions.numeric import (
    correlation,
    exact_mean,
    exact_sum,
    not_negative,
    positive,
    round_half_up,
    safe_ratio,
    sum_where,
    to_number,
)
from gridtide.functions.temporal import (
    closed_hour,
    compact_text,
    iso_text,
    position_time,
    resolution_hours,
    utc_from_epoch,
    utc_from_text,
)
from gridtide.operators import clean, combine, market, weather
from gridtide.operators.keep_last import keep_last
from gridtide.plans import rebuild, reports, views
from gridtide.reference_data import (
    BUSINESS_TYPES,
    EVERY_DATASET,
    GENERATION_DATASETS,
    GENERATION_WIND,
    LOAD_DATASETS,
    PROCESS_TYPES,
    PRODUCTION_TYPES,
    RENEWABLE_GENERATION,
    SOLAR,
    WEATHER_WIND,
)
from gridtide.schemas import (
    FACT_GENERATION,
    FACT_LOAD,
    MARKET_CLEAN,
    MARKET_RECORD,
    QUARANTINE,
    TABLES,
    WEATHER_CLEAN,
    WEATHER_RECORD,
    conform,
)
from gridtide.sources import batches, documents, expected_series, json_lines
from gridtide.sources import tables as storage
from gridtide.sources.generations import Generation, append_generation, names_in, read_generations
from gridtide.streaming import counts, ingest, quarantine

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def registered(name: str) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        return query

    return add


# --- tables, views, reports ----------------------------------------------------


def _table(name: str) -> Query:
    return lambda spark, sf_dir: inputs.tables(spark, sf_dir)[name]


QUERIES |= {name: _table(name) for name in TABLES}

# Views and reports: what builds them from the tables, and with which arguments.
OVER_TABLES: dict[str, tuple] = {
    "table_row_counts": (reports.table_row_counts,),
    "area_lookup": (views.area_lookup,),
    "v_supply_demand": (views.supply_demand,),
    "v_daily_renewable_share": (views.daily_renewable_share,),
    "v_solar_performance": (views.solar_performance,),
    "v_wind_performance": (views.wind_performance,),
    "q01_hourly_solar": (reports.hourly_solar, inputs.DAY),
    "q02_daily_solar_conversion": (reports.daily_solar_conversion,),
    "q03_solar_corr": (reports.solar_correlation,),
    "q04_hourly_wind": (reports.hourly_wind, inputs.DAY),
    "q05_wind_corr": (reports.wind_correlation,),
    "q06_wind_buckets": (reports.wind_buckets,),
    "q07_irradiance_buckets": (reports.irradiance_buckets,),
    "q08_normalized_peak": (reports.normalized_peak,),
    "q09_weather_score": (reports.weather_score,),
    "q10_forecast_error": (reports.forecast_error, inputs.DAY),
    "q11_error_vs_weather": (reports.error_against_weather,),
    "q12_load_coverage": (reports.load_coverage, inputs.DAY),
    "q13_solar_efficiency": (reports.solar_efficiency,),
    "q14_wind_underperformance": (reports.wind_underperformance,),
    "q15_monthly_benchmark": (reports.monthly_benchmark,),
    "readme_daily_share": (reports.average_daily_share, inputs.FIRST_DAY),
}


def report(name: str, tables: views.Tables) -> DataFrame:
    build, *args = OVER_TABLES[name]
    return build(tables, *args)


def _over_tables(name: str) -> Query:
    return lambda spark, sf_dir: report(name, inputs.tables(spark, sf_dir))


QUERIES |= {name: _over_tables(name) for name in OVER_TABLES}


# --- documents -------------------------------------------------------------------

_STATUS_COLUMNS = [
    "ingested_at",
    "source",
    "dataset",
    "country_code",
    "area_code",
    "area_name",
    "request_period_start",
    "request_period_end",
    "status",
]


def _with_status(spark: SparkSession, sf_dir: str, status: str) -> DataFrame:
    return documents.market_records(inputs.documents(spark, sf_dir), statuses=[status])


@registered("xml_flatten_points")
def xml_flatten_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_status(spark, sf_dir, "ok").select(
        *_STATUS_COLUMNS,
        "timestamp_utc",
        "document_mrid",
        "process_type",
        "document_time_start",
        "document_time_end",
        "timeseries_mrid",
        "business_type",
        "business_type_label",
        "object_aggregation",
        "in_domain",
        "out_domain",
        "period_start",
        "period_end",
        "resolution",
        "position",
        "value",
        "value_type",
        "quantity_mw",
        "price_amount",
        "unit",
        "currency_unit",
        "psr_type",
        "technology",
    )


@registered("xml_large_documents")
def xml_large_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of documents with thousands of series, which are read in pieces."""
    path = storage.shared_folder(spark, "large-documents")
    inputs.write_large_documents(spark, sf_dir, path)
    pieces = documents.read_pieces(spark, path, "*.txt", ["area_code"])
    return documents.records_from_pieces(pieces).select(
        "status",
        "area_code",
        "document_mrid",
        "timeseries_mrid",
        "timestamp_utc",
        "psr_type",
        "technology",
        "resolution",
        "position",
        "quantity_mw",
    )


@registered("xml_empty_document_status")
def xml_empty_document_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_status(spark, sf_dir, "ok_but_empty_points").select(
        *_STATUS_COLUMNS,
        "document_mrid",
        "revision_number",
        "document_type",
        "process_type",
        "created_datetime",
        "document_time_start",
        "document_time_end",
        "timestamp_utc",
        "value",
    )


@registered("xml_ack_rows")
def xml_ack_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_status(spark, sf_dir, "no_data").select(
        *_STATUS_COLUMNS, "response_type", "created_datetime", "reason_code", "reason_text"
    )


@registered("classify_documents")
def classify_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = documents.parse(inputs.documents(spark, sf_dir))
    return parsed.select("line_id", "status", "root")


@registered("quarantine_rows")
def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_status(spark, sf_dir, "request_failed").select(*_STATUS_COLUMNS, "error")


@registered("unknown_documents")
def unknown_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of unknown type keep their whole text beside the preview."""
    xml = F.col("raw_xml")
    return _with_status(spark, sf_dir, "unknown_response_type").select(
        *_STATUS_COLUMNS,
        "response_type",
        F.regexp_extract(xml, "mRID>([^<]*)<", 1).alias("document_id"),
        xml.endswith("Publication_MarketDocument>").alias("is_whole"),
        F.startswith(xml, F.col("raw_xml_preview")).alias("preview_fits"),
    )


@registered("position_to_ts")
def position_to_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = inputs.generation_readings(spark, sf_dir)
    resolution = (
        F.when(F.col("l_tax") == 0.08, "P1M")
        .when(F.col("l_tax") == 0.07, "P1D")
        .when(F.col("l_tax") == 0.06, "P7D")
        .when(F.col("l_tax") == 0.05, "PT1H")
        .otherwise(F.col("resolution"))
    )
    return readings.withColumn("resolution", resolution).select(
        "l_orderkey",
        "l_linenumber",
        "period_start",
        "resolution",
        position_time(utc_from_text("period_start"), "resolution", "l_linenumber").alias(
            "timestamp_utc"
        ),
    )


@registered("value_type_coalesce")
def value_type_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = inputs.generation_readings(spark, sf_dir)
    quantity = F.when(F.col("l_tax") < 0.04, F.col("quantity_mw").cast("string"))
    price = F.col("price_amount").cast("string")
    value, kind = documents.reading_value(quantity, price)
    return readings.select(
        "l_orderkey", "l_linenumber", value.alias("value"), kind.alias("value_type")
    )


# --- JSON lines ------------------------------------------------------------------


def _land(gathered: DataFrame, path: str) -> None:
    """Land records that have been gathered by hour."""
    json_lines.write_lines(gathered, path, laid_out=True, compression=json_lines.LINE_COMPRESSION)


@registered("jsonl_sink_roundtrip")
def jsonl_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = storage.shared_folder(spark, "landed")
    _land(inputs.market_records(spark, sf_dir, gathered=True), path)
    lines = json_lines.readable(json_lines.read_lines(spark, path, MARKET_RECORD))
    return lines.select(
        "document_mrid",
        "dataset",
        "ingested_at",
        "timestamp_utc",
        "area_code",
        "psr_type",
        to_number("quantity_mw").alias("quantity_mw"),
        "status",
        "year",
        "month",
        "day",
        "hour",
    )


@registered("jsonl_scan")
def jsonl_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan of lines among blank and broken ones; only whole records come back."""
    records = inputs.weather_records(spark, sf_dir)
    line = F.to_json(F.struct(*records.columns))
    written = (
        F.when(F.col("technology") == "other", F.concat(line, F.lit("\n\n   \n")))
        .when(F.col("technology") == "wind-offshore", F.expr("concat('{\"broken\": ', country)"))
        .otherwise(line)
    )
    path = storage.shared_folder(spark, "lines")
    records.select(written.alias("value")).write.text(path)
    lines = json_lines.read_lines(spark, path, WEATHER_RECORD, glob="*.txt")
    return json_lines.readable(lines).select(
        "current_time",
        "cluster_name",
        "technology",
        "ingested_at",
        to_number("temperature_2m").alias("temperature_2m"),
        to_number("cloud_cover").alias("cloud_cover"),
    )


@registered("envelope_enrich")
def envelope_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.table(spark, sf_dir, "events")
    return json_lines.with_envelope(events, iso_text("ts"), "open-meteo", "current")


# --- partitioned tables ----------------------------------------------------------

_READING_COLUMNS = [
    "event_date",
    "dataset",
    "timestamp_utc",
    "area_code",
    "psr_type",
    "quantity_mw",
    "ingested_at",
]


def _stored_readings(spark: SparkSession, sf_dir: str) -> str:
    path = storage.shared_folder(spark, "clean")
    readings = inputs.clean_readings(spark, sf_dir, gathered=True)
    storage.append_partitioned(readings, path, ["event_date", "dataset"], laid_out=True)
    return path


@registered("silver_partitioned_write")
def silver_partitioned_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _stored_readings(spark, sf_dir)
    return storage.read_table(spark, path, MARKET_CLEAN).select(*_READING_COLUMNS)


@registered("partition_scan")
def partition_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _stored_readings(spark, sf_dir)
    day = storage.read_table(spark, path, MARKET_CLEAN, [inputs.DAY], GENERATION_DATASETS)
    return day.select(*_READING_COLUMNS)


@registered("multi_dataset_scan")
def multi_dataset_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _stored_readings(spark, sf_dir)
    day = storage.read_table(spark, path, MARKET_CLEAN, [inputs.DAY], LOAD_DATASETS)
    return day.select(*_READING_COLUMNS)


@registered("create_if_absent")
def create_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = storage.shared_folder(spark, "fact_load")
    storage.create_if_absent(spark, path, FACT_LOAD)
    storage.overwrite_days(inputs.fact_load(spark, sf_dir), path, FACT_LOAD)
    storage.create_if_absent(spark, path, FACT_LOAD)
    return storage.read_table(spark, path, FACT_LOAD)


@registered("idempotent_overwrite")
def idempotent_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load with one day doubled: written twice, then followed by an empty write."""
    path = storage.shared_folder(spark, "fact_load")
    storage.overwrite_days(inputs.fact_load(spark, sf_dir), path, FACT_LOAD)
    day = reports.on_day(inputs.fact_load(spark, sf_dir), inputs.DAY)
    doubled = day.withColumn("quantity_mw", F.col("quantity_mw") * 2)
    for rows in (doubled, doubled, doubled.where(F.lit(False))):
        storage.overwrite_days(rows, path, FACT_LOAD)
    return storage.read_table(spark, path, FACT_LOAD)


@registered("conform_schema")
def conform_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with a text day, text period ends and a renamed measure, made to fit."""
    readings = inputs.generation_readings(spark, sf_dir).withColumn(
        "event_date", F.col("event_date").cast("string")
    )
    older = readings.withColumnRenamed("quantity_mw", "power_mw")
    return conform(older, FACT_GENERATION, {"quantity_mw": "power_mw"})


@registered("schema_evolution_read")
def schema_evolution_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Older days were written before two columns existed; they read as null."""
    path = storage.shared_folder(spark, "evolving")
    load = inputs.fact_load(spark, sf_dir)
    older = F.col("event_date") < F.lit(inputs.DAY).cast("date")
    storage.append_partitioned(load.where(older).drop("unit", "resolution"), path, ["event_date"])
    storage.append_partitioned(load.where(~older), path, ["event_date"])
    return storage.read_table(spark, path, FACT_LOAD)


LOAD_GENERATIONS = (
    Generation(1),
    Generation(2, {"power_mw": "value", "measure": "unit"}),
    Generation(3, {"quantity_mw": "power_mw", "unit": "measure", "source": "origin"}),
)


@registered("schema_generations_read")
def schema_generations_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load written under three sets of names, a third of the year each, read as one table."""
    path = storage.shared_folder(spark, "generations")
    load = inputs.fact_load(spark, sf_dir)
    third = F.ceil(F.month("event_date") / 4)
    for generation in LOAD_GENERATIONS:
        part = load.where(third == generation.version)
        old = names_in(generation.version, LOAD_GENERATIONS, load.columns)
        if generation.version == 1:  # numbers were texts then
            part = part.withColumn("quantity_mw", F.col("quantity_mw").cast("string"))
        append_generation(part.withColumnsRenamed(old), path, generation.version, ["event_date"])
    return read_generations(spark, path, FACT_LOAD, LOAD_GENERATIONS)


@registered("write_counts")
def write_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per dataset that a write has added to the table."""
    path = _stored_readings(spark, sf_dir)
    return storage.count_by(storage.read_table(spark, path, MARKET_CLEAN), "dataset")


def _expected_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = inputs.areas(spark, sf_dir)
    explicit = F.array(F.lit("actual_total_load"), F.lit("day_ahead_energy_prices"), F.lit("other"))
    use_for = F.when(F.col("n_regionkey") == 0, explicit).otherwise(F.array(F.lit(EVERY_DATASET)))
    areas = suppliers.select(
        F.col("s_suppkey").cast("string").alias("area_code"),
        F.col("s_name").alias("area_name"),
        use_for.alias("use_for"),
    )
    return expected_series.expected_series(areas)


@registered("series_manifest")
def series_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected series of every area against the readings received."""
    expected = _expected_series(spark, sf_dir)
    return expected_series.series_status(expected, inputs.clean_readings(spark, sf_dir))


_YEAR = (date(2024, 1, 1), date(2024, 12, 31))


@registered("interval_gaps")
def interval_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing hours of every expected series over a year."""
    expected = _expected_series(spark, sf_dir)
    return expected_series.interval_gaps(expected, inputs.clean_readings(spark, sf_dir), *_YEAR)


@registered("series_completeness")
def series_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarter hours expected, received and missing per series over a year."""
    expected = _expected_series(spark, sf_dir)
    received = inputs.clean_readings(spark, sf_dir)
    gaps = expected_series.interval_gaps(expected, received, *_YEAR, minutes=15)
    return expected_series.completeness(expected, gaps, *_YEAR, minutes=15)


@registered("backfill_range")
def backfill_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and measure totals per rebuilt table and day."""
    clean_path = _stored_readings(spark, sf_dir)
    weather_path = storage.shared_folder(spark, "clean-weather")
    storage.append_partitioned(inputs.clean_weather(spark, sf_dir), weather_path, ["event_date"])
    days = ["2024-01-14", inputs.DAY, "2024-01-16"]
    return _rebuilt_totals(spark, clean_path, weather_path, days)


@registered("backfill_years")
def backfill_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for every day there is, asked for as a range of ten years."""
    clean_path = _stored_readings(spark, sf_dir)
    weather_path = storage.shared_folder(spark, "clean-weather")
    storage.append_partitioned(inputs.clean_weather(spark, sf_dir), weather_path, ["event_date"])
    days = storage.days_between(spark, date(2016, 1, 1), date(2025, 12, 31))
    return _rebuilt_totals(spark, clean_path, weather_path, days)


def _rebuilt_totals(
    spark: SparkSession, clean_path: str, weather_path: str, days: list[str] | DataFrame
) -> DataFrame:
    root = storage.shared_folder(spark, "tables")
    rebuild.rebuild_market(spark, clean_path, root, days)
    rebuild.rebuild_weather(spark, weather_path, root, days)
    tables = rebuild.open_tables(spark, root)
    measures = {
        "fact_generation": "quantity_mw",
        "fact_load": "quantity_mw",
        "fact_prices": "price_amount",
        "fact_generation_forecast": "quantity_mw",
        "agg_daily_generation_mix": "total_mwh",
        "fact_hourly_weather": "wind_direction_100m",
        "agg_daily_bidding_zone": "observation_count",
    }
    totals = [
        tables[name]
        .groupBy(F.lit(name).alias("tbl"), "event_date")
        .agg(
            F.count("*").alias("row_count"),
            round_half_up(F.sum(measure), 3).alias("total"),
        )
        for name, measure in measures.items()
    ]
    return reduce(DataFrame.unionByName, totals)


# --- cleaning --------------------------------------------------------------------


@registered("silver_market_project")
def silver_market_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.project_market(inputs.market_records(spark, sf_dir))


@registered("silver_weather_project")
def silver_weather_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.project_weather(inputs.weather_records(spark, sf_dir))


@registered("blank_to_null")
def blank_to_null_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = inputs.market_records(spark, sf_dir)
    return records.select(
        "document_mrid",
        blank_to_null("psr_type").alias("psr_type"),
        blank_to_null("out_domain").alias("out_domain"),
        blank_to_null("timestamp_utc").alias("timestamp_utc"),
    )


@registered("conditional_null_columns")
def conditional_null_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = inputs.weather_readings(spark, sf_dir)
    kept = [value.alias(name) for name, value in clean.measures_by_technology().items()]
    return readings.select("event_id", "technology", *kept)


@registered("numeric_coerce")
def numeric_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.table(spark, sf_dir, "events")
    text = (
        F.when(F.col("event_type") == "error", "n/a")
        .when(F.col("event_type") == "signup", "")
        .when(F.col("event_type") == "purchase", "NaN")
        .otherwise(F.get_json_object("props", "$.k"))
    )
    return events.select("event_id", to_number(text).alias("number"))


@registered("safe_round")
def safe_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = inputs.generation_readings(spark, sf_dir)
    return readings.select(
        "l_orderkey",
        "l_linenumber",
        round_half_up("forecast_mw", 3).alias("forecast_mw"),
        round_half_up(F.col("price_amount") / 7, 4).alias("price_amount"),
    )


@registered("event_date_derive")
def event_date_derive(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.table(spark, sf_dir, "events")
    return events.select("event_id", F.to_date("ts").cast("string").alias("event_date"))


@registered("utc_normalize")
def utc_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times written with and without seconds, with an offset, blank and unreadable."""
    kind = F.col("event_type")
    seconds = F.substring(iso_text("ts"), 1, 19)
    minutes = F.substring(iso_text("ts"), 1, 16)
    text = (
        F.when(kind == "click", F.concat(seconds, F.lit("Z")))
        .when(kind == "view", F.concat(minutes, F.lit("Z")))
        .when(kind == "purchase", F.concat(seconds, F.lit(".00000000000000000000000+02:00")))
        .when(kind == "signup", F.concat(minutes, F.lit("-05:30")))
        .when(F.col("value") < 50, F.lit(""))
        .when(F.col("value") < 100, F.lit("not a time"))
        .otherwise(seconds)
    )
    events = inputs.table(spark, sf_dir, "events")
    return events.select("event_id", utc_from_text(text).alias("timestamp_utc"))


@registered("label_lookup")
def label_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = inputs.generation_readings(spark, sf_dir)
    product = F.when(F.col("l_tax") == 0.08, "B99").otherwise(F.col("psr_type"))
    business = F.when(F.col("business_type_label") == "consumption", "A04").otherwise("A93")
    return readings.select(
        "l_orderkey",
        "l_linenumber",
        label_of(product, PRODUCTION_TYPES).alias("technology"),
        label_of(business, BUSINESS_TYPES).alias("business_type_label"),
        label_of("process_type", PROCESS_TYPES).alias("process_type_label"),
    )


# --- checks, flags, buckets ------------------------------------------------------


@registered("range_null")
def range_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = weather.null_outside_limits(inputs.weather_readings(spark, sf_dir))
    return checked.select("event_id", *weather.WEATHER_LIMITS)


@registered("negative_to_null")
def negative_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = inputs.generation_readings(spark, sf_dir)
    return readings.select(
        "l_orderkey", "l_linenumber", not_negative("quantity_mw").alias("quantity_mw")
    )


@registered("nonpositive_to_null")
def nonpositive_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = inputs.load_readings(spark, sf_dir)
    return readings.select("o_orderkey", positive("quantity_mw").alias("quantity_mw"))


@registered("price_not_null")
def price_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = inputs.fact_prices(spark, sf_dir)
    return prices.select("timestamp_utc", "area_code", "price_amount")


@registered("renewable_flag")
def renewable_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = inputs.generation_readings(spark, sf_dir)
    technology = F.when(F.col("l_tax") != 0.08, F.col("technology"))
    return readings.select(
        "l_orderkey",
        "l_linenumber",
        technology.alias("technology"),
        is_member(technology, RENEWABLE_GENERATION).alias("is_renewable"),
    )


@registered("technology_group")
def technology_group_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = inputs.weather_readings(spark, sf_dir)
    group = technology_group("technology")
    return readings.select("event_id", "technology", group.alias("technology_group"))


@registered("bucket_irradiance")
def bucket_irradiance(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = inputs.weather_readings(spark, sf_dir)
    label = irradiance_bucket("global_tilted_irradiance").alias("irradiance_bucket")
    return readings.groupBy(label).agg(
        F.count("*").alias("hours"), F.max("global_tilted_irradiance").alias("highest")
    )


@registered("bucket_wind")
def bucket_wind(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = inputs.weather_readings(spark, sf_dir)
    return readings.groupBy("technology", wind_bucket("wind_speed_100m").alias("wind_bucket")).agg(
        F.count("*").alias("hours"), F.max("wind_speed_100m").alias("highest")
    )


# --- time ------------------------------------------------------------------------


@registered("resolution_hours")
def resolution_hours_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = inputs.generation_readings(spark, sf_dir)
    resolution = (
        F.when(F.col("l_tax") == 0.08, F.lower("resolution"))
        .when(F.col("l_tax") == 0.07, "PT1H")
        .when(F.col("l_tax") == 0.06, "P1D")
        .when(F.col("l_tax") != 0.05, F.col("resolution"))
    )
    return readings.select(
        "l_orderkey",
        "l_linenumber",
        resolution.alias("resolution"),
        resolution_hours(resolution).alias("hours"),
    )


@registered("closed_hour_window")
def closed_hour_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end = closed_hour("ts")
    return inputs.table(spark, sf_dir, "events").select(
        "event_id",
        start.alias("window_start"),
        end.alias("window_end"),
        compact_text(start).alias("period_start"),
        compact_text(end).alias("period_end"),
    )


@registered("time_format")
def time_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "events").select(
        "event_id", iso_text("ts").alias("iso"), compact_text("ts").alias("compact")
    )


@registered("epoch_to_utc")
def epoch_to_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    seconds = F.timestamp_diff("SECOND", start, F.col("ts"))
    return inputs.table(spark, sf_dir, "events").select(
        "event_id", seconds.alias("epoch"), utc_from_epoch(seconds).alias("timestamp_utc")
    )


# --- keep last -------------------------------------------------------------------

_LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@registered("dedup_silver_market")
def dedup_silver_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clean.project_market(inputs.market_records(spark, sf_dir))
    return keep_last(rows, [*clean.MARKET_KEY, "dataset"])


@registered("dedup_silver_weather")
def dedup_silver_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clean.project_weather(inputs.weather_records(spark, sf_dir))
    return keep_last(rows, clean.WEATHER_KEY)


@registered("dedup_generation")
def dedup_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = inputs.generation_readings(spark, sf_dir)
    latest = keep_last(readings, market.GENERATION_KEY, tiebreak=inputs.GENERATION_TIES)
    return latest.select(*market.GENERATION_KEY, *_LINE, "quantity_mw", "ingested_at")


@registered("dedup_load")
def dedup_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = inputs.load_readings(spark, sf_dir)
    latest = keep_last(readings, market.LOAD_KEY, tiebreak=inputs.LOAD_TIES)
    return latest.select(*market.LOAD_KEY, "o_orderkey", "quantity_mw", "ingested_at")


@registered("dedup_prices")
def dedup_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = inputs.generation_readings(spark, sf_dir)
    latest = keep_last(readings, market.PRICE_KEY, tiebreak=inputs.GENERATION_TIES)
    return latest.select(*market.PRICE_KEY, *_LINE, "price_amount", "ingested_at")


@registered("dedup_forecast")
def dedup_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = inputs.forecast_readings(spark, sf_dir)
    latest = keep_last(readings, market.FORECAST_KEY, tiebreak=inputs.GENERATION_TIES)
    return latest.select(*market.FORECAST_KEY, *_LINE, "quantity_mw", "ingested_at")


@registered("dedup_weather")
def dedup_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = inputs.weather_readings(spark, sf_dir)
    latest = keep_last(readings, weather.WEATHER_FACT_KEY, tiebreak=inputs.WEATHER_TIES)
    return latest.select(*weather.WEATHER_FACT_KEY, "event_id", "temperature_2m", "ingested_at")


# --- joins -----------------------------------------------------------------------


@registered("join_inner_filtered")
def join_inner_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = combine.with_actual_load(
        inputs.fact_generation(spark, sf_dir), inputs.fact_load(spark, sf_dir)
    )
    return joined.select("timestamp_utc", "area_code", "psr_type", "quantity_mw", "load_mw")


def _zones_with_generation(
    spark: SparkSession, sf_dir: str, sites: list[str], labels: list[str]
) -> DataFrame:
    tables = inputs.tables(spark, sf_dir)
    zones = reports.with_label(tables["agg_daily_bidding_zone"], sites)
    generation = reports.with_label(tables["fact_generation"], labels)
    joined = combine.daily_with(
        zones, generation, timestamp_utc="timestamp_utc", generation_mw="quantity_mw"
    )
    return joined.select(
        "event_date",
        "country_code",
        "bidding_zone",
        "technology",
        "observation_count",
        "timestamp_utc",
        "generation_mw",
    )


@registered("join_left_const_on")
def join_left_const_on(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zones_with_generation(spark, sf_dir, [SOLAR], [SOLAR])


@registered("join_left_in_on")
def join_left_in_on(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zones_with_generation(spark, sf_dir, WEATHER_WIND, GENERATION_WIND)


_HOUR_COLUMNS = [
    "event_date",
    "bidding_zone",
    "cluster_name",
    "observation_timestamp_utc",
    "global_tilted_irradiance",
    "generation_mw",
]


def _solar_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = reports.with_label(inputs.fact_hourly_weather(spark, sf_dir), SOLAR)
    return combine.hourly_with_generation(sites, inputs.fact_generation(spark, sf_dir), [SOLAR])


@registered("join_left_hourly")
def join_left_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _solar_hours(spark, sf_dir).select(*_HOUR_COLUMNS)


@registered("join_outer_to_inner")
def join_outer_to_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = _solar_hours(spark, sf_dir).where(F.col("generation_mw").isNotNull())
    return hours.select(*_HOUR_COLUMNS)


@registered("join_tech_family")
def join_tech_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = inputs.tables(spark, sf_dir)
    joined = combine.mix_with_weather(
        tables["agg_daily_generation_mix"], tables["agg_daily_bidding_zone"], "wind_speed_100m_avg"
    )
    return joined.select(
        "event_date", "area_code", "technology", "total_mwh", "wind_speed_100m_avg"
    )


_PAIR_COLUMNS = ["area_code", "timestamp_utc", "technology", "actual_mw", "forecast_mw", "error_mw"]


@registered("join_inner_3key")
def join_inner_3key(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = inputs.tables(spark, sf_dir)
    pairs = combine.actual_with_forecast(
        tables["fact_generation"], tables["fact_generation_forecast"]
    )
    return pairs.select(*_PAIR_COLUMNS)


@registered("join_three_way")
def join_three_way(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = inputs.tables(spark, sf_dir)
    pairs = combine.actual_with_forecast(
        tables["fact_generation"], tables["fact_generation_forecast"]
    )
    weathered = combine.with_hourly_weather(
        pairs, tables["fact_hourly_weather"], "cluster_name", "temperature_2m"
    )
    return weathered.select(*_PAIR_COLUMNS, "cluster_name", "temperature_2m")


@registered("join_daily_inner")
def join_daily_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = inputs.tables(spark, sf_dir)
    mix = reports.with_label(tables["agg_daily_generation_mix"], GENERATION_WIND)
    zones = reports.with_label(tables["agg_daily_bidding_zone"], WEATHER_WIND)
    joined = combine.daily_with(mix, zones, "inner", speed="wind_speed_100m_avg")
    return joined.select("event_date", "country_code", "area_name", "total_mwh", "speed")


# --- aggregation -----------------------------------------------------------------


@registered("share_of_area")
def share_of_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = market.mix_totals(inputs.fact_generation(spark, sf_dir))
    return totals.select(
        "event_date",
        "area_code",
        "technology",
        market.renewable_share().alias("area_renewable_share_pct"),
    )


@registered("agg_grouped_stats")
def agg_grouped_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics per group where some group keys are null."""
    generation = inputs.fact_generation(spark, sf_dir)
    gas_unknown = F.when(F.col("technology") != "fossil_gas", F.col("technology"))
    totals = market.mix_totals(
        generation.withColumn("technology", gas_unknown), ["event_date", "area_code", "technology"]
    )
    return totals.select(
        "event_date",
        "area_code",
        "technology",
        round_half_up("avg_mw", 3).alias("avg_mw"),
        "peak_mw",
        "min_mw",
        "observation_count",
    )


@registered("agg_mwh_total")
def agg_mwh_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = market.mix_totals(
        inputs.fact_generation(spark, sf_dir), ["country_code", "technology"]
    )
    return totals.select("country_code", "technology", "total_mwh")


def _zone_columns(spark: SparkSession, sf_dir: str, *measures: str) -> DataFrame:
    zones = weather.daily_bidding_zone(inputs.fact_hourly_weather(spark, sf_dir))
    return zones.select("event_date", "bidding_zone", "technology", *measures)


@registered("agg_kwh")
def agg_kwh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zone_columns(spark, sf_dir, "shortwave_daily_kwh_m2", "gti_daily_kwh_m2")


@registered("agg_p90")
def agg_p90(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zone_columns(spark, sf_dir, "wind_speed_100m_p90")


@registered("agg_conditional_sum")
def agg_conditional_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    generation = inputs.fact_generation(spark, sf_dir)
    return generation.groupBy("area_code", "timestamp_utc").agg(
        sum_where(F.col("is_renewable"), "quantity_mw").alias("renewable_mw"),
        sum_where(F.col("technology") == SOLAR, "quantity_mw").alias("solar_mw"),
    )


@registered("agg_corr")
def agg_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correlation per zone and per zone and day; single hours give null, not an error."""
    hours = _solar_hours(spark, sf_dir)
    value = round_half_up(correlation("global_tilted_irradiance", "generation_mw"), 4)
    return hours.groupBy("bidding_zone", "event_date").agg(value.alias("corr_gti"))


@registered("agg_having")
def agg_having(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = _solar_hours(spark, sf_dir).where(F.col("generation_mw").isNotNull())
    days = hours.groupBy("bidding_zone", "event_date").agg(F.count("*").alias("hours"))
    return days.where(F.col("hours") >= 3)


@registered("agg_safe_ratio")
def agg_safe_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = inputs.tables(spark, sf_dir)["agg_daily_bidding_zone"]
    ratio = safe_ratio(exact_sum("gti_daily_kwh_m2"), exact_mean("precipitation_sum_mm"))
    return zones.groupBy("event_date", "technology").agg(
        round_half_up(ratio, 4).alias("kwh_per_mm"),
        round_half_up(safe_ratio(F.sum("observation_count"), F.lit(0.0)), 4).alias("over_zero"),
    )


# --- named views -------------------------------------------------------------------


@registered("views_registered")
def views_registered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every named view, asked through SQL."""
    views.register_views(inputs.tables(spark, sf_dir))
    counts = [f"SELECT '{name}' AS view, COUNT(*) AS rows FROM {name}" for name in views.VIEWS]
    return spark.sql(" UNION ALL ".join(counts))


@registered("area_list")
def area_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas by country and code, numbered in that order within each country."""
    areas = views.area_lookup(inputs.tables(spark, sf_dir))
    place = F.row_number().over(Window.partitionBy("country_code").orderBy("area_code"))
    return areas.withColumn("place", place)


# --- streaming -------------------------------------------------------------------


@registered("stream_bronze_to_silver")
def stream_bronze_to_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed files cleaned by the stream, then the latest row per key of all files."""
    landing = storage.shared_folder(spark, "landing")
    clean_path = storage.shared_folder(spark, "clean")
    _land(inputs.market_records(spark, sf_dir, gathered=True), landing)
    checkpoint = storage.shared_folder(spark, "progress")
    query = ingest.start_ingest(spark, ingest.MARKET, landing, clean_path, checkpoint)
    query.awaitTermination()
    rows = storage.read_table(spark, clean_path, MARKET_CLEAN)
    return keep_last(rows, [*clean.MARKET_KEY, "dataset"])


@registered("stream_bronze_to_silver_weather")
def stream_bronze_to_silver_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weather feed through the stream, then the latest row per key of all files."""
    landing = storage.shared_folder(spark, "landing")
    clean_path = storage.shared_folder(spark, "clean")
    json_lines.write_lines(inputs.weather_records(spark, sf_dir), landing)
    checkpoint = storage.shared_folder(spark, "progress")
    query = ingest.start_ingest(
        spark, ingest.WEATHER, landing, clean_path, checkpoint, feeds=["current"]
    )
    query.awaitTermination()
    return keep_last(storage.read_table(spark, clean_path, WEATHER_CLEAN), clean.WEATHER_KEY)


def _ingested_faulty_lines(spark: SparkSession, sf_dir: str, runs: int = 1) -> str:
    """The cleaned table of faulty lines; several runs take them as one batch each time."""
    landing = storage.shared_folder(spark, "landing")
    clean_path = storage.shared_folder(spark, "clean")
    inputs.faulty_lines(spark, sf_dir).write.text(landing, compression=json_lines.LINE_COMPRESSION)
    if runs == 1:
        checkpoint = storage.shared_folder(spark, "progress")
        ingest.start_ingest(
            spark, ingest.MARKET, landing, clean_path, checkpoint, glob="*.txt*"
        ).awaitTermination()
        return clean_path
    lines = json_lines.read_lines(spark, landing, MARKET_RECORD, glob="*.txt*")
    for _ in range(runs):
        name = batches.batch_name("replayed", 0)
        ingest.take(lines, ingest.MARKET, name, clean_path, ingest.quarantine_of(clean_path))
    return clean_path


def _by_problem(lines: DataFrame) -> DataFrame:
    return lines.groupBy("problem", "lost").agg(F.count(F.lit(1)).alias("row_count"))


@registered("quarantine_lines")
def quarantine_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines a stream has put aside or noted, and readings it has cleaned, by problem."""
    clean_path = _ingested_faulty_lines(spark, sf_dir)
    return _by_problem(spark.read.parquet(ingest.quarantine_of(clean_path)))


@registered("stream_batch_replayed")
def stream_batch_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same after the batch was taken twice."""
    clean_path = _ingested_faulty_lines(spark, sf_dir, runs=2)
    return _by_problem(batches.read_batches(spark, ingest.quarantine_of(clean_path), QUARANTINE))


@registered("ingest_counts")
def ingest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a batch that was taken twice has read, lost and noted, by dataset."""
    clean_path = _ingested_faulty_lines(spark, sf_dir, runs=2)
    found = counts.read_counts(spark, clean_path)
    return found.select("dataset", "lines_read", "lines_lost", "lines_noted")


@registered("quarantine_retaken")
def quarantine_retaken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines without a dataset are given one and come back; which lines still wait, and the rows per key."""
    clean_path = _ingested_faulty_lines(spark, sf_dir)
    named = F.regexp_replace("raw_line", "^\\{", '{"dataset":"actual_generation_per_production_type",')

    def mend(line: Column) -> Column:
        return F.when(F.contains(line, F.lit('"dataset"')), line).otherwise(named)

    back = ingest.retake(spark, ingest.MARKET, clean_path, "names", mend)
    waiting = _by_problem(quarantine.open_lines(spark, ingest.quarantine_of(clean_path)))
    rows = keep_last(storage.read_table(spark, clean_path, MARKET_CLEAN), [*clean.MARKET_KEY, "dataset"])
    keys = rows.select(F.lit("cleaned keys").alias("problem"), F.lit(False).alias("lost"))
    came_back = F.lit(back).cast("long").alias("came_back")
    return waiting.unionByName(_by_problem(keys)).select("*", came_back)


@registered("clean_compacted")
def clean_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned readings of all datasets, written as three batches and compacted."""
    clean_path = storage.shared_folder(spark, "clean")
    readings = inputs.clean_readings(spark, sf_dir, gathered=True)
    third = F.pmod(F.hash("timestamp_utc", "ingested_at"), F.lit(3))
    for n in range(3):
        name = f"part-{'abc'[n]}"
        batches.write_batch(readings.where(third == n), clean_path, name, ingest.MARKET.partitions, laid_out=True)
    ingest.compact_clean(spark, ingest.MARKET, clean_path)
    return storage.read_table(spark, clean_path, MARKET_CLEAN)


@registered("stream_late_rebuild")
def stream_late_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load that arrives in two parts; late rows replace earlier ones in the fact."""
    landing = storage.shared_folder(spark, "landing")
    clean_path = storage.shared_folder(spark, "clean")
    root = storage.shared_folder(spark, "tables")
    checkpoint = storage.shared_folder(spark, "progress")
    readings = inputs.load_readings(spark, sf_dir)
    late = F.col("quantity_mw") > 250
    landed = F.timestamp_add(
        "HOUR", F.when(late, 9).otherwise(4), F.date_add("event_date", 1).cast("timestamp_ntz")
    )
    made = {
        "timestamp_utc": iso_text("timestamp_utc"),
        "ingested_at": iso_text(landed),
        "status": F.lit("ok"),
    }
    for part in (readings.where(~late), readings.where(late)):
        records = conform(part.withColumns(made), MARKET_RECORD)
        json_lines.write_lines(records, landing)
        query = ingest.start_ingest(spark, ingest.MARKET, landing, clean_path, checkpoint, root)
        query.awaitTermination()
    return rebuild.open_tables(spark, root)["fact_load"]
