from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from gridtide.operators import clean
from gridtide.schemas import (
    FACT_LOAD,
    MARKET_CLEAN,
    MARKET_RECORD,
    WEATHER_CLEAN,
    WEATHER_RECORD,
    conform,
)


def market_records(spark, *changes):
    base = {
        "status": "ok",
        "timestamp_utc": "2026-04-22T10:00:00Z",
        "ingested_at": "2026-04-22T11:00:00Z",
        "dataset": "actual_total_load",
        "area_code": "10Y",
        "business_type_label": "consumption",
        "process_type": "A16",
        "psr_type": "",
        "quantity_mw": 1.23456,
    }
    rows = [tuple((base | change).get(name) for name in MARKET_RECORD.names) for change in changes]
    return spark.createDataFrame(rows, MARKET_RECORD)


def weather_records(spark, *changes):
    base = {
        "current_time": "2026-04-22T10:00:00+00:00",
        "ingested_at": "2026-04-22T10:30:00.5+00:00",
        "technology": "solar",
        "cluster_name": "site",
        "cloud_cover": 10.00049,
        "wind_speed_100m": 5.0,
        "temperature_2m": 20.0,
    }
    rows = [tuple((base | change).get(name) for name in WEATHER_RECORD.names) for change in changes]
    return spark.createDataFrame(rows, WEATHER_RECORD)


def test_only_valid_market_readings_pass(spark):
    records = market_records(
        spark,
        {},
        {"status": "no_data"},
        {"status": None},
        {"timestamp_utc": ""},
        {"timestamp_utc": None},
        {"timestamp_utc": "garbage"},
    )
    (row,) = clean.project_market(records).collect()
    assert (row.event_date, row.timestamp_utc) == ("2026-04-22", dt.datetime(2026, 4, 22, 10))
    assert (row.psr_type, row.process_type_label, row.quantity_mw) == (None, "realised", 1.235)


def test_columns_are_the_declared_ones(spark):
    assert clean.clean_market(market_records(spark, {})).schema == MARKET_CLEAN
    assert clean.clean_weather(weather_records(spark, {})).schema == WEATHER_CLEAN


def test_datasets_and_files_do_not_replace_each_other(spark):
    same_hour = market_records(
        spark,
        {"quantity_mw": 1.0},
        {"quantity_mw": 2.0, "ingested_at": "2026-04-22T12:00:00Z"},
        {"quantity_mw": 3.0, "dataset": "day_ahead_total_load_forecast"},
    )
    got = clean.clean_market(same_hour).collect()
    assert sorted(r.quantity_mw for r in got) == [2.0, 3.0]
    files = same_hour.withColumn(clean.SOURCE_FILE, F.col("quantity_mw").cast("string"))
    assert clean.clean_market(files).count() == 3


def test_weather_measures_follow_technology(spark):
    kinds = ["solar", "wind-onshore", "wind-offshore", "hydro", None]
    rows = clean.project_weather(
        weather_records(spark, *[{"technology": kind, "cluster_name": str(kind)} for kind in kinds])
    ).collect()
    kept = {r.technology: (r.cloud_cover, r.wind_speed_100m) for r in rows}
    assert kept == {
        "solar": (10.0, None),
        "wind-onshore": (None, 5.0),
        "wind-offshore": (None, 5.0),
        "hydro": (10.0, 5.0),
        None: (10.0, 5.0),
    }


def test_bad_weather_time_gives_null_not_failure(spark):
    rows = clean.clean_weather(
        weather_records(spark, {"current_time": ""}, {"ingested_at": "?", "cluster_name": "b"})
    ).collect()
    by_site = {r.cluster_name: r for r in rows}
    assert by_site["site"].observation_timestamp_utc is None
    assert by_site["site"].event_date is None
    assert by_site["b"].ingested_at is None


def test_conform_casts_fills_and_renames(spark):
    frame = spark.createDataFrame(
        [("2026-04-22", "2026-04-22T10:00Z", "7.5", "bad")],
        "event_date string, timestamp_utc string, power string, ingested_at string",
    ).withColumn("unit", F.lit(None))
    fitted = conform(frame, FACT_LOAD, {"quantity_mw": "power"})
    assert fitted.schema == FACT_LOAD
    row = fitted.first()
    assert (row.event_date, row.timestamp_utc) == (
        dt.date(2026, 4, 22),
        dt.datetime(2026, 4, 22, 10),
    )
    assert (row.quantity_mw, row.ingested_at, row.unit, row.area_code) == (7.5, None, None, None)


def test_conform_reads_zoned_times_as_utc(spark):
    frame = spark.range(1).select(F.timestamp_seconds(F.lit(0)).alias("timestamp_utc"))
    assert conform(frame, FACT_LOAD).first().timestamp_utc == dt.datetime(1970, 1, 1)
