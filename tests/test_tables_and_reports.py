"""Facts, daily aggregates and reports on small frames with known answers."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridtide.operators import market, weather
from gridtide.plans import reports, views
from gridtide.schemas import TABLES, conform

DAY = dt.date(2026, 4, 22)


def at(hour, day=22):
    return dt.datetime(2026, 4, day, hour)


def readings(spark, *changes):
    base = {
        "event_date": DAY,
        "timestamp_utc": at(1),
        "area_code": "A",
        "area_name": "Zone",
        "country_code": "PL",
        "country": "Poland",
        "technology": "solar",
        "psr_type": "B16",
        "dataset": "actual_total_load",
        "business_type_label": "production",
        "resolution": "PT60M",
        "quantity_mw": 10.0,
        "price_amount": 5.0,
        "ingested_at": at(2),
    }
    kinds = {
        "event_date": "date",
        "timestamp_utc": "timestamp_ntz",
        "ingested_at": "timestamp_ntz",
        "quantity_mw": "double",
        "price_amount": "double",
    }
    schema = ", ".join(f"{name} {kinds.get(name, 'string')}" for name in base)
    return spark.createDataFrame([tuple((base | c).values()) for c in changes], schema)


def observations(spark, *changes):
    base = {
        "event_date": DAY,
        "observation_timestamp_utc": at(1),
        "country_code": "PL",
        "country": "Poland",
        "bidding_zone": "Zone",
        "technology": "wind-onshore",
        "cluster_name": "site",
        "temperature_2m": 10.0,
        "precipitation": None,
        "global_tilted_irradiance": None,
        "wind_speed_100m": 5.0,
        "ingested_at": at(2),
    }
    kinds = {"event_date": "date"}
    kinds |= dict.fromkeys(("observation_timestamp_utc", "ingested_at"), "timestamp_ntz")
    measures = ["temperature_2m", "precipitation", "global_tilted_irradiance", "wind_speed_100m"]
    kinds |= dict.fromkeys(measures, "double")
    schema = ", ".join(f"{name} {kinds.get(name, 'string')}" for name in base)
    frame = spark.createDataFrame([tuple((base | c).values()) for c in changes], schema)
    missing = [n for n in weather.WEATHER_LIMITS if n not in frame.columns]
    return frame.withColumns({n: F.lit(None).cast("double") for n in missing})


def test_generation_keeps_zero_and_nulls_negative(spark):
    rows = readings(
        spark,
        {"quantity_mw": 0.0},
        {"quantity_mw": -1.0, "psr_type": "B19", "technology": None},
    )
    fact = market.fact_generation(rows)
    assert fact.schema.simpleString() == TABLES["fact_generation"].simpleString()
    got = {r.psr_type: (r.quantity_mw, r.is_renewable) for r in fact.collect()}
    assert got == {"B16": (0.0, True), "B19": (None, False)}


def test_load_nulls_zero(spark):
    assert market.fact_load(readings(spark, {"quantity_mw": 0.0})).first().quantity_mw is None


def test_null_latest_price_removes_the_key(spark):
    rows = readings(
        spark,
        {"price_amount": 5.0},
        {"price_amount": None, "ingested_at": at(3)},
        {"area_code": "B"},
    )
    assert [r.area_code for r in market.fact_prices(rows).collect()] == ["B"]


def test_mix_converts_to_energy_and_shares(spark):
    rows = readings(
        spark,
        {"resolution": "PT15M", "quantity_mw": 40.0},
        {"psr_type": "B04", "technology": "fossil_gas", "quantity_mw": 30.0},
        {"area_code": "N", "technology": "nuclear", "psr_type": "B14"},
        {"area_code": "Z", "quantity_mw": 0.0},
        {"area_code": None, "quantity_mw": 3.0},
        {"area_code": "Q", "quantity_mw": -3.0},
    )
    mix = market.daily_generation_mix(market.fact_generation(rows)).collect()
    got = {(r.area_code, r.technology): (r.total_mwh, r.area_renewable_share_pct) for r in mix}
    assert got == {
        ("A", "solar"): (10.0, 25.0),
        ("A", "fossil_gas"): (30.0, 25.0),
        ("N", "nuclear"): (10.0, None),
        ("Z", "solar"): (0.0, None),
        (None, "solar"): (3.0, None),
    }


def test_days_stay_apart(spark):
    next_day = {"event_date": dt.date(2026, 4, 23), "timestamp_utc": at(1, 23)}
    rows = readings(spark, {}, {"technology": "nuclear", "psr_type": "B14", **next_day})
    mix = market.daily_generation_mix(market.fact_generation(rows)).collect()
    assert {r.technology: r.area_renewable_share_pct for r in mix} == {
        "solar": 100.0,
        "nuclear": None,
    }


def test_weather_limits_and_labels(spark):
    rows = observations(
        spark,
        {"temperature_2m": 60.0},
        {"temperature_2m": 60.001, "cluster_name": "b", "technology": "solar"},
        {"temperature_2m": -60.0, "cluster_name": "c", "technology": None},
    )
    fact = weather.fact_hourly_weather(rows)
    assert fact.schema.simpleString() == TABLES["fact_hourly_weather"].simpleString()
    got = {
        r.cluster_name: (r.temperature_2m, r.technology_group, r.is_renewable)
        for r in fact.collect()
    }
    assert got == {
        "site": (60.0, "wind", True),
        "b": (None, "solar", True),
        "c": (-60.0, None, False),
    }


def test_daily_weather_of_missing_measures(spark):
    daily = weather.daily_bidding_zone(
        weather.fact_hourly_weather(observations(spark, {"wind_speed_100m": None}))
    ).first()
    assert daily.precipitation_sum_mm == 0.0
    assert daily.wind_speed_100m_p90 is None and daily.wind_speed_100m_avg is None
    assert daily.gti_daily_kwh_m2 is None and daily.observation_count == 1


def test_daily_weather_against_brute_force(spark):
    rng = random.Random(7)
    changes = [
        {
            "cluster_name": f"site{n}",
            "technology": "wind-onshore" if n % 3 else "wind-offshore",
            "wind_speed_100m": None if n % 11 == 0 else round(rng.uniform(0, 12), 1),
            "temperature_2m": round(rng.uniform(-10, 30), 3),
            "precipitation": None if n % 2 else round(rng.uniform(0, 3), 2),
        }
        for n in range(400)
    ]
    fact = weather.fact_hourly_weather(observations(spark, *changes))
    for row in weather.daily_bidding_zone(fact).collect():
        mine = [c for c in changes if c["technology"] == row.technology]
        wind = [c["wind_speed_100m"] for c in mine if c["wind_speed_100m"] is not None]
        rain = [c["precipitation"] for c in mine if c["precipitation"] is not None]
        warm = [c["temperature_2m"] for c in mine]
        assert row.observation_count == len(mine)
        assert row.wind_speed_100m_p90 == pytest.approx(np.quantile(wind, 0.9), abs=6e-4)
        assert row.wind_speed_100m_avg == pytest.approx(np.mean(wind), abs=6e-4)
        assert row.wind_speed_100m_max == max(wind)
        assert row.precipitation_sum_mm == pytest.approx(sum(rain), abs=6e-4)
        assert row.temperature_2m_avg == pytest.approx(np.mean(warm), abs=6e-4)
        assert (row.temperature_2m_min, row.temperature_2m_max) == (min(warm), max(warm))


@pytest.fixture
def tables(spark):
    generation = readings(
        spark,
        {"quantity_mw": 10.0},
        {"psr_type": "B19", "technology": "wind_onshore", "quantity_mw": 20.0},
        {"psr_type": "B18", "technology": "wind_offshore", "quantity_mw": 30.0},
        {"psr_type": "B04", "technology": "fossil_gas", "quantity_mw": 40.0},
    )
    load = readings(
        spark,
        {"quantity_mw": 50.0},
        {"quantity_mw": 80.0, "dataset": "day_ahead_total_load_forecast"},
    )
    sites = observations(
        spark,
        {"technology": "solar", "cluster_name": "sun", "global_tilted_irradiance": 500.0},
        {"wind_speed_100m": 10.0},
    )
    made = {
        "fact_generation": market.fact_generation(generation),
        "fact_load": market.fact_load(load),
        "fact_prices": market.fact_prices(load),
        "fact_generation_forecast": market.fact_generation_forecast(
            generation.withColumn("quantity_mw", F.col("quantity_mw") - 5)
        ),
        "fact_hourly_weather": weather.fact_hourly_weather(sites),
    }
    made["agg_daily_generation_mix"] = market.daily_generation_mix(made["fact_generation"])
    made["agg_daily_bidding_zone"] = weather.daily_bidding_zone(made["fact_hourly_weather"])
    return made


def test_supply_and_coverage(tables):
    balance = views.supply_demand(tables).first()
    assert (balance.total_generation_mw, balance.renewable_mw) == (100.0, 60.0)
    assert (balance.total_load_mw, balance.surplus_mw) == (50.0, 50.0)
    covered = reports.load_coverage(tables, DAY.isoformat()).first()
    assert (covered.wind_solar_mw, covered.wind_solar_coverage_pct) == (60.0, 120.0)
    assert reports.load_coverage(tables, "2026-04-23").count() == 0


def test_zone_with_both_winds_repeats_weather(tables):
    wind = views.wind_performance(tables).first()
    assert (wind.total_wind_mwh, wind.peak_wind_mw) == (50.0, 30.0)
    scores = {r.technology: r.weather_adjusted_score for r in reports.weather_score(tables).collect()}
    assert scores == {"solar": 20.0, "wind_onshore": 2.0, "wind_offshore": 3.0}


def test_reports_need_enough_hours(tables):
    assert reports.solar_correlation(tables).count() == 0
    one = reports.solar_correlation(tables, min_hours=1).first()
    assert (one.hours, one.corr_gti) == (1, None)


def test_forecast_error(tables):
    errors = reports.forecast_error(tables, DAY.isoformat()).collect()
    assert [(r.technology, r.error_mw, r.abs_pct_error) for r in errors] == [
        ("solar", 5.0, 50.0),
        ("wind_onshore", 5.0, 25.0),
        ("wind_offshore", 5.0, 16.67),
    ]


def test_views_work_from_sql(spark, tables):
    views.register_views(tables)
    row = spark.sql("SELECT max(renewable_share_pct) AS top FROM v_daily_renewable_share").first()
    assert row.top == 60.0
    assert spark.sql("SELECT * FROM v_area_lookup").count() == 1


def test_counts_include_empty_tables(spark, tables):
    empty = {name: conform(table, TABLES[name]).where("1 = 0") for name, table in tables.items()}
    assert {r.rows for r in reports.table_row_counts(empty).collect()} == {0}
