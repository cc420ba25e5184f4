"""Reports come in the order they promise."""

from __future__ import annotations

import pytest

from gridtide.catalog.queries import QUERIES

# Sort keys of each report, first one first; a minus means falling.
ORDERS = {
    "readme_daily_share": "event_date -renewable_share_pct",
    "q01_hourly_solar": "bidding_zone observation_timestamp_utc",
    "q02_daily_solar_conversion": "-mwh_per_kwh_m2",
    "q03_solar_corr": "-corr_gti",
    "q04_hourly_wind": "bidding_zone observation_timestamp_utc",
    "q05_wind_corr": "-corr_wind_speed",
    "q06_wind_buckets": "bidding_zone wind_bucket",
    "q07_irradiance_buckets": "bidding_zone irradiance_bucket",
    "q08_normalized_peak": "event_date area_code technology",
    "q09_weather_score": "-weather_adjusted_score",
    "q10_forecast_error": "-abs_pct_error",
    "q11_error_vs_weather": "-abs_error_mw",
    "q12_load_coverage": "area_code timestamp_utc",
    "q13_solar_efficiency": "vs_avg",
    "q14_wind_underperformance": "performance_vs_avg",
    "q15_monthly_benchmark": "month -monthly_performance_score",
}


def rank(value, falling):
    """Nulls last, whatever the direction."""
    if value is None:
        return (1, 0)
    number = value.toordinal() * 86400 if hasattr(value, "toordinal") else value
    if hasattr(value, "hour"):
        number += value.hour * 3600 + value.minute * 60 + value.second
    return (0, -number if falling else number) if not isinstance(number, str) else (0, number)


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_rows_are_in_order(name, spark, sf_dir):
    rows = QUERIES[name](spark, sf_dir).collect()
    keys = ORDERS[name].split()
    assert len(rows) > 1
    ranks = [tuple(rank(r[k.lstrip("-")], k[0] == "-") for k in keys) for r in rows]
    assert ranks == sorted(ranks)
