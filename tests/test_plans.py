"""What the physical plans must and must not contain."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from gridtide.catalog import inputs
from gridtide.catalog.queries import QUERIES, report
from gridtide.operators.weather import fact_hourly_weather
from gridtide.plans import rebuild
from gridtide.schemas import MARKET_CLEAN, TABLES, WEATHER_CLEAN, conform
from gridtide.sources.tables import append_partitioned, days_between, overwrite_days, read_table

BATCH = sorted(
    name
    for name in QUERIES
    if not name.startswith(("stream_", "jsonl_", "silver_partitioned", "backfill", "quarantine_lines"))
    and name
    not in (
        "partition_scan",
        "multi_dataset_scan",
        "create_if_absent",
        "idempotent_overwrite",
        "schema_evolution_read",
        "schema_generations_read",
        "xml_large_documents",
        "write_counts",
        "ingest_counts",
        "quarantine_retaken",
        "clean_compacted",
    )
)


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_pairing(name, spark, sf_dir):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for unwanted in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan


def test_scan_reads_only_needed_columns(spark, sf_dir):
    plan = plan_of(QUERIES["v_supply_demand"](spark, sf_dir))
    lines = next(line for line in plan.splitlines() if "lineitem" in line and "ReadSchema" in line)
    assert "l_discount" not in lines and "l_quantity" in lines


def test_day_filter_passes_below_keep_last(spark, sf_dir):
    day = inputs.fact_generation(spark, sf_dir).where(f"event_date = DATE'{inputs.DAY}'")
    plan = plan_of(day)
    assert plan.rindex("Filter") > plan.index("WindowGroupLimit")
    # The filter reaches the scan: the cast to a day became a range of times.
    assert ">= 2024-01-15 00:00:00)" in plan[plan.index("Exchange hashpartitioning"):]


def test_outer_join_becomes_inner(spark, sf_dir):
    assert "LeftOuter" not in plan_of(QUERIES["join_outer_to_inner"](spark, sf_dir))


def test_no_pinned_broadcast(spark, sf_dir):
    """With the size limit off, nothing is broadcast: every broadcast is a checked one."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = plan_of(QUERIES["q11_error_vs_weather"](spark, sf_dir))
        assert "Broadcast" not in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_daily_weather_is_combined_before_its_one_shuffle(spark, sf_dir):
    zones = inputs.tables(spark, sf_dir)["agg_daily_bidding_zone"]
    plan = plan_of(zones)
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert sum("technology_group" in line for line in exchanges) == 1
    assert "partial_percentile" in plan


def test_no_percentile_where_no_wind_is_asked_for(spark, sf_dir):
    for name in ("q13_solar_efficiency", "q02_daily_solar_conversion", "v_solar_performance"):
        plan = plan_of(QUERIES[name](spark, sf_dir))
        assert "percentile" not in plan and "wind_speed_100m" not in plan


def test_wind_speeds_of_a_zone_are_bounded(spark):
    rows = [(n / 7.0001,) for n in range(5000)]
    speeds = spark.createDataFrame(rows, "wind_speed_100m double")
    seen = conform(speeds, WEATHER_CLEAN).withColumns(
        {
            "event_date": F.lit("2024-01-01"),
            "observation_timestamp_utc": F.timestamp_seconds(F.col("wind_speed_100m") * 1000)
            .cast("timestamp_ntz"),
            "cluster_name": F.col("wind_speed_100m").cast("string"),
        }
    )
    fact = fact_hourly_weather(seen)
    speed = F.col("wind_speed_100m")
    assert fact.where((speed < 0) | (speed > 120) | (speed != F.round(speed, 3))).count() == 0


def test_no_forced_repartitioning(spark, sf_dir):
    for name in BATCH:
        assert "REPARTITION_BY_NUM" not in plan_of(QUERIES[name](spark, sf_dir))


def test_one_day_reports_prune_stored_days(spark, sf_dir, tmp_path):
    for name in ("fact_generation", "fact_load", "fact_generation_forecast", "fact_hourly_weather"):
        rows = inputs.tables(spark, sf_dir)[name].where("event_date < DATE'2024-01-17'")
        overwrite_days(rows, rebuild.table_path(str(tmp_path), name), TABLES[name])
    tables = rebuild.open_tables(spark, str(tmp_path))
    for name in ("q01_hourly_solar", "q04_hourly_wind", "q10_forecast_error", "q12_load_coverage"):
        plan = plan_of(report(name, tables))
        scans = [line for line in plan.splitlines() if "PartitionFilters" in line]
        assert scans and all("event_date" in line.split("PartitionFilters")[1].split("]")[0] for line in scans)


def test_a_range_of_years_prunes_without_a_list_of_days(spark, sf_dir, tmp_path):
    clean = str(tmp_path / "clean")
    append_partitioned(inputs.clean_readings(spark, sf_dir), clean, ["event_date", "dataset"])
    decade = days_between(spark, date(2024, 6, 15), date(2034, 6, 14))
    before = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        rows = read_table(spark, clean, MARKET_CLEAN, decade, ["actual_total_load"])
        plan = plan_of(rows)
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", before)
    filters = plan[plan.index("PartitionFilters"):].split("\n")[0]
    assert "dynamicpruningexpression(event_date" in filters and "dataset" in filters
    assert "2024-06-16" not in plan
    whole = read_table(spark, clean, MARKET_CLEAN, None, ["actual_total_load"])
    want = whole.where("event_date BETWEEN '2024-06-15' AND '2034-06-14'")
    assert rows.columns == want.columns and 0 < rows.count() == want.count() < whole.count()
    assert rows.exceptAll(want).count() == 0
    files = {name for (name,) in rows.select(F.input_file_name()).distinct().collect()}
    assert all("event_date=2024-06-14" not in name for name in files)
    assert read_table(spark, clean, MARKET_CLEAN, days_between(spark, date(2024, 2, 1), date(2024, 1, 1))).count() == 0


def test_a_rebuild_of_a_range_equals_that_of_its_days(spark, sf_dir, tmp_path):
    clean = str(tmp_path / "clean")
    append_partitioned(inputs.clean_readings(spark, sf_dir), clean, ["event_date", "dataset"])
    days = [date(2024, month, 14) for month in (3, 4)]
    span = days_between(spark, date(2024, 3, 14), date(2024, 4, 14)).where("day(event_date) = 14")
    counts = [
        rebuild.rebuild_market(spark, clean, str(tmp_path / name), chosen)
        for name, chosen in (("list", [str(day) for day in days]), ("range", span))
    ]
    assert counts[0] == counts[1] and counts[0]["agg_daily_generation_mix"] > 0


def test_readings_lie_in_twelve_months(spark, sf_dir):
    tables = inputs.tables(spark, sf_dir)
    for name in ("fact_generation", "fact_load", "fact_hourly_weather"):
        assert tables[name].selectExpr("month(event_date)").distinct().count() == 12
    months = report("q15_monthly_benchmark", tables).select("month").distinct().count()
    assert months == 12
