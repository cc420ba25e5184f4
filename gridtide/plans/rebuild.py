"""Rebuild the analysis tables for any set of days.

All days go through one job per table, or several where they hold many rows; a long
range is a frame of days (``days_between``), which prunes partitions while the scan runs.
A daily aggregate reads back the fact days just written, so the fact is computed once and the lineage ends at a table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtide.operators import market, weather
from gridtide.reference_data import (
    FORECAST_DATASETS,
    GENERATION_DATASETS,
    LOAD_DATASETS,
    PRICE_DATASETS,
)
from gridtide.schemas import MARKET_CLEAN, TABLES, WEATHER_CLEAN
from gridtide.sources.tables import DAY, create_if_absent, overwrite_days, read_table, rounds

MARKET_FACTS = {
    "fact_generation": (GENERATION_DATASETS, market.fact_generation),
    "fact_load": (LOAD_DATASETS, market.fact_load),
    "fact_prices": (PRICE_DATASETS, market.fact_prices),
    "fact_generation_forecast": (FORECAST_DATASETS, market.fact_generation_forecast),
}


def yesterday() -> date:
    """The day a rebuild without an explicit day works on (UTC)."""
    return datetime.now(UTC).date() - timedelta(days=1)


def day_range(first: date, last: date) -> list[str]:
    return [(first + timedelta(days=n)).isoformat() for n in range((last - first).days + 1)]


Days = Iterable[str] | DataFrame | None


def _named(days: Days) -> list[str] | DataFrame:
    """Days as text or as they are in a frame: yesterday where none are named, none for an empty list."""
    if isinstance(days, DataFrame):
        return days
    return [str(day) for day in ([yesterday()] if days is None else days)]


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def open_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All analysis tables below a folder, created empty where absent."""
    for name, schema in TABLES.items():
        create_if_absent(spark, table_path(root, name), schema)
    return {
        name: read_table(spark, table_path(root, name), schema) for name, schema in TABLES.items()
    }


def _overwrite(root: str, name: str, rows: DataFrame) -> int:
    return overwrite_days(rows, table_path(root, name), TABLES[name])


def _overwrite_in(
    ranges: list[tuple], root: str, name: str, readings: DataFrame, build: Callable[[DataFrame], DataFrame]
) -> int:
    """Build and write a table one range of days after another; its builder works day by day."""
    parts = [readings.where(F.col(DAY).between(*ends)) for ends in ranges] if len(ranges) > 1 else [readings]
    return sum(_overwrite(root, name, build(part)) for part in parts)


def _written(spark: SparkSession, root: str, name: str, days: list[str] | DataFrame) -> DataFrame:
    create_if_absent(spark, table_path(root, name), TABLES[name])
    return read_table(spark, table_path(root, name), TABLES[name], days)


def rebuild_market(
    spark: SparkSession,
    clean: str,
    root: str,
    days: Days = None,
    changed: Iterable[str] | None = None,
) -> dict[str, int]:
    """Rebuild the market tables; returns rows written per table.

    ``changed`` names datasets with new data and leaves out tables that use
    none of them.  A table that is rebuilt reads all its datasets, since its
    days are replaced as a whole.  Many days are taken in rounds of a bounded
    number of rows, so the shuffles of all of them need not fit on the disks.
    """
    days = _named(days)
    changed = None if changed is None else set(changed)
    wanted = {n: of for n, of in MARKET_FACTS.items() if changed is None or changed & set(of[0])}
    used = {dataset for datasets, _ in wanted.values() for dataset in datasets}
    ranges = rounds(read_table(spark, clean, MARKET_CLEAN, days, sorted(used))) if wanted else []
    counts = {}
    for name, (datasets, build) in wanted.items():
        readings = read_table(spark, clean, MARKET_CLEAN, days, datasets)
        counts[name] = _overwrite_in(ranges, root, name, readings, build)
    if "fact_generation" in counts:
        name, facts = "agg_daily_generation_mix", _written(spark, root, "fact_generation", days)
        counts[name] = _overwrite_in(ranges, root, name, facts, market.daily_generation_mix)
    return counts


def rebuild_weather(
    spark: SparkSession,
    clean: str,
    root: str,
    days: Days = None,
    changed: Iterable[str] | None = None,
) -> dict[str, int]:
    """Rebuild the two weather tables; returns rows written per table.

    Weather is one dataset, so ``changed`` makes no difference here.
    """
    days = _named(days)
    observations = read_table(spark, clean, WEATHER_CLEAN, days)
    ranges, counts = rounds(observations), {}
    name, daily = "fact_hourly_weather", "agg_daily_bidding_zone"
    counts[name] = _overwrite_in(ranges, root, name, observations, weather.fact_hourly_weather)
    hours = _written(spark, root, name, days)
    counts[daily] = _overwrite_in(ranges, root, daily, hours, weather.daily_bidding_zone)
    return counts
