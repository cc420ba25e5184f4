"""Time the table builds and the reports over stored tables; print one JSON line.

BENCH_SF_DIR names the folder of the given tables (default sf0.1), BENCH_CPUS
the local cores (default 4), BENCH_RUNS the timed runs per query (default 3, the
median counts).  The seven analysis tables are written once, day-partitioned,
from cleaned readings; each report then reads those it needs.  One untimed run
comes first; every query runs in full into the ``noop`` sink.  ``raw_*`` queries
build a table from the given tables instead of reading a stored one.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from gridtide.catalog import inputs
from gridtide.catalog.queries import OVER_TABLES, QUERIES, report
from gridtide.plans import rebuild
from gridtide.schemas import TABLES
from gridtide.sources.tables import append_partitioned, days_between


def session(cpus: str, shared: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("gridtide-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.files.minPartitionNum", cpus)
        .config("spark.checkpoint.dir", shared)
        .config("spark.sql.warehouse.dir", f"{shared}/warehouse")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(work: Callable[[], object]) -> float:
    start = time.perf_counter()
    work()
    return time.perf_counter() - start


def build_tables(spark: SparkSession, sf_dir: str, root: str) -> tuple[str, dict[str, float]]:
    """Write cleaned readings, then all seven tables for every day they hold."""
    market, weather, tables = (f"{root}/{name}" for name in ("market", "weather", "tables"))
    readings = inputs.clean_readings(spark, sf_dir)
    seconds = {
        "write_market": timed(
            lambda: append_partitioned(readings, market, ["event_date", "dataset"])
        ),
        "write_weather": timed(
            lambda: append_partitioned(
                inputs.clean_weather(spark, sf_dir), weather, ["event_date"]
            )
        ),
    }
    days = days_between(spark, date(2024, 1, 1), date(2024, 12, 31))
    seconds["rebuild_market"] = timed(lambda: rebuild.rebuild_market(spark, market, tables, days))
    seconds["rebuild_weather"] = timed(
        lambda: rebuild.rebuild_weather(spark, weather, tables, days)
    )
    return tables, {name: round(value, 3) for name, value in seconds.items()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    with tempfile.TemporaryDirectory(prefix="gridtide-bench-") as shared:
        spark = session(cpus, shared)
        root, builds = build_tables(spark, sf_dir, shared)
        tables = rebuild.open_tables(spark, root)
        queries: dict[str, Callable[[], DataFrame]] = {
            f"raw_{name}": lambda name=name: QUERIES[name](spark, sf_dir) for name in TABLES
        }
        queries |= {name: lambda name=name: report(name, tables) for name in OVER_TABLES}

        def run(name: str) -> float:
            write = lambda: queries[name]().write.format("noop").mode("overwrite").save()
            return timed(write)

        seconds = {}
        for name in queries:
            run(name)
            seconds[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
        spark.stop()
    result = {
        "metric": "table queries and reports over stored tables, warm median, summed",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "builds": builds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": cpus,
        "runs": runs,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
