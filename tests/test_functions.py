from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from gridtide.functions import labels, numeric, temporal
from gridtide.operators.weather import null_outside_limits
from gridtide.reference_data import RENEWABLE_GENERATION, RENEWABLE_WEATHER


def column(spark, values, kind, build):
    rows = [(n, value) for n, value in enumerate(values)]
    frame = spark.createDataFrame(rows, f"n int, x {kind}")
    return [r.y for r in frame.select("n", build("x").alias("y")).orderBy("n").collect()]


def test_round_half_up(spark):
    values = [1.005, 2.675, 0.125, -0.125, 1e20, math.inf, None]
    got = column(spark, values, "double", lambda x: numeric.round_half_up(x, 2))
    assert got == [1.01, 2.68, 0.13, -0.13, 1e20, math.inf, None]
    assert math.isnan(column(spark, [math.nan], "double", lambda x: numeric.round_half_up(x, 2))[0])


def test_to_number(spark):
    values = ["5", " 5.5 ", "-1e3", "abc", "", "NaN", "-Infinity", "1e999", None]
    got = column(spark, values, "string", numeric.to_number)
    assert got == [5.0, 5.5, -1000.0, *[None] * 6]


def test_within_includes_both_ends(spark):
    values = [0.0, 100.0, -0.001, 100.001, 50.0, math.nan, None]
    got = column(spark, values, "double", lambda x: numeric.within(x, 0.0, 100.0))
    assert got == [0.0, 100.0, None, None, 50.0, None, None]


def test_sign_rules_differ_at_zero(spark):
    assert column(spark, [-1.0, 0.0, 1.0], "double", numeric.not_negative) == [None, 0.0, 1.0]
    assert column(spark, [-1.0, 0.0, 1.0], "double", numeric.positive) == [None, None, 1.0]


def test_safe_ratio(spark):
    got = column(spark, [4.0, 0.0, None], "double", lambda x: numeric.safe_ratio(F.lit(2.0), x))
    assert got == [0.5, None, None]


def test_correlation(spark):
    rows = [("line", float(n), 2.0 * n) for n in range(5)]
    rows += [("flat", 1.0, float(n)) for n in range(5)]
    rows += [("one", 1.0, 2.0), ("gaps", 1.0, None), ("gaps", None, 1.0)]
    frame = spark.createDataFrame(rows, "k string, x double, y double")
    value = numeric.round_half_up(numeric.correlation("x", "y"), 6)
    got = {r.k: r.c for r in frame.groupBy("k").agg(value.alias("c")).collect()}
    assert got == {"line": 1.0, "flat": None, "one": None, "gaps": None}


def test_sum_where_without_match_is_null(spark):
    frame = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    never = numeric.sum_where(F.col("x") > 5, "x").alias("never")
    some = numeric.sum_where(F.col("x") > 1, "x").alias("some")
    assert frame.agg(never, some).first().asDict() == {"never": None, "some": 2.0}


def test_utc_from_text(spark):
    noon = dt.datetime(2026, 4, 22, 12, 0)
    cases = {
        "2026-04-22T12:00Z": noon,
        "2026-04-22T12:00:00Z": noon,
        "2026-04-22T12:00:00+00:00": noon,
        "2026-04-22T14:00+02:00": noon,
        "2026-04-22T06:30:00-05:30": noon,
        "2026-04-22 12:00": noon,
        "2026-04-22T12:00:00": noon,
        "2026-04-22T12:00:00.250000+00:00": noon.replace(microsecond=250000),
        "2026-04-22": dt.datetime(2026, 4, 22),
        "": None,
        "12:00": None,
        "T12:00:00Z": None,
        "garbage": None,
        "2026-13-22T12:00:00Z": None,
    }
    assert column(spark, list(cases), "string", temporal.utc_from_text) == list(cases.values())


def test_times_ignore_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        # 02:30 on this day does not exist in New York.
        text = "2026-03-08T02:30Z"
        there = temporal.utc_from_text("x")
        frame = spark.createDataFrame([(text,)], "x string").select(
            there.alias("t"),
            temporal.iso_text(there).alias("iso"),
            temporal.compact_text(there).alias("compact"),
            temporal.hour_floor(there).alias("hour"),
        )
        assert frame.first().asDict() == {
            "t": dt.datetime(2026, 3, 8, 2, 30),
            "iso": "2026-03-08T02:30:00Z",
            "compact": "202603080230",
            "hour": dt.datetime(2026, 3, 8, 2),
        }
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_closed_hour_crosses_the_year(spark):
    frame = spark.createDataFrame([(dt.datetime(2026, 1, 1, 0, 59),)], "x timestamp_ntz")
    start, end = temporal.closed_hour("x")
    row = frame.select(start.alias("s"), end.alias("e")).first()
    assert (row.s, row.e) == (dt.datetime(2025, 12, 31, 23), dt.datetime(2026, 1, 1))


def test_resolution_hours(spark):
    cases = {
        "PT15M": 0.25,
        "PT30M": 0.5,
        "PT60M": 1.0,
        "PT1H": 1.0,
        "pt15m": 0.25,
        "PT2H": 2.0,
        "PT45M": 0.75,
        "P1D": 1.0,
        "P7D": 1.0,
        "P1M": 1.0,
        "PT1H30M": 1.0,
        None: 1.0,
    }
    assert column(spark, list(cases), "string", temporal.resolution_hours) == list(cases.values())


@pytest.mark.parametrize(
    ("resolution", "position", "expected"),
    [
        ("PT15M", 1, dt.datetime(2026, 1, 31, 23, 30)),
        ("PT15M", 3, dt.datetime(2026, 2, 1)),
        ("PT1H", 2, dt.datetime(2026, 2, 1, 0, 30)),
        ("P7D", 2, dt.datetime(2026, 2, 7, 23, 30)),
        ("pt15m", 1, None),
        ("P1M", 1, None),
        (None, 1, None),
        ("PT15M", None, None),
        ("P7D", 2_000_000_000, None),
    ],
)
def test_position_time(spark, resolution, position, expected):
    frame = spark.createDataFrame(
        [(dt.datetime(2026, 1, 31, 23, 30), resolution, position)],
        "s timestamp_ntz, r string, p int",
    )
    assert frame.select(temporal.position_time("s", "r", "p").alias("t")).first().t == expected


def test_buckets_are_open_above(spark):
    got = column(spark, [49.99, 50.0, 200.0, 500.0, 800.0], "double", labels.irradiance_bucket)
    assert [text.split()[0] for text in got] == ["0-50", "50-200", "200-500", "500-800", "800+"]
    got = column(spark, [4.9, 5.0, 10.0, 15.0, 20.0, 25.0], "double", labels.wind_bucket)
    assert [text[:5] for text in got] == ["00-05", "05-10", "10-15", "15-20", "20-25", "25+  "]


def test_labels(spark):
    got = column(spark, ["B16", "B99", "", None], "string", lambda x: labels.label_of(
        x, {"B16": "solar"}))
    assert got == ["solar", None, None, None]
    members = column(spark, ["a", "b", None], "string", lambda x: labels.is_member(x, ["a"]))
    assert members == [True, False, False]
    families = column(
        spark, ["solar", "wind_onshore", "wind-offshore", "other", None], "string",
        labels.technology_family,
    )
    assert families == ["solar", "wind", "wind", None, None]


def test_offset_behind_many_digits_counts(spark):
    texts = ["2024-01-15T09:30:00.12345678901234567890123+02:00", "2024-01-15T09:30:00." + "0" * 60 + "Z"]
    got = column(spark, texts, "string", temporal.utc_from_text)
    assert [t.strftime("%H:%M:%S") for t in got] == ["07:30:00", "09:30:00"]


def test_large_doubles_are_rounded(spark):
    values = [1e15 + 0.125, 2.0**51 + 0.5, 2.0**53 + 2, 1e300, -(1e15) - 0.125]
    got = column(spark, values, "double", lambda v: numeric.round_half_up(v, 0))
    assert got == [1e15, 2.0**51 + 1, 2.0**53 + 2, 1e300, -1e15]


def test_far_positions_are_times_or_null(spark):
    frame = spark.createDataFrame(
        [("P7D", 10_000_000), ("P7D", 2**31 - 1), ("PT60M", 2**31 - 1)], "r string, p int"
    ).withColumn("s", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    made = frame.select(temporal.position_time("s", "r", "p").isNotNull().alias("there"))
    assert [r.there for r in made.collect()][:1] == [True]


# Written out here, apart from the lists the operators use.
RENEWABLE = """solar wind_onshore wind_offshore hydro_run_of_river hydro_reservoir
    hydro_pumped_storage geothermal biomass other_renewable""".split()
LIMITS = """temperature_2m -60 60, relative_humidity_2m 0 100, precipitation 0 500,
    surface_pressure 850 1100, cloud_cover 0 100, shortwave_radiation 0 1500, direct_radiation 0 1500,
    diffuse_radiation 0 1000, global_tilted_irradiance 0 1500, wind_speed_100m 0 120,
    wind_direction_100m 0 360, wind_gusts_10m 0 200"""


def test_each_flag_of_the_technologies(spark):
    others = ["fossil_gas", "nuclear", "wind-onshore", None]
    got = column(
        spark, RENEWABLE + others, "string", lambda v: labels.is_member(v, RENEWABLE_GENERATION)
    )
    assert got == [True] * len(RENEWABLE) + [False] * len(others)
    sites = ["solar", "wind-onshore", "wind-offshore", "wind_onshore", "other"]
    got = column(spark, sites, "string", lambda v: labels.is_member(v, RENEWABLE_WEATHER))
    assert got == [True, True, True, False, False]
    assert column(spark, sites, "string", labels.technology_family) == [
        "solar", "wind", "wind", "wind", None,
    ]


def test_a_value_on_each_side_of_each_limit(spark):
    for name, low, high in (part.split() for part in LIMITS.split(",")):
        low, high = float(low), float(high)
        frame = spark.createDataFrame(
            [(v,) for v in (low - 0.01, low, high, high + 0.01)], f"{name} double"
        )
        got = [r[0] for r in null_outside_limits(frame).collect()]
        assert got == [None, low, high, None], name


def test_a_value_on_each_side_of_each_bucket(spark):
    for build, bounds in (
        (labels.wind_bucket, [5, 10, 15, 20, 25]),
        (labels.irradiance_bucket, [50, 200, 500, 800]),
    ):
        values = [v for bound in bounds for v in (bound - 0.01, float(bound))]
        got = column(spark, values, "double", build)
        assert len(set(got)) == len(bounds) + 1
        assert all(got[n] == got[n + 1] for n in range(1, len(got) - 1, 2))
        assert all(got[n] != got[n + 1] for n in range(0, len(got), 2))
