"""Which (area, dataset) series should arrive, which did not, and which intervals of them are missing."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtide.reference_data import EVERY_DATASET, MARKET_DATASETS


def expected_series(areas: DataFrame, datasets: Sequence[str] = tuple(MARKET_DATASETS)) -> DataFrame:
    """A row per area and dataset the area is used for (its column ``use_for``).

    Each area expands its own list, so no pairing of all areas with all
    datasets takes place.
    """
    every = F.array(*[F.lit(name) for name in datasets])
    wanted = F.when(F.array_contains("use_for", EVERY_DATASET), every).otherwise(
        F.array_intersect("use_for", every)
    )
    own = [name for name in areas.columns if name != "use_for"]
    return areas.select(*own, F.explode(wanted).alias("dataset"))


def series_status(expected: DataFrame, received: DataFrame) -> DataFrame:
    """Expected series with the number of received rows; 0 marks a missing series.

    ``received`` is counted per series before the join, so the join sees one
    row per series.
    """
    counts = received.groupBy("area_code", "dataset").agg(F.count(F.lit(1)).alias("rows_received"))
    joined = expected.join(counts, ["area_code", "dataset"], "left")
    return joined.withColumn("rows_received", F.coalesce("rows_received", F.lit(0)))


def interval_gaps(
    expected: DataFrame, received: DataFrame, first: date, last: date, minutes: int = 60
) -> DataFrame:
    """The runs of intervals that are missing in each expected series, from one day to another.

    A row per gap: area_code, dataset, gap_start, gap_end (not included) and
    n_missing.  An interval is there if any reading falls into it; a series
    without any is one gap from end to end; series that are not expected do not
    count.

    Intervals are numbered from the first midnight on and counted once per
    series before the shuffle, so a series with most of all readings ships no
    more rows per task than there are intervals.  Gaps are what lies between
    neighbouring numbers; the missing intervals themselves are never listed.
    """
    series = ["area_code", "dataset"]
    start = F.lit(first).cast("timestamp_ntz")
    count = ((last - first).days + 1) * 1440 // minutes
    number = F.floor(F.timestamp_diff("MINUTE", start, F.col("timestamp_utc")) / minutes)
    wanted = expected.select(*series).distinct()
    # A time before the first midnight may round to 0; the bounds are those of the time itself.
    inside = (F.col("timestamp_utc") >= start) & (
        F.col("timestamp_utc") < F.timestamp_add("DAY", F.lit((last - first).days + 1), start)
    )
    seen = received.where(inside).select(*series, number.cast("long").alias("number")).distinct()
    ends = F.explode(F.array(F.lit(-1).cast("long"), F.lit(count).cast("long"))).alias("number")
    marks = seen.join(wanted, series, "left_semi").union(wanted.select(*series, ends))
    before = F.lag("number").over(Window.partitionBy(*series).orderBy("number"))
    gaps = marks.withColumn("before", before).where(F.col("number") - F.col("before") > 1)

    def time_of(interval: Column) -> Column:
        return F.timestamp_add("MINUTE", interval * minutes, start)

    return gaps.select(
        *series,
        time_of(F.col("before") + 1).alias("gap_start"),
        time_of(F.col("number")).alias("gap_end"),
        (F.col("number") - F.col("before") - 1).alias("n_missing"),
    )


def completeness(
    expected: DataFrame, gaps: DataFrame, first: date, last: date, minutes: int = 60
) -> DataFrame:
    """Per expected series: intervals expected and received, the number of gaps and the longest."""
    count = ((last - first).days + 1) * 1440 // minutes
    series = ["area_code", "dataset"]
    by_series = gaps.groupBy(*series).agg(
        F.sum("n_missing").alias("missing"),
        F.count(F.lit(1)).alias("n_gaps"),
        F.max("n_missing").alias("longest_gap"),
    )
    joined = expected.select(*series).distinct().join(by_series, series, "left")
    none = F.lit(0).cast("long")
    return joined.select(
        *series,
        F.lit(count).cast("long").alias("n_expected"),
        (F.lit(count) - F.coalesce("missing", none)).cast("long").alias("n_received"),
        F.coalesce("n_gaps", none).alias("n_gaps"),
        F.coalesce("longest_gap", none).alias("longest_gap"),
    )
