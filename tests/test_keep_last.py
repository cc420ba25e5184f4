from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from gridtide.operators.keep_last import keep_last

SCHEMA = "k string, j string, ingested_at timestamp_ntz, v int"


def at(hour):
    return dt.datetime(2026, 1, 1, hour)


def rows_of(frame):
    return sorted((r.k, r.j, r.v) for r in frame.collect())


def test_latest_wins_nulls_equal_and_null_time_is_latest(spark):
    frame = spark.createDataFrame(
        [
            ("a", "x", at(1), 1),
            ("a", "x", at(2), 2),
            ("b", "x", at(5), 3),
            ("b", "x", None, 4),
            ("c", "", at(1), 5),
            ("c", "", at(1), 6),
        ],
        SCHEMA,
    )
    assert rows_of(keep_last(frame, ["k", "j"])) == [("a", "x", 2), ("b", "x", 4), ("c", "", 6)]
    nulls = frame.withColumn("j", F.lit(None).cast("string"))
    assert keep_last(nulls, ["k", "j"]).count() == 3


def test_idempotent_and_independent_of_order(spark):
    frame = spark.range(5000).select(
        (F.col("id") % 7).cast("string").alias("k"),
        F.lit("x").alias("j"),
        F.lit(at(1)).cast("timestamp_ntz").alias("ingested_at"),
        F.hash("id").alias("v"),
    )
    once = keep_last(frame, ["k"])
    assert rows_of(once) == rows_of(keep_last(once, ["k"]))
    assert rows_of(once) == rows_of(keep_last(frame.repartition(13, "v"), ["k"]))


def test_hot_key_is_cut_before_the_shuffle(spark):
    frame = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.lit("x").alias("j"),
        F.lit(at(1)).cast("timestamp_ntz").alias("ingested_at"),
        F.col("id").cast("int").alias("v"),
    )
    last = keep_last(frame, ["k"])
    plan = last._jdf.queryExecution().executedPlan().toString()
    shuffle = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[shuffle:], plan
    assert last.where("k = 'hot'").first().v == 29997
