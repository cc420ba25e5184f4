"""Day-partitioned Parquet tables: scan, append, repeatable overwrite."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtide.schemas import conform

DAY = "event_date"
# So many rows with all their columns go through the shuffles of one round at most, or one day's.
ROWS_AT_ONCE = 4_000_000


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one the cluster shares between its machines.

    The cluster names that folder in ``spark.checkpoint.dir``.  Without the
    setting the warehouse of the session is used, which is shared as well.
    What is written there belongs to the caller, who may delete it after use.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/gridtide/{name}-{uuid.uuid4().hex}"


# Tables are read far more often than written, and a scan has less to fetch.
COMPRESSION = "zstd"
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def free_shuffles(spark: SparkSession) -> None:
    """Let shuffle files go when the query that made them has ended, unless the session says otherwise.

    Without it they stay until the driver happens to collect its garbage, so a
    job of many steps fills the disks with those of all its steps.  Spark reads
    the setting when a query is run, so it stays for the session.
    """
    if spark.conf.get(_FREE_SHUFFLES, None) is None:
        spark.conf.set(_FREE_SHUFFLES, "true")


def append_partitioned(df: DataFrame, path: str, by: Sequence[str], laid_out: bool = False) -> None:
    """Append to a partitioned table.  Rows without a partition value are left out.

    The rebalance hint gathers each partition into few files and splits a
    partition that holds far more rows than the others, so no task writes an
    oversized partition alone.  ``laid_out`` says that the rows come from such a
    rebalance already, done while they had fewer columns.
    """
    free_shuffles(df.sparkSession)
    for name in by:
        df = df.where(F.col(name).isNotNull())
    df = df if laid_out else df.hint("rebalance", *by)
    df.write.partitionBy(*by).mode("append").parquet(path, compression=COMPRESSION)


def days_between(spark: SparkSession, first: date, last: date) -> DataFrame:
    """A row per day of a range, for ``read_table``; nothing where the range ends before it begins.

    The days are counted off, not listed, and the bounds stand as a filter on
    them: that tells the planner to prune the partitions of the table they are
    joined with while it runs, however long the range.
    """
    count = max((last - first).days + 1, 0)
    day = F.date_add(F.lit(first), F.col("id").cast("int")).alias(DAY)
    return spark.range(count).select(day).where(F.col(DAY).between(F.lit(first), F.lit(last)))


def on_days(table: DataFrame, days: Iterable[str] | DataFrame) -> DataFrame:
    """The rows of some days; the partitions of the others are not read."""
    if isinstance(days, DataFrame):
        kind = table.schema[DAY].dataType
        wanted = days.select(F.col(days.columns[0]).cast(kind).alias(DAY))
        return table.join(wanted, DAY, "left_semi")
    return table.where(F.col(DAY).isin([str(day) for day in days]))


def rounds(table: DataFrame, by: str = DAY) -> list[tuple]:
    """Ranges (first, last) of a partition column: a bounded number of rows each, or one value.

    One row per value comes to the driver; the counts are those the files name.
    Rows without a value are in no range.
    """
    counted = table.where(F.col(by).isNotNull()).groupBy(by).count().orderBy(by).collect()
    ranges: list[tuple] = []
    held = 0
    for value, count in counted:
        if ranges and held + count <= ROWS_AT_ONCE:
            ranges[-1] = (ranges[-1][0], value)
            held += count
        else:
            ranges.append((value, value))
            held = count
    return ranges


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    days: Iterable[str] | DataFrame | None = None,
    datasets: Iterable[str] | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """Scan a table with its declared schema, pruned to days and datasets.

    Days are a few texts, which become a filter, or a frame of one column, which
    is joined and prunes while the scan runs.  Several datasets need one scan,
    not a union.  Columns that older files lack read as null.
    """
    reader = spark.read.schema(schema).option("mergeSchema", merge_schema)
    table = reader.option("pathGlobFilter", "*.parquet").parquet(path).select(*schema.names)
    if datasets is not None:
        table = table.where(F.col("dataset").isin(list(datasets)))
    if days is not None:
        table = on_days(table, days)
    return table.select(*schema.names)


def create_if_absent(
    spark: SparkSession, path: str, schema: T.StructType, by: Sequence[str] = (DAY,)
) -> None:
    """Create an empty table with the declared columns; an existing one stays as it is."""
    empty = spark.createDataFrame([], schema)
    empty.write.partitionBy(*by).mode("ignore").parquet(path)


def overwrite_days(
    df: DataFrame,
    path: str,
    schema: T.StructType,
    former_names: Mapping[str, str] | None = None,
) -> int:
    """Replace the days that occur in the frame and return the rows written.

    Other days stay.  An empty frame changes nothing.  Running it twice gives
    the same table.
    """
    free_shuffles(df.sparkSession)
    written = Observation()
    rows = conform(df, schema, former_names).where(F.col(DAY).isNotNull())
    rows = rows.hint("rebalance", DAY).observe(written, F.count(F.lit(1)).alias("rows"))
    writer = rows.write.partitionBy(DAY).option("partitionOverwriteMode", "dynamic")
    writer.mode("overwrite").parquet(path, compression=COMPRESSION)
    return written.get["rows"]


def count_by(df: DataFrame, column: str) -> DataFrame:
    """Rows per written dataset or table."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
