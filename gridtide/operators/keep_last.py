"""Keep the latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RANK = "_rank"


def _default_tiebreak(df: DataFrame, used: set[str]) -> list[str]:
    """All other sortable columns, so that equal rows are the only ones left undecided."""
    return [
        field.name
        for field in df.schema.fields
        if field.name not in used
        and not isinstance(field.dataType, (T.MapType, T.VariantType, T.NullType))
    ]


def keep_last(
    df: DataFrame,
    keys: Sequence[str],
    latest_by: str = "ingested_at",
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: the one with the greatest ``latest_by``.

    Null keys count as equal.  A null ``latest_by`` counts as latest.  Rows with
    the same ``latest_by`` are decided by ``tiebreak``, greatest first; by
    default that is every other column, so the result never depends on the
    order in which rows arrive.

    Spark limits each key to one row per input task before the shuffle
    (WindowGroupLimit), so a key that holds most of the rows ships one row per
    task rather than all of them.
    """
    if tiebreak is None:
        tiebreak = _default_tiebreak(df, {*keys, latest_by})
    order = [F.col(latest_by).desc_nulls_first()]
    order += [F.col(name).desc_nulls_last() for name in tiebreak]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def keep_last_of_day(
    df: DataFrame, keys: Sequence[str], tiebreak: Sequence[str] | None = None
) -> DataFrame:
    """Keep the latest row per key within each ``event_date``.

    Tables are rebuilt day by day, so the day belongs to every key.  It also
    lets a filter on the day pass below the ranking and prune partitions.  It
    comes last in the key: sorting is faster when the first column tells most
    rows apart.
    """
    day = [name for name in ["event_date"] if name in df.columns and name not in keys]
    return keep_last(df, [*keys, *day], tiebreak=tiebreak)
