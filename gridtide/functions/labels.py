"""Label, flag and bucket column builders."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridtide.functions.numeric import as_column
from gridtide.reference_data import (
    GENERATION_WIND,
    IRRADIANCE_BUCKETS,
    IRRADIANCE_TOP,
    SOLAR,
    WEATHER_WIND,
    WIND_BUCKETS,
    WIND_TOP,
)


def blank_to_null(text: Column | str) -> Column:
    return F.nullif(as_column(text), F.lit(""))


def null_to_blank(text: Column | str) -> Column:
    return F.coalesce(as_column(text), F.lit(""))


def label_of(code: Column | str, labels: Mapping[str, str]) -> Column:
    """Label of a code from a small fixed list; null for an unknown code."""
    lookup = F.create_map(*[F.lit(v) for pair in labels.items() for v in pair])
    return F.try_element_at(lookup, as_column(code))


def is_member(value: Column | str, members: Iterable[str]) -> Column:
    """Membership flag that is false, never null, for a null value."""
    return F.coalesce(as_column(value).isin(list(members)), F.lit(False))


def technology_group(technology: Column | str) -> Column:
    """Weather technology with both wind labels folded into ``wind``."""
    technology = as_column(technology)
    return F.when(technology.isin(WEATHER_WIND), F.lit("wind")).otherwise(technology)


def technology_family(technology: Column | str) -> Column:
    """``solar`` or ``wind`` in either spelling, else null.

    The two vocabularies meet in this key, so generation and weather join on
    equality alone.
    """
    technology = as_column(technology)
    return F.when(technology == SOLAR, F.lit("solar")).when(
        technology.isin(GENERATION_WIND + WEATHER_WIND), F.lit("wind")
    )


def bucket(value: Column | str, bounds: Sequence[tuple[float, str]], top: str) -> Column:
    """Label of the first upper bound above the value; a null falls into the top bucket."""
    value = as_column(value)
    (first, label), *rest = bounds
    chain = F.when(value < first, F.lit(label))
    for bound, label in rest:
        chain = chain.when(value < bound, F.lit(label))
    return chain.otherwise(F.lit(top))


def irradiance_bucket(value: Column | str) -> Column:
    return bucket(value, IRRADIANCE_BUCKETS, IRRADIANCE_TOP)


def wind_bucket(value: Column | str) -> Column:
    return bucket(value, WIND_BUCKETS, WIND_TOP)
