"""Time column builders.

Every instant is a ``TIMESTAMP_NTZ`` that holds the UTC wall clock.  Nothing
here reads the session time zone, so results are the same on every cluster.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridtide.functions.numeric import as_column
from gridtide.reference_data import RESOLUTION_MINUTES

def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def utc_from_instant(instant: Column | str) -> Column:
    """UTC wall clock of a zoned TIMESTAMP."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(as_column(instant)), _epoch())


def utc_from_epoch(seconds: Column | str) -> Column:
    return F.timestamp_add("SECOND", as_column(seconds).cast("long"), _epoch())


def utc_from_text(text: Column | str) -> Column:
    """UTC wall clock of an ISO-8601 text; blank or unreadable text gives null.

    Accepts minutes without seconds, any offset, no offset (read as UTC) and a
    bare date.  The layout is fixed by position, so no pattern matching runs
    per row; the cast rejects whatever is not a time.
    """
    text = F.trim(as_column(text))
    # A bare time of day is no instant, though a cast would read it as today's.
    is_dated = (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-")
    head, tail = F.substring(text, 1, 16), F.substring(text, F.lit(17), F.length(text))
    seconds = F.when(tail.startswith(":"), F.lit("")).otherwise(F.lit(":00"))
    has_offset = tail.endswith("Z") | tail.contains("+") | tail.contains("-")
    offset = F.when(has_offset, F.lit("")).otherwise(F.lit("Z"))
    full = F.when(F.length(text) == 10, F.concat(text, F.lit("T00:00:00Z"))).otherwise(
        F.concat(head, seconds, tail, offset)
    )
    return utc_from_instant(F.when(is_dated, full).try_cast("timestamp"))


def hour_floor(ts: Column | str) -> Column:
    ts = as_column(ts)
    return F.timestamp_add("HOUR", F.hour(ts), F.to_date(ts).cast("timestamp_ntz"))


def month_floor(day: Column | str) -> Column:
    return F.trunc(as_column(day), "month").cast("timestamp_ntz")


def iso_text(ts: Column | str) -> Column:
    """2024-01-15T09:30:00Z"""
    seconds = F.substring(as_column(ts).cast("string"), 1, 19)
    return F.concat(F.translate(seconds, " ", "T"), F.lit("Z"))


def compact_text(ts: Column | str) -> Column:
    """202401150930"""
    return F.translate(F.substring(as_column(ts).cast("string"), 1, 16), "- :", "")


def closed_hour(now: Column | str) -> tuple[Column, Column]:
    """Start and end of the last hour that has fully passed at ``now``."""
    end = hour_floor(now)
    return F.timestamp_add("HOUR", F.lit(-1), end), end


def resolution_hours(resolution: Column | str) -> Column:
    """Hours of one reading, for MW to MWh; anything but hours or minutes counts as 1."""
    text = F.upper(as_column(resolution))
    usual = {name: n / 60 for name, n in RESOLUTION_MINUTES.items() if name.startswith("PT")}
    known = F.try_element_at(
        F.create_map(*[F.lit(v) for pair in usual.items() for v in pair]), text
    )
    hours = F.regexp_extract(text, r"^PT(\d+(?:\.\d+)?)H$", 1).try_cast("double")
    minutes = F.regexp_extract(text, r"^PT(\d+(?:\.\d+)?)M$", 1).try_cast("double")
    # Patterns are only tried for a text outside the usual ones.
    return F.coalesce(known, hours, minutes / 60, F.lit(1.0))


def position_time(start: Column | str, resolution: Column | str, position: Column | str) -> Column:
    """Time of a reading from its 1-based position; null for an unknown resolution."""
    step = F.create_map(*[F.lit(v) for pair in RESOLUTION_MINUTES.items() for v in pair])
    minutes = F.try_element_at(step, as_column(resolution)).cast("long")
    steps = F.try_subtract(as_column(position).cast("long"), F.lit(1))
    # A product or sum beyond the range of its type is null, not an error.
    micros = F.try_multiply(F.try_multiply(steps, minutes), F.lit(60_000_000))
    start = as_column(start)
    end = F.try_add(F.unix_micros(start.cast("timestamp")), micros)
    return F.timestamp_add("MICROSECOND", F.when(end.isNotNull(), micros), start)
