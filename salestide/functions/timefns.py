"""Time helpers: the as-of instant, interval literals, parsing, labels."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_INTERVAL = re.compile(
    r"^\s*(\d+)\s+(microsecond|millisecond|second|minute|hour|day|week|month|year)s?\s*$",
    re.IGNORECASE)

# dayofweek() numbering (1 = Sunday) and its short labels.
WEEKDAY_LABELS = {1: "Sun", 2: "Mon", 3: "Tue", 4: "Wed", 5: "Thu", 6: "Fri", 7: "Sat"}


def as_of_column(as_of=None) -> Column:
    """The as-of instant as a ``TIMESTAMP_NTZ`` column.

    ``None`` means "now" as wall-clock time in the session time zone
    (``localtimestamp()``), so a session in ``Asia/Kolkata`` reproduces the
    original "current time in IST".  Strings and datetimes are taken as naive
    wall-clock times; a Column is used as is.
    """
    if as_of is None:
        return F.localtimestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, dt.datetime):
        as_of = as_of.replace(tzinfo=None).isoformat(sep=" ")
    elif isinstance(as_of, dt.date):
        as_of = as_of.isoformat()
    return F.lit(str(as_of)).cast("timestamp_ntz")


def interval(length) -> Column:
    """An interval literal from ``"3 hours"``-style text or a ``timedelta``."""
    if isinstance(length, Column):
        return length
    if isinstance(length, dt.timedelta):
        return F.lit(length)
    m = _INTERVAL.match(str(length))
    if not m:
        raise ValueError(f"not an interval: {length!r}")
    return F.expr(f"INTERVAL {int(m.group(1))} {m.group(2).upper()}")


def interval_seconds(length) -> int:
    """Length of a fixed-size interval in whole seconds (no months/years)."""
    if isinstance(length, dt.timedelta):
        return int(length.total_seconds())
    m = _INTERVAL.match(str(length))
    if not m:
        raise ValueError(f"not an interval: {length!r}")
    unit = m.group(2).lower()
    per = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}
    if unit not in per:
        raise ValueError(f"interval {length!r} has no fixed length in seconds")
    return int(m.group(1)) * per[unit]


def parse_timestamp(c: str | Column) -> Column:
    """Text to ``TIMESTAMP_NTZ``; unparsable text gives NULL, not an error."""
    c = F.col(c) if isinstance(c, str) else c
    return F.try_to_timestamp(c).cast("timestamp_ntz")


def weekday_name(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    pairs = []
    for k, v in WEEKDAY_LABELS.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.try_element_at(F.create_map(*pairs), c)
