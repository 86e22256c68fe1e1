"""Timestamp parsing for post dates and filter bounds."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from .text import col_of

# Post dates look like "Wed Nov 04 02:03:04 +0000 2020". Spark refuses the
# weekday letter when parsing, so the weekday and its space are cut off first.
POST_TIME_FORMAT = "MMM dd HH:mm:ss Z yyyy"


def parse_post_time(c) -> Column:
    """Parse a post date string to TIMESTAMP; null stays null, bad text raises (ANSI)."""
    return F.to_timestamp(F.substring(col_of(c), 5, 1 << 30), POST_TIME_FORMAT)


def bound_literal(value, target_type=None) -> Column:
    """A comparison bound from text such as ``2020-11-03 08:15:00+01:00``.

    Bounds with an offset are converted to UTC. For TIMESTAMP_NTZ columns the
    literal is the UTC wall-clock time (session time zone is UTC).
    """
    if isinstance(value, str):
        dt = datetime.fromisoformat(value.strip().replace("Z", "+00:00"))
    else:
        dt = value
    if dt.tzinfo is not None:
        dt = dt.astimezone(timezone.utc).replace(tzinfo=None)
    lit = F.lit(dt.isoformat(sep=" "))
    if isinstance(target_type, TimestampNTZType):
        return lit.cast("timestamp_ntz")
    return lit.cast("timestamp")
