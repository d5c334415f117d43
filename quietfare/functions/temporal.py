"""Time helpers on zone-less timestamps; the session's zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def micros(ts: Column) -> Column:
    """Microseconds since the epoch."""
    return F.unix_micros(ts.cast("timestamp"))


def bucket(ts: Column, minutes: int) -> Column:
    """``ts`` floored to whole buckets of ``minutes`` counted from the epoch; null stays null."""
    if minutes < 1:
        raise ValueError("a bucket has at least one minute")
    width = minutes * 60_000_000
    return F.timestamp_micros(micros(ts) - F.pmod(micros(ts), F.lit(width))).cast("timestamp_ntz")


def seconds_between(a: Column, b: Column) -> Column:
    """Seconds from ``a`` to ``b`` with fractions."""
    return (micros(b) - micros(a)) / F.lit(1e6)


def nan_to_null(column: Column) -> Column:
    """NaN as null, so that it counts as missing and compares as unknown."""
    return F.when(~F.isnan(column), column)
