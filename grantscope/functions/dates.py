"""Review-time helpers. The review time is always explicit (never the wall clock)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



def as_of_ts(as_of: str) -> Column:
    """The review time as a TIMESTAMP_NTZ literal (time-zone independent)."""
    return F.lit(as_of).cast("timestamp_ntz")



def plus_hours(ts: Column, hours: Column) -> Column:
    return F.timestamp_add("HOUR", hours, ts)
