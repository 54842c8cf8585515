"""Wall-clock arithmetic on zone-less timestamps.

`date_trunc` and `timestamp_diff` pass through the session time zone, which shifts values inside a
daylight-saving change. These helpers stay zone-less, so results do not depend on session settings.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def hour_bucket(ts: Column) -> Column:
    """Start of the hour `ts` falls in."""
    return F.make_timestamp_ntz(
        F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.lit(0), F.lit(0)
    )


def weekday(ts: Column) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(ts).cast("bigint")


def whole_seconds(start: Column, end: Column) -> Column:
    """Whole seconds from `start` to `end`, cut toward zero."""
    return (end - start).cast("interval second").cast("bigint")


def months_before(as_of: dt.date | Column | None, months: int) -> Column:
    """`as_of` (today when None) moved back by `months`, clamped to the end of a shorter month."""
    if as_of is None:
        day = F.current_date()
    elif isinstance(as_of, Column):
        day = as_of
    else:
        day = F.lit(as_of)
    return F.add_months(day, -months)
