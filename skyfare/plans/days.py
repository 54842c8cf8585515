"""Days to be worked on, as filters that prune what a scan reads."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

MOST_RANGES = 64


@dataclass(frozen=True)
class Days:
    """A set of days, and whether rows without a day belong to it. There are as many as a calendar has, not as the trips."""

    known: frozenset[dt.date] = frozenset()
    undated: bool = False

    @staticmethod
    def of(df: DataFrame, column: str) -> Days:
        found = {r[0] for r in df.select(column).distinct().collect()}
        return Days(frozenset(found - {None}), None in found)

    def __or__(self, other: Days) -> Days:
        return Days(self.known | other.known, self.undated or other.undated)

    def __bool__(self) -> bool:
        return bool(self.known) or self.undated

    @property
    def values(self) -> set[dt.date | None]:
        return {*self.known, *([None] if self.undated else [])}

    def ranges(self) -> list[tuple[dt.date, dt.date]]:
        """First and last days of at most 64 stretches that hold all days; the smallest gaps are closed first."""
        days = sorted(self.known)
        gaps = sorted(range(1, len(days)), key=lambda i: days[i - 1] - days[i])
        cuts = sorted(i for i in gaps[: MOST_RANGES - 1] if days[i] - days[i - 1] > dt.timedelta(1))
        return [(days[a], days[b - 1]) for a, b in zip([0, *cuts], [*cuts, len(days)], strict=True) if b > a]

    def hold(self, day: Column) -> Column:
        """Whether a date is one of them: a filter on a partition column."""
        within = day.isin(sorted(self.known)) if self.known else F.lit(False)
        return F.coalesce(within, F.lit(False)) | day.isNull() if self.undated else within

    def near(self, time: Column) -> Column:
        """True for all times of these days, and few others: a filter that row groups can be skipped by."""
        within = F.lit(False)
        for first, last in self.ranges():
            # as text, since a literal time would pass through the session's time zone
            one = time >= F.lit(first.isoformat()).cast("timestamp_ntz")
            if last < dt.date.max:
                one = one & (time < F.lit((last + dt.timedelta(1)).isoformat()).cast("timestamp_ntz"))
            within = within | one
        return within | time.isNull() if self.undated else within
