"""Means and ratios that leave zero denominators out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, NULL where the denominator is zero or NULL."""
    return numerator / F.nullif(denominator, F.lit(0))


def mean_ratio(numerator: Column, denominator: Column, scale: float = 1.0) -> Column:
    """Mean of the per-row ratios (not the ratio of the sums) times `scale`."""
    return F.avg(safe_ratio(numerator, denominator)) * F.lit(scale)


def celsius(fahrenheit: Column) -> Column:
    return (fahrenheit - 32) * 5 / 9


@dataclass(frozen=True)
class PartialMean:
    """A mean carried as (sum, count) through a first aggregation and finished in a second one."""

    name: str
    value: Column

    def start(self) -> list[Column]:
        return [
            F.sum(self.value).alias(f"{self.name}__sum"),
            F.count(self.value).alias(f"{self.name}__n"),
        ]

    def finish(self, keep: Column | None = None) -> Column:
        """Mean over the rows of the first aggregation, or over those where `keep` holds."""
        total, n = F.col(f"{self.name}__sum"), F.col(f"{self.name}__n")
        if keep is not None:
            total, n = F.when(keep, total), F.when(keep, n)
        return safe_ratio(F.sum(total), F.sum(n))
