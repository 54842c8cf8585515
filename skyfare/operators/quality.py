"""Data-quality checks. Each returns the failing rows (or failing values, for checks on groups)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from skyfare.operators.lookup import lookup_join
from skyfare.scratch import hold


def _n_records() -> Column:
    return F.count(F.lit(1)).alias("n_records")


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows in which `column` is NULL."""
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values of `column` that occur more than once; NULLs may repeat."""
    return unique_combination(df.where(F.col(column).isNotNull()), [column])


def accepted_values(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    """Values of `column` outside `values`, compared as text; NULL is accepted."""
    listed = F.col(column).cast("string").isin([str(v) for v in values])
    return df.where(~listed).groupBy(column).agg(_n_records())


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows of `child` whose `column` is not NULL and not found in the parent's column.

    The values at fault are found on counted values; the rows are then looked up by them, so the rows
    are not shuffled by a value that many of them share.
    """
    orphans = hold(orphan_values(child, column, parent, parent_column).select(column), "orphans")
    return lookup_join(child, orphans, {column: column}, how="inner")


def orphan_values(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """The failing values of `relationships` with their row counts. Rows are counted per value
    before the join, so a hot value is one row in the shuffle."""
    counted = child.where(F.col(column).isNotNull()).groupBy(column).agg(_n_records())
    known = parent.select(F.col(parent_column).alias(column)).distinct()
    return counted.join(known, column, "left_anti").select(column, "n_records")


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Value combinations that occur more than once; NULLs count as equal."""
    return df.groupBy(*columns).agg(_n_records()).where(F.col("n_records") > 1)


def expression_is_true(df: DataFrame, expression: str | Column) -> DataFrame:
    """Rows for which the expression is false; a NULL result passes."""
    condition = F.expr(expression) if isinstance(expression, str) else expression
    return df.where(~condition)
