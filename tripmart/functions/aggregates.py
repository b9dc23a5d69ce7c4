"""Aggregate expressions shared by the reports, the profile and the checks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.functions.scalars import col


def row_count() -> Column:
    return F.count(F.lit(1))


def count_where(condition: Column) -> Column:
    """Rows for which the condition is true (null conditions do not count)."""
    return F.count_if(condition)


def percent_where(condition: Column) -> Column:
    """Share, in percent, of a group's rows that satisfy the condition."""
    return F.lit(100.0) * F.count_if(condition) / F.count(F.lit(1))


def null_count(c: Column | str) -> Column:
    return F.count_if(col(c).isNull())


def null_counts(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """One row with the null count of every given column, in a single pass."""
    return df.agg(*[null_count(F.col(c)).alias(c) for c in (columns or df.columns)])
