"""Cleaning steps. Each takes a DataFrame first, so it fits ``df.transform(step, ...)``."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.functions.scalars import col, flag_equals
from tripmart.operators.quantiles import quantiles


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Keep one copy of every row.

    Grouping on all columns combines copies on the map side, so a group of copies of any
    size leaves each task as one row.
    """
    return df.dropDuplicates()


def distinct_positive(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Distinct rows whose measure is positive, and one row of counts over all rows, from one shuffle.

    The counts are ``raw_rows``, ``unmeasured_rows`` (zero, negative or null measure) and
    ``distinct_rows``. Copies are numbered while they are combined; rows that go because of their
    measure lose their values first, so that those of a map task leave it as one row. An
    empty table counts 0 throughout.
    """
    taken = {c.lower() for c in df.columns}
    kept, copies = (next(n for i in range(len(taken) + 1) if (n := f"_{x}{i}") not in taken) for x in ("kept", "copies"))
    named = [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]
    measured = df.select(F.coalesce(F.col(column) > 0, F.lit(False)).alias(kept), *named).select(
        kept, *[F.when(F.col(kept), n).alias(c) for c, n in zip(df.columns, named)]
    )
    groups = measured.groupBy(kept, *named).agg(F.count(F.lit(1)).alias(copies))
    # A condition on the flag alone would be pushed beneath the grouping, here but not for the counts,
    # and the rows would be read and shuffled twice.
    rows = groups.filter(F.when(F.col(copies) > 0, F.col(kept))).select(*named)
    counts = groups.agg(
        F.coalesce(F.sum(copies), F.lit(0)).alias("raw_rows"),
        F.coalesce(F.sum(F.when(~F.col(kept), F.col(copies))), F.lit(0)).alias("unmeasured_rows"),
        F.count_if(kept).alias("distinct_rows"),
    )
    return rows, counts


def keep_positive(df: DataFrame, column: str) -> DataFrame:
    """Drop rows whose measure is zero, negative or null."""
    return df.filter(F.col(column) > 0)


def keep_in_range(df: DataFrame, column: str, above: float, upto: float) -> DataFrame:
    """Keep rows with ``above < column <= upto``; null is dropped."""
    return df.filter((F.col(column) > above) & (F.col(column) <= upto))


def repair_negative(df: DataFrame, column: str, replacement: Column | str) -> DataFrame:
    """Replace negative values; zero, positive and null values stay."""
    c = F.col(column)
    return df.withColumn(column, F.when(c < 0, col(replacement)).otherwise(c))


def winsorise(df: DataFrame, column: str, low: Column | str, high: Column | str) -> DataFrame:
    """Clamp a column into ``[low, high]``; null stays null, and an unknown fence is open."""
    c, lo, hi = F.col(column), col(low), col(high)
    return df.withColumn(column, F.when(c > hi, hi).when(c < lo, lo).otherwise(c))


def impute_missing_or_zero(df: DataFrame, column: str, value: int, type_: str = "int") -> DataFrame:
    """Null and zero become ``value``; everything else is cast."""
    c = F.col(column)
    return df.withColumn(
        column,
        F.when(c.isNull() | (c == 0), F.lit(value).cast(type_)).otherwise(c.try_cast(type_)),
    )


def flag_to_boolean(df: DataFrame, column: str, true_value: str = "Y") -> DataFrame:
    """Text flag to boolean, anything but ``true_value`` (null included) being false."""
    return df.withColumn(column, flag_equals(column, true_value))


def fill_nulls(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace nulls, column by column, by constants. NaN is a value and stays."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def standardise_timestamps(
    df: DataFrame, columns: Iterable[str], type_: str = "timestamp"
) -> DataFrame:
    """Cast to one timestamp type; text that is no timestamp becomes null."""
    return df.withColumns({c: F.col(c).try_cast(type_) for c in columns})


def repair_limits(
    df: DataFrame,
    repair_column: str,
    cap_column: str,
    k: float,
    method: str = "exact",
    accuracy: int = 10_000,
) -> DataFrame:
    """One lazy row: ``repair_value`` (median of the positive values of ``repair_column``)
    and ``cap_low``/``cap_high`` (``Q1 - k*IQR`` / ``Q3 + k*IQR`` of ``cap_column``)."""
    positive = F.when(F.col(repair_column) > 0, F.col(repair_column))
    stats = quantiles(
        df,
        {
            "repair_value": (positive, 0.5),
            "q1": (cap_column, 0.25),
            "q3": (cap_column, 0.75),
        },
        method,
        accuracy,
    )
    iqr = F.col("q3") - F.col("q1")
    return stats.select(
        "repair_value",
        (F.col("q1") - F.lit(float(k)) * iqr).alias("cap_low"),
        (F.col("q3") + F.lit(float(k)) * iqr).alias("cap_high"),
    )
