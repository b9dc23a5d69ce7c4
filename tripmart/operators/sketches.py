"""Quantiles of a growing table from sketches that are stored per partition.

A sketch (KLL) keeps a bounded choice of a column's values, from which the rank of any value is known within
a small share of the rows, whatever their number. Sketches of parts merge into one of the whole: a month
that lands is sketched alone and its sketch takes the place of the one it had, and a quantile over any
months reads one short row per month and column, never the rows.

Null and NaN are no values and are left out. A column without values has ``n`` 0 and gives no row when
sketches are merged. Landing no rows replaces nothing. Sketches of different ``k`` may be merged; the
smallest one tells the error.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions.scalars import col
from tripmart.sources.sinks import write_table

K = 800
FIELDS = ("series", "n", "low", "high", "sketch")


def rank_error(k: int = K) -> float:
    """By how much of all rows the rank of a sketched quantile may be off, in 99 of 100 cases."""
    # The fitted error of this kind of sketch.
    return 2.296 / k**0.9723


def _values(column: Column | str) -> Column:
    value = col(column).cast("double")
    return F.when(~F.isnan(value), value)


def sketch_columns(
    df: DataFrame, columns: Mapping[str, Column | str] | Sequence[str], by: Sequence[str] = (), k: int = K
) -> DataFrame:
    """One row per combination of ``by`` and column: ``series, n, low, high, sketch``.

    Every task sketches its own rows, and one sketch per task, combination and column is shuffled, so a month
    that holds a third of all rows costs its reducer no more than the others.
    """
    named = columns if isinstance(columns, Mapping) else {c: c for c in columns}
    clash = {c.lower() for c in by}.intersection(FIELDS)
    if clash:
        raise ValueError(f"columns to group by have names of the result: {', '.join(sorted(clash))}")
    sketched = [
        F.struct(
            F.lit(name).alias("series"),
            F.count(_values(c)).alias("n"),
            F.min(_values(c)).alias("low"),
            F.max(_values(c)).alias("high"),
            F.kll_sketch_agg_double(_values(c), k).alias("sketch"),
        )
        for name, c in named.items()
    ]
    return df.groupBy(*by).agg(F.array(*sketched).alias("of")).select(*by, F.inline("of"))


def land_sketches(
    df: DataFrame, columns: Mapping[str, Column | str] | Sequence[str], by: Sequence[str], path: str, k: int = K
) -> str:
    """Sketch the rows and replace the stored sketches of the partitions they belong to; the others stay."""
    return write_table(sketch_columns(df, columns, by, k), path, by, replace="partitions")


def read_sketches(spark: SparkSession, path: str, where: str | None = None) -> DataFrame:
    """Stored sketches; a condition on the partition columns selects folders before a file is opened."""
    stored = spark.read.parquet(path)
    return stored.filter(where) if where else stored


def merged_quantiles(
    sketches: DataFrame, probabilities: Mapping[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """``*by, series, n, low, high`` and a column per entry of ``probabilities``, over all given sketches or
    per combination of ``by``. Every quantile is a value of the data."""
    merged = (
        sketches.filter(F.col("n") > 0)
        .groupBy(*by, "series")
        .agg(
            F.sum("n").alias("n"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            F.kll_merge_agg_double("sketch").alias("sketch"),
        )
    )
    found = [F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(name) for name, p in probabilities.items()]
    return merged.select(*by, "series", "n", "low", "high", *found)


def merged_shares(sketches: DataFrame, limits: Mapping[str, float], by: Sequence[str] = ()) -> DataFrame:
    """``*by, series, n`` and, per entry of ``limits``, the share of values up to that limit."""
    merged = (
        sketches.filter(F.col("n") > 0)
        .groupBy(*by, "series")
        .agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))
    )
    found = [F.kll_sketch_get_rank_double("sketch", F.lit(float(v))).alias(name) for name, v in limits.items()]
    return merged.select(*by, "series", "n", *found)


def sketched_fences(sketches: DataFrame, k: float = 1.5, by: Sequence[str] = ()) -> DataFrame:
    """``*by, series, n, q1, median, q3, low_fence, high_fence`` without a look at the rows."""
    reach = F.lit(float(k)) * (F.col("q3") - F.col("q1"))
    return merged_quantiles(sketches, {"q1": 0.25, "median": 0.5, "q3": 0.75}, by).select(
        *by, "series", "n", "q1", "median", "q3",
        (F.col("q1") - reach).alias("low_fence"), (F.col("q3") + reach).alias("high_fence"),
    )
