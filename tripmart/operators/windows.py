"""Window operators.

Ranking over the whole set, running totals and moving averages order all rows in one
task, so they belong *behind* an aggregation, on one row per group or per day. Operators
that take ``partition`` may also run on raw rows; ``top_k`` cuts each group to ``k`` rows on
the map side before the shuffle, so a hot group costs no more than any other.

Null order is explicit: ascending puts nulls first, descending puts nulls last.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.functions.scalars import col, rounded

RANKERS = {"rank": F.rank, "dense_rank": F.dense_rank, "row_number": F.row_number}


def _over(partition: Sequence, order: Sequence):
    return Window.partitionBy(*partition).orderBy(*order)


def rank_within(
    df: DataFrame,
    out: str,
    order: Sequence[Column | str],
    partition: Sequence[Column | str] = (),
    kind: str = "rank",
) -> DataFrame:
    """Add a rank. ``row_number`` needs a tiebreak in ``order`` to be repeatable."""
    return df.withColumn(out, RANKERS[kind]().over(_over(partition, order)))


def ntile_within(
    df: DataFrame,
    out: str,
    tiles: int,
    order: Sequence[Column | str],
    partition: Sequence[Column | str] = (),
) -> DataFrame:
    """Cut grouped rows into ``tiles`` numbered classes of equal size."""
    return df.withColumn(out, F.ntile(tiles).over(_over(partition, order)))


def top_k(
    df: DataFrame,
    k: int,
    order: Sequence[Column | str],
    partition: Sequence[Column | str] = (),
    out: str = "position",
) -> DataFrame:
    """The first ``k`` rows of every group with their position."""
    return rank_within(df, out, order, partition, "row_number").filter(F.col(out) <= k)


def share_of_total(
    df: DataFrame,
    measure: Column | str,
    out: str,
    partition: Sequence[Column | str] = (),
    digits: int = 2,
    nudge: float = 0.0,
) -> DataFrame:
    """Percentage of a grouped measure in its total. A zero total gives null."""
    m = col(measure)
    total = F.sum(m).over(Window.partitionBy(*partition))
    return df.withColumn(out, rounded(F.try_divide(F.lit(100.0) * m, total), digits, nudge))


def lag_delta(
    df: DataFrame,
    measure: str,
    order: Sequence[Column | str],
    lag_out: str,
    delta_out: str,
    partition: Sequence[Column | str] = (),
    digits: int = 2,
) -> DataFrame:
    """The previous row's value and the rounded change to it; both null on the first row."""
    previous = F.lag(measure).over(_over(partition, order))
    return df.withColumn(lag_out, previous).withColumn(
        delta_out, F.round(F.col(measure) - F.col(lag_out), digits)
    )


def running_total(
    df: DataFrame,
    measure: Column | str,
    order: Sequence[Column | str],
    out: str,
    partition: Sequence[Column | str] = (),
    digits: int = 2,
    nudge: float = 0.0,
) -> DataFrame:
    """Sum of all rows up to and including the current one."""
    frame = _over(partition, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out, rounded(F.sum(col(measure)).over(frame), digits, nudge))


def moving_average(
    df: DataFrame,
    measure: Column | str,
    order: Sequence[Column | str],
    out: str,
    rows: int = 7,
    partition: Sequence[Column | str] = (),
    digits: int = 2,
    nudge: float = 0.0,
) -> DataFrame:
    """Mean of the current row and the ``rows - 1`` rows before it (rows, not calendar days)."""
    frame = _over(partition, order).rowsBetween(1 - rows, Window.currentRow)
    return df.withColumn(out, rounded(F.avg(col(measure)).over(frame), digits, nudge))


def deviation_alert(
    df: DataFrame,
    measure: str,
    order: Sequence[Column | str],
    rows: int = 7,
    k: float = 2.0,
    partition: Sequence[Column | str] = (),
    include_current: bool = True,
    digits: int = 4,
    nudge: float = 0.0,
) -> DataFrame:
    """Flag rows further than ``k`` sample standard deviations from their moving mean.

    The band covers the same rows as ``moving_average``. With ``include_current=False`` it
    covers the ``rows`` rows before the current one, so an outlier cannot widen its own band.
    Without a standard deviation (fewer than two rows) nothing is flagged.
    """
    first, last = (1 - rows, 0) if include_current else (-rows, -1)
    frame = _over(partition, order).rowsBetween(first, last)
    mean, sd = F.avg(measure).over(frame), F.stddev_samp(measure).over(frame)
    return df.withColumns(
        {
            "moving_mean": rounded(mean, digits, nudge),
            "moving_sd": rounded(sd, digits, nudge),
            "alert": F.coalesce(F.abs(F.col(measure) - mean) > F.lit(k) * sd, F.lit(False)),
        }
    )
