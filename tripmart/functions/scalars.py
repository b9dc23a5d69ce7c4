"""Scalar building blocks: every function takes and returns ``Column``s.

All of them are compositions of JVM built-ins, so they stay inside whole-stage
code generation and, where they are deterministic, can be pushed to the scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    """Accept a column or its name, which may hold dots; ``a.b`` of a struct is a column."""
    return F.col("`" + c.replace("`", "``") + "`") if isinstance(c, str) else c


def rounded(c: Column | str, digits: int = 2, nudge: float = 0.0) -> Column:
    """Round half up.

    ``nudge`` is added first. A double that should be an exact tie (``x.xx5``) may
    carry the noise of its summation order; a nudge far below the last kept digit
    makes such ties round the same way in every engine and on every run.
    """
    value = col(c)
    return F.round(value + F.lit(nudge) if nudge else value, digits)


def label_for(c: Column | str, labels: Mapping, default: str | None = None) -> Column:
    """Map discrete values to labels; unmatched and null values get ``default``."""
    value = col(c)
    out = None
    for key, label in labels.items():
        test, text = value == F.lit(key), F.lit(label)
        out = F.when(test, text) if out is None else out.when(test, text)
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def bucket_for(
    c: Column | str, buckets: Sequence[tuple[float, float, str]], default: str
) -> Column:
    """Label half-open ranges ``[low, high)``; anything else, and null, gets ``default``."""
    value = col(c)
    out = None
    for low, high, label in buckets:
        test, text = (value >= F.lit(low)) & (value < F.lit(high)), F.lit(label)
        out = F.when(test, text) if out is None else out.when(test, text)
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def safe_ratio(
    numerator: Column | str,
    denominator: Column | str,
    scale: float = 1.0,
    digits: int = 2,
    fallback: float = 0.0,
    nudge: float = 0.0,
) -> Column:
    """``round(n / d * scale)`` where the denominator is positive, else ``fallback``.

    The guard also keeps ANSI mode from raising on division by zero.
    """
    n, d = col(numerator), col(denominator)
    ratio = n / d if scale == 1.0 else n / d * F.lit(scale)
    return F.when(d > 0, rounded(ratio, digits, nudge)).otherwise(F.lit(fallback))


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Fractional minutes between two timestamps, at whole-second resolution."""
    return (F.unix_timestamp(col(end)) - F.unix_timestamp(col(start))) / F.lit(60.0)


def weekend_flag(day_of_week: Column | str) -> Column:
    """True on Saturday and Sunday (1 = Sunday .. 7 = Saturday); null counts as false."""
    return F.coalesce(col(day_of_week).isin(1, 7), F.lit(False))


def flag_equals(c: Column | str, true_value: str = "Y") -> Column:
    """Text flag to boolean: only ``true_value`` is true; null is false."""
    return F.coalesce(col(c) == F.lit(true_value), F.lit(False))


def with_time_parts(df: DataFrame, ts: str, prefix: str = "pickup") -> DataFrame:
    """Add ``<prefix>_hour, _dayofweek, _month, _year`` (int) and ``_date``."""
    t = F.col(ts)
    return df.withColumns(
        {
            f"{prefix}_hour": F.hour(t),
            f"{prefix}_dayofweek": F.dayofweek(t),
            f"{prefix}_month": F.month(t),
            f"{prefix}_year": F.year(t),
            f"{prefix}_date": F.to_date(t),
        }
    )
