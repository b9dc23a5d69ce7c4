"""Exact and approximate quantiles as lazy one-row frames.

The built-in exact ``percentile`` keeps every distinct value of the column in the
buffer of one task, so it cannot be used on a continuous column of unbounded size.
Here the exact path works on *value counts*:

1. ``series, value -> weight``: one pass over the input, combined on the map side. A
   value that makes up a third of all rows leaves each map task as one row.
2. The counts are range-partitioned by value. Each slice reports its weight and its
   value range; the number of slice rows is bounded by the number of partitions.
3. The running weight over the slices tells which slice holds each wanted rank, and
   only that slice is ranked.

Step 3 selects a slice by its value range, never by a partition number, so the result
does not depend on how the ranges were sampled. Both uses of the value counts share
one shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.functions.scalars import col

Wanted = Mapping[str, tuple["Column | str", float]]


def value_counts(df: DataFrame, series: Mapping[str, Column | str]) -> DataFrame:
    """``series, value, weight``: how often each non-null value occurs in each series."""
    named = df.select(*[col(e).cast("double").alias(n) for n, e in series.items()])
    long = named.unpivot([], list(series), "series", "value")
    return (
        long.filter(F.col("value").isNotNull() & F.col("series").isNotNull())
        .groupBy("series", "value")
        .agg(F.count(F.lit(1)).alias("weight"))
    )


def _neighbours(
    counts: DataFrame, probabilities: Mapping[str, tuple[str | None, float]], series_bound: int
) -> DataFrame:
    """For every wanted quantile of every series, the values around its rank.

    ``counts`` has the columns ``series, value, weight``; ``probabilities`` maps a name to
    (series or None for every series, probability). ``series_bound`` is the caller's
    bound on the number of series: it bounds the broadcast below.
    """
    kind = counts.schema["series"].dataType
    wanted = F.array(
        *[
            F.struct(F.lit(n).alias("name"), F.lit(s).cast(kind).alias("of"), F.lit(float(p)).alias("p"))
            for n, (s, p) in probabilities.items()
        ]
    )
    slices = (
        counts.repartitionByRange("series", "value")
        .groupBy("series", F.spark_partition_id().alias("slice"))
        .agg(
            F.sum("weight").alias("weight"),
            F.min("value").alias("low"),
            F.max("value").alias("high"),
        )
    )
    in_series = Window.partitionBy("series")
    placed = slices.select(
        "series",
        "low",
        "high",
        (F.sum("weight").over(in_series.orderBy("low")) - F.col("weight")).alias("before"),
        "weight",
        F.sum("weight").over(in_series).alias("total"),
    )
    position = (F.col("total") - 1) * F.col("w.p")
    hits = (
        placed.select("*", F.explode(wanted).alias("w"))
        .filter(F.col("w.of").isNull() | (F.col("w.of") == F.col("series")))
        .select(
            "series",
            "low",
            "high",
            "before",
            "weight",
            F.col("w.name").alias("name"),
            F.floor(position).alias("first"),
            F.ceil(position).alias("last"),
            (position - F.floor(position)).alias("fraction"),
        )
        .filter(
            (F.col("last") >= F.col("before"))
            & (F.col("first") < F.col("before") + F.col("weight"))
        )
        .drop("weight")
    )
    # At most two slices per quantile and series: 2 * len(probabilities) * series_bound rows.
    if 2 * len(probabilities) * series_bound <= 10_000:
        hits = F.broadcast(hits)
    inside = counts.join(
        hits.withColumnRenamed("series", "of"),
        (F.col("series") == F.col("of"))
        & F.col("value").between(F.col("low"), F.col("high")),
    )
    slice_order = Window.partitionBy("series", "name", "before").orderBy("value")
    upto = F.col("before") + F.sum("weight").over(slice_order)
    ranked = inside.select("*", upto.alias("upto"))
    first_place = F.col("upto") - F.col("weight")

    def at(rank: str) -> Column:
        return F.when(F.col(rank).between(first_place, F.col("upto") - 1), F.col("value"))

    return ranked.select(
        "series", "name", "fraction", at("first").alias("at_floor"), at("last").alias("at_ceil")
    )


def ranked_values(
    counts: DataFrame, probabilities: Mapping[str, tuple[str | None, float]], series_bound: int
) -> DataFrame:
    """``series, name, fraction, at_floor, at_ceil``: one row per quantile and series."""
    return (
        _neighbours(counts, probabilities, series_bound)
        .groupBy("series", "name", "fraction")
        .agg(F.max("at_floor").alias("at_floor"), F.max("at_ceil").alias("at_ceil"))
    )


def interpolated() -> Column:
    """Linear interpolation between the two neighbouring ranks."""
    return F.col("at_floor") + (F.col("at_ceil") - F.col("at_floor")) * F.col("fraction")


def quantiles_from_counts(
    counts: DataFrame, probabilities: Mapping[str, tuple[str, float]]
) -> DataFrame:
    """One row with a column per wanted quantile (null for a series without values)."""
    near = _neighbours(counts, probabilities, series_bound=1)
    parts = ("at_floor", "at_ceil", "fraction")
    found = near.agg(
        *[
            F.struct(
                *[F.max(F.when(F.col("name") == n, F.col(c))).alias(c) for c in parts]
            ).alias(n)
            for n in probabilities
        ]
    )
    return found.select(
        *[
            (
                F.col(f"{n}.at_floor")
                + (F.col(f"{n}.at_ceil") - F.col(f"{n}.at_floor")) * F.col(f"{n}.fraction")
            ).alias(n)
            for n in probabilities
        ]
    )


def quantiles(
    df: DataFrame, wanted: Wanted, method: str = "exact", accuracy: int = 10_000
) -> DataFrame:
    """One row with a column per entry of ``wanted`` (name -> (column, probability)).

    ``method="exact"`` interpolates linearly between neighbouring ranks. ``"approx"`` uses
    a mergeable sketch of relative error ``1 / accuracy`` in a single aggregate and returns
    values that occur in the data.
    """
    if method == "approx":
        return df.agg(
            *[
                F.percentile_approx(col(c).cast("double"), F.lit(float(p)), F.lit(accuracy)).alias(n)
                for n, (c, p) in wanted.items()
            ]
        )
    if method != "exact":
        raise ValueError(f"unknown quantile method: {method}")
    # Series are keyed by position, so that no name of an entry meets one of a column; entries
    # on one named column share a series.
    series: dict[str, Column | str] = {}
    names: dict[str, tuple[str, float]] = {}
    keys: dict[str, str] = {}
    for i, (name, (c, p)) in enumerate(wanted.items()):
        key = keys.setdefault(c, f"s{i}") if isinstance(c, str) else f"s{i}"
        series[key] = c
        names[name] = (key, p)
    return quantiles_from_counts(value_counts(df, series), names)


def grouped_quantile(
    df: DataFrame, key: Column | str, value: Column | str, p: float, out: str, groups: int
) -> DataFrame:
    """``series, <out>``: the exact quantile of ``value`` per key.

    ``groups`` is the known bound on the number of keys (for example the number of buckets).
    """
    counts = (
        df.select(col(key).alias("series"), col(value).cast("double").alias("measure"))
        .unpivot(["series"], ["measure"], "measure", "value")
        .filter(F.col("value").isNotNull() & F.col("series").isNotNull())
        .groupBy("series", "value")
        .agg(F.count(F.lit(1)).alias("weight"))
    )
    found = ranked_values(counts, {out: (None, p)}, series_bound=groups)
    return found.select("series", interpolated().alias(out))


def quantile_edges(
    df: DataFrame, value: Column | str, parts: int, method: str = "exact"
) -> tuple[DataFrame, Sequence[str]]:
    """One row with the ``parts - 1`` inner edges that cut a column into equal shares."""
    names = [f"edge_{i}" for i in range(1, parts)]
    wanted = {n: (value, i / parts) for i, n in enumerate(names, start=1)}
    return quantiles(df, wanted, method), names
