"""Column profile and quality issues as distributed jobs.

Everything but quantiles and duplicates comes from one aggregate over all columns, whose
single row is then turned into one row per column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.functions.aggregates import count_where, row_count
from tripmart.functions.scalars import col, rounded
from tripmart.operators.quantiles import (
    interpolated,
    quantiles,
    ranked_values,
    value_counts,
)

# Fixed values of the quality rules and of the charts.
OUTLIER_MULTIPLIER = 1.5
DISPLAY_CAP = 0.99
HISTOGRAM_BINS = 50
DENSITY_POINTS = 200
SAMPLE_VALUES = 5
SAMPLE_WIDTH = 60

# Into how many groups of tasks the samples of a column are merged first.
SAMPLE_PARTS = 512
# Kernel values that a task holds at a time while it sums densities.
KERNEL_CELLS = 400_000


def _percent(part: Column, whole: Column, digits: int, nudge: float) -> Column:
    """Percentage of a whole; zero when there is nothing to divide by."""
    share = F.when(whole > 0, F.lit(100.0) * part / whole).otherwise(F.lit(0.0))
    return rounded(share, digits, nudge)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def column_nulls(df: DataFrame) -> DataFrame:
    """``position, column_name, row_count, null_count``: one pass, one row per column."""
    stats = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(c).alias("column_name"),
                row_count().alias("row_count"),
                (row_count() - F.count(col(c))).alias("null_count"),
            )
            for i, c in enumerate(df.columns, start=1)
        ]
    )
    return df.agg(stats.alias("s")).select(F.inline("s"))


def _first_values(n: int, columns: int):
    """A task function that keeps, for each column, the ``n`` first values in the order of place and text.

    It carries all it needs, so the executors need no copy of this package.
    """

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        # A place that is null comes before all others.
        order = [(name, "ascending") for name in ("known", "place", "value")]
        held = []
        for batch in batches:
            if not batch.num_rows:
                continue
            place = batch.column(0)
            known = place.is_valid().cast(pa.int8())
            found = []
            for i in range(columns):
                value = batch.column(i + 1)
                rows = pa.table([known, place, value], ["known", "place", "value"]).filter(value.is_valid())
                found.append(pa.concat_tables([held[i], rows]) if held else rows)
            # What is kept is copied, so that no batch stays in memory.
            held = [
                (t.take(pc.select_k_unstable(t, k=n, sort_keys=order)) if t.num_rows > n else t).combine_chunks()
                for t in found
            ]
        for i, kept in enumerate(held):
            entries = [c.combine_chunks() for c in kept.columns[1:]]
            entries = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in entries]
            listed = pa.ListArray.from_arrays([0, kept.num_rows], pa.StructArray.from_arrays(entries, ["place", "value"]))
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), listed], ["position", "kept"])

    return run


def column_samples(
    df: DataFrame, order_by: str | None = None, n: int = SAMPLE_VALUES, width: int = SAMPLE_WIDTH
) -> DataFrame:
    """``column_name, samples``: the first ``n`` non-null values of each column by ``order_by``
    and, where that is equal or not given, by their text. A column of nulls only has an empty list;
    a table without rows has no row.

    One pass for all columns. Every task keeps ``n`` values per column and sends one row per column;
    these are merged in two steps, so that no task meets those of all others.
    """
    place = col(order_by) if order_by else F.lit(0)
    rows = df.select(place.alias("place"), *[col(c).cast("string").alias(f"c{i}") for i, c in enumerate(df.columns)])
    entry = T.StructType([T.StructField("place", rows.schema["place"].dataType), T.StructField("value", T.StringType())])
    schema = T.StructType([T.StructField("position", T.IntegerType()), T.StructField("kept", T.ArrayType(entry))])
    kept = rows.mapInArrow(_first_values(n, len(df.columns)), schema).withColumn(
        "part", F.spark_partition_id() % SAMPLE_PARTS
    )
    first = F.slice(F.sort_array(F.flatten(F.collect_list("kept"))), 1, n).alias("kept")
    merged = kept.groupBy("position", "part").agg(first).groupBy("position").agg(first)
    names = F.array(*[F.lit(c) for c in df.columns])
    return merged.select(
        F.element_at(names, F.col("position") + 1).alias("column_name"),
        F.substring(F.concat_ws(", ", F.col("kept.value")), 1, width).alias("samples"),
    )


def schema_table(
    df: DataFrame, order_by: str | None = None, samples: int = SAMPLE_VALUES, nudge: float = 0.0
) -> DataFrame:
    """Column, type, non-null count, null percentage and sample values: the first ones by
    ``order_by``, or else the smallest as text. ``samples=0`` leaves them out."""
    types = F.create_map(
        *[F.lit(x) for f in df.schema.fields for x in (f.name, f.dataType.simpleString())]
    )
    base = column_nulls(df).select(
        "position",
        "column_name",
        F.element_at(types, F.col("column_name")).alias("data_type"),
        (F.col("row_count") - F.col("null_count")).alias("non_null"),
        _percent(F.col("null_count"), F.col("row_count"), 1, nudge).alias("null_pct"),
    )
    if samples:
        base = base.join(column_samples(df, order_by, samples), "column_name", "left")
    return base.orderBy("position")


def missing_table(df: DataFrame, nudge: float = 0.0) -> DataFrame:
    """Columns with nulls: count and percentage, largest first."""
    return (
        column_nulls(df)
        .filter(F.col("null_count") > 0)
        .select(
            "column_name",
            F.col("null_count").alias("missing_count"),
            _percent(F.col("null_count"), F.col("row_count"), 2, nudge).alias("missing_pct"),
        )
        .orderBy(F.desc("missing_pct"), F.asc("column_name"))
    )


def missing_chart(df: DataFrame, nudge: float = 0.0) -> DataFrame:
    """Null percentage per column with nulls, or one ``(no nulls)`` row when there are none."""
    nulls = column_nulls(df).withColumn(
        "missing_pct", _percent(F.col("null_count"), F.col("row_count"), 2, nudge)
    )
    listed = F.filter(F.collect_list(F.struct("position", "column_name", "missing_pct", "null_count")),
                      lambda s: s["null_count"] > 0)
    placeholder = F.array(
        F.struct(
            F.lit(0).alias("position"),
            F.lit("(no nulls)").alias("column_name"),
            F.lit(0.0).alias("missing_pct"),
            F.lit(0).cast("bigint").alias("null_count"),
        )
    )
    # One entry per column of the table, whatever its number of rows.
    chosen = nulls.agg(listed.alias("s")).select(
        F.when(F.size("s") > 0, F.col("s")).otherwise(placeholder).alias("s")
    )
    return chosen.select(F.inline("s")).select("position", "column_name", "missing_pct").orderBy("position")


def numeric_summary(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    method: str = "exact",
    digits: int = 4,
    nudge: float = 0.0,
) -> DataFrame:
    """Mean, median, sample standard deviation, minimum and maximum per numeric column."""
    names = list(columns or numeric_columns(df))
    moments = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.avg(c).alias("mean"),
                    F.stddev_samp(c).alias("std_dev"),
                    F.min(c).cast("double").alias("min"),
                    F.max(c).cast("double").alias("max"),
                )
                for c in names
            ]
        ).alias("s")
    ).select(F.inline("s"))
    medians = quantiles(df, {c: (c, 0.5) for c in names}, method).unpivot(
        [], names, "column_name", "median"
    )
    joined = moments.join(medians, "column_name")
    return joined.select(
        "column_name",
        *[rounded(c, digits, nudge).alias(c) for c in ("mean", "median", "std_dev", "min", "max")],
    ).orderBy("column_name")


def duplicate_summary(df: DataFrame) -> DataFrame:
    """One row: ``row_count`` and ``duplicate_rows`` (copies beyond the first of each row)."""
    copies = df.groupBy(*df.columns).agg(row_count().alias("copies"))
    return copies.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_rows"),
    )


@dataclass(frozen=True)
class QualityRules:
    """Which columns are checked for what."""

    negative: Sequence[str] = ("fare_amount",)
    non_positive: Sequence[str] = ("trip_distance",)
    outliers: Sequence[str] = ("total_amount",)
    missing: Sequence[str] = ("passenger_count",)
    flags: Mapping[str, Sequence[str]] = field(
        default_factory=lambda: {"store_and_fwd_flag": ("Y", "N")}
    )
    outlier_multiplier: float = OUTLIER_MULTIPLIER


ACTIONS = {
    "duplicate rows": "keep one copy of each row",
    "negative values": "replace by the median of the positive values",
    "non-positive values": "drop the row",
    "outliers": "cap at the outer quartile fences",
    "missing values": "impute the most frequent value",
    "missing flag": "treat as false",
    "unexpected flag values": "treat as false",
}


def quality_issues(df: DataFrame, rules: QualityRules = QualityRules(), nudge: float = 0.0) -> DataFrame:
    """``issue, column_name, issue_count, pct, action``: one row per finding.

    "missing values" is listed only where it occurs; every other check always reports.
    Rules on columns that the table does not have are skipped.
    """
    have = set(df.columns)
    checks: list[tuple[str, str, Column]] = []
    checks += [("negative values", c, F.col(c) < 0) for c in rules.negative if c in have]
    checks += [("non-positive values", c, F.col(c) <= 0) for c in rules.non_positive if c in have]
    checks += [("missing values", c, F.col(c).isNull()) for c in rules.missing if c in have]
    for c, allowed in rules.flags.items():
        if c in have:
            checks.append(("missing flag", c, F.col(c).isNull()))
            checks.append(("unexpected flag values", c, ~F.col(c).isin(*allowed)))

    parts = [
        duplicate_summary(df).select(
            F.lit("duplicate rows").alias("issue"),
            F.lit("(entire row)").alias("column_name"),
            F.col("duplicate_rows").alias("issue_count"),
            "row_count",
        )
    ]
    if checks:
        parts.append(
            df.agg(
                F.array(
                    *[
                        F.struct(
                            F.lit(issue).alias("issue"),
                            F.lit(c).alias("column_name"),
                            count_where(condition).alias("issue_count"),
                            F.lit(None).cast("bigint").alias("row_count"),
                        )
                        for issue, c, condition in checks
                    ]
                ).alias("s")
            ).select(F.inline("s"))
        )
    outliers = [c for c in rules.outliers if c in have]
    if outliers:
        parts.append(
            outlier_counts(df, outliers, rules.outlier_multiplier).select(
                F.lit("outliers").alias("issue"),
                "column_name",
                F.col("outlier_count").alias("issue_count"),
                F.lit(None).cast("bigint").alias("row_count"),
            )
        )
    actions = F.create_map(*[F.lit(x) for pair in ACTIONS.items() for x in pair])
    # One row per finding from here on; the number of rows is known from the duplicate check.
    total = F.max("row_count").over(Window.partitionBy())
    return (
        reduce(DataFrame.union, parts)
        .withColumn("row_count", total)
        .filter((F.col("issue") != "missing values") | (F.col("issue_count") > 0))
        .select(
            "issue",
            "column_name",
            "issue_count",
            _percent(F.col("issue_count"), F.col("row_count"), 2, nudge).alias("pct"),
            F.element_at(actions, F.col("issue")).alias("action"),
        )
    )


def outlier_counts(
    df: DataFrame, columns: Sequence[str], k: float = OUTLIER_MULTIPLIER
) -> DataFrame:
    """``column_name, low_fence, high_fence, outlier_count``: values beyond ``k`` times the
    interquartile range from the quartiles. Both the quartiles and the counts come from the
    value counts, so the table is read once."""
    counts = value_counts(df, {c: c for c in columns})
    found = ranked_values(
        counts, {"q1": (None, 0.25), "q3": (None, 0.75)}, series_bound=len(columns)
    )
    quartiles = found.groupBy(F.col("series").alias("of")).agg(
        *[F.max(F.when(F.col("name") == q, interpolated())).alias(q) for q in ("q1", "q3")]
    )
    reach = F.lit(float(k)) * (F.col("q3") - F.col("q1"))
    fences = quartiles.select(
        "of", (F.col("q1") - reach).alias("low_fence"), (F.col("q3") + reach).alias("high_fence")
    )
    outside = (F.col("value") < F.col("low_fence")) | (F.col("value") > F.col("high_fence"))
    return (
        counts.join(F.broadcast(fences), F.col("series") == F.col("of"))  # one row per column
        .groupBy(F.col("of").alias("column_name"), "low_fence", "high_fence")
        .agg(F.sum(F.when(outside, F.col("weight")).otherwise(F.lit(0))).alias("outlier_count"))
    )


def capped_counts(
    df: DataFrame, columns: Sequence[str], cap: float = DISPLAY_CAP
) -> tuple[DataFrame, DataFrame]:
    """Value counts up to each column's ``cap`` quantile, and one row of statistics per column
    (``series, low, high, n, mean``). The input is read once; the rest works on counts."""
    counts = value_counts(df, {c: c for c in columns})
    caps = ranked_values(counts, {"cap": (None, cap)}, series_bound=len(columns)).select(
        F.col("series").alias("of"),
        interpolated().alias("cap"),
    )
    capped = counts.join(
        F.broadcast(caps),  # one row per listed column
        (F.col("series") == F.col("of")) & (F.col("value") <= F.col("cap")),
    ).select("series", "value", "weight")
    stats = capped.groupBy("series").agg(
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        F.sum("weight").alias("n"),
        (F.sum(F.col("value") * F.col("weight")) / F.sum("weight")).alias("mean"),
    )
    return capped, stats


def histograms(
    df: DataFrame,
    columns: Sequence[str],
    bins: int = HISTOGRAM_BINS,
    cap: float = DISPLAY_CAP,
    digits: int = 4,
    nudge: float = 0.0,
) -> DataFrame:
    """Equal-width histogram of every column below its cap, empty bins included.

    ``column_name, bin, bin_low, bin_high, bin_count, mean``; the last bin includes its upper
    edge. A constant column gets a range of width one around its value.
    """
    capped, stats = capped_counts(df, columns, cap)
    flat = F.col("low") == F.col("high")
    ranges = stats.select(
        F.col("series").alias("of"),
        F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")).alias("start"),
        (F.when(flat, F.lit(1.0)).otherwise(F.col("high") - F.col("low")) / F.lit(float(bins))).alias("width"),
        "mean",
    )
    index = F.floor((F.col("value") - F.col("start")) / F.col("width"))
    keys = ["series", "start", "width", "mean"]
    filled = (
        capped.join(F.broadcast(ranges), F.col("series") == F.col("of"))  # one row per column
        .groupBy(*keys, F.least(index, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.sum("weight").alias("bin_count"))
    )
    # At most ``bins`` entries per column.
    by_bin = F.map_from_entries(F.collect_list(F.struct("bin", "bin_count")))
    edge = F.col("start") + F.col("width") * F.col("bin")
    return (
        filled.groupBy(*keys)
        .agg(by_bin.alias("by_bin"))
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
        .select(
            F.col("series").alias("column_name"),
            "bin",
            rounded(edge, digits, nudge).alias("bin_low"),
            rounded(edge + F.col("width"), digits, nudge).alias("bin_high"),
            F.coalesce(F.try_element_at("by_bin", F.col("bin")), F.lit(0)).cast("bigint").alias("bin_count"),
            rounded("mean", digits, nudge).alias("mean"),
        )
        .orderBy("column_name", "bin")
    )


def _kernel_sums(points: int):
    """A task function that sums the weighted kernels of its values at every point of each column's grid.

    It carries all it needs, so the executors need no copy of this package.
    """
    cells = KERNEL_CELLS

    def run(batches):
        import numpy as np
        import pyarrow as pa

        block = max(1, cells // points)
        sums = {}
        for batch in batches:
            named = batch.column(0).dictionary_encode()
            codes = named.indices.to_numpy()
            value, weight = (batch.column(i).to_numpy() for i in (1, 2))
            for code, series in enumerate(named.dictionary.to_pylist()):
                mine = np.nonzero(codes == code)[0]
                low, high, h, n = (batch.column(i)[int(mine[0])].as_py() for i in (3, 4, 5, 6))
                x = low + (high - low) * np.arange(points) / float(points - 1)
                _, mass = sums.setdefault(series, ((low, high, h, n), np.zeros(points)))
                for at in range(0, len(mine), block):
                    some = mine[at : at + block]
                    z = (x[:, None] - value[some]) / h
                    mass += np.exp(-0.5 * z * z) @ weight[some]
        if sums:
            scales = list(zip(*(scale for scale, _ in sums.values())))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(sums), pa.string()),
                    *(pa.array(c, pa.float64()) for c in scales),
                    pa.array([mass for _, mass in sums.values()], pa.list_(pa.float64())),
                ],
                names=["series", "low", "high", "h", "n", "mass"],
            )

    return run


def densities(
    df: DataFrame,
    columns: Sequence[str],
    points: int = DENSITY_POINTS,
    cap: float = DISPLAY_CAP,
    digits: int = 6,
    nudge: float = 0.0,
    cells: int | None = None,
) -> DataFrame:
    """Gaussian kernel density of every column below its cap, at equally spaced points.

    The bandwidth is ``sd * n ** (-1/5)``. Each distinct value contributes once, with its
    weight, to every point. A task adds whole grids of points and sends one per column: rows are
    not multiplied by the number of points, and the shuffle does not grow with the number of values.
    ``cells`` first gathers the values into that many cells per column, which bounds the work
    for columns whose values hardly repeat, at the cost of an approximation.
    """
    capped, stats = capped_counts(df, columns, cap)
    stats = stats.withColumnRenamed("series", "of")
    if cells:
        step = (F.col("high") - F.col("low")) / F.lit(float(cells))
        index = F.least(F.floor((F.col("value") - F.col("low")) / step), F.lit(cells - 1))
        middle = F.when(step > 0, F.col("low") + (index + 0.5) * step).otherwise(F.col("value"))
        capped = (
            capped.join(F.broadcast(stats), F.col("series") == F.col("of"))
            .groupBy("series", middle.alias("value"))
            .agg(F.sum("weight").alias("weight"))
        )
    centred = capped.join(F.broadcast(stats), F.col("series") == F.col("of"))
    spread = centred.groupBy("of", "low", "high", "n").agg(
        F.sqrt(
            F.try_divide(
                F.sum(F.col("weight") * (F.col("value") - F.col("mean")) ** 2), F.max("n") - 1
            )
        ).alias("sd")
    )
    grid = spread.filter(F.col("sd") > 0).select(
        "of",
        "low",
        "high",
        "n",
        (F.col("sd") * F.pow(F.col("n"), F.lit(-0.2))).alias("h"),
    )
    scaled = capped.join(F.broadcast(grid), F.col("series") == F.col("of")).select(
        "series", "value", F.col("weight").cast("double").alias("weight"), "low", "high", "h", F.col("n").cast("double").alias("n")
    )
    # One row per task and column.
    grids = scaled.mapInArrow(
        _kernel_sums(points), "series string, low double, high double, h double, n double, mass array<double>"
    )
    of = ["series", "low", "high", "h", "n"]
    summed = (
        grids.select(*of, F.posexplode("mass").alias("point", "part"))
        .groupBy(*of, "point")
        .agg(F.sum("part").alias("mass"))
    )
    x = F.col("low") + (F.col("high") - F.col("low")) * F.col("point") / F.lit(float(points - 1))
    norm = F.col("n") * F.col("h") * F.sqrt(F.lit(2.0) * F.pi())
    return summed.select(
        F.col("series").alias("column_name"),
        "point",
        rounded(x, 4, nudge).alias("x"),
        rounded(F.col("mass") / norm, digits, nudge).alias("density"),
    ).orderBy("column_name", "point")
