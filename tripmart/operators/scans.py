"""Running values and ranks over all rows of a table, without a window that has no partition.

A window without a partition moves every row into one task. Here rows are range-partitioned by
the order instead and stored as *slices*. Each slice reports one row (its number of rows, its sum,
its first and last keys, its last few values); a fold over these rows says what each slice is
to carry in, and windows run inside the slices. The carried frame has one row per slice, so
its size is that of the partitioning and not that of the data.

Rows that are equal in the order are spread by a hash of the whole row and by their place in the input, so
one key may fill several slices. Their order among one another is not defined, as in SQL; the total, lag and
mean of such rows need further columns in ``order`` to be repeatable. Nulls sort as Spark's ``asc`` and
``desc`` have them. An empty table gives an empty result. Column names of the input are never
met by those used inside.

The input should be read from files without a shuffle of its own: the place in the input is then the
same when a task is repeated.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tripmart.functions.scalars import col, rounded
from tripmart.sources.workspace import workspace

# A running id holds the number of its partition above this many bits.
ROW_BITS = 33
SLICE_ROWS = 1 << 20  # rows of a slice at most, when the number of slices is not given


def _fresh(taken: Sequence[str], wanted: str) -> str:
    lowered = {c.lower() for c in taken}
    while wanted in lowered:
        wanted = "_" + wanted
    return wanted


def _by(order: Column | str) -> Column:
    return F.col(order) if isinstance(order, str) else order


@dataclass(frozen=True)
class Slices:
    """Stored rows in slices: ``slice`` and ``at`` (row in the slice, from 0) are the names of
    two columns beside those of the input (``columns``)."""

    rows: DataFrame
    columns: list[str]
    slice: str
    at: str


def slice_rows(df: DataFrame, order: Sequence[Column | str], slices: int | None = None) -> Slices:
    """Range-partition, sort and store ``df``. ``slices`` is by default the session's number of
    shuffle partitions, or more where slices would pass ``SLICE_ROWS`` rows. One shuffle."""
    spark = df.sparkSession
    place, tie = _fresh(df.columns, "_place"), _fresh(df.columns, "_tie")
    number, at = _fresh(df.columns, "_slice"), _fresh(df.columns, "_at")
    count = slices or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // SLICE_ROWS))
    plain = [f.name for f in df.schema if "map<" not in f.dataType.simpleString() and f.dataType.typeName() != "variant"]
    tied = df.select("*", F.xxhash64(*[_name(c) for c in plain]).alias(tie), F.monotonically_increasing_id().alias(place))
    keys = [*[_by(o) for o in order], F.col(tie), F.col(place)]
    sorted_rows = tied.repartitionByRange(count, *keys).sortWithinPartitions(*keys).drop(tie, place)
    path = workspace(spark, "slices")
    sorted_rows.select("*", F.monotonically_increasing_id().alias(at)).write.parquet(path)
    found = spark.read.schema(StructType([*df.schema, StructField(at, LongType())])).parquet(path)
    rows = found.select(
        *[_name(c) for c in df.columns],
        F.shiftright(at, ROW_BITS).alias(number),
        F.col(at).bitwiseAND((1 << ROW_BITS) - 1).alias(at),
    )
    return Slices(rows, list(df.columns), number, at)


def _name(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def _folded(per_slice: DataFrame, key: str, start: Column, step, finish) -> DataFrame:
    """Fold over the one row per slice, in the order of ``key``: ``step(state, slice)`` is the next
    state and ``finish(state, slice)`` the struct of columns that the slice gets. One row per
    slice comes back. The array that is folded has one entry per slice."""
    listed = per_slice.agg(F.sort_array(F.collect_list(F.struct(key, *[c for c in per_slice.columns if c != key]))).alias("all"))
    nothing = F.filter(F.transform("all", lambda s: finish(start, s)), lambda s: F.lit(False))
    folded = F.aggregate(
        "all",
        F.struct(start.alias("state"), nothing.alias("out")),
        lambda acc, s: F.struct(
            step(acc["state"], s).alias("state"),
            F.concat(acc["out"], F.array(finish(acc["state"], s))).alias("out"),
        ),
        lambda acc: acc["out"],
    )
    return listed.select(F.inline(folded))


def _joined(sliced: Slices, carried: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rows with what their slice carries in; ``carried`` has one row per slice."""
    side = carried.select(*[F.col(c).alias(n) for c, n in names.items()])
    of = names["slice"]
    return sliced.rows.join(F.broadcast(side), F.col(sliced.slice) == F.col(of)).drop(of)


def with_positions(df: DataFrame, order: Sequence[Column | str], out: str, slices: int | None = None) -> DataFrame:
    """Add the place of every row in the order, from 0: 64-bit, without a gap. One shuffle, no window."""
    sliced = slice_rows(df, order, slices)
    before = _fresh([*df.columns, out, sliced.slice, sliced.at], "_before")
    of = _fresh([*df.columns, out, sliced.slice, sliced.at], "_of")
    per_slice = sliced.rows.groupBy(F.col(sliced.slice).alias("slice")).agg(F.count(F.lit(1)).alias("n"))
    carried = _folded(
        per_slice, "slice", F.lit(0).cast("long"),
        lambda state, s: state + s["n"],
        lambda state, s: F.struct(s["slice"].alias("slice"), state.alias("before")),
    )
    rows = _joined(sliced, carried, {"slice": of, "before": before})
    return rows.select(*[_name(c) for c in df.columns], (F.col(before) + F.col(sliced.at)).alias(out))


def scan_rows(
    df: DataFrame,
    measure: Column | str,
    order: Sequence[Column | str],
    total: str | None = None,
    previous: str | None = None,
    delta: str | None = None,
    mean: str | None = None,
    rows: int = 7,
    digits: int = 2,
    nudge: float = 0.0,
    slices: int | None = None,
) -> DataFrame:
    """Add the running total, the previous row's value, the change to it and the mean of the current
    and the ``rows - 1`` rows before, each under the given name or not at all.

    As in SQL, totals and means leave nulls out, a total or mean over nulls only is null, and a
    value without a previous row has a null one. A decimal ``measure`` is summed exactly.
    Two shuffles: one by range, one by slice.
    """
    taken = [*df.columns, *filter(None, (total, previous, delta, mean))]
    value = _fresh(taken, "_value")
    sliced = slice_rows(df.withColumn(value, col(measure)), order, slices)
    taken += [value, sliced.slice, sliced.at]
    names = {n: _fresh(taken, f"_{n}") for n in ("slice", "before", "seen", "tail")}
    names["slice"] = _fresh(taken, "_of")
    keep = max(1, rows - 1)

    at, v = F.col(sliced.at), F.col(value)
    counted = sliced.rows.groupBy(F.col(sliced.slice).alias("slice")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(v).alias("sum"), F.count(v).alias("values")
    )
    ends = (
        sliced.rows.select(F.col(sliced.slice).alias("slice"), at.alias("at"), v.alias("value"))
        .join(F.broadcast(counted.select(F.col("slice").alias("of"), "n")), F.col("slice") == F.col("of"))
        .filter(F.col("at") >= F.col("n") - keep)
        .groupBy("slice")
        # At most ``rows - 1`` entries per slice.
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "value"))), lambda e: e["value"]).alias("tail"))
    )
    per_slice = counted.drop("n").join(F.broadcast(ends), "slice")
    sum_type = counted.schema["sum"].dataType
    none = F.filter(F.array(F.lit(None).cast(sliced.rows.schema[value].dataType)), lambda e: F.lit(False))

    def last(values: Column) -> Column:
        return F.slice(values, F.greatest(F.size(values) - keep + 1, F.lit(1)), keep)

    carried = _folded(
        per_slice, "slice",
        F.struct(F.lit(0).cast(sum_type).alias("before"), F.lit(0).cast("long").alias("seen"), none.alias("tail")),
        lambda state, s: F.struct(
            (state["before"] + F.coalesce(s["sum"], F.lit(0))).cast(sum_type).alias("before"),
            (state["seen"] + s["values"]).alias("seen"),
            last(F.concat(state["tail"], s["tail"])).alias("tail"),
        ),
        lambda state, s: F.struct(
            s["slice"].alias("slice"), state["before"].alias("before"), state["seen"].alias("seen"), state["tail"].alias("tail")
        ),
    )
    joined = _joined(sliced, carried, names)
    inside = Window.partitionBy(sliced.slice).orderBy(sliced.at)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = inside.rowsBetween(1 - rows, Window.currentRow)
    tail = F.col(names["tail"])
    # How many of the last rows of earlier slices the frame still covers.
    want = F.least(F.greatest(F.lit(rows - 1) - at, F.lit(0)), F.size(tail)).cast("int")
    outside = F.filter(F.slice(tail, F.size(tail) - want + 1, want), lambda e: e.isNotNull())
    # An array index of 0 is refused, so the slice starts at 1 where nothing is wanted.
    outside = F.when(want > 0, outside).otherwise(none)

    lag = F.when(at > 0, F.lag(v).over(inside)).otherwise(F.try_element_at(tail, F.lit(-1)))
    seen = F.col(names["seen"]) + F.count(v).over(upto)
    running = F.when(seen > 0, F.col(names["before"]) + F.coalesce(F.sum(v).over(upto), F.lit(0)))
    spread = F.coalesce(F.sum(v).over(near), F.lit(0)) + F.aggregate(
        outside, F.lit(0).cast(sum_type), lambda acc, e: (acc + e).cast(sum_type)
    )
    number = F.count(v).over(near) + F.size(outside)
    added = {
        total: rounded(running, digits, nudge),
        previous: lag,
        delta: F.round(v - lag, digits),
        mean: rounded(F.try_divide(spread.cast("double"), number), digits, nudge),
    }
    return joined.select(*[_name(c) for c in df.columns], *[e.alias(n) for n, e in added.items() if n])


def rank_rows(
    df: DataFrame,
    order: Sequence[Column | str | tuple[Column | str, str]],
    rank: str | None = None,
    dense_rank: str | None = None,
    row_number: str | None = None,
    ntile: Mapping[str, int] | None = None,
    slices: int | None = None,
) -> DataFrame:
    """Add ranks over all rows, each under the given name or not at all.

    ``order`` lists columns or expressions without a direction; ``(column, "desc")`` turns one round.
    A group of ties may reach over several slices: a slice that begins with the key on which the one
    before ended goes on with that key's rank. ``row_number`` and ``ntile`` (name -> number of tiles) need
    an order without ties to be repeatable. Two shuffles: one by range, one by slice.
    """
    ntile = dict(ntile or {})
    taken = [*df.columns, *filter(None, (rank, dense_rank, row_number)), *ntile]
    keys = [_fresh(taken, f"_key{i}") for i in range(len(order))]
    split = [o if isinstance(o, tuple) else (o, "asc") for o in order]
    # Keys of the order as columns, so that equal ones can be told.
    keyed = df.withColumns({k: col(o) for k, (o, _) in zip(keys, split)})
    directed = [F.desc(k) if way == "desc" else F.asc(k) for k, (_, way) in zip(keys, split)]
    sliced = slice_rows(keyed, directed, slices)
    taken += [*keys, sliced.slice, sliced.at]
    names = {n: _fresh(taken, f"_{n}") for n in ("before", "dense", "tied", "all")}
    names["slice"] = _fresh(taken, "_of")

    key = F.struct(*keys)
    if rank is None and dense_rank is None:
        # Row numbers and tiles need only the rows before a slice: no group per key. ``keys``
        # counts rows here; only dense ranks read it.
        per_slice = sliced.rows.groupBy(F.col(sliced.slice).alias("slice")).agg(
            F.count(F.lit(1)).alias("n"),
            F.count(F.lit(1)).alias("keys"),
            F.min_by(key, sliced.at).alias("first"),
            F.max_by(key, sliced.at).alias("last"),
            F.max(sliced.at).alias("last_at"),
        )
    else:
        groups = sliced.rows.groupBy(F.col(sliced.slice).alias("slice"), *keys).agg(
            F.min(sliced.at).alias("at"), F.count(F.lit(1)).alias("n")
        )
        per_slice = groups.groupBy("slice").agg(
            F.sum("n").alias("n"),
            F.count(F.lit(1)).alias("keys"),
            F.min_by(key, "at").alias("first"),
            F.max_by(key, "at").alias("last"),
            F.max("at").alias("last_at"),
        )
    key_type = per_slice.schema["first"].dataType
    zero = F.lit(0).cast("long")

    def tied(state: Column, s: Column) -> Column:
        return (state["before"] > 0) & state["key"].eqNullSafe(s["first"])

    def dense(state: Column, s: Column) -> Column:
        return state["dense"] - F.when(tied(state, s), 1).otherwise(0)

    carried = _folded(
        per_slice, "slice",
        F.struct(zero.alias("before"), zero.alias("dense"), zero.alias("rank"), F.lit(None).cast(key_type).alias("key")),
        lambda state, s: F.struct(
            (state["before"] + s["n"]).alias("before"),
            (dense(state, s) + s["keys"]).alias("dense"),
            F.when(tied(state, s) & (s["last_at"] == 0), state["rank"])
            .otherwise(state["before"] + s["last_at"] + 1).alias("rank"),
            s["last"].alias("key"),
        ),
        lambda state, s: F.struct(
            s["slice"].alias("slice"),
            state["before"].alias("before"),
            dense(state, s).alias("dense"),
            F.when(tied(state, s), state["rank"]).alias("tied"),
        ),
    )
    carried = carried.join(F.broadcast(per_slice.agg(F.sum("n").alias("all"))), F.lit(True))  # one row
    joined = _joined(sliced, carried, names)
    inside = Window.partitionBy(sliced.slice).orderBy(*directed)
    before = F.col(names["before"])
    position = before + F.col(sliced.at)
    local = F.rank().over(inside)
    added = {
        rank: F.when((local == 1) & F.col(names["tied"]).isNotNull(), F.col(names["tied"])).otherwise(before + local),
        dense_rank: F.col(names["dense"]) + F.dense_rank().over(inside),
        row_number: position + 1,
    }
    for name, tiles in ntile.items():
        size = F.floor(F.col(names["all"]) / tiles)
        longer = F.col(names["all"]) % tiles  # the first tiles have one row more
        within = F.floor(position / (size + 1))
        beyond = longer + F.floor(F.try_divide(position - longer * (size + 1), size))
        added[name] = F.when(position < longer * (size + 1), within).otherwise(beyond) + 1
    return joined.select(
        *[_name(c) for c in df.columns], *[e.cast("long").alias(n) for n, e in added.items() if n]
    )
