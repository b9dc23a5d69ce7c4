"""Checks on stored tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions.aggregates import null_count, row_count
from tripmart.functions.scalars import rounded

# The columns of each stored table that must not be null.
KEY_COLUMNS = {
    "fact_trips": ("trip_distance", "fare_amount", "total_amount", "payment_type"),
    "dim_time": ("pickup_date", "pickup_hour"),
    "dim_location": ("location_id",),
    "dim_payment": ("payment_type", "payment_label"),
    "dim_vendor": ("VendorID",),
}


def key_nulls(df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """``table_name, column_name, null_count`` for the key columns, in one pass."""
    return df.agg(
        F.array(
            *[
                F.struct(F.lit(c).alias("column_name"), null_count(c).alias("null_count"))
                for c in keys
            ]
        ).alias("s")
    ).select(F.lit(name).alias("table_name"), F.inline("s"))


def _status() -> Column:
    return F.when(F.col("row_count") == 0, "FAIL").when(F.col("null_keys") > 0, "WARN").otherwise("OK")


def table_check(
    df: DataFrame, name: str, keys: Sequence[str] = (), path: str | None = None
) -> DataFrame:
    """One row: rows, nulls in key columns, status.

    ``FAIL`` without rows, ``WARN`` with nulls in a key, else ``OK``. Only the key columns are read.
    """
    nulls = reduce(lambda a, b: a + b, [null_count(k) for k in keys if k in df.columns], F.lit(0))
    return (
        df.agg(row_count().alias("row_count"), nulls.cast("bigint").alias("null_keys"))
        .select(
            F.lit(name).alias("table_name"),
            "row_count",
            "null_keys",
            _status().alias("status"),
            F.lit(path).cast("string").alias("path"),
        )
    )


def validate_tables(
    tables: Mapping[str, DataFrame],
    keys: Mapping[str, Sequence[str]] = KEY_COLUMNS,
    paths: Mapping[str, str] | None = None,
) -> DataFrame:
    """The summary of all tables, one row each."""
    return reduce(
        DataFrame.union,
        [
            table_check(df, name, keys.get(name, ()), (paths or {}).get(name))
            for name, df in tables.items()
        ],
    )


def counted_checks(
    spark: SparkSession, counts: Mapping[str, Mapping[str, int]], paths: Mapping[str, str] | None = None
) -> DataFrame:
    """``validate_tables`` from counts that were taken while the tables were written: by table, its
    ``row_count`` and the nulls of each key column."""
    rows = [
        (name, found["row_count"], sum(n for k, n in found.items() if k != "row_count"), (paths or {}).get(name))
        for name, found in counts.items()
    ]
    checked = spark.createDataFrame(rows, "table_name string, row_count long, null_keys long, path string")
    return checked.select("table_name", "row_count", "null_keys", _status().alias("status"), "path")


def counted_key_nulls(spark: SparkSession, counts: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """``key_nulls`` of all tables, from the same counts."""
    rows = [(name, k, n) for name, found in counts.items() for k, n in found.items() if k != "row_count"]
    return spark.createDataFrame(rows, "table_name string, column_name string, null_count long")


def counted_reconciliation(spark: SparkSession, raw_rows: int, stored_rows: int, nudge: float = 0.0) -> DataFrame:
    """``reconcile`` from two counts."""
    return _reconciled(spark.createDataFrame([(raw_rows, stored_rows)], "raw_rows long, stored_rows long"), nudge)


def require_rows(summary: DataFrame) -> None:
    """Raise if a table has no rows. Brings one name per failed table to the driver."""
    empty = [r["table_name"] for r in summary.filter("status = 'FAIL'").select("table_name").collect()]
    if empty:
        raise ValueError(f"tables without rows: {', '.join(sorted(empty))}")


def reconcile(raw: DataFrame, stored: DataFrame, nudge: float = 0.0) -> DataFrame:
    """One row: rows before and after, rows removed and their percentage of the raw rows."""
    before = raw.agg(row_count().alias("raw_rows")).withColumn("stored_rows", F.lit(0).cast("bigint"))
    after = stored.agg(row_count().alias("stored_rows")).select(
        F.lit(0).cast("bigint").alias("raw_rows"), "stored_rows"
    )
    both = before.union(after).agg(F.sum("raw_rows").alias("raw_rows"), F.sum("stored_rows").alias("stored_rows"))
    return _reconciled(both, nudge)


def _reconciled(both: DataFrame, nudge: float) -> DataFrame:
    removed = F.col("raw_rows") - F.col("stored_rows")
    pct = F.when(F.col("raw_rows") > 0, F.lit(100.0) * removed / F.col("raw_rows")).otherwise(F.lit(0.0))
    return both.select(
        "raw_rows",
        "stored_rows",
        removed.alias("removed_rows"),
        rounded(pct, 2, nudge).alias("removed_pct"),
    )
